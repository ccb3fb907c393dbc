"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every window of ten consecutive words of a benchmark item is a pattern. Documents and patterns are
folded alike (words in lower case, one space around each), so that a window occurs in a document
exactly where its bytes do. Patterns of similar length share one set of tables: the shift table
says, for the block of bytes that ends a position's window, how far no pattern can end; only where
it says nothing can be skipped do the suffix block and the prefix block choose test strings, which
are then compared byte by byte. Many places of a batch advance together, each by its own shift.

The benchmark goes to the tasks in shards of bounded size; each shard is one more narrow pass over
the documents, so a larger benchmark costs time and no memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.llm.common import map_rows, slices, stored, unused

WORDS = 10
#: Bytes of patterns in a shard, about.
SHARD_BYTES = 32_000_000
#: Bytes of a block, bytes of a pattern that the shift table knows at most, bytes of a stretch of
#: text that one place runs over, test strings compared at one time.
BLOCK = 8
KNOWN = 128
STRETCH = 1024
TOGETHER = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


def _fold() -> np.ndarray:
    """Bytes of words, A-Z in lower case; every other byte becomes a space."""
    out = np.full(256, _SPACE, np.uint8)
    out[0x80:] = np.arange(0x80, 0x100)
    for first, last in ("09", "az"):
        out[ord(first) : ord(last) + 1] = np.arange(ord(first), ord(last) + 1)
    out[ord("A") : ord("Z") + 1] = out[ord("a") : ord("z") + 1]
    return out


_FOLD = _fold()


def folded(texts: list[bytes]) -> np.ndarray:
    """All texts in one array: a zero, then a text's words with one space around each, and so on;
    a zero ends the last. Eight more zeros stand behind, so that blocks can be read anywhere."""
    raw = np.frombuffer(b"\0 " + b" \0 ".join(texts) + b" \0", np.uint8)
    out = _FOLD[raw]
    zeros = np.cumsum([0, *(len(t) + 3 for t in texts)])
    out[zeros] = 0
    blank = out == _SPACE
    blank[1:] &= blank[:-1]
    blank[0] = False
    return np.concatenate([out[~blank], np.zeros(BLOCK, np.uint8)])


def _blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; the last seven places are left out."""
    return np.ndarray(max(0, len(data) - BLOCK + 1), "<u8", data, strides=(1,))


class Tables:
    """Shift table and buckets for patterns of similar length."""

    def __init__(self, patterns: list[bytes], numbers: np.ndarray):
        shortest = min(map(len, patterns))
        self.known = min(shortest, KNOWN)
        self.block = min(BLOCK, self.known)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        size = np.array([len(p) for p in patterns])
        start = np.cumsum(size) - size
        data = np.frombuffer(b"".join(patterns) + b"\0" * BLOCK, np.uint8)
        blocks = _blocks(data)
        last = self.known - self.block
        distinct = len(np.unique(np.concatenate([blocks[start + j] & self.mask for j in range(last + 1)])))
        self.right = np.uint64(64 - min(24, max(10, int(8 * distinct).bit_length())))
        self.shift = np.full(1 << (64 - int(self.right)), last + 1, np.int32)
        for j in range(last + 1):
            np.minimum.at(self.shift, self.place(blocks[start + j] & self.mask), last - j)
        key = self.bucket(blocks[start + last] & self.mask, blocks[start] & self.mask)
        order = np.argsort(key, kind="stable")
        self.keys, self.size, self.start = key[order], size[order], start[order]
        self.numbers, self.data = numbers[order], data

    def place(self, block: np.ndarray) -> np.ndarray:
        return ((block * _MIX) >> self.right).astype(np.int64)

    @staticmethod
    def bucket(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return suffix * _MIX ^ (prefix * _MIX >> np.uint64(7))

    def candidates(self, text: np.ndarray) -> np.ndarray:
        """Places where the shift table cannot rule out that a pattern begins."""
        blocks, lead = _blocks(text), self.known - self.block
        end = len(text) - BLOCK - self.block + 1
        at = np.arange(lead, end, STRETCH)
        stop = np.minimum(at + STRETCH, end)
        found = []
        while len(at):
            step = self.shift[self.place(blocks[at] & self.mask)]
            found.append(at[step == 0] - lead)
            at = at + np.maximum(step, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the pattern) of every occurrence."""
        at = self.candidates(text)
        blocks = _blocks(text)
        key = self.bucket(blocks[at + self.known - self.block] & self.mask, blocks[at] & self.mask)
        low, high = (np.searchsorted(self.keys, key, side) for side in ("left", "right"))
        some = high > low
        at, low, many = at[some], low[some], (high - low)[some]
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        done = 0
        total = np.cumsum(many)
        while done < len(at):
            upto = max(done + 1, int(np.searchsorted(total, total[done] - many[done] + TOGETHER, "right")))
            n = many[done:upto]
            where = np.repeat(at[done:upto], n)
            which = np.repeat(low[done:upto], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            same = self.equal(text, blocks, where, which)
            places.append(where[same])
            numbers.append(self.numbers[which[same]])
            done = upto
        return np.concatenate(places), np.concatenate(numbers)

    def equal(self, text: np.ndarray, blocks: np.ndarray, where: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether the whole pattern stands there, eight bytes at a time."""
        ours = _blocks(self.data)
        size, start = self.size[which], self.start[which]
        same = where + size <= len(text) - BLOCK
        left = np.flatnonzero(same)
        done = 0
        while len(left):
            rest = np.minimum(size[left] - done, BLOCK)
            mask = ~np.uint64(0) >> (8 * (BLOCK - rest)).astype(np.uint64)
            equal = (blocks[where[left] + done] ^ ours[start[left] + done]) & mask == 0
            same[left[~equal]] = False
            done += BLOCK
            left = left[equal & (size[left] > done)]
        return same


class Patterns:
    """One shard of (window, words, item) rows, ready to search for."""

    def __init__(self, rows: pa.Table):
        windows = rows.column("window").to_pylist()
        distinct = sorted(set(windows))
        number = {w: i for i, w in enumerate(distinct)}
        own = np.array([number[w] for w in windows], np.int64)
        order = np.argsort(own, kind="stable")
        items = rows.column("item").to_pylist()
        self.items = [items[i] for i in order]
        self.first = np.searchsorted(own[order], np.arange(len(distinct) + 1))
        self.words = np.array([w.count(b" ") - 1 for w in distinct], np.int64)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(distinct):
            by_size.setdefault(len(w).bit_length(), []).append(i)
        self.tables = [Tables([distinct[i] for i in some], np.array(some)) for some in by_size.values()]


def windows_of(text: bytes | None, words: int) -> set[bytes]:
    """The windows of a text; one of fewer words, but not none, is a window."""
    own = folded([text or b""]).tobytes().strip(b"\0").split()
    n = min(words, len(own))
    return {b" " + b" ".join(own[i : i + n]) + b" " for i in range(len(own) - n + 1)} if own else set()


def windows(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """The different (window, item) of (item_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                out, items = [], []
                texts = rows.column("text").cast(pa.binary()).to_pylist()
                for item, text in zip(rows.column("item").to_pylist(), texts, strict=True):
                    found = windows_of(text, words)
                    out += found
                    items += [item] * len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out, pa.binary()), pa.array(items, pa.string())], ["window", "item"]
                )

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return rows.mapInArrow(run, "window binary, item string").distinct()


def shards(benchmark: DataFrame, words: int = WORDS, size: int = SHARD_BYTES) -> Iterator[Patterns]:
    """The patterns in parts of about ``size`` bytes, each dealt by a hash of window and item."""
    rows = stored(windows(benchmark, words), "benchmark-windows")
    total = rows.agg(F.sum(F.length("window") + F.coalesce(F.length("item"), F.lit(0)))).first()[0] or 0
    n = -(-int(total) // size)
    for i in range(n):
        yield Patterns(rows.where(F.pmod(F.xxhash64("window", "item"), F.lit(n)) == i).toArrow())


def _search(texts: list[bytes], shard: Patterns | None, spans: list, items: list) -> dict:
    """Adds to the spans and items of each text what a shard's patterns give."""
    text = folded(texts)
    space = np.flatnonzero(text == _SPACE)
    zeros = np.flatnonzero(text[: len(text) - BLOCK] == 0)
    edge = np.searchsorted(space, zeros)
    n_words = np.diff(edge) - 1
    if shard is None or not shard.tables:
        return {"n_words": n_words, "spans": spans, "items": items}
    place, number = (np.concatenate(x) for x in zip(*(t.occurrences(text) for t in shard.tables), strict=True))
    doc = np.searchsorted(zeros, place) - 1
    word = np.searchsorted(space, place) - edge[doc]
    spans, items = list(spans), list(items)
    order = np.lexsort((word, doc))
    doc, word, number = doc[order], word[order], number[order]
    last = word + shard.words[number]
    cuts = np.flatnonzero(np.diff(doc, prepend=-1, append=-2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        d = int(doc[a])
        mine = [(s["first"], s["last"]) for s in spans[d] or []]
        spans[d] = _union(mine + list(zip(word[a:b].tolist(), last[a:b].tolist(), strict=True)))
        known = set(items[d] or [])
        for i in np.unique(number[a:b]):
            known.update(shard.items[shard.first[i] : shard.first[i + 1]])
        items[d] = sorted(known - {None})
    return {"n_words": n_words, "spans": spans, "items": items}


def _union(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"]:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


STATE = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    words: int = WORDS,
    shard_bytes: int = SHARD_BYTES,
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per document: the columns in ``carry``, n_words, spans, items.

    ``spans`` are the stretches of words (from 0, end exclusive) that occurrences of windows
    cover, merged where they touch; ``items`` are the different item_ids, as sorted strings, that
    have an occurring window. Words are runs of ASCII letters (case folded) and digits and of all
    other characters from U+0080 on; texts of any length are searched whole. Null and empty
    texts have no words; nor has an item whose text is null or empty any window. The windows of
    rows with a null item_id cover words but name no item; rows with one item_id are one item.
    Repeated documents give a row each, null doc_ids stay null, an empty table gives an empty
    table, and with an empty benchmark nothing is covered. A column in ``carry`` that is named
    like one of the results gives way to it.
    """
    spark = docs.sparkSession
    text = unused("text", docs.columns)
    state = docs.select(*carry, F.col("text").alias(text))
    state = state.withColumns({"spans": F.lit(None).cast("array<struct<first:long,last:long>>"), "items": F.lit(None).cast("array<string>")})
    parts = [spark.sparkContext.broadcast(p) for p in shards(benchmark, words, shard_bytes)]
    kept = tuple(c for c in carry if c not in ("n_words", "spans", "items"))
    for part in parts or [None]:

        def start(part=part) -> Callable[[pa.RecordBatch], dict]:
            shard = part.value if part is not None else None

            def work(rows: pa.RecordBatch) -> dict:
                texts = [t or b"" for t in rows.column(text).cast(pa.binary()).to_pylist()]
                spans, items = ([x or [] for x in rows.column(c).to_pylist()] for c in ("spans", "items"))
                return _search(texts, shard, spans, items)

            return work

        state = map_rows(state, start, STATE, (*kept, text))
    return state.drop(text)


def hit_words(spans: Column) -> Column:
    """How many words ``spans`` cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def report(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: ``overlaps`` in digits."""
    n_hit = hit_words(F.col("spans"))
    return overlaps(docs, benchmark, words).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """The documents no word of which a window covers, with all their columns.

    Columns may have any names; nulls, repeats and empty tables as in ``overlaps``.
    """
    row = unused("row", docs.columns)
    packed = docs.select(F.struct(*docs.columns).alias(row), "text")
    found = overlaps(packed, benchmark, words, carry=(row,))
    return found.where(F.size("spans") == 0).select(*(F.col(row)[c].alias(c) for c in docs.columns))
