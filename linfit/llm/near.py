"""Near-duplicate documents by order min-hash, verified by banded alignment.

The k-mers of a text are its runs of five words, each labelled with the number of times it
occurred before. A sketch takes, for each of many hash orders, the few least k-mers and keeps
them in text order, so that it agrees for texts that share k-mers in one order. Texts that agree
in enough sketches are candidates. A candidate pair is verified on its k-mer sequences: with M
of them matched in order by an alignment inside a band, its similarity is M / (n + m - M).

Equal word sequences fall together first. Then, in each bucket of agreeing sketches, every text
is verified against the least one; a bucket that this leaves in one component, such as thousands
of copies of one text, is finished. In the others, texts of different components meet block by
block, so that no link between two components is left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfit.llm.common import components, map_rows, stored, unused

WORDS = 5
SIMILARITY = 0.8
#: Hash orders, k-mers each keeps, and the orders a candidate pair agrees in. At similarity 0.8
#: an order agrees with probability about 0.64, so fewer than three of sixteen agree for one
#: pair in thirty thousand.
ORDERS = 16
LEAST = 2
AGREE = 3
#: Texts of a bucket that are compared at one time.
BLOCK = 256
SEED = 20240229
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


_RANDOM = np.random.default_rng(SEED)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at one time.
CHUNK = 1 << 20


class WordHasher:
    """64-bit hashes of words (runs of non-blank bytes), many texts at a time.

    A word's hash is a polynomial of its bytes, taken as a difference of running sums.
    """

    def __init__(self):
        self.powers = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def _words(self, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word."""
        self._grow(len(b) + 1)
        solid = ~_BLANK[b]
        edge = np.diff(np.concatenate(([False], solid, [False])).astype(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * self.powers[: len(b)], out=sums[1:])
        return start, _mixed((sums[stop] - sums[start]) * self.inverse[start])

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        data = [(t or "").encode("utf-8", "replace") for t in texts]
        out: list[np.ndarray] = []
        i = 0
        while i < len(data):
            j, size = i, 0
            while j < len(data) and (j == i or size + len(data[j]) <= CHUNK):
                size += len(data[j]) + 1
                j += 1
            if size > 2 * CHUNK:  # one long text: in pieces that end after a blank
                out.append(self._long(np.frombuffer(data[i], np.uint8)))
            else:
                b = np.frombuffer(b" ".join(data[i:j]), np.uint8)
                start, hashes = self._words(b)
                ends = np.cumsum([len(d) + 1 for d in data[i:j]])
                out += np.split(hashes, np.searchsorted(start, ends[:-1]))
            i = j
        return out

    def _long(self, b: np.ndarray) -> np.ndarray:
        parts, at = [], 0
        while at < len(b):
            stop = at + CHUNK
            while stop < len(b) and not _BLANK[b[stop - 1]]:
                blank = np.flatnonzero(_BLANK[b[stop : stop + CHUNK]])
                stop = stop + int(blank[0]) + 1 if len(blank) else min(stop + CHUNK, len(b))
            parts.append(self._words(b[at:stop])[1])
            at = stop
        return np.concatenate(parts)


def kmers(words: np.ndarray, k: int = WORDS) -> np.ndarray:
    """Hashes of the runs of k words; a shorter text is one run, an empty one none."""
    if not len(words):
        return words
    k = min(k, len(words))
    code = np.zeros(len(words) - k + 1, np.uint64)
    for i in range(k):
        code = (code ^ words[i : len(words) - k + 1 + i]) * np.uint64(_BASE)
        code ^= code >> np.uint64(32)
    return code


def labelled(codes: np.ndarray) -> np.ndarray:
    """Each k-mer mixed with the number of times it stands earlier in the text."""
    if len(codes) < 2:
        return codes
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    new = np.ones(len(codes), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if new.all():
        return codes
    start = np.maximum.accumulate(np.where(new, np.arange(len(codes)), 0))
    times = np.empty(len(codes), np.uint64)
    times[order] = (np.arange(len(codes)) - start).astype(np.uint64)
    return np.where(times > 0, _mixed(codes + times * np.uint64(0x9E3779B97F4A7C15)), codes)


_ORDERS = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def sketch(codes: np.ndarray, orders: int = ORDERS, least: int = LEAST) -> np.ndarray:
    """One 63-bit value for each hash order: its least k-mers, in text order."""
    unique = labelled(codes)
    if not len(unique):
        return np.zeros(0, np.int64)
    take = min(least, len(unique))
    at = np.empty((orders, take), np.int64)
    rows = max(1, min(orders, 20_000 // len(unique)))
    for r in range(0, orders, rows):
        stop = min(r + rows, orders)
        value = unique[None, :] * _ORDERS[r:stop, None]
        value ^= value >> np.uint64(32)
        value *= _ORDERS[r + 32 : stop + 32, None]
        each = np.arange(len(value))
        for t in range(take):
            at[r:stop, t] = i = value.argmin(axis=1)
            value[each, i] = np.uint64(2**64 - 1)
    at.sort(axis=1)
    code = np.full(orders, take, np.uint64)
    for t in range(take):
        code = _mixed(code ^ unique[at[:, t]]) + unique[at[:, t]]
    return (code >> np.uint64(1)).astype(np.int64)


def aligned(a: list[int], b: list[int], most: int) -> int:
    """Elements matched in order, at most ``most`` places apart; bit-parallel along the band."""
    head = 0
    stop = min(len(a), len(b))
    while head < stop and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < stop - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not a or not b:
        return head + tail
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    # Zero bits of ``row`` mark the places of b where the longest match grows.
    width = 2 * most + 1
    full = (1 << width) - 1
    low, row, matched = 0, full, 0
    for i, x in enumerate(a):
        first = max(0, i - most)
        while low < first:  # the band moves on by one place
            matched += 1 - (row & 1)
            row = row >> 1 | 1 << width - 1
            low += 1
        hit = places.get(x, 0) >> low & full
        if hit:
            found = row & hit
            row = (row + found | row & ~hit) & full
    return head + tail + matched + width - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Matched share of two k-mer sequences; 0 where it cannot reach ``least``."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    common = len(np.intersect1d(a, b))
    repeats = max(n - len(np.unique(a)), m - len(np.unique(b)))
    need = least / (1 + least) * (n + m)
    if common + repeats < need - 1e-9:
        return 0.0
    # A match further off the diagonal would leave more than this many elements unmatched.
    most = int(n + m - 2 * need + 1e-9)
    matched = aligned(a.tolist(), b.tolist(), most)
    return matched / (n + m - matched)


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, id (digest of the word sequence), n (words), sketch."""

    def start() -> Callable:
        hasher = WordHasher()

        def work(batch) -> dict:
            ids, n, sketches = [], [], []
            for words in hasher(batch.column("text").to_pylist()):
                ids.append(xxhash.xxh3_128_digest(words.tobytes()))
                n.append(len(words))
                sketches.append(sketch(kmers(words)))
            return {"id": ids, "n": n, "sketch": sketches}

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return map_rows(rows, start, "id binary, n int, sketch array<long>", ("doc_id", "text_hash"))


def _tokens(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Word hashes, as bytes, of the texts in ``texts`` (id, doc_id, text_hash)."""

    def start() -> Callable:
        hasher = WordHasher()
        return lambda batch: {"words": [w.tobytes() for w in hasher(batch.column("text").to_pylist())]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    rows = rows.join(texts.hint("shuffle_hash"), ["doc_id", "text_hash"]).select("id", "text")
    return map_rows(rows, start, "words binary", ("id",)).dropDuplicates(["id"])


def _verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""

    def start() -> Callable:
        def work(batch) -> dict:
            ok = []
            for x, y in zip(batch.column("aw").to_pylist(), batch.column("bw").to_pylist(), strict=True):
                a, b = (kmers(np.frombuffer(v, np.uint64)) for v in (x, y))
                ok.append(similarity(a, b, least) >= least - 1e-12)
            return {"ok": ok}

        return work

    left = words.select(F.col("id").alias("a"), F.col("words").alias("aw"))
    right = words.select(F.col("id").alias("b"), F.col("words").alias("bw"))
    joined = pairs.join(left, "a").join(right, "b")
    return map_rows(joined, start, "ok boolean", ("a", "b")).where("ok").select("a", "b")


def _shared(codes: list[np.ndarray]) -> np.ndarray:
    """How many labelled k-mers each two texts have in common."""
    where = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    _, number, times = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
    often = times[number] > 1
    where, number = where[often], np.unique(number[often], return_inverse=True)[1]
    out = np.zeros((len(codes), len(codes)), np.float32)
    order = np.argsort(number, kind="stable")
    where, number = where[order], number[order]
    step = 4096
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        a, b = np.searchsorted(number, [low, low + step])
        holds = np.zeros((len(codes), step), np.float32)
        holds[where[a:b], number[a:b] - low] = 1
        out += holds @ holds.T
    return out


def _links_within(least: float):
    """Links between different components among the texts of two blocks, enough to join them.

    Labelled k-mers in common bound the matched ones, so pairs that share too few are done with;
    the others are aligned, unless links found before join them already.
    """

    def run(key, rows):
        import pandas as pd

        rows = rows.drop_duplicates(["id", "own"]).sort_values("id")
        ids, own = rows["id"].tolist(), rows["own"].to_numpy()
        texts = [kmers(np.frombuffer(w, np.uint64)) for w in rows["words"]]
        n = np.array([len(t) for t in texts], np.float32)
        common = _shared([labelled(t) for t in texts])
        enough = common >= least * (n[:, None] + n[None, :] - common) - 1e-3
        _, one, other = key
        enough &= (own == one)[:, None] & (own == other)[None, :]
        if one == other:
            enough = np.triu(enough, 1)
        parent = {r: r for r in rows["root"]}

        def top(r):
            while parent[r] != r:
                parent[r] = r = parent[parent[r]]
            return r

        roots, out = rows["root"].tolist(), []
        for x, y in zip(*np.nonzero(enough), strict=True):
            a, b = top(roots[x]), top(roots[y])
            if a != b and similarity(texts[x], texts[y], least) >= least - 1e-12:
                parent[a] = b
                out.append((ids[x], ids[y]))
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def near_links(docs: DataFrame, least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, id) of the documents with a doc_id, and components (id, root).

    ``id`` is the digest of a word sequence, so texts that differ in blanks alone are one text
    and two texts under one doc_id are two. Texts without a link are in no component.
    """
    found = stored(_sketched(docs).where("doc_id is not null"), "sketches")
    texts = found.where("n > 0").groupBy("id").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("one"), F.first("sketch").alias("sketch")
    )
    texts = stored(texts, "sketched-texts")
    keys = texts.select("id", F.posexplode("sketch").alias("r", "value"))
    keys = keys.select("id", F.xxhash64("r", "value").alias("key"))
    heads = keys.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("size"))
    members = stored(keys.join(heads.where("size > 1").select("key", "head"), "key"), "buckets")
    pairs = members.where("id <> head").groupBy("head", "id").agg(F.count("*").alias("agree"))
    pairs = pairs.where(F.col("agree") >= AGREE).select(F.col("head").alias("a"), F.col("id").alias("b"))
    # A pair that is verified shares AGREE buckets, so each of its texts is in as many.
    used = members.groupBy("id").agg(F.count("*").alias("shared")).where(F.col("shared") >= AGREE)
    wanted = texts.select("id", "one.doc_id", "one.text_hash").join(used.select("id"), "id")
    words = stored(_tokens(docs, wanted), "word-hashes")
    first = stored(_verified(pairs, words, least), "first-links")
    roots = components(first, "first")

    # Buckets that still hold several components; of those with the same members, one.
    placed = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    split = placed.groupBy("key").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.count("*").alias("size"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members"),
    )
    split = split.where("low < high and size > 2").groupBy("size", "members").agg(F.min("key").alias("key"))
    open_ = placed.select("key", "id", "root").join(split.select("key", "size"), "key").join(words, "id")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    open_ = open_.withColumn("blocks", blocks).withColumn("own", own)
    # Block i meets block j once: the group (i, j), i <= j, gets both.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")),
    )
    met = open_.select("key", "id", "root", "words", "own", F.explode(meets).alias("m"))
    met = met.select("key", "m.i", "m.j", "id", "root", "words", "own")
    met = met.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "i", "j")
    second = met.groupBy("key", "i", "j").applyInPandas(_links_within(least), "a binary, b binary")
    roots = components(stored(first.union(second), "links"), "all")
    return found.select("doc_id", "text_hash", "id"), roots


def _classes(docs: DataFrame, least: float) -> DataFrame:
    """(doc_id, text_hash, root, class_id, class_size, kept) of the documents with a doc_id."""
    named, roots = near_links(docs, least)
    found = named.join(roots, "id", "left")
    # A text without words is a class for each of its documents.
    empty = F.unhex(F.lit(xxhash.xxh3_128_hexdigest(b"")))
    alone = F.col("id") == empty
    own = F.concat(F.lit(b"\0"), F.col("doc_id").cast("string").cast("binary"))
    found = found.select("doc_id", "text_hash", "id", F.when(alone, own).otherwise(F.coalesce("root", "id")).alias("root"))
    found = stored(found, "near-found")
    # Members are counted before they meet, so one class of a third of all rows is no hot task.
    heads = found.groupBy("root").agg(
        F.min(F.struct("doc_id", "id")).alias("head"), F.count("*").alias("class_size")
    )
    joined = found.join(heads, "root")
    return joined.select(
        "doc_id",
        "text_hash",
        "root",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        (F.struct("doc_id", "id") == F.col("head")).alias("kept"),
    )


def near_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept, class_text.

    A class is a component of the links between texts with similarity of ``least`` or more.
    ``class_id`` is its smallest doc_id; the row that has it stays (of rows alike in doc_id and
    words, all; of several texts under that doc_id, the one with the least digest). Where a
    doc_id has several texts each is in the class of its own links, and classes with one
    ``class_id`` differ in ``class_text``, a digest. Texts without words (null, empty, blank) are
    classes by doc_id, and rows without doc_id classes of their own, of size 1, that stay. Texts of
    any length are compared whole; an empty table gives an empty table.
    """
    found = _classes(docs, least).select(
        "doc_id", "class_id", "class_size", "kept", F.lower(F.hex("root")).alias("class_text")
    )
    nameless = docs.where("doc_id is null").select(
        F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(1).cast("long"), F.lit(True), F.lit(None).cast("string")
    )
    return found.union(nameless)


def keep_first(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents that ``near_classes`` keeps, with all their columns, whatever their names.

    Rows go by doc_id and text together, so another text under the doc_id of a copy stays.
    """
    doc, text = unused("gone_doc", docs.columns), unused("gone_text", docs.columns)
    gone = _classes(docs, least).where("not kept").select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text))
    gone = stored(gone.distinct(), "near-dropped").hint("shuffle_hash")
    same = (F.col("doc_id").cast("long") == F.col(doc)) & (F.xxhash64("text") == F.col(text))
    return docs.join(gone, same, "left_anti")
