"""Spelling variants by a relational trie frontier.

The words form a trie that exists only as a table of edges: a node is a hash of the characters
that lead to it, an edge leads from a node along a few characters to the node below. A state
(word, position, node, edits) says that the word's first characters reach the node with that many
edits. Without an edit the node is the word's own prefix; there a state takes its one edit, by
taking the edge of another character (replaced) or by staying at the node (deleted). With its edit
spent it follows the word's remaining characters, level by level, by joins with the edges; each
level takes the longest step of a power of two that is left, so a word of n characters needs at
most log n levels, and only states that a word can end rightly are carried: edges know how many
characters follow them. States at the end of a word are neighbours, checked once more on the text.

Two words one edit apart agree in their first or in their last half, so a word takes its edit in
its second half only, once forwards and once backwards. The edge that an edit takes is joined
together with the step behind it, so no state is dealt to all children of a node.

No table is broadcast: a word makes two states for each of its characters, which the planner, who
sizes them as the words, does not see.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfit.llm.common import slices, stored

SHORTEST = 7
LEAST = 2
#: A form is this many times as common as the words it stands for.
TIMES = 10
#: Words that a task counts before it hands them on.
HELD = 200_000
_LETTERS = "[A-Za-zÀ-ÿ]"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.uint64(0xD6E8FEB86659FD93)


def _inverse(odd: np.uint64) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): the words of (doc_id, text) of at least ``shortest`` characters, ``least`` times.

    Words are whole runs of letters up to U+00FF with A-Z in lower case. Where 31 divides the
    crc32 of ``<doc_id>:<run>``, the run loses one character, the one at that number. Each task
    counts before anything is shuffled, so the commonest word costs no more than another. Null and
    empty texts have no words, a null doc_id counts as an empty one, texts of any length are read
    whole, repeated rows count each, an empty table gives an empty table.
    """
    # A run loses at most one character, so shorter runs never make a word.
    runs = re.compile(_LETTERS + "{%d,}" % shortest)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"]
            )
            total.clear()
            return out

        for batch in batches:
            for rows in slices(batch):
                texts = rows.column("text").cast(pa.binary()).to_pylist()
                for doc, text in zip(rows.column("doc").to_pylist(), texts, strict=True):
                    if not text:
                        continue
                    seed = zlib.crc32(f"{doc}:".encode())
                    own = Counter(runs.findall(text.translate(_LOWER).decode("utf-8", "replace")))
                    for run, n in own.items():
                        h = zlib.crc32(run.encode(), seed)
                        if h % 31:
                            total[run] += n
                        elif len(run) > shortest:
                            k = h % len(run)
                            total[run[:k] + run[k + 1 :]] += n
                if len(total) > HELD:
                    yield flush()
        if total:
            yield flush()

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    counted = texts.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _half(n: int) -> int:
    """Characters that one end of two words has in common at least, if one edit parts them."""
    return n // 2


def _hashes(letters: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each word (a row), the hash of every prefix; and the powers to shift by."""
    rows, n = letters.shape
    # Letters become scattered odd numbers; so no change of one letter leaves a hash as it was.
    value = (letters.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _SALT
    value ^= value >> np.uint64(29)
    power = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.concatenate([power[:1], np.full(n, _STEP)]), out=power)
    out = np.full((rows, n + 1), np.uint64(salt + 1))
    np.cumsum(value * power[:n], axis=1, out=out[:, 1:])
    out[:, 1:] += np.uint64(salt + 1)
    return out, power


def _tag(label: np.ndarray, rest: int, kind: int) -> np.ndarray:
    """What an edge or a step is looked up by beside its node."""
    h = (label ^ np.uint64(rest * 2 + kind)) * _SALT
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def _steps(rest: int) -> list[int]:
    """``rest`` characters as steps of powers of two, longest first."""
    return [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


#: kind 1: another letter, then a step; kind 0: a step. ``letter`` is null for kind 0.
STATES = "word string, node long, tag long, letter int, path array<long>"
EDGES = "node long, tag long, letter int, child long, target string"


def _rows(words: list[str], states: bool, shortest: int) -> Iterator[pa.RecordBatch]:
    """States after their edit, or edges, of words of one length."""
    n = len(words[0])
    forwards = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, n)
    text = pa.array(words, pa.string())
    none = pa.nulls(len(words), pa.int32())
    back = _inverse(_STEP)
    for side in (0, 1):
        letters = forwards[:, ::-1] if side else forwards
        hashes, power = _hashes(letters, side)
        shift = np.ones(n + 1, np.uint64)
        np.multiply.accumulate(np.concatenate([shift[:1], np.full(n, back)]), out=shift)

        def label(at: int, size: int) -> np.ndarray:
            """The hash of some characters, whatever stands before them."""
            return (hashes[:, at + size] - hashes[:, at]) * shift[at]

        def path(at: int, rest: int, kind: int) -> tuple[np.ndarray, pa.Array]:
            """The tag of the first step, and those of the steps behind it."""
            tags = []
            for step in _steps(rest):
                tags.append(_tag(label(at, step), rest, 0))
                at, rest = at + step, rest - step
            first = tags[0] if tags else _tag(np.zeros(len(words), np.uint64), 0, 0)
            if kind:
                first = _tag(first.view(np.uint64), 0, 1)
            more = np.stack(tags[1:], axis=1).ravel() if len(tags) > 1 else np.zeros(0, np.int64)
            width = max(0, len(tags) - 1)
            offsets = pa.array(np.arange(len(words) + 1) * width, pa.int32())
            return first, pa.ListArray.from_arrays(offsets, pa.array(more, pa.int64()))

        def node(at: int) -> pa.Array:
            return pa.array(hashes[:, at].view(np.int64))

        for at in range(_half(n), n):
            letter = pa.array(letters[:, at].astype(np.int32))
            if states:
                first, rest = path(at + 1, n - at - 1, 1)
                yield pa.RecordBatch.from_arrays([text, node(at), pa.array(first), letter, rest], names=["word", "node", "tag", "letter", "path"])
                if n > shortest:
                    first, rest = path(at + 1, n - at - 1, 0)
                    yield pa.RecordBatch.from_arrays([text, node(at), pa.array(first), none, rest], names=["word", "node", "tag", "letter", "path"])
                continue
            for kind in (1, 0):
                begin = at + kind
                first, _ = path(begin, n - begin, kind)
                step = _steps(n - begin)[:1]
                end = begin + (step[0] if step else 0)
                whole = text if end == n else pa.nulls(len(words), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [node(at), pa.array(first), letter if kind else none, node(end), whole], names=["node", "tag", "letter", "child", "target"]
                )
        if not states:
            # A word ends at its own node: what is left after the last letter is deleted.
            first, _ = path(n, 0, 0)
            yield pa.RecordBatch.from_arrays([node(n), pa.array(first), none, node(n), text], names=["node", "tag", "letter", "child", "target"])


def _table(words: DataFrame, states: bool, shortest: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_size: dict[int, list[str]] = {}
            for w in batch.column("word").to_pylist():
                by_size.setdefault(len(w), []).append(w)
            for some in by_size.values():
                yield from _rows(some, states, shortest)

    made = words.select("word").mapInArrow(run, STATES if states else EDGES)
    key = F.xxhash64("node", "tag").alias("key")
    if states:
        return made.select("word", key, "letter", "path")
    # Where the word ends, it stands for its node.
    ends = made.where("target is not null").select(key, "letter", F.lit(None).cast("long").alias("child"), "target")
    # Words that go on alike share an edge.
    inner = made.where("target is null").select(key, "letter", "child", "target").distinct()
    return ends.union(inner)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): all ordered pairs of different words of ``words`` that are one edit apart.

    ``word`` must hold different, non-empty strings; an edit inserts, deletes or replaces one code
    point. An empty table gives an empty table.
    """
    bounds = words.agg(F.min(F.length("word")).alias("least")).first()
    if bounds.least is None:
        return words.select("word", F.col("word").alias("near")).limit(0)
    edges = stored(_table(words, False, bounds.least), "trie-edges")
    steps = edges.where("letter is null").drop("letter")
    states = _table(words, True, bounds.least)
    found = []
    while True:
        if found:
            met = states.join(steps.hint("merge"), "key")
        else:
            other = F.col("s.letter").isNull() & F.col("e.letter").isNull() | (F.col("s.letter") != F.col("e.letter"))
            met = states.alias("s").join(edges.alias("e").hint("merge"), (F.col("s.key") == F.col("e.key")) & other)
        level = stored(met.select("word", "path", "child", "target"), "trie-level")
        found.append(level.where("target is not null").select("word", F.col("target").alias("near")))
        left = level.where("target is null")
        if left.isEmpty():
            break
        states = left.select("word", F.xxhash64("child", F.col("path")[0]).alias("key"), F.slice("path", 2, 1 << 30).alias("path"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    pairs = pairs.where(F.levenshtein("word", "near", 1) == 1)
    return pairs.union(pairs.select("near", "word")).distinct()


def spelling_forms(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of (word, n).

    ``n_near`` counts the words one edit away. ``form`` is the commonest of them (ties: the
    smallest in code-point order) where it is at least ``times`` as common as the word, else null;
    ``root`` is where the forms lead in the end, the word itself if it has none. Words must be
    different and not null; an empty table gives an empty table.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as common as its words")
    counts = stored(counts.select("word", F.col("n").cast("long").alias("n")), "word-counts")
    near = near_words(counts)
    others = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(others.hint("merge"), "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best")
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"))
    common = F.col("near_n") >= times * F.col("n")
    forms = counts.join(best.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("near")).alias("form"),
        F.when(common, F.col("near_n")).alias("form_n"),
    )
    forms = stored(forms, "word-forms")
    # Each form is ``times`` as common as the last, so a chain is short; every round doubles it.
    roots = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(roots.join(further.hint("merge"), "root", "left"), "word-roots")
        roots = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.where("next is not null").isEmpty():
            break
    found = forms.join(roots.hint("merge"), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
