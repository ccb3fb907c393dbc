"""Personal data: fixed patterns, and a trained tagger that adds what they leave.

The tagger (a character-level bidirectional LSTM with CRF transitions) learns from the spans that
the patterns find in a bounded sample of documents. It reads overlapping windows around every
digit and every ``@``: each kind of span holds one of them, and only spans that do are taken, so
windows elsewhere could add nothing. Of the windows that cover a character, the one it lies
deepest in tags it; spans are then read off the whole text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfit.llm.common import held_out, map_rows
from linfit.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, how far windows lie apart, and how far they reach beyond an anchor.
WINDOW = 96
STRIDE = 48
REACH = 24
#: Training windows of each kind, and of none.
PER_KIND = 150
STEPS = 300
#: Windows tagged at one time.
TOGETHER = 512

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: long runs without one cost nothing."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by start and then kind; null counts as empty."""
    if not text:
        return []
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            parts = m.group().split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGITS.findall(m.group())) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


_SYMBOLS = string.ascii_lowercase + string.digits + "@.-+()%_ :/=,;\"'\n"
#: Symbols after the listed ones: padding, capitals, other letters, everything else.
_PAD, _CAPITAL, _LETTER, _OTHER = range(len(_SYMBOLS), len(_SYMBOLS) + 4)
_CODE = {c: i for i, c in enumerate(_SYMBOLS)} | {c: _CAPITAL for c in string.ascii_uppercase}
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind


def symbols(text: str) -> np.ndarray:
    known = [_CODE.get(c, -1) for c in text]
    other = [_LETTER if c.isalpha() else _OTHER for k, c in zip(known, text, strict=True) if k < 0]
    out = np.array(known, np.int64)
    out[out < 0] = other
    return out


def new_tagger() -> Tagger:
    allowed = np.ones((TAGS, TAGS), bool)
    starts = np.ones(TAGS, bool)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        allowed[:, inside] = False
        allowed[inside - 1 : inside + 1, inside] = True
        starts[inside] = False
    return Tagger.new(_OTHER + 1, TAGS, allowed, starts)


def tags_of(spans: list[tuple[str, int, int]], start: int, stop: int) -> np.ndarray:
    """Tags of the characters from ``start`` on; of spans that overlap the first counts."""
    out = np.zeros(stop - start, np.int64)
    done = -1
    for kind, a, b in spans:
        if a < done or a < start or b > stop:
            continue
        k = KINDS.index(kind)
        out[a - start : b - start] = 2 + 2 * k
        out[a - start] = 1 + 2 * k
        done = b
    return out


def windows_of(text: str) -> list[int]:
    """Starts of overlapping windows that hold every anchor and ``REACH`` on both sides."""
    starts: list[int] = []
    covered = -1
    for m in _ANCHOR.finditer(text):
        at = m.start()
        if at + REACH < covered:
            continue
        start = max(0, at - REACH) if covered < at else starts[-1] + STRIDE
        while start + WINDOW <= at + REACH:
            starts.append(start)
            start += STRIDE
        starts.append(start)
        covered = start + WINDOW
    return starts


def _padded(code: np.ndarray) -> np.ndarray:
    out = np.full(WINDOW, _PAD, np.int64)
    out[: len(code)] = code[:WINDOW]
    return out


def fit(docs: DataFrame, per_kind: int = PER_KIND, steps: int = STEPS) -> Tagger:
    """Train on at most ``per_kind`` windows of each kind and as many without a span.

    Their labels are the spans of the patterns. Documents that ``held_out`` names are not learned
    from. Windows are taken by a hash of their text, so reruns agree.
    """

    def sample(batches):
        best: dict[str, list] = {k: [] for k in (*KINDS, "none")}
        for batch in batches:
            for value in batch.column("text"):
                text = value.as_py()
                starts = windows_of(text)
                if not starts:
                    continue
                spans = base_spans(text)
                for start in starts:
                    stop = min(start + WINDOW, len(text))
                    tags = tags_of(spans, start, stop)
                    part = text[start:stop]
                    cut = any(a < start < b or a < stop < b for _, a, b in spans)
                    if cut:
                        continue
                    h = -xxhash.xxh3_64_intdigest(part.encode("utf-8", "replace"))
                    for kind in {KINDS[(t - 1) // 2] for t in set(tags.tolist()) if t} or {"none"}:
                        item = (h, part, tags.astype(np.uint8).tobytes())
                        if len(best[kind]) < per_kind:
                            heapq.heappush(best[kind], item)
                        elif item > best[kind][0]:
                            heapq.heapreplace(best[kind], item)
        rows = [(k, *item) for k, items in best.items() for item in items]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([float(r[1]) for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.string()),
                pa.array([r[3] for r in rows], pa.binary()),
            ],
            ["kind", "h", "part", "tags"],
        )

    known = docs.where(F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("text")
    found = known.mapInArrow(sample, "kind string, h double, part string, tags binary")
    windows, tags = [], []
    for kind in (*KINDS, "none"):
        top = found.where(F.col("kind") == kind).dropDuplicates(["part"])
        for r in top.orderBy(F.desc("h"), "part").limit(per_kind).collect():
            windows.append(_padded(symbols(r.part)))
            row = np.zeros(WINDOW, np.int64)
            row[: len(r.tags)] = np.frombuffer(bytes(r.tags), np.uint8)
            tags.append(row)
    tagger = new_tagger()
    if windows:
        tagger.train(np.stack(windows), np.stack(tags), steps)
    return tagger


def tagged_spans(texts: list[str | None], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """Spans that the tagger sees in each whole text."""
    jobs, rows = [], []
    texts = [t or "" for t in texts]
    for i, text in enumerate(texts):
        for start in windows_of(text):
            jobs.append((i, start))
            rows.append(_padded(symbols(text[start : start + WINDOW])))
    tags = [tagger.decode(np.stack(rows[j : j + TOGETHER])) for j in range(0, len(rows), TOGETHER)]
    decoded = np.concatenate(tags) if tags else np.zeros((0, WINDOW), np.int8)
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    depth = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
    j = 0
    while j < len(jobs):
        i, first = jobs[j]
        # Windows that overlap one another form a stretch of the text.
        stop, k = first + WINDOW, j + 1
        while k < len(jobs) and jobs[k][0] == i and jobs[k][1] < stop:
            stop = jobs[k][1] + WINDOW
            k += 1
        tag, deep = np.zeros(stop - first, np.int8), np.full(stop - first, -1)
        for w in range(j, k):
            at = slice(jobs[w][1] - first, jobs[w][1] - first + WINDOW)
            better = depth > deep[at]
            tag[at] = np.where(better, decoded[w], tag[at])
            deep[at] = np.where(better, depth, deep[at])
        open_, kind = -1, 0
        for p in range(len(tag) + 1):
            t = int(tag[p]) if p < len(tag) else 0
            if open_ >= 0 and t != kind + 1:
                a, b = first + open_, min(first + p, len(texts[i]))
                if _ANCHOR.search(texts[i], a, b):
                    out[i].append((KINDS[(kind - 1) // 2], a, b))
                open_ = -1
            if t % 2 == 1:
                open_, kind = p, t
        j = k
    return out


def _kept(kind: str, text: str) -> bool:
    """Whether an added span has the numbers or the sign that its kind needs."""
    digits = len(_DIGITS.findall(text))
    if kind == "email":
        return "@" in text and "." in text.partition("@")[2]
    if kind == "ip":
        return 4 <= digits <= 12 and text.count(".") == 3
    if kind == "card":
        return 12 <= digits <= 19 and luhn("".join(_DIGITS.findall(text)))
    return 9 <= digits <= 15


def all_spans(texts: list[str | None], tagger: Tagger) -> tuple[list[list], list[list]]:
    """Spans of the patterns, and these with what the tagger adds where no pattern matched."""
    base = [base_spans(t) for t in texts]
    merged = []
    for text, own, more in zip(texts, base, tagged_spans(texts, tagger), strict=True):
        added = [
            s
            for s in more
            if _kept(s[0], text[s[1] : s[2]]) and not any(a < s[2] and s[1] < b for _, a, b in own)
        ]
        merged.append(sorted(own + added, key=lambda s: (s[1], KINDS.index(s[0]))))
    return base, merged


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The counts and the digest are of the patterns' spans; ``spans`` has all, ``n_added`` those
    that the tagger added. Starts and ends are code points, the end exclusive. Null texts count
    as empty. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger or fit(docs))

    def start() -> Callable:
        learned = shared.value

        def work(batch) -> dict:
            base, merged = all_spans(batch.column("text").to_pylist(), learned)
            out = {f"n_{k}": [sum(s[0] == k for s in own) for own in base] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(joined(s).encode()).hexdigest() for s in base]
            out["spans"] = [joined(s) for s in merged]
            out["n_added"] = [len(m) - len(b) for m, b in zip(merged, base, strict=True)]
            return out

        return work

    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return map_rows(docs.select("doc_id", "text"), start, schema, ("doc_id",))
