"""Perplexity under an interpolated modified Kneser-Ney n-gram model.

The n-grams are runs of ``ORDER`` bytes. The model is trained on all trusted text: counts,
continuation counts, discounts and interpolation weights are joins and sums over sharded tables.
Texts are then scored against one shard of the model after another, each of a bounded number of
rows; every position of a text is scored by one shard, so the sums add up. A language's threshold
is a quantile of the perplexities of trusted texts that were kept from training.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfit.llm.common import held_out, map_rows, stored

ORDER = 5
#: Bytes that stand before and after a text; UTF-8 has neither.
BEGIN, END = 0xFE, 0xFF
#: Quantile of trusted log perplexities, in steps of ``STEP``, up to which texts are kept.
HIGH = 0.98
STEP = 0.001
#: What a text may exceed it by, over the root of its length: short texts spread wider.
SPREAD = 4.0
#: Rows of a shard: what is broadcast at one time.
SHARD_ROWS = 2_000_000
#: n-grams that a task counts before it passes them on, and bytes it handles at one time.
HELD = 1_000_000
CHUNK = 1 << 20


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams that end at a byte or at the end of a text, and the texts' bounds.

    The last byte is the lowest one of a code, so lower orders are its low bytes.
    """
    data = [t.encode("utf-8", "replace") for t in texts]
    before, end = bytes([BEGIN]) * (ORDER - 1), bytes([END])
    b = np.frombuffer(b"".join(before + d + end for d in data), np.uint8).astype(np.int64)
    code = b.copy()
    for k in range(1, ORDER):
        code[k:] |= b[:-k] << (8 * k)
    sizes = np.array([len(d) + ORDER for d in data])
    starts = np.cumsum(sizes) - sizes
    keep = np.ones(len(b), bool)
    for k in range(ORDER - 1):
        keep[starts + k] = False
    bounds = np.concatenate([[0], np.cumsum(sizes - ORDER + 1)])
    return code[keep], bounds


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of about ``CHUNK`` characters."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def count_grams(texts: DataFrame) -> DataFrame:
    """(code, n): how often each n-gram stands in the texts; counted in tasks first."""

    def count(batches):
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.column("text").slice(start, 256).to_pylist()
                for i, j in _pieces(rows):
                    new, times = np.unique(gram_codes(rows[i:j])[0], return_counts=True)
                    both = np.concatenate([codes, new])
                    codes, where = np.unique(both, return_inverse=True)
                    n = np.bincount(where, np.concatenate([n, times]), len(codes)).astype(np.int64)
                    if len(codes) > HELD:
                        yield packed()
                        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield packed()

    counts = texts.select("text").mapInArrow(count, "code long, n long")
    return counts.groupBy("code").agg(F.sum("n").alias("n"))


def _low(code: Column | str, k: int) -> Column:
    return (F.col(code) if isinstance(code, str) else code).bitwiseAND(F.lit((1 << 8 * k) - 1))


def train(texts: DataFrame) -> DataFrame:
    """The model: (k, kind, code, value), stored.

    Kind ``p``: log probability of the last byte of a k-gram after the others. Kind ``w``: log of
    the weight that order k - 1 has after a context of k - 1 bytes. An empty corpus gives no rows.
    """
    grams = {ORDER: stored(count_grams(texts), "grams")}
    for k in range(ORDER - 1, 0, -1):
        # How many different bytes stand before the k-gram.
        below = grams[k + 1].groupBy(_low("code", k).alias("code")).agg(F.count("*").alias("n"))
        grams[k] = stored(below, f"grams-{k}")
    many = [g.groupBy("n").agg(F.count("*").alias("grams")).where("n <= 4").withColumn("k", F.lit(k)) for k, g in grams.items()]
    seen = many[0]
    for m in many[1:]:
        seen = seen.union(m)
    times = {(r.k, r.n): r.grams for r in seen.collect()}  # four numbers an order

    parts = []
    below = None
    for k in range(1, ORDER + 1):
        n1, n2, n3, n4 = (times.get((k, i), 0) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [
            min(max(1 - 2 * y * n2 / n1, 0.05), 1.0) if n1 else 0.5,
            min(max(2 - 3 * y * n3 / n2, 0.05), 2.0) if n2 else 0.75,
            min(max(3 - 4 * y * n4 / n3, 0.05), 3.0) if n3 else 1.0,
        ]
        n = F.col("n")
        discount = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        g = grams[k].withColumn("context", F.shiftright("code", 8)).withColumn("cut", discount)
        contexts = g.groupBy("context").agg(
            F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight")
        )
        contexts = stored(contexts, f"contexts-{k}")
        g = g.join(contexts, "context")
        own = (n - F.col("cut")) / F.col("total")
        if below is None:
            p = g.select("code", (own + F.col("weight") / 256).alias("p"))
        else:
            lower = below.select(F.col("code").alias("low"), F.col("p").alias("q"))
            g = g.withColumn("low", _low("code", k - 1)).join(lower, "low")
            p = g.select("code", (own + F.col("weight") * F.col("q")).alias("p"))
        below = stored(p, f"chances-{k}")
        parts.append(below.select(F.lit(k).alias("k"), F.lit("p").alias("kind"), "code", F.log("p").alias("value")))
        parts.append(contexts.select(F.lit(k).alias("k"), F.lit("w").alias("kind"), F.col("context").alias("code"), F.log("weight").alias("value")))
    model = parts[0]
    for more in parts[1:]:
        model = model.union(more)
    return stored(model, "language-model")


class Table:
    """Numbers by 64-bit key, looked up many at a time; open addressing in flat arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        left, self.tries = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], self.tries)
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            won = np.zeros(len(left), bool)
            won[first] = True
            won &= free
            self.keys[slot[won]] = keys[left[won]]
            self.values[slot[won]] = values[left[won]]
            left = left[~won]
            self.tries += 1

    def _slot(self, keys: np.ndarray, step: int) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        return (slot + step * (step + 1) // 2) & ((1 << self.bits) - 1)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys are there."""
        out, found = np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        left = np.arange(len(keys))
        for step in range(self.tries):
            now = keys[left] if step else keys
            slot = self._slot(now, step)
            there = self.keys[slot]
            hit = there == now
            at = left[hit]
            out[at] = self.values[slot[hit]]
            found[at] = True
            left = left[~hit & (there >= 0)]
            if not len(left):
                break
        return out, found


class Shard:
    """The part of the model for contexts whose last two bytes hash to one number."""

    def __init__(self, rows: pa.Table, number: int, shards: int):
        self.number, self.shards = number, shards
        kinds = np.array(rows.column("kind").to_pylist())
        k = rows.column("k").to_numpy()
        code, value = rows.column("code").to_numpy(), rows.column("value").to_numpy()
        self.tables = {
            (kind, n): Table(code[at], value[at])
            for kind in ("p", "w")
            for n in range(1, ORDER + 1)
            for at in [np.flatnonzero((k == n) & (kinds == kind))]
        }

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each position that belongs to this shard, 0 for the others."""
        total = np.zeros(len(codes), np.float32)
        if self.shards > 1:
            left = np.flatnonzero(shard_of((codes >> 8) & 0xFFFF, self.shards) == self.number)
        else:
            left = np.arange(len(codes))
        for k in range(ORDER, 0, -1):
            now = codes[left] & ((1 << 8 * k) - 1)
            value, found = self.tables["p", k].get(now)
            total[left[found]] += value[found]
            left = left[~found]
            if not len(left):
                return total
            weight, _ = self.tables["w", k].get(now[~found] >> 8)
            total[left] += weight  # 0 after a context that was never met
        total[left] += np.float32(-np.log(256))
        return total


def shard_of(context: np.ndarray, shards: int) -> np.ndarray:
    return (context * 40503 & 0xFFFFF) % shards


def score(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, lang, symbols, log_prob): one row per document, texts read once for each shard.

    ``symbols`` counts the bytes and the end; null texts count as empty.
    """
    spark = docs.sparkSession
    shards = max(1, -(-model.count() // SHARD_ROWS))
    context = F.when(F.col("kind") == "p", F.shiftright("code", 8)).otherwise(F.col("code"))
    number = F.pmod((_low(context, 2) * 40503).bitwiseAND(F.lit(0xFFFFF)), F.lit(shards))
    model = model.withColumn("number", F.when(F.col("k") >= 3, number))
    keyed = docs.select("doc_id", "lang", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    parts = None
    for s in range(shards):
        rows = model.where(F.col("number").isNull() | (F.col("number") == s)).drop("number").toArrow()
        shared = spark.sparkContext.broadcast(rows.combine_chunks())  # about SHARD_ROWS rows

        def start(shared=shared, s=s) -> Callable:
            shard = Shard(shared.value, s, shards)

            def work(batch) -> dict:
                texts = batch.column("text").to_pylist()
                n, total = [], []
                for i, j in _pieces(texts):
                    codes, bounds = gram_codes(texts[i:j])
                    sums = np.add.reduceat(shard.scores(codes).astype(float), bounds[:-1])
                    n += np.diff(bounds).tolist()
                    total += sums.tolist()
                return {"symbols": n, "log_prob": total}

            return work

        part = map_rows(keyed, start, "symbols long, log_prob double", ("doc_id", "lang", "h"))
        part = stored(part, f"scored-{s}")
        parts = part if parts is None else parts.union(part)
    # Equal rows have one key: each shard gave each of them the same sum.
    rows = parts.groupBy("doc_id", "lang", "h").agg(
        (F.sum("log_prob") / (F.count("*") / shards)).alias("log_prob"),
        F.max("symbols").alias("symbols"),
        (F.count("*") / shards).cast("long").alias("copies"),
    )
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("doc_id", "lang", "symbols", "log_prob")


def thresholds(trusted: DataFrame) -> tuple[DataFrame, float | None]:
    """(language, high) from (language, log_ppl) of trusted texts, and the same over all of them.

    Exact quantiles of the values rounded to ``STEP``: a language has a bounded number of those.
    """
    bins = trusted.groupBy("language", F.round(F.col("log_ppl") / STEP).cast("long").alias("bin"))
    bins = stored(bins.agg(F.count("*").alias("n")), "bins")
    up = Window.partitionBy("language").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("n").over(up) / F.sum("n").over(Window.partitionBy("language"))
    ranked = bins.withColumn("share", share).where(F.col("share") >= HIGH)
    limits = ranked.groupBy("language").agg((F.min("bin") * STEP).alias("high"))
    rows = sorted(bins.groupBy("bin").agg(F.sum("n").alias("n")).collect())  # a row a bin
    if not rows:
        return limits, None
    upto = np.cumsum([r.n for r in rows])
    return limits, rows[int(np.argmax(upto / upto[-1] >= HIGH))].bin * STEP


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, symbols, perplexity, high, kept.

    Trusted are documents with a quality label of 1 (of several labels the best counts); one in
    four is kept from training and sets its language's threshold. Texts below it are kept;
    where a language has no such text, the threshold is that over the texts of all languages.
    Null and empty texts have no perplexity and are not kept. Null languages are a language.
    Without trusted texts kept from training nothing is known and every non-empty text is kept.
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    good = good.agg(F.max("quality").alias("quality")).where("quality > 0").select("doc_id")
    # Labels grow with the documents: one way to join them, whatever their size.
    good = good.hint("merge")
    training = docs.where(F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    model = train(training.select("doc_id", "text").join(good, "doc_id"))
    rows = stored(score(docs, model), "perplexities")
    per_symbol = F.when(F.col("symbols") > 1, -F.col("log_prob") / F.col("symbols"))
    rows = rows.withColumn("log_ppl", per_symbol).withColumn(
        "language", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("null"))
    )
    kept_back = rows.where(held_out(F.col("doc_id")) & F.col("log_ppl").isNotNull()).join(good, "doc_id")
    limits, overall = thresholds(kept_back.select("language", "log_ppl"))
    found = rows.join(limits, "language", "left")
    found = found.withColumn("high", F.coalesce("high", F.lit(overall).cast("double")))
    slack = SPREAD / F.sqrt("symbols")
    below = F.col("log_ppl") <= F.coalesce("high", F.col("log_ppl")) + slack
    return found.select(
        "doc_id",
        "lang",
        "symbols",
        F.exp("log_ppl").alias("perplexity"),
        F.exp("high").alias("high"),
        F.coalesce(below, F.lit(False)).alias("kept"),
    )
