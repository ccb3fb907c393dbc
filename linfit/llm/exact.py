"""Exact deduplication by tree-merge of sorted digest runs.

Every input partition yields a run: its digests in order, each once, with the smallest
identifier and the number of rows. Runs meet in binomial rounds: round r brings the runs whose
numbers agree but for the last r digits (base ``fan_in``) to one task per shard of the digest
space, which merges them in one streaming pass and keeps the smallest identifier, after checking
that lengths agree under each digest. A shard is a prefix of the digest, so no task ever meets
all digests; in the end each digest stands in exactly one run of its shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfit.llm.common import BLANK, stored, unused

FAN_IN = 16
#: Digests that a shard is to hold; their number sets the number of shards.
PER_SHARD = 200_000
RUN = "shard int, run long, digest binary, n_chars long, doc_id long, at long, docs long"


def normalised(text: Column) -> Column:
    """The text with every stretch of white space as one space; null counts as empty."""
    # A lone space stays as it is, so only the others are matched.
    return F.regexp_replace(
        F.coalesce(text, F.lit("")), rf"[\x09-\x0D]{BLANK}*|\x20{BLANK}+", " "
    )


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, run, digest, doc_id nulls last, at): one row for each digest."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch.cast(held.schema)]).combine_chunks().to_batches()[0]
        n = batch.num_rows
        shard, run = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "run"))
        raw = b"".join(batch.column("digest").to_pylist())
        words = np.frombuffer(raw, np.uint64).reshape(n, 4)
        new = np.ones(n, bool)
        new[1:] = (words[1:] != words[:-1]).any(axis=1) | (run[1:] != run[:-1]) | (shard[1:] != shard[:-1])
        first = np.flatnonzero(new)
        length = batch.column("n_chars").to_numpy(zero_copy_only=False)
        if (~new[1:] & (length[1:] != length[:-1])).any():
            raise ValueError("two texts of different length have one digest")
        total = np.add.reduceat(batch.column("docs").to_numpy(zero_copy_only=False), first)
        merged = batch.take(pa.array(first))
        merged = merged.set_column(
            merged.schema.get_field_index("docs"), "docs", pa.array(total, pa.int64())
        )
        held = merged.slice(merged.num_rows - 1)
        if merged.num_rows > 1:
            yield merged.slice(0, merged.num_rows - 1)
    if held is not None:
        yield held


def merge_round(runs: DataFrame, partitions: int) -> DataFrame:
    """Bring the runs of one number together and merge them, shard by shard."""
    dealt = runs.repartition(partitions, "shard", "run").sortWithinPartitions(
        "shard", "run", "digest", F.col("doc_id").asc_nulls_last(), "at"
    )
    return dealt.mapInArrow(_merge, RUN)


def digest_classes(docs: DataFrame, fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """All rows (run, at, doc_id, digest, n_chars, shard) and one merged row for each digest.

    ``at`` numbers the rows as they were first read. Both tables lie in the shared folder.
    """
    value = normalised(F.col("text")).alias("value")
    rows = docs.select(
        F.spark_partition_id().cast("long").alias("run"),
        F.monotonically_increasing_id().alias("at"),
        F.col("doc_id").cast("long").alias("doc_id"),
        value,
    ).select(
        "run",
        "at",
        "doc_id",
        F.unhex(F.sha2(F.col("value").cast("binary"), 256)).alias("digest"),
        F.length("value").cast("long").alias("n_chars"),
    )
    rows = stored(rows, "digest-rows")
    n, last = rows.agg(F.count("*"), F.max("run")).first()
    shards = max(1, -(-n // PER_SHARD))
    code = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("shard", (code % shards).cast("int"))
    partitions = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    runs = rows.select("shard", "run", "digest", "n_chars", "doc_id", "at", F.lit(1).cast("long").alias("docs"))
    # Round 0 makes the runs; no row has left its input partition's number.
    runs = merge_round(runs, partitions)
    left = (last or 0) + 1
    while left > 1:
        runs = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("long"))
        runs = merge_round(runs, partitions)
        left = -(-left // fan_in)
    return rows, stored(runs, "digest-merged")


def exact_classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical with each stretch of white space as one space; null
    counts as empty. The smallest doc_id stays; a null one only if all are null, and of rows
    with the same smallest doc_id the first one read. An empty table gives an empty table.
    """
    rows, merged = digest_classes(docs)
    best = merged.select(
        "digest",
        F.col("doc_id").alias("keep_id"),
        F.col("at").alias("keep_at"),
        F.col("docs").alias("group_size"),
    )
    # A digest stands once in each run, so even one shared by a third of all rows joins as few
    # rows here, and then with the rows of its own run only.
    local = rows.select("run", "digest").distinct().join(best, "digest")
    found = rows.select("run", "digest", "doc_id", "at").join(local, ["run", "digest"])
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("at") == F.col("keep_at")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names.

    Joined by digest and doc_id to the narrow table of what stays, so texts are shuffled once
    and never sorted. Rows alike in both are copies of one row, of which the one with the least
    text stays; a null doc_id is alike another null. Null texts count as empty; an empty table
    gives an empty table.
    """
    rows, merged = digest_classes(docs)
    times = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("times"))
    best = merged.select("digest", "doc_id").join(
        times.withColumnsRenamed({"digest": "d", "doc_id": "i"}), F.col("digest").eqNullSafe(F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i"))
    )
    best = stored(best.select("digest", "doc_id", "times"), "kept-digests")
    own, keep = unused("digest", docs.columns), unused("keep_digest", docs.columns)
    again, times = unused("keep_doc", docs.columns), unused("times", docs.columns)
    best = best.withColumnsRenamed({"digest": keep, "doc_id": again, "times": times}).hint("shuffle_hash")
    tagged = docs.withColumn(own, digest(F.col("text")))
    same = (F.col(own) == F.col(keep)) & F.col("doc_id").cast("long").eqNullSafe(F.col(again))
    joined = tagged.join(best, same)
    single = joined.where(F.col(times) == 1).select(*docs.columns)
    if best.where(F.col(times) > 1).isEmpty():
        return single
    # Combined before the shuffle, so many copies of one row are no hot group.
    row = unused("row", docs.columns)
    some = joined.where(F.col(times) > 1).groupBy(own, again)
    some = some.agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias(row))
    return single.union(some.select(*(F.col(row)[c].alias(c) for c in docs.columns)))
