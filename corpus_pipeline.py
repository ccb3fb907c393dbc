"""From raw documents to the tokens of a mix, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linfit.llm import bpe, exact, langid, mixing, near
from linfit.llm.common import stored
from linfit.llm.queries import VOCABULARY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is not recognised.

    Null texts and texts without letters go; repeated rows stay or go alike; an empty table stays
    empty. Columns may have any names, here and in the stages below; texts of any length are read
    whole.
    """
    return langid.drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each text, the one with the smallest doc_id.

    Null counts as an empty text, a null doc_id comes after all others, and of rows alike in
    doc_id and text one stays.
    """
    return exact.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near copies, the one with the smallest doc_id.

    Texts without words and rows without a doc_id stay, and so does another text under the doc_id
    of a copy; rows alike in doc_id and text stay or go alike.
    """
    return near.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, by words per source.

    Null texts hold no words, a null source is a source of its own, and chance depends on hashes of
    doc_id, source and size alone, so reruns agree.
    """
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source and tokens, with digests of the tokens and of the bytes they decode to.

    Null texts have no tokens; repeated rows give a row each.
    """
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return bpe.token_documents(docs, path, pattern)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokenize", tokenize),
]

#: Centroids, sketches and the walk of the cube have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
