import public_tokenizers
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """A small table with nulls, empty and long texts, repeated rows and columns that clash."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    last = rows[-1]
    rows += [
        (900001, None, "en", "src1"),
        (900002, "", None, None),
        (900003, " \t\n ", "fr", "src2"),
        (900004, "word " * 30_000, "en", "src0"),
        (None, rows[0][1], rows[0][2], "src1"),
        (900005, rows[1][1], None, "src1"),
        (900006, "12345 67890 !!", "en", "src1"),
        last,
        last,
    ]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema)
    extra = ("kept", "score", "id", "size", "h", "n", "a", "key", "rows", "copies", "digest", "run")
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(c) for c in extra}).cache()


@pytest.fixture(scope="session")
def vocabulary():
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
