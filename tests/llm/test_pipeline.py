"""Queries over the small tables, the SQL beside them, and the pipeline by its stages."""

import duckdb

import corpus_pipeline
from linfit.llm import exact, langid, mixing, near
from linfit.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_queries_of_all_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_exact_dedup_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    cursor = con.execute(ORACLES["op2_exact_dedup"])
    names = [c[0] for c in cursor.description]
    df = QUERIES["op2_exact_dedup"](spark, SMALL)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(cursor.fetchall())


def test_pipeline_equals_its_operators_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = set(docs.columns)
    found = corpus_pipeline.run(spark, SMALL)
    known = langid.identify(docs).where("not rejected").select("doc_id")
    docs = docs.join(known, "doc_id", "left_semi").select(*docs.columns)
    first = exact.exact_classes(docs).where("kept").select("doc_id")
    docs = docs.join(first, "doc_id", "left_semi").select(*docs.columns)
    one = near.near_classes(docs).where("kept").select("doc_id")
    docs = docs.join(one, "doc_id", "left_semi").select(*docs.columns)
    assert set(docs.columns) == names
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(docs).collect() if r.size}
    times: dict[int, int] = {}
    for r in found.select("doc_id", "n_tokens").collect():
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert times == {i: t for i, t in taken.items() if t}


def test_stages_keep_the_columns(spark, documents):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, documents, SMALL)
        assert out.columns == documents.columns, name
        assert out.count() <= (3 if name == "mix_sources" else 1) * documents.count()
