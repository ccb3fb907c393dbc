"""One query per operator over its whole table, and SQL with the same rows where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.llm import ann, bpe, decontam, exact, kneser, langid, lines, mixing, near, negatives, pii, toxicity, variants
from linfit.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix at the target weights takes from each document."""
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for each text, and the size of its group."""
    return exact.exact_classes(read(spark, sf_dir, "documents", "doc_id", "text"))


ORACLES["op2_exact_dedup"] = """
WITH normal AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       text_sha256
FROM normal
WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies that each document belongs to."""
    return near.near_classes(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document."""
    return langid.identify(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's tokens and of their bytes."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query
def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 100 == 0)


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of each document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document."""
    return pii.find(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of each document, and whether it is kept."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return kneser.classify(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each document that are near copies of earlier lines."""
    return lines.dedup_report(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that windows of benchmark items cover."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.report(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLES["op13_decontamination"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), spot AS (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
    FROM item WHERE len(w) > 0
), pattern AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM spot
), size AS (
    SELECT DISTINCT n FROM pattern
), place AS (
    SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n
), met AS (
    SELECT r, i, place.n, item_id
    FROM place JOIN pattern ON place.n = pattern.n AND array_to_string(w[i:i + place.n - 1], ' ') = p
), hit AS (
    SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM met) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id,
       len(w)::BIGINT AS n_words,
       coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commoner form that each word of the documents is a slip of."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return variants.spelling_forms(variants.word_counts(docs))


ORACLES["op12_spelling_variants"] = r"""
WITH RECURSIVE remainder AS (
    SELECT list(c ORDER BY b) AS t
    FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
                                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
          FROM (SELECT unnest(range(256)) AS b))
), run AS (
    SELECT doc_id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[A-Za-z\x{C0}-\x{FF}]+')) AS run
          FROM documents)
    WHERE length(run) >= 7
    GROUP BY doc_id, run
), code AS (
    SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM run
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i:
                   16 * instr('123456789ABCDEF', x[i]) + instr('123456789ABCDEF', x[i + 1]))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM code, remainder
), slip AS (
    SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                   ELSE run END AS word
    FROM hashed
), word AS (
    SELECT word, sum(n)::BIGINT AS n FROM slip WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), hole AS (
    SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM word)
), pair AS (
    SELECT a.word, b.word AS near FROM hole a JOIN hole b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT hole.word, b.word FROM hole JOIN word b ON rest = b.word
    UNION SELECT b.word, hole.word FROM hole JOIN word b ON rest = b.word
), ranked AS (
    SELECT pair.word, near, w.n AS near_n, count(*) OVER (PARTITION BY pair.word) AS n_near,
           row_number() OVER (PARTITION BY pair.word ORDER BY w.n DESC, near) AS r
    FROM pair JOIN word w ON near = w.word
), formed AS (
    SELECT word.word, word.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN near_n >= 10 * word.n THEN near END AS form,
           CASE WHEN near_n >= 10 * word.n THEN near_n END AS form_n
    FROM word LEFT JOIN ranked ON word.word = ranked.word AND r = 1
), walk AS (
    SELECT word, word AS top, form AS next FROM formed
    UNION ALL
    SELECT walk.word, walk.next, formed.form FROM walk JOIN formed ON walk.next = formed.word
)
SELECT formed.word, form, top AS root, n, n_near, form_n
FROM formed JOIN walk ON formed.word = walk.word AND walk.next IS NULL
"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth vector."""
    vectors = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLES["op11_hard_negatives"] = """
WITH row AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           list_inner_product(a.v, b.v)::BIGINT AS score
    FROM row a JOIN row b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 50 = 0
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS r
    FROM positive JOIN scored USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE r <= 3
"""
