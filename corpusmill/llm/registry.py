"""Queries over the test tables, one for each operator of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from . import decontam, jaccard, licenses, mixing, quality, repeats, surrogates, token_counts, token_file, topk
from .common import read


#: A deployment passes its own secret; the queries need the same one in every run.
SURROGATE_KEY = b"corpusmill test key"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymize(read(spark, sf_dir, "documents"), key=SURROGATE_KEY)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=1024)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"), k=4, threshold=Fraction(85, 100))


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_file(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"), length=200)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_topk_search, op3_mixing, op4_surrogates, op5_decontamination, op6_token_counts, op7_jaccard_join, op8_token_file, op9_quality, op10_repeated_strings)}


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
), c AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2
), r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM w
), n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), sym AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS u FROM n UNION SELECT r.v, sym.b FROM r JOIN sym ON r.u = sym.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.u) AS component_id FROM n JOIN r ON r.v = n.doc_id GROUP BY 1, 2
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_topk_search": OP2_SQL, "op7_jaccard_join": OP7_SQL}
