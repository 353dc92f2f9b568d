"""What keeps the work of large inputs in proportion: steps that are run once, and small batches."""

import gc

import pyarrow as pa
from pyspark.sql import functions as F

from corpusmill.functions import language as L
from corpusmill.functions import text as T
from corpusmill.operators import corpus as O
from corpusmill.plans import commands
from corpusmill.sources import html

TEXT = "Ang aso ay nasa bahay na ngayon. Ang aso ay nasa bahay na ngayon. Oo. “Halika na rito ngayon po.” Ang pusa at ibon ay nasa bahay {}. See all <b> of the men here."


def documents(spark):
    return spark.createDataFrame([(i, "s", TEXT.format(i % 3)) for i in range(7)] + [(None, "s", TEXT.format(9))], "doc_id bigint, source string, text string")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_policy_totals_need_no_row_for_each_profile_and_sentence(spark):
    totals = O.policy_totals(O.sentence_rows(documents(spark)), {"a": (3, 100, False, False, 0.0), "b": (1, 9, True, True, 0.5)})
    assert not any(x in plan(totals) for x in ("Window", "Join", "RepartitionByExpression"))
    assert O.policy_totals(O.sentence_rows(documents(spark).where("doc_id > 99")), {"a": (3, 100, False, False, 0.0)}).count() == 0
    rows = spark.createDataFrame([(1, 0, "Ang aso ay nasa bahay.", None)], "doc_id bigint, sentence_index int, sentence_text string, is_quote boolean")
    assert O.policy_totals(rows, {"a": (3, 100, False, False, 0.0)}).first().accepted == 1


def test_sentences_are_judged_once_for_their_outcomes(spark):
    judged = O.judged_sentences(O.sentence_rows(documents(spark))).select("doc_id", "sentence_index", "reason", "content_hash")
    final = executed(O.deduplicated(judged)).split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("Scan ExistingRDD") == 1


def test_outcome_counts_agree_with_outcomes(spark):
    judged = O.judged_sentences(O.sentence_rows(documents(spark)), languages=["FILIPINO"])
    want = {r.outcome: r["count"] for r in O.deduplicated(judged).groupBy("outcome").count().collect()}
    counts = O.outcome_counts(judged)
    assert {r.outcome: r.n for r in counts.collect()} == want and {"accepted", "duplicate_batch", "duplicate_db", "too_short", "quote_excluded", "markup"} <= set(want)
    assert not any(x in plan(counts) for x in ("Window", "Join"))
    assert commands.rejection_legs(counts).first() == commands.rejections(O.deduplicated(judged)).first()
    assert commands.rejections(O.deduplicated(judged.where("false"))).first().total_candidates == 0


def test_cheaper_patterns_give_the_same(spark):
    odd = ["a  b", "a b", " a  \t b ", "a\n\n b", "a \n b\u0085c", " ", "", None, "x­ ", "a\tb", "A　 　B", "x  "]
    rows = spark.createDataFrame([(t,) for t in odd], "c string")
    c = F.col("c")
    bare = F.replace(F.coalesce(c, F.lit("")), F.lit("­"), F.lit(""))
    normal = F.trim(F.regexp_replace(F.regexp_replace(bare, r"[\p{Zs}&&[^ ]]", " "), r"[ \t\r\f\x0B]{2,}|[\t\r\f\x0B]", " "), F.lit(" \t\n\r\f\x0b"))
    digest = F.sha2(F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " ")), 256)
    n = T.normalize_text(c)
    got = rows.select((n == normal).alias("n"), T.content_hash(c).eqNullSafe(digest).alias("h"), (T.normal_tokens(n) == T.token_count(n)).alias("t")).collect()
    assert all(r.n and r.h and r.t for r in got)
    words = spark.createDataFrame([("Ang mga_tao, ng the-of; hindi ñang anǵ ANG",), (None,), ("",)], "c string").select(L.scores(F.col("c")).alias("x")).collect()
    assert [tuple(r.x) for r in words] == [(4, 2), (0, 0), (0, 0)]


def test_pages_are_held_in_small_slices_and_trees_freed():
    gc.collect()
    gc.disable()
    try:
        got = html.extract("<html><body><p>" + "<b>x</b>" * 50 + "<a href='/y'>z</a></p></body></html>", "http://a.com/")
        left = [x for x in gc.get_objects() if isinstance(x, html.Node)]
    finally:
        gc.enable()
    assert not left and got["links"][0]["href"] == "http://a.com/y"
    texts = ["a" * 300_000, "b" * 300_000, None, "c" * 900_000, "", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["html"])
    cut = [x.column("html").to_pylist() for x in html.slices(iter([batch]))]
    assert [len(x) for x in cut] == [1, 2, 1, 2]
    assert [t for x in cut for t in x] == texts
