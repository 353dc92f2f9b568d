"""Configuration, commands, sinks, SQL functions and streams."""

import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import language as L
from corpusmill.functions import register
from corpusmill.functions import text as T
from corpusmill.functions import url as U
from corpusmill.operators import corpus as O
from corpusmill.operators import discovery as D
from corpusmill.operators import store
from corpusmill.plans import commands, config
from corpusmill.sources import sinks
from corpusmill.streaming import crawl

GOOD = {"id": "a", "name": "A", "domain": "www.a.com", "url_prefix": "news", "article_path_patterns": [r"/news/\d+.*"], "sibling_prefixes": ["/news/other"]}


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "change, word",
    [
        ({"id": " "}, "id"), ({"domain": "http://a.com"}, "bare host"), ({"crawl_delay_seconds": -1}, "crawl_delay"), ({"max_concurrent": 0}, "max_concurrent"), ({"article_path_patterns": ["("]}, "regular"),
        ({"budgets": {"max_depth": 0}}, "max_depth"), ({"archive": {"granularity": "week"}}, "granularity"), ({"archive": {"start_date": "2026-02-01", "end_date": "2026-01-01"}}, "after"),
        ({"link_discovery": {"article_priority": 10001}}, "10000"), ({"policy_profile": "odd"}, "one of"), ({"min_tokens": 9, "max_tokens": 3}, "more than"), ({"min_confidence": 1.5}, "0 to 1"),
        ({"common_crawl": {"enabled": True}}, "needs a pattern"), ({"common_crawl": {"url_patterns": ["https://b.com/*"]}}, "hosts"), ({"shared_domain": True, "common_crawl": {"url_patterns": ["https://a.com/*"]}}, "shared"),
    ],
)
def test_source_rules(change, word):
    assert not config.source_violations(GOOD)
    assert any(word in v for v in config.source_violations(GOOD | change))
    with pytest.raises(config.ConfigError):
        config.checked([GOOD | change])


def test_run_rules_and_policies(tmp_path):
    for tree in ({"crawl": {"cutoff_date": "soon"}}, {"link_discovery": {"max_depth": 11}}, {"common_crawl": {"collection": "CC-MAIN-2026-54"}}, {"quality": {"noise_patterns": ["["]}}, {"sentence": {"min_tokens": 5, "max_tokens": 4}}):
        assert len(config.run_violations(tree)) == 1
    assert not config.run_violations({"common_crawl": {"collection": "CC-MAIN-2026-30"}, "link_discovery": {"max_depth": 0}})
    run = {"sentence": {"min_tokens": 7}, "policy": {"profile": "default"}}
    assert config.resolve_policy({}, run)[1].min_tokens == 7 and config.resolve_policy({"policy_profile": "strict"}, run)[1].min_tokens == 6
    assert config.resolve_policy({"policy_profile": "strict", "max_tokens": 50}, run) == ("strict", config.Policy(6, 50, False, False, ("FILIPINO",), 0.85, False, True, 0.9))
    with pytest.raises(config.ConfigError, match="twice"):
        config.checked([GOOD, GOOD])
    (tmp_path / "c.json").write_text(json.dumps(run))
    assert config.load(str(tmp_path / "c.json")) == run


def test_scope_by_row_is_scope(spark):
    sources = [GOOD, {"id": "b", "name": "B", "domain": "b.com"}, {"id": "c", "name": "C", "domain": "c.com", "url_prefix": "/x/", "landing_paths": ["/x/top"]}]
    urls = ["http://a.com/news/12-x", "http://a.com/news/x", "http://a.com/news/other/1", "http://a.com/news", "http://b.com/y", "http://b.com/", "http://www.c.com/x/1", "http://c.com/x/top/", "http://c.com/z", "ftp://c.com/x/1", "", "http://d.com/q"]
    rows = spark.createDataFrame([(u, s["id"]) for u in urls for s in sources], "url string, source_id string")
    got = {(r.url, r.source_id): r.reason for r in store.with_sources(rows, config.sources_table(spark, sources)).select("url", "source_id", U.scope_reason_by_row(F.col("url")).alias("reason")).collect()}
    for s in sources:
        want = {r.url: r.reason for r in rows.select("url", U.scope_reason(F.col("url"), config.scope_of(s)).alias("reason")).collect()}
        assert {u: got[u, s["id"]] for u in urls} == want


def test_language(spark):
    texts = {"ang mga tao ay narito sa bahay": "FILIPINO", "the man was in the house": "ENGLISH", "bonjour": "OTHER", " ": "UNKNOWN", "ang bahay": "MIXED"}
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select("c", L.detect(F.col("c"), 0.6).alias("x"))
    assert {r.c: r.x.label for r in rows.collect()} == texts
    wanted = F.array(F.lit("FILIPINO"))
    good = lambda label, conf, mixed: spark.range(1).select(L.accepted(F.lit(label), F.lit(conf), wanted, F.lit(0.5), F.lit(mixed))).first()[0]
    assert good("FILIPINO", 0.5, False) and not good("FILIPINO", 0.4, True) and good("MIXED", 0.0, True) and not good("MIXED", 1.0, False)


def test_link_frontier(spark):
    links = [("http://a.com/1", "one"), ("/1#x", "again"), ("mailto:x@y.z", "m"), ("", "none"), ("http://a.com/2?x=1", "query"), ("http://a.com/2?utm_source=1", "tracked"), ("http://b.com/", "other"), ("http://a.com/p", "self"), ("http://a.com/0", "zero")]
    row = (1, "http://a.com/p", "http://a.com/p", 0, [(u, u if "://" in u or not u or u.startswith("mailto") else "http://a.com" + u, t, None) for u, t in links])
    pages = spark.createDataFrame([row, (2, "http://a.com/q", "http://a.com/q", 1, row[4])], "page_id int, requested string, final string, depth int, links array<struct<raw string, href string, text string, rel string>>")
    judged = D.judged_links(pages, lambda c: U.scope_reason(c, U.Source("a", "a.com")))
    n = {r.page_id: r.asDict() for r in D.link_counters(judged, 2).collect()}
    one = n[1]
    assert (one["anchors_seen"], one["normalization_failures"], one["duplicates"], one["accepted"], one["candidates_emitted"], one["candidates_truncated"]) == (9, 2, 1, 3, 2, 1)
    assert one["unique_normalized"] == one["accepted_unique"] + one["rejected_unique"] == 6 and n[2]["links_skipped_by_depth"] == 9
    got = [(r.normalized, r.text, r.depth) for r in D.link_candidates(judged, most=2).orderBy("rank").collect()]
    assert got == [("http://a.com/0", "zero", 1), ("http://a.com/1", "one", 1)]
    reasons = {r.outcome: r.n for r in D.rejection_reasons(judged).collect()}
    assert reasons == {"host_mismatch": 1, "invalid_url": 1, "query_parameters_disallowed": 1, "self_link": 1, "unsupported_scheme": 1}


def test_sitemap_documents_and_edges(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "r"), ("s", "a"), ("b", "c")], "src string, dst string")
    roots = spark.createDataFrame([("r", 1), ("s", 2), ("t", 3)], "root string, ord int")
    got = [(r.root, r.url, r.depth) for r in D.sitemap_documents(edges, roots, max_depth=2, max_roots=2).collect()]
    assert got == [("r", "r", 0), ("r", "a", 1), ("r", "b", 2), ("s", "s", 0)]
    assert len(D.sitemap_documents(edges, roots, max_documents=3).collect()) == 3
    links = spark.createDataFrame([("a", "b", "L"), ("a", "a", "L"), ("a", "b", "L"), ("a", "c", "L")], "src string, dst string, method string")
    assert [r.dst for r in D.new_edges(links, links.where("dst = 'c'")).collect()] == ["b"]


def test_requeue_guards_and_recovery(spark):
    rows = [(i, s, "x", t) for i, (s, t) in enumerate([("RETRY_WAIT", None), ("RETRY_WAIT", 9), ("FAILED", 1), ("BLOCKED", None), ("TERMINAL_FAILED", None), ("ACCEPTED", None)])]
    urls = spark.createDataFrame(rows, "url_id int, status string, source_id string, next_retry_at int")
    ids = lambda df: sorted(r.url_id for r in df.collect())
    now = F.lit(5)
    assert ids(store.requeue_scope(urls, now)) == [0, 1, 2] and ids(store.requeue_scope(urls, now, due=True)) == [0, 2]
    assert ids(store.requeue_scope(urls, now, include_terminal=True, include_blocked=True)) == [0, 1, 2, 3, 4]
    for status in ("blocked", "TERMINAL_FAILED"):
        with pytest.raises(PermissionError):
            store.requeue_scope(urls, now, status=status)
    taken, after = commands.requeue(urls, now, execute=True, status="failed")
    assert ids(taken) == [2] and {r.url_id: r.status for r in after.collect()}[2] == "DISCOVERED"
    assert commands.requeue(urls, now)[1] is urls
    stamps = spark.createDataFrame([(1, "PROCESSING", 1, None), (2, "PROCESSING", 9, 0), (3, "DOWNLOADED", None, 2), (4, "ACCEPTED", 1, None)], "url_id int, status string, processing_started_at int, retry_count int").selectExpr("*", "CAST(NULL AS INT) AS fetched_at", "CAST(NULL AS INT) AS discovered_at", "'e' AS error_reason", "7 AS next_retry_at")
    assert ids(store.stale(stamps, now)) == [1, 3]
    got = {r.url_id: (r.status, r.retry_count, r.next_retry_at) for r in store.recovered(stamps, now).collect()}
    assert got == {1: ("RETRY_WAIT", 1, None), 2: ("PROCESSING", 0, 7), 3: ("RETRY_WAIT", 3, None), 4: ("ACCEPTED", 0, 7)}


def test_outcomes_funnel_and_cooldowns(spark):
    seen = spark.createDataFrame([("a", 1, {"x": "1", "y": None}), ("a", 2, {"x": None, "y": "2"}), (None, 3, {"x": "3"}), ("b", 4, None)], "k string, seq int, metadata map<string, string>")
    got = {r.k: (r.n, r.metadata) for r in store.outcomes(seen, ["k"], "seq", "metadata").collect()}
    assert got == {"a": (2, {"x": "1", "y": "2"}), None: (1, {"x": "3"}), "b": (1, None)}
    totals = spark.createDataFrame([(8, 10, 4, 5, 0, 3, 2, 9)], "in_scope int, unique int, queued int, duplicates int, fetched int, articles int, accepted_articles int, sentences int")
    assert tuple(store.funnel(totals).first()) == (0.8, 0.4, 0.5, None, 4.5)
    sources = spark.createDataFrame([("a", "COOLDOWN", 5), ("b", "COOLDOWN", 9), ("c", "DISABLED", None)], "source_id string, status string, cooldown_until int")
    assert {r.source_id for r in store.blocked_sources(sources, F.lit(7)).collect()} == {"b", "c"}
    assert {r.source_id: r.status for r in store.expired_cooldowns(sources, F.lit(7)).collect()} == {"a": "ACTIVE", "b": "COOLDOWN", "c": "DISABLED"}


def test_discover_conserves(spark):
    feed = b"<rss><channel>" + b"".join(b"<item><link>%s</link><pubDate>%s</pubDate></item>" % (u, t) for u, t in ((b"http://a.com/news/1", b"11 Aug 2026 00:00:00 GMT"), (b"http://a.com/news/1", b""), (b"http://a.com/news/2", b"11 Aug 2001 00:00:00 GMT"), (b"http://b.com/", b""), (b"http://a.com/news/3", b""))) + b"</channel></rss>"
    sitemap = b"<urlset><url><loc>http://a.com/news/1</loc></url><url><loc>http://a.com/news/4</loc><lastmod>2001-01-01</lastmod></url><url><loc>ftp://a.com/news/5</loc></url></urlset>"
    documents = spark.createDataFrame([("f", 1, "a", "feed", bytearray(feed)), ("s", 2, "a", "sitemap", bytearray(sitemap))], "root string, ord int, source_id string, kind string, content binary")
    out = commands.discover(documents, config.sources_table(spark, [GOOD]), spark.createDataFrame([("http://a.com/news/3",)], "url string"), stamp("2020-01-01"), stamp("2027-01-01"))
    assert sorted(r.outcome for r in out.collect()) == sorted(["queued_new", "duplicate_in_run", "rejected_date_hint", "rejected_scope", "already_stored", "duplicate_cross_method", "queued_new", "invalid"])
    n = commands.counters(out).first()
    assert n.seen == n.invalid + n.duplicates + n.unique and n.unique == n.accepted + n.rejected and n.accepted == n.queued_new + n.already_stored


def test_crawl_flow(spark):
    page = "<html><body><article><p>{}</p></article></body></html>"
    body = "Ang mga tao ay nasa bahay na ngayon. The man was in the house by then."
    day = datetime(2026, 8, 11)
    rows = [(1, 200, page.format(body), day), (2, 200, page.format(body), day), (3, 503, None, day), (4, 404, None, day), (5, 200, page.format("Ang bahay ay para sa mga tao ngayon."), None), (6, 200, "", day), (7, 200, page.format("Iba."), day), (8, 200, page.format(body + " Siya ay nasa bahay ng mga tao."), day)]
    fetched = spark.createDataFrame([(i, f"http://a.com/news/{i}", "a", s, 0, None, h, t, None) for i, s, h, t in rows], "page_id int, url string, source_id string, status int, retries int, retry_after double, html string, rss_date timestamp_ntz, lastmod timestamp_ntz").withColumn("page_id", F.col("page_id").cast("bigint"))
    out = commands.crawl(fetched, config.sources_table(spark, [GOOD]), spark.createDataFrame([], "content_hash string"), stamp("2020-01-01"), stamp("2027-01-01"))
    got = {r.page_id: (r.outcome, r.sentence_count) for r in out["articles"].collect()}
    assert got == {1: ("ACCEPTED", 1), 2: ("ACCEPTED", 0), 3: ("RETRY_WAIT", 0), 4: ("TERMINAL_FAILED", 0), 5: ("REJECTED_DATE", 0), 6: ("NO_CONTENT", 0), 7: ("NO_SENTENCES", 0), 8: ("ACCEPTED", 1)}
    sentences = {(r.doc_id, r.sentence_index): r.outcome for r in out["sentences"].collect()}
    assert sentences == {(1, 0): "accepted", (1, 1): "language", (7, 0): "too_short", (8, 0): "duplicate_db", (8, 1): "language", (8, 2): "accepted"}
    legs = commands.rejections(out["sentences"]).first()
    assert legs.total_candidates == 6 == legs.quality + legs.quote + legs.headline + legs.language + legs.duplicate_batch + legs.duplicate_db + legs.accepted


def test_policy_totals_agree_with_each_profile(spark):
    docs = spark.createDataFrame([(i, "s", " ".join(f"Ang {w} {i % 3} ay nasa bahay." for w in ("aso", "pusa", "ibon")) + " “Halika na rito ngayon.” Oo.") for i in range(9)], "doc_id bigint, source string, text string")
    rows = O.sentence_rows(docs)
    profiles = {"one": (3, 100, False, False, 0.0), "two": (1, 4, True, True, 0.5), "three": (3, 9, True, False, 1.5)}
    got = {r.profile: (r.candidates, r.accepted, r.rejected) for r in O.policy_totals(rows, profiles).collect()}
    for name, (low, high, quotes, headlines, least) in profiles.items():
        out = O.sentence_outcomes(rows, low=low, high=high, quotes=quotes, headlines=headlines, least_score=least)
        accepted = out.where("outcome = 'accepted'").count()
        assert got[name] == (out.count(), accepted, out.count() - accepted)


def test_sinks(spark, tmp_path):
    sentences = spark.createDataFrame([("s1", "a1", "x", "Ang “aso”, oo.", "ang “aso”, oo.", 0, 0, True, 3, 1.0, "FILIPINO", 0.9, False), ("s2", "a2", "x", "Iba.", "iba.", 1, 0, False, 1, 1.0, "FILIPINO", 0.8, False)], "sentence_id string, article_id string, source_id string, sentence_text string, normalized_text string, sentence_index int, paragraph_index int, is_quote boolean, token_count int, quality_score double, language string, language_confidence double, is_duplicate boolean")
    articles = spark.createDataFrame([("a1", "x", "http://a/1", None, "H", None, datetime(2026, 8, 11, 5), "html_meta"), ("a2", "x", "http://a/2", "http://a/c", None, "B", None, None)], "article_id string, source_id string, url string, canonical_url string, headline string, author string, publication_date timestamp_ntz, date_source string")
    tables = {"sentences": sentences, "articles": articles, "sources": spark.createDataFrame([("x", "X")], "source_id string, name string")}
    path = str(tmp_path / "out.jsonl")
    commands.export(spark, tables, path)
    lines = [json.loads(x.value) for x in spark.read.text(path).collect()]
    first = next(x for x in lines if x["sentence_id"] == "s1")
    assert len(first) == 10 and first["sentence"] == "Ang “aso”, oo." and first["publication_date"] == "2026-08-11" and first["canonical_url"] is None
    for append, n in ((False, 2), (True, 4)):
        commands.export(spark, tables, str(tmp_path / "csv"), "csv", append=append)
        rows = spark.read.option("header", "true").csv(str(tmp_path / "csv"))
        assert rows.count() == n and len(rows.columns) == 19 and {r.is_quote for r in rows.collect()} == {"0", "1"}
    assert sinks.versioned("a/b.csv", datetime(2026, 8, 11, 1, 2, 3)) == "a/b_2026-08-11T010203.csv"
    assert len(commands.init_tables(spark, str(tmp_path / "db"))) == len(commands.TABLES) and commands.init_tables(spark, str(tmp_path / "db")) == []
    new = sinks.new_rows(sentences.union(sentences), sentences.where("sentence_id = 's1'"), "sentence_id")
    assert [r.sentence_id for r in new.collect()] == ["s2"]


def test_sql_functions(spark):
    assert register.register(spark) == sorted(register.FUNCTIONS)
    row = spark.sql("SELECT url_domain('http://WWW.a.com:80/x'), token_count(' a b '), http_category(429), parse_date('11 Aug 2026'), quality_reason('Ito ay isang maayos na pangungusap dito.'), hamming64(1, 2)").first()
    assert tuple(row) == ("a.com", 2, "RATE_LIMITED", datetime(2026, 8, 11), "accepted", 2)
    register.view(spark.createDataFrame([("Una ito. Ikalawa.",)], "text string"), "texts")
    assert spark.sql("SELECT size(segment_sentences), detect_language.label FROM texts").first()[0] == 2
    assert spark.range(1).select(T.hamming(F.lit(1), F.lit(2))).first()[0] == 2


def test_store_stream_is_idempotent(spark, tmp_path):
    source, store_path = str(tmp_path / "in"), str(tmp_path / "store")
    write = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").json(source)
    read = lambda: spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).json(source)
    for i, texts in enumerate((["a", "b", "A"], ["b", "c"], ["c"])):
        write(texts)
        # The second run starts anew, as after a lost checkpoint, and sees all files again.
        crawl.store_stream(read(), store_path, str(tmp_path / f"check{i // 2}")).awaitTermination(120)
    assert sorted(T_.text.lower() for T_ in spark.read.parquet(store_path).collect()) == ["a", "b", "c"]


def test_stream_timers(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    files = [[("u", "2026-08-11 00:00:00", 60.0), ("v", "2026-08-11 00:00:00", 9000.0)], [("w", "2026-08-11 01:00:00", 1.0)], [("x", "2026-08-11 01:30:00", 1.0)]]
    for rows in files:
        spark.createDataFrame(rows, "url string, at string, delay double").select("url", F.col("at").cast("timestamp").alias("at"), "delay").coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    stream = spark.readStream.schema("url string, at timestamp, delay double").option("maxFilesPerTrigger", 1).parquet(source)
    crawl.due_retries(stream, "1 minute").writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(120)
    got = {r.url: str(r.due) for r in spark.read.parquet(out).collect()}
    assert got["u"] == "2026-08-11 00:01:00" and "v" not in got
    values = spark.readStream.schema("url string, at timestamp, delay double").option("maxFilesPerTrigger", 1).parquet(source).select(F.col("url").alias("key"), "at", F.col("delay").cast("string").alias("value"))
    crawl.fresh_values(values, 1800, "1 minute").writeStream.format("parquet").option("path", out + "2").option("checkpointLocation", str(tmp_path / "check2")).trigger(availableNow=True).start().awaitTermination(120)
    live = {(r.key, r.live) for r in spark.read.parquet(out + "2").collect()}
    assert {("u", True), ("v", True), ("w", True), ("x", True), ("u", False), ("v", False)} <= live and ("x", False) not in live
