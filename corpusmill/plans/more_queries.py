"""More queries over the test tables: store, discovery, dates, language and configuration operators.

orders stand for articles (status F: accepted), lineitem for sentences, customer for sources, events for URLs,
observations and runs (a user's day), pages for fetched URLs and listings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import language as L
from ..functions import status as S
from ..functions import text as T
from ..functions import url as U
from ..operators import corpus as O
from ..operators import discovery as D
from ..operators import store
from ..sources import feeds, sinks
from . import commands
from .config import sources_table
from .queries import HASH, NORMAL_URL, SCOPE, SQL, _urls, link_edges, query, table, url_normalize

_LISTS = {k: "(" + ", ".join(f"'{w}'" for w in v) + ")" for k, v in (("f", L.FILIPINO), ("e", L.ENGLISH))}


@query(rf"""WITH w AS (SELECT doc_id, text, regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{M}}\p{{N}}_]+') AS w FROM documents),
 n AS (SELECT doc_id, text, len(list_filter(w, lambda x: x IN {_LISTS['f']})) AS f, len(list_filter(w, lambda x: x IN {_LISTS['e']})) AS e FROM w),
 c AS (SELECT *, greatest(f, e) AS m, CASE WHEN greatest(f, e) > 0 THEN round(CAST(greatest(f, e) AS DOUBLE) / (f + e) * greatest(f, e) / (greatest(f, e) + 1), 6) ELSE 0 END AS c FROM n)
 SELECT doc_id, CASE WHEN trim(coalesce(text, '')) = '' THEN 'UNKNOWN' WHEN m > 0 AND c < 0.85 THEN 'MIXED' WHEN m = 0 THEN 'OTHER' WHEN f >= e THEN 'FILIPINO' ELSE 'ENGLISH' END AS label, CAST(c AS DOUBLE) AS confidence FROM c""")
def language_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", L.detect(F.col("text"), 0.85).alias("x")).select("doc_id", "x.label", "x.confidence")


@query(f"SELECT label, count(*) AS n, CAST(sum(CASE WHEN (label IN ('FILIPINO', 'ENGLISH') AND confidence >= 0.85) OR label = 'MIXED' THEN 1 ELSE 0 END) AS BIGINT) AS accepted FROM ({SQL['language_labels']}) GROUP BY 1")
def language_acceptance(spark, d):
    rows = language_labels(spark, d)
    good = L.accepted(F.col("label"), F.col("confidence"), F.array(F.lit("FILIPINO"), F.lit("ENGLISH")), F.lit(0.85), F.lit(True))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.count_if(good).alias("accepted"))


RAW = "CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d %b %Y') WHEN 2 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S +0000') WHEN 3 THEN strftime(o_orderdate, '%B %d, %Y') WHEN 4 THEN 'soon' ELSE '' END"


@query(f"""SELECT o_orderkey, {RAW} AS raw, CASE o_orderkey % 6 WHEN 5 THEN 'date_missing' WHEN 4 THEN 'date_invalid' ELSE CASE WHEN o_orderdate > TIMESTAMP '1998-01-02' THEN 'date_in_future' WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 'date_before_cutoff' ELSE 'accepted' END END AS reason FROM orders""")
def raw_date_gate(spark, d):
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    raw = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "dd MMM yyyy")).when(k == 2, F.concat(F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))).when(k == 3, F.date_format(day, "MMMM dd, yyyy")).when(k == 4, "soon").otherwise("")
    return table(spark, d, "orders").select("o_orderkey", raw.alias("raw"), S.raw_date_reason(raw, F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")).alias("reason"))


@query("""SELECT o_orderkey, pos, source, value, confidence FROM (
 SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY i) - 1 AS INTEGER) AS pos, source, value, confidence FROM (
  SELECT o_orderkey, 0 AS i, 'html_meta' AS source, o_orderdate AS value, 1.0::DOUBLE AS confidence FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 1, 'rss', o_orderdate, 0.85 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, 2, 'lastmod', o_orderdate + INTERVAL 40 DAY, 0.5 FROM orders UNION ALL SELECT o_orderkey, 3, 'hint', o_orderdate, 0.8 FROM orders WHERE o_orderkey % 2 <> 0 AND o_orderkey % 3 <> 0))""")
def evidence_assembly(spark, d):
    day, k = F.col("o_orderdate"), F.col("o_orderkey")
    none = F.lit(None).cast("timestamp_ntz")
    rows = S.evidence(F.when(k % 2 == 0, day), F.lit("html_meta"), none, F.when(k % 3 == 0, day), none, none, day + F.expr("INTERVAL 40 DAYS"), day)
    return table(spark, d, "orders").select("o_orderkey", F.posexplode(rows).alias("pos", "e")).select("o_orderkey", "pos", "e.source", "e.value", "e.confidence")


@query("""SELECT o_orderkey AS item, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 'lastmod' ELSE 'hint' END AS source, CAST(40 AS BIGINT) AS days FROM orders""")
def evidence_disagreements(spark, d):
    return O.disagreements(evidence_assembly(spark, d).withColumnRenamed("o_orderkey", "item"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS TIMESTAMP) ELSE CASE WHEN event_id % 3 = 0 THEN CAST(ts - INTERVAL 1 DAY AS TIMESTAMP) END END AS modified FROM events")
def modified_fallback(spark, d):
    k = F.col("event_id")
    return table(spark, d, "events").select("event_id", S.modified_date(F.when(k % 2 == 0, F.col("ts")), F.when(k % 3 == 0, F.col("ts") - F.expr("INTERVAL 1 DAY"))).alias("modified"))


@query("SELECT user_id AS source_id FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 5 = 0 OR (user_id % 5 = 1 AND user_id > 20)")
def blocked_sources(spark, d):
    k = F.col("source_id")
    sources = table(spark, d, "events").select(F.col("user_id").alias("source_id")).distinct()
    return store.blocked_sources(sources.withColumn("status", F.when(k % 5 == 0, "DISABLED").when(k % 5 == 1, "COOLDOWN").otherwise("ACTIVE")).withColumn("cooldown_until", k), F.lit(20))


@query("SELECT count(*) AS n FROM events WHERE event_id % 4 = 0")
def queued_count(spark, d):
    return store.queued_count(_urls(spark, d))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'DISCOVERED' WHEN 1 THEN 'RETRY_WAIT' WHEN 2 THEN 'DISCOVERED' ELSE 'ACCEPTED' END AS status FROM events")
def reset_failed(spark, d):
    urls = _urls(spark, d).select(F.col("event_id").alias("url_id"), "status")
    return store.reset_failed(urls).select(F.col("url_id").alias("event_id"), "status")


@query("""SELECT c_custkey AS source_id, coalesce(a.n, 0) AS articles, coalesce(s.n, 0) AS sentences FROM customer LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1) AS a ON a.k = c_custkey
 LEFT JOIN (SELECT o_custkey AS k, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) AS s ON s.k = c_custkey""")
def per_source_counts(spark, d):
    articles = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("source_id"))
    sentences = table(spark, d, "lineitem").join(articles, F.col("l_orderkey") == F.col("o_orderkey"))
    return store.per_source(table(spark, d, "customer").select(F.col("c_custkey").alias("source_id")), articles, sentences)


@query("SELECT user_id AS run_id, " + ", ".join(f"CAST(sum(CASE WHEN event_id % 6 IN ({k}) THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, k in (("urls_discovered", "0, 1"), ("urls_fetched", "2"), ("articles_extracted", "3"), ("sentences_accepted", "4"), ("sentences_rejected", "5"))) + " FROM events GROUP BY 1")
def run_totals(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("discovered", "claimed", "fetched", "extracted", "accepted", "rejected"))), (F.col("event_id") % 6 + 1).cast("int"))
    return store.run_totals(table(spark, d, "events").select(F.col("user_id").alias("run_id"), kind.alias("kind"), F.lit(1).cast("bigint").alias("n")))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def newest_articles(spark, d):
    return store.newest(table(spark, d, "orders"), ["o_orderdate", "o_orderkey"], 50).select("o_orderkey")


@query("SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_run(spark, d):
    return store.newest(table(spark, d, "events"), ["ts", "event_id"], 1).select("event_id")


@query("SELECT c_custkey AS run_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def observed_runs(spark, d):
    runs = table(spark, d, "customer").select(F.col("c_custkey").alias("run_id"), F.col("c_custkey").alias("end_time"))
    return store.observed_runs(runs, table(spark, d, "orders").select(F.col("o_custkey").alias("run_id"))).select("run_id")


@query("SELECT DISTINCT user_id AS source_id FROM events UNION SELECT c_custkey FROM customer")
def distinct_sources(spark, d):
    return store.source_ids(table(spark, d, "events").select(F.col("user_id").alias("source_id")), table(spark, d, "customer").select(F.col("c_custkey").alias("source_id")))


@query("SELECT 'backfilled' AS step, count(*) AS rows FROM orders UNION ALL SELECT 'reclassified', count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def migration_counts(spark, d):
    articles = table(spark, d, "orders").select(F.col("o_orderkey").alias("article_id"), F.when(F.col("o_orderstatus") == "F", "ACCEPTED").otherwise("NEW").alias("status"))
    return store.migration_counts(articles, table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("article_id")))


@query(f"SELECT doc_id FROM documents WHERE {HASH} IN (SELECT {HASH} FROM documents WHERE doc_id % 3 = 0)")
def known_bodies(spark, d):
    rows = table(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))
    return store.known_bodies(rows, rows.where("doc_id % 3 = 0")).select("doc_id")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 0) ON l_orderkey = o_orderkey")
def source_config_join(spark, d):
    """Rows with their source's configuration, sent to all tasks only if it's small."""
    sources = table(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("source_id"), "o_orderstatus")
    return store.with_sources(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), "l_linenumber"), sources).select(F.col("source_id").alias("l_orderkey"), "l_linenumber", "o_orderstatus")


@query("""WITH m AS (SELECT event_type, user_id % 3 AS origin, event_id, 'a' AS k, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS v FROM events)
 SELECT event_type, origin, count(*) AS n, arg_max(v, event_id) FILTER (WHERE v IS NOT NULL) AS last FROM m GROUP BY 1, 2""")
def outcome_metadata(spark, d):
    k = F.col("event_id")
    rows = table(spark, d, "events").select("event_type", (F.col("user_id") % 3).alias("origin"), "event_id", F.create_map(F.lit("a"), F.when(k % 2 == 0, k.cast("string"))).alias("metadata"))
    return store.outcomes(rows, ["event_type", "origin"], "event_id", "metadata").select("event_type", "origin", "n", F.col("metadata")["a"].alias("last"))


@query("SELECT event_type AS dimension, CAST(sum(value) / (CASE WHEN event_type = 'view' THEN NULL ELSE 1000 END) AS DOUBLE) AS ratio FROM events GROUP BY event_type")
def budget_ratios(spark, d):
    used = table(spark, d, "events").groupBy(F.col("event_type").alias("dimension")).agg(F.sum("value").alias("used"))
    return store.budget_use(used.withColumn("limit", F.when(F.col("dimension") == "view", 0).otherwise(1000))).withColumn("ratio", F.round("ratio", 9))


@query(f"""WITH l AS (SELECT n.page_id % 5 AS source, n.page_id AS ord, n.normalized AS u, s.reason FROM ({NORMAL_URL}) AS n JOIN ({SCOPE}) AS s USING (page_id) WHERE n.normalized <> ''),
 f AS (SELECT u, min(ord) AS f FROM l WHERE reason = 'accepted' GROUP BY 1),
 o AS (SELECT l.*, CASE WHEN reason <> 'accepted' THEN 'out_of_scope' WHEN u IN (SELECT normalized FROM ({NORMAL_URL}) AS x WHERE page_id % 9 = 0) OR ord > f THEN 'duplicate' ELSE 'added' END AS outcome FROM l LEFT JOIN f USING (u)),
 b AS (SELECT *, coalesce(sum(CASE WHEN outcome = 'added' THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o)
 SELECT source, count(*) AS links_found, CAST(sum(CASE WHEN outcome = 'added' THEN 1 ELSE 0 END) AS BIGINT) AS links_added, CAST(sum(CASE WHEN outcome = 'duplicate' THEN 1 ELSE 0 END) AS BIGINT) AS duplicates,
 CAST(sum(CASE WHEN outcome = 'out_of_scope' THEN 1 ELSE 0 END) AS BIGINT) AS out_of_scope FROM b WHERE before < 10 GROUP BY 1""")
def archive_counters(spark, d):
    links = table(spark, d, "pages").select((F.col("page_id") % 5).alias("source"), F.col("page_id").alias("ord"), "url")
    stored = url_normalize(spark, d).where("page_id % 9 = 0").select(F.col("normalized").alias("url"))
    return D.archive_counters(D.archive_outcomes(links, lambda c: U.scope_reason(c, U.Source("news", "example.com", landing=("/news",))), stored, 10))


@query("""SELECT page_id % 7 AS root, CASE WHEN bool_or(page_id % 2 = 0) AND bool_or(page_id % 3 = 0) THEN 'configured+robots' WHEN bool_or(page_id % 3 = 0) THEN 'robots' ELSE 'configured' END AS origin,
 count(CASE WHEN page_id % 4 <> 0 THEN 200 END) AS documents_fetched, CAST(sum(length(html)) AS BIGINT) AS entries FROM pages GROUP BY 1""")
def root_audit(spark, d):
    k, zero = F.col("page_id"), F.lit(0)
    rows = table(spark, d, "pages").select((k % 7).alias("root"), (k % 2 == 0).alias("configured"), (k % 3 == 0).alias("declared"), F.when(k % 4 != 0, 200).alias("status"), F.length("html").cast("bigint").alias("entries"), *[zero.alias(c) for c in ("accepted", "rejected", "lastmod_dates", "news_dates")])
    return D.root_audit(rows).select("root", "origin", "documents_fetched", "entries")


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS src, unnest([p_partkey * 2 % 997, p_partkey * 3 % 997]) AS dst FROM part WHERE p_partkey < 997),
 r AS (SELECT p_partkey AS root, p_partkey AS url, 0 AS depth FROM (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 3) UNION SELECT r.root, e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.url WHERE r.depth < 4),
 b AS (SELECT root, url, min(depth) AS depth FROM r GROUP BY 1, 2), o AS (SELECT url, arg_min(root, root) AS root, arg_min(depth, root) AS depth FROM b GROUP BY 1)
 SELECT root, url, CAST(depth AS INTEGER) AS depth FROM o ORDER BY root, depth, url LIMIT 40""")
def sitemap_documents(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    edges = p.where("k < 997").select(F.col("k").alias("src"), F.explode(F.array(F.col("k") * 2 % 997, F.col("k") * 3 % 997)).alias("dst"))
    return D.sitemap_documents(edges, p.select(F.col("k").alias("root"), F.col("k").alias("ord")), 4, 40, 3)


@query()
def link_frontier(spark, d):
    """The counters of every page's links."""
    return commands.audit_link_frontier(table(spark, d, "pages"), U.Source("news", "example.com"))["counters"]


@query()
def link_frontier_reasons(spark, d):
    return commands.audit_link_frontier(table(spark, d, "pages"), U.Source("news", "example.com"))["reasons"]


@query()
def new_link_edges(spark, d):
    edges = link_edges(spark, d).select("src", "dst", F.lit("LINK").alias("method"))
    return D.new_edges(edges, edges.where(F.xxhash64("dst") % 2 == 0))


@query()
def page_reach(spark, d):
    """Pages within two links of any page."""
    edges = link_edges(spark, d).select("src", "dst")
    return O.reachable(edges, url_normalize(spark, d).select(F.col("normalized").alias("node")).distinct(), 2)


@query(SCOPE)
def url_scope_by_source(spark, d):
    """Scope by a join to the sources' table."""
    sources = sources_table(spark, [{"id": "news", "name": "News", "domain": "www.example.com", "landing_paths": ["/news"]}])
    rows = store.with_sources(table(spark, d, "pages").select("page_id", "url", F.lit("news").alias("source_id")), sources)
    return rows.select("page_id", U.scope_reason_by_row(F.col("url")).alias("reason"))


@query("SELECT * FROM (VALUES ('a', 'default', 3, 100), ('b', 'strict', 8, 60), ('c', 'recall', 3, 120)) AS t(source_id, profile, min_tokens, max_tokens)")
def policy_resolution(spark, d):
    sources = [{"id": "a", "name": "A", "domain": "a.com"}, {"id": "b", "name": "B", "domain": "b.com", "policy_profile": "strict", "min_tokens": 8}, {"id": "c", "name": "C", "domain": "c.com", "policy_profile": "recall"}]
    return sources_table(spark, sources).select("source_id", "profile", "policy.min_tokens", "policy.max_tokens")


@query("""SELECT l_orderkey * 10 + l_linenumber AS sentence_id, c_name AS source, l_orderkey AS article_id, strftime(o_orderdate, '%Y-%m-%d') AS publication_date, 'FILIPINO' AS language
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'N' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'""")
def export_jsonl_rows(spark, d):
    empty = F.lit(None).cast("string")
    sentences = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sentence_id"), F.col("l_orderkey").alias("article_id"), F.lit("x").alias("sentence_text"), F.lit("FILIPINO").alias("language"), F.lit(1.0).alias("language_confidence"), (F.col("l_returnflag") != "N").alias("is_duplicate"))
    articles = table(spark, d, "orders").select(F.col("o_orderkey").alias("article_id"), F.col("o_custkey").alias("source_id"), F.col("o_orderdate").alias("publication_date"), empty.alias("date_source"), empty.alias("url"), empty.alias("canonical_url"))
    sources = table(spark, d, "customer").select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("name"))
    return sinks.jsonl_rows(sinks.export_rows(sentences, articles, sources, "1996-01-01", "1996-01-31")).select("sentence_id", "source", "article_id", "publication_date", "language")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url END AS cached FROM pages")
def index_cache_lookup(spark, d):
    """Every third request is in the cache, every sixth of those damaged copies aside."""
    rows = table(spark, d, "pages").select("page_id", F.to_json(F.struct("page_id")).alias("request"), F.col("url").cast("binary").alias("content"))
    cache = feeds.cache_entries(rows.where("page_id % 3 < 2"))
    broken = (F.get_json_object("request", "$.page_id").cast("int") % 3) == 1
    cache = cache.withColumn("sha256", F.when(broken, "0").otherwise(F.col("sha256")))
    return feeds.cache_lookup(rows.drop("content"), cache).select("page_id", F.col("content").cast("string").alias("cached"))


@query("""SELECT page_id, CASE WHEN page_id % 5 = 0 THEN FALSE WHEN page_id % 5 IN (1, 2) THEN NOT contains(regexp_extract(url, '^[A-Za-z]+://[^/?#]*(.*)$', 1), 'zzz') ELSE TRUE END AS allowed FROM pages WHERE starts_with(url, 'http')""")
def robots_decisions(spark, d):
    """Forbidden (403), with a rule that fits no page, or without a file."""
    pages = table(spark, d, "pages").where("url LIKE 'http%'").select("page_id", F.concat(F.lit("http://h"), F.col("page_id") % 5, F.lit(".com/x")).alias("url"))
    files = [(f"h{k}.com", s, t, 1) for k, s, t in ((0, 403, None), (1, 200, "User-agent: *\nDisallow: /zzz"), (2, 200, "User-agent: *\nDisallow: /zzz"), (3, 500, None))]
    return feeds.robots_decisions(pages, spark.createDataFrame(files, "domain string, status int, text string, at int"), "bot").select("page_id", "allowed")


@query(SQL["policy_projection"])
def evaluate_policy(spark, d):
    return commands.evaluate_policy(table(spark, d, "documents"))


@query()
def rejection_legs(spark, d):
    return commands.rejection_legs(O.outcome_counts(O.judged_sentences(O.sentence_rows(table(spark, d, "documents")), languages=["OTHER"])))


@query()
def crawl_pages(spark, d):
    """The crawl command over all pages: the state that each page ends in."""
    at = F.lit("2035-01-01").cast("timestamp_ntz")
    k, none = F.col("page_id"), F.lit(None)
    fetched = table(spark, d, "pages").select("page_id", "url", F.lit("news").alias("source_id"), F.when(k % 11 == 0, 503).when(k % 13 == 0, 404).otherwise(200).alias("status"), (k % 5).cast("int").alias("retries"), none.cast("double").alias("retry_after"), "html", F.lit("2026-01-01").cast("timestamp_ntz").alias("rss_date"), none.cast("timestamp_ntz").alias("lastmod"))
    sources = sources_table(spark, [{"id": "news", "name": "News", "domain": "example.com"}])
    known = spark.createDataFrame([], "content_hash string")
    out = commands.crawl(fetched, sources, known, F.lit("2000-01-01").cast("timestamp_ntz"), at)
    return out["articles"].groupBy("outcome").agg(F.count("*").alias("n"), F.sum("sentence_count").alias("sentences"))


@query()
def discover_candidates(spark, d):
    """The discover command over a feed of each page: counters."""
    url = F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.concat(F.lit("<rss><channel><item><link>"), url, F.lit("</link><pubDate>Tue, 11 Aug 2026 12:00:00 +0800</pubDate></item></channel></rss>")).cast("binary")
    documents = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("root"), F.col("page_id").alias("ord"), F.lit("news").alias("source_id"), F.lit("feed").alias("kind"), body.alias("content"))
    sources = sources_table(spark, [{"id": "news", "name": "News", "domain": "example.com", "landing_paths": ["/news"]}])
    stored = url_normalize(spark, d).where("page_id % 7 = 0").select(F.col("normalized").alias("url"))
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return commands.counters(commands.discover(documents, sources, stored, at("2020-01-01"), at("2027-01-01")))
