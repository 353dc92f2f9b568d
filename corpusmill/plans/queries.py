"""The engine's queries over the test tables, with the DuckDB SQL that gives the same rows.

Tables stand in for the engine's own: documents for articles, pages for fetched URLs, events for the event log
(value as retry count), orders, lineitem and customer for articles, sentences and sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import status as S
from ..functions import text as T
from ..functions import url as U
from ..operators import corpus as O
from ..operators import discovery as D
from ..operators import store
from ..sources import feeds, html

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Policy profiles: least and most tokens, quotes, headlines, least score.
PROFILES = {"default": (3, 100, False, False, 0.0), "strict": (6, 60, False, False, 0.9), "balanced": (4, 80, True, False, 0.7), "recall": (3, 120, True, True, 0.5)}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


NORM = r"regexp_replace(regexp_replace(regexp_replace(replace(nfc_normalize(coalesce(text, '')), chr(173), ''), '\p{Zs}', ' ', 'g'), '[ \t\r\f\x0B]+', ' ', 'g'), '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g')"
HASH = r"sha256(trim(regexp_replace(lower(text), '\s+', ' ', 'g')))"


@query(f"SELECT doc_id, {NORM} AS normalized FROM documents")
def text_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_text(F.col("text"), compose=True).alias("normalized"))


@query(f"SELECT doc_id, {HASH} AS content_hash FROM documents")
def content_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("content_hash"))


@query(f"SELECT doc_id, content_hash, CAST(row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) AS INTEGER) AS occurrence, row_number() OVER (PARTITION BY content_hash ORDER BY doc_id) = 1 AS kept FROM (SELECT doc_id, {HASH} AS content_hash FROM documents)")
def article_dedup_first_wins(spark, d):
    return O.first_wins(content_hash(spark, d), "content_hash", "doc_id")


@query(f"SELECT {HASH} AS content_hash, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, d):
    return O.duplicate_groups(content_hash(spark, d), "content_hash", "doc_id")


@query(f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS paragraph_index, p[i] AS paragraph FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, list_filter(list_transform(string_split(replace({NORM}, chr(10) || ' ', chr(10)), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS p FROM documents))")
def paragraphs(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.paragraphs(F.col("text"))).alias("paragraph_index", "paragraph"))


QUALITY = r"""CASE WHEN t = '' THEN 'empty' WHEN n < 5 THEN 'too_short' WHEN n > 80 THEN 'too_long'
 WHEN regexp_matches(t, '[<>{}]') OR contains(lower(t), 'javascript:') THEN 'markup'
 WHEN regexp_matches(t, '(?i)https?://|www\.|[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}') THEN 'url_or_email'
 WHEN regexp_matches(lower(t), '^(photo|larawan|credit|abante\s+tnt|read\s+more|click\s+here|mag-subscribe|i-share|basahin\s+din|sundan\s+kami|newsletter|advertisement|patalastas)([^\p{L}\p{N}_]|$)|all\s+rights\s+reserved|copyright([^\p{L}\p{N}_]|$)|^[-–—•*]') THEN 'boilerplate'
 WHEN regexp_matches(t, '[\p{Cc}\p{Cf}]') THEN 'control_character'
 WHEN length(regexp_replace(t, '[^\p{L}\p{N}]', '', 'g')) / length(t) < 0.6 THEN 'symbol_noise'
 WHEN NOT regexp_matches(t, '[.!?]["''’”»)]*$') THEN 'unterminated' ELSE 'accepted' END"""


@query(f"WITH p AS ({SQL['paragraphs']}), q AS (SELECT paragraph AS t, len(regexp_split_to_array(paragraph, '\\s+')) AS n FROM p), r AS (SELECT {QUALITY} AS reason FROM q) SELECT reason, count(*) AS n FROM r GROUP BY 1")
def paragraph_quality(spark, d):
    return paragraphs(spark, d).select(T.quality_reason(F.col("paragraph")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


_W, _CLOSERS = r"[\p{L}\p{M}\p{N}_]", """["''”’»)\\]}]*"""
#: The boundary rule in patterns without look-around: b is what stands before a mark, a what stands after it.
_STOPS = f"""NOT (regexp_matches(b, '\\p{{Nd}}$') AND regexp_matches(a, '^\\p{{Nd}}')) AND NOT starts_with(a, '.') AND NOT regexp_matches(b, '(?i)((https?://|www\\.)\\S*|www)$')
 AND NOT (regexp_matches(b, '(^|[^{_W[1:-1]}])(?i:{"|".join(T.TERMINAL_ABBREVIATIONS)})$') AND regexp_matches(a, '^{_CLOSERS}\\s*$')) AND NOT (regexp_matches(b, '(^|[^{_W[1:-1]}])(?i:{"|".join(T.ABBREVIATIONS)})$') AND regexp_matches(a, '^{_CLOSERS}\\s*\\S'))
 AND NOT (regexp_matches(b, '(^|[^{_W[1:-1]}]){_W}$') AND regexp_matches(a, '^{_CLOSERS}\\s*\\p{{L}}'))"""
SENTENCES = f"""(SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY paragraph_index, e) - 1 AS INTEGER) AS sentence_index, paragraph_index, t AS sentence_text, regexp_matches(t, '^["“‘'']|["”’»'']$') AS is_quote FROM (
 SELECT doc_id, paragraph_index, e, trim(substr(p, s + 1, e - s)) AS t FROM (SELECT *, lag(e, 1, 0) OVER (PARTITION BY doc_id, paragraph_index ORDER BY e) AS s FROM (
  SELECT doc_id, paragraph_index, p, i + length(regexp_extract(a, '^{_CLOSERS}')) AS e FROM (
   SELECT *, substr(p, 1, i - 1) AS b, substr(p, i + 1) AS a FROM (SELECT doc_id, paragraph_index, paragraph AS p, unnest(string_split(paragraph, '')) AS ch, generate_subscripts(string_split(paragraph, ''), 1) AS i FROM ({SQL["paragraphs"]})) WHERE ch IN ('.', '!', '?'))
  WHERE regexp_matches(a, '^{_CLOSERS}($|\\s|\\p{{Lu}})') AND (ch <> '.' OR ({_STOPS}))))) WHERE t <> '')"""


@query(f"SELECT s.*, d.source FROM {SENTENCES} AS s JOIN documents AS d USING (doc_id)")
def sentence_segments(spark, d):
    return O.sentence_rows(table(spark, d, "documents"))


def outcomes_sql(low: str, high: str, quotes: str, least: str, profiles: str, by: str) -> str:
    """SQL of the sentences' outcomes; the limits are expressions over a row of profiles."""
    quality = QUALITY.replace("n < 5", f"n < {low}").replace("n > 80", f"n > {high}").replace("THEN 'empty'", f"THEN 'empty' WHEN is_quote AND NOT {quotes} THEN 'quote_excluded'").replace("ELSE 'accepted'", f"WHEN 1.0 < {least} THEN 'low_quality_score' ELSE 'accepted'")
    return f"""(SELECT *, CASE WHEN reason <> 'accepted' THEN reason WHEN row_number() OVER (PARTITION BY {by} reason, content_hash, doc_id ORDER BY sentence_index) > 1 THEN 'duplicate_batch'
 WHEN min(doc_id) OVER (PARTITION BY {by} reason, content_hash) <> doc_id THEN 'duplicate_db' ELSE 'accepted' END AS outcome FROM (
 SELECT *, {quality} AS reason, sha256(trim(regexp_replace(lower(t), '\\s+', ' ', 'g'))) AS content_hash FROM (SELECT *, sentence_text AS t, len(regexp_split_to_array(sentence_text, '\\s+')) AS n FROM {SENTENCES} AS s{profiles})))"""


@query(f"SELECT doc_id, sentence_index, reason, outcome, content_hash FROM {outcomes_sql('5', '80', 'FALSE', '0', '', '')}")
def sentence_dedup_outcome(spark, d):
    judged = O.judged_sentences(sentence_segments(spark, d)).select("doc_id", "sentence_index", "reason", "content_hash")
    return O.deduplicated(judged).select("doc_id", "sentence_index", "reason", "outcome", "content_hash")


@query(f"SELECT outcome, count(*) AS n FROM ({SQL['sentence_dedup_outcome']}) GROUP BY 1")
def rejection_breakdown(spark, d):
    return O.outcome_counts(O.judged_sentences(sentence_segments(spark, d)))


_PROFILE_ROWS = ", (VALUES " + ", ".join(f"('{n}', {low}, {high}, {q}, {least})" for n, (low, high, q, _, least) in PROFILES.items()) + ") AS f(profile, low, high, quotes, least)"


@query(f"SELECT profile, count(*) AS candidates, CAST(sum(CASE WHEN outcome = 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS accepted, CAST(sum(CASE WHEN outcome <> 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS rejected FROM {outcomes_sql('low', 'high', 'quotes', 'least', _PROFILE_ROWS, 'profile,')} GROUP BY 1")
def policy_projection(spark, d):
    return O.policy_totals(O.sentence_rows(table(spark, d, "documents")), PROFILES)


@query(r"SELECT source, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens, min(n) AS least, max(n) AS most FROM (SELECT source, CASE WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 0 ELSE CAST(len(regexp_split_to_array(trim(text, ' ' || chr(9) || chr(10) || chr(13)), '\s+')) AS INTEGER) END AS n FROM documents) GROUP BY 1")
def token_stats_by_source(spark, d):
    return table(spark, d, "documents").select("source", T.token_count(F.col("text")).alias("n")).groupBy("source").agg(F.count("*").alias("docs"), F.sum("n").alias("tokens"), F.min("n").alias("least"), F.max("n").alias("most"))


@query()
def near_duplicate_pairs(spark, d):
    return O.near_pairs(table(spark, d, "documents"), "doc_id", "text")


URL = r"""(SELECT page_id, url, lower(regexp_extract(trim(url), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS s, lower(regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS h,
 regexp_extract(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(trim(url), '^[^?#]*\?([^#]*)', 1) AS q FROM pages)"""
TRACK = "('" + "', '".join(U.TRACKING) + "')"
NORMAL_URL = f"""SELECT page_id, s || '://' || CASE WHEN s = 'https' THEN regexp_replace(h, ':443$', '') WHEN s = 'http' THEN regexp_replace(h, ':80$', '') ELSE h END
 || CASE WHEN p IN ('', '/') THEN '/' ELSE regexp_replace(p, '/+$', '') END || CASE WHEN len(k) > 0 THEN '?' || array_to_string(list_sort(k), '&') ELSE '' END AS normalized
 FROM (SELECT *, list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '^[^=]*=.') AND lower(split_part(x, '=', 1)) NOT IN {TRACK}) AS k FROM {URL})"""


@query(NORMAL_URL)
def url_normalize(spark, d):
    return table(spark, d, "pages").select("page_id", U.normalize_url(F.col("url")).alias("normalized"))


NEWS = U.Source("news", "example.com", patterns=(), landing=("/news",))
SCOPE = f"""SELECT page_id, CASE WHEN s = '' OR h = '' THEN 'invalid_url' WHEN s NOT IN ('http', 'https') THEN 'unsupported_scheme'
 WHEN regexp_replace(regexp_replace(h, ':[0-9]*$', ''), '^www\\.', '') <> 'example.com' THEN 'host_mismatch'
 WHEN regexp_matches(lower(p), '\\.({"|".join(U.ASSETS)})$') OR regexp_matches(lower(p), '(^|/)({"|".join(U.UTILITY)})(/|$)') OR regexp_matches(lower(q), '^(s|q|search)=') THEN 'non_article_asset'
 WHEN regexp_replace(p, '/+$', '') IN ('', '/news') THEN 'section_landing_page' ELSE 'accepted' END AS reason FROM {URL}"""


@query(SCOPE)
def url_scope(spark, d):
    return table(spark, d, "pages").select("page_id", U.scope_reason(F.col("url"), NEWS).alias("reason"))


@query(f"SELECT reason, count(*) AS n FROM ({SCOPE}) GROUP BY 1")
def scope_reason_counts(spark, d):
    return url_scope(spark, d).groupBy("reason").agg(F.count("*").alias("n"))


@query(f"""WITH c AS (SELECT n.page_id * 2 + m AS ord, CASE m WHEN 0 THEN 'rss' ELSE 'sitemap' END AS method, n.normalized AS url, s.reason AS scope FROM ({NORMAL_URL}) AS n JOIN ({SCOPE}) AS s USING (page_id), (VALUES (0), (1)) AS v(m)),
 w AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ord) AS n, first_value(method) OVER (PARTITION BY url ORDER BY ord) AS f FROM c)
 SELECT CASE WHEN url = '' OR scope = 'unsupported_scheme' THEN 'invalid' WHEN n > 1 AND f <> method THEN 'duplicate_cross_method' WHEN n > 1 THEN 'duplicate_in_run' WHEN scope <> 'accepted' THEN 'rejected_scope'
 WHEN url IN (SELECT normalized FROM ({NORMAL_URL}) AS x WHERE page_id % 7 = 0) THEN 'already_stored' ELSE 'queued_new' END AS outcome, count(*) AS n FROM w GROUP BY 1""")
def candidate_reconcile(spark, d):
    urls = url_normalize(spark, d).join(url_scope(spark, d), "page_id")
    both = urls.select("page_id", "normalized", "reason", F.explode(F.array(F.lit(0), F.lit(1))).alias("m"))
    candidates = both.select((F.col("page_id") * 2 + F.col("m")).alias("ord"), F.when(F.col("m") == 0, "rss").otherwise("sitemap").alias("method"), F.col("normalized").alias("url"), F.col("reason").alias("scope"))
    return O.reconcile(candidates, urls.where("page_id % 7 = 0").select(F.col("normalized").alias("url"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"SELECT page_id AS url_id, normalized AS url, CAST(page_id % 4 AS INTEGER) AS depth, CAST(page_id % 11 AS INTEGER) AS priority, page_id % 5 > 0 AS enabled FROM ({NORMAL_URL}) ORDER BY enabled DESC, depth, priority DESC, url, url_id LIMIT 100")
def frontier_claim_topk(spark, d):
    rows = url_normalize(spark, d).select(F.col("page_id").alias("url_id"), F.col("normalized").alias("url"), (F.col("page_id") % 4).cast("int").alias("depth"), (F.col("page_id") % 11).cast("int").alias("priority"), (F.col("page_id") % 5 > 0).alias("enabled"))
    return O.frontier(rows, 100)


@query("SELECT source, doc_id, n_chars FROM (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) WHERE b < 50000")
def budget_truncate(spark, d):
    return O.within_budget(table(spark, d, "documents").select("source", "doc_id", "n_chars"), "source", "n_chars", ["doc_id"], 50_000)


@query("SELECT event_type, CAST(user_id % 10 AS BIGINT) AS origin, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1, 2")
def outcome_aggregates(spark, d):
    return table(spark, d, "events").groupBy("event_type", (F.col("user_id") % 10).cast("bigint").alias("origin")).agg(F.count("*").alias("n"), F.max("ts").alias("last_ts"))


@query("SELECT event_type, event_id, sample FROM (SELECT event_type, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS INTEGER) AS sample FROM events) WHERE sample <= 5")
def capped_samples(spark, d):
    return O.capped_samples(table(spark, d, "events").select("event_type", "event_id"), ["event_type"], ["event_id"], 5)


@query("WITH r AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, day, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS k FROM r) WHERE k <= 3")
def retain_last_runs(spark, d):
    runs = table(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").cast("string").alias("day")).agg(F.count("*").alias("n"))
    return O.retain_runs(runs, "user_id", [F.desc("day")], 3)


def _stats(name: str, tab: str, key: str) -> None:
    def run(spark, d):
        return table(spark, d, tab).where(f"{key} IS NOT NULL").groupBy(key).agg(F.count("*").alias("n"))

    run.__name__ = name
    query(f"SELECT {key}, count(*) AS n FROM {tab} WHERE {key} IS NOT NULL GROUP BY 1")(run)


for _name, _tab, _key in (("stats_event_type", "events", "event_type"), ("stats_source", "documents", "source"), ("stats_language", "documents", "lang"), ("stats_role", "conversations", "role"), ("stats_label", "labels", "quality"), ("stats_order_status", "orders", "o_orderstatus"), ("stats_segment", "customer", "c_mktsegment")):
    _stats(_name, _tab, _key)


@query("SELECT d.source, count(*) AS docs, CAST(count(l.doc_id) AS BIGINT) AS labelled, CAST(coalesce(sum(l.toxic), 0) AS BIGINT) AS toxic FROM documents AS d LEFT JOIN labels AS l USING (doc_id) GROUP BY 1")
def audit_labels(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").withColumn("has", F.lit(1)), "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("docs"), F.count("has").alias("labelled"), F.coalesce(F.sum("toxic"), F.lit(0)).cast("bigint").alias("toxic"))


STATUS = "CASE event_id % 9 WHEN 0 THEN 200 WHEN 1 THEN 304 WHEN 2 THEN 429 WHEN 3 THEN 403 WHEN 4 THEN 503 WHEN 5 THEN 202 WHEN 6 THEN 404 WHEN 7 THEN 410 ELSE 500 END"


def _fetches(spark, d):
    code = F.expr(STATUS)
    return table(spark, d, "events").select("event_id", code.alias("status"), (F.col("user_id") % 5).cast("int").alias("retries"), F.when(F.col("event_id") % 6 == 0, (F.col("event_id") % 600).cast("double")).alias("retry_after"))


@query(f"SELECT c AS category, count(*) AS n FROM (SELECT CASE WHEN s IN (200, 304) THEN 'SUCCESS' WHEN s = 429 THEN 'RATE_LIMITED' WHEN s = 403 THEN 'FORBIDDEN' WHEN s IN (202, 408, 425, 500, 502, 503, 504) THEN 'HTTP_TRANSIENT' ELSE 'HTTP_ERROR' END AS c FROM (SELECT {STATUS} AS s FROM events)) GROUP BY 1")
def http_categories(spark, d):
    return _fetches(spark, d).groupBy(S.http_category(F.col("status")).alias("category")).agg(F.count("*").alias("n"))


@query(f"""WITH f AS (SELECT event_id, {STATUS} AS s, CAST(user_id % 5 AS INTEGER) AS r, CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 600 AS DOUBLE) END AS a FROM events),
 t AS (SELECT *, s IN (202, 408, 425, 429, 500, 502, 503, 504) AS tr FROM f)
 SELECT event_id, CASE WHEN s IN (200, 304) THEN 'DOWNLOADED' WHEN tr AND r < 3 THEN 'RETRY_WAIT' WHEN tr THEN 'TERMINAL_FAILED' WHEN s = 403 AND r < 1 THEN 'RETRY_WAIT' WHEN s = 403 THEN 'BLOCKED' ELSE 'TERMINAL_FAILED' END AS state,
 CASE WHEN s IN (200, 304) THEN NULL WHEN tr AND r < 3 THEN 'http_transient' WHEN tr THEN 'retry_exhausted' WHEN s = 403 AND r < 1 THEN 'forbidden_retry' WHEN s = 403 THEN 'forbidden' ELSE 'http_permanent' END AS reason,
 CAST(CASE WHEN (tr AND r < 3) OR (s = 403 AND r < 1) THEN r + 1 ELSE r END AS INTEGER) AS retries,
 CASE WHEN tr AND r < 3 THEN greatest(least(CAST(2 * power(2, r) AS DOUBLE), 300.0), coalesce(a, 0.0)) WHEN s = 403 AND r < 1 THEN CASE WHEN a > 0 THEN a ELSE 3600.0 END END AS delay FROM t""")
def lifecycle_transition(spark, d):
    rows = _fetches(spark, d)
    return rows.select("event_id", S.next_state(F.col("status"), F.col("retries"), F.col("retry_after")).alias("x")).select("event_id", "x.*")


@query("SELECT user_id AS source_id, count(*) AS failures FROM events WHERE event_id % 9 = 3 GROUP BY 1 HAVING count(*) >= 5")
def source_cooldown(spark, d):
    return store.cooldowns(table(spark, d, "events").where("event_id % 9 = 3").select(F.col("user_id").alias("source_id")))


#: Of the URLs that events stand for, value is when a retry is due and 50 the time now.
NOW = 50


def _urls(spark, d):
    state = F.element_at(F.array(*map(F.lit, ("DISCOVERED", "RETRY_WAIT", "FAILED", "ACCEPTED"))), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("source_id"), state.alias("status"), F.col("value").alias("next_retry_at"), "ts")


@query("SELECT event_id FROM events WHERE (event_id % 4 = 0 OR (event_id % 4 = 1 AND (value IS NULL OR value <= 50))) AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 9 = 3 GROUP BY 1 HAVING count(*) >= 5)")
def due_work(spark, d):
    return store.due_urls(_urls(spark, d), source_cooldown(spark, d), NOW).select("event_id")


@query("SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN ts END, ts - INTERVAL 1 HOUR) AS stamp FROM events WHERE event_id % 4 = 2 AND coalesce(CASE WHEN event_id % 3 = 0 THEN ts END, ts - INTERVAL 1 HOUR) < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def stale_recovery(spark, d):
    e = table(spark, d, "events")
    stamp = F.coalesce(F.when(F.col("event_id") % 3 == 0, F.col("ts")), F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    latest = e.agg((F.max("ts") - F.expr("INTERVAL 1 HOUR")).alias("bound"))
    return e.where("event_id % 4 = 2").select("event_id", stamp.alias("stamp")).join(F.broadcast(latest), F.col("stamp") < F.col("bound")).select("event_id", "stamp")


@query("SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '1998-01-02' THEN 'date_in_future' WHEN o_orderdate < TIMESTAMP '1995-01-01' THEN 'date_before_cutoff' ELSE 'accepted' END AS reason FROM orders")
def date_gate(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.date_reason(F.col("o_orderdate"), F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz")).alias("reason"))


EVIDENCE = "SELECT o_orderkey AS item, 0 AS pos, 'rss' AS source, o_orderdate AS value, 0.85 AS confidence FROM orders UNION ALL SELECT l_orderkey, 1 + l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'html_meta' WHEN 1 THEN 'url' ELSE 'lastmod' END, l_shipdate, 0.5 + l_linenumber / 100.0 FROM lineitem"


@query(f"""WITH e AS ({EVIDENCE}), r AS (SELECT *, CASE source WHEN 'html_meta' THEN 1 WHEN 'rss' THEN 3 WHEN 'url' THEN 4 ELSE 99 END AS k,
 CASE WHEN value > TIMESTAMP '1998-01-02' THEN 'date_in_future' WHEN value < TIMESTAMP '1995-01-01' THEN 'date_before_cutoff' ELSE 'accepted' END AS reason FROM e WHERE source <> 'lastmod'),
 n AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY reason <> 'accepted', CASE WHEN reason = 'accepted' THEN k ELSE -k END, CASE WHEN reason = 'accepted' THEN -confidence ELSE confidence END, CASE WHEN reason = 'accepted' THEN pos ELSE -pos END, CASE WHEN reason = 'accepted' THEN value END, reason DESC, source DESC) AS i FROM r)
 SELECT item, CASE WHEN reason = 'accepted' THEN value END AS resolved, reason, source, CAST(CASE WHEN reason = 'accepted' THEN confidence ELSE 0 END AS DOUBLE) AS confidence FROM n WHERE i = 1""")
def date_evidence_resolve(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("item"), F.lit(0).alias("pos"), F.lit("rss").alias("source"), F.col("o_orderdate").alias("value"), F.lit(0.85).alias("confidence"))
    k = F.col("l_linenumber")
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"), (1 + k).alias("pos"), F.when(k % 3 == 0, "html_meta").when(k % 3 == 1, "url").otherwise("lastmod").alias("source"), F.col("l_shipdate").alias("value"), (0.5 + k / 100).alias("confidence"))
    return O.resolve_evidence(orders.unionByName(lines), F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz"))


@query("SELECT l_orderkey, l_linenumber, c_name, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'N' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-01-31' + INTERVAL 1 DAY")
def export_join(spark, d):
    o = table(spark, d, "orders").where("o_orderdate >= TIMESTAMP_NTZ'1996-01-01' AND o_orderdate < TIMESTAMP_NTZ'1996-02-01'")
    rows = table(spark, d, "lineitem").where("l_returnflag = 'N'").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("l_orderkey", "l_linenumber", "c_name", "o_orderdate")


@query("SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS sentence_count, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) THEN 'ACCEPTED' ELSE 'NO_SENTENCES' END AS status FROM orders")
def count_backfill(spark, d):
    articles = table(spark, d, "orders").select(F.col("o_orderkey").alias("article_id"))
    return store.counted_back(articles, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("article_id"))).select(F.col("article_id").alias("o_orderkey"), "sentence_count", "status")


@query("SELECT CAST(CAST(p AS DATE) AS VARCHAR) AS period, strftime(p, '%Y') AS yyyy, strftime(p, '%m') AS mm, strftime(p, '%d') AS dd, strftime(p, '%Y-%m-%d') AS date_iso FROM (SELECT unnest(generate_series(TIMESTAMP '2024-11-01', TIMESTAMP '2026-02-01', INTERVAL 1 MONTH)) AS p)")
def archive_periods(spark, d):
    return feeds.archive_periods(spark, "2024-11-15", "2026-02-03", "month").withColumn("period", F.col("period").cast("string"))


@query("SELECT conv_id, turn, user_turns FROM (SELECT conv_id, turn, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS user_turns FROM conversations)")
def running_counts(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(Window.partitionBy("conv_id").orderBy("turn")).alias("user_turns"))


@query()
def page_articles(spark, d):
    return html.extract_pages(table(spark, d, "pages")).select("page_id", "headline", "canonical", "date_source", "body", F.size("links").alias("n_links"))


@query()
def link_edges(spark, d):
    pages = html.extract_pages(table(spark, d, "pages"))
    links = pages.select("page_id", U.normalize_url(F.col("url")).alias("src"), F.explode("links").alias("l"))
    return links.where("l.href LIKE 'http%'").select("page_id", "src", U.normalize_url(F.col("l.href")).alias("dst"), "l.text").where("src <> dst").dropDuplicates(["src", "dst"])


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS src, unnest([n_nationkey * 2 + 1, n_nationkey * 2 + 2]) AS dst FROM nation),
 r AS (SELECT n_nationkey AS node, 0 AS depth FROM nation WHERE n_nationkey = 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 2)
 SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1""")
def bounded_reach(spark, d):
    n = table(spark, d, "nation")
    edges = n.select(F.col("n_nationkey").alias("src"), F.explode(F.array(F.col("n_nationkey") * 2 + 1, F.col("n_nationkey") * 2 + 2)).alias("dst"))
    return O.reachable(edges, n.where("n_nationkey = 0").select(F.col("n_nationkey").alias("node")), 2)


URL_OF_DAY = "concat('https://example.com/', {y}, '/', {m}, '/', {d}, '/item-', o_orderkey)"


@query(f"""SELECT o_orderkey, CAST(try_cast(concat_ws('-', nullif(regexp_extract(u, '(?:^|/)(20[0-9]{{2}})[-/](0?[1-9]|1[0-2])[-/](0?[1-9]|[12][0-9]|3[01])(?:/|$)', 1), ''), lpad(m, 2, '0'), lpad(d, 2, '0')) AS DATE) AS VARCHAR) AS url_date
 FROM (SELECT o_orderkey, u, CAST(month(o_orderdate) AS VARCHAR) AS m, CAST(day(o_orderdate) AS VARCHAR) AS d FROM (SELECT *, {URL_OF_DAY.format(y="year(o_orderdate) + 10", m="month(o_orderdate)", d="day(o_orderdate)")} AS u FROM orders))""")
def url_date(spark, d):
    # Ten years on, some 29ths of February don't exist.
    url = F.expr(URL_OF_DAY.format(y="year(o_orderdate) + 10", m="month(o_orderdate)", d="day(o_orderdate)"))
    return table(spark, d, "orders").select("o_orderkey", U.url_date(url).cast("string").alias("url_date"))


@query("SELECT event_id FROM events WHERE event_id % 4 IN (1, 2) AND user_id % 10 = 3 AND (value IS NULL OR value <= 50)")
def requeue_scope(spark, d):
    """Rows in RETRY_WAIT or FAILED of one source that are due."""
    scope = store.requeue_scope(_urls(spark, d).withColumn("source_id", F.col("source_id") % 10), NOW, source=3, due=True)
    return scope.select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def reclassify_zero(spark, d):
    """Accepted articles (status F) without a kept sentence (flag R)."""
    articles = table(spark, d, "orders").select(F.col("o_orderkey").alias("article_id"), F.when(F.col("o_orderstatus") == "F", "ACCEPTED").alias("status"))
    kept = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("article_id"))
    return store.without_sentences(articles, kept).select(F.col("article_id").alias("o_orderkey"))


@query(f"SELECT normalized AS url, bool_or(page_id % 2 = 0) AS configured, bool_or(page_id % 2 = 1 OR page_id % 6 = 0) AS declared FROM ({NORMAL_URL}) GROUP BY 1")
def merged_roots(spark, d):
    """Roots that are configured, declared by robots, or both, by normal form."""
    k = F.col("page_id")
    return store.merged_roots(url_normalize(spark, d).select(F.col("normalized").alias("url"), (k % 2 == 0).alias("configured"), ((k % 2 == 1) | (k % 6 == 0)).alias("declared")))


@query(f"SELECT normalized AS url, CAST(min(page_id % 4) AS INTEGER) AS depth, CAST(max(page_id % 11) AS INTEGER) AS priority, min(page_id) AS owner FROM ({NORMAL_URL}) GROUP BY 1")
def rediscovery_improvement(spark, d):
    """A URL found again keeps its owner, its smallest depth and its highest priority."""
    k = F.col("page_id")
    return store.rediscovered(url_normalize(spark, d).select(F.col("normalized").alias("url"), (k % 4).cast("int").alias("depth"), (k % 11).cast("int").alias("priority"), k.alias("owner")))


@query(f"SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source, {HASH} ORDER BY doc_id) AS n FROM documents) WHERE n > 1")
def pagination_loops(spark, d):
    """Pages (documents) whose body was met before in the same period (source)."""
    hashed = table(spark, d, "documents").select("source", "doc_id", T.content_hash(F.col("text")).alias("h"))
    return store.repeated(hashed, "source", "h", "doc_id")


RECONCILED = SQL["candidate_reconcile"]


@query(f"SELECT CAST(sum(CASE WHEN outcome = 'queued_new' THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS new_url, CAST(sum(CASE WHEN outcome LIKE 'duplicate%' THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS duplicate, 1 - CAST(sum(CASE WHEN outcome = 'rejected_scope' THEN n ELSE 0 END) AS DOUBLE) / sum(n) AS scope_acceptance FROM ({RECONCILED})")
def funnel_rates(spark, d):
    share = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).cast("double") / F.sum("n")
    out = F.col("outcome")
    return candidate_reconcile(spark, d).agg(share(out == "queued_new").alias("new_url"), share(out.startswith("duplicate")).alias("duplicate"), (F.lit(1) - share(out == "rejected_scope")).alias("scope_acceptance"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n <= 25")
def parent_quota(spark, d):
    return O.capped_samples(table(spark, d, "events").select("user_id", "event_id"), ["user_id"], ["event_id"], 25).drop("sample")


@query("""SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'blank' WHEN 2 THEN 'malformed' WHEN 3 THEN 'invalid' ELSE 'candidate' END AS outcome,
 CASE WHEN page_id % 5 IN (0, 4) THEN url WHEN page_id % 5 = 3 THEN '' END AS url FROM pages""")
def ndjson_index_parse(spark, d):
    k = F.col("page_id") % 5
    line = F.when(k == 1, " ").when(k == 2, F.concat(F.lit('{"url": "'), "url")).when(k == 3, '{"url": "", "status": "200"}').otherwise(F.to_json(F.struct("url", F.lit("200").alias("status"))))
    lines = table(spark, d, "pages").select("page_id", line.alias("value"))
    return lines.select("page_id", feeds.index_outcome(F.col("value")).alias("outcome"), F.try_variant_get(F.try_parse_json("value"), "$.url", "string").alias("url"))


def _xml(spark, d, body: str):
    """One document per page, with the page's URL as escaped text in it."""
    url = F.replace(F.replace(F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    before, after = body.split("URL")
    return table(spark, d, "pages").select("page_id", F.concat(F.lit(before), url, F.lit(after)).cast("binary").alias("content"))


@query("SELECT page_id, 'RSS' AS kind, 'A title' AS title, trim(url) AS url, TIMESTAMP '2026-08-11 04:00:00' AS published FROM pages")
def feed_parse(spark, d):
    rows = _xml(spark, d, "<rss version='2.0'><channel><item><title>A title</title><link>URL</link><pubDate>Tue, 11 Aug 2026 12:00:00 +0800</pubDate></item></channel></rss>")
    return feeds.read_feeds(rows, "page_id").select("page_id", "kind", F.explode("entries").alias("e")).select("page_id", "kind", "e.title", "e.url", "e.published")


@query("SELECT page_id, 'urlset' AS kind, trim(url) AS url, TIMESTAMP '2026-08-11' AS lastmod FROM pages")
def sitemap_parse(spark, d):
    rows = _xml(spark, d, "<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><url><loc>URL</loc><lastmod>2026-08-11</lastmod></url></urlset>")
    return feeds.read_sitemaps(rows, "page_id").select("page_id", "kind", F.explode("urls").alias("u")).select("page_id", "kind", "u.url", "u.lastmod")


@query()
def simhash64(spark, d):
    return O.simhashes(table(spark, d, "documents"), "doc_id", "text")


@query()
def crawl_flow(spark, d):
    """From fetched pages to the outcomes of their sentences; each page's source is its own host."""
    p = U.parts(F.col("url"))
    wanted = p["scheme"].isin("http", "https") & (p["netloc"] != "") & ~U.is_asset(p["path"], p["query"])
    articles = html.extract_pages(table(spark, d, "pages").where(wanted))
    docs = articles.select(F.col("page_id").alias("doc_id"), F.col("body").alias("text"), p["netloc"].alias("source"))
    return O.sentence_outcomes(O.sentence_rows(docs)).groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("pages"))
