"""The commands of the engine as DataFrame plans: what each reads is given, what it would write is returned."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import status as S
from ..functions import text as T
from ..functions import url as U
from ..operators import corpus as O
from ..operators import discovery as D
from ..operators import store
from ..sources import feeds, html, sinks
from .config import PROFILES, Policy

#: The stored tables.
TABLES = {
    "sources": "source_id string, name string, domain string, status string, cooldown_until timestamp_ntz",
    "urls": "url_id string, url string, source_id string, status string, depth int, priority int, retry_count int, next_retry_at timestamp_ntz, processing_started_at timestamp_ntz, fetched_at timestamp_ntz, discovered_at timestamp_ntz, discovery_method string, http_status int, error_reason string, failure_class string, publication_date_hint timestamp_ntz, date_hint_source string",
    "articles": "article_id string, source_id string, url_id string, url string, canonical_url string, headline string, author string, publication_date timestamp_ntz, date_source string, modified_date timestamp_ntz, content_hash string, sentence_count bigint, status string",
    "sentences": "sentence_id string, article_id string, source_id string, sentence_text string, normalized_text string, sentence_index int, paragraph_index int, is_quote boolean, token_count int, quality_score double, language string, language_confidence double, content_hash string, is_duplicate boolean",
    "edges": "src string, dst string, method string",
    "runs": "run_id string, source_id string, start_time timestamp_ntz, end_time timestamp_ntz",
    "observations": "run_id string, seq bigint, discovery_method string, root_url string, outcome string, reason string, http_status int, metadata map<string, string>",
}


def init_tables(spark: SparkSession, path: str) -> list[str]:
    """Create the stored tables that aren't there; their names."""
    made = []
    for name, schema in TABLES.items():
        try:
            spark.read.parquet(f"{path}/{name}")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            spark.createDataFrame([], schema).write.parquet(f"{path}/{name}")
            made.append(name)
    return made


def discover(documents: DataFrame, sources: DataFrame, stored: DataFrame, cutoff: Column, as_of: Column) -> DataFrame:
    """The candidates of fetched feeds and sitemaps with their outcome.

    documents: root, ord, source_id, kind (feed or sitemap), content; sources: as config.sources_table gives them;
    stored: url.
    """
    feed = feeds.read_feeds(documents.where("kind = 'feed'")).select("root", F.lit("RSS").alias("method"), F.posexplode("entries").alias("place", "e"))
    sitemap = feeds.read_sitemaps(documents.where("kind = 'sitemap'")).select("root", F.lit("SITEMAP").alias("method"), F.posexplode("urls").alias("place", "e"))
    none = F.lit(None).cast("timestamp_ntz")
    rows = feed.select("root", "method", "place", "e.url", F.col("e.published").alias("hint"), none.alias("lastmod")).unionByName(sitemap.select("root", "method", "place", "e.url", F.col("e.published").alias("hint"), "e.lastmod"))
    placed = rows.join(documents.select("root", "ord", "source_id"), "root").withColumn("url", U.normalize_url(F.col("url")))
    scoped = store.with_sources(placed, sources.select("source_id", "domain", "prefix", "patterns", "landing", "siblings"))
    judged = scoped.withColumn("scope", U.scope_reason_by_row(F.col("url"))).withColumn("date_reason", F.when(F.col("hint").isNotNull(), S.date_reason(F.col("hint"), cutoff, as_of)))
    # Arrival order: documents by their place, entries within.
    ordered = judged.withColumn("ord", F.struct("ord", "place", "root", "method"))
    return O.reconcile(ordered.select("ord", "method", "url", "scope", "date_reason", "source_id", "hint", "lastmod"), stored)


def counters(outcomes: DataFrame) -> DataFrame:
    """seen, invalid, duplicates, unique, accepted, rejected, queued_new and already_stored of candidates with outcomes."""
    n = lambda *names: F.count_if(F.col("outcome").isin(*names))
    rejected, accepted = ("rejected_scope", "rejected_date_hint"), ("queued_new", "already_stored")
    return outcomes.agg(F.count("*").alias("seen"), n("invalid").alias("invalid"), n("duplicate_in_run", "duplicate_cross_method").alias("duplicates"), n(*rejected, *accepted).alias("unique"), n(*accepted).alias("accepted"), n(*rejected).alias("rejected"), n("queued_new").alias("queued_new"), n("already_stored").alias("already_stored"))


def audit_discovery(documents: DataFrame, urls: DataFrame, observations: DataFrame) -> dict[str, DataFrame]:
    """roots, stored (counts by source, method and status) and observations (the last first)."""
    return {
        "roots": D.root_audit(documents),
        "stored": urls.groupBy("source_id", "discovery_method", "status").agg(F.count("*").alias("n")),
        "observations": observations.orderBy(F.desc("seq")),
    }


def audit_link_frontier(pages: DataFrame, source: U.Source, max_depth: int = 1, links_per_page: int = 500, most: int = 500, priority: int = 100) -> dict[str, DataFrame]:
    """candidates, counters and reasons of the links of pages (page_id, url, html)."""
    found = html.extract_pages(pages)
    links = F.transform("links", lambda x: F.struct(x["href"].alias("raw"), x["href"].alias("href"), x["text"].alias("text"), x["rel"].alias("rel")))
    rows = found.select("page_id", F.col("url").alias("requested"), F.col("url").alias("final"), F.lit(0).alias("depth"), links.alias("links"))
    judged = D.judged_links(rows, lambda c: U.scope_reason(c, source), max_depth, links_per_page)
    return {"candidates": D.link_candidates(judged, priority, most), "counters": D.link_counters(judged, most), "reasons": D.rejection_reasons(judged)}


def crawl(fetched: DataFrame, sources: DataFrame, articles: DataFrame, cutoff: Column, as_of: Column, policy: Policy | None = None) -> dict[str, DataFrame]:
    """articles (each fetched page's next state) and sentences (each with its outcome) of fetched pages.

    fetched: page_id, url, source_id, status, retries, retry_after, html, rss_date, lastmod; articles: content_hash.
    A body that an article or an earlier page has is known: its page is accepted, its sentences aren't cut again.
    """
    policy = policy or PROFILES["default"]
    known = store.with_sources(fetched, sources.select("source_id", "body_selector", "date_selector"))
    state = S.next_state(F.col("status"), F.col("retries"), F.col("retry_after"))
    pages = known.withColumn("next", state)
    got = html.extract_pages(pages.where("next.state = 'DOWNLOADED'")).drop("links", "url")
    rows = pages.drop("html", "body_selector", "date_selector").join(got, "page_id", "left")
    dates = S.evidence(S.parse_date(F.col("published")), F.concat(F.lit("html_"), F.col("date_source")), F.lit(None), F.col("rss_date"), U.url_date(F.col("url")), F.lit(None), F.col("lastmod"), F.lit(None))
    items = rows.select(F.col("page_id").alias("item"), F.posexplode(dates).alias("pos", "e")).select("item", "pos", "e.source", "e.value", "e.confidence")
    resolved = O.resolve_evidence(items, cutoff, as_of).select(F.col("item").alias("page_id"), "resolved", F.col("reason").alias("date_reason"), F.col("source").alias("date_origin"))
    rows = rows.join(resolved, "page_id", "left").withColumn("content_hash", F.when(F.coalesce("body", F.lit("")) != "", T.content_hash(F.col("body"))))
    first = rows.where("content_hash IS NOT NULL").groupBy("content_hash").agg(F.min("page_id").alias("_first"))
    seen = articles.select("content_hash", F.lit(True).alias("_known")).distinct()
    rows = rows.join(first, "content_hash", "left").join(seen, "content_hash", "left")
    again = F.col("_known") | (F.col("page_id") != F.col("_first"))
    outcome = (
        F.when(F.col("next.state") != "DOWNLOADED", F.col("next.state"))
        .when(F.coalesce("body", F.lit("")) == "", "NO_CONTENT")
        .when(F.coalesce("date_reason", F.lit("date_missing")) != "accepted", "REJECTED_DATE")
        .when(F.coalesce(again, F.lit(False)), "ACCEPTED")
        .otherwise("EXTRACTED")
    )
    done = rows.withColumn("outcome", outcome).drop("_first", "_known")
    texts = done.where("outcome = 'EXTRACTED'").select(F.col("page_id").alias("doc_id"), F.col("body").alias("text"), F.col("source_id").alias("source"))
    limits = asdict(policy)
    sentences = O.sentence_outcomes(O.sentence_rows(texts), low=limits["min_tokens"], high=limits["max_tokens"], quotes=limits["include_quotes"], headlines=limits["include_headlines"], least_score=limits["min_quality_score"], languages=list(policy.accepted_languages), min_confidence=policy.min_confidence, allow_mixed=policy.allow_mixed)
    kept = sentences.where("outcome = 'accepted'").groupBy(F.col("doc_id").alias("page_id")).agg(F.count("*").alias("sentence_count"))
    final = done.join(kept, "page_id", "left").withColumn("sentence_count", F.coalesce("sentence_count", F.lit(0)))
    status = F.when(F.col("outcome") == "EXTRACTED", F.when(F.col("sentence_count") > 0, "ACCEPTED").otherwise("NO_SENTENCES")).otherwise(F.col("outcome"))
    return {"articles": final.withColumn("outcome", status), "sentences": sentences}


def rejections(sentences: DataFrame) -> DataFrame:
    """total_candidates and how many sentences each leg rejected: quality, quote, headline, language, duplicates."""
    return rejection_legs(sentences.groupBy("outcome").agg(F.count("*").alias("n")))


def rejection_legs(counts: DataFrame) -> DataFrame:
    """As rejections, of the outcomes' counts (outcome, n)."""
    o, n = F.col("outcome"), lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0).cast("bigint"))
    own = {"quote": "quote_excluded", "headline": "headline_excluded", "language": "language", "duplicate_batch": "duplicate_batch", "duplicate_db": "duplicate_db"}
    legs = [n(o == v).alias(k) for k, v in own.items()]
    return counts.agg(n(F.lit(True)).alias("total_candidates"), n(~o.isin("accepted", *own.values())).alias("quality"), *legs, n(o == "accepted").alias("accepted"))


def export(spark: SparkSession, tables: dict[str, DataFrame], path: str, kind: str = "jsonl", start=None, end=None, source: str | None = None, append: bool = False) -> None:
    """Write accepted sentences as JSON lines or CSV."""
    rows = sinks.export_rows(tables["sentences"], tables["articles"], tables["sources"].select("source_id", "name"), start, end, source)
    if kind == "jsonl":
        sinks.write_jsonl(sinks.jsonl_rows(rows), path)
    else:
        sinks.write_csv(sinks.csv_rows(rows), path, append)


def requeue(urls: DataFrame, now: Column, execute: bool = False, **scope) -> tuple[DataFrame, DataFrame]:
    """The URLs a requeue takes, and the table after it (as it was, unless execute)."""
    taken = store.requeue_scope(urls, now, **scope)
    return taken, store.requeued(urls, taken) if execute else urls


def stats(urls: DataFrame, articles: DataFrame, observations: DataFrame) -> DataFrame:
    """dimension, value and n of the stored tables."""
    return store.stats({"status": (urls, "status"), "source": (urls, "source_id"), "method": (urls, "discovery_method"), "http_status": (urls, "http_status"), "error": (urls, "error_reason"), "date_source": (articles, "date_source"), "outcome": (observations, "outcome")})


def evaluate_policy(documents: DataFrame, newest: int | None = None, order: str = "doc_id") -> DataFrame:
    """What each profile would accept of the sentences of the newest documents."""
    docs = documents if newest is None else store.newest(documents, [order], newest)
    limits = {n: (p.min_tokens, p.max_tokens, p.include_quotes, p.include_headlines, p.min_quality_score) for n, p in PROFILES.items()}
    totals = O.policy_totals(O.sentence_rows(docs), limits)
    return totals.withColumn("balanced", F.assert_true(F.col("candidates") == F.col("accepted") + F.col("rejected")).isNull()).drop("balanced")
