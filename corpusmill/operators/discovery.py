"""Operators of discovery: links of pages, archive listings, sitemap indexes, and what they report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import url as U

COUNTERS = "anchors_seen links_considered links_skipped_by_page_limit links_skipped_by_depth normalization_successes normalization_failures unique_normalized duplicates accepted rejected accepted_unique rejected_unique candidates_emitted candidates_truncated parse_errors".split()


def judged_links(pages: DataFrame, scope, max_depth: int = 1, links_per_page: int = 500, allow_query: bool = False) -> DataFrame:
    """page_id, place, raw, text, rel, normalized, depth and outcome of every anchor.

    pages: page_id, requested, final, depth, links (href as written and resolved, text, rel); scope: Column -> Column,
    the reason that decides on a normal form. An outcome is skipped_depth, skipped_page_limit, invalid_url,
    unsupported_scheme, duplicate, self_link, query_parameters_disallowed, or the scope's reason.
    """
    rows = pages.select("page_id", "depth", F.array(U.normalize_url(F.col("requested")), U.normalize_url(F.col("final"))).alias("parents"), F.posexplode("links").alias("place", "l"))
    scheme = F.regexp_extract(F.lower(F.trim(F.col("l.raw"))), r"^([a-z][a-z0-9+.-]*):", 1)
    normal = U.normalize_url(F.col("l.href"))
    early = (
        F.when(F.col("depth") >= max_depth, "skipped_depth")
        .when(F.col("place") >= links_per_page, "skipped_page_limit")
        .when(F.trim(F.coalesce("l.raw", F.lit(""))) == "", "invalid_url")
        .when((scheme != "") & ~scheme.isin("http", "https"), "unsupported_scheme")
        .when(~U.parts(F.col("l.href"))["scheme"].isin("http", "https"), "unsupported_scheme")
        .when(normal == "", "invalid_url")
    )
    rows = rows.select("page_id", "place", (F.col("depth") + 1).alias("depth"), "parents", F.substring(F.trim("l.raw"), 1, 2000).alias("raw"), F.col("l.href").alias("href"), F.col("l.text").alias("text"), F.col("l.rel").alias("rel"), normal.alias("normalized"), early.alias("early"))
    # A page's links are a bounded list, so a window over a page holds no more than that.
    again = F.row_number().over(Window.partitionBy("page_id", "early", "normalized").orderBy("place")) > 1
    late = (
        F.when(again, "duplicate")
        .when(F.array_contains("parents", F.col("normalized")), "self_link")
        .when(U.disallowed_query(F.col("href"), allow_query), "query_parameters_disallowed")
        .otherwise(scope(F.col("normalized")))
    )
    return rows.withColumn("outcome", F.coalesce("early", late)).drop("parents", "href", "early")


def link_candidates(judged: DataFrame, priority: int = 100, most: int = 500) -> DataFrame:
    """The accepted links of each page with the context of their first anchor, ranked and cut."""
    rank = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("priority"), "normalized", "raw"))
    rows = judged.where("outcome = 'accepted'").select("page_id", "raw", "normalized", "depth", F.lit(priority).alias("priority"), "text", "rel")
    return rows.withColumn("rank", rank).where(F.col("rank") <= most)


def link_counters(judged: DataFrame, most: int = 500) -> DataFrame:
    """page_id and the counters of its links; unique = accepted + rejected of the normalised ones."""
    n = lambda c: F.count_if(c)
    out = F.col("outcome")
    early = out.isin("invalid_url", "unsupported_scheme")
    skipped = out.isin("skipped_depth", "skipped_page_limit")
    sums = {
        "anchors_seen": F.count("*"),
        "links_considered": n(~skipped),
        "links_skipped_by_page_limit": n(out == "skipped_page_limit"),
        "links_skipped_by_depth": n(out == "skipped_depth"),
        "normalization_successes": n(~skipped & ~early),
        "normalization_failures": n(early),
        "unique_normalized": n(~skipped & ~early & (out != "duplicate")),
        "duplicates": n(out == "duplicate"),
        "accepted": n(out == "accepted"),
        "rejected": n(~skipped & ~out.isin("duplicate", "accepted")),
    }
    rows = judged.groupBy("page_id").agg(*[c.alias(k) for k, c in sums.items()])
    rows = rows.withColumns({"accepted_unique": F.col("accepted"), "rejected_unique": F.col("unique_normalized") - F.col("accepted"), "candidates_emitted": F.least("accepted", F.lit(most)), "parse_errors": F.lit(0).cast("bigint")})
    return rows.withColumn("candidates_truncated", F.col("accepted") - F.col("candidates_emitted")).select("page_id", *COUNTERS)


def rejection_reasons(judged: DataFrame) -> DataFrame:
    """outcome and n of the rejected links, by name."""
    return judged.where(~F.col("outcome").isin("accepted", "duplicate", "skipped_depth", "skipped_page_limit")).groupBy("outcome").agg(F.count("*").alias("n")).orderBy("outcome")


def new_edges(links: DataFrame, stored: DataFrame) -> DataFrame:
    """src, dst and method of links not stored yet, without links to the page itself."""
    keys = ["src", "dst", "method"]
    return links.where("src <> dst").select(keys).distinct().join(stored.select(keys), keys, "left_anti")


def archive_outcomes(links: DataFrame, scope, stored: DataFrame, most: int) -> DataFrame:
    """links of archive listings with their outcome; links: source, ord, url; stored: url.

    out_of_scope, duplicate (stored, or met before) or added; a source's links after its last candidate are cut.
    """
    rows = links.withColumn("normalized", U.normalize_url(F.col("url"))).where("normalized <> ''").withColumn("reason", scope(F.col("normalized")))
    known = stored.select(F.col("url").alias("normalized"), F.lit(True).alias("_known")).distinct()
    first = rows.where("reason = 'accepted'").groupBy("normalized").agg(F.min("ord").alias("_first"))
    joined = rows.join(first, "normalized", "left").join(known, "normalized", "left")
    outcome = F.when(F.col("reason") != "accepted", "out_of_scope").when(F.col("_known") | (F.col("ord") > F.col("_first")), "duplicate").otherwise("added")
    added = F.sum((F.col("outcome") == "added").cast("int")).over(Window.partitionBy("source").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    return joined.withColumn("outcome", outcome).withColumn("_before", F.coalesce(added, F.lit(0))).where(F.col("_before") < most).select(*links.columns, "normalized", "outcome")


def archive_counters(outcomes: DataFrame) -> DataFrame:
    """links_found, links_added, duplicates and out_of_scope of each source."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    return outcomes.groupBy("source").agg(F.count("*").alias("links_found"), n("added").alias("links_added"), n("duplicate").alias("duplicates"), n("out_of_scope").alias("out_of_scope"))


def sitemap_documents(edges: DataFrame, roots: DataFrame, max_depth: int = 5, max_documents: int = 1000, max_roots: int = 20) -> DataFrame:
    """root, url and depth of the sitemap documents that roots lead to, each once, nearest roots first.

    edges: src, dst of index documents; roots: root, ord. Cycles end where a document was met before. The budget is
    shared: documents count in the order of root, depth and URL.
    """
    chosen = roots.orderBy("ord", "root").limit(max_roots)
    seen = chosen.select("root", "ord", F.col("root").alias("url"), F.lit(0).alias("depth"))
    for d in range(1, max_depth + 1):
        step = seen.where(F.col("depth") == d - 1).join(edges, F.col("url") == F.col("src")).select("root", "ord", F.col("dst").alias("url"), F.lit(d).alias("depth"))
        seen = seen.unionByName(step).groupBy("root", "ord", "url").agg(F.min("depth").alias("depth"))
    once = seen.groupBy("url").agg(F.min(F.struct("ord", "depth", "root")).alias("x")).select("url", "x.*")
    return once.orderBy("ord", "depth", "url").limit(max_documents).select("root", "url", "depth")


def root_audit(documents: DataFrame) -> DataFrame:
    """Of each root: origin, status, documents fetched, entries, accepted, rejected and dated entries.

    documents: root, configured, declared, status, entries, accepted, rejected, lastmod_dates, news_dates.
    """
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("entries", "accepted", "rejected", "lastmod_dates", "news_dates")]
    rows = documents.groupBy("root").agg(F.bool_or("configured").alias("c"), F.bool_or("declared").alias("d"), F.max("status").alias("status"), F.count("status").alias("documents_fetched"), *sums)
    origin = F.when(F.col("c") & F.col("d"), "configured+robots").when(F.col("d"), "robots").otherwise("configured")
    return rows.withColumn("origin", origin).drop("c", "d")
