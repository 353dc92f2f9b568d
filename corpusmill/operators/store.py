"""Operators over the stored tables: queue, recovery, requeueing, counts, retention and reports.

urls: url_id, url, source_id, status, depth, priority, retry_count, next_retry_at, processing_started_at, fetched_at,
discovered_at, discovery_method, http_status, error_reason; sources: source_id, status, cooldown_until; articles:
article_id, source_id, url_id, content_hash, publication_date; sentences: sentence_id, article_id, source_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tables of at most so many rows are sent to all tasks.
SMALL = 10_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df, to be broadcast if it's proven to have at most so many rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def blocked_sources(sources: DataFrame, now: Column) -> DataFrame:
    """Sources that are disabled, or cooling down beyond now."""
    return sources.where((F.col("status") == "DISABLED") | ((F.col("status") == "COOLDOWN") & (F.col("cooldown_until") > now))).select("source_id")


def expired_cooldowns(sources: DataFrame, now: Column) -> DataFrame:
    """sources as of now: a cooldown that has passed is over."""
    over = (F.col("status") == "COOLDOWN") & (F.col("cooldown_until") <= now)
    return sources.withColumn("status", F.when(over, "ACTIVE").otherwise(F.col("status"))).withColumn("cooldown_until", F.when(~F.coalesce(over, F.lit(False)), F.col("cooldown_until")))


def is_due(now: Column, retry: str = "next_retry_at") -> Column:
    return F.col(retry).isNull() | (F.col(retry) <= now)


def due_urls(urls: DataFrame, blocked: DataFrame, now: Column, source: str | None = None) -> DataFrame:
    """What may be fetched now: new URLs and retries that are due, of sources that aren't blocked."""
    open_ = (F.col("status") == "DISCOVERED") | ((F.col("status") == "RETRY_WAIT") & is_due(now))
    rows = urls.where(open_ if source is None else open_ & (F.col("source_id") == source))
    return rows.join(blocked.select("source_id").distinct(), "source_id", "left_anti")


def queued_count(urls: DataFrame) -> DataFrame:
    """n: how many URLs are new. Retries that are due don't count."""
    return urls.where("status = 'DISCOVERED'").agg(F.count("*").alias("n"))


def cooldowns(failures: DataFrame, threshold: int = 5) -> DataFrame:
    """source_id and failures of the sources with so many; failures: source_id."""
    return failures.groupBy("source_id").agg(F.count("*").alias("failures")).where(F.col("failures") >= threshold)


def stale(urls: DataFrame, before: Column) -> DataFrame:
    """Claims that an interrupted run left behind, with the stamp that tells."""
    stamp = F.coalesce("processing_started_at", "fetched_at", "discovered_at")
    return urls.where(F.col("status").isin("PROCESSING", "DOWNLOADED")).withColumn("stamp", stamp).where(F.col("stamp").isNull() | (F.col("stamp") <= before))


def recovered(urls: DataFrame, before: Column) -> DataFrame:
    """urls, with stale claims back in the queue."""
    stamp = F.coalesce("processing_started_at", "fetched_at", "discovered_at")
    hit = F.col("status").isin("PROCESSING", "DOWNLOADED") & (stamp.isNull() | (stamp <= before))
    marked = urls.withColumn("_hit", hit)
    return (
        marked.withColumn("status", F.when(F.col("_hit"), "RETRY_WAIT").otherwise(F.col("status")))
        .withColumn("error_reason", F.when(F.col("_hit"), "recovered_interrupted_processing").otherwise(F.col("error_reason")))
        .withColumn("next_retry_at", F.when(~F.col("_hit"), F.col("next_retry_at")))
        .withColumn("retry_count", F.coalesce("retry_count", F.lit(0)) + F.col("_hit").cast("int"))
        .drop("_hit")
    )


def requeue_scope(urls: DataFrame, now: Column, status: str | None = None, source: str | None = None, due: bool = False, include_terminal: bool = False, include_blocked: bool = False) -> DataFrame:
    """The URLs that a requeue would take. Terminal and blocked ones have to be asked for."""
    guarded = {"TERMINAL_FAILED": include_terminal, "BLOCKED": include_blocked}
    if status and not guarded.get(status.upper(), True):
        raise PermissionError(f"{status.upper()} isn't requeued unless it's included expressly")
    states = [status.upper()] if status else ["RETRY_WAIT", "FAILED", *(s for s, open_ in guarded.items() if open_)]
    rows = urls.where(F.col("status").isin(states))
    rows = rows.where(F.col("source_id") == source) if source else rows
    return rows.where(is_due(now)) if due else rows


def requeued(urls: DataFrame, scope: DataFrame) -> DataFrame:
    """urls, with those in scope new again."""
    marked = urls.join(scope.select("url_id", F.lit(True).alias("_hit")).distinct(), "url_id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    clear = [c for c in ("next_retry_at", "error_reason", "failure_class") if c in urls.columns]
    out = marked.withColumn("status", F.when(hit, "DISCOVERED").otherwise(F.col("status")))
    for c in clear:
        out = out.withColumn(c, F.when(~hit, F.col(c)))
    return out.select(urls.columns)


def reset_failed(urls: DataFrame) -> DataFrame:
    """urls, with all failed ones new again."""
    return requeued(urls, urls.where("status = 'FAILED'"))


def counted_back(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """articles with sentence_count and status: ACCEPTED with sentences, else NO_SENTENCES."""
    n = sentences.groupBy("article_id").agg(F.count("*").alias("_n"))
    joined = articles.join(n, "article_id", "left")
    return joined.withColumn("sentence_count", F.coalesce("_n", F.lit(0))).withColumn("status", F.when(F.col("_n") > 0, "ACCEPTED").otherwise("NO_SENTENCES")).drop("_n")


def without_sentences(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """Accepted articles none of whose sentences were kept."""
    return articles.where("status = 'ACCEPTED'").join(sentences.select("article_id"), "article_id", "left_anti")


def migration_counts(articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """step and rows: what a migration fills in and reclassifies."""
    filled = counted_back(articles.drop("sentence_count"), sentences).agg(F.count("*").alias("rows")).select(F.lit("backfilled").alias("step"), "rows")
    moved = without_sentences(articles, sentences).agg(F.count("*").alias("rows")).select(F.lit("reclassified").alias("step"), "rows")
    return filled.unionByName(moved)


def merged_roots(roots: DataFrame) -> DataFrame:
    """url, configured and declared of the roots by normal form; roots: url, configured, declared."""
    return roots.groupBy("url").agg(F.bool_or("configured").alias("configured"), F.bool_or("declared").alias("declared"))


def rediscovered(found: DataFrame) -> DataFrame:
    """url, depth, priority and owner: a URL found again keeps its owner, its smallest depth and highest priority."""
    return found.groupBy("url").agg(F.min("depth").alias("depth"), F.max("priority").alias("priority"), F.min("owner").alias("owner"))


def repeated(pages: DataFrame, group: str, key: str, order: str) -> DataFrame:
    """group and order of the pages whose key (URL or body hash) came before in the same group.

    The first is kept by a partial aggregate, so no window gathers a group.
    """
    first = pages.groupBy(group, key).agg(F.min(order).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return pages.join(first, [group, key]).where(F.col(order) != F.col("_first")).select(group, order)


def known_bodies(pages: DataFrame, articles: DataFrame) -> DataFrame:
    """The pages whose body is an article's already."""
    return pages.join(articles.select("content_hash"), "content_hash", "left_semi")


def with_sources(urls: DataFrame, sources: DataFrame) -> DataFrame:
    """urls with their sources' columns; sources are sent to all tasks if they're few."""
    return urls.join(small(sources), "source_id", "left")


def per_source(sources: DataFrame, articles: DataFrame, sentences: DataFrame) -> DataFrame:
    """source_id, articles and sentences of every source."""
    count = lambda df, name: df.groupBy("source_id").agg(F.count("*").alias(name))
    out = sources.select("source_id").join(count(articles, "articles"), "source_id", "left").join(count(sentences, "sentences"), "source_id", "left")
    return out.fillna(0, ["articles", "sentences"])


def stats(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """dimension, value and n for each named column of a table, nulls aside."""
    parts = [df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).select(F.lit(name).alias("dimension"), "value", "n") for name, (df, c) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def run_totals(events: DataFrame) -> DataFrame:
    """urls_discovered, urls_fetched, articles_extracted, sentences_accepted and sentences_rejected of each run; events: run_id, kind, n."""
    names = {"discovered": "urls_discovered", "claimed": "urls_discovered", "fetched": "urls_fetched", "extracted": "articles_extracted", "accepted": "sentences_accepted", "rejected": "sentences_rejected"}
    sums = [F.sum(F.when(F.col("kind").isin([k for k, v in names.items() if v == name]), F.col("n")).otherwise(0)).alias(name) for name in dict.fromkeys(names.values())]
    return events.groupBy("run_id").agg(*sums)


def newest(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The n rows that come last in order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def observed_runs(runs: DataFrame, observations: DataFrame, end: str = "end_time") -> DataFrame:
    """The runs that have observations, the last first."""
    return runs.join(observations.select("run_id"), "run_id", "left_semi").orderBy(F.desc(end), "run_id")


def source_ids(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [t.select("source_id") for t in tables]).distinct()


def outcomes(observations: DataFrame, keys: list[str], order: str, metadata: str | None = None) -> DataFrame:
    """keys, n and, of a map column, the last value of each name that isn't null."""
    n = observations.groupBy(*keys).agg(F.count("*").alias("n"))
    if metadata is None:
        return n
    values = observations.select(*keys, order, F.explode(metadata).alias("_name", "_value")).where("_value IS NOT NULL")
    last = values.groupBy(*keys, "_name").agg(F.max_by("_value", order).alias("_value"))
    maps = last.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_name", "_value")))).alias(metadata))
    on = reduce(lambda a, b: a & b, [n[k].eqNullSafe(maps[k]) for k in keys])
    return n.join(maps, on, "left").select(*[n[k] for k in keys], "n", metadata)


def funnel(outcomes_: DataFrame) -> DataFrame:
    """The five rates of a run, from totals (in_scope, unique, queued, duplicates, fetched, articles, accepted_articles, sentences)."""
    rate = lambda a, b: (F.col(a) / F.nullif(F.col(b), F.lit(0))).cast("double")
    return outcomes_.select(rate("in_scope", "unique").alias("scope_acceptance"), rate("queued", "unique").alias("new_url"), rate("duplicates", "unique").alias("duplicate"), rate("articles", "fetched").alias("article_success"), rate("sentences", "accepted_articles").alias("sentence_yield"))


def budget_use(used: DataFrame) -> DataFrame:
    """dimension and ratio of what was used to the limit; null for no limit."""
    return used.select("dimension", (F.col("used") / F.nullif(F.col("limit"), F.lit(0))).cast("double").alias("ratio"))
