"""Exports: JSON lines and CSV, and idempotent appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_rows(sentences: DataFrame, articles: DataFrame, sources: DataFrame, start=None, end=None, source: str | None = None) -> DataFrame:
    """Accepted sentences with article and source; a bare end date counts as the whole day."""
    kept = sentences.where("language = 'FILIPINO' AND NOT is_duplicate")
    kept = kept.where(F.col("source_id") == source) if source and "source_id" in sentences.columns else kept
    own = [c for c in articles.columns if c == "article_id" or c not in sentences.columns]
    rows = kept.join(articles.select(own), "article_id").join(sources, "source_id")
    if start is not None:
        rows = rows.where(F.col("publication_date") >= F.lit(start))
    if end is not None:
        bound = F.lit(end).cast("timestamp_ntz")
        midnight = F.date_trunc("day", bound) == bound
        rows = rows.where(F.when(midnight, F.col("publication_date") < bound + F.expr("INTERVAL 1 DAY")).otherwise(F.col("publication_date") <= bound))
    return rows


def jsonl_rows(rows: DataFrame) -> DataFrame:
    """The ten fields of a JSON line; rows: as export_rows gives them, with the source's name."""
    day = F.date_format("publication_date", "yyyy-MM-dd").alias("publication_date")
    return rows.select("sentence_id", F.col("sentence_text").alias("sentence"), F.col("name").alias("source"), "article_id", day, "date_source", "url", "canonical_url", "language", "language_confidence")


def csv_rows(rows: DataFrame) -> DataFrame:
    """The nineteen columns of a CSV export; what may be missing is empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    day = F.coalesce(F.date_format("publication_date", "yyyy-MM-dd"), F.lit("")).alias("publication_date")
    return rows.select(
        "sentence_id", F.col("sentence_text").alias("sentence"), F.col("normalized_text").alias("normalized_sentence"), F.col("name").alias("source_name"), "source_id", "article_id", text("headline"), text("author"), day,
        "url", "language", "language_confidence", "token_count", "quality_score", "paragraph_index", "sentence_index", F.col("is_quote").cast("int").alias("is_quote"), text("date_source"), text("canonical_url"),
    )


def versioned(path: str, at) -> str:
    """stem_YYYY-MM-DDTHHMMSS.suffix of an output path."""
    head, dot, tail = path.rpartition(".")
    stamp = at.strftime("%Y-%m-%dT%H%M%S")
    return f"{head}_{stamp}.{tail}" if dot and "/" not in tail else f"{path}_{stamp}"


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls written, over what was there."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """CSV part files, each with a header, so that any of them can be read alone; readers set header."""
    df.write.mode("append" if append else "overwrite").option("header", "true").option("emptyValue", "").option("quoteAll", "false").csv(path)


def new_rows(incoming: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """The incoming rows whose key isn't stored, one for each key."""
    return incoming.dropDuplicates(list(keys)).join(stored.select(*keys), list(keys), "left_anti")
