"""Token counts through a digest cache.

A text's count depends on its content and on the tokenizer's version only. The cache is a table of
(tokenizer digest, content digest, count). Documents join it on both digests; of those that miss, one
text per distinct digest is encoded, and the new counts are appended.

Content is normalised by taking null as empty and nothing more, since any other change could change the
count. Appends are atomic by Spark's commit protocol. Writers that append at the same time may both store a
digest, with the same count; it's read once.

Defined cases: a null text has the digest and the count of the empty one (0); equal texts share one
entry; a null doc_id is kept; an empty table gives no row; other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, whole_text, work_dir, written
from .encoding import PieceEncoder, file_digest

CACHE = "tokenizer string, digest binary, n_tokens bigint"


def _stored(spark, cache_path: str, version: str) -> DataFrame | None:
    """What the cache holds for this version; None where there's no cache yet."""
    try:
        table = spark.read.schema(CACHE).parquet(cache_path)
        table.schema  # noqa: B018
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return table.where(F.col("tokenizer") == version).select(F.col("digest").alias("_digest"), "n_tokens")


def extend_cache(docs: DataFrame, tokenizer_path: str, cache_path: str) -> None:
    """Encode the distinct contents that the cache lacks and append their counts."""
    spark, version = docs.sparkSession, file_digest(tokenizer_path)
    texts = docs.select(whole_text().alias("text")).withColumn("_digest", F.unhex(F.sha2("text", 256)))
    if (stored := _stored(spark, cache_path, version)) is not None:
        texts = texts.join(stored.select("_digest"), "_digest", "left_anti")
    missing = texts.dropDuplicates(["_digest"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer_path)
        for batch in text_slices(batches, "text"):
            counts = [encoder.count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(counts)), batch.column("_digest"), pa.array(counts, pa.int64())], names=["tokenizer", "digest", "n_tokens"])

    missing.select("text", "_digest").mapInArrow(encode, CACHE).write.mode("append").parquet(cache_path)


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    spark = docs.sparkSession
    cache_path = cache_path or f"{work_dir(spark)}/token-cache"
    extend_cache(docs, tokenizer_path, cache_path)
    keys = docs.select("doc_id", whole_text().alias("_text")).select("doc_id", F.octet_length("_text").cast("bigint").alias("n_bytes"), F.unhex(F.sha2("_text", 256)).alias("_digest"))
    stored = _stored(spark, cache_path, file_digest(tokenizer_path))
    counts = written(stored.groupBy("_digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return keys.join(counts, "_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
