"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared one that the cluster names in spark.checkpoint.dir.

    Only where that setting is absent and all runs on this machine a temporary folder is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/corpusmill-{uuid.uuid4().hex}"


#: While a table is written: Spark removes the execution's shuffle files as soon as it ends, and hands rows to
#: Python in small batches, of which both sides hold a few.
_FRUGAL = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Settings under which tables are written."""
    before = {k: spark.conf.get(k, None) for k in _FRUGAL}
    for k, v in _FRUGAL.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str = "table", **options: object) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends, and lost executors cost nothing.

    The table stands for the shuffles behind it, so their files go at once; otherwise they stay until the
    driver collects garbage.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}"
    with frugal(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if (made := _MADE.get()) is not None:
        made.append((path, out))
    return out


_MADE: ContextVar[list[tuple[str, DataFrame]] | None] = ContextVar("made", default=None)


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Tables written inside are deleted at the end, but for those put in the list this gives."""
    keep: list[DataFrame] = []
    mark = _MADE.set([])
    try:
        yield keep
    finally:
        made = _MADE.get()
        _MADE.reset(mark)
        for path, table in made:
            if not any(table is k for k in keep):
                where = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path).getParent()
                where.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def trim() -> None:
    """Return freed memory of this process to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 480_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about `most` bytes of text, one row at least.

    The temporary arrays of vectorised code then stay small however long the texts are. Workers are used
    again by later tasks, so what an earlier one has freed goes back to the system first, and again at the end.
    """
    trim()
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
    trim()


def partitions_for(total_bytes: float, each: int, least: int = 1) -> int:
    """How many partitions of about `each` bytes hold total_bytes."""
    return max(least, -(-int(total_bytes) // each))
