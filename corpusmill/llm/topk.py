"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors become integers, floor(256 * x). Candidates are dealt to blocks. In a block the postings of a
component are quantised by magnitude into levels, a segment for each level and component, and searched
from the highest level down for a whole block of queries. After a level, what a candidate's unread
postings can still add is at most the query's length times the length of the candidate's unread rest
(Cauchy-Schwarz). The search of a block stops only when that bound proves, for each query, which
candidates may still be among its k best; those are scored exactly, and the blocks' best are merged.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no part;
missing components of a shorter vector count as 0; a query has no row for itself, that is for its own
vec_id; repeated query rows are answered once, repeated candidate rows each count; null ids take no part.
Components are 64-bit integers after scaling and scores are exact; a query that fails to fit (a component of
2**53 or more after scaling, a score beyond 64 bits) raises an error rather than giving a wrong score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

LEVELS = 5
#: So many queries are searched at once, so that their scores in a block take little memory.
_AT_ONCE = 256
_INDEX = "block int, ids binary, dims int, level array<int>, rows array<binary>, columns array<binary>, impacts array<binary>"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and the integer components of the vectors that take part."""
    whole = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v")).where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    sound = whole.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    scaled = sound.select("vec_id", F.transform("v", lambda x: F.floor(x * 256)).alias("v"))
    fits = F.forall("v", lambda x: F.abs(x) < 1 << 53)
    return scaled.select("vec_id", F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit("a vector's components exceed 2**53 after scaling"))).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.to_pylist()
    out = np.zeros((len(lists), max(map(len, lists), default=0)), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """One row per block of candidates: its segments, highest impact first."""

    def build(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("v").combine_chunks())
        size = np.abs(x)
        top = int(size.max(initial=1)).bit_length()  # floats hold sizes under 2**53 exactly
        level = np.maximum(0, np.ceil(np.log2(np.maximum(size, 1) + 0.5)).astype(int) - (top - LEVELS + 1))  # by powers of two, the low ones together
        out = {k: [] for k in ("level", "rows", "columns", "impacts")}
        for k in range(level.max(initial=0), -1, -1):
            column, row = np.nonzero(((level == k) & (size > 0)).T)  # ordered by component
            out["level"].append(k)
            out["rows"].append(row.astype("<i4").tobytes())
            out["columns"].append(column.astype("<i4").tobytes())
            out["impacts"].append(x[row, column].astype("<i8").tobytes())
        ids = np.array(table.column("vec_id").to_pylist(), "<i8").tobytes()
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "ids": [ids], "dims": pa.array([x.shape[1]], pa.int32()), **{k: [v] for k, v in out.items()}}).cast(_schema())

    return vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(build, _INDEX)


def _schema() -> pa.Schema:
    lists = pa.list_(pa.binary())
    return pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("dims", pa.int32()), ("level", pa.list_(pa.int32())), ("rows", lists), ("columns", lists), ("impacts", lists)])


def _products(queries: np.ndarray, x: np.ndarray, q_at: np.ndarray, c_at: np.ndarray) -> np.ndarray:
    """The integer inner products of pairs of rows."""
    most = np.sqrt((queries.astype(float) ** 2).sum(axis=1)).max(initial=0) * np.sqrt((x.astype(float) ** 2).sum(axis=1)).max(initial=0)
    if most < 2**52:  # no partial sum is longer, so doubles hold each
        return np.einsum("ij,ij->i", queries.astype(float)[q_at], x.astype(float)[c_at]).astype(np.int64)
    if most < 2**62:
        return np.einsum("ij,ij->i", queries[q_at], x[c_at])
    sums = [sum(a * b for a, b in zip(queries[q].tolist(), x[c].tolist(), strict=True)) for q, c in zip(q_at.tolist(), c_at.tolist(), strict=True)]
    return np.array(sums, object).astype(np.int64) if all(-(1 << 63) <= s < 1 << 63 for s in sums) else _overflow()


def _overflow():
    raise OverflowError("a score exceeds 64 bits")


def _numbers(value: pa.Scalar, kind: str) -> np.ndarray:
    """The numbers in a binary value, without a copy."""
    return np.frombuffer(value.as_buffer(), kind)


def search_block(queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, segments: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query positions, candidate positions and scores of each query's k best of one block; and the levels read."""
    whole, queries = queries, queries.astype(float)
    dims, n = queries.shape[1], len(ids)
    x = np.zeros((n, dims), np.int64)
    length = np.sqrt((queries**2).sum(axis=1))
    rest = np.zeros(n)
    for row, _, impact in segments:
        rest += np.bincount(row, impact.astype(float) ** 2, n)
    rounding = 4e-16 * (dims + len(segments)) * np.sqrt(rest)  # of a score, for a query of length 1
    fading = 4e-16 * (dims + len(segments)) * rest  # of a rest
    own = query_ids[:, None] == ids[None, :]
    score = np.zeros((len(queries), n))
    read = 0
    possible = ~own
    for row, column, impact in segments:
        if read and (possible.sum(axis=1) <= max(4 * k, n // 50)).all():
            break
        x[row, column] = impact
        touched = np.unique(row)
        part = np.zeros((len(touched), dims))
        part[np.searchsorted(touched, row), column] = impact
        score[:, touched] += queries @ part.T
        rest = np.maximum(0, rest - np.bincount(row, impact.astype(float) ** 2, n))
        slack = length[:, None] * (np.sqrt(rest + fading) + rounding)[None, :] * (1 + 1e-9) + 1e-6
        low = np.where(own, -np.inf, score - slack)
        bar = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(queries), -np.inf)
        possible = ~own & (score + slack >= bar[:, None])
        read += 1
    for row, column, impact in segments[read:]:  # the rest of the postings, for exact scores of possible members
        x[row, column] = impact
    q_at, c_at = np.nonzero(possible)
    exact = _products(whole, x, q_at, c_at)
    order = np.lexsort((ids[c_at], -exact, q_at))
    q_at, c_at, exact = q_at[order], c_at[order], exact[order]
    place = np.arange(len(q_at)) - np.searchsorted(q_at, q_at)
    best = place < k
    return q_at[best], c_at[best], exact[best], read


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = 8192, query_rows: int = 1024) -> DataFrame:
    """query_id, rank, vec_id and score: the k best candidates of each query among all vectors."""
    candidates = written(usable(vectors), "vectors")
    asked = written(usable(queries).dropDuplicates(["vec_id", "v"]), "queries")
    blocks = max(1, -(-candidates.count() // block_rows))
    query_blocks = max(1, -(-asked.count() // query_rows))
    # Readers hold a file's blocks at once, so a file has few.
    index = written(build_index(candidates, blocks), "index", maxRecordsPerFile=4)

    def bundle(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("v").combine_chunks()).astype("<i8")
        ids = np.array(table.column("vec_id").to_pylist(), "<i8")
        return pa.table({"query_block": pa.array([table.column("query_block")[0].as_py()], pa.int32()), "query_ids": [ids.tobytes()], "query_dims": pa.array([x.shape[1]], pa.int32()), "queries": [x.tobytes()]})

    bundles = asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).groupBy("query_block").applyInArrow(bundle, "query_block int, query_ids binary, query_dims int, queries binary")
    # A task reads some of these files whole; one bundle a file lets it take few.
    bundles = written(bundles, "bundles", maxRecordsPerFile=1)
    # The stated query set against all rows, in blocks: each bundle of queries visits each block of the index. Tasks read
    # both from their files; a join on block numbers would shuffle all visits, or broadcast them through the driver,
    # as Spark takes them to be as small as the file of the queries.
    visits = index.crossJoin(bundles.hint("shuffle_replicate_nl"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: column[i] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                qd, d = r["query_dims"].as_py(), r["dims"].as_py()
                ids, query_ids = _numbers(r["ids"], "<i8"), _numbers(r["query_ids"], "<i8")
                q = np.zeros((len(query_ids), max(qd, d)), np.int64)
                q[:, :qd] = _numbers(r["queries"], "<i8").reshape(-1, qd)
                segments = [tuple(_numbers(b, kind) for b, kind in zip(s, ("<i4", "<i4", "<i8"), strict=True)) for s in zip(r["rows"].values, r["columns"].values, r["impacts"].values, strict=True)]
                for at in range(0, len(q), _AT_ONCE):
                    some = query_ids[at : at + _AT_ONCE]
                    q_at, c_at, score, _ = search_block(q[at : at + _AT_ONCE], some, ids, segments, k)
                    yield pa.RecordBatch.from_arrays([pa.array(some[q_at]), pa.array(ids[c_at]), pa.array(score)], names=["query_id", "vec_id", "score"])

    found = visits.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
