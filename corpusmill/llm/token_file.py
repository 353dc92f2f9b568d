"""Token-ID binary output: patched frame-of-reference blocks.

A segment image holds the ids of consecutive documents. Ids are cut into blocks of 256. Each block
subtracts its minimum, packs the rests at the width that a percentile of them needs (made even, and over
16 a multiple of 4, so that words end on bytes), and stores the rests that are wider in an exception list. An index of block starts closes the image, so that any id can
be reached by decoding one block.

    image  = b"PFR1", u32 ids, u32 blocks, block*, u32 block start * blocks
    block  = u32 minimum, u16 exceptions, u8 width, packed rests (256 * width bits),
             u8 position * exceptions, u32 rest * exceptions

Images travel as binary rows of a Spark-written table, which reaches any store that Spark can write.

Defined cases: a null text counts as empty; every document has at least its end id; a null doc_id sorts
first; rows with the same doc_id are ordered by a hash of the text, then by the text (so that many of them
spread over the partitions); an empty table gives no segment and no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frugal, partitions_for, text_slices, whole_text, work_dir
from .encoding import bulk_encoder

BLOCK = 256
MAGIC = b"PFR1"


def _bits(x: np.ndarray) -> np.ndarray:
    """How many bits each value needs."""
    return np.frexp(x.astype(np.float64))[1]


def _words(rest: np.ndarray, w: int) -> np.ndarray:
    """Rows of values packed at w bits: four (over 16 bits, two) share a little-endian word."""
    share = 4 if w <= 16 else 2
    mask, words = np.uint64((1 << w) - 1), np.zeros((len(rest), BLOCK // share), np.uint64)
    for j in range(share):
        words |= (rest[:, j::share].astype(np.uint64) & mask) << np.uint64(j * w)
    return np.ascontiguousarray(words.view(np.uint8).reshape(len(rest), -1, 8)[:, :, : share * w // 8]).reshape(len(rest), -1)


def _values(lines: np.ndarray, w: int) -> np.ndarray:
    """The inverse of _words."""
    share = 4 if w <= 16 else 2
    room = np.zeros((len(lines), BLOCK // share, 8), np.uint8)
    room[:, :, : share * w // 8] = lines.reshape(len(lines), BLOCK // share, -1)
    words, out = room.view("<u8")[:, :, 0], np.empty((len(lines), BLOCK), np.uint32)
    for j in range(share):
        out[:, j::share] = (words >> np.uint64(j * w)) & np.uint64((1 << w) - 1)
    return out


def pack(ids: np.ndarray, percentile: float = 90.0) -> bytes:
    """The image of a uint32 array."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not n:
        return MAGIC + np.array([0, 0], "<u4").tobytes()
    grid = np.concatenate((ids, np.full(blocks * BLOCK - n, ids[-1]))).astype(np.uint32).reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    k = min(BLOCK - 1, int(BLOCK * percentile / 100))
    width = _bits(np.partition(rest, k, axis=1)[:, k])
    width = np.where(width <= 16, width + width % 2, width + -width % 4).astype(np.uint8)
    wide = rest > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    spare = wide.sum(axis=1).astype(np.uint16)
    bodies: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            lines = _words(rest[rows], int(w))
            for i, line in zip(rows.tolist(), lines, strict=True):
                bodies[i] = line.tobytes()
    where, column = np.nonzero(wide)
    bounds = np.searchsorted(where, np.arange(blocks + 1))
    column, values = column.astype(np.uint8), rest[wide].astype("<u4")
    out, starts, at = [MAGIC + np.array([n, blocks], "<u4").tobytes()], [], 12
    heads = np.rec.fromarrays([low.astype("<u4"), spare.astype("<u2"), width], dtype=np.dtype([("a", "<u4"), ("b", "<u2"), ("c", "u1")]))
    for i in range(blocks):
        a, b = bounds[i], bounds[i + 1]
        block = heads[i : i + 1].tobytes() + bodies[i] + column[a:b].tobytes() + values[a:b].tobytes()
        starts.append(at)
        out.append(block)
        at += len(block)
    return b"".join(out) + np.array(starts, "<u4").tobytes()


def unpack(image: bytes) -> np.ndarray:
    """The uint32 array of an image."""
    if image[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, blocks = np.frombuffer(image, "<u4", 2, 4).tolist()
    if not n:
        return np.empty(0, np.uint32)
    starts = np.frombuffer(image, "<u4", blocks, len(image) - 4 * blocks).astype(np.int64)
    raw = np.frombuffer(image, np.uint8)
    head = raw[starts[:, None] + np.arange(7)]
    low = head[:, :4].copy().view("<u4").ravel()
    spare = head[:, 4:6].copy().view("<u2").ravel().astype(np.int64)
    width = head[:, 6].astype(np.int64)
    grid = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        lines = raw[(starts[rows] + 7)[:, None] + np.arange(BLOCK * w // 8)]
        grid[rows] = _values(lines, w)
    body = starts + 7 + BLOCK // 8 * width
    for i in np.flatnonzero(spare).tolist():
        k, at = int(spare[i]), int(body[i])
        grid[i, raw[at : at + k]] = np.frombuffer(image, "<u4", k, at + k)
    return (grid + low[:, None]).ravel()[:n]


_SEGMENTS = "part int, seg int, doc_ids array<bigint>, counts array<int>, image binary"
_ROWS = "part int, seg int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"


def write_token_file(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, percentile: float = 90.0, segment_ids: int = 1 << 18) -> None:
    """Encode every text, append end_id to each, and write segment images in ascending doc_id order."""
    texts = docs.select("doc_id", whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    each = min(max(size >> 12, 16 << 20), 256 << 20)  # more text means larger partitions first, then more of them
    dealt = texts.repartitionByRange(partitions_for(size, each, 4), "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), bulk_encoder(tokenizer_path)
        held: list[np.ndarray] = []
        names: list[int | None] = []
        sizes: list[int] = []
        seg = filled = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())), pa.array([pack(np.concatenate(held), percentile)], pa.binary())],
                names=["part", "seg", "doc_ids", "counts", "image"],
            )

        for batch in text_slices(batches, "text"):
            ids, counts = encoder.encode(batch.column("text").to_pylist())
            ends = np.cumsum(counts)
            held.append(np.insert(ids, ends, np.uint32(end_id)))
            names += batch.column("doc_id").to_pylist()
            sizes += (counts + 1).tolist()
            filled += len(held[-1])
            if filled >= segment_ids:
                yield flush()
                held, names, sizes, filled, seg = [], [], [], 0, seg + 1
        if names:
            yield flush()

    with frugal(docs.sparkSession):
        dealt.mapInArrow(encode, _SEGMENTS).write.parquet(path)


def read_token_file(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the written segments."""
    segments = spark.read.schema(_SEGMENTS).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, seg, names, counts, image = (batch.column(i)[row] for i in range(5))
                sizes = np.array(counts.as_py(), np.int64)
                raw = memoryview(unpack(image.as_py()).astype("<u4").tobytes())
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([seg.as_py()] * n, pa.int32()), pa.array(names.as_py(), pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(sums, pa.int64())],
                    names=["part", "seg", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    totals = segments.select("part", "seg", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("ids"))
    within = Window.partitionBy("part").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.groupBy("part").agg(F.sum("ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    starts = totals.select("part", "seg", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("ahead")).join(parts, "part")
    rows = segments.mapInArrow(decode, _ROWS).join(starts, ["part", "seg"])
    return rows.select("doc_id", (F.col("base") + F.col("ahead") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def token_file(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the token file of docs into the shared folder and return its digest, read back from the file."""
    spark = docs.sparkSession
    path = f"{work_dir(spark)}/tokens"
    write_token_file(docs, tokenizer_path, end_id, path)
    return read_token_file(spark, path)
