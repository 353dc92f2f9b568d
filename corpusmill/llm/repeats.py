"""Suffix-array dedup by bucket-pointer refinement: bytes covered by repeated strings of a length.

Suffixes are only compared up to `length` bytes, so a suffix's bucket after refinement to `length` says
all: a string is repeated where its bucket holds several suffixes.

1. Initial buckets. A suffix's bucket identifier for q bytes is a hash of its q-gram. Suffixes are sampled
   by content: of each run of length - q + 1 suffixes the one with the smallest identifier is an anchor.
   Equal strings of `length` bytes have their anchor at the same offset, so a string can only be repeated
   if its anchor's bucket is.
2. Refinement. Suffixes whose anchors share a bucket are sorted on the pair of bucket identifiers
   at offset 0 and at a later offset: h -> 2h from (id_h(p), id_h(p + h)), the last step overlapping. After each
   sort, suffixes that are alone in their bucket are settled: they, and those that point at them, are left out
   of the next step, which uses the identifiers of this one, until buckets tell apart strings of `length` bytes.

Anchors of a bucket are refined together; a bucket with many anchors is split over `SPLIT`-sized tasks.
What is unique in its part is then compared across the parts in a second sort. Documents with equal
texts are represented by one of them: it is the source of the others' matches, and all of them are
covered in full, if long enough.

Defined cases: null and empty texts have no bytes, nothing removed and the digest of nothing; texts shorter
than `length` are kept whole; matches never cross documents; repeated rows each count as documents; rows
with a null doc_id are treated as documents like any other, told apart by their texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, text_slices, whole_text, written
from .shingles import mixed, powers

GRAM = 64
SPLIT = 200
_VALUES = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)


def gram_ids(data: np.ndarray, q: int) -> np.ndarray:
    """The bucket identifier of every q-gram."""
    n = len(data) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, inverse = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * power[: len(data)], out=total[1:])
    return mixed((total[q:] - total[:-q]) * inverse[:n], 41)


def shared(ids: np.ndarray) -> np.ndarray:
    """Which identifiers occur more than once."""
    order = np.argsort(ids)
    same = ids[order[1:]] == ids[order[:-1]]
    several = np.zeros(len(ids), bool)
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    return several


def refined(ids: np.ndarray, at: np.ndarray, keep: np.ndarray, q: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the suffixes may begin a repeated string of `length` bytes, and their identifiers for it.

    ids: of q bytes at all places; at: the suffixes' places; keep: suffixes that stay though they're alone here.
    """
    steps, h = [], q
    while h < length:
        steps.append(min(h, length - h))
        h += steps[-1]

    def paired(own: np.ndarray, at: np.ndarray, level: int) -> np.ndarray:
        return mixed(mixed(own, 42) + pointed(at + steps[level], level), 43)

    def pointed(at: np.ndarray, level: int) -> np.ndarray:
        return ids[at] if not level else paired(pointed(at, level - 1), at, level - 1)

    chosen, own = np.arange(len(at)), ids[at]
    for level in range(len(steps)):
        some = np.flatnonzero(shared(own) | keep[chosen])
        chosen, at = chosen[some], at[some]
        own = paired(own[some], at, level)
    return chosen, own


def _sliding(x: np.ndarray, w: int, best) -> np.ndarray:
    """best (minimum or maximum) of each w values in a row, in time independent of w."""
    n = len(x) - w + 1
    pad = -len(x) % w
    grid = np.concatenate((x, np.full(pad, x[-1]))).reshape(-1, w)
    ahead = best.accumulate(grid, axis=1).ravel()
    behind = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(ids: np.ndarray, w: int) -> np.ndarray:
    """Positions that are the smallest identifier of some w in a row."""
    if len(ids) < w:
        return np.empty(0, np.int64)
    low = _sliding(ids, w, np.minimum)
    # A position is chosen if the largest minimum over the windows that hold it is its own value.
    edge = np.concatenate((np.full(w - 1, low[0]), low, np.full(w - 1, low[-1])))
    if w > 1:
        edge[: w - 1] = 0
        edge[len(edge) - w + 1 :] = 0
    return np.flatnonzero(_sliding(edge, w, np.maximum) == ids)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _keys(rows: DataFrame) -> DataFrame:
    """rows (doc_id, text) with a 128-bit digest of the text."""
    return rows.select("doc_id", whole_text().alias("text")).withColumn("digest", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))


def _anchor_buckets(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """digest, at and size: the anchors whose bucket holds several; texts: digest, text."""
    w = length - GRAM + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        filled = 0

        def flush() -> pa.RecordBatch:
            ids, keys, at = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket = (ids >> np.uint64(33)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            ids, keys, at, bucket = ids[order], keys[order], at[order], bucket[order]
            used, start = np.unique(bucket, return_index=True)
            cuts = list(zip(start.tolist(), [*start[1:].tolist(), len(bucket)], strict=True))
            cols = [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (ids, keys, at)]
            return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *cols], names=["bucket", "ids", "keys", "at"])

        for batch in text_slices(batches, "text"):
            for text, digest in zip(batch.column("text").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                raw = np.frombuffer(_bytes(text), np.uint8)
                if len(raw) < length:
                    continue
                ids = gram_ids(raw, GRAM)
                at = anchors(ids, w)
                held.append((ids[at], np.full(len(at), digest, "S16"), at.astype("<i4")))
                filled += len(at)
            if filled >= 1_000_000:
                yield flush()
                held, filled = [], 0
        if filled:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
        for batch in batches:
            for b, *x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_bucket.setdefault(b, []).append(x)
        for parts in by_bucket.values():
            ids, keys, at = (np.concatenate([np.frombuffer(p[i], kind) for p in parts]) for i, kind in enumerate(("<u8", "S16", "<i4")))
            _, which, size = np.unique(ids, return_inverse=True, return_counts=True)
            size = size[which]
            some = size > 1
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array([k.ljust(16, b"\0") for k in keys[some].tolist()], pa.binary()), pa.array(at[some]), pa.array(size[some])], names=["digest", "at", "size"])

    dealt = texts.mapInArrow(deal, "bucket int, ids binary, keys binary, at binary").repartition(buckets, "bucket")
    return dealt.mapInArrow(meet, "digest binary, at int, size bigint")


_PARTS = "digest binary, start int, stop int, bucket int, ids binary, keys binary, at binary"


def _strings(docs: DataFrame, own: DataFrame, length: int) -> DataFrame:
    """bucket, part, hot, digest, first and bytes: per anchor the stretch that its strings span.

    own: doc_id, digest and anchors (at, size) of the documents to read.
    """
    w = length - GRAM + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            rows = []
            for text, digest, found in zip(*(batch.column(c).to_pylist() for c in ("text", "digest", "anchors")), strict=True):
                raw = _bytes(text)
                ids = gram_ids(np.frombuffer(raw, np.uint8), GRAM)
                low = _sliding(ids, w, np.minimum)
                last: dict[int, int] = {}
                for a in sorted(found, key=lambda x: x["at"]):
                    p, size = a["at"], a["size"]
                    v = int(ids[p])
                    lo = max(0, p - w + 1)
                    held = np.flatnonzero(low[lo : p + 1] == ids[p])  # its strings, those of an equal anchor before it aside
                    first, stop = max(lo + int(held[0]), last.get(v, -1) + 1), lo + int(held[-1]) + 1
                    last[v] = p
                    if first < stop:
                        parts = -(-size // SPLIT)
                        part = int.from_bytes(hashlib.blake2b(digest + p.to_bytes(4, "little"), digest_size=4).digest(), "little") % parts
                        rows.append((v - (1 << 63), part, parts > 1, digest, first, raw[first : stop + length - 1]))
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "part", "hot", "digest", "first", "bytes"])

    texts = _keys(docs).alias("d").join(own.alias("o"), (F.col("d.digest") == F.col("o.digest")) & F.col("d.doc_id").eqNullSafe(F.col("o.doc_id"))).select("d.text", "d.digest", "o.anchors")
    return texts.mapInArrow(cut, "bucket bigint, part int, hot boolean, digest binary, first int, bytes binary")


def _runs(keys: np.ndarray, at: np.ndarray, length: int, digests: np.ndarray | None = None) -> pa.RecordBatch:
    """Covered stretches from repeated string starts; keys are digests or places among digests."""
    order = np.lexsort((at, keys))
    keys, at = keys[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (at[1:] > at[:-1] + 1)
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(at)) - 1
    n, at = len(start), at.astype(np.int64)
    names = keys[start] if digests is None else digests[keys[start]]
    return pa.RecordBatch.from_arrays(
        [pa.array([k.ljust(16, b"\0") for k in names.tolist()], pa.binary()), pa.array(at[start].astype(np.int32)), pa.array((at[stop] + length).astype(np.int32)), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 3],
        names=["digest", "start", "stop", "bucket", "ids", "keys", "at"],
    )


def _distinct(ids: np.ndarray, keys: np.ndarray, at: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """Without rows that say the same of the same document (repeated rows of the input)."""
    order = np.lexsort((at, keys, ids))
    cols = [c[order] for c in (ids, keys, at, *more)]
    new = np.ones(len(order), bool)
    new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    return [c[new] for c in cols]


def _refine_parts(strings: DataFrame, length: int, buckets: int) -> DataFrame:
    """Covered stretches found within parts, and what has to be compared across parts."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(d, f, h, b) for batch in batches for d, f, h, b in zip(*(batch.column(c).to_pylist() for c in ("digest", "first", "hot", "bytes")), strict=True)]
        if not rows:
            return
        digests, number = np.unique(np.array([r[0] for r in rows], "S16"), return_inverse=True)
        number = number.astype(np.int32)
        sizes = np.array([len(r[3]) for r in rows])
        grams, base = [], np.zeros(len(rows), np.int64)
        for i in range(0, len(rows), 2000):
            some, before = sizes[i : i + 2000], sum(map(len, grams))
            base[i : i + 2000] = before + np.cumsum(some) - some
            grams.append(gram_ids(np.frombuffer(b"".join(r[3] for r in rows[i : i + 2000]), np.uint8), GRAM))
        ids, count = np.concatenate(grams), sizes - length + 1
        del grams
        row = np.repeat(np.arange(len(rows), dtype=np.int32), count)
        offset = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
        first, hot = np.array([r[1] for r in rows], np.int32), np.array([r[2] for r in rows], bool)
        del rows
        chosen, ids = refined(ids, base[row] + offset, hot[row], GRAM, length)
        if not len(chosen):
            return
        row = row[chosen]
        out = (ids, number[row], first[row] + offset[chosen], hot[row])
        del ids, offset
        ids, keys, at, hot = _distinct(*out)
        same = np.zeros(len(ids), bool)
        same[1:] = ids[1:] == ids[:-1]
        repeated = same.copy()
        repeated[:-1] |= same[1:]
        if repeated.any():
            yield _runs(keys[repeated], at[repeated], length, digests)
        # Of a split bucket one string of each kind goes on: it may be unique here only.
        go = hot & ~same
        if go.any():
            ids, keys, at = ids[go], digests[keys[go]], at[go]
            bucket = (ids >> np.uint64(33)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            used, start = np.unique(bucket[order], return_index=True)
            cuts = list(zip(start.tolist(), [*start[1:].tolist(), len(order)], strict=True))
            n = len(cuts)
            cols = [pa.array([x[order][a:b].tobytes() for a, b in cuts], pa.binary()) for x in (ids, keys, at.astype("<i4"))]
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.binary()), *[pa.nulls(n, pa.int32())] * 2, pa.array(used.astype(np.int32)), *cols], names=["digest", "start", "stop", "bucket", "ids", "keys", "at"])

    return strings.repartition(buckets, "bucket", "part").mapInArrow(refine, _PARTS)


def _across_parts(rows: DataFrame, length: int, buckets: int) -> DataFrame:
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [x for batch in batches for x in zip(*(batch.column(c).to_pylist() for c in ("ids", "keys", "at")), strict=True)]
        if not parts:
            return
        ids, keys, at = _distinct(*(np.concatenate([np.frombuffer(p[i], kind) for p in parts]) for i, kind in enumerate(("<u8", "S16", "<i4"))))
        same = np.zeros(len(ids), bool)
        same[1:] = ids[1:] == ids[:-1]
        same[:-1] |= same[1:]
        if same.any():
            yield _runs(keys[same], at[same], length)

    return rows.where("bucket is not null").repartition(buckets, "bucket").mapInArrow(meet, _PARTS)


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    if length < GRAM:
        raise ValueError(f"strings under {GRAM} bytes need a smaller GRAM")
    keyed = _keys(docs)
    sized = keyed.select("doc_id", "digest", F.octet_length("text").alias("n"))
    classes = written(sized.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.max("n").alias("n")), "classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    parts = partitions_for(total / 2, 8 << 20, 12)
    alive = written(_anchor_buckets(keyed.select("digest", "text"), length, parts), "anchors")
    own = alive.groupBy("digest").agg(F.collect_list(F.struct("at", "size")).alias("anchors")).join(classes.select("digest", "doc_id"), "digest")
    found = written(_refine_parts(_strings(docs, own, length), length, 4 * parts), "strings")
    covered = found.where("bucket is null").select("digest", "start", "stop").unionByName(_across_parts(found, length, parts).select("digest", "start", "stop"))
    spans = covered.groupBy("digest").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    facts = written(classes.join(spans, "digest", "left").select("digest", (F.col("copies") > 1).alias("copied"), "spans").where("copied or spans is not null"), "facts")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            rows = []
            for doc_id, text, copied, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "copied", "spans")), strict=True):
                raw = _bytes(text)
                cuts = [(0, len(raw))] if copied and len(raw) >= length else sorted((s["start"], s["stop"]) for s in spans or ())
                kept, upto, removed, runs = [], 0, 0, 0
                end = -1
                for a, b in cuts:
                    if a > end:
                        kept.append(raw[upto:a])
                        runs += 1
                    removed += max(0, b - max(a, end)) if end >= 0 else b - a
                    end = max(end, b)
                    upto = end
                kept.append(raw[upto:])
                rows.append((doc_id, len(raw), removed, runs, hashlib.sha256(b"".join(kept)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = keyed.join(facts, "digest", "left").select("doc_id", "text", "copied", "spans")
    return rows.mapInArrow(strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
