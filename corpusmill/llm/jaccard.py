"""N-gram Jaccard join in metric space, exact.

Documents are sets of word shingles. Equal sets are one point. The sets are points of two metric spaces
that bound each other: Jaccard distance, and the size of the symmetric difference, where a link between
sets of a and b >= a members allows at most a * (1 - t) / t differences.

1. Pivots and regions. The shingles are dealt to m cells. A point's part in a cell is the pivot it stands
   at, so every cell cuts the space into regions of points with distance 0 from their pivot. Points belong
   to size windows, and those near a window's border are replicated to the next one (a link's larger set
   has at most a / t members). By the triangle inequality two linked points differ in at most D cells, so
   with more than D + slack cells they meet in a region whose part isn't empty. Points with more empty
   cells than the slack are rare; they also meet in the regions of their empty parts. Points of at most
   `FEW` shingles take their smallest hashes as pivots, as many as a link may miss and one more.
   Sampled documents can't be the pivots of this step: nearly all pairs of documents share nothing, so
   all distances from such pivots are 1 and every window would hold every point.
2. Regions join recursively. In each region the point that stands in the most regions becomes its pivot
   document; the others are tested against it, unless the triangle inequality rules a link out, and what links
   becomes one component. In regions that still hold several, points of the largest become pivots for the
   points outside it. A region of more than `LEAF` points that still holds several components is then cut as
   a Voronoi diagram in the space of counts by coarse cells (whose L1 distance no symmetric difference is
   under): each point is at home with its nearest of `PIVOTS` pivots, and the triangle inequality gives the
   window of other regions that it has to visit. The parts are cut again, down to leaves, where pairs of
   different components are tested unless sizes or counts rule a link out. A region that windows don't
   thin out (its points are all near each other) is cut into blocks instead, and the points outside its
   largest component meet all of it, block by block. So every pair of a region is tested, ruled out or already
   connected, and no region is ever gathered in a task.

Only candidates' sets are stored; every link is verified on them. Point and shingle identities are 128-bit and
64-bit hashes.

Defined cases: null, empty and blank texts have no shingles and link with nothing; a text with fewer words than
a shingle is one shingle; equal sets share a component even when everything else differs; repeated rows
each get a row; a null doc_id is kept, and takes the smallest known doc_id of its component. Rows without a
doc_id link as others do.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, scratch, text_slices, whole_text, written
from .shingles import mixed, set_digest, shingle_sets

COARSE = 256
#: Regions of up to so many points are tested as they are.
LEAF = 2048
#: How often a region is cut, and how many times its rows the parts may hold.
LEVELS, GROWTH = 3, 2
#: Sets of up to so many shingles take single shingles as pivots.
FEW = 40
#: Points of the largest component that others are tested against, and pivots of a cut.
HEADS, PIVOTS = 4, 16


class Windows:
    """Size windows and their cells for a threshold."""

    def __init__(self, threshold: Fraction, ratio: float = 1.25):
        self.threshold = t = threshold
        ratio = max(ratio, float(1 / t) * 1.0001)
        self.starts = [1, FEW + 1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(int(self.starts[-1] * ratio) + 1)
        self.cells, self.slack = [0], [0]
        for lo, hi in zip(self.starts[1:], self.starts[2:], strict=False):
            differences = int((hi - 1) * (1 - t) / t)
            slack = 0
            for _ in range(12):  # more cells leave more of them empty, which takes more slack
                cells = differences + 1 + slack
                empty = cells * np.exp(-lo / cells)
                slack = int(np.ceil(empty + 3 * np.sqrt(empty)))
            self.cells.append(differences + 1 + slack)
            self.slack.append(slack)

    def of(self, n: int) -> list[int]:
        """The windows that a set of n members belongs to."""
        j = int(np.searchsorted(self.starts, n, "right")) - 1
        near = j and n <= int((self.starts[j] - 1) / self.threshold)
        return [j, j - 1] if near else [j]

    def regions(self, sets: list[np.ndarray], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Region hashes and the points in them."""
        every = [(i, j) for i, s in enumerate(sets) if len(s) for j in self.of(len(s))]
        short, jobs = [i for i, j in every if not j], [(i, j) for i, j in every if j]
        # One of two linked sets' smallest len - ceil(t * len) + 1 hashes is in both.
        heads = [sets[i][: len(sets[i]) - int(-(-len(sets[i]) * self.threshold // 1)) + 1] for i in short]
        few = mixed(np.concatenate(heads), 16) if heads else np.empty(0, np.uint64)
        few_points = np.repeat(points[np.array(short, np.int64)], [len(h) for h in heads])
        if not jobs:
            return few, few_points
        cells = np.array([self.cells[j] for _, j in jobs], np.int64)
        base = np.cumsum(cells) - cells
        sizes = [len(sets[i]) for i, _ in jobs]
        every = np.concatenate([sets[i] for i, _ in jobs])
        job = np.repeat(np.arange(len(jobs)), sizes)
        cell = (mixed(every, 11) % cells.astype(np.uint64)[job]).astype(np.int64) + base[job]
        part, total = mixed(every, 12), int(cells.sum())
        count = np.bincount(cell, minlength=total)
        low = np.bincount(cell, (part & np.uint64(0xFFFFFFFF)).astype(float), total).astype(np.uint64)
        high = np.bincount(cell, (part >> np.uint64(32)).astype(float), total).astype(np.uint64)
        owner = np.repeat(np.arange(len(jobs)), cells)
        name = np.array([j for _, j in jobs], np.uint64)[owner] << np.uint64(40) | (np.arange(total) - base[owner]).astype(np.uint64)
        name = mixed(mixed(name, 13) ^ (low + (high << np.uint64(32))), 14)
        empty = count == 0
        odd = np.bincount(owner, empty, len(jobs)) > np.array([self.slack[j] for _, j in jobs])
        apart = odd[owner]  # these meet in all their regions, under names of their own
        names = np.concatenate((few, name[~empty], mixed(name[apart], 15)))
        return names, np.concatenate((few_points, points[np.array([i for i, _ in jobs])][np.concatenate((owner[~empty], owner[apart]))]))


def _digest() -> Column:
    """With doc_id this names a row, but for its repeats."""
    return F.xxhash64(whole_text())


def _points(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, the 128-bit point and the text's digest of each document."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist(), k)
            digests = [set_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), batch.column("digest")], names=["doc_id", "n_shingles", "point", "check", "digest"])

    return docs.select("doc_id", whole_text().alias("text"), _digest().alias("digest")).mapInArrow(measure, "doc_id bigint, n_shingles bigint, point bigint, check bigint, digest bigint")


def _shared_regions(docs: DataFrame, k: int, windows: Windows, buckets: int) -> DataFrame:
    """region and point, for the regions with several points."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        filled = 0

        def flush() -> pa.RecordBatch:
            names, points = (np.concatenate(x) for x in zip(*held, strict=True))
            bucket = (names >> np.uint64(32)) % np.uint64(buckets)
            order = np.lexsort((points, names, bucket))
            names, points, bucket = names[order], points[order], bucket[order]
            new = np.ones(len(names), bool)  # copies in this task say the same once
            new[1:] = (names[1:] != names[:-1]) | (points[1:] != points[:-1])
            names, points, bucket = names[new].astype("<u4"), points[new], bucket[new]
            used, start = np.unique(bucket, return_index=True)
            stop = [*start[1:].tolist(), len(bucket)]
            cuts = list(zip(start.tolist(), stop, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([names[a:b].tobytes() for a, b in cuts], pa.binary()), pa.array([points[a:b].tobytes() for a, b in cuts], pa.binary())], names=["bucket", "names", "points"])

        for batch in text_slices(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist(), k)
            held.append(windows.regions(sets, np.array([set_digest(s)[0] for s in sets], np.int64)))
            filled += len(held[-1][0])
            if filled >= 600_000:
                yield flush()
                held, filled = [], 0
        if filled:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[tuple[bytes, bytes]]] = {}
        for batch in batches:
            for b, n, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_bucket.setdefault(b, []).append((n, p))
        for parts in by_bucket.values():
            names = np.concatenate([np.frombuffer(n, "<u4") for n, _ in parts])
            points = np.concatenate([np.frombuffer(p, "<i8") for _, p in parts])
            order = np.lexsort((points, names))
            names, points = names[order], points[order]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (points[1:] != points[:-1])
            names, points = names[new], points[new]
            first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
            size = np.diff(np.append(first, len(names)))
            several = np.repeat(size > 1, size)
            first, size = first[size > 1], size[size > 1]
            points = points[several]
            if len(points):
                # A region is named by its points: regions with the same points become one.
                at = np.cumsum(size) - size
                own = np.add.reduceat(mixed(points.view(np.uint64), 21), at)
                region = mixed(own, 22) ^ np.add.reduceat(mixed(points.view(np.uint64), 23), at)
                region, which = np.unique(region, return_index=True)
                take = np.concatenate([np.arange(a, a + n) for a, n in zip(at[which].tolist(), size[which].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(region, size[which]).view(np.int64)), pa.array(points[take])], names=["region", "point"])

    texts = docs.select(whole_text().alias("text"))
    dealt = texts.mapInArrow(deal, "bucket int, names binary, points binary").repartition(buckets, "bucket")
    return dealt.mapInArrow(meet, "region bigint, point bigint").distinct()


def _counts(members: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((mixed(members, 31) % np.uint64(COARSE)).astype(np.int64), minlength=COARSE), 255).astype(np.uint8)


def _sets(docs: DataFrame, chosen: DataFrame, k: int) -> DataFrame:
    """point, its coarse counts and its sorted shingles, for the chosen classes: first and, where that is null, digest."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets = shingle_sets(batch.column("text").to_pylist(), k)
            yield pa.RecordBatch.from_arrays([pa.array([set_digest(s)[0] for s in sets], pa.int64()), pa.array([_counts(s).tobytes() for s in sets], pa.binary()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], names=["point", "coarse", "members"])

    named = docs.select("doc_id", whole_text().alias("text")).join(chosen.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    # Texts that only rows without a doc_id have are found by their digests, one row for each.
    bare = docs.where("doc_id IS NULL").groupBy(_digest().alias("digest")).agg(F.first(whole_text()).alias("text"))
    unnamed = bare.join(chosen.where("first IS NULL").select("digest"), "digest", "left_semi")
    return named.select("text").unionByName(unnamed.select("text")).mapInArrow(store, "point bigint, coarse binary, members binary").dropDuplicates(["point"])


def _linked(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of points that link, by their sets."""
    top, bottom = threshold.numerator, threshold.denominator

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "x", 2 << 20):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(bottom * both >= top * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("point").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("point").alias("b"), F.col("members").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(link, "a bigint, b bigint")


def _near(pairs: DataFrame, coarse: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of points that the triangle inequality over coarse counts, and sizes, don't rule out."""
    top, bottom = threshold.numerator, threshold.denominator

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "x", 1 << 20):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COARSE).astype(np.int16) for c in ("x", "y"))
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
            keep = (apart * (top + bottom) <= (n + m) * (bottom - top)) & (bottom * np.minimum(n, m) >= top * np.maximum(n, m))
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = coarse.select(F.col("point").alias("a"), F.col("coarse").alias("x"), F.col("n_shingles").alias("n"))
    right = coarse.select(F.col("point").alias("b"), F.col("coarse").alias("y"), F.col("n_shingles").alias("m"))
    return written(pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y", "n", "m").mapInArrow(test, "a bigint, b bigint"), "near")


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node it is connected to) of the edges' ends a and b, by passing labels
    and jumping pointers."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label")
    labels = written(labels, "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("heard"))
        lower = labels.join(heard, labels.node == heard.a).select("node", "label", F.least("label", "heard").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("upper"))
        moved = written(lower.join(up, "next").select("node", F.col("upper").alias("label"), (F.col("upper") < F.col("label")).alias("moved")), "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").limit(1).count() == 0:
            return labels


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """point and label after the links (a, b) between points."""
    ends = labels.select(F.col("point").alias("a"), F.col("label").alias("la")), labels.select(F.col("point").alias("b"), F.col("label").alias("lb"))
    roots = components(links.join(ends[0], "a").join(ends[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    named = labels.join(roots.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
    return written(named.select("point", F.coalesce("root", "label").alias("label")), "labels")


_ROW = "cell bigint, home boolean, point bigint, label bigint, n_shingles bigint, coarse binary"


def _grid(column: pa.Array) -> np.ndarray:
    """A row of counts for each value."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COARSE).astype(np.int16)


def _cut(rows: DataFrame, level: int, threshold: Fraction) -> DataFrame:
    """The rows of large cells in the cells of their pivots: parent, and the columns of _ROW.

    A visitor meets only those at home. Of two neighbours at home with different pivots the one with the lower visits.
    """
    slot = F.pmod(F.xxhash64("point", F.lit(level)), F.lit(PIVOTS))
    heads = rows.where("home").groupBy("cell", slot.alias("slot")).agg(F.min(F.struct("point", "coarse")).alias("p"))
    pivots = written(heads.groupBy("cell").agg(F.array_sort(F.collect_list("p.coarse")).alias("pivots")), "pivots")
    wide = float(2 * (1 - threshold) / threshold)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "coarse"):
            cells, home, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "home", "n_shingles"))
            counts = _grid(batch.column("coarse"))
            for cell in np.unique(cells):
                mine = np.flatnonzero(cells == cell)
                centres = _grid(pa.array(batch.column("pivots")[int(mine[0])].as_py(), pa.binary()))
                away = np.stack([np.abs(counts[mine] - c).sum(axis=1, dtype=np.int64) for c in centres], axis=1)
                nearest = away.argmin(axis=1)
                to = away <= (away.min(axis=1) + wide * n[mine])[:, None]
                to &= ~home[mine][:, None] | (np.arange(len(centres)) >= nearest[:, None])
                x, j = np.nonzero(to)
                part = batch.select(["cell", "point", "label", "n_shingles", "coarse"]).take(pa.array(mine[x]))
                names = mixed(mixed(np.full(len(j), cell, np.int64).view(np.uint64), 41 + level) ^ j.astype(np.uint64), 40)
                yield pa.RecordBatch.from_arrays([part.column("cell"), pa.array(names.view(np.int64)), pa.array(home[mine][x] & (j == nearest[x])), *part.columns[1:]], names=["parent", "cell", "home", "point", "label", "n_shingles", "coarse"])

    return rows.join(pivots, "cell").mapInArrow(assign, f"parent bigint, {_ROW}")


def _leaves(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """What meets in a test: cell, i, j, side (0: of both sides, 1: left, 2: right) and the columns of _ROW."""
    done: list[DataFrame] = []
    whole = [F.lit(0).alias(c) for c in ("i", "j", "side")]
    for level in range(LEVELS + 1):
        sizes = written(rows.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > LEAF), "sizes")
        if sizes.limit(1).count() == 0:
            done.append(rows.select("*", *whole))
            break
        done.append(rows.join(sizes, "cell", "left_anti").select("*", *whole))
        large = written(rows.join(sizes.select("cell"), "cell", "left_semi"), "large")
        if level < LEVELS:
            cut = written(_cut(large, level, threshold), "cut")
            grown = cut.groupBy("parent").agg(F.count("*").alias("m")).join(sizes.withColumnRenamed("cell", "parent"), "parent")
            thinned = written(grown.where(F.col("m") <= GROWTH * F.col("n")).select(F.col("parent").alias("cell")), "thinned")
            rows = cut.join(thinned.withColumnRenamed("cell", "parent"), "parent", "left_semi").drop("parent")
            large = large.join(thinned, "cell", "left_anti")
        # The points outside the largest component, in blocks, against blocks of all points.
        masses = large.groupBy("cell", "label").agg(F.count("*").alias("m"))
        main = masses.groupBy("cell").agg(F.max(F.struct("m", "label")).alias("main"), F.sum("m").alias("n"))
        main = written(main.select("cell", F.col("main.label").alias("main"), F.ceil(F.col("n") / LEAF).cast("int").alias("jn"), F.ceil(F.greatest(F.col("n") - F.col("main.m"), F.lit(1)) / LEAF).cast("int").alias("in")), "main")
        dealt = large.join(main, "cell")
        own = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        columns = [*large.columns, "i", "j", "side"]
        done.append(dealt.where("label <> main").withColumn("i", own("in")).withColumn("j", every("jn")).withColumn("side", F.lit(1)).select(columns))
        done.append(dealt.withColumn("j", own("jn")).withColumn("i", every("in")).withColumn("side", F.lit(2)).select(columns))
        if level == LEVELS:
            break
    return reduce(DataFrame.unionByName, done)


def _across(rows: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of different labels in a region that may link.

    rows: region, point, label, n_shingles, coarse.
    """
    spark = rows.sparkSession
    cells = written(rows.select(F.col("region").alias("cell"), F.lit(True).alias("home"), "point", "label", "n_shingles", "coarse"), "cells")
    met = _leaves(cells, threshold)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions_for(cells.count() * 320, 8 << 20))
    top, bottom = threshold.numerator, threshold.denominator

    def pairs(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        side, home, point, label, size = (group.column(c).to_numpy() for c in ("side", "home", "point", "label", "n_shingles"))
        names, inverse, mass = np.unique(label, return_inverse=True, return_counts=True)
        if len(names) == 1:
            return point[:0], point[:0]
        main = inverse == mass.argmax()
        left, right = np.flatnonzero((side == 1) | (side == 0) & ~main), np.flatnonzero(side != 1)
        right = right[np.argsort(size[right], kind="stable")]
        counts, sizes = _grid(group.column("coarse").combine_chunks()), size[right]
        from_, to = np.searchsorted(sizes, -(-size[left] * top // bottom)), np.searchsorted(sizes, size[left] * bottom // top, "right")
        a, b = [], []
        for x, lo, hi in zip(left.tolist(), from_.tolist(), to.tolist(), strict=True):
            y = right[lo:hi]
            # Two points outside the main component are both on the left: one test will do.
            y = y[(label[y] != label[x]) & (home[y] | home[x]) & ((side[x] == 1) | main[y] | (point[x] < point[y]))]
            if len(y):
                apart = np.abs(counts[y] - counts[x]).sum(axis=1, dtype=np.int64)
                y = y[apart * (top + bottom) <= (size[x] + size[y]) * (bottom - top)]
                a.append(np.full(len(y), point[x]))
                b.append(point[y])
        return (np.concatenate(a), np.concatenate(b)) if a else (point[:0], point[:0])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            a, b = pairs(pa.Table.from_batches(held))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            cell, i, j = (batch.column(c).to_numpy() for c in ("cell", "i", "j"))
            new = np.flatnonzero((cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows], strict=True):
                if hi > lo:
                    key = (cell[lo], i[lo], j[lo])
                    if held and key != last:
                        yield found(held)
                        held = []
                    last = key
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield found(held)

    sorted_ = met.repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return sorted_.mapInArrow(test, "a bigint, b bigint").distinct()


def _join_regions(regions: DataFrame, coarse: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """point and label for the points of the regions; regions: region, point, written."""
    weights = regions.groupBy("point").agg(F.count("*").alias("weight"))
    labels = written(weights.select("point", F.col("point").alias("label"), "weight"), "points")
    first = regions.join(labels, "point").groupBy("region").agg(F.max(F.struct("weight", "point")).alias("p")).select("region", F.col("p.point").alias("a"))
    pairs = regions.select("region", F.col("point").alias("b")).join(written(first, "pivots"), "region").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    known = labels.select("point", "weight")
    labels = _merged(labels.select("point", "label"), written(_linked(_near(pairs, coarse, threshold), sets, threshold), "links"))
    # The pivots now are points of the region's largest component, one in each of a few slots.
    rows = written(_unsettled(regions, labels).join(known, "point"), "rows")
    masses = written(labels.groupBy("label").agg(F.count("*").alias("mass")), "masses")
    main = rows.select("region", "label").distinct().join(masses, "label").groupBy("region").agg(F.max(F.struct("mass", "label")).alias("m"))
    rows = rows.join(written(main.select("region", F.col("m.label").alias("main")), "main"), "region")
    slot = F.pmod(F.xxhash64("point"), F.lit(HEADS))
    pivots = written(rows.where("label = main").groupBy("region", slot.alias("slot")).agg(F.max(F.struct("weight", "point")).alias("p")).select("region", F.col("p.point").alias("a")), "pivots")
    tests = rows.where("label <> main").select("region", F.col("point").alias("b")).join(pivots, "region")
    tests = tests.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    labels = _merged(labels, written(_linked(_near(tests, coarse, threshold), sets, threshold), "links"))
    rows = _unsettled(regions, labels).join(coarse, "point")
    return _merged(labels, written(_linked(_across(rows, threshold), sets, threshold), "links"))


def _unsettled(regions: DataFrame, labels: DataFrame) -> DataFrame:
    """region, point and label of the regions that hold several labels."""
    rows = regions.join(labels, "point")
    several = rows.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("region")
    return rows.join(written(several, "several"), "region")


def _resolved(docs: DataFrame, k: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """The points of the documents, and each class of equal sets with its component's label and smallest doc_id."""
    with scratch() as keep:
        points = written(_points(docs, k), "documents")
        classes = written(points.where("n_shingles > 0").groupBy("point", "check", "n_shingles").agg(F.min("doc_id").alias("first"), F.min("digest").alias("digest")), "classes")
        windows = Windows(threshold)
        entries = points.agg(F.sum(F.col("n_shingles") * 0.4 + 2)).first()[0] or 0
        regions = written(_shared_regions(docs, k, windows, partitions_for(entries * 12, 6 << 20, 12)), "regions")
        candidates = classes.join(regions.select("point").distinct(), "point", "left_semi")
        coarse_sets = written(_sets(docs, candidates.select("first", "digest"), k), "sets")
        coarse = coarse_sets.select("point", "coarse").join(candidates.select("point", "n_shingles"), "point")
        labels = _join_regions(regions, written(coarse, "coarse"), coarse_sets.select("point", "members"), threshold)
        named = labels.join(classes.select("point", "first"), "point")
        smallest = written(named.groupBy("label").agg(F.min("first").alias("component")), "smallest")
        of_class = named.join(smallest, "label").select("point", "label", "component")
        # A label is the smallest point of its component, so a class that links with nothing is named by its own.
        resolved = classes.join(of_class, "point", "left").select("point", "check", F.coalesce("label", "point").alias("label"), F.coalesce("component", "first").alias("component"))
        resolved = written(resolved, "resolved")
        keep += [points, resolved]
    return points, resolved


def jaccard_components(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    points, resolved = _resolved(docs, k, threshold)
    some = points.where("n_shingles > 0").join(resolved, ["point", "check"]).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    none = points.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none)


def keep_one(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """One row of docs, with all columns, for each component: the first by doc_id (null last) and digest of the text.

    Of rows that agree in both any one stays. Texts without shingles link with nothing, so all their rows stay.
    """
    points, resolved = _resolved(docs, k, threshold)
    # Copies are counted and reduced class by class, so that no join holds a large class.
    copies = points.where("n_shingles > 0").groupBy("point", "check", "doc_id", "digest").agg(F.count("*").alias("n"))
    row = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "digest", "n")
    heads = copies.groupBy("point", "check").agg(F.min(row).alias("row")).join(resolved, ["point", "check"]).groupBy("label").agg(F.min("row").alias("row"))
    empty = points.where("n_shingles = 0").select("doc_id", "digest").distinct()
    first = heads.select("row.doc_id", "row.digest", (F.col("row.n") > 1).alias("again")).unionByName(empty.withColumn("again", F.lit(False)))
    first = written(first.select(F.col("doc_id").alias("_first"), F.col("digest").alias("_digest"), "again"), "first")

    def rows(chosen: DataFrame) -> DataFrame:
        return docs.join(chosen, (_digest() == chosen["_digest"]) & docs["doc_id"].eqNullSafe(chosen["_first"]), "left_semi")

    kept = rows(first.where("NOT again"))
    if first.where("again").limit(1).count() == 0:
        return kept
    several = rows(first.where("again")).groupBy("doc_id", _digest().alias("_digest")).agg(F.first(F.struct(*docs.columns)).alias("_row"))
    return kept.unionByName(several.select("_row.*"))
