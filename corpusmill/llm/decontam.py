"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are word sequences (runs of letters and digits, lower-cased; each character of a
script without spaces is a word). Runs of
`shortest` words that both hold are the seeds; documents and items meet through them. For each such pair,
the longest matches between unmarked words are found by running Karp-Rabin hashes at falling lengths and
marked, never overlapping. Tiles may come in any order, so a passage whose parts were moved about is
covered as well as a plain copy. A document is contaminated by an item whose words are covered by at
least `coverage`.

The benchmark is handled in blocks of about `block_items` items or `block_bytes` bytes, each a bounded broadcast
with a pass over all documents, so it may be of any size; documents are never shuffled.

Defined cases: null and empty texts hold no words and match nothing; items with fewer than `shortest`
words take no part; repeated items each count, repeated documents give repeated rows; null ids are kept
on documents; items without an id take no part in `contaminated`, and drop documents as others do.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, whole_text

_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_WORDS = re.compile(rf"[^\W_{_UNSPACED}]+|[{_UNSPACED}]").findall
_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def _windows(codes: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Start and rolling hash of each window of unmarked codes."""
    lead = pow(_BASE, size - 1, _MODULUS)
    run = h = 0
    for i, c in enumerate(codes):
        if not free[i]:
            run = h = 0
            continue
        if run == size:
            h = (h - codes[i - size] * lead) % _MODULUS
            run -= 1
        h = (h * _BASE + c) % _MODULUS
        run += 1
        if run == size:
            yield i - size + 1, h


def tiles(item: list[int], text: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two code sequences: (item start, text start, length), longest first."""
    free_i, free_t = [True] * len(item), [True] * len(text)
    out: list[tuple[int, int, int]] = []
    size = max(shortest, min(len(item), len(text)) // 2)
    while True:
        heads = defaultdict(list)
        for at, h in _windows(item, free_i, size):
            heads[h].append(at)
        matches = []
        for at, h in _windows(text, free_t, size):
            for start in heads.get(h, ()):
                if item[start : start + size] != text[at : at + size]:
                    continue
                if start and at and free_i[start - 1] and free_t[at - 1] and item[start - 1] == text[at - 1]:
                    continue  # the match that begins a word earlier holds this one
                n = size
                while start + n < len(item) and at + n < len(text) and item[start + n] == text[at + n] and free_i[start + n] and free_t[at + n]:
                    n += 1
                matches.append((n, start, at))
        again = False
        for n, start, at in sorted(matches, key=lambda m: (-m[0], m[1], m[2])):
            if all(free_i[start : start + n]) and all(free_t[at : at + n]):
                free_i[start : start + n] = free_t[at : at + n] = [False] * n
                out.append((start, at, n))
            else:
                again = True  # what is left of it may still be long enough
        if not again:
            if size == shortest:
                return out
            size = max(shortest, size // 2)


class Items:
    """A block of benchmark items with its seeds."""

    def __init__(self, rows: list[tuple[int, str]], shortest: int, coverage: float):
        self.shortest, self.coverage = shortest, coverage
        self.items = [(i, w) for i, w in ((i, words_of(t)) for i, t in rows) if len(w) >= shortest]
        self.seeds: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for k, (_, w) in enumerate(self.items):
            for p in range(len(w) - shortest + 1):
                self.seeds[tuple(w[p : p + shortest])].append((k, p))
        self.seeds = dict(self.seeds)
        self.heads = {s[0] for s in self.seeds}

    def hits(self, words: list[str]) -> Iterator[tuple[int, int, int, float]]:
        """Item id, covered words, number of tiles and coverage of each item that the words contaminate."""
        n, heads, seeds = self.shortest, self.heads, self.seeds
        shared: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at in [i for i, w in enumerate(words) if w in heads]:
            for k, p in seeds.get(tuple(words[at : at + n]), ()):
                shared[k].append((p, at))
        for k, pairs in shared.items():
            item_id, item = self.items[k]
            if len({q for p, _ in pairs for q in range(p, p + n)}) < self.coverage * len(item):
                continue
            # Only seeds can be part of a tile: the text is cut to them, with a code that matches nothing between.
            code = {w: i + 1 for i, w in enumerate(set(item))}
            text, upto = [], -1
            for at in sorted({a for _, a in pairs}):
                if at > upto and text:
                    text.append(0)
                text += [code.get(w, 0) for w in words[max(at, upto) : at + n]]
                upto = at + n
            found = tiles([code[w] for w in item], text, n)
            covered = sum(t[2] for t in found)
            if covered >= self.coverage * len(item):
                yield item_id, covered, len(found), covered / len(item)


def _blocks(benchmark: DataFrame, shortest: int, coverage: float, block_items: int, block_bytes: int) -> Iterator[Items]:
    """The items in blocks, which bound each fetch."""
    rows = benchmark.where(F.col("text").isNotNull()).select("item_id", "text", F.xxhash64("item_id", "text").alias("at"))
    count, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n = max(-(-count // block_items), -(-(size or 0) // block_bytes))
    for k in range(n):
        part = rows.where(F.pmod("at", F.lit(n)) == k).collect()
        yield Items(sorted(((r.item_id, r.text) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1])), shortest, coverage)


def contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = 5, coverage: float = 0.7, block_items: int = 20_000, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, item_id, covered, n_tiles and coverage of each pair over the threshold."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    schema = "doc_id bigint, item_id bigint, covered bigint, n_tiles bigint, coverage double"
    out = None
    for items in _blocks(benchmark.where(F.col("item_id").isNotNull()), shortest, coverage, block_items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text"):
                rows = [(i, *h) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for h in shared.value.hits(words_of(t))]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "covered", "n_tiles", "coverage"])

        part = texts.mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shortest: int = 5, coverage: float = 0.7, block_items: int = 20_000, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of docs, with all columns, that no item contaminates."""
    names, out = docs.columns, docs
    for items in _blocks(benchmark, shortest, coverage, block_items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches, "text"):
                clean = [next(shared.value.hits(words_of(t or "")), None) is None for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean)).select(names)

        out = out.mapInArrow(keep, docs.schema)
    return out
