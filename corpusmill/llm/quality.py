"""Quality classifier by compression.

Two zstandard dictionaries are built from texts labelled good and texts labelled bad. A text is
compressed piece by piece against each; the difference of the two sizes over their sum says which
class's words and habits it shares, and a logistic curve fitted on other labelled rows turns that into
a probability.

What is learnt comes from a bounded sample: per class `per_class` labelled rows for the dictionaries and
as many again of all rows for the curve, the first by a hash of doc_id. Scoring reads whole texts of all documents in one pass, with
no shuffle; only the two dictionaries (`dict_bytes` each) and two numbers travel.

Defined cases: null and empty texts compress to nothing and get the score of a zero difference; a null
doc_id is kept and isn't held out; labels that are null or not 0 or 1 teach nothing; where a doc_id has
several labels the highest counts; if a class has no labelled text, all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices, whole_text

LEVEL = 3


def held_out():
    """Whether a document is kept from learning: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def _pieces(raw: bytes, size: int) -> list[bytes]:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    slope: float
    offset: float
    piece: int

    def scorer(self):
        """A function from text to the normalised difference."""
        import zstandard

        def against(raw: bytes):
            kept = zstandard.ZstdCompressionDict(raw)
            kept.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False, write_dict_id=False, write_checksum=False).compress

        if not self.good or not self.bad:
            return lambda text: 0.0
        good, bad = against(self.good), against(self.bad)

        def difference(text: str) -> float:
            g = b = 0
            for part in _pieces(text.encode("utf-8", "surrogatepass"), self.piece):
                g += len(good(part))
                b += len(bad(part))
            return (b - g) / (b + g) if b else 0.0

        return difference

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with a slight ridge so that separable data converge."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _dictionary(texts: list[str], size: int, piece: int) -> bytes:
    import zstandard

    parts = [p for t in texts for p in _pieces(t.encode("utf-8", "surrogatepass"), piece)]
    try:
        return zstandard.train_dictionary(size, parts, level=LEVEL, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(parts)[-size:]


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1200, dict_bytes: int = 112_640, piece: int = 512, longest: int = 65_536) -> Model:
    """Learn from rows of labels that aren't held out; texts over `longest` bytes teach nothing.

    What comes to the driver is bounded by 4 * per_class texts of at most `longest` bytes, and the query
    fetches them in two parts.
    """
    marked = labels.where(F.col("quality").isin(0, 1)).where(~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    # Where a drawn row has no text, or too long a one, the sample is that much smaller.
    taught = [marked.where(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class).select("doc_id", "quality", F.lit(True).alias("teach")) for q in (0, 1)]
    curve = marked.orderBy(F.xxhash64(F.col("doc_id"), F.lit("curve")), "doc_id").limit(2 * per_class).select("doc_id", "quality", F.lit(False).alias("teach"))
    sample = taught[0].unionByName(taught[1]).unionByName(curve)
    texts = docs.select("doc_id", "text").where(F.octet_length("text").between(1, longest))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "teach", "text").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text, r.teach))
    by_class = [[r.text for r in rows if r.teach and r.quality == q] for q in (0, 1)]
    if not all(by_class):
        return Model(b"", b"", 0.0, 0.0, piece)
    bad, good = (_dictionary(t, dict_bytes, piece) for t in by_class)
    seen = {r.doc_id for r in rows if r.teach}
    rest = [r for r in rows if not r.teach and r.doc_id not in seen] or [r for r in rows if r.teach]
    difference = Model(good, bad, 0.0, 0.0, piece).scorer()
    slope, offset = _logistic(np.array([difference(r.text) for r in rest]), np.array([float(r.quality) for r in rest]))
    return Model(good, bad, slope, offset, piece)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row of docs."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = model.scorer()
        for batch in text_slices(batches, "text"):
            x = np.array([difference(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.probability(x))], names=["doc_id", "score"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(score, "doc_id bigint, score double")


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = scored(docs, fit(docs, labels, **options))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose score is at least `least`."""
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        difference = model.scorer()
        for batch in text_slices(batches, "text"):
            x = np.array([difference(t or "") for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(model.probability(x) >= least)).select(names)

    return docs.mapInArrow(keep, docs.schema)
