"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms describe how the words of a text are written: their shape, their ending, and whether they repeat a
word shortly before. A singular value decomposition of the weighted term counts of a bounded, labelled
sample gives the latent space. The sample's vectors go to every task (their number and length are
parameters, so their size has a bound), and every text of the corpus is compared with all of them in
exact, blocked cosine products. The labels of its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallyvein.llm.words import _LOWER, prefix_hashes, span_hashes, text_slices, word_spans

#: Labelled rows that the classifier is fitted on, at most; the first by hash, whatever the corpus' size.
SAMPLE = 4096
DIMENSIONS = 48
NEIGHBOURS = 32
SHARPNESS = 4
#: Repeated words count so many times as much as other terms.
REPEATS = 3
ACCEPT = 0.3

_ENDINGS, _LAGS = 1024, 4
_CLASS = np.full(256, 5, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 3
_CLASS[list(b".,;:")] = 4
_UPPER = _CLASS == 1
_SHAPES = 6 * 6 * 2 * 8
TERMS = _SHAPES + _LAGS + _ENDINGS


def _terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of terms, one row per text."""
    starts, ends = word_spans(data, offsets)
    bounds = np.searchsorted(starts, offsets)
    texts = len(offsets) - 1
    if not len(starts):
        return np.zeros((texts, TERMS), np.float32)
    upper = np.concatenate(([0], np.cumsum(_UPPER[data])))
    shouted = upper[ends] - upper[starts] >= 2
    length = np.minimum(np.ceil(np.log2(ends - starts + 1) * 1.5).astype(np.int64) - 1, 7)
    shape = ((_CLASS[data[starts]] * 6 + _CLASS[data[ends - 1]]) * 2 + shouted) * 8 + length
    tail = (_LOWER[data[ends - 1]].astype(np.int64) * 256 + _LOWER[data[np.maximum(ends - 2, starts)]]) * 40503 % 65521 % _ENDINGS
    hashes = span_hashes(prefix_hashes(_LOWER[data]), starts, ends)
    row = np.repeat(np.arange(texts), np.diff(bounds))
    keys = [row * TERMS + shape, row * TERMS + _SHAPES + _LAGS + tail]
    for lag in range(1, _LAGS + 1):
        same = (hashes[lag:] == hashes[:-lag]) & (row[lag:] == row[:-lag])
        keys.append(row[lag:][same] * TERMS + _SHAPES + lag - 1)
    return np.bincount(np.concatenate(keys), minlength=texts * TERMS).reshape(texts, TERMS).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray  # inverse document frequencies
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # sample x dimensions, of length 1
    labels: np.ndarray
    prior: float

    @staticmethod
    def fit(counts: np.ndarray, labels: np.ndarray, dimensions: int) -> Model:
        seen = (counts > 0).sum(0)
        weights = np.log((1 + len(counts)) / (1 + seen)).astype(np.float32) + 1
        weights[_SHAPES : _SHAPES + _LAGS] *= REPEATS
        weighted = _unit(np.log1p(counts) * weights)
        _, vectors = np.linalg.eigh(weighted.T @ weighted)
        axes = np.ascontiguousarray(vectors[:, ::-1][:, :dimensions].astype(np.float32))
        return Model(weights, axes, _unit(weighted @ axes), labels.astype(np.float32), float(labels.mean()) if len(labels) else 0.5)

    def scores(self, counts: np.ndarray, neighbours: int, block: int = 512) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        known = np.flatnonzero(counts.any(1))
        if not len(self.labels):
            return out
        k = min(neighbours, len(self.labels))
        for i in range(0, len(known), block):
            rows = known[i : i + block]
            cosines = _unit((_unit(np.log1p(counts[rows]) * self.weights)) @ self.axes) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, 1).astype(np.float64), 1e-6) ** SHARPNESS
            out[rows] = (votes * self.labels[near]).sum(1) / votes.sum(1)
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _counted(batches):
    for batch in batches:
        for first, data, offsets in text_slices(batch.column(2)):
            counts = _terms(data, offsets)
            at = slice(first, first + len(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[at], batch.column(1)[at], pa.array([c.astype(np.float32).tobytes() for c in counts], pa.binary())], ["id", "label", "counts"]
            )


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    learn: Column | None = None, sample: int = SAMPLE, dimensions: int = DIMENSIONS,
) -> Model:
    """A model from at most ``sample`` labelled documents, the first by hash of those that ``learn`` admits.

    Null labels are not used; a document with several labels has their mean. If no labelled document is
    found, every text gets a score of a half.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(learn) if learn is not None else known
    chosen = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).groupBy("id").agg(F.avg("label").alias("label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Bounded by ``sample``, like what comes to the driver.
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("id"), "id").limit(sample))
    kind = dict(texts.dtypes)["id"]
    rows = texts.join(chosen, "id").select("id", "label", "text").mapInArrow(_counted, f"id {kind}, label double, counts binary")
    rows = rows.groupBy("id").agg(F.min("label").alias("label"), F.min("counts").alias("counts")).orderBy("id").collect()
    counts = np.array([np.frombuffer(r.counts, np.float32) for r in rows]).reshape(-1, TERMS)
    return Model.fit(counts, np.array([r.label for r in rows], np.float64), dimensions)


def quality_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", neighbours: int = NEIGHBOURS) -> DataFrame:
    """(id_col, score) for every row: 0 to 1, higher where label 1 is likelier.

    Null, empty and blank texts get the sample's mean label. Equal texts get equal scores; of neighbours
    that tie at the end of the list any may vote. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            parts = [shared.value.scores(_terms(data, offsets), neighbours) for _, data, offsets in text_slices(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else [], pa.float64())], [id_col, "score"])

    columns = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = StructType([columns.schema[0], StructField("score", DoubleType())])
    return columns.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, model: Model, text_col: str = "text", accept: float = ACCEPT, neighbours: int = NEIGHBOURS) -> DataFrame:
    """The rows of ``docs`` whose text scores ``accept`` or more, with all their columns; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            parts = [shared.value.scores(_terms(data, offsets), neighbours) for _, data, offsets in text_slices(batch.column(at))]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= accept))

    return docs.mapInArrow(run, docs.schema)
