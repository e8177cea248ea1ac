"""Quality classifier: similarity-weighted votes of the nearest labelled neighbours.

Terms are byte trigrams, hashed to ``dims`` columns, and a few terms for the build of a text (share of
its most frequent trigram, of symbols, of capitals, of line ends, of words said twice in a row, of
distinct words; length of words).  A truncated singular value decomposition of
the weighted counts of a bounded sample of labelled rows gives the latent space; the sample's vectors
and the projection are broadcast (their size is set by parameters).  Every document is projected, its
cosine with every labelled vector is computed exactly in blocks, and the ``neighbours`` nearest vote
with the weight of their similarity.

Learned from: up to ``sample`` rows of each label, the least by hash of their id, so a rerun learns
from the same rows.  Ids with contradicting labels and null labels are left out.  Null texts are empty
texts; a text without trigrams gets the label share of the sample, as does every text when there are
no labels to learn from (0.5 then).  Repeated rows get equal scores; null ids are scored; an empty table gives an empty
table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, whole

SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>!{}[]\\^~_="))
PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    sample: int = 1500
    dims: int = 2048
    rank: int = 32
    neighbours: int = 9
    block: int = 512
    sharpness: float = 8.0
    seed: int = 7


BUILD_BINS = 8
BUILD_TERMS = 7


def term_counts(text: bytes, dims: int) -> np.ndarray:
    """Weighted term counts of one text: hashed byte trigrams, then the terms of its build."""
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(dims + BUILD_TERMS * BUILD_BINS, np.float32)
    if len(raw) < 3:
        return out
    counts = np.zeros(dims, np.int64)
    for i in range(0, len(raw) - 2, PIECE):
        part = raw[i : i + PIECE + 2].astype(np.uint32)
        codes = (part[:-2] * np.uint32(2654435761) ^ part[1:-1] * np.uint32(2246822519) ^ part[2:] * np.uint32(3266489917)) >> np.uint32(15)
        counts += np.bincount(codes % np.uint32(dims), minlength=dims)
    kinds = np.bincount(raw, minlength=256)
    size, blanks = len(raw), int(kinds[32] + kinds[9:14].sum())
    words = text.split()
    letters = max(1, int(kinds[65:91].sum() + kinds[97:123].sum()))
    shares = (
        np.log2(1 + counts.max() * 64 / size) / 5,
        kinds[SYMBOLS].sum() * 8 / size,
        kinds[65:91].sum() / letters,
        size / max(1, blanks) / 20,
        kinds[10] * 20 / size,
        (sum(map(eq, words, words[1:])) / max(1, len(words) - 1)) ** 0.5,
        1 - len(set(words)) / max(1, len(words)),
    )
    build = np.zeros((BUILD_TERMS, BUILD_BINS), np.float32)
    for row, share in zip(build, shares, strict=True):
        row[min(BUILD_BINS - 1, int(share * BUILD_BINS))] = 1
    out[:dims] = np.log1p(counts)
    out[:dims] /= max(1e-9, float(np.linalg.norm(out[:dims])))
    out[dims:] = build.ravel() / np.sqrt(BUILD_TERMS)
    return out


@dataclass
class Model:
    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = (counts * self.weights) @ self.axes
        size = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, size, out=np.zeros_like(latent), where=size > 1e-9)

    def scores(self, counts: np.ndarray, settings: Settings) -> np.ndarray:
        """Share of label 1 in the weighted votes of the nearest neighbours."""
        latent = self.project(counts)
        out = np.full(len(latent), self.prior)
        if not len(self.labels):
            return out
        near = min(settings.neighbours, len(self.labels))
        cosine = latent @ self.vectors.T
        best = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
        weight = np.clip(np.take_along_axis(cosine, best, axis=1), 0, 1).astype(np.float64) ** settings.sharpness
        total = weight.sum(axis=1)
        voted = (total > 1e-12) & (np.abs(latent).sum(axis=1) > 0)
        out[voted] = (weight * self.labels[best]).sum(axis=1)[voted] / total[voted]
        return np.clip(out, 0.0, 1.0)


def _counted(docs: DataFrame, id_column: str, text: str, settings: Settings) -> DataFrame:
    """(id, counts): the term counts of every row as bytes of float32."""
    docs = docs.select(F.col(id_column), whole(text).cast("binary").alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            counts = [term_counts(t.as_py(), settings.dims).astype(np.float16).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.binary())], names=[id_column, "counts"])

    return docs.mapInArrow(run, f"`{id_column}` {kind}, counts binary")


def chosen_rows(labels: DataFrame, id_column: str, label: str, sample: int) -> DataFrame:
    """(id, label) of at most ``sample`` ids of each label."""
    sure = labels.filter(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min(label).alias("low"), F.max(label).alias("high")).filter("low = high")
    of = [sure.filter(F.col("low") == one).orderBy(F.xxhash64(id_column), id_column).limit(sample) for one in (0, 1)]
    return of[0].union(of[1]).select(id_column, F.col("low").cast("int").alias("label"))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", settings: Settings = Settings()) -> Model:
    """The latent space and labelled vectors, from at most ``2 * settings.sample`` rows."""
    chosen = chosen_rows(labels, id_column, label, settings.sample)
    rows = docs.select(id_column, text).join(F.broadcast(chosen.select(id_column)), id_column, "left_semi")  # at most 2 * sample ids
    one = _counted(rows, id_column, text, settings).groupBy(id_column).agg(F.min("counts").alias("counts"))
    got = one.join(chosen, id_column).orderBy(id_column).collect()
    width = settings.dims + BUILD_TERMS * BUILD_BINS
    counts = np.frombuffer(b"".join(r["counts"] for r in got), np.float16).reshape(-1, width).astype(np.float32)
    y = np.array([r["label"] for r in got], np.float64)
    df = (counts > 0).sum(axis=0)
    weights = np.log((1 + len(y)) / (1 + df)).astype(np.float32) + np.float32(1)
    axes = _axes(counts * weights, settings)
    model = Model(weights, axes, np.empty((0, axes.shape[1]), np.float32), y, float(y.mean()) if len(y) else 0.5)
    if len(y):
        model.vectors = model.project(counts)
    return model


def _axes(matrix: np.ndarray, settings: Settings) -> np.ndarray:
    """The leading right singular vectors, by block power iteration."""
    rank = max(1, min(settings.rank, *matrix.shape))
    basis = np.random.default_rng(settings.seed).standard_normal((matrix.shape[1], rank + 16)).astype(np.float32)
    for _ in range(8 if len(matrix) else 0):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    if not len(matrix):
        return basis[:, :rank]
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ turn.T)[:, :rank]).astype(np.float32)


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, score) of every row; the score is near 1 where label 1 is likely."""
    docs = docs.select(F.col(id_column), whole(text).cast("binary").alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = []
            for begin in range(0, batch.num_rows, settings.block):
                part = batch.column(1).slice(begin, settings.block)
                found.append(shared.value.scores(np.array([term_counts(t.as_py(), settings.dims) for t in part]), settings))
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], names=[id_column, "score"])

    return docs.mapInArrow(run, f"`{id_column}` {kind}, score double")
