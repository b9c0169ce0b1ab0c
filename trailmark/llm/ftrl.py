"""Follow-the-regularised-leader (proximal, per coordinate) for sparse linear models, and the bounded sample they fit."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import written

#: Features (of all sampled rows together) that the driver takes at most, about: under 200 MB at 12 bytes each with their
#: copies. A sample with more is thinned by a hash of its rows.
TRAIN_TERMS = 16_000_000


class Ftrl:
    """Weights of `size` features (by `outputs` columns if given) under L1 and L2 penalties (elastic net)."""

    def __init__(self, size: int, outputs: int = 0, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.0, l2: float = 0.0):
        shape = (size, outputs) if outputs else size
        self.z = np.zeros(shape)
        self.n = np.zeros(shape)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, ids=slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, ids: np.ndarray, gradient: np.ndarray, w: np.ndarray) -> None:
        """ids must not repeat; gradient and w have a row for each."""
        n = self.n[ids]
        more = n + gradient * gradient
        self.z[ids] += gradient - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[ids] = more


def sigmoid(x):
    """Elementwise logistic function, without overflow."""
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, dtype=float)))


def sampled(labelled: DataFrame, rows: int, seed: str) -> DataFrame:
    """All of `labelled`, or of more than `rows` rows about so many, chosen by a hash of doc_id."""
    there = labelled.count()
    if there <= rows:
        return labelled
    cut = math.floor(rows / there * 2**32)
    return labelled.where(F.crc32(F.concat(F.lit(seed), F.col("doc_id").cast("string")).cast("binary")) < cut)


def gathered(featured: DataFrame, ids: str, most: int = TRAIN_TERMS) -> pa.Table:
    """The feature rows of a sample, on the driver. They are bounded in number by the sample and in bytes by `most`, as
    a row has no more different features than there are buckets, however long its text."""
    rows = written(featured, "features")
    terms = rows.agg(F.sum(F.size(ids))).first()[0] or 0
    if terms > most:
        rows = rows.where(F.abs(F.hash(ids) % 1_000_000) < math.floor(1_000_000 * most / terms))
    return rows.toArrow()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo folds; null ids fall in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def csr(lists) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a column of arrays that toArrow gave."""
    col = lists.combine_chunks()
    return col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
