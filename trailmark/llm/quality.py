"""Quality classifier: hashed word n-gram logistic regression, fitted by following the regularised leader.

The n-grams are of two spellings of each word of the whole text: the word in lower case without punctuation at its
ends (1-grams), and its shape (letters as a, or A in capitals, digits as 0, other characters kept; 1- and 2-grams),
with a mark where a word repeats the one before it. A feature's value is its share among the text's n-grams of its
kind, so a score is a sparse dot product that does not depend on the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import word_features as W
from trailmark.llm.common import table
from trailmark.llm.ftrl import Ftrl, csr, fold, gathered, sampled, sigmoid

#: Labelled rows the model is fitted on, at most about.
TRAIN_ROWS = 12_000
EPOCHS = 4
ALPHA, L1, L2 = 2.0, 0.05, 0.001
#: Kinds of n-grams: words, shapes, pairs of shapes. Each has its own buckets.
KINDS = 3
SIZE = KINDS * W.BUCKETS
_REPEAT = W.bucket("s:<repeat>")


def ngrams(text: str | None) -> list[np.ndarray]:
    """The buckets of a whole text's n-grams, by kind, with repeats."""
    code = W.codes(text)
    if not len(code):
        return [np.empty(0, np.int64)] * KINDS
    shapes = W.shape_buckets(code)
    shapes[1:][code[1:] == code[:-1]] = _REPEAT
    pairs = W.mixed(shapes[:-1], shapes[1:], 1)
    return [W.bare_buckets(code), shapes + W.BUCKETS, pairs + 2 * W.BUCKETS]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets and their values."""
    ids, values = [], []
    for grams in ngrams(text):
        if len(grams):
            at, n = np.unique(grams, return_counts=True)
            ids.append(at)
            values.append(n / len(grams))
    if not ids:
        return np.empty(0, np.int64), np.empty(0)
    return np.concatenate(ids), np.concatenate(values)


def dot(weights: np.ndarray, text: str | None) -> float:
    """The sparse dot product of a text's features and the weights."""
    return float(sum(weights[g].mean() for g in ngrams(text) if len(g)))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        found = [features(texts[k].as_py()) for k in range(len(texts))]
        offsets = pa.array(np.cumsum([0] + [len(i) for i, _ in found]).astype(np.int32))
        ids = np.concatenate([i for i, _ in found] or [np.empty(0)]).astype(np.int32)
        values = np.concatenate([v for _, v in found] or [np.empty(0)]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(values))],
            names=["label", "ids", "xs"],
        )


def fit(y: np.ndarray, ids: np.ndarray, xs: np.ndarray, offsets: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> tuple[np.ndarray, float]:
    """(weights, bias) of labelled rows; without rows the score is one half, with one label it leans to it."""
    model, bias = Ftrl(SIZE, alpha=ALPHA, l1=L1, l2=L2), Ftrl(1, alpha=0.1)
    keys = [ids[offsets[k] : offsets[k + 1]].tobytes() for k in range(len(y))]
    order = np.array(sorted(range(len(y)), key=lambda k: (keys[k], int(y[k]))), dtype=int)
    rng, one = np.random.default_rng(seed), np.zeros(1, dtype=int)
    for _ in range(epochs):
        for k in rng.permutation(order):
            at = ids[offsets[k] : offsets[k + 1]]
            x = xs[offsets[k] : offsets[k + 1]]
            w, b = model.weights(at), bias.weights(one)
            off = float(sigmoid(w @ x + b[0])) - y[k]
            model.update(at, off * x, w)
            bias.update(one, np.array([off]), b)
    return model.weights(), float(bias.weights(one)[0])


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, held: int = 1, folds: int = 3) -> tuple[np.ndarray, float]:
    """The model of a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.where(F.col("quality").isNotNull() & (fold(F.col("doc_id"), folds) != held))
    chosen = sampled(known.groupBy("doc_id").agg(F.max("quality").alias("label")), rows, "quality")
    # about `rows` rows of two integers: small by the bound
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.col("label").cast("int"), "text")
    got = gathered(joined.mapInArrow(_featured, "label int, ids array<int>, xs array<float>"), "ids")
    if got.num_rows == 0:
        return np.zeros(SIZE), 0.0
    ids, offsets = csr(got.column("ids"))
    xs, _ = csr(got.column("xs"))
    return fit(got.column("label").to_numpy(), ids, xs.astype(float), offsets)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) for each row of docs: the likelihood of label 1.

    An empty or null text has no features and gets the model's bias. Repeated rows are scored one by one; other
    columns of docs are ignored, and an empty table gives no rows. The model's size is fixed (3 MB).
    """
    weights, bias = model[0].astype(np.float32), model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            out = sigmoid(np.array([dot(weights, texts[k].as_py()) + bias for k in range(len(texts))]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id bigint, score double")


QUERY = "op2_quality"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, trained(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
