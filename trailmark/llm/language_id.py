"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of 1 to 3 characters of the lower-cased text (runs of characters that aren't letters are one blank) are hashed
to buckets. Document frequencies are counted over all learnable documents. A feature's value is the n-gram's share of
the text's n-grams times its inverse document frequency, so a score is the mean of idf-weighted coefficients over the
whole text; the n-grams of a long text are made a stretch at a time, each stretch with the characters that follow it. Coefficients follow the regularised leader under an
elastic net; a part of the sample is set aside to fit the temperature by which the scores are calibrated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import table
from trailmark.llm.ftrl import Ftrl, csr, fold, gathered

#: Documents the model is fitted on, at most about; all learnable documents count for the document frequencies.
TRAIN_ROWS = 8_000
EPOCHS = 3
ALPHA, L1, L2 = 0.5, 0.01, 0.001
BITS = 16
BUCKETS = 1 << BITS
ORDERS = (1, 2, 3)
#: N-grams made at a time, which bounds memory and changes no result; the factor on values that keeps steps of the fit
#: in scale.
PIECE, SCALE = 500_000, 10.0
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def pieces(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a whole text with a blank at either end, at most PIECE of them at a time. A stretch
    takes along the characters that its last n-grams reach into, so every n-gram comes once wherever stretches end."""
    if not text:
        return
    plain = " " + _OTHERS.sub(" ", text.lower()) + " "
    for at in range(0, len(plain), PIECE):
        stretch = plain[at : at + PIECE + max(ORDERS) - 1].encode("utf-32-le", "replace")
        points = np.frombuffer(stretch, dtype=np.uint32).astype(np.uint64)
        for n in ORDERS:
            h = np.zeros(max(0, min(PIECE, len(points) - n + 1)), dtype=np.uint64)
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + points[k : k + len(h)] + np.uint64(n)
            yield ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets of a whole text and how often each occurs."""
    grams = list(pieces(text))
    return np.unique(np.concatenate(grams), return_counts=True) if grams else (np.empty(0, np.int64), np.empty(0, np.int64))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of texts: one row for each task, the number of documents that have each bucket, and of all documents."""
    seen, total = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        texts = batch.column(0)
        for k in range(len(texts)):
            text = texts[k].as_py()
            total += 1
            has = np.zeros(BUCKETS, bool)
            for grams in pieces(text):
                has[grams] = True
            seen[has] += 1
    if total:
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1), pa.int64()), pa.array(np.append(seen[used], total), pa.int64())],
            names=["bucket", "n"],
        )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """idf by bucket over all rows of texts (one column): counts are added up in the cluster, one row per bucket."""
    rows = texts.mapInArrow(_frequencies, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    total = int(n[at < 0].sum())
    df = np.zeros(BUCKETS)
    df[at[at >= 0]] = n[at >= 0]
    return np.log((1 + total) / (1 + df)) + 1.0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        found = [counts(texts[k].as_py()) for k in range(len(texts))]
        offsets = pa.array(np.cumsum([0] + [len(i) for i, _ in found]).astype(np.int32))
        ids = np.concatenate([i for i, _ in found] or [np.empty(0)]).astype(np.int32)
        ns = np.concatenate([v for _, v in found] or [np.empty(0)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(ns))],
            names=["label", "ids", "ns"],
        )


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature (0.05 to 20) with the least log loss on rows the weights were not fitted on."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20.0), 121))
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    """Languages, coefficients (buckets by languages, idf and scale applied), biases and temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, heat: float):
        self.languages, self.weights, self.bias, self.heat = languages, weights, bias, heat

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for grams in pieces(text):
            total += self.weights[grams].sum(axis=0)
            n += len(grams)
        return total / max(n, 1) + self.bias


def fit(y: np.ndarray, languages: list[str], ids, ns, offsets, idf: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """The model of a sample; every fifth row of a seeded order is set aside for the temperature."""
    k = len(languages)
    model, bias = Ftrl(BUCKETS, k, alpha=ALPHA, l1=L1, l2=L2), Ftrl(1, k, alpha=0.1)
    rows = [slice(offsets[r], offsets[r + 1]) for r in range(len(y))]
    order = np.array(sorted(range(len(y)), key=lambda r: (ids[rows[r]].tobytes(), ns[rows[r]].tobytes(), int(y[r]))), dtype=int)
    rng, one = np.random.default_rng(seed), np.zeros(1, dtype=int)
    order = rng.permutation(order)
    aside, learn = order[::5], order[np.arange(len(order)) % 5 != 0] if len(order) >= 5 else order
    values = lambda r: SCALE * ns[rows[r]] / ns[rows[r]].sum() * idf[ids[rows[r]]]
    for _ in range(epochs):
        for r in rng.permutation(learn):
            at, x = ids[rows[r]], values(r)
            w, b = model.weights(at), bias.weights(one)
            off = _softmax(x @ w + b[0])
            off[y[r]] -= 1.0
            model.update(at, np.outer(x, off), w)
            bias.update(one, off[None, :], b)
    w, b = model.weights(), bias.weights(one)[0]
    logits = np.array([values(r) @ w[ids[rows[r]]] + b for r in aside]).reshape(len(aside), k)
    return Model(languages, (w * idf[:, None] * SCALE), b, temperature(logits, y[aside]))


def trained(docs: DataFrame, rows: int = TRAIN_ROWS, held: int = 0, folds: int = 5) -> Model:
    """The model of the documents outside the held-out fold with a language and a letter; the sample is bounded and
    dealt evenly over languages as far as they go, the document frequencies are those of all such documents."""
    learnable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held)
    ).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in learnable.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return Model([UNKNOWN], np.zeros((BUCKETS, 1)), np.zeros(1), 1.0)
    idf = inverse_frequencies(learnable.select("text"))
    share = max(1, rows // len(languages))
    # of each language about `share` documents, by a hash of the id
    part = F.crc32(F.concat(F.lit("lang"), F.col("doc_id").cast("string")).cast("binary"))
    cut = F.lit(0.0)
    for name in languages:
        cut = F.when(F.col("lang") == name, F.lit(min(1.0, share / sizes[name]) * 2.0**32)).otherwise(cut)
    chosen = learnable.where(part < cut).select("lang", "text")
    got = gathered(chosen.mapInArrow(_counted, "lang string, ids array<int>, ns array<int>"), "ids")
    ids, offsets = csr(got.column("ids"))
    ns, _ = csr(got.column("ns"))
    index = {name: k for k, name in enumerate(languages)}
    y = np.array([index[x] for x in got.column("lang").to_pylist()], dtype=int)
    return fit(y, languages, ids, ns, offsets, idf)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of docs; `und` with score 0 where text is null or has no letter.

    The score is the calibrated probability of the predicted language. Repeated rows are scored one by one; other
    columns of docs are ignored, and an empty table gives no rows. The model's size is fixed by buckets and languages.
    """
    small = Model(model.languages, model.weights.astype(np.float32), model.bias, model.heat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            names, scores = [], []
            for k in range(len(texts)):
                text = texts[k].as_py()
                if not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = _softmax(small.logits(text) / small.heat)
                best = int(np.argmax(p))
                names.append(small.languages[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


QUERY = "op9_language_id"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return predict(docs, trained(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
