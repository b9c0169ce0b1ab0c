"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity has four grades: 0 for clean, then, for the rows labelled toxic, by how many different words of a text are
tied to the toxic label: at most one, two or three, four or more. Labels are binary, so the grades above the first are
made here; which words are tied is learned on the other half of the labelled rows, so that no row grades itself.
P(grade >= k) = sigmoid(w.x - theta_k): the weights are shared by the ordered thresholds.
x marks the words (lower case, bare of punctuation) and their leading 4, 5 and 6 letters, hashed, that occur anywhere
in the text; the beginnings catch forms of a word that the labelled rows don't have. Weights follow the
regularised leader with an L1 penalty, so words without evidence weigh nothing and long clean texts stay clean; the
thresholds go down the same likelihood and are kept in order. The output is the expected severity, the sum of
P(grade >= k), and a text is toxic when P(grade >= 1) is at least CUT.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import word_features as W
from trailmark.llm.common import table
from trailmark.llm.ftrl import Ftrl, csr, gathered, sigmoid

#: Labelled rows the model is fitted on, at most about; toxic ones come first, up to half of them.
TRAIN_ROWS = 16_000
GRADES, EPOCHS, CUT = 4, 4, 0.5
#: HEAVY is the weight of a toxic row in the likelihood; set, as L1 is, on held-out labelled rows.
ALPHA, L1, L2, HEAVY = 0.3, 10.0, 0.01, 3.0
#: Step of the thresholds, and the least distance between two of them.
STEP, GAP = 0.01, 0.5
#: The columns that `score` adds.
ADDED = ("expected_severity", "severity", "toxic")


def features(text: str | None) -> np.ndarray:
    """The different buckets of a whole text's words and of their beginnings, in order."""
    return W.stem_buckets(text)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        ids = [features(texts[k].as_py()) for k in range(len(texts))]
        offsets = np.cumsum([0] + [len(x) for x in ids]).astype(np.int32)
        values = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["label", "ids"]
        )


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels, bucket values, offsets) of a bounded sample of the labelled documents, chosen by a hash of doc_id: all
    rows of label 1 up to half of the bound, the others up to what is left."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    toxic = F.col("label") == 1
    n = known.agg(F.count_if(toxic).alias("toxic"), F.count_if(~toxic).alias("clean")).first()
    toxic_rows = min(n["toxic"], max(rows // 2, rows - n["clean"]))
    shares = [min(1.0, want / max(1, of)) for want, of in ((toxic_rows, n["toxic"]), (rows - toxic_rows, n["clean"]))]
    place = F.crc32(F.concat(F.lit("toxicity"), F.col("doc_id").cast("string")).cast("binary")) / F.lit(2.0**32)
    chosen = known.where(place < F.when(toxic, shares[0]).otherwise(shares[1]))
    # about `rows` rows of two integers: small by the bound
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "text")
    got = gathered(joined.mapInArrow(_featured, "label int, ids array<int>"), "ids")
    if got.num_rows == 0:
        return np.empty(0), np.empty(0, np.int64), np.zeros(1, np.int64)
    values, offsets = csr(got.column("ids"))
    return got.column("label").to_numpy(), values, offsets


def grades(y: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Severity grades of labelled rows: from the label, and how many words a row has that the other half of the rows
    (by the parity of a row's features) ties to it."""
    doc = np.repeat(np.arange(len(y)), np.diff(offsets))
    half = np.bincount(doc, weights=values % 2, minlength=len(y)).astype(np.int64) % 2
    count = np.zeros(len(y))
    for k in (0, 1):
        learn, use = half[doc] != k, half[doc] == k
        toxic, clean = max(1, int((y[half != k] == 1).sum())), max(1, int((y[half != k] == 0).sum()))
        p = np.bincount(values[learn & (y[doc] == 1)], minlength=W.BUCKETS)
        n = np.bincount(values[learn & (y[doc] == 0)], minlength=W.BUCKETS)
        tied = (p >= 3) & (p / toxic >= 20 * (n + 0.5) / clean)
        count += np.bincount(doc[use], weights=tied[values[use]], minlength=len(y))
    return np.where(y == 1, 1 + (count >= 2).astype(int) + (count >= 4), 0)


class Model:
    """Weights by bucket and the ordered thresholds."""

    def __init__(self, weights: np.ndarray, theta: np.ndarray):
        self.weights, self.theta = weights, theta

    def at_least(self, ids: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 and up, of the features of one text."""
        return sigmoid(self.weights[ids].sum() - self.theta)


def fit(
    y: np.ndarray, values: np.ndarray, offsets: np.ndarray, epochs: int = EPOCHS, alpha: float = ALPHA, l1: float = L1, seed: int = 7,
    heavy: float = HEAVY,
) -> Model:
    """The model of labelled rows; without rows of both labels nothing is toxic."""
    theta = np.arange(1.0, GRADES) + 2.5
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(W.BUCKETS), theta + 20.0)
    grade = grades(y, values, offsets)
    model = Ftrl(W.BUCKETS, alpha=alpha, l1=l1, l2=L2)
    # rows in an order that does not depend on how they arrived
    keys = [values[offsets[k] : offsets[k + 1]].tobytes() for k in range(len(y))]
    order = np.array(sorted(range(len(y)), key=lambda k: (keys[k], int(grade[k]))))
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        rate = STEP / (1 + epoch)
        for k in rng.permutation(order):
            ids, g = values[offsets[k] : offsets[k + 1]], grade[k]
            w = model.weights(ids)
            s = w.sum()
            a = 1.0 if g == 0 else float(sigmoid(s - theta[g - 1]))
            b = 0.0 if g == GRADES - 1 else float(sigmoid(s - theta[g]))
            h = heavy if g else 1.0
            model.update(ids, np.full(len(ids), h * (a + b - 1.0)), w)
            share = max(a - b, 1e-9)
            if g > 0:
                theta[g - 1] -= h * rate * min(5.0, a * (1 - a) / share)
            if g < GRADES - 1:
                theta[g] += h * rate * min(5.0, b * (1 - b) / share)
            spread = np.maximum(np.diff(theta), GAP)
            theta = theta.mean() + np.cumsum(np.append(0.0, spread)) - np.append(0.0, spread).cumsum().mean()
    return Model(model.weights(), theta)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with expected_severity, severity (0 to 3) and toxic added; a text that is null or has no word is clean.

    The model is part of the task (2 MB by its fixed size). Repeated rows are scored one by one; columns of docs with
    these names, in any case, are replaced. An empty table gives no rows.
    """
    weights, theta, cut = model.weights.astype(np.float32), model.theta, CUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(weights, theta)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            out = np.empty((len(texts), GRADES - 1))
            for k in range(len(texts)):
                ids = features(texts[k].as_py())
                out[k] = ready.at_least(ids) if len(ids) else 0.0
            names, columns = batch.schema.names, batch.columns
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(out.sum(axis=1)),
                    pa.array((out >= cut).sum(axis=1).astype(np.int32)),
                    pa.array(out[:, 0] >= cut),
                ],
                names=[*names, *ADDED],
            )

    kept = [f for f in docs.schema.fields if f.name.lower() not in ADDED]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.select(*[f"`{f.name}`" for f in kept]).mapInArrow(
        run, f"{schema}, expected_severity double, severity int, toxic boolean"
    )


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that are not toxic, with docs' own columns, whatever their names."""
    weights, theta, cut = model.weights.astype(np.float32), model.theta, CUT
    place = [f.name.lower() for f in docs.schema.fields].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(weights, theta)
        for batch in batches:
            found = (features(text.as_py()) for text in batch.column(place))
            yield batch.filter(pa.array([not len(ids) or bool(ready.at_least(ids)[0] < cut) for ids in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    return fit(*training_rows(docs, labels, "toxic", rows))


QUERY = "op4_toxicity"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = trained(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", "expected_severity", "severity", "toxic")
