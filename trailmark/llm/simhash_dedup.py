"""Near-dedup by SimHash with covering locality-sensitive hashing.

Fingerprints of 64 bits link when they differ in at most RADIUS bits. For radius r, bit i gets a nonzero vector m(i)
of r + 1 bits, and each of the 2^(r+1) - 1 nonzero vectors v gives a mask with the bits i whose m(i).v is odd. At most
r differing bits span a space of at most r dimensions, so some v is orthogonal to all their vectors: in that mask none
of the differing bits appears and the pair agrees. Every linked pair therefore meets in at least one table, whatever
the data.

Equal fingerprints are first made one. Within a bucket of a table the links are found by a search that compares each
fingerprint only with those not yet reached and passes on a spanning tree of the links: no more edges than members,
and not all pairs. The fingerprints of copies of one text are equal, and those within RADIUS of one fingerprint number
at most sum(C(64, k), k <= 4) = 679,121, which bounds what one family of near copies can put into a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import votes
from trailmark.llm.common import ascii_lower, one_of_each, table, words, written
from trailmark.llm.components import components

#: Words of a shingle and differing bits of a link, as the contract of the query has them.
SPAN, RADIUS = 4, 4


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 covering masks, each as a signed 64-bit integer."""
    nonzero = (1 << (radius + 1)) - 1
    vector = [1 + i % nonzero for i in range(bits)]
    out = []
    for v in range(1, nonzero + 1):
        mask = sum(1 << i for i in range(bits) if bin(vector[i] & v).count("1") % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.lit("text"), F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, copies, fp): one row for each different (doc_id, text); copies counts its rows in docs."""
    cut = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), words(ascii_lower(F.col("text"))).alias("w"))
    at = votes.exploded(cut, "w", span)
    shingle = F.concat_ws(" ", *[F.get("w", F.col("i") + k) for k in range(span)])
    hashed = at.select("doc_id", "text_key", "i", F.when(F.col("i").isNotNull(), F.xxhash64(shingle)).alias("h"))
    sums = hashed.groupBy("doc_id", "text_key").agg(
        F.count("h").alias("terms"),
        F.sum(F.when(F.coalesce(F.col("i"), F.lit(0)) == 0, 1).otherwise(0)).alias("copies"),
        *votes.lane_sums(F.col("h"), None, "s"),
    )
    return sums.select("doc_id", "text_key", "copies", votes.majority("s", F.col("terms")).alias("fp"))


def _tree(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the components of different fingerprints under distance <= radius."""
    us, vs = [], []
    left = fps
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                found = left[near]
                us.append(found)
                vs.append(np.full(len(found), at, dtype=np.uint64))
                front.extend(found)
                left = left[~near]
    if not us:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(us), np.concatenate(vs)


def _bucket_links(radius: int):
    """Of rows sorted by (mask, part, fp): the edges inside each bucket. Only the last bucket of a batch waits."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            if held:
                now = [np.concatenate(x) for x in zip(held, now, strict=True)]
            if not len(now[0]):
                continue
            change = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0)) + 1
            cut = int(change[-1]) if len(change) else 0
            yield from _edges(now[2][:cut], change[:-1] if len(change) else change, radius)
            held = [x[cut:] for x in now]
        if held:
            yield from _edges(held[2], np.empty(0, np.int64), radius)

    return links


def _edges(fps: np.ndarray, cuts: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    if len(fps) < 2:
        return
    starts = np.concatenate([[0], cuts]).astype(np.int64)
    ends = np.concatenate([cuts, [len(fps)]]).astype(np.int64)
    sizes = ends - starts
    fps = fps.view(np.uint64)
    us, vs = [], []
    two = starts[sizes == 2]
    near = np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius
    us.append(fps[two][near])
    vs.append(fps[two + 1][near])
    for a, b in zip(starts[sizes > 2], ends[sizes > 2], strict=True):
        u, v = _tree(fps[a:b], radius)
        us.append(u)
        vs.append(v)
    u, v = np.concatenate(us), np.concatenate(vs)
    if len(u):
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v) between different fingerprints of the column fp that keep all links connected."""
    keyed = distinct.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"), F.col("fp"))
                    for k, m in enumerate(masks(radius))
                ]
            )
        ).alias("x")
    ).select("x.*")
    placed = keyed.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp")
    return placed.mapInArrow(_bucket_links(radius), "u bigint, v bigint").distinct()


def _placed(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) for each different fingerprint of rows (doc_id, fp): its component's least fingerprint
    and least doc_id."""
    heads = written(rows.groupBy("fp").agg(F.min("doc_id").alias("head")), "distinct-fingerprints")
    roots = components(links(heads.select("fp"), radius))
    placed = heads.join(roots, heads.fp == roots.u, "left").select(
        "fp", "head", F.coalesce("root", "fp").alias("root")
    )
    placed = written(placed, "placed")
    least = placed.groupBy("root").agg(F.min("head").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def near_components(docs: DataFrame, span: int = SPAN, radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: doc_id, text_key, fingerprint (16 hex digits), component_id.

    Null and blank texts have the fingerprint zero and are linked like any other. component_id is the smallest doc_id
    that links lead to, the row's own included; null ids never are that, unless there is no other. Repeated rows get
    equal results each. Other columns of docs are ignored; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, span), "fingerprints")
    return (
        rows.join(_placed(rows, radius).drop("root"), "fp")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select("doc_id", "text_key", votes.hex64(F.col("fp")).alias("fingerprint"), "component_id")
    )


def text_roots(docs: DataFrame, span: int = SPAN, radius: int = RADIUS) -> DataFrame:
    """(text_key, root) for each different text of docs: the least fingerprint of its component."""
    rows = written(fingerprints(docs, span), "fingerprints")
    return rows.join(_placed(rows, radius), "fp").select("text_key", "root").distinct()


def keep_one(docs: DataFrame, span: int = SPAN, radius: int = RADIUS) -> DataFrame:
    """The rows of docs with one document of each component left, with docs' own columns: the one with the least doc_id
    (null ids last, then by text key; of rows with that id and text the one with the least row key, so a rerun keeps
    the same). Unrelated documents that share an id are components of their own. Odd rows as in `near_components`."""
    rows = written(fingerprints(docs, span), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    best = rows.join(_placed(rows, radius), "fp").groupBy("root").agg(F.min(rank).alias("x")).select("x.*")
    mark = lambda key: F.concat_ws(":", F.col("doc_id").cast("string"), key)
    return one_of_each(docs, mark(_text_key(F.col("text"))), best.select(mark(F.col("text_key")).alias("__mark")))


QUERY = "op7_simhash_dedup"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents")).drop("text_key")
