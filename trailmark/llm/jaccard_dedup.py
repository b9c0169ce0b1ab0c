"""Near-dedup by the Jaccard similarity of word shingles, for stages that need the rule and not SimHash's few bits.

Two texts link when their sets of SPAN-word shingles (64-bit hashes; shorter texts are one shingle) have a Jaccard
similarity of LEAST or more. Candidates meet in bands of MinHashes: DEPTH equal minima in one of BANDS bands. A pair
at similarity s misses every band with probability (1 - s^DEPTH)^BANDS, 5 in a million at 0.8 and less above it. All
links are then decided by the whole sets. Components that another method found (the pipeline's: SimHash with covering
tables) are candidates too.

Equal sets are first made one, and of bands with the same members one stays. Within a band the links are found by a
search that compares each set only with those not yet reached and passes on a spanning tree: no more edges than
members, and not all pairs. A band is held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import ascii_lower, one_of_each, words, written
from trailmark.llm.components import components

#: Words of a shingle, and the least similarity of a link as a ratio.
SPAN, LEAST = 5, (4, 5)
BANDS, DEPTH = 40, 6
#: Shingles whose minima are taken at once.
CHUNK = 2048


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.lit("text"), F.coalesce(text, F.lit("")))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(ascii_lower(text)), lambda w: F.xxhash64(w))


def shingle_set(hashes: np.ndarray, span: int = SPAN) -> np.ndarray:
    """The different shingles of a text's word hashes, in order; a text of fewer words is one shingle."""
    x = hashes.astype(np.uint64)
    if not len(x):
        return x
    n = max(1, len(x) - span + 1)
    out = np.full(n, min(len(x), span), np.uint64)
    for k in range(min(len(x), span)):
        out = (out ^ x[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _steps(bands: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    a, b = (rng.integers(0, 1 << 64, bands * depth, np.uint64) for _ in range(2))
    return a | np.uint64(1), b


def band_keys(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """A 64-bit key of each band's minima."""
    least = np.full(len(a), np.iinfo(np.uint64).max)
    for k in range(0, len(shingles), CHUNK):
        np.minimum(least, (shingles[k : k + CHUNK, None] * a + b).min(axis=0), out=least)
    key = np.zeros(len(a) // depth, np.uint64)
    for column in least.reshape(-1, depth).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    values, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    at = at - at[0]
    for k in range(len(column)):
        yield values[at[k] : at[k + 1]]


def _packed(arrays: list[np.ndarray]) -> pa.ListArray:
    at = np.cumsum([0] + [len(x) for x in arrays]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))


def _signed(span: int, bands: int, depth: int):
    a, b = _steps(bands, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bands_of = [], []
            for hashes in _lists(batch.column(2)):
                found = shingle_set(hashes, span)
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                bands_of.append(band_keys(found, a, b, depth) if len(found) else found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), _packed(bands_of)],
                names=["doc_id", "text_key", "set_key", "bands"],
            )

    return run


def _shingled(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x, span) for x in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), _packed(found)], names=["set_key", "shingles"])

    return run


def _tree(sets: list[np.ndarray], least: tuple[int, int]) -> Iterator[tuple[int, int]]:
    """Edges that span the components of sets under similarity >= least."""
    num, den = least
    sizes = np.array([len(x) for x in sets])
    left = np.arange(len(sets))
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            own = sets[at]
            like = den * np.minimum(sizes[left], len(own)) >= num * np.maximum(sizes[left], len(own))
            tried = left[like]
            if not len(tried):
                continue
            every = np.concatenate([sets[k] for k in tried])
            there = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            common = np.add.reduceat(there.astype(np.int64), np.cumsum(sizes[tried]) - sizes[tried])
            found = tried[den * common >= num * (len(own) + sizes[tried] - common)]
            yield from ((at, k) for k in found)
            front.extend(found)
            left = left[~np.isin(left, found)]


def _band_links(least: tuple[int, int]):
    """Of rows (band, part, set_key, shingles) sorted by band and part: the edges inside each."""

    def edges(keys: list[bytes], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs = list(_tree(sets, least))
        if pairs:
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[p[k]] for p in pairs], pa.binary()) for k in (0, 1)], names=["u", "v"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, sets = None, [], []
        for batch in batches:
            band, part, key = (batch.column(k).to_pylist() for k in range(3))
            for k, shingles in enumerate(_lists(batch.column(3))):
                if (band[k], part[k]) != now:
                    yield from edges(keys, sets)
                    now, keys, sets = (band[k], part[k]), [], []
                keys.append(key[k])
                sets.append(shingles.view(np.uint64).copy())
        yield from edges(keys, sets)

    return run


def _candidates(rows: DataFrame, near: DataFrame | None) -> DataFrame:
    """(band, part, set_key) of the bands with several sets; of bands with the same members one stays. The components of
    near are one more band."""
    placed = rows.groupBy("set_key").agg(F.first("bands").alias("bands")).select(
        "set_key", F.posexplode("bands").alias("band", "part")
    )
    if near is not None:
        sets = rows.select("text_key", "set_key").distinct().join(near, "text_key")
        placed = placed.unionByName(sets.select("set_key", F.lit(-1).alias("band"), F.col("root").alias("part")).distinct())
    placed = written(placed, "bands")
    named = placed.groupBy("band", "part").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("set_key").alias("low"),
        F.max("set_key").alias("high"),
        F.sum(F.xxhash64("set_key").cast("decimal(38,0)")).alias("mark"),
    )
    one = named.where("n > 1").groupBy("n", "low", "high", "mark").agg(F.min(F.struct("band", "part")).alias("x"))
    return written(placed.join(one.select("x.*"), ["band", "part"]), "candidates")


def keep_one(
    docs: DataFrame, span: int = SPAN, least: tuple[int, int] = LEAST, bands: int = BANDS, depth: int = DEPTH,
    near: DataFrame | None = None,
) -> DataFrame:
    """The rows of docs with one document of each component left: the one with the least doc_id (null ids last, then
    by text key; of rows with that id and text the one with the least row key, so a rerun keeps the same). Null and
    blank texts are equal. An empty table gives no rows. near: (text_key, root) of components found by another method,
    whose members are candidates as those of a band are."""
    keyed = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), _word_hashes(F.col("text")).alias("w"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = written(
        keyed.mapInArrow(
            _signed(span, bands, depth), f"doc_id {kind}, text_key bigint, set_key binary, bands array<bigint>"
        ),
        "signatures",
    )
    met = _candidates(rows, near)
    reps = rows.join(met.select("set_key").distinct(), "set_key", "left_semi").groupBy("set_key").agg(
        F.min("text_key").alias("text_key")
    )
    sets = (
        docs.select(_text_key(F.col("text")).alias("text_key"), "text")
        .join(reps, "text_key")
        .select("set_key", _word_hashes(F.col("text")).alias("w"))
        .mapInArrow(_shingled(span), "set_key binary, shingles array<bigint>")
    )
    sets = written(sets, "shingles").dropDuplicates(["set_key"])
    dealt = met.join(sets, "set_key").select("band", "part", "set_key", "shingles")
    dealt = dealt.repartition("band", "part").sortWithinPartitions("band", "part", "set_key")
    roots = components(dealt.mapInArrow(_band_links(least), "u binary, v binary").distinct())
    mark = lambda key: F.concat_ws(":", F.col("doc_id").cast("string"), key)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    stay = (
        rows.join(roots, rows.set_key == roots.u, "left")
        .groupBy(F.coalesce("root", "set_key").alias("root"))
        .agg(F.min(rank).alias("x"))
        .select("x.*")
        .select(mark(F.col("text_key")).alias("__mark"))
    )
    return one_of_each(docs, mark(_text_key(F.col("text"))), stay)
