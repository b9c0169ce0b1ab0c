"""SimHash votes in DataFrame functions: hashes of terms vote on the bits of a fingerprint.

A 64-bit hash is spread over 32 sums of two 32-bit lanes each, so a document needs 32 (or 64) running sums of longs
instead of one counter per bit, all of them combined before the shuffle. A lane holds the total weight of up to 2^32.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def lane_sums(hash_: Column, weight: Column | None, prefix: str) -> list[Column]:
    """32 sums that hold, for each bit of hash_, the weight of the terms that set it."""
    out = []
    for k in range(32):
        lanes = F.shiftrightunsigned(hash_, k).bitwiseAND(F.lit(_LANES))
        out.append(F.sum(lanes if weight is None else lanes * weight).alias(f"{prefix}{k}"))
    return out


def majority(prefix: str, total: Column) -> Column:
    """The 64-bit word with a bit set where more than half of the total weight set it (0 without terms)."""
    word = F.lit(0).cast("bigint")
    for k in range(32):
        lanes = F.coalesce(F.col(f"{prefix}{k}"), F.lit(0).cast("bigint"))
        low = lanes.bitwiseAND(F.lit(_LOW))
        high = F.shiftrightunsigned(lanes, 32)
        word = word.bitwiseOR(F.when(low * 2 > total, F.lit(1 << k).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
        top = (1 << (k + 32)) if k < 31 else -(1 << 63)
        word = word.bitwiseOR(F.when(high * 2 > total, F.lit(top).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return word


def hex64(word: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(word), 16, "0"))


def exploded(df: DataFrame, words: str, span: int, index: str = "i") -> DataFrame:
    """One row per run of `span` consecutive words (its first position in `index`); fewer words than that: one row;
    none: one row with a null index."""
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - span, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )
    return df.withColumn("__starts", starts).select("*", F.explode_outer("__starts").alias(index)).drop("__starts")
