"""Sliding, last-time and popular counts, the count families of the key-value store, and its commands."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions import scalars as S

HOUR, DAY = 3_600_000, 86_400_000
#: Seconds to live: 60 days with the 30-day value; 93 days, or 3 at zero, for last-time counts; -1 is for ever.
TTL_30_DAYS, TTL_LAST, TTL_LAST_ZERO = 60 * 86_400, 93 * 86_400, 3 * 86_400


def measure(single_cart_quantity: Column) -> Column:
    """What an action counts: the quantity of its single cart content, else 1."""
    return F.when(single_cart_quantity > 0, single_cart_quantity).otherwise(F.lit(1)).cast("bigint")


def bucket_end(ms: Column, emit: int) -> Column:
    """The exclusive end of the emit window an event falls into; an event on a boundary belongs to the next one."""
    return S.floor_millis(ms, emit) + emit


def sliding(df: DataFrame, keys: list[str], ms: str, count: str, emit: int, unit: int, sizes: list[int]) -> DataFrame:
    """(keys, emit_ms, size, count): trailing counts at every time a key's value changes.

    Events are first added up by bucket, so the frames below run over buckets, not events. A bucket with end e counts
    at T for size b if T - b < e <= T; values are given at each bucket's end and when it leaves each of the sizes.
    """
    buckets = df.groupBy(*keys, bucket_end(F.col(ms), emit).alias("t")).agg(F.sum(count).alias("n"))
    times = F.explode(F.array(F.col("t"), *[F.col("t") + size * unit for size in sizes]))
    points = buckets.select(*keys, F.col("n"), F.col("t").alias("own"), times.alias("t"))
    rows = points.groupBy(*keys, "t").agg(F.sum(F.when(F.col("t") == F.col("own"), F.col("n")).otherwise(0)).alias("n"))
    line = Window.partitionBy(*keys).orderBy("t")
    counted = rows.select(
        *keys,
        F.col("t").alias("emit_ms"),
        *[F.sum("n").over(line.rangeBetween(-(size * unit) + 1, 0)).alias(f"c{size}") for size in sizes],
    )
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("size"), F.col(f"c{s}").alias("count")) for s in sizes]))
    return counted.select(*keys, "emit_ms", each.alias("x")).select(*keys, "emit_ms", "x.size", "x.count")


def hourly_sliding(df: DataFrame, keys: list[str], ms: str, count: str, emit_minutes: int = 15) -> DataFrame:
    """One-hour counts every emit_minutes, which must divide the hour; no time to live of their own."""
    if 60 % emit_minutes:
        raise ValueError("emit_minutes must divide 60")
    return sliding(df, keys, ms, count, emit_minutes * 60_000, HOUR, [1]).withColumn("ttl", F.lit(0))


def daily_sliding(df: DataFrame, keys: list[str], ms: str, count: str) -> DataFrame:
    """1, 7 and 30-day counts every four hours; the 30-day value carries the time to live."""
    out = sliding(df, keys, ms, count, 4 * HOUR, DAY, [1, 7, 30])
    return out.withColumn("ttl", F.when(F.col("size") == 30, TTL_30_DAYS).otherwise(0))


def last_time(df: DataFrame, keys: list[str], ms: str, count: str, days: int = 90) -> DataFrame:
    """Per event: its time and the count of the `days` days up to its own, by calendar day. What follows when days run
    out is in `last_time_expiries`."""
    day = F.floor(F.col(ms) / DAY).cast("bigint")
    rows = df.select(*keys, F.col(ms).alias("last_ms"), F.col(count).alias("__n"), day.alias("__day"))
    per_day = rows.groupBy(*keys, "__day").agg(F.sum("__n").alias("__d"))
    line = Window.partitionBy(*keys).orderBy("__day").rangeBetween(-(days - 1), -1)
    before = per_day.select(*keys, "__day", F.coalesce(F.sum("__d").over(line), F.lit(0)).alias("__before"))
    today = Window.partitionBy(*keys, "__day").orderBy("last_ms").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__today", F.sum("__n").over(today)).join(before, [*keys, "__day"])
    return rows.select(*keys, "last_ms", (F.col("__before") + F.col("__today")).alias("count"), F.lit(TTL_LAST).alias("ttl"))


def last_time_expiries(df: DataFrame, keys: list[str], ms: str, count: str, days: int = 90) -> DataFrame:
    """(keys, emit_ms, last_ms, count, ttl) of the times at which a key's day leaves the trailing `days` days: the count
    of the days still in them and the last event by then. A count of zero carries the short time to live."""
    per_day = df.groupBy(*keys, F.floor(F.col(ms) / DAY).cast("bigint").alias("__day")).agg(F.sum(count).alias("__n"), F.max(ms).alias("__last"))
    line = Window.partitionBy(*keys).orderBy("__day")
    n = F.coalesce(F.sum("__n").over(line.rangeBetween(1, days - 1)), F.lit(0))
    last = F.max("__last").over(line.rangeBetween(0, days - 1))
    rows = per_day.select(*keys, ((F.col("__day") + days) * DAY).alias("emit_ms"), last.alias("last_ms"), n.alias("count"))
    return rows.withColumn("ttl", F.when(F.col("count") == 0, TTL_LAST_ZERO).otherwise(TTL_LAST))


def popular(df: DataFrame, ts: str, keys: list[str], window: str = "14 days", slide: str = "3 days", least: int = 1000) -> DataFrame:
    """(window_start, window_end, keys, count) of keys seen at least so often in a sliding window."""
    w = F.window(F.col(ts), window, slide)
    out = df.groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= least)
    return out.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        "count",
    )


def query_ok(query: Column, most: int = 100) -> Column:
    return (F.length(F.trim(query)) > 0) & (F.length(query) <= most)


def top_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value; the report's own limit."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), key).limit(n)


@dataclass(frozen=True)
class Family:
    """A count family: what it groups by, its store key and field, and its feature type."""

    name: str
    group: tuple[str, ...]
    kind: str
    mark: str = ""
    ttl: int | None = None
    device: bool = False


FAMILIES = (
    Family("platform_device", ("platform_id",), "ITEM_DEVICE_COUNT", ttl=-1, device=True),
    Family("content_device", ("platform_id", "content_id"), "ITEM_DEVICE_COUNT", device=True),
    Family("log_user", ("platform_id", "log_user_id"), "LOG_USER_COUNT", mark="u"),
    Family("user", ("platform_id", "user_id"), "USER_COUNT", mark="u"),
    Family("query", ("platform_id", "search_query"), "QUERY_COUNT", mark="q"),
    Family("content_query", ("platform_id", "content_id", "search_query"), "ITEM_QUERY_COUNT", mark="q"),
)
LAST_FAMILIES = (
    Family("last_log_user_content", ("platform_id", "log_user_id", "content_id"), "LOG_USER_ITEM_COUNT", mark="u"),
    Family("last_user_content", ("platform_id", "user_id", "content_id"), "USER_ITEM_COUNT", mark="u"),
    Family("last_log_user_query", ("platform_id", "log_user_id", "search_query"), "LOG_USER_QUERY_COUNT", mark="uq"),
    Family("last_user_query", ("platform_id", "user_id", "search_query"), "USER_QUERY_COUNT", mark="uq"),
)
WINDOWS = ((1, "DAY"), (7, "DAY_7"), (30, "DAY_30"))


def _grouping(family: Family) -> list[Column]:
    """The columns of the group; queries in lower case, as their hash is taken of that."""
    return [F.lower(c).alias(c) if c == "search_query" else F.col(c) for c in family.group]


def _key(family: Family) -> Column:
    """The store key of grouped rows: the parts of the group, with a mark before a user and before a query. A query is
    given by the hex digits of its hash, which is so computed once for each group and not for each event."""
    parts = []
    for name in family.group:
        if name in ("user_id", "log_user_id") and "u" in family.mark:
            parts.append(F.lit(S.MARK + "u"))
        if name == "search_query" and "q" in family.mark:
            parts.append(F.lit(S.MARK + "q"))
        parts.append(S.xxh64_hex(F.col(name)) if name == "search_query" else F.col(name))
    return S.store_key(*parts)


def command(count: Column) -> Column:
    return F.when(count != 0, "HSET").otherwise("HDEL")


def family_counts(df: DataFrame, family: Family, as_of_ms: int) -> DataFrame:
    """Store commands (op, key, field, value, ttl) with a family's daily counts as of one time.

    df: platform_id, ids, os, browser, action_type (null: an impression), ms and count. One conditional sum per window, over one scan.
    """
    device = ("os", "browser") if family.device else ()
    end = bucket_end(F.col("ms"), 4 * HOUR)
    recent = df.where((F.col("ms") < as_of_ms) & (end <= as_of_ms))
    sums = [
        F.sum(F.when(end > as_of_ms - days * DAY, F.col("count")).otherwise(0)).alias(window) for days, window in WINDOWS
    ]
    grouped = recent.groupBy(*_grouping(family), *device, S.metric(F.col("action_type")).alias("metric")).agg(*sums)
    each = F.explode(
        F.array(
            *[
                F.struct(
                    S.feature_id(family.kind, F.col("metric"), window).cast("bigint").alias("fid"),
                    F.col(window).alias("value"),
                    F.lit(family.ttl if family.ttl is not None else TTL_30_DAYS if days == 30 else 0).alias("ttl"),
                )
                for days, window in WINDOWS
            ]
        )
    )
    rows = grouped.select(_key(family).alias("key"), *device, each.alias("x"))
    field = S.store_key(*[F.col(c) for c in device], F.col("x.fid"))
    return rows.select(
        command(F.col("x.value")).alias("op"), "key", field.alias("field"), F.col("x.value").alias("value"), F.col("x.ttl").alias("ttl")
    )


def last_family(df: DataFrame, family: Family, as_of_ms: int, days: int = 90) -> DataFrame:
    """Store commands of a last-time family as of one time: the 90-day count and the last time, or its deletion."""
    day = F.floor(F.col("ms") / DAY)
    inside = day > as_of_ms // DAY - days
    grouped = df.where(F.col("ms") <= as_of_ms).groupBy(*_grouping(family), S.metric(F.col("action_type")).alias("metric")).agg(
        F.sum(F.when(inside, F.col("count")).otherwise(0)).alias("n"), F.max("ms").alias("last")
    )
    hours = family.kind.replace("_COUNT", "_HOURS_AGO")
    query = "search_query" in family.group
    ttl = F.when(F.col("n") == 0, TTL_LAST_ZERO).otherwise(TTL_LAST)
    both = F.explode(
        F.array(
            F.struct(
                S.feature_id(family.kind, F.col("metric"), "DAY_90").cast("bigint").alias("field"), F.col("n").alias("value"), ttl.alias("ttl")
            ),
            F.struct(
                S.feature_id(hours, F.col("metric"), "NONE").cast("bigint").alias("field"),
                F.col("last").alias("value"),
                (F.lit(0) if query else ttl).alias("ttl"),
            ),
        )
    )
    rows = grouped.select(_key(family).alias("key"), "n", both.alias("x"))
    return rows.select(
        command(F.col("n")).alias("op"), "key", F.col("x.field").cast("string").alias("field"), F.col("x.value").alias("value"), F.col("x.ttl").alias("ttl")
    )


def last_write(commands: DataFrame, ms: str, bucket: int) -> DataFrame:
    """Backfill buffer: the last command of each (key, field) within a bucket of event time."""
    line = Window.partitionBy("key", "field", S.floor_millis(F.col(ms), bucket)).orderBy(F.desc(ms), F.desc("value"))
    return commands.withColumn("__n", F.row_number().over(line)).where("__n = 1").drop("__n")
