"""Keep-first dedupe and other groups that begin anew a fixed time after their first event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: How long a first event suppresses repeats, in milliseconds, by record type.
RETENTION_MS = {
    "action": 86_400_000,
    "impression": 86_400_000,
    "view": 21_600_000,
    "auto_view": 21_600_000,
    "joined_impression": 21_600_000,
    "delivery_log": 86_400_000,
    "cohort_membership": 86_400_000,
    "log_user_user": 7_200_000,
}


def with_first(df: DataFrame, keys: list[str], ms: str, order: list[str], span: int, strict: bool = True) -> DataFrame:
    """Adds `first_ms`: the time of the event that opened the group an event falls into.

    Per key, in order of time, an event later than the opening one by more than `span` (or exactly `span`, unless
    strict) opens a new group. A gap above the span always does, so a key's different times are first cut at such gaps;
    only within a stretch without one are they walked through in order, as an array of its different times. The
    openers are then carried forward along time to the events, which are never gathered.
    """
    far = lambda later, earlier: (later - earlier > span) if strict else (later - earlier >= span)
    times = df.select(*keys, F.col(ms).alias("__t")).distinct()
    line = Window.partitionBy(*keys).orderBy("__t")
    gap = F.coalesce(far(F.col("__t"), F.lag("__t").over(line)), F.lit(True)).cast("int")
    cut = times.withColumn("__gap", gap)
    cut = cut.withColumn("__part", F.sum("__gap").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.struct(F.array().cast("array<bigint>").alias("all"), F.lit(None).cast("bigint").alias("last"))
    walked = F.aggregate(
        F.sort_array(F.collect_list(F.col("__t").cast("bigint"))),
        start,
        lambda acc, t: F.when(
            acc["last"].isNull() | far(t, acc["last"]), F.struct(F.concat(acc["all"], F.array(t)).alias("all"), t.alias("last"))
        ).otherwise(acc),
        lambda acc: acc["all"],
    )
    openers = cut.groupBy(*keys, "__part").agg(walked.alias("__openers")).select(*keys, F.explode("__openers").alias("__t"))
    # as-of: openers and events in one line
    both = openers.select(*keys, "__t", F.col("__t").alias("first_ms"), F.lit(None).cast(df.schema).alias("__row")).unionByName(
        df.select(*keys, F.col(ms).cast("bigint").alias("__t"), F.lit(None).cast("bigint").alias("first_ms"), F.struct(*df.columns).alias("__row"))
    )
    along = Window.partitionBy(*keys).orderBy("__t", F.col("__row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("first_ms", F.last("first_ms", ignorenulls=True).over(along)).where("__row IS NOT NULL")
    return placed.select("__row.*", "first_ms")


def keep_first(df: DataFrame, keys: list[str], ms: str, order: list[str], span: int) -> DataFrame:
    """The first event of a key, and again the first one more than `span` after it."""
    rows = with_first(df, keys, ms, order, span).where(F.col(ms) == F.col("first_ms"))
    line = Window.partitionBy(*keys, "first_ms").orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(line)).where("__n = 1").drop("__n", "first_ms")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the order given."""
    line = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__n", F.row_number().over(line)).where("__n = 1").drop("__n")


def keep_first_stream(df: DataFrame, keys: list[str], event_time: str, span: str) -> DataFrame:
    """The streaming form: repeats within the watermark's span are dropped."""
    return df.withWatermark(event_time, span).dropDuplicatesWithinWatermark(keys)
