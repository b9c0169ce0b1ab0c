"""Content metrics: a pivot of five event tables, summed per hour, day and cumulatively."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark import views as V
from trailmark.catalog import register

MEASURES = (
    "view_count",
    "impression_count",
    "joined_impression_count",
    "joined_position_sum",
    "navigate_count",
    "add_to_cart_count",
    "checkout_count",
    "purchase_count",
    "gmv_usd_micros",
)


def _row(source: DataFrame, **measures: Column) -> DataFrame:
    """source as rows of the unified stream: the named measures set, the others 0; blank contents go."""
    zero = F.lit(0)
    return source.where("content_id <> ''").select(
        "platform_id",
        "content_id",
        "rowtime",
        *[measures.get(m, zero).cast("bigint").alias(m) for m in MEASURES],
    )


def unified_events(
    views: DataFrame, impressions: DataFrame, joined: DataFrame, actions: DataFrame, carts: DataFrame
) -> DataFrame:
    """One row per event with its contribution to each of the nine measures.

    A purchase counts once for the action row and once for each of its cart rows; only cart rows carry value.
    """
    kind = lambda n: F.when(F.col("action_type") == n, 1).otherwise(0)
    counts = {
        "navigate_count": kind(V.NAVIGATE),
        "add_to_cart_count": kind(V.ADD_TO_CART),
        "checkout_count": kind(V.CHECKOUT),
        "purchase_count": kind(V.PURCHASE),
    }
    value = F.when(
        F.col("action_type") == V.PURCHASE, F.col("quantity") * F.col("price_usd_micros_per_unit")
    ).otherwise(0)
    parts = [
        _row(views, view_count=F.lit(1)),
        _row(impressions, impression_count=F.lit(1)),
        _row(joined, joined_impression_count=F.lit(1), joined_position_sum=F.col("position")),
        _row(actions, **counts),
        _row(carts, **counts, gmv_usd_micros=value),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _sums() -> list[Column]:
    return [F.sum(m).alias(m) for m in MEASURES]


def hourly(unified: DataFrame) -> DataFrame:
    """Tumbling hours per platform and content; dt and hour label the window."""
    start = F.window("rowtime", "1 hour").start
    return unified.groupBy(start.alias("start"), "platform_id", "content_id").agg(*_sums()).select(
        F.date_format("start", "yyyy-MM-dd").alias("dt"),
        F.date_format("start", "HH").alias("hour"),
        "platform_id",
        "content_id",
        *MEASURES,
    )


def _unified(spark, sf_dir) -> DataFrame:
    joined = V.impressions(spark, sf_dir).withColumn("position", F.col("impression_id").cast("bigint") % 10)
    return unified_events(
        V.views(spark, sf_dir),
        V.impressions(spark, sf_dir),
        joined,
        V.actions(spark, sf_dir),
        V.cart_contents(spark, sf_dir),
    )


_EVENTS_SQL = """
ev AS (
  SELECT CAST(1 AS BIGINT) AS platform_id, event_id, CAST(user_id AS VARCHAR) AS log_user_id,
         json_extract_string(props, '$.k') AS content_id, event_type, value, ts AS rowtime
  FROM events
),
unified AS (
  SELECT platform_id, content_id, rowtime, 1 AS view_count, 0 AS impression_count, 0 AS joined_impression_count,
         0 AS joined_position_sum, 0 AS navigate_count, 0 AS add_to_cart_count, 0 AS checkout_count,
         0 AS purchase_count, 0 AS gmv_usd_micros
  FROM ev WHERE event_type = 'view' AND event_id % 2 = 0
  UNION ALL
  SELECT platform_id, content_id, rowtime, 0, 1, 0, 0, 0, 0, 0, 0, 0
  FROM ev WHERE event_type = 'view' AND event_id % 2 = 1
  UNION ALL
  SELECT platform_id, content_id, rowtime, 0, 0, 1, event_id % 10, 0, 0, 0, 0, 0
  FROM ev WHERE event_type = 'view' AND event_id % 2 = 1
  UNION ALL
  SELECT platform_id, content_id, rowtime, 0, 0, 0, 0, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END, 0, 0,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END, 0
  FROM ev WHERE event_type IN ('click', 'purchase', 'signup')
  UNION ALL
  SELECT 1, CAST(l_partkey AS VARCHAR), o_orderdate, 0, 0, 0, 0, 0, 0, 0, 1,
         CAST(l_quantity AS BIGINT)
         * ((CAST(round(l_extendedprice * 100) AS BIGINT) * 10000) // CAST(l_quantity AS BIGINT))
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
"""
_SUM_SQL = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}" for m in MEASURES)


@register(
    "a2_hourly_content_metrics",
    f"""WITH {_EVENTS_SQL}
SELECT strftime(date_trunc('hour', rowtime), '%Y-%m-%d') AS dt, strftime(date_trunc('hour', rowtime), '%H') AS hour,
       platform_id, content_id, {_SUM_SQL}
FROM unified WHERE content_id <> '' GROUP BY ALL""",
)
def hourly_query(spark, sf_dir):
    return hourly(_unified(spark, sf_dir))


def daily(unified: DataFrame) -> DataFrame:
    """Tumbling days per platform and content."""
    start = F.window("rowtime", "1 day").start
    return unified.groupBy(start.alias("start"), "platform_id", "content_id").agg(*_sums()).select(
        F.date_format("start", "yyyy-MM-dd").alias("dt"), "platform_id", "content_id", *MEASURES
    )


def cumulated(unified: DataFrame, step_hours: int = 6) -> DataFrame:
    """From each day's start to the end of every step of the day that follows an event, the sums so far.

    Events are added up by step first; each step's sums then count for its own and the later steps of its day, so the
    rows multiplied are steps and not events.
    """
    if 24 % step_hours:
        raise ValueError("step_hours must divide the day")
    day = F.date_trunc("day", "rowtime").cast("timestamp_ntz")
    step = F.floor(F.hour("rowtime") / step_hours).cast("int")
    steps = unified.groupBy(day.alias("window_start"), step.alias("step"), "platform_id", "content_id").agg(*_sums())
    later = F.explode(F.sequence(F.col("step") + 1, F.lit(24 // step_hours))).alias("ends")
    spread = steps.select("window_start", "platform_id", "content_id", *MEASURES, later)
    sums = spread.groupBy("window_start", "ends", "platform_id", "content_id").agg(*_sums())
    end = F.expr(f"window_start + make_dt_interval(0, ends * {step_hours})").cast("timestamp_ntz")
    return sums.select("window_start", end.alias("window_end"), "platform_id", "content_id", *MEASURES)


@register("a1_unified_events", f"WITH {_EVENTS_SQL} SELECT platform_id, content_id, rowtime, " + ", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in MEASURES) + " FROM unified WHERE content_id <> ''")
def unified_query(spark, sf_dir):
    return _unified(spark, sf_dir)


_DAILY_SQL = f"""SELECT strftime(date_trunc('day', rowtime), '%Y-%m-%d') AS dt, platform_id, content_id, {_SUM_SQL}
FROM unified WHERE content_id <> '' GROUP BY ALL"""


@register("a3_daily_content_metrics", f"WITH {_EVENTS_SQL} {_DAILY_SQL}")
def daily_query(spark, sf_dir):
    return daily(_unified(spark, sf_dir))


@register(
    "a4_cumulated_content_metrics",
    f"""WITH {_EVENTS_SQL}, steps AS (
  SELECT *, date_trunc('day', rowtime) AS day, hour(rowtime) // 6 AS step FROM unified WHERE content_id <> ''
), spread AS (SELECT *, unnest(range(step + 1, 5)) AS ends FROM steps)
SELECT CAST(day AS TIMESTAMP) AS window_start, CAST(day AS TIMESTAMP) + to_hours(CAST(ends * 6 AS INTEGER)) AS window_end,
       platform_id, content_id, {_SUM_SQL} FROM spread GROUP BY day, ends, platform_id, content_id""",
)
def cumulated_query(spark, sf_dir):
    return cumulated(_unified(spark, sf_dir))


@register("a5_daily_csv_rows", f"WITH {_EVENTS_SQL}, d AS ({_DAILY_SQL}) SELECT dt AS date, * FROM d")
def csv_query(spark, sf_dir):
    rows = daily(_unified(spark, sf_dir))
    return rows.select(F.col("dt").alias("date"), "*")
