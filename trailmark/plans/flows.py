"""Queries that write through the sinks and read back, and the streaming flows run over stored events."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark import views as V
from trailmark.catalog import register
from trailmark.plans import metrics
from trailmark.session import table
from trailmark.sources import files, sinks
from trailmark.streaming import flows


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder all executors share; a local one only where none is set and the master is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="trailmark-")
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


_DATED = "SELECT event_id, CAST(ts AS DATE) AS dt, strftime(ts, '%H') AS hour FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'"


@register("src6_dated_scan", _DATED)
def dated_scan(spark, sf_dir):
    """Written by date and hour, read with a date range that prunes partitions."""
    path = scratch(spark, "dated")
    e = table(spark, sf_dir, "events").select("event_id", V.millis(F.col("ts")).alias("ms"))
    sinks.write_dated(sinks.with_date_hour(e, F.col("ms")), path)
    got = files.dated(spark, path, "2024-01-05", "2024-01-09")
    return got.select("event_id", F.col("dt").cast("date").alias("dt"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"))


@register("snk4_csv_round_trip", "SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) || ';x' AS tags FROM nation")
def csv_round_trip(spark, sf_dir):
    path = scratch(spark, "csv")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.array(F.col("n_regionkey").cast("string"), F.lit("x")).alias("tags"))
    sinks.write_csv(rows, path)
    return spark.read.option("header", True).schema("n_nationkey int, n_name string, tags string").csv(path)


@register("snk6_partition_overwrite", "SELECT r_regionkey, CASE WHEN r_regionkey = 1 THEN 'new' ELSE r_name END AS r_name FROM region")
def partition_overwrite(spark, sf_dir):
    path = scratch(spark, "overwrite")
    rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sinks.overwrite_partitions(rows, path, ["r_regionkey"])
    sinks.overwrite_partitions(rows.where("r_regionkey = 1").withColumn("r_name", F.lit("new")), path, ["r_regionkey"])
    return spark.read.schema("r_name string, r_regionkey int").parquet(path).select("r_regionkey", "r_name")


@register(
    "snk3_daily_parquet",
    f"WITH {metrics._EVENTS_SQL} {metrics._DAILY_SQL}",
)
def daily_parquet(spark, sf_dir):
    """All daily metrics, carts included, written by month (the orders span years of days) and read back whole."""
    path = scratch(spark, "daily")
    rows = metrics.daily(metrics._unified(spark, sf_dir))
    sinks.write_dated(rows.withColumnRenamed("dt", "day").withColumn("dt", F.substring("day", 1, 7)), path, hours=False)
    return spark.read.parquet(path).drop("dt").withColumnRenamed("day", "dt").select(*rows.columns)


def replay(df: DataFrame, build, tag: str, delay: str | None = "1 second") -> DataFrame:
    """Runs a streaming flow over stored rows, to the end, and gives what it has written."""
    spark = df.sparkSession
    source, out, marks = (scratch(spark, f"{tag}-{x}") for x in ("in", "out", "marks"))
    df.write.parquet(source)
    stream = build(files.stream(spark, source, df.schema, "ts", delay))
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _with_time(spark, sf_dir) -> DataFrame:
    return V.events(spark, sf_dir).select("event_id", "log_user_id", "event_type", F.col("rowtime").cast("timestamp").alias("ts"))


@register("st1_streamed_hourly_counts", "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streamed_counts(spark, sf_dir):
    """Tumbling counts as a stream; the sentinel at the end closes the last windows."""
    rows = flows.sentinel(_with_time(spark, sf_dir), "ts")
    out = replay(rows, lambda s: flows.tumbling_counts(s, "ts", ["event_type", "is_sentinel"]), "counts").where("NOT is_sentinel")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


@register("st8_streamed_keep_first", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS log_user_id, event_type FROM events")
def streamed_keep_first(spark, sf_dir):
    from trailmark.operators.dedupe import keep_first_stream

    rows = _with_time(spark, sf_dir)
    path_rows = replay(rows, lambda s: keep_first_stream(s.select("log_user_id", "event_type", "ts"), ["log_user_id", "event_type"], "ts", "60 days"), "first", None)
    return path_rows.select("log_user_id", "event_type")
