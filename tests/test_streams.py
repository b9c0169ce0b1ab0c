"""Streaming flows give what the batch operators give."""

from pyspark.sql import functions as F

from trailmark.plans.flows import replay, scratch
from trailmark.sources import files
from trailmark.streaming import flows


def test_streamed_attribution_within_bounds(spark):
    at = lambda s: F.timestamp_millis(s.ms)
    left = spark.createDataFrame([("i1", 1_000), ("i2", 5_000)], "id string, ms bigint")
    right = spark.createDataFrame([("i1", "a1", 2_000), ("i1", "a2", 99_000), ("i2", "a3", 4_500), ("i9", "a4", 5_000)], "id string, action string, ms bigint")
    paths = [scratch(spark, f"pair-{k}") for k in range(3)]
    left.withColumn("ts", at(left)).drop("ms").write.parquet(paths[0])
    right.withColumn("ts", at(right)).drop("ms").write.parquet(paths[1])
    l, r = files.stream(spark, paths[0], "id string, ts timestamp", "ts"), files.stream(spark, paths[1], "id string, action string, ts timestamp", "ts")
    out = flows.attribution_stream(l, r, "id", "ts", "ts", "10 seconds", "1 second")
    q = out.writeStream.format("parquet").option("path", paths[2]).option("checkpointLocation", paths[2] + "-marks").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(x.action for x in spark.read.schema(out.schema).parquet(paths[2]).collect()) == ["a1", "a3"]


def test_cumulative_counts_as_batch(spark):
    df = spark.createDataFrame([("k", 1_800_000), ("k", 5_400_000)], "k string, ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    got = {r.window_end.hour: r.n for r in flows.cumulative_counts(df, "ts", ["k"]).collect()}
    assert got[1] == 1 and got[2] == 2 and got[0] == 2 and len(got) == 24


def test_sentinel_closes_the_last_window(spark):
    df = spark.createDataFrame([("k", 1_000), ("k", 4_000_000)], "k string, ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    rows = flows.sentinel(df, "ts")
    out = replay(rows, lambda s: flows.tumbling_counts(s, "ts", ["k", "is_sentinel"]), "closing")
    assert sorted(r.n for r in out.where("NOT is_sentinel").collect()) == [1, 1]
