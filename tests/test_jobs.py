"""The jobs end to end on generated events."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from trailmark.plans import counting, ingestion, jobs
from trailmark.sources import files, sinks


def funnel_parts(spark, **options):
    rows = files.generated_funnel(spark, 60, files.FunnelOptions(users=7, **options)).cache()
    blank = lambda *names: [F.lit("").alias(n) for n in names]
    base = ["platform_id", "log_user_id", "ms", "content_id"]
    ins = rows.where("kind = 'insertion'").select(*base, "insertion_id", "request_id", *blank("view_id"))
    imp = rows.where("kind = 'impression'").select(*base, "impression_id", "insertion_id", *blank("request_id", "view_id"))
    act = rows.where("kind IN ('navigate', 'purchase')").select(*base, "action_id", "impression_id", *blank("insertion_id", "request_id", "view_id"))
    views = spark.createDataFrame([], "platform_id bigint, log_user_id string, ms bigint, view_id string, content_id string")
    return views, ins, imp, act


def test_flat_output_joins_every_event(spark):
    views, ins, imp, act = funnel_parts(spark, redundant=20)
    out = jobs.flat_output(views, ins, imp, act)
    n = act.count()
    assert out["insertion"].count() == ins.count()
    assert out["action"].count() == n and out["dropped_action"].count() == 0
    assert out["impression"].count() + out["redundant_impression"].count() == imp.count()
    assert out["redundant_impression"].count() > 0
    assert out["action"].where("request_id = '' OR insertion_id = ''").count() == 0
    assert out["flat_session"].agg(F.sum(F.size("action_ids"))).first()[0] == n


def test_flat_output_writes_each_step_once(spark):
    """Impressions are ranked once for roots, redundant ones and actions, and left ids are joined in one step."""
    names = []
    jobs.flat_output(*funnel_parts(spark, redundant=20), cut=lambda df, name: names.append(name) or df)
    assert names == ["delivered", "shown", "acted", "ranked", "pointed"]


def test_flat_output_infers_missing_ids(spark):
    views, ins, imp, act = funnel_parts(spark, missing_impression_id=100)
    out = jobs.flat_output(views, ins, imp, act)
    assert out["action"].count() == act.count()


def test_raw_output_and_fixed_schema(spark, small, tmp_path):
    options = jobs.RawOptions(str(tmp_path / "out"))
    tables = jobs.raw_output(ingestion.batches(spark, small).where("user_info.log_user_id < 'LU2'"), options)
    assert tables["view"].where("user_info.user_id <> ''").count() == 0
    assert {"log_user_user", "delivery_log_ids", "request_insertion_ids", "response_insertion_ids"} <= set(tables)
    view = tables["view"].select("view_id", "platform_id", F.lit("2024-01-02").alias("dt"), F.lit("07").alias("hour"))
    sinks.write_dated(view, str(tmp_path / "v"))
    schema = StructType([StructField("view_id", StringType()), StructField("platform_id", LongType()), StructField("extra", IntegerType())])
    o = jobs.FixSchemaOptions(str(tmp_path / "v"), str(tmp_path / "w"), "2024-01-01", "2024-01-03", defaults={"extra": 4})
    jobs.fix_schema(spark, schema, o)
    got = spark.read.parquet(str(tmp_path / "w"))
    assert got.count() == view.count() and got.select("extra").distinct().collect()[0][0] == 4


def test_counter_job(spark, small):
    events = counting.counted_events(spark, small)
    got = jobs.counter(events, jobs.CounterOptions(counting.AS_OF_MS, popular_least=10))
    ops = {r.op: r.n for r in got.groupBy("op").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert ops["HSET"] > 0
    assert got.where("key LIKE '%q\x1f%'").count() > 0


def test_streamed_as_of(spark, tmp_path):
    from trailmark.plans.flows import replay
    from trailmark.streaming import flows

    rows = [("k", 3, False, None, "d3"), ("k", 4, True, "f4", None), ("k", 2, True, "f2", None), ("k", 5, False, None, "d5"), ("k", 10, True, "f10", None), ("z", 7 * 10**12, True, "end", None)]
    df = spark.createDataFrame(rows, "k string, ms bigint, is_fact boolean, fact string, version string").withColumn("ts", F.timestamp_millis("ms"))
    got = replay(df, flows.as_of_stream, "asof").collect()
    assert {(r.fact, r.version) for r in got} == {("f4", "d3"), ("f10", "d5")}
