"""Small cases with known answers for joins along time, counters, reduction and metrics."""

import datetime as dt
import random

from pyspark.sql import functions as F

from trailmark import schemas
from trailmark.operators import attribution as A
from trailmark.operators import checks as K
from trailmark.operators import counters as C
from trailmark.operators import dedupe as D
from trailmark.operators import hydrate, ingest
from trailmark.operators import temporal as T
from trailmark.plans import metrics
from trailmark.sources import sinks

TINY = "platform_id bigint, log_user_id string, ms bigint, impression_id string, insertion_id string, request_id string, view_id string, content_id string"


def imps(spark, rows):
    return spark.createDataFrame([(1, "u", ms, i, "", "", "", c) for ms, i, c in rows], TINY)


def acts(spark, rows):
    data = [(1, "u", ms, a, i, "", "", "", c) for ms, a, i, c in rows]
    return spark.createDataFrame(data, TINY.replace("ms bigint,", "ms bigint, action_id string,"))


def test_as_of_join(spark):
    facts = spark.createDataFrame([("k1", f"f{k}", t) for k, t in enumerate([1, 2, 4, 4, 4, 6, 10])], "k string, fact string, ms bigint")
    dims = spark.createDataFrame([("k1", f"d{t}", t) for t in (3, 5, 11)], "k string, version string, ms bigint")
    left = {r.fact: r.version for r in T.as_of(facts, dims, ["k"], "ms", ["version"], "left").collect()}
    assert left == {"f0": None, "f1": None, "f2": "d3", "f3": "d3", "f4": "d3", "f5": "d5", "f6": "d5"}
    assert T.as_of(facts, dims, ["k"], "ms", ["version"]).count() == 5
    same = spark.createDataFrame([("k1", "now", 4)], "k string, version string, ms bigint")
    assert T.as_of(facts, same, ["k"], "ms", ["version"]).where("ms = 4 AND version = 'now'").count() == 3


def test_inferred_join_by_content(spark):
    left = imps(spark, [(10, "imp1", "1"), (80, "imp2", "2"), (90, "imp3", "3")])
    right = acts(spark, [(20, "a2", "", "2"), (50, "a1", "", "1"), (60, "a3", "", "3")])
    o = A.JoinOptions("impression_id", ("insertion_id", "request_id", "view_id", "content_id"), 100, 50, use_contents=True, right_key=("action_id", "content_id"))
    joined = A.attribute(left, right, o)
    assert {(r.action_id, r.left_key) for r in joined.collect()} == {("a1", "imp1"), ("a3", "imp3")}
    assert [r.action_id for r in A.dropped(right, joined, ["action_id"]).collect()] == ["a2"]


def test_explicit_never_falls_back_and_ties_go_later(spark):
    left = imps(spark, [(10, "i1", "1"), (30, "i2", "1"), (20, "", "1")])
    right = acts(spark, [(20, "a1", "", "1"), (40, "a2", "gone", "1"), (40, "a3", "i1", "9")])
    o = A.JoinOptions("impression_id", ("content_id",), 100, 50, use_contents=True, right_key=("action_id",))
    got = {r.action_id: (r.left_key, r.kind) for r in A.attribute(left, right, o).collect()}
    assert got == {"a1": ("i2", "inferred"), "a3": ("i1", "explicit")}


def test_other_contents_are_scopes(spark):
    """An action on a store meets an impression of an item of the store, if the store's dimension is selected."""
    kind = "platform_id bigint, log_user_id string, ms bigint, impression_id string, content_id string, other_content_ids map<int,string>"
    left = spark.createDataFrame([(1, "u", 10, "i1", "c1", {7: "store9"}), (1, "u", 20, "i2", "c2", {7: "store8"})], kind)
    right = spark.createDataFrame([(1, "u", 50, "", "store9", {}, "a1")], kind + ", action_id string")
    o = A.JoinOptions("impression_id", ("content_id",), 100, use_contents=True, right_key=("action_id",), other_dimensions=(7,))
    assert [(r.left_key, r.kind) for r in A.attribute(left, right, o).collect()] == [("i1", "inferred")]
    none = A.JoinOptions("impression_id", ("content_id",), 100, use_contents=True, right_key=("action_id",))
    assert A.attribute(left, right, none).collect() == []


def test_one_very_busy_user(spark):
    """100,000 events of one user on either side, all within reach of each other's neighbours: read in order, not in
    pairs; time buckets are part of the key."""
    base = spark.range(100_000).select(F.lit(1).cast("bigint").alias("platform_id"), F.lit("bot").alias("log_user_id"), "id")
    views = base.select("platform_id", "log_user_id", (F.col("id") * 10).alias("ms"), F.concat(F.lit("v"), "id").alias("view_id"), F.lit("").alias("content_id"))
    right = base.select("platform_id", "log_user_id", (F.col("id") * 10 + 3).alias("ms"), F.lit("").alias("view_id"), F.concat(F.lit("n"), "id").alias("insertion_id"), F.lit("").alias("content_id"))
    out = A.attribute(views, right, A.VIEW_INSERTION)
    assert "bucket" in out._jdf.queryExecution().toString()
    assert out.where("left_key = concat('v', substring(insertion_id, 2))").count() == 100_000
    # one chain without a gap: the first event of each span
    rows = base.select("log_user_id", (F.col("id") * 10).alias("ms"), "id")
    assert D.keep_first(rows, ["log_user_id"], "ms", ["id"], 995).count() == 1_000


def test_redundant_impressions(spark):
    hour = 3_600_000
    left = imps(spark, [(500, "imp1", "c"), (1000, "imp2", "c"), (6000, "imp3", "c"), (60_000, "imp4", "c")])
    right = acts(spark, [(0, "act1", "imp2", "c"), (12_000, "act2", "imp1", "c"), (70_000, "act3", "imp4", "c")])
    roots, redundant, pointed = A.reduce_redundant(left, right, hour)
    assert [r.impression_id for r in roots.collect()] == ["imp1"]
    assert redundant.count() == 3
    assert {r.action_id: r.impression_id for r in pointed.collect()} == dict.fromkeys(("act1", "act2", "act3"), "imp1")
    edge = imps(spark, [(0, "a", "c"), (hour, "b", "c"), (hour + 1, "d", "c")])
    assert sorted(r.impression_id for r in A.reduce_redundant(edge, right, hour)[0].collect()) == ["a", "d"]


def test_keep_first_chain(spark):
    rows = spark.createDataFrame([("k", 0, "a"), ("k", 50, "b"), ("k", 101, "c"), ("k", 180, "d"), ("k", 202, "e")], "k string, ms bigint, id string")
    assert sorted(r.id for r in D.keep_first(rows, ["k"], "ms", ["id"], 100).collect()) == ["a", "c", "e"]


def test_hourly_sliding_counts(spark):
    m = 60_000
    rows = [("UNKNOWN", 10), ("NAVIGATE", 21), ("NAVIGATE", 15 * m - 10), ("custom", 15 * m), ("NAVIGATE", 33 * m)]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "k string, ms bigint, n bigint")
    got = {(r.k, r.emit_ms // m): r["count"] for r in C.hourly_sliding(df, ["k"], "ms", "n").collect()}
    assert got[("NAVIGATE", 15)] == 2 and got[("UNKNOWN", 15)] == 1 and got[("custom", 30)] == 1
    assert got[("NAVIGATE", 45)] == 3 and got[("NAVIGATE", 75)] == 1 and got[("NAVIGATE", 105)] == 0


def test_daily_bucket_ends(spark):
    hours = lambda h, m=0, s=0: ((h * 60 + m) * 60 + s) * 1000
    times = [hours(7), hours(12, 46), hours(23, 59, 59) + 999]
    df = spark.createDataFrame([(t,) for t in times], "ms bigint").select(C.bucket_end(F.col("ms"), 4 * C.HOUR).alias("e"), "ms")
    assert {r.ms: r.e // C.HOUR for r in df.collect()} == {times[0]: 8, times[1]: 16, times[2]: 24}


def test_last_time(spark):
    df = spark.createDataFrame([("k", 11 * C.HOUR, 1), ("k", 33 * C.HOUR, 1)], "k string, ms bigint, n bigint")
    got = sorted((r.last_ms, r["count"]) for r in C.last_time(df, ["k"], "ms", "n").collect())
    assert got == [(39_600_000, 1), (118_800_000, 2)]


def test_one_funnel_counts_cart_and_action(spark):
    t = dt.datetime(2022, 10, 1, 22, 49, 11)
    schema = "platform_id bigint, content_id string, rowtime timestamp_ntz"
    row = (1, "i-1-1", t)
    plain = spark.createDataFrame([row], schema)
    joined = spark.createDataFrame([(*row, 5)], schema + ", position bigint")
    kinds = [2, 8, 3]
    actions = spark.createDataFrame([(*row, k) for k in kinds], schema + ", action_type int")
    carts = spark.createDataFrame([(*row, k, 1, 5_000_000) for k in (8, 3)], schema + ", action_type int, quantity bigint, price_usd_micros_per_unit bigint")
    unified = metrics.unified_events(plain, plain, joined, actions, carts)
    got = metrics.hourly(unified).first()
    assert tuple(got) == ("2022-10-01", "22", 1, "i-1-1", 1, 1, 1, 5, 1, 0, 2, 2, 5_000_000)
    doc = sinks.metrics_document(metrics.cumulated(unified, 1)).orderBy("header.eventDateTimestamp").first()
    assert doc.id == "2022-10-01@1@i-1-1"
    assert doc.header.eventDateTimestamp == "2022-10-01T23:00:00Z"


def test_push_down_defaults(spark):
    batch = spark.createDataFrame(
        ['{"platform_id":1,"user_info":{"user_id":"U","log_user_id":"LU"},"timing":{"event_api_timestamp":9},"user":[{}],"view":[{"view_id":"v","platform_id":3}],'
         '"delivery_log":[{"request":{"request_id":"r","platform_id":77}}]}'], "string"
    )
    batches = ingest.parse_batches(batch)
    parts = ingest.split_all(batches)
    view = parts["view"].first()
    assert (view.platform_id, view.user_info.log_user_id, view.user_info.user_id, view.timing.event_api_timestamp) == (3, "lu", "", 9)
    assert parts["user"].first().user_info.user_id == "U"
    log = parts["delivery_log"].first()
    assert (log.platform_id, log.request.platform_id, log.request.user_info.log_user_id) == (1, 1, "lu")
    assert parts["action"].count() == 0
    assert set(parts) == set(schemas.RECORDS)


def test_user_ids_are_cleared_in_arrays(spark):
    info = "user_info struct<user_id:string,log_user_id:string>"
    rows = spark.createDataFrame(
        [(("u", "l"), [(("u2", "l2"), [(("u3", "l3"),)]), None], None)],
        f"{info}, view array<struct<{info.replace(' ', ':', 1)}, inner:array<struct<{info.replace(' ', ':', 1)}>>>>, request struct<{info.replace(' ', ':', 1)}>",
    )
    r = ingest.clear_user_id(rows).first()
    assert r.user_info.user_id == "" and r.user_info.log_user_id == "l"
    assert r.view[0].user_info.user_id == "" and r.view[0].user_info.log_user_id == "l2"
    assert r.view[0].inner[0].user_info.user_id == "" and r.view[1] is None and r.request is None


def test_filters_give_both_sides(spark):
    df = spark.range(4).withColumn("p", F.when(F.col("id") < 2, True))
    keep, rest = K.partition_by(df, F.col("p"))
    assert (keep.count(), rest.count()) == (2, 2)


def test_cart_lookup_and_combined_logs(spark):
    item = "array<struct<content_id: string, quantity: bigint, amount_micros: bigint>>"
    df = spark.createDataFrame([([("a", 0, 5), ("b", 2, 6)],)], f"cart {item}")
    got = df.select(hydrate.single_cart_content(F.col("cart"), F.lit("a"), F.array(F.lit("b"))).alias("x"), hydrate.single_cart_content(F.col("cart"), F.lit("z"), F.array(F.lit("b"))).alias("y")).first()
    assert (got.x.quantity, got.y.content_id) == (1, "b")
    logs = spark.createDataFrame(
        [(1, "u", "c", 0, "API", 3, "r1", "pg"), (1, "u", "c", 100, "SDK", 3, "r2", ""), (1, "u", "c", 3000, "API", 3, "r3", "pg3"), (1, "u", "", 5, "API", 3, "r4", "")],
        "platform_id bigint, log_user_id string, client_request_id string, ms bigint, source string, priority int, request_id string, paging_id string",
    )
    got = {(r.first_ms, r.sdk_request_id, r.api_request_id, r.paging_id) for r in T.combine_logs(logs).collect()}
    assert got == {(0, "r2", "r1", "pg"), (3000, None, "r3", "pg3"), (5, None, "r4", "")}


def test_store_commands(spark):
    rows = [("HSET", "k", "f", 5, 10, 1), ("HINCRBY", "k", "f", 2, 0, 2), ("HSET", "k", "g", 1, -1, 3), ("HDEL", "k", "g", 0, 0, 4)]
    got = sinks.apply_commands(spark.createDataFrame(rows, "op string, key string, field string, value bigint, ttl int, seq bigint")).collect()
    assert [(r.key, r.field, r.value, r.ttl) for r in got] == [("k", "f", 7, 10)]


def test_attribution_shuffles_both_sides_once(spark):
    left = spark.createDataFrame([(1, "u", 10, "i1", "r1", "", "c"), (1, "u", 10, "", "r1", "", "c")], "platform_id bigint, log_user_id string, ms bigint, insertion_id string, request_id string, view_id string, content_id string")
    rows = [(1, "u", 20, "m1", "i1", "", "", ""), (1, "u", 20, "m2", "", "r1", "", "c"), (1, "u", 20, "m3", "", "", "", "c"), (1, "u", 20, "m4", "i9", "r1", "", "c"), (1, "v", 20, "m5", "", "r1", "", "c")]
    right = spark.createDataFrame(rows, "platform_id bigint, log_user_id string, ms bigint, impression_id string, insertion_id string, request_id string, view_id string, content_id string")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = A.attribute(left, right, A.INSERTION_IMPRESSION)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # one for all users, read twice, and two for the busy ones' buckets
    assert plan.count("- Exchange hashpartitioning") == 3 and plan.count("ReusedExchange") == 1 and "Join" not in plan
    assert {(r.impression_id, r.left_key, r.kind) for r in joined.collect()} == {("m1", "i1", "explicit"), ("m2", "i1", "inferred"), ("m3", "i1", "inferred")}


def test_busy_users_get_the_same(spark, monkeypatch):
    rnd = random.Random(3)
    ident = "platform_id bigint, log_user_id string, ms bigint, insertion_id string, request_id string, view_id string, content_id string, other_content_ids array<string>"
    some = lambda *x: rnd.choice(["", *x])
    row = lambda key: (1, some("u", "v"), rnd.randrange(9_000), key, some("r1", "r2"), some("v1"), some("a", "b"), rnd.choice([None, [], ["a", "c"]]))
    left = spark.createDataFrame([row(some(f"i{k % 12}")) for k in range(90)], ident)
    right = spark.createDataFrame([(*row(some("i3", "i9", "", "", "")), f"m{k % 70}") for k in range(80)], ident + ", impression_id string")
    for how in ("inner", "right"):
        o = A.JoinOptions("insertion_id", ("request_id", "content_id"), 900, 200, how, use_contents=True, user_scope=True, right_key=("impression_id",))
        pick = lambda: sorted((r.impression_id, r.ms, r.left_key, r.left_ms or 0, r.kind) for r in A.attribute(left, right, o).collect())
        few = pick()
        with monkeypatch.context() as m:
            m.setattr(A, "BUSY", 0)
            assert pick() == few
        assert {x[-1] for x in few} >= {"explicit", "inferred"}
