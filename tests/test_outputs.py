"""Streamed attribution against the batch form, late rows, Avro records, look-ups, writers."""

import json
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from trailmark import catalog
from trailmark.operators import attribution as A
from trailmark.operators import hydrate
from trailmark.plans import jobs, outputs
from trailmark.plans.flows import replay, scratch
from trailmark.sources import files, sinks
from trailmark.streaming import flows

LEFT = "platform_id bigint, log_user_id string, ms bigint, impression_id string, insertion_id string, request_id string, view_id string, content_id string, other_content_ids array<string>"
RIGHT = LEFT.replace("impression_id string", "action_id string, impression_id string")
END = 7_258_118_400_000


def rows_of(seed: int):
    r = random.Random(seed)
    pick = lambda kind: r.choice(["", "", f"{kind}{r.randrange(3)}"])
    ids = lambda: [pick("i"), pick("r"), pick("v"), r.choice(["", "c0", "c1"]), r.choice([[], ["c1"], ["c0", "s"]])]
    left = [(1, f"u{r.randrange(2)}", 1_000 + r.randrange(40), f"m{k}", *ids()) for k in range(40)]
    right = [(1, f"u{r.randrange(2)}", 1_000 + r.randrange(50), f"a{k}", r.choice(["", "", f"m{r.randrange(50)}"]), *ids()) for k in range(40)]
    return left, right


@pytest.mark.parametrize("seed,ooo,contents", [(1, 0, True), (2, 6, True), (3, 6, False)])
def test_streamed_attribution_is_the_batch_form(spark, seed, ooo, contents):
    left, right = (spark.createDataFrame(rows, schema) for rows, schema in zip(rows_of(seed), (LEFT, RIGHT), strict=True))
    o = A.JoinOptions("impression_id", ("insertion_id", "request_id", "view_id", "content_id"), 12, ooo, use_contents=contents, retention=1, right_key=("action_id",))
    key = lambda r: (r.log_user_id, r.action_id, r.left_key, r.left_ms, r.kind)
    want = {key(r) for r in A.attribute(left, right, o).collect()}
    events = flows.attribution_events(left, right, o, "action_id")
    end = spark.createDataFrame([(0, "end", END, False, "end", "[]", "")], "platform_id bigint, log_user_id string, ms bigint, is_right boolean, id string, scopes string, left_id string").withColumn("ts", F.timestamp_millis("ms"))
    out = replay(events.unionByName(end.select(*events.columns)), lambda s: flows.attribute_stream(s, o), "streamed").collect()
    assert {(r.log_user_id, r.id, r.left_key, r.left_ms, r.kind) for r in out if r.kind in ("explicit", "inferred")} == want
    assert want and {r.id for r in out if r.kind == "dropped"} == {r[3] for r in rows_of(seed)[1]} - {w[1] for w in want}


@pytest.mark.parametrize("retention", [0, 1])
def test_join_by_id_is_the_explicit_part_of_attribution(spark, retention):
    left, right = (spark.createDataFrame(rows, schema) for rows, schema in zip(rows_of(4), (LEFT, RIGHT), strict=True))
    left = left.unionByName(left.limit(9).withColumns({"ms": F.col("ms") + 1, "view_id": F.lit("later")}))
    o = A.JoinOptions("impression_id", ("insertion_id", "request_id", "view_id", "content_id"), 12, 6, use_contents=True, retention=retention, right_key=("action_id",))
    whole = A.attribute(left, right, o)
    got = A.by_id(left, right, o, ["view_id"])
    assert got.columns == [*whole.columns, "__view_id"] and got.where("__view_id = 'later'").count() == 0
    key = lambda df: sorted(map(str, df.select(whole.columns).collect()))
    assert key(got) == key(whole.where("kind = 'explicit'")) and got.count()
    others = A.attribute(left, right.where("impression_id = ''"), o)
    assert key(others) == key(whole.where("kind = 'inferred'")) and others.count()
    assert key(A.attribute(left, right, o, busy=A.has_busy(left, right))) == key(whole)


def test_only_redundant_impressions(spark):
    imp = spark.createDataFrame(rows_of(5)[0], LEFT).drop("other_content_ids")
    _, want, _ = A.reduce_redundant(imp, imp.withColumn("action_id", F.lit("a")), 9)
    key = lambda df: sorted(map(str, df.select(imp.columns).collect()))
    assert key(A.redundant(imp, 9)) == key(want) and want.count()


def test_side_tables_by_parts_of_the_users(spark, small, tmp_path, monkeypatch):
    """The parts' side tables together are those of all users, and no part leaves its lines or steps behind."""
    names = []
    monkeypatch.setattr(outputs, "PART_LINES", 3_500)
    monkeypatch.setattr(outputs, "scratch", lambda s, tag: names.append(tag) or f"file://{tmp_path}/{tag}-{len(names)}")
    got = outputs.flat_side_tables(spark, small)
    c = duckdb.connect()
    for t in ("orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    want = c.execute(catalog.oracle_sql()["snk18_flat_side_tables"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert names == ["lines", "flat", "steps", "steps"] and os.listdir(tmp_path) == ["flat-2"]
    assert set(os.listdir(tmp_path / "flat-2")) == {"etl_side"} and spark.conf.get(outputs._CLEANUP) == "false"


def test_streamed_attribution_names_repeats(spark):
    events = [(1, "u", 1, False, "m", '["x"]', ""), (1, "u", 1, False, "m", '["x"]', ""), (1, "u", 2, True, "a", '[["x"]]', ""), (1, "u", 2, True, "a", '[["x"]]', ""), (0, "end", END, False, "end", "[]", "")]
    df = spark.createDataFrame(events, "platform_id bigint, log_user_id string, ms bigint, is_right boolean, id string, scopes string, left_id string").withColumn("ts", F.timestamp_millis("ms"))
    out = replay(df, lambda s: flows.attribute_stream(s, A.IMPRESSION_ACTION), "repeats").collect()
    assert sorted((r.id, r.kind) for r in out) == [("a", "duplicate_right"), ("a", "inferred"), ("m", "duplicate_left")]


def test_late_splitter_repeats_a_batch_with_the_same_result(spark):
    split = flows.LateSplitter(scratch(spark, "late"), "ts", 1_000)
    at = lambda *ms: spark.createDataFrame([(m,) for m in ms], "ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    split(at(5_000, 100), 0)
    for _ in range(2):
        split(at(3_999, 4_000, 9_000), 1)
    split(at(7_999, 8_000), 2)
    read = lambda kind: sorted(r.ms for r in split.table(spark, kind, "ms bigint").collect())
    assert read("late") == [3_999, 7_999] and read("on_time") == [100, 4_000, 5_000, 8_000, 9_000]


AVRO = json.dumps({"type": "record", "name": "x", "fields": [{"name": "platform_id", "type": "long"}, {"name": "user", "type": "string"}, {"name": "at", "type": ["null", "long"]}, {"name": "score", "type": "double"}, {"name": "ok", "type": "boolean"}]})
#: Written by hand from the format's rules: zig-zag numbers, lengths before strings, the number of a union's branch.
GOOD = bytes([0x81, 0x01]) + bytes([6]) + b"abc" + bytes([2, 0x80, 0x02]) + bytes([0, 0, 0, 0, 0, 0, 0xF8, 0x3F]) + b"\x01"


def test_avro_records(spark):
    null_time = bytes([4]) + bytes([4]) + "é".encode() + bytes([0]) + bytes(8) + b"\x00"
    df = spark.createDataFrame([(1, bytearray(GOOD)), (2, bytearray(null_time)), (3, None)], "n int, value binary")
    got = [tuple(r) for r in files.avro_records(df, AVRO).orderBy("n").collect()]
    assert got == [(1, -65, "abc", 128, 1.5, True), (2, 2, "é", None, 0.0, False), (3, None, None, None, None, None)]
    for bad in (GOOD[:-1], GOOD + b"\x00"):
        with pytest.raises(Exception, match="unreadable message"):
            files.avro_records(spark.createDataFrame([(bytearray(bad),)], "value binary"), AVRO).collect()


def test_bad_json_message_fails_with_the_message(spark):
    df = spark.createDataFrame([('{"ms": 5, "a": "x"}',)], "value string")
    good = files.event_stream(df, "ms bigint, a string", F.col("ms"))
    assert [(r.ms, r.a) for r in good.collect()] == [(5, "x")]
    with pytest.raises(Exception, match="unreadable message: e25vcGU="):
        files.event_stream(spark.createDataFrame([("{nope",)], "value string"), "ms bigint, a string", F.col("ms")).collect()


def test_look_up_asks_once_and_again_after_errors(spark):
    df = spark.createDataFrame([("c1",), ("c1",), ("c2",), ("",), (None,), ("gone",)], "content_id string")

    def fetch(ids):
        import os

        mark = f"/tmp/look-{os.getpid()}-{'-'.join(ids)}"
        if "gone" in ids:
            raise OSError("service away")
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("first try")
        os.remove(mark)
        return {i: {"store": "s" + i} for i in ids if i != "c2"}

    got = hydrate.looked_up(df, "content_id", fetch, ["store"], batch=1, wait=0.0)
    assert {(r.content_id, r.store) for r in got.collect()} == {("c1", "sc1"), ("c2", None), ("gone", None)}
    plain = hydrate.without_lookup(df.withColumn("other_content_ids", F.lit(None).cast("map<string,string>")))
    assert plain.where("size(other_content_ids) = 0").count() == 6


def test_store_metadata_and_writers(spark, tmp_path):
    sent = []
    meta = sinks.store_metadata(spark, {"query": (["platform_id", "q"], [7, 3])})
    sinks.prepare_store(lambda rows: sent.extend(rows), meta, wipe=True)
    assert [r.op for r in sent] == ["PING", "FLUSHDB", "HSET", "HSET"]
    assert {(r.key, r.field, r.value) for r in sent[2:]} == {("row_format", "query", "platform_id,q"), ("feature_ids", "query", "3,7")}

    def put(records):
        with open(tmp_path / f"{records[0][0]}-{len(records)}", "w") as out:
            out.write(",".join(k for k, _ in records))

    sinks.record_writer(put, most=2)(spark.createDataFrame([(str(k), "v") for k in range(5)], "key string, value string").coalesce(1), 0)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["0-2", "2-2", "4-1"]


def test_compaction_keeps_rows_and_other_partitions(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(40).select("id", F.lit(0).cast("bigint").alias("ms")).withColumn("ms", F.col("id") % 2 * 86_400_000)
    for k in range(3):
        sinks.write_dated(sinks.with_date_hour(df.where(F.col("id") % 3 == k), F.col("ms")), a)
    for day in ("1970-01-01", "1970-01-02"):
        sinks.compact(spark, a, b, {"dt": day})
    assert sorted(r.id for r in spark.read.parquet(b).collect()) == list(range(40))
    assert len(list((tmp_path / "b").rglob("*.parquet"))) < len(list((tmp_path / "a").rglob("*.parquet")))


def test_slow_batches_are_logged():
    from types import SimpleNamespace as N

    said = []
    listener = flows.SlowBatches(100, lambda *a: said.append(a))
    for ms in (50, 150):
        listener.onQueryProgress(N(progress=N(batchDuration=ms, batchId=ms, name="q", id="i", durationMs={"addBatch": ms})))
    assert [a[1] for a in said] == [150]


def test_flat_tables_are_upserted_by_their_keys(spark):
    out = {
        "impression": spark.createDataFrame([(1, "u", 5, "m1", "i1")], "platform_id bigint, log_user_id string, ms bigint, impression_id string, insertion_id string"),
        "action": spark.createDataFrame([(1, "u", 5, "a1", "c1")], "platform_id bigint, log_user_id string, ms bigint, action_id string, content_id string"),
        "flat_session": spark.createDataFrame([(1, "u", "i1")], "platform_id bigint, log_user_id string, insertion_id string").withColumn("session_start", F.timestamp_millis(F.lit(5))),
    }
    first = jobs.upsert_flat(out)
    later = out | {"impression": out["impression"].withColumn("ms", F.lit(9).cast("bigint")).withColumn("impression_id", F.lit("m2"))}
    second = jobs.upsert_flat(later, first)
    assert [(r.ms, r.impression_id) for r in second["joined_impression"].collect()] == [(9, "m2")]
    assert second["joined_action"].count() == 1 and second["flat_response_insertion"].count() == 1
