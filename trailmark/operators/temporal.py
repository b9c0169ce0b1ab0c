"""Joins along time: as-of, user updates, seen sets, sessions, latest impressions, combined delivery logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmark.functions import scalars as S
from trailmark.operators.attribution import USER
from trailmark.operators.dedupe import with_first


def as_of(facts: DataFrame, versions: DataFrame, keys: list[str], ms: str, values: list[str], how: str = "inner") -> DataFrame:
    """Each fact with the values of the last version whose time is at or before its own.

    One shuffle: both sides are put together and the last version is carried forward along time. Of versions with one
    time the greatest values count.
    """
    pack = F.struct(*values)
    line = Window.partitionBy(*keys).orderBy("__t", "__side", "__v").rowsBetween(Window.unboundedPreceding, 0)
    kind = versions.select(pack.alias("p")).schema["p"].dataType
    left = facts.select(*keys, F.col(ms).alias("__t"), F.lit(1).alias("__side"), F.struct(*facts.columns).alias("__f"), F.lit(None).cast(kind).alias("__v"))
    right = versions.select(*keys, F.col(ms).alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(left.schema["__f"].dataType).alias("__f"), pack.alias("__v"))
    found = left.unionByName(right).withColumn("__hit", F.last("__v", ignorenulls=True).over(line)).where("__side = 1")
    if how == "inner":
        found = found.where("__hit IS NOT NULL")
    return found.select("__f.*", *[F.col(f"__hit.{v}").alias(v) for v in values])


def user_join(events: DataFrame, updates: DataFrame, out_of_order: int) -> DataFrame:
    """Events with the user fields merged from their updates; events without any known user are dropped.

    Each field is the last one set by an update at or before the event; where no update is that early, updates up to
    `out_of_order` ms later are taken, the earliest first. updates: user key, ms, user_id, properties.
    """
    fields = ["user_id", "properties"]
    sides = events.select(*USER, F.col("ms").alias("t"), F.lit(1).alias("side"), "event_id", *[F.lit(None).cast("string").alias(c) for c in fields])
    ups = updates.select(*USER, F.col("ms").alias("t"), F.lit(0).alias("side"), F.lit(None).cast(events.schema["event_id"].dataType).alias("event_id"), *fields)
    line = Window.partitionBy(*USER).orderBy("t", "side", "event_id", "user_id")
    set_ = lambda c: F.nullif(F.col(c), F.lit(""))
    both = sides.unionByName(ups)
    for c in fields:
        both = both.withColumn(f"{c}_at", F.last(set_(c), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    soon = Window.partitionBy(*USER).orderBy("t").rangeBetween(0, out_of_order)
    for c in fields:
        both = both.withColumn(f"{c}_soon", F.min_by(set_(c), F.when(set_(c).isNotNull(), F.struct("t", c))).over(soon))
    joined = both.where("side = 1").select(*USER, "event_id", F.col("t").alias("ms"), F.coalesce("user_id_at", "user_id_soon").alias("user_id"), F.coalesce("properties_at", "properties_soon", F.lit("")).alias("properties"))
    return joined.where("user_id IS NOT NULL")


def right_seen(left: DataFrame, seen: DataFrame, keys: list[str], start: str, end: str, ts: str, exempt: Column) -> DataFrame:
    """Left rows whose key was in the seen set at their time (start inclusive, end exclusive), and exempt ones.

    The seen set, one row per key and window, is far smaller than the left side; the optimiser broadcasts it if its
    size allows and joins by sort-merge otherwise.
    """
    s = seen.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(start).alias("__a"), F.col(end).alias("__b"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [(F.col(ts) >= F.col("__a")) & (F.col(ts) < F.col("__b"))]
    return left.where(exempt).unionByName(left.where(~exempt).join(s, on, "left_semi"))


def sessions(impressions: DataFrame, actions: DataFrame, gap: str = "1 day") -> DataFrame:
    """Impressions and actions of an insertion put together by session: one row per (user, insertion, session)."""
    keys = [*USER, "insertion_id"]
    both = impressions.select(*keys, "ts", F.col("impression_id").alias("i"), F.lit(None).cast("string").alias("a")).unionByName(
        actions.select(*keys, "ts", F.lit(None).cast("string").alias("i"), F.col("action_id").alias("a"))
    )
    w = F.session_window("ts", gap)
    grouped = both.groupBy(*keys, w.alias("w")).agg(
        F.sort_array(F.collect_list("i")).alias("impression_ids"), F.sort_array(F.collect_list("a")).alias("action_ids")
    )
    return grouped.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "impression_ids", "action_ids")


def latest_impressions(actions: DataFrame, impressions: DataFrame, window: int = 21_600_000, most: int = 25) -> DataFrame:
    """Per action the user's latest impressions within `window` ms up to it, newest first one per content, without
    contents acted on by then, at most `most` of them (the feature's limit), given in ascending time."""
    # a bucket is as long as the window: an impression meets the actions of its own bucket and of the next one
    bucket = F.floor(F.col("ms") / (window + 1)).cast("bigint")
    a = actions.select(*USER, "action_id", F.col("ms").alias("a_ms"), bucket.alias("bucket"))
    i = impressions.select(*USER, F.col("ms").alias("i_ms"), "impression_id", F.col("content_id").alias("i_content"), F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    done = actions.select(*USER, F.col("content_id").alias("i_content"), F.col("ms").alias("d_ms")).groupBy(*USER, "i_content").agg(F.min("d_ms").alias("d_ms"))
    i = i.join(done, [*USER, "i_content"], "left")
    pairs = a.join(i, [*USER, "bucket"]).where((F.col("i_ms") <= F.col("a_ms")) & (F.col("i_ms") >= F.col("a_ms") - window))
    pairs = pairs.where("d_ms IS NULL OR d_ms > a_ms")
    each = Window.partitionBy(*USER, "action_id", "i_content").orderBy(F.desc("i_ms"), "impression_id")
    pairs = pairs.withColumn("n", F.row_number().over(each)).where("n = 1")
    line = Window.partitionBy(*USER, "action_id").orderBy(F.desc("i_ms"), "impression_id")
    pairs = pairs.withColumn("n", F.row_number().over(line)).where(F.col("n") <= most)
    return pairs.groupBy(*USER, "action_id").agg(F.sort_array(F.collect_list(F.struct("i_ms", "impression_id"))).alias("x")).select(
        *USER, "action_id", F.transform("x", lambda e: e["impression_id"]).alias("impression_ids")
    )


def combine_logs(logs: DataFrame, span: int = 2_000) -> DataFrame:
    """One row per client request and window of `span` ms from its first log: the SDK and the API log with the highest
    traffic priority (the later of equal ones), the SDK log taking the API's paging id where it has none. Logs without
    a client request id pass through alone. logs: user key, client_request_id, ms, source, priority, request_id,
    paging_id."""
    named = logs.where(~S.blank(F.col("client_request_id")))
    rows = with_first(named, [*USER, "client_request_id"], "ms", ["request_id"], span)
    pick = lambda kind, c: F.max_by(c, F.when(F.col("source") == kind, F.struct("priority", "ms", "request_id")))
    grouped = rows.groupBy(*USER, "client_request_id", "first_ms").agg(
        pick("SDK", "request_id").alias("sdk_request_id"),
        pick("API", "request_id").alias("api_request_id"),
        pick("SDK", "paging_id").alias("__sdk_paging"),
        pick("API", "paging_id").alias("__api_paging"),
    )
    alone = logs.where(S.blank(F.col("client_request_id"))).select(
        *USER, F.lit("").alias("client_request_id"), F.col("ms").alias("first_ms"),
        F.when(F.col("source") == "SDK", F.col("request_id")).alias("sdk_request_id"),
        F.when(F.col("source") == "API", F.col("request_id")).alias("api_request_id"),
        F.when(F.col("source") == "SDK", F.col("paging_id")).alias("__sdk_paging"),
        F.when(F.col("source") == "API", F.col("paging_id")).alias("__api_paging"),
    )
    return grouped.unionByName(alone).select(
        *USER, "client_request_id", "first_ms", "sdk_request_id", "api_request_id",
        S.first_not_empty(F.col("__sdk_paging"), F.col("__api_paging")).alias("paging_id"),
    )
