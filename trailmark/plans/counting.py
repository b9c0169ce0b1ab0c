"""Queries of dedupe, sliding counts, last-time counts, popular queries and the count families."""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark import views as V
from trailmark.catalog import register
from trailmark.functions import scalars as S
from trailmark.operators import counters as C
from trailmark.operators import dedupe as D
from trailmark.sources import sinks

#: A few agents for the device families, dealt by user.
AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0",
    "Googlebot/2.1 (+http://www.google.com/bot.html)",
)
AS_OF_MS = 1_706_659_200_000  # 2024-01-31 00:00 UTC


def counted_events(spark, sf_dir) -> DataFrame:
    """Events as counter input: ids, query (in either case), agent families, action type (null for views), ms, count."""
    agent = F.get(F.array(*[F.lit(a) for a in AGENTS]), (F.col("log_user_id").cast("int") % len(AGENTS)))
    kind = F.when(F.col("event_type").isin("click", "purchase", "signup"), V.action_type())
    return V.events(spark, sf_dir).where("event_type <> 'error'").select(
        "platform_id", "event_id", "log_user_id",
        F.concat(F.lit("U"), F.col("log_user_id")).alias("user_id"),
        "content_id",
        F.concat(F.when(F.col("event_id") % 2 == 0, "Query ").otherwise("query "), (F.col("content_id").cast("int") % 20).cast("string")).alias("search_query"),
        S.os_family(agent).alias("os"), S.browser_family(agent).alias("browser"),
        kind.alias("action_type"), V.millis(F.col("rowtime")).alias("ms"), "rowtime",
        C.measure(F.lit(0)).alias("count"),
    )


_EV = """ce AS (
  SELECT CAST(1 AS BIGINT) AS platform_id, event_id, CAST(user_id AS VARCHAR) AS log_user_id,
         'U' || CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS content_id,
         CASE WHEN event_id % 2 = 0 THEN 'Query ' ELSE 'query ' END || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 20 AS VARCHAR) AS search_query,
         ['Windows', 'iOS', 'Linux', 'Other'][1 + CAST(user_id % 4 AS INTEGER)] AS os,
         ['Chrome', 'Safari', 'Firefox', 'Other'][1 + CAST(user_id % 4 AS INTEGER)] AS browser,
         CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 15 END AS action_type,
         epoch_us(ts) // 1000 AS ms, ts AS rowtime, CAST(1 AS BIGINT) AS count
  FROM events WHERE event_type <> 'error'
)"""


def _sliding_sql(keys: str, emit: int, unit: int, sizes: list[int]) -> str:
    shifts = ", ".join(["0", *[str(s * unit) for s in sizes]])
    frames = ", ".join(
        f"CAST(sum(n) OVER (PARTITION BY {keys} ORDER BY t RANGE BETWEEN {s * unit - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS c{s}" for s in sizes
    )
    each = " UNION ALL ".join(f"SELECT {keys}, t AS emit_ms, {s} AS size, c{s} AS count FROM counted" for s in sizes)
    return f"""WITH {_EV}, buckets AS (
  SELECT {keys}, (ms // {emit}) * {emit} + {emit} AS t, sum(count) AS n FROM ce GROUP BY ALL
), points AS (
  SELECT {keys}, t + s AS t, CASE WHEN s = 0 THEN n ELSE 0 END AS n FROM buckets, (SELECT unnest([{shifts}]) AS s)
), merged AS (SELECT {keys}, t, sum(n) AS n FROM points GROUP BY ALL),
counted AS (SELECT {keys}, t, {frames} FROM merged)
SELECT * FROM ({each})"""


@register("a7_hourly_sliding_counts", f"SELECT *, 0 AS ttl FROM ({_sliding_sql('log_user_id, action_type', 900_000, C.HOUR, [1])})")
def hourly_query(spark, sf_dir):
    return C.hourly_sliding(counted_events(spark, sf_dir), ["log_user_id", "action_type"], "ms", "count")


@register(
    "a8_daily_sliding_counts",
    f"SELECT *, CASE WHEN size = 30 THEN 5184000 ELSE 0 END AS ttl FROM ({_sliding_sql('content_id, action_type', 4 * C.HOUR, C.DAY, [1, 7, 30])})",
)
def daily_query(spark, sf_dir):
    return C.daily_sliding(counted_events(spark, sf_dir), ["content_id", "action_type"], "ms", "count")


@register(
    "a9_last_time_and_count",
    f"""WITH {_EV} SELECT log_user_id, content_id, ms AS last_ms, CAST((
  SELECT sum(count) FROM ce b WHERE b.log_user_id = a.log_user_id AND b.content_id = a.content_id AND b.ms <= a.ms
  AND b.ms // 86400000 > a.ms // 86400000 - 90) AS BIGINT) AS count, 8035200 AS ttl FROM ce a""",
)
def last_query(spark, sf_dir):
    return C.last_time(counted_events(spark, sf_dir), ["log_user_id", "content_id"], "ms", "count")


@register(
    "a9_last_time_expiries",
    f"""WITH {_EV}, d AS (SELECT log_user_id, content_id, ms // 86400000 AS day, sum(count) AS n, max(ms) AS last FROM ce GROUP BY ALL)
SELECT log_user_id, content_id, (day + 90) * 86400000 AS emit_ms, last_ms, count, CASE WHEN count = 0 THEN 259200 ELSE 8035200 END AS ttl FROM (
  SELECT a.log_user_id, a.content_id, a.day, max(b.last) AS last_ms, CAST(coalesce(sum(CASE WHEN b.day > a.day THEN b.n END), 0) AS BIGINT) AS count
  FROM d a JOIN d b ON a.log_user_id = b.log_user_id AND a.content_id = b.content_id AND b.day BETWEEN a.day AND a.day + 89 GROUP BY ALL)""",
)
def expiry_query(spark, sf_dir):
    return C.last_time_expiries(counted_events(spark, sf_dir), ["log_user_id", "content_id"], "ms", "count")


@register(
    "a11_popular_queries",
    f"""WITH {_EV}, w AS (
  SELECT search_query, unnest(generate_series(0, 4)) AS back,
         time_bucket(INTERVAL '3 days', rowtime, TIMESTAMP '1970-01-01') AS last_start, rowtime FROM ce
), placed AS (
  SELECT search_query, last_start - to_days(CAST(3 * back AS INTEGER)) AS window_start, rowtime FROM w
)
SELECT window_start, window_start + INTERVAL '14 days' AS window_end, search_query, count(*) AS count
FROM placed WHERE rowtime < window_start + INTERVAL '14 days' GROUP BY ALL HAVING count(*) >= 100""",
)
def popular_query(spark, sf_dir):
    rows = counted_events(spark, sf_dir).where(C.query_ok(F.col("search_query")))
    return C.popular(rows, "rowtime", ["search_query"], least=100)


@register("a12_top_queries", f"WITH {_EV} SELECT search_query, count(*) AS count FROM ce GROUP BY ALL ORDER BY count DESC, search_query LIMIT 10")
def top_query(spark, sf_dir):
    return C.top_n(counted_events(spark, sf_dir), "search_query", 10)


def _metric_sql() -> str:
    """Bits of a metric: an impression without an action is number 1, an action has its type's number."""
    return "32 * coalesce(action_type, 1)"


#: The hashes of the twenty queries in lower case, from the library, as DuckDB has no XXH64.
_HASH_SQL = "CAST(" + str([format(xxhash.xxh64_intdigest(f"query {k}", 0), "x") for k in range(20)]) + " AS VARCHAR[])[1 + CAST(substr(search_query, 7) AS INTEGER)]"


def _group_sql(f: C.Family) -> tuple[str, str]:
    """The columns of a family's group, and their names."""
    return ", ".join("lower(search_query) AS search_query" if c == "search_query" else c for c in f.group), ", ".join(f.group)


def _key_sql(family: C.Family) -> str:
    parts = []
    for name in family.group:
        if name in ("user_id", "log_user_id") and "u" in family.mark:
            parts.append("chr(29) || 'u'")
        if name == "search_query" and "q" in family.mark:
            parts.append("chr(29) || 'q'")
        parts.append(_HASH_SQL if name == "search_query" else f"CAST({name} AS VARCHAR)")
    return " || chr(31) || ".join(parts)


def _family_sql(f: C.Family) -> str:
    device = ", os, browser" if f.device else ""
    group = _group_sql(f)[0] + device
    end = f"((ms // {4 * C.HOUR}) * {4 * C.HOUR} + {4 * C.HOUR})"
    parts = []
    for days, window in C.WINDOWS:
        bits = S.TYPE_BITS[f.kind] | S.WINDOW_BITS[window]
        ttl = f.ttl if f.ttl is not None else C.TTL_30_DAYS if days == 30 else 0
        prefix = "os || chr(31) || browser || chr(31) || " if f.device else ""
        parts.append(
            f"SELECT {_key_sql(f)} AS key, {prefix}CAST(metric | {bits} AS VARCHAR) AS field, {window} AS value, {ttl} AS ttl FROM g"
        )
    sums = ", ".join(
        f"CAST(sum(CASE WHEN {end} > {AS_OF_MS - d * C.DAY} THEN count ELSE 0 END) AS BIGINT) AS {w}" for d, w in C.WINDOWS
    )
    return f"""WITH {_EV}, g AS (
  SELECT {group}, {_metric_sql()} AS metric, {sums} FROM ce WHERE ms < {AS_OF_MS} AND {end} <= {AS_OF_MS} GROUP BY ALL
) SELECT CASE WHEN value <> 0 THEN 'HSET' ELSE 'HDEL' END AS op, * FROM ({" UNION ALL ".join(parts)})"""


def _last_sql(f: C.Family) -> str:
    group = _group_sql(f)[0]
    count_bits = S.TYPE_BITS[f.kind] | S.WINDOW_BITS["DAY_90"]
    hours_bits = S.TYPE_BITS[f.kind.replace("_COUNT", "_HOURS_AGO")]
    ttl = f"CASE WHEN n = 0 THEN {C.TTL_LAST_ZERO} ELSE {C.TTL_LAST} END"
    last_ttl = "0" if "search_query" in f.group else ttl
    return f"""WITH {_EV}, g AS (
  SELECT {group}, {_metric_sql()} AS metric,
         CAST(sum(CASE WHEN ms // {C.DAY} > {AS_OF_MS // C.DAY - 90} THEN count ELSE 0 END) AS BIGINT) AS n, max(ms) AS last
  FROM ce WHERE ms <= {AS_OF_MS} GROUP BY ALL
) SELECT CASE WHEN n <> 0 THEN 'HSET' ELSE 'HDEL' END AS op, key, field, value, ttl FROM (
  SELECT n, {_key_sql(f)} AS key, CAST(metric | {count_bits} AS VARCHAR) AS field, n AS value, {ttl} AS ttl FROM g
  UNION ALL SELECT n, {_key_sql(f)}, CAST(metric | {hours_bits} AS VARCHAR), last, {last_ttl} FROM g)"""


def _register_families() -> None:
    for f in C.FAMILIES:
        register(f"a13_{f.name}_counts", _family_sql(f))(
            lambda spark, sf_dir, f=f: C.family_counts(counted_events(spark, sf_dir), f, AS_OF_MS)
        )
    for f in C.LAST_FAMILIES:
        register(f"a13_{f.name}_counts", _last_sql(f))(
            lambda spark, sf_dir, f=f: C.last_family(counted_events(spark, sf_dir), f, AS_OF_MS)
        )


_register_families()


@register(
    "a14_keep_first",
    f"""WITH RECURSIVE {_EV}, n AS (
  SELECT log_user_id, content_id, event_id, ms, row_number() OVER (PARTITION BY log_user_id, content_id ORDER BY ms, event_id) AS i FROM ce
), walk AS (
  SELECT *, ms AS first_ms FROM n WHERE i = 1
  UNION ALL
  SELECT n.*, CASE WHEN n.ms - walk.first_ms > 86400000 THEN n.ms ELSE walk.first_ms END
  FROM walk JOIN n ON n.log_user_id = walk.log_user_id AND n.content_id = walk.content_id AND n.i = walk.i + 1
) SELECT log_user_id, content_id, min(event_id) AS event_id, ms FROM walk WHERE ms = first_ms GROUP BY log_user_id, content_id, ms""",
)
def keep_first_query(spark, sf_dir):
    rows = counted_events(spark, sf_dir).select("log_user_id", "content_id", "event_id", "ms")
    return D.keep_first(rows, ["log_user_id", "content_id"], "ms", ["event_id"], D.RETENTION_MS["action"])


@register(
    "a17_feature_ids",
    "WITH t AS (SELECT unnest([1187840, 1236992]) AS k, unnest([0, 0]) AS z), m AS (SELECT unnest(range(2, 16)) AS a), "
    "w AS (SELECT unnest([2, 4, 6, 8]) AS b) SELECT CAST(a AS INTEGER) AS action_type, CAST(fid AS BIGINT) AS fid, CAST(fid - fid % 8192 AS BIGINT) AS type_bits, "
    "CAST(fid % 8192 - fid % 32 AS BIGINT) AS metric_bits, CAST(fid % 32 AS BIGINT) AS window_bits "
    "FROM (SELECT a, k + (CASE WHEN a = 12 THEN 0 ELSE a * 32 END) + b AS fid FROM t, m, w)",
)
def feature_query(spark, sf_dir):
    kinds = [(k, w) for k in ("QUERY", "LOG_USER_COUNT") for w in ("HOUR", "DAY", "DAY_7", "DAY_30")]
    ids = F.array(
        *[
            (S.metric(F.col("action_type")).bitwiseOR(F.lit((1187840 if k == "QUERY" else S.TYPE_BITS[k]) | S.WINDOW_BITS[w])))
            for k, w in kinds
        ]
    )
    rows = spark.range(2, 16).select(F.col("id").cast("int").alias("action_type")).select("action_type", F.explode(ids).alias("fid")).withColumn("fid", F.col("fid").cast("bigint"))
    return rows.select("*", *[c.cast("bigint").alias(n) for n, c in S.feature_parts(F.col("fid")).items()])


@register(
    "a18_store_commands",
    f"""WITH {_EV}, c AS (SELECT CASE event_id % 10 WHEN 0 THEN 'HDEL' WHEN 1 THEN 'HSET' ELSE 'HINCRBY' END AS op,
  log_user_id AS key, content_id AS field, event_id AS seq, CASE WHEN event_id % 3 = 0 THEN 60 ELSE 0 END AS ttl FROM ce),
  r AS (SELECT key, field, max(CASE WHEN op <> 'HINCRBY' THEN seq END) AS last_reset FROM c GROUP BY ALL)
SELECT key, field, CAST(sum(CASE WHEN op <> 'HDEL' THEN 1 ELSE 0 END) AS BIGINT) AS value,
       coalesce(max_by(ttl, CASE WHEN ttl <> 0 THEN seq END), 0) AS ttl
FROM c JOIN r USING (key, field) WHERE last_reset IS NULL OR seq >= last_reset GROUP BY key, field HAVING max_by(op, seq) <> 'HDEL'""",
)
def store_query(spark, sf_dir):
    e = counted_events(spark, sf_dir)
    op = F.when(F.col("event_id") % 10 == 0, "HDEL").when(F.col("event_id") % 10 == 1, "HSET").otherwise("HINCRBY")
    commands = e.select(
        op.alias("op"), F.col("log_user_id").alias("key"), F.col("content_id").alias("field"), F.lit(1).cast("bigint").alias("value"),
        F.when(F.col("event_id") % 3 == 0, 60).otherwise(0).alias("ttl"), F.col("event_id").alias("seq"),
    )
    return sinks.apply_commands(commands)


@register(
    "snk15_backfill_buffer",
    f"""WITH {_EV} SELECT key, field, value, ms FROM (
  SELECT log_user_id AS key, content_id AS field, event_id AS value, ms,
         row_number() OVER (PARTITION BY log_user_id, content_id, ms // 86400000 ORDER BY ms DESC, event_id DESC) AS n FROM ce) WHERE n = 1""",
)
def buffer_query(spark, sf_dir):
    e = counted_events(spark, sf_dir)
    rows = e.select(F.col("log_user_id").alias("key"), F.col("content_id").alias("field"), F.col("event_id").alias("value"), "ms")
    return C.last_write(rows, "ms", C.DAY)


@register("snk16_time_gate", f"WITH {_EV} SELECT event_id, ms FROM ce WHERE ms BETWEEN {AS_OF_MS - 7 * C.DAY} AND {AS_OF_MS - C.DAY}")
def gate_query(spark, sf_dir):
    return sinks.between(counted_events(spark, sf_dir).select("event_id", "ms"), "ms", AS_OF_MS - 7 * C.DAY, AS_OF_MS - C.DAY)


@register(
    "a10_measure",
    "SELECT CAST(l_orderkey AS VARCHAR) AS action_id, CAST(sum(CASE WHEN l_quantity > 10 THEN CAST(l_quantity AS BIGINT) ELSE 1 END) AS BIGINT) AS n FROM lineitem GROUP BY 1",
)
def measure_query(spark, sf_dir):
    rows = V.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("action_id"), F.when(F.col("l_quantity") > 10, F.col("l_quantity").cast("bigint")).otherwise(0).alias("q")
    )
    return rows.groupBy("action_id").agg(F.sum(C.measure(F.col("q"))).alias("n"))
