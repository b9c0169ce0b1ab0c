"""Queries of log batches, validation and filters, side tables, and what the sinks receive."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark import schemas
from trailmark import views as V
from trailmark.catalog import register
from trailmark.functions import scalars as S
from trailmark.operators import checks as K
from trailmark.operators import dedupe, hydrate, ingest
from trailmark.plans import metrics
from trailmark.plans.counting import AGENTS
from trailmark.session import table
from trailmark.sources import files, sinks


def _record(kind: str, **values):
    """A struct of a record type: the values given, '' or 0 or null for all else."""
    inner = kind[len("STRUCT<") : -1]
    blank = {"STRING": F.lit(""), "BIGINT": F.lit(0), "INT": F.lit(0), "DOUBLE": F.lit(0.0), "BOOLEAN": F.lit(False)}
    depth, start, parts = 0, 0, []
    for k, ch in enumerate(inner + ","):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(inner[start:k])
            start = k + 1
    out = []
    for part in parts:
        name, _, sub = part.strip().partition(": ")
        value = values.get(name)
        if value is None:
            value = blank.get(sub, F.lit(None))
        out.append(value.cast(sub).alias(name))
    return F.struct(*out)


def batches(spark, sf_dir) -> DataFrame:
    """Log batches: a user's views, impressions and actions of one day, with the batch's ids as defaults.

    Every fifth record has its own platform; views carry an agent; users differ in the case of their ids.
    """
    e = V.events(spark, sf_dir).where("event_type <> 'error'")
    ms = V.millis(F.col("rowtime"))
    platform = F.when(F.col("event_id") % 5 == 0, 2).otherwise(0)
    timing = lambda t: F.struct(F.lit(0).cast("bigint"), t.cast("bigint"), F.lit(0).cast("bigint")).cast(schemas.TIMING)
    own = {"platform_id": platform, "timing": timing(ms)}
    ident = F.col("event_id").cast("string")
    view = _record(schemas.VIEW, **own, view_id=ident, content_id=F.col("content_id"))
    imp = _record(schemas.IMPRESSION, **own, impression_id=ident, content_id=F.col("content_id"))
    act = _record(schemas.ACTION, **own, action_id=ident, content_id=F.col("content_id"), action_type=V.action_type())
    kind = lambda k: F.when(k, F.lit(True))
    is_view = (F.col("event_type") == "view") & (F.col("event_id") % 2 == 0)
    is_imp = (F.col("event_type") == "view") & (F.col("event_id") % 2 == 1)
    is_act = F.col("event_type") != "view"
    day = F.to_date("rowtime")
    grouped = e.groupBy("log_user_id", day.alias("day")).agg(
        F.collect_list(F.when(is_view, view)).alias("view"),
        F.collect_list(F.when(is_imp, imp)).alias("impression"),
        F.collect_list(F.when(is_act, act)).alias("action"),
    )
    user_info = F.struct(
        F.concat(F.lit("U"), "log_user_id"), F.concat(F.lit("LU"), "log_user_id"), F.lit(False), F.lit(False)
    ).cast(schemas.USER_INFO)
    given = {"view", "impression", "action"}
    arrays = [F.col(r) if r in given else F.array().cast(f"array<{kind_}>").alias(r) for r, kind_ in schemas.RECORDS.items()]
    start = F.unix_millis(F.col("day").cast("timestamp"))
    return grouped.select(
        F.lit(1).cast("bigint").alias("platform_id"), user_info.alias("user_info"), timing(start).alias("timing"),
        F.struct(F.lit("WEB"), F.lit("PRODUCTION")).cast(schemas.CLIENT).alias("client_info"), *arrays,
    )


_BATCH = """b AS (
  SELECT CAST(CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS platform_id, 'lu' || CAST(user_id AS VARCHAR) AS log_user_id,
         CAST(event_id AS VARCHAR) AS id, json_extract_string(props, '$.k') AS content_id, event_type, event_id,
         epoch_us(ts) // 1000 AS event_ms, 'U' || CAST(user_id AS VARCHAR) AS user_id FROM events WHERE event_type <> 'error'
)"""


def _typed(spark, sf_dir, record: str, ident: str, *more: str) -> DataFrame:
    rows = ingest.split(batches(spark, sf_dir), record)
    return rows.select("platform_id", F.col("user_info.log_user_id").alias("log_user_id"), F.col("user_info.user_id").alias("user_id"), F.col(ident).alias("id"), "content_id", F.col("timing.event_api_timestamp").alias("event_ms"), F.col("client_info.traffic_type").alias("traffic"), *more)


for _name, _where in {
    "view": "event_type = 'view' AND event_id % 2 = 0",
    "impression": "event_type = 'view' AND event_id % 2 = 1",
    "action": "event_type <> 'view'",
}.items():
    register(
        f"p3_split_{_name}",
        f"WITH {_BATCH} SELECT platform_id, log_user_id, '' AS user_id, id, content_id, event_ms, 'PRODUCTION' AS traffic FROM b WHERE {_where}",
    )(functools.partial(lambda spark, sf_dir, n: _typed(spark, sf_dir, n, f"{n}_id"), n=_name))


def mixed_batches(spark, sf_dir) -> DataFrame:
    """One batch for each event with one record, of every type in turn; two records of three have users of their own,
    half of them times, a fifth platforms."""
    e = V.events(spark, sf_dir)
    ident = F.col("event_id").cast("string")
    timing = lambda t: F.struct(F.lit(0), t, F.lit(0)).cast(schemas.TIMING)
    blank = F.struct(F.lit(""), F.lit(""), F.lit(False), F.lit(False)).cast(schemas.USER_INFO)
    own_user = F.struct(F.concat(F.lit("O"), ident), F.concat(F.lit("own"), "log_user_id"), F.lit(False), F.lit(False)).cast(schemas.USER_INFO)
    own = {
        "platform_id": F.when(F.col("event_id") % 5 == 0, 2).otherwise(0),
        "timing": timing(F.when(F.col("event_id") % 2 == 0, V.millis(F.col("rowtime"))).otherwise(0)),
        "user_info": F.when(F.col("event_id") % 3 != 0, own_user).otherwise(blank),
    }
    arrays = []
    for n, (name, kind) in enumerate(schemas.RECORDS.items()):
        one = _record(kind, request=_record(schemas.REQUEST, **own)) if name == "delivery_log" else _record(kind, **own)
        arrays.append(F.when(F.col("event_id") % len(schemas.RECORDS) == n, F.array(one)).otherwise(F.array().cast(f"array<{kind}>")).alias(name))
    user = F.struct(F.concat(F.lit("U"), "log_user_id"), F.concat(F.lit("LU"), "log_user_id"), F.lit(False), F.lit(False))
    return e.select(
        F.lit(1).cast("bigint").alias("platform_id"), user.cast(schemas.USER_INFO).alias("user_info"),
        timing(F.unix_millis(F.date_trunc("day", "rowtime").cast("timestamp"))).alias("timing"),
        F.struct(F.lit("WEB"), F.lit("PRODUCTION")).cast(schemas.CLIENT).alias("client_info"), *arrays,
    )


@register(
    "p15_log_user_users",
    """WITH e AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, epoch_us(date_trunc('day', ts)) // 1000 AS day FROM events)
SELECT CAST(1 AS BIGINT) AS platform_id, 'LU' || user_id AS log_user_id, 'U' || user_id AS user_id, day AS event_api_timestamp FROM e
UNION ALL SELECT CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END, 'own' || user_id, 'O' || event_id, CASE WHEN event_id % 2 = 0 THEN ms ELSE day END
FROM e WHERE event_id % 3 <> 0""",
)
def user_pairs(spark, sf_dir):
    return ingest.log_user_users(mixed_batches(spark, sf_dir))


@register(
    "p5_cleared_records",
    """SELECT ['user', 'cohort_membership', 'view', 'auto_view', 'delivery_log', 'impression', 'action', 'diagnostics', 'session', 'session_profile'][1 + event_id % 10] AS record,
       'LU' || user_id AS batch_log_user_id, '' AS batch_user_id, CASE WHEN event_id % 3 <> 0 THEN 'own' || user_id ELSE '' END AS log_user_id, '' AS user_id FROM events""",
)
def cleared_records(spark, sf_dir):
    rows = ingest.clear_user_id(mixed_batches(spark, sf_dir))

    def named(record):
        own = lambda x: (x["request"] if record == "delivery_log" else x)["user_info"]
        return F.transform(record, lambda x: F.struct(F.lit(record).alias("record"), own(x).alias("u")))

    each = F.explode(F.concat(*[named(r) for r in schemas.RECORDS]))
    return rows.select(F.col("user_info.log_user_id").alias("batch_log_user_id"), F.col("user_info.user_id").alias("batch_user_id"), each.alias("e")).select(
        "e.record", "batch_log_user_id", "batch_user_id", "e.u.log_user_id", "e.u.user_id"
    )


@register("p5_clear_user_id", "SELECT 'LU' || CAST(user_id AS VARCHAR) AS log_user_id, '' AS user_id, count(*) AS n FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type <> 'error') GROUP BY 1")
def cleared(spark, sf_dir):
    rows = ingest.clear_user_id(batches(spark, sf_dir))
    return rows.groupBy(F.col("user_info.log_user_id").alias("log_user_id"), F.col("user_info.user_id").alias("user_id")).agg(F.count(F.lit(1)).alias("n"))


def delivery_logs(spark, sf_dir) -> DataFrame:
    """Orders as delivery logs: the lines' parts as a matrix in the request, and as response insertions without ids."""
    lines = table(spark, sf_dir, "lineitem")
    uniq = lines.select("l_orderkey", "l_partkey").distinct()
    cell = F.struct("l_partkey").alias("x")
    grouped = uniq.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(cell)).alias("xs"))
    row = F.transform("xs", lambda x: F.array(x["l_partkey"].cast("string"), (x["l_partkey"] % 10).cast("string"), F.lit("red"), F.lit("s"), (x["l_partkey"] % 3).cast("string")))
    request = _record(
        schemas.REQUEST, platform_id=F.lit(9), request_id=F.col("l_orderkey").cast("string"),
        insertion_matrix_headers=F.array(*[F.lit(h) for h in ("contentId", "retrievalRank", "color", "size.eu.men", "size.us")]), insertion_matrix=row,
    )
    response = F.transform(
        "xs", lambda x, i: _record(schemas.INSERTION, content_id=x["l_partkey"].cast("string"), position=i.cast("bigint"))
    )
    execution = F.transform("xs", lambda x, i: _record(schemas.INSERTION, content_id=x["l_partkey"].cast("string"), retrieval_score=i.cast("double")))
    batch = grouped.select(
        F.lit(1).cast("bigint").alias("platform_id"), F.lit(None).cast(schemas.USER_INFO).alias("user_info"),
        F.lit(None).cast(schemas.TIMING).alias("timing"), F.lit(None).cast(schemas.CLIENT).alias("client_info"),
        F.array(
            F.struct(
                F.lit(0).cast("bigint").alias("platform_id"), request.alias("request"),
                F.struct(response.cast(f"array<{schemas.INSERTION}>").alias("insertion"), F.lit("pg").alias("paging_id")).alias("response"),
                F.struct(F.lit("API").alias("execution_server"), execution.cast(f"array<{schemas.INSERTION}>").alias("insertion")).alias("execution"),
            )
        ).alias("delivery_log"),
    )
    return ingest.split(batch, "delivery_log")


_PARTS = """parts AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1 AS pos
  FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem))"""


@register(
    "p6_restructured_insertions",
    f"""WITH {_PARTS} SELECT CAST(1 AS BIGINT) AS platform_id, CAST(l_orderkey AS VARCHAR) AS request_id, CAST(l_partkey AS VARCHAR) AS content_id,
pos AS position, l_partkey % 10 AS retrieval_rank,
'{{"color":"red","size":{{"eu":{{"men":"s"}},"us":"' || (l_partkey % 3) || '"}}}}' AS properties FROM parts""",
)
def restructured(spark, sf_dir):
    logs = ingest.restructure(delivery_logs(spark, sf_dir))
    rows = logs.select("platform_id", F.col("request.request_id").alias("request_id"), F.explode("request.insertion").alias("i"))
    return rows.select("platform_id", "request_id", "i.content_id", "i.position", "i.retrieval_rank", "i.properties")


@register(
    "p7_fixed_response_ids",
    f"WITH {_PARTS} SELECT CAST(1 AS BIGINT) AS platform_id, CAST(l_orderkey AS VARCHAR) AS request_id, concat_ws('-', l_orderkey, pos, l_partkey) AS insertion_id, CAST(l_partkey AS VARCHAR) AS content_id, pos AS position FROM parts",
)
def fixed(spark, sf_dir):
    return ingest.insertion_ids(ingest.fix_response(delivery_logs(spark, sf_dir)), "response")


@register(
    "p7_split_sdk_logs",
    f"""WITH {_PARTS} SELECT CAST(l_orderkey AS VARCHAR) AS request_id, CAST(l_partkey AS VARCHAR) AS content_id, pos AS position,
CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE 'p' END AS response_properties, CASE WHEN l_orderkey % 2 = 0 THEN 'p' END AS request_properties,
CASE WHEN l_orderkey % 2 = 0 THEN 0 END AS request_position FROM parts""",
)
def split_sdk_logs(spark, sf_dir):
    logs = delivery_logs(spark, sf_dir)
    sdk = F.when(F.col("request.request_id").cast("bigint") % 2 == 0, "SDK").otherwise("API")
    held = F.transform("response.insertion", lambda i: i.withField("properties", F.lit("p")))
    logs = logs.withColumns({"response": F.col("response").withField("insertion", held), "execution": F.col("execution").withField("execution_server", sdk)})
    fixed = ingest.fix_response(logs)
    rows = fixed.select(F.col("request.request_id").alias("request_id"), F.col("request.insertion").alias("asked"), F.posexplode("response.insertion").alias("n", "i"))
    asked = F.get("asked", F.col("n"))
    return rows.select(
        "request_id", "i.content_id", "i.position", F.col("i.properties").alias("response_properties"),
        asked["properties"].alias("request_properties"), asked["position"].alias("request_position"),
    )


@register("p16_delivery_log_ids", "SELECT DISTINCT CAST(1 AS BIGINT) AS platform_id, CAST(l_orderkey AS VARCHAR) AS request_id, '' AS view_id, '' AS client_request_id, '' AS log_user_id FROM lineitem")
def log_ids(spark, sf_dir):
    return ingest.delivery_ids(delivery_logs(spark, sf_dir))


@register(
    "j10_bundled_insertions",
    f"WITH {_PARTS} SELECT CAST(l_orderkey AS VARCHAR) AS request_id, CAST(l_partkey AS VARCHAR) AS content_id, l_partkey % 10 AS rank, CAST(pos AS DOUBLE) AS score FROM parts",
)
def bundled(spark, sf_dir):
    rows = hydrate.bundle_insertions(ingest.restructure(delivery_logs(spark, sf_dir)))
    return rows.select("request_id", "response_insertion.content_id", F.col("request_insertion.retrieval_rank").alias("rank"), F.col("execution_insertion.retrieval_score").alias("score"))


@register("p13_other_content_ids", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def others(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", ingest.other_contents(F.col("props"), ["k", "missing"]).alias("m"))
    return rows.select("event_id", F.col("m")["k"].alias("k"))


@register("p21_schema_remap", "SELECT event_id AS platformId, CAST(value AS VARCHAR) IS NOT NULL AS has_value, 0 AS newTestField FROM events")
def remapped(spark, sf_dir):
    from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

    target = StructType([StructField("platformId", LongType()), StructField("newTestField", IntegerType()), StructField("value", StringType())])
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("platformId"), "value", "props")
    return ingest.aligned(rows, target, {"newTestField": 0}).select("platformId", F.col("value").isNotNull().alias("has_value"), "newTestField")


def _raw_actions(spark, sf_dir) -> DataFrame:
    """Events as actions with gaps: no user, no ids, carts with blank contents and zero quantities."""
    e = V.events(spark, sf_dir)
    gap = lambda n, c: F.when(F.col("event_id") % n == 0, "").otherwise(c)
    item = F.struct(gap(7, F.col("content_id")).alias("content_id"), (F.col("event_id") % 4).alias("quantity"))
    return e.select(
        F.col("event_id").cast("string").alias("action_id"), gap(11, F.col("log_user_id")).alias("log_user_id"), gap(3, F.col("content_id")).alias("content_id"),
        F.lit("").alias("impression_id"), F.when(F.col("event_id") % 9 == 0, "i").otherwise("").alias("insertion_id"),
        F.when(F.col("event_id") % 2 == 0, F.array(item)).alias("cart"), "event_id",
    )


_RAW = """r AS (SELECT event_id, CAST(event_id AS VARCHAR) AS action_id, CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS log_user_id,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'c' END AS content_id, CASE WHEN event_id % 9 = 0 THEN 'i' ELSE '' END AS insertion_id,
  event_id % 2 = 0 AS has_cart, CASE WHEN event_id % 7 = 0 THEN '' ELSE 'c' END AS cart_content, event_id % 4 AS q FROM events),
err AS (
  SELECT action_id, 'MISSING_FIELD' AS error_type, 'LOG_USER_ID' AS field FROM r WHERE log_user_id = ''
  UNION ALL SELECT action_id, 'MISSING_JOINABLE_ID', 'MULTIPLE' FROM r WHERE content_id = '' AND insertion_id = '' AND NOT (has_cart AND cart_content <> '')
  UNION ALL SELECT action_id, 'MISSING_FIELD', 'CART_CONTENT_QUANTITY' FROM r WHERE has_cart AND q = 0
  UNION ALL SELECT action_id, 'MISSING_FIELD', 'CART_CONTENT_ID' FROM r WHERE has_cart AND cart_content = '')"""


@register("f9_action_errors", f"WITH {_RAW} SELECT 'ACTION' AS record_type, * FROM err")
def action_errors(spark, sf_dir):
    return K.validated(_raw_actions(spark, sf_dir), K.action_errors(), "ACTION", ["action_id"])[1]


@register("f9_valid_actions", f"WITH {_RAW} SELECT action_id FROM r ANTI JOIN err USING (action_id)")
def valid_actions(spark, sf_dir):
    return K.validated(_raw_actions(spark, sf_dir), K.action_errors(), "ACTION", ["action_id"])[0].select("action_id")


@register(
    "f10_impression_errors",
    f"""WITH {_RAW} SELECT 'IMPRESSION' AS record_type, 'MISSING_FIELD' AS error_type, 'LOG_USER_ID' AS field, action_id FROM r WHERE log_user_id = ''
UNION ALL SELECT 'IMPRESSION', 'MISSING_JOINABLE_ID', 'MULTIPLE', action_id FROM r WHERE content_id = '' AND insertion_id = ''""",
)
def impression_errors(spark, sf_dir):
    return K.validated(_raw_actions(spark, sf_dir), K.impression_errors(), "IMPRESSION", ["action_id"])[1]


@register("f11_delivery_errors", "SELECT 'DELIVERY_LOG' AS record_type, 'INVALID' AS error_type, 'INSERTION_MATRIX' AS field, o_orderkey FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT 'DELIVERY_LOG', 'MISSING_FIELD', 'LOG_USER_ID', o_orderkey FROM orders WHERE o_custkey % 10 = 0")
def delivery_errors(spark, sf_dir):
    n = (F.col("o_orderkey") % 3 + 1).cast("int")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 10 == 0, "").otherwise("u").alias("log_user_id"),
        F.array(F.lit("contentId")).alias("insertion_matrix_headers"), F.array(F.array_repeat(F.lit("x"), n)).alias("insertion_matrix"),
    )
    return K.validated(rows, K.delivery_errors(), "DELIVERY_LOG", ["o_orderkey"])[1]


@register("f12_view_errors", f"WITH {_RAW} SELECT 'VIEW' AS record_type, 'MISSING_FIELD' AS error_type, 'LOG_USER_ID' AS field, action_id FROM r WHERE log_user_id = ''")
def view_errors(spark, sf_dir):
    return K.validated(_raw_actions(spark, sf_dir), K.required_errors("log_user_id", "LOG_USER_ID"), "VIEW", ["action_id"])[1]


_TRAFFIC = ("PRODUCTION", "SHADOW", "LOAD_TEST", "REPLAY", "UNKNOWN")


@register("f2_should_join", "SELECT event_id, CASE event_id % 5 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 3 END AS priority FROM events WHERE event_id % 5 NOT IN (2, 3)")
def should_join(spark, sf_dir):
    traffic = F.get(F.array(*[F.lit(t) for t in _TRAFFIC]), (F.col("event_id") % 5).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", traffic.alias("traffic"))
    keep, _ = K.partition_by(rows, K.should_join(F.col("traffic")))
    return keep.select("event_id", K.traffic_priority(F.col("traffic")).alias("priority"))


@register("f3_bot_filter", "SELECT event_id, ['Windows', 'iOS', 'Linux'][1 + CAST(user_id % 4 AS INTEGER)] AS os, ['Chrome', 'Safari', 'Firefox'][1 + CAST(user_id % 4 AS INTEGER)] AS browser FROM events WHERE user_id % 4 < 3")
def bots(spark, sf_dir):
    agent = F.get(F.array(*[F.lit(a) for a in AGENTS]), (F.col("user_id") % len(AGENTS)).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", agent.alias("agent"))
    keep, _ = K.partition_by(rows, ~S.is_bot(F.col("agent")))
    return keep.select("event_id", S.os_family(F.col("agent")).alias("os"), S.browser_family(F.col("agent")).alias("browser"))


@register("f4_ignore_usage", "SELECT event_id FROM events WHERE event_id % 4 <> 0 AND user_id % 6 <> 0")
def ignored(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    flags = K.ignores_usage(F.col("event_id") % 4 == 0, F.col("user_id") % 6 == 0, F.lit(None).cast("boolean"))
    return K.partition_by(rows, ~flags)[0].select("event_id")


@register("f5_buyers", "SELECT event_id FROM events WHERE event_id % 3 <> 1")
def buyers(spark, sf_dir):
    ids = F.create_map(F.lit(77).cast("bigint"), F.col("event_id") % 3)
    return table(spark, sf_dir, "events").where(K.is_buyer(ids, [77, 78])).select("event_id")


@register("f8_query_length", "SELECT conv_id, turn FROM conversations WHERE trim(coalesce(text, '')) <> '' AND length(text) <= 100")
def query_length(spark, sf_dir):
    from trailmark.operators.counters import query_ok

    return table(spark, sf_dir, "conversations").where(query_ok(F.col("text"))).select("conv_id", "turn")


@register("f14_debug_ids", "SELECT event_id FROM events WHERE contains(CAST(user_id AS VARCHAR), '42') OR contains(CAST(event_id AS VARCHAR), '777')")
def debug_ids(spark, sf_dir):
    e = V.events(spark, sf_dir).withColumn("id", F.col("event_id").cast("string"))
    return e.where(K.matches_ids({"user": {"42"}, "event": {"777"}}, {"user": "log_user_id", "event": "id"})).select("event_id")


@register("fn_java_hash_code", "SELECT p_partkey, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS h FROM (SELECT p_partkey, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(p_name, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda a, b: (a * 31 + b) % 4294967296) AS h FROM part)")
def java_hash(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", S.java_hash_code(F.col("p_name")).alias("h"))


def _hash_rows() -> list[str]:
    """(type, hash, hex digits) of the part types in lower case."""
    import xxhash

    out = []
    for kind in ("economy", "standard", "small", "medium", "large", "promo"):
        n = xxhash.xxh64_intdigest(kind, 0)
        out.append(f"('{kind}', {n - (1 << 64) if n >> 63 else n}, '{n:x}')")
    return out


@register(
    "fn_query_hash",
    # from the library, as DuckDB has no XXH64
    "SELECT DISTINCT lower(p_type) AS q, h.hash, h.hex FROM part JOIN (VALUES " + ", ".join(_hash_rows()) + ") h(q, hash, hex) ON h.q = lower(p_type)",
)
def query_hash(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.lower("p_type").alias("q")).distinct().select("q", S.query_hash(F.col("q")).alias("hash"), S.xxh64_hex(F.col("q")).alias("hex"))


@register("fn_action_name", "SELECT event_id, CASE event_type WHEN 'click' THEN 'NAVIGATE' WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'COMPLETE_SIGN_UP' ELSE 'my-' || event_type END AS name FROM events")
def names(spark, sf_dir):
    kind = F.when(F.col("event_type").isin("click", "purchase", "signup"), V.action_type()).otherwise(1)
    return table(spark, sf_dir, "events").select("event_id", S.action_name(kind, F.concat(F.lit("my-"), "event_type")).alias("name"))


@register("fn_calendar_keys", "SELECT event_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS hour_key, (epoch_us(ts) // 1000 // 900000) * 900000 AS quarter FROM events")
def calendar(spark, sf_dir):
    return V.events(spark, sf_dir).select("event_id", S.hour_key(F.col("rowtime")).alias("hour_key"), S.floor_millis(V.millis(F.col("rowtime")), 900_000).alias("quarter"))


@register("snk7_metrics_documents", f"""WITH {metrics._EVENTS_SQL}, steps AS (
  SELECT *, date_trunc('day', rowtime) AS day, hour(rowtime) // 12 AS step FROM unified WHERE content_id <> ''
), spread AS (SELECT *, unnest(range(step + 1, 3)) AS ends FROM steps)
SELECT strftime(day, '%Y-%m-%d') || '@' || platform_id || '@' || content_id AS id,
       strftime(CAST(day AS TIMESTAMP) + to_hours(CAST(ends * 12 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS time, CAST(sum(view_count) AS BIGINT) AS views
FROM spread GROUP BY day, ends, platform_id, content_id""")
def documents_out(spark, sf_dir):
    docs = sinks.metrics_document(metrics.cumulated(metrics._unified(spark, sf_dir), 12))
    return docs.select("id", F.col("header.eventDateTimestamp").alias("time"), F.col("body.view_count").alias("views"))


@register("snk8_json_messages", "SELECT CAST(o_orderkey AS VARCHAR) AS key, '{\"o_orderkey\":' || o_orderkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}' AS value FROM orders")
def json_messages(spark, sf_dir):
    return sinks.message_records(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderkey"))


@register(
    "snk10_user_key_bytes",
    "SELECT c_custkey, array_to_string(list_transform(range(0, 8), lambda k: printf('%02x', (c_custkey >> CAST(8 * k AS BIGINT)) & 255)), '') || lower(hex(encode(c_name))) AS key FROM customer",
)
def key_bytes(spark, sf_dir):
    key = S.user_key_bytes(F.col("c_custkey"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.lower(F.hex(key)).alias("key"))


@register("snk12_lake_upsert", "SELECT log_user_id, event_id, dt FROM (SELECT CAST(user_id AS VARCHAR) AS log_user_id, event_id, strftime(ts, '%Y-%m-%d') AS dt, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def lake(spark, sf_dir):
    e = V.events(spark, sf_dir)
    rows = ingest.lake_row(e, ["log_user_id"], {"dt": F.date_format("rowtime", "yyyy-MM-dd")})
    old, new = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")
    return sinks.upsert(new, old, ["log_user_id"], ["rowtime", "event_id"]).select("log_user_id", "event_id", "dt")


@register("snk19_joined_keys", "SELECT CAST(l_orderkey AS VARCHAR) AS action_id, CAST(l_partkey AS VARCHAR) AS content_id FROM lineitem GROUP BY ALL")
def joined_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("action_id"), F.col("l_partkey").cast("string").alias("content_id"), "l_linenumber")
    return dedupe.latest_per_key(rows, ["action_id", "content_id"], ["l_linenumber"]).select("action_id", "content_id")


@register("snk20_raw_dated_counts", f"WITH {_BATCH} SELECT strftime(make_timestamp(event_ms * 1000), '%Y-%m-%d') AS dt, strftime(make_timestamp(event_ms * 1000), '%H') AS hour, count(*) AS n FROM b WHERE event_type <> 'view' GROUP BY ALL")
def raw_dated(spark, sf_dir):
    rows = sinks.with_date_hour(ingest.split(batches(spark, sf_dir), "action"), F.col("timing.event_api_timestamp"))
    return rows.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n"))


def _funnel_sql(requests: int) -> str:
    """Every row of the funnel from its number, by the rule of the generator's options."""
    o = files.FunnelOptions()
    chance = lambda salt, percent: f"CAST('0x' || substr(md5('{salt}:' || id), 1, 6) AS BIGINT) % 100 < {percent}"
    kinds = (
        ("true", "insertion", 0, "''", "''"), ("imp", "impression", 100, "'m' || id", "''"), ("imp AND twice", "impression", 150, "'m' || id || 'b'", "''"),
        ("imp AND nav", "navigate", 200, "shown", "'n' || id"), ("imp AND buy", "purchase", 300, "shown", "'p' || id"),
    )
    rows = " UNION ALL ".join(
        f"SELECT platform_id, log_user_id, ms + {after} AS ms, '{kind}' AS kind, request_id, insertion_id, {imp} AS impression_id, {act} AS action_id, content_id FROM f WHERE {flag}"
        for flag, kind, after, imp, act in kinds
    )
    return f"""WITH n AS (SELECT id, id // {o.insertions_per_request} AS r FROM range({requests * o.insertions_per_request}) t(id)), f AS (
  SELECT CAST(1 AS BIGINT) AS platform_id, 'u' || (r % {o.users}) AS log_user_id, {o.start_ms} + r * 1000 + id % {o.insertions_per_request} AS ms, id,
         'r' || r AS request_id, 'i' || id AS insertion_id, 'c' || (id % 50) AS content_id, {chance("impression", o.impressed)} AS imp,
         {chance("navigate", o.navigated)} AS nav, {chance("purchase", o.purchased)} AS buy, {chance("redundant", o.redundant)} AS twice,
         CASE WHEN {chance("missing", o.missing_impression_id)} THEN '' ELSE 'm' || id END AS shown FROM n) {rows}"""


@register("src8_generated_funnel", _funnel_sql(2_000))
def funnel(spark, sf_dir):
    return files.generated_funnel(spark, 2_000)


@register("src9_content_dimension", "SELECT p_brand AS store, count(*) AS items, count(DISTINCT p_type) AS promotions FROM part GROUP BY 1")
def content_dimension(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("store")).agg(F.count(F.lit(1)).alias("items"), F.countDistinct("p_type").alias("promotions"))


@register("src7_end_cutoff", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15'")
def cutoff(spark, sf_dir):
    from trailmark.sources.files import until

    return until(table(spark, sf_dir, "events"), "ts", F.lit("2024-01-15").cast("timestamp_ntz")).select("event_id")
