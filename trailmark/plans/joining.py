"""Queries of attribution, temporal joins, reduction and details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark import views as V
from trailmark.catalog import register
from trailmark.functions import scalars as S
from trailmark.operators import attribution as A
from trailmark.operators import checks, hydrate
from trailmark.operators import temporal as T
from trailmark.session import table

HOUR, DAY = 3_600_000, 86_400_000


def _tiny(spark, sf_dir, kinds: str) -> DataFrame:
    """Narrow events: user key, time and ids; contents are k % 5, so that users meet the same content again."""
    return V.events(spark, sf_dir).where(kinds).select(
        "platform_id", "log_user_id", V.millis(F.col("rowtime")).alias("ms"), F.col("event_id").cast("string").alias("id"),
        (F.col("content_id").cast("int") % 5).cast("string").alias("content_id"), "event_type", "value",
    )


def impressions(spark, sf_dir) -> DataFrame:
    blank = [F.lit("").alias(c) for c in ("insertion_id", "request_id", "view_id")]
    return _tiny(spark, sf_dir, "event_type = 'view' AND event_id % 2 = 1").select(
        "platform_id", "log_user_id", "ms", F.col("id").alias("impression_id"), *blank, "content_id"
    )


def actions(spark, sf_dir) -> DataFrame:
    blank = [F.lit("").alias(c) for c in ("impression_id", "insertion_id", "request_id", "view_id")]
    return _tiny(spark, sf_dir, "event_type IN ('click', 'purchase', 'signup')").select(
        "platform_id", "log_user_id", "ms", F.col("id").alias("action_id"), *blank, "content_id"
    )


_TINY = """tiny AS (
  SELECT CAST(1 AS BIGINT) AS platform_id, CAST(user_id AS VARCHAR) AS log_user_id, epoch_us(ts) // 1000 AS ms, event_id,
         CAST(event_id AS VARCHAR) AS id, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS content_id,
         event_type, value, ts FROM events
), imp AS (SELECT * FROM tiny WHERE event_type = 'view' AND event_id % 2 = 1),
act AS (SELECT * FROM tiny WHERE event_type IN ('click', 'purchase', 'signup'))"""


@register(
    "j4_impression_action_inferred",
    f"""WITH {_TINY}, p AS (
  SELECT a.id AS action_id, a.content_id, i.id AS left_key, i.ms AS left_ms,
         row_number() OVER (PARTITION BY a.log_user_id, a.id ORDER BY abs(a.ms - i.ms), i.ms DESC, i.id) AS n
  FROM act a JOIN imp i ON a.log_user_id = i.log_user_id AND a.content_id = i.content_id
   AND i.ms BETWEEN a.ms - {DAY} AND a.ms)
SELECT action_id, content_id, left_key, left_ms, 'inferred' AS kind FROM p WHERE n = 1""",
)
def impression_action(spark, sf_dir):
    joined = A.attribute(impressions(spark, sf_dir), actions(spark, sf_dir), A.IMPRESSION_ACTION)
    return joined.select("action_id", "content_id", "left_key", "left_ms", "kind")


def order_lines(spark, sf_dir) -> DataFrame:
    """Order lines with their order's customer and date, as the tables have them."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return rows.select("o_custkey", "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def order_insertions(spark, sf_dir) -> DataFrame:
    """Order lines as delivered insertions: ten minutes apart within their order."""
    return line_insertions(order_lines(spark, sf_dir))


def line_insertions(rows: DataFrame) -> DataFrame:
    """The same of rows of `order_lines`."""
    return rows.select(
        F.lit(1).cast("bigint").alias("platform_id"), F.col("o_custkey").cast("string").alias("log_user_id"),
        (V.millis(F.col("o_orderdate")) + F.col("l_linenumber") * 600_000).alias("ms"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("insertion_id"),
        F.col("l_orderkey").cast("string").alias("request_id"), F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("view_id"),
        (F.col("l_partkey") % 7).cast("string").alias("content_id"), ((F.col("l_orderkey") + F.col("l_linenumber")) % 4).alias("mode"),
    )


def order_impressions(spark, sf_dir) -> DataFrame:
    """Impressions of order lines a minute later: with the insertion id, or only the request's, the view's, or none."""
    rows = order_insertions(spark, sf_dir)
    return rows.select(
        "platform_id", "log_user_id", (F.col("ms") + 60_000).alias("ms"), F.concat(F.lit("m"), F.col("insertion_id")).alias("impression_id"),
        F.when(F.col("mode") == 0, F.col("insertion_id")).otherwise("").alias("insertion_id"),
        F.when(F.col("mode") == 1, F.col("request_id")).otherwise("").alias("request_id"),
        F.when(F.col("mode") == 2, F.col("view_id")).otherwise("").alias("view_id"), "content_id",
    )


_LINES = """ins AS (
  SELECT CAST(1 AS BIGINT) AS platform_id, CAST(o_custkey AS VARCHAR) AS log_user_id,
         epoch_us(o_orderdate) // 1000 + l_linenumber * 600000 AS ms,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS insertion_id,
         CAST(l_orderkey AS VARCHAR) AS request_id, 'v' || CAST(o_custkey AS VARCHAR) AS view_id,
         CAST(l_partkey % 7 AS VARCHAR) AS content_id, (l_orderkey + l_linenumber) % 4 AS mode
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), im AS (
  SELECT log_user_id, ms + 60000 AS ms, 'm' || insertion_id AS impression_id, content_id,
         CASE WHEN mode = 0 THEN insertion_id ELSE '' END AS insertion_id, CASE WHEN mode = 1 THEN request_id ELSE '' END AS request_id,
         CASE WHEN mode = 2 THEN view_id ELSE '' END AS view_id FROM ins
)"""


def _scope_sql(rank: int, name: str) -> str:
    return f"""SELECT m.impression_id, m.content_id, i.insertion_id AS left_key, i.ms AS left_ms, {rank} AS rank, m.ms
  FROM im m JOIN ins i ON m.log_user_id = i.log_user_id AND m.{name} = i.{name} AND m.content_id = i.content_id
  WHERE m.insertion_id = '' AND m.{name} <> '' AND i.ms BETWEEN m.ms - 1800000 AND m.ms"""


@register(
    "j3_insertion_impression",
    f"""WITH {_LINES}, p AS ({_scope_sql(0, "request_id")} UNION ALL {_scope_sql(1, "view_id")} UNION ALL {_scope_sql(2, "content_id")}),
b AS (SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY rank, abs(ms - left_ms), left_ms DESC, left_key) AS n FROM p)
SELECT impression_id, content_id, left_key, left_ms, 'inferred' AS kind FROM b WHERE n = 1
UNION ALL SELECT m.impression_id, m.content_id, i.insertion_id, i.ms, 'explicit' FROM im m JOIN ins i USING (log_user_id, insertion_id)""",
)
def insertion_impression(spark, sf_dir):
    joined = A.attribute(order_insertions(spark, sf_dir).drop("mode"), order_impressions(spark, sf_dir), A.INSERTION_IMPRESSION)
    return joined.select("impression_id", "content_id", "left_key", "left_ms", "kind")


@register(
    "j2_view_insertion_outer",
    f"""WITH {_TINY}, v AS (SELECT * FROM tiny WHERE event_type = 'view' AND event_id % 2 = 0), p AS (
  SELECT a.id, v.id AS left_key, v.ms AS left_ms,
         row_number() OVER (PARTITION BY a.log_user_id, a.id ORDER BY abs(a.ms - v.ms), v.ms DESC, v.id) AS n
  FROM act a JOIN v ON a.log_user_id = v.log_user_id AND v.ms BETWEEN a.ms - 600000 AND a.ms)
SELECT a.id AS insertion_id, coalesce(p.left_key, '') AS left_key, p.left_ms, CASE WHEN p.id IS NULL THEN 'none' ELSE 'inferred' END AS kind
FROM act a LEFT JOIN p ON p.id = a.id AND p.n = 1""",
)
def view_insertion(spark, sf_dir):
    views = _tiny(spark, sf_dir, "event_type = 'view' AND event_id % 2 = 0").withColumnRenamed("id", "view_id").drop("event_type", "value")
    right = actions(spark, sf_dir).drop("insertion_id", "impression_id").withColumnRenamed("action_id", "insertion_id")
    return A.attribute(views, right, A.VIEW_INSERTION).select("insertion_id", "left_key", "left_ms", "kind")


def _with_others(df: DataFrame, own, others) -> DataFrame:
    """Events with a content of their own and a map of other contents by dimension (1: store, 2: brand)."""
    values = F.create_map(F.lit(1), others[0].cast("string"), F.lit(2), others[1].cast("string"))
    return df.withColumns({"content_id": own.cast("string"), "other_content_ids": values})


_OTHERS = f"""{_TINY}, i2 AS (SELECT log_user_id, ms, id, 'c' || event_id % 4 AS content_id, 's' || event_id % 3 AS store, 'b' || event_id % 2 AS brand,
  CAST(event_id % 3 AS VARCHAR) AS view_id FROM imp),
a2 AS (SELECT log_user_id, ms, id, CASE event_id % 4 WHEN 0 THEN 's' || event_id % 3 WHEN 1 THEN 'c' || event_id % 5 WHEN 2 THEN '' ELSE 'b1' END AS content_id,
  CASE WHEN event_id % 4 = 2 THEN 's1' ELSE '' END AS store, CAST(event_id % 3 AS VARCHAR) AS view_id FROM act)"""


def _two_sided(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    n = F.col("event_id")
    shown, done = impressions(spark, sf_dir), actions(spark, sf_dir)
    shown = shown.withColumn("event_id", F.col("impression_id").cast("bigint"))
    done = done.withColumn("event_id", F.col("action_id").cast("bigint"))
    left = _with_others(shown, F.concat(F.lit("c"), n % 4), (F.concat(F.lit("s"), n % 3), F.concat(F.lit("b"), n % 2)))
    own = F.when(n % 4 == 0, F.concat(F.lit("s"), n % 3)).when(n % 4 == 1, F.concat(F.lit("c"), n % 5)).when(n % 4 == 2, "").otherwise("b1")
    right = _with_others(done, own, (F.when(n % 4 == 2, "s1").otherwise(""), F.lit("")))
    return left, right


@register(
    "j4_other_contents",
    f"""WITH {_OTHERS}, scopes AS (
  SELECT id, 0 AS rank, content_id AS scope FROM a2 WHERE content_id <> '' UNION ALL SELECT id, 1, store FROM a2 WHERE store <> ''),
p AS (SELECT a.id AS action_id, i.id AS left_key, i.ms AS left_ms,
    row_number() OVER (PARTITION BY a.id ORDER BY s.rank, abs(a.ms - i.ms), i.ms DESC, i.id) AS n
  FROM a2 a JOIN scopes s USING (id) JOIN i2 i ON a.log_user_id = i.log_user_id AND s.scope IN (i.content_id, i.store)
   AND i.ms BETWEEN a.ms - {5 * DAY} AND a.ms + {HOUR})
SELECT action_id, left_key, left_ms FROM p WHERE n = 1""",
)
def other_contents(spark, sf_dir):
    """Actions on a store that meet impressions of its items: the store dimension is selected, the brand is not."""
    left, right = _two_sided(spark, sf_dir)
    o = A.JoinOptions(
        "impression_id", ("content_id",), 5 * DAY, HOUR, use_contents=True, right_key=("action_id",), other_dimensions=(1,)
    )
    return A.attribute(left, right, o).select("action_id", "left_key", "left_ms")


@register(
    "j5_content_overlap",
    f"""WITH {_OTHERS}, p AS (SELECT a.id AS action_id, i.id AS left_key,
    row_number() OVER (PARTITION BY a.id ORDER BY abs(a.ms - i.ms), i.ms DESC, i.id) AS n
  FROM a2 a JOIN i2 i ON a.log_user_id = i.log_user_id AND a.view_id = i.view_id AND i.ms BETWEEN a.ms - {5 * DAY} AND a.ms
  WHERE a.content_id IN (i.content_id, i.store, i.brand) OR (a.store <> '' AND a.store = i.store))
SELECT action_id, left_key FROM p WHERE n = 1""",
)
def content_overlap(spark, sf_dir):
    """Within a view, only impressions that share a content with the action, whichever it is of either, count."""
    left, right = _two_sided(spark, sf_dir)
    view = lambda df: df.withColumn("view_id", (F.col("event_id") % 3).cast("string"))
    o = A.JoinOptions("impression_id", ("view_id",), 5 * DAY, use_contents=True, right_key=("action_id",))
    return A.attribute(view(left), view(right), o).select("action_id", "left_key")


@register(
    "j6_as_of_user",
    f"""WITH {_TINY}, s AS (SELECT log_user_id, ms, max(value) AS version FROM tiny WHERE event_type = 'signup' GROUP BY ALL)
SELECT a.id AS action_id, s.version FROM (SELECT * FROM tiny WHERE event_type IN ('click', 'purchase')) a
ASOF JOIN s ON a.log_user_id = s.log_user_id AND a.ms >= s.ms""",
)
def as_of_user(spark, sf_dir):
    facts = _tiny(spark, sf_dir, "event_type IN ('click', 'purchase')").select("log_user_id", "ms", F.col("id").alias("action_id"))
    versions = _tiny(spark, sf_dir, "event_type = 'signup'").select("log_user_id", "ms", F.col("value").alias("version"))
    return T.as_of(facts, versions, ["log_user_id"], "ms", ["version"]).select("action_id", "version")


@register(
    "j7_user_join",
    f"""WITH {_TINY}, u AS (SELECT log_user_id, ms, 'U' || id AS user_id FROM tiny WHERE event_type = 'signup'),
f AS (SELECT * FROM tiny WHERE event_type = 'click')
SELECT * FROM (SELECT f.id AS event_id, coalesce(
  (SELECT max_by(user_id, {{'m': ms, 'u': user_id}}) FROM u WHERE u.log_user_id = f.log_user_id AND u.ms <= f.ms),
  (SELECT min_by(user_id, {{'m': ms, 'u': user_id}}) FROM u WHERE u.log_user_id = f.log_user_id AND u.ms BETWEEN f.ms AND f.ms + {HOUR})) AS user_id FROM f)
WHERE user_id IS NOT NULL""",
)
def user_join(spark, sf_dir):
    clicks = _tiny(spark, sf_dir, "event_type = 'click'").select("platform_id", "log_user_id", "ms", F.col("id").alias("event_id"))
    ups = _tiny(spark, sf_dir, "event_type = 'signup'").select(
        "platform_id", "log_user_id", "ms", F.concat(F.lit("U"), F.col("id")).alias("user_id"), F.lit("").alias("properties")
    )
    return T.user_join(clicks, ups, HOUR).select("event_id", "user_id")


@register(
    "j8_impression_details",
    f"""WITH {_LINES} SELECT im.impression_id, ins.content_id, CASE WHEN mode < 3 THEN 'view' END AS view FROM im
JOIN ins ON im.impression_id = 'm' || ins.insertion_id WHERE CAST(ins.request_id AS BIGINT) % 5 <> 0""",
)
def impression_details(spark, sf_dir):
    ins = order_insertions(spark, sf_dir)
    tiny = ins.select(*A.USER, F.concat(F.lit("m"), "insertion_id").alias("impression_id"), "request_id", F.when(F.col("mode") < 3, F.col("view_id")).otherwise("").alias("view_id"))
    views = ins.select(*A.USER, "view_id").distinct().withColumn("view", F.lit("view"))
    deliveries = ins.where("CAST(request_id AS BIGINT) % 5 <> 0").select(*A.USER, "request_id").distinct().withColumn("delivery", F.lit("delivery"))
    full = ins.select(*A.USER, F.concat(F.lit("m"), "insertion_id").alias("impression_id"), F.struct("content_id").alias("impression"))
    joined, _ = hydrate.impression_details(tiny, views, deliveries, full)
    return joined.select("impression_id", "impression.content_id", "view")


@register(
    "j9_action_details",
    """SELECT CAST(l_orderkey AS VARCHAR) AS action_id, CASE WHEN l_partkey % 2 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE 'store' || l_partkey END AS content_id,
       CASE WHEN q = 0 THEN 1 ELSE q END AS quantity FROM (
  SELECT l_orderkey, l_partkey, first(CAST(l_quantity AS BIGINT) % 5 ORDER BY l_linenumber, CAST(l_quantity AS BIGINT) % 5) AS q FROM lineitem WHERE l_orderkey % 2 = 0 GROUP BY 1, 2)""",
)
def action_details(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    key = [F.lit(1).cast("bigint").alias("platform_id"), F.lit("u").alias("log_user_id")]
    tiny = lines.select(*key, F.col("l_orderkey").cast("string").alias("action_id"), F.col("l_orderkey").cast("string").alias("impression_id"), F.when(F.col("l_partkey") % 2 == 0, F.col("l_partkey").cast("string")).otherwise(F.concat(F.lit("store"), F.col("l_partkey").cast("string"))).alias("content_id"), F.col("l_partkey").cast("string").alias("item")).distinct()
    # half of the actions are on a store; its item in the cart is found by their other contents
    tiny = tiny.withColumn("other_content_ids", F.array(F.lit("none"), "item")).drop("item")
    shown = lines.where("l_orderkey % 2 = 0").select(*key, F.col("l_orderkey").cast("string").alias("impression_id")).distinct().withColumn("joined_impression", F.lit("i"))
    item = F.struct("l_linenumber", F.struct(F.col("l_partkey").cast("string").alias("content_id"), (F.col("l_quantity").cast("bigint") % 5).alias("quantity")).alias("c"))
    carts = lines.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["c"]).alias("cart"))
    acts = carts.select(*key, F.col("l_orderkey").cast("string").alias("action_id"), F.struct("cart").alias("action"))
    joined, _ = hydrate.action_details(tiny, shown, acts)
    return joined.select("action_id", "content_id", "single_cart_content.quantity")


@register(
    "j11_session_cogroup",
    f"""WITH {_TINY}, b AS (
  SELECT log_user_id, content_id, ts, CASE WHEN event_type = 'view' THEN id END AS i, CASE WHEN event_type <> 'view' THEN id END AS a FROM (
    SELECT * FROM imp UNION ALL SELECT * FROM act)),
g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 1 DAY OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS brk FROM b WINDOW w AS (PARTITION BY log_user_id, content_id ORDER BY ts)),
s AS (SELECT *, sum(brk) OVER (PARTITION BY log_user_id, content_id ORDER BY ts) AS sid FROM g)
SELECT log_user_id, content_id AS insertion_id, count(i) AS n_impressions, count(a) AS n_actions, min(epoch_us(ts) // 1000) AS start_ms
FROM s GROUP BY log_user_id, content_id, sid""",
)
def session_cogroup(spark, sf_dir):
    ts = F.timestamp_millis("ms").alias("ts")
    rows = lambda kinds, name: V.events(spark, sf_dir).where(kinds).select(
        "platform_id", "log_user_id", (F.col("content_id").cast("int") % 5).cast("string").alias("insertion_id"),
        F.col("rowtime").cast("timestamp").alias("ts"), F.col("event_id").cast("string").alias(name),
    )
    out = T.sessions(rows("event_type = 'view' AND event_id % 2 = 1", "impression_id"), rows("event_type IN ('click', 'purchase', 'signup')", "action_id"))
    return out.select("log_user_id", "insertion_id", F.size("impression_ids").cast("bigint").alias("n_impressions"), F.size("action_ids").cast("bigint").alias("n_actions"), F.unix_millis("session_start").alias("start_ms"))


@register(
    "j12_right_seen",
    f"""WITH {_TINY}, pop AS (SELECT content_id, date_trunc('day', ts) AS day FROM tiny GROUP BY ALL HAVING count(*) >= 60)
SELECT id FROM tiny WHERE event_type = 'error' OR EXISTS (SELECT 1 FROM pop WHERE pop.content_id = tiny.content_id AND pop.day = date_trunc('day', ts))""",
)
def right_seen(spark, sf_dir):
    e = V.events(spark, sf_dir).select(F.col("event_id").cast("string").alias("id"), (F.col("content_id").cast("int") % 5).cast("string").alias("content_id"), "event_type", "rowtime")
    w = F.window("rowtime", "1 day")
    seen = e.groupBy(w.alias("w"), "content_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 60").select("content_id", F.col("w.start").alias("a"), F.col("w.end").alias("b"))
    return T.right_seen(e, seen, ["content_id"], "a", "b", "rowtime", F.col("event_type") == "error").select("id")


@register("j13_top_n_filter", f"WITH {_TINY}, top AS (SELECT log_user_id FROM tiny GROUP BY 1 ORDER BY count(*) DESC, log_user_id LIMIT 10) SELECT id FROM tiny SEMI JOIN top USING (log_user_id)")
def top_filter(spark, sf_dir):
    from trailmark.operators.counters import top_n

    e = _tiny(spark, sf_dir, "true")
    # the list has as many rows as the report asks for
    return e.join(F.broadcast(top_n(e, "log_user_id", 10).select("log_user_id")), "log_user_id", "left_semi").select("id")


@register("j14_content_lookup", "SELECT CAST(l_orderkey AS VARCHAR) AS id, l_linenumber, p_brand AS store, CASE WHEN l_linenumber = 1 THEN 'logged' ELSE p_type END AS promotion FROM lineitem JOIN part ON l_partkey = p_partkey")
def content_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("content_id"), F.col("p_brand").alias("store"), F.col("p_type").alias("promotion"))
    logged = F.when(F.col("l_linenumber") == 1, F.create_map(F.lit("promotion"), F.lit("logged")))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("id"), "l_linenumber", F.col("l_partkey").alias("content_id"), logged.alias("other_content_ids"))
    out = hydrate.with_content(rows, parts, "content_id", ["store", "promotion"])
    return out.select("id", "l_linenumber", F.col("other_content_ids")["store"].alias("store"), F.col("other_content_ids")["promotion"].alias("promotion"))


@register(
    "j16_latest_impressions",
    f"""WITH {_TINY}, done AS (SELECT log_user_id, content_id, min(ms) AS d FROM act GROUP BY ALL), p AS (
  SELECT a.id AS action_id, i.id AS impression_id, i.ms, i.content_id,
         row_number() OVER (PARTITION BY a.log_user_id, a.id, i.content_id ORDER BY i.ms DESC, i.id) AS n
  FROM act a JOIN imp i ON a.log_user_id = i.log_user_id AND i.ms BETWEEN a.ms - 2592000000 AND a.ms
  LEFT JOIN done ON done.log_user_id = i.log_user_id AND done.content_id = i.content_id WHERE d IS NULL OR d > a.ms
), q AS (SELECT *, row_number() OVER (PARTITION BY action_id ORDER BY ms DESC, impression_id) AS r FROM p WHERE n = 1)
SELECT action_id, string_agg(impression_id, ',' ORDER BY ms, impression_id) AS impression_ids FROM q WHERE r <= 25 GROUP BY 1""",
)
def latest(spark, sf_dir):
    out = T.latest_impressions(actions(spark, sf_dir), impressions(spark, sf_dir), window=30 * DAY)
    return out.select("action_id", F.array_join("impression_ids", ",").alias("impression_ids"))


@register(
    "j17_combine_logs",
    f"""WITH RECURSIVE {_TINY}, logs AS (
  SELECT log_user_id, content_id AS client_request_id, ms, id, CASE WHEN event_id % 2 = 0 THEN 'SDK' ELSE 'API' END AS source,
         1 + event_id % 3 AS priority, CASE WHEN event_id % 2 = 1 THEN 'p' || id ELSE '' END AS paging FROM tiny WHERE event_type <> 'error'),
n AS (SELECT *, row_number() OVER (PARTITION BY log_user_id, client_request_id ORDER BY ms, id) AS i FROM logs),
walk AS (SELECT *, ms AS first_ms FROM n WHERE i = 1 UNION ALL
  SELECT n.*, CASE WHEN n.ms - walk.first_ms > {DAY} THEN n.ms ELSE walk.first_ms END FROM walk JOIN n
  ON n.log_user_id = walk.log_user_id AND n.client_request_id = walk.client_request_id AND n.i = walk.i + 1)
SELECT log_user_id, client_request_id, first_ms,
       max_by(id, {{'p': priority, 'm': ms, 'i': id}}) FILTER (source = 'SDK') AS sdk_request_id,
       max_by(id, {{'p': priority, 'm': ms, 'i': id}}) FILTER (source = 'API') AS api_request_id,
       coalesce(max_by(paging, {{'p': priority, 'm': ms, 'i': id}}) FILTER (source = 'API'), '') AS paging_id
FROM walk GROUP BY 1, 2, 3""",
)
def combine(spark, sf_dir):
    e = V.events(spark, sf_dir).where("event_type <> 'error'")
    sdk = F.col("event_id") % 2 == 0
    logs = e.select(
        "platform_id", "log_user_id", (F.col("content_id").cast("int") % 5).cast("string").alias("client_request_id"),
        V.millis(F.col("rowtime")).alias("ms"), F.col("event_id").cast("string").alias("request_id"),
        F.when(sdk, "SDK").otherwise("API").alias("source"), (1 + F.col("event_id") % 3).alias("priority"),
        F.when(sdk, "").otherwise(F.concat(F.lit("p"), F.col("event_id").cast("string"))).alias("paging_id"),
    )
    return T.combine_logs(logs, DAY).drop("platform_id")


@register(
    "j18_mismatches",
    f"""WITH {_LINES}, o AS (SELECT *, CAST((CAST(content_id AS INTEGER) * 2) % 7 AS VARCHAR) AS other FROM ins)
SELECT 'm' || insertion_id AS impression_id, 'content_id' AS field, content_id AS lhs, other AS rhs FROM o
WHERE content_id <> other AND other <> '0' AND content_id <> '0'""",
)
def mismatch(spark, sf_dir):
    rows = order_insertions(spark, sf_dir).select(
        F.concat(F.lit("m"), "insertion_id").alias("impression_id"), "content_id", ((F.col("content_id").cast("int") * 2) % 7).cast("string").alias("other")
    )
    return A.mismatches(rows, {"content_id": ("content_id", "other")})


@register(
    "p11_cart_split",
    """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS action_id, CAST(c AS VARCHAR) AS content_id, CASE WHEN o_orderkey % 3 = 0 THEN 'i' ELSE '' END AS impression_id FROM (
  SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 3 = 0 THEN [0] ELSE list_append(list(l_partkey), 0) END) AS c
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)""",
)
def cart_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey").cast("string")).alias("cart"))
    acts = lines.select(
        F.col("l_orderkey").cast("string").alias("action_id"), F.lit("0").alias("content_id"), F.lit("i").alias("impression_id"), "cart",
        F.when(F.col("l_orderkey") % 3 == 0, V.NAVIGATE).otherwise(V.PURCHASE).alias("action_type"),
    )
    return A.split_cart(acts).select("action_id", "content_id", "impression_id")


_A16 = f"""WITH RECURSIVE {_TINY}, n AS (SELECT *, row_number() OVER (PARTITION BY log_user_id, content_id ORDER BY ms, id) AS i FROM imp),
walk AS (SELECT *, ms AS first_ms FROM n WHERE i = 1 UNION ALL
  SELECT n.*, CASE WHEN n.ms - walk.first_ms > {DAY} THEN n.ms ELSE walk.first_ms END FROM walk JOIN n
  ON n.log_user_id = walk.log_user_id AND n.content_id = walk.content_id AND n.i = walk.i + 1),
roots AS (SELECT log_user_id, content_id, first_ms AS ms, min(id) AS impression_id FROM walk WHERE ms = first_ms GROUP BY ALL)"""


@register("a16_reduced_impressions", f"{_A16} SELECT impression_id, ms FROM roots")
def reduced(spark, sf_dir):
    roots, _, _ = A.reduce_redundant(impressions(spark, sf_dir), actions(spark, sf_dir), DAY)
    return roots.select("impression_id", "ms")


@register(
    "a16_repointed_actions",
    f"""{_A16} SELECT a.id AS action_id, coalesce(
  (SELECT max_by(impression_id, ms) FROM roots r WHERE r.log_user_id = a.log_user_id AND r.content_id = a.content_id AND r.ms <= a.ms),
  (SELECT min_by(impression_id, ms) FROM roots r WHERE r.log_user_id = a.log_user_id AND r.content_id = a.content_id AND r.ms > a.ms), '') AS impression_id FROM act a""",
)
def repointed(spark, sf_dir):
    _, _, pointed = A.reduce_redundant(impressions(spark, sf_dir), actions(spark, sf_dir), DAY)
    return pointed.select("action_id", "impression_id")
