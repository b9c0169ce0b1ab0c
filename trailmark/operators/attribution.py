"""Attribution joins: by explicit id, else inferred from the nearest event in time within a scope."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from trailmark.functions import scalars as S

USER = ("platform_id", "log_user_id")
#: The user as windows sort by it: a sort compares the first eight bytes first, and platforms are few.
_SORTED = USER[::-1]
#: Rows multiply about so much after an attribution's shuffle (scopes, contents), which has so many times the partitions.
GROWTH = 4
#: A user with more events than this on both sides is read by time bucket, scope and content, and not in one task.
BUSY = 50_000


@dataclass(frozen=True)
class JoinOptions:
    """How a left stream is attributed to a right one.

    scopes: ancestor ids from most to least specific, tried in that order; max_time and max_out_of_order (ms) say how
    long before and after the right event the left one may lie; retention bounds joins by id, as a multiple of
    max_time (0: unbounded); use_contents: left rows of a scope must share a content id when the right has any;
    user_scope: the user itself is the last scope. The scope content_id goes on with the other contents of an event:
    all of them where they are an array, those under the keys other_dimensions, in that order, where they are a map.
    """

    key: str
    scopes: tuple[str, ...]
    max_time: int
    max_out_of_order: int = 0
    how: str = "inner"
    retention: int = 0
    use_contents: bool = False
    user_scope: bool = False
    right_key: tuple[str, ...] = field(default=())
    other_dimensions: tuple = field(default=())


VIEW_INSERTION = JoinOptions("view_id", (), 600_000, how="right", user_scope=True, right_key=("insertion_id",))
INSERTION_IMPRESSION = JoinOptions(
    "insertion_id", ("request_id", "view_id", "content_id"), 1_800_000, use_contents=True, right_key=("impression_id",)
)
IMPRESSION_ACTION = JoinOptions(
    "impression_id",
    ("insertion_id", "request_id", "view_id", "content_id"),
    86_400_000,
    use_contents=True,
    right_key=("action_id", "content_id"),
)


def other_ids(df: DataFrame, dimensions: tuple | None = None) -> Column:
    """An event's other contents as an array; of a map all values, or those under some keys."""
    none = F.array().cast("array<string>")
    if "other_content_ids" not in df.columns:
        return none
    c = F.col("other_content_ids")
    if isinstance(df.schema["other_content_ids"].dataType, MapType):
        if dimensions is not None:
            return F.array(*[F.try_element_at(c, F.lit(d)) for d in dimensions]) if dimensions else none
        c = F.map_values(c)
    return F.coalesce(c, none)


def contents(df: DataFrame, dimensions: tuple | None = None) -> Column:
    """All content ids of an event (or, of a map of others, those under some keys): its own first, without blanks."""
    every = F.concat(F.array("content_id"), other_ids(df, dimensions))
    return F.array_distinct(F.filter(every, lambda c: ~S.blank(c)))


def _lined(left: DataFrame, right: DataFrame, o: JoinOptions) -> DataFrame:
    """Both sides in one line of rows dealt by user: the ids they share by name, lists of contents where a side has
    other ones, and the right rows' other columns as __row."""
    names = list(dict.fromkeys([o.key, *o.scopes, "content_id"]))
    more = [c for c in right.columns if c not in (*USER, "ms", *names)]
    row = F.struct(*more) if more else F.lit(None).cast("string")
    none = F.lit(None).cast("array<string>")
    others = "other_content_ids" in left.columns + right.columns

    def side(df: DataFrame, k: int, row: Column) -> DataFrame:
        ids = [F.col(c) if c in df.columns or c != "content_id" else F.lit(None).cast("string").alias(c) for c in names]
        lists = (contents(df, o.other_dimensions), contents(df)) if "other_content_ids" in df.columns else (none, none)
        lists = [c.alias(n) for c, n in zip(lists, ("__scoped", "__shared"), strict=True)] if others else []
        return df.select(*USER, "ms", *ids, F.lit(k).alias("__side"), *lists, row.alias("__row"))

    rights = side(right, 1, row)
    lefts = side(left, 0, F.lit(None).cast(rights.schema["__row"].dataType))
    parts = GROWTH * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lefts.unionByName(rights).repartition(parts, *USER)


def _scopes(df: DataFrame, o: JoinOptions, scoped: Column | None = None) -> Column:
    """An event's scopes in order: (kind, id). A content's kind is the same whether it is the event's own or another;
    scoped: the contents that are scopes, where they are at hand."""
    parts = []
    for name in o.scopes:
        if name == "content_id":
            found = contents(df, o.other_dimensions) if scoped is None else scoped
            parts.append(F.transform(found, lambda c: F.struct(F.lit("content").alias("kind"), c.alias("id"))))
        else:
            parts.append(F.array(F.struct(F.lit(name).alias("kind"), F.col(name).alias("id"))))
    if o.user_scope:
        parts.append(F.array(F.struct(F.lit("user").alias("kind"), F.lit("user").alias("id"))))
    return F.concat(*parts) if parts else F.array().cast("array<struct<kind:string,id:string>>")


def _reader(rows: DataFrame):
    """Gives a right row's column, wherever rows of `_lined` have it."""
    return lambda c: F.col(c) if c in rows.columns else F.col(f"__row.{c}")


def has_busy(left: DataFrame, right: DataFrame) -> bool:
    """Whether any user has more than BUSY events on both sides."""
    events = left.select(*USER).unionByName(right.select(*USER)).groupBy(*_SORTED).count()
    return events.where(F.col("count") > BUSY).limit(1).count() > 0


def attribute(left: DataFrame, right: DataFrame, o: JoinOptions, busy: bool = True) -> DataFrame:
    """(right's columns, left_key, left_ms, kind): the left event of each right one.

    left and right: platform_id, log_user_id, ms, and the ids named in the options ('' where absent). Left rows without
    their id are ignored, the first of an id counts. A right row with the left's id set joins by it and never falls
    back; one without tries the scopes, and takes the left row nearest in time, the later one of two as near (of equal
    times the smaller id). Blank scope ids never match. kind is explicit, inferred or, for a right join, none.

    Both sides are shuffled once, together, by user, and a user's rows are sorted by id; `_carried` then gives the open
    ones their nearest left row within the same task. Only users with more than BUSY rows are dealt anew for that; busy:
    False where it is known that there are none.
    """
    r_key = [*USER, *(o.right_key or ())]
    is_left, blank_key = F.col("__side") == 0, S.blank(F.col(o.key))
    lined = _lined(left, right, o)
    at = _reader(lined)
    whole = lambda names: F.lit(True) if not names else ~F.greatest(F.lit(False), *[at(c).isNull() for c in names])

    by_id = Window.partitionBy(*_SORTED, o.key).orderBy("__side", "ms", *o.scopes)
    rows = lined.withColumns({"__n": F.row_number().over(by_id), "__met": F.first(is_left).over(by_id), "__l_ms": F.first("ms").over(by_id)})
    hit = ~is_left & F.col("__met") & ~blank_key & whole(USER)
    if o.retention:
        lag = F.col("ms") - F.col("__l_ms")
        hit = hit & F.coalesce((lag <= o.max_time * o.retention) & (lag >= -o.max_out_of_order), F.lit(False))
    open_ = ~is_left & blank_key & whole(r_key)
    for k in o.right_key[:1]:
        open_ = open_ & ~S.blank(at(k))
    own = F.when(S.blank(F.col("content_id")), F.array().cast("array<string>")).otherwise(F.array("content_id"))
    rows = rows.where(~is_left | ((F.col("__n") == 1) & ~blank_key)).withColumns(
        {"__hit": hit, "__open": open_} | {c: F.coalesce(c, own) if c in lined.columns else own for c in ("__scoped", "__shared")}
    )

    # what the open right rows of a user look in
    has = {n: ~S.blank(F.col(n)) for n in o.scopes if n != "content_id"} | ({"user": F.lit(True)} if o.user_scope else {})
    has |= {"content": F.size("__scoped") > 0} if "content_id" in o.scopes else {}
    user = Window.partitionBy(*_SORTED)
    any_ = lambda test: F.max(F.col("__open") & test).over(user)
    sought = F.array_compact(F.array(*[F.when(any_(test), F.lit(n)) for n, test in has.items()]))
    rows = rows.withColumns({"__sought": sought, "__bare": any_(F.size("__shared") == 0), "__events": F.count(F.lit(1)).over(user)})
    if not busy:
        return _carried(rows, left, right, o, False)
    few = F.col("__events") <= BUSY
    return _carried(rows.where(few), left, right, o, False).unionByName(_carried(rows.where(~few), left, right, o, True))


def _carried(rows: DataFrame, left: DataFrame, right: DataFrame, o: JoinOptions, spread: bool) -> DataFrame:
    """The result of `attribute` for its marked rows.

    Rows are put in one line by user, scope and content, and the nearest left row is carried along time, so a user's
    events are read in order instead of in pairs. Left rows are repeated only for the scopes that a right row of the
    same user looks in, and right rows go through that by their key only. spread: the line is cut into time buckets as
    long as a right row looks around, which are dealt out with scope and content; left rows go to the neighbouring ones
    too.
    """
    at, is_left = _reader(rows), F.col("__side") == 0
    scopes, kind, self_row = _scopes(rows, o, F.col("__scoped")), F.col("__x.kind"), F.col("__x.kind") == ""
    self_ = F.array(F.struct(F.lit("").alias("kind"), F.lit("").alias("id")))
    tried = F.when(is_left, scopes).when(F.col("__open"), F.concat(scopes, self_)).otherwise(self_)
    rows = rows.select("*", F.posexplode(tried).alias("__rank", "__x"))
    rows = rows.where(self_row | (~S.blank(F.col("__x.id")) & (~is_left | F.array_contains("__sought", kind))))
    content = F.array(F.lit(""))
    if o.use_contents:
        lefts = F.when(F.col("__bare"), F.concat(content, "__shared")).otherwise(F.col("__shared"))
        content = F.when(self_row, content).when(is_left, lefts).when(F.size("__shared") > 0, F.col("__shared")).otherwise(content)
    rows = rows.select(
        *USER, "ms", "__side", "__hit", "__open", "__l_ms", kind.alias("kind"), F.col("__x.id").alias("id"), F.explode(content).alias("content"), F.col("__rank").alias("rank"),
        F.when(is_left, F.col(o.key)).alias("left_key"), *[F.when(~is_left, at(c)).alias(f"__k{n}") for n, c in enumerate(o.right_key or ())],
        F.when(self_row, F.struct(*[at(c).alias(c) for c in right.columns])).alias("__row"),
    )

    # of left rows with one time the one with the smaller id comes last on the way to the right row
    ms, left_row = F.col("ms"), F.when(is_left, F.struct(F.col("ms").alias("left_ms"), "left_key"))
    key = [*_SORTED, "kind", "id", "content"]
    if spread:
        bucket = F.floor(F.col("ms") / max(1, o.max_time + o.max_out_of_order)).cast("bigint")
        near = F.array(*[bucket + k for k in ((0, 1) if not o.max_out_of_order else (-1, 0, 1))])
        key.append("bucket")
        rows = rows.withColumn("bucket", F.explode(F.when(is_left, near).otherwise(F.array(bucket)))).repartition(*key)
    upto = Window.partitionBy(*key).orderBy("ms", "__side", F.desc("left_key")).rowsBetween(Window.unboundedPreceding, 0)
    sides = {"back": F.last(left_row, ignorenulls=True).over(upto)}
    if o.max_out_of_order:
        after = Window.partitionBy(*key).orderBy(F.desc("ms"), F.desc("__side"), F.desc("left_key")).rowsBetween(Window.unboundedPreceding, 0)
        sides["ahead"] = F.last(left_row, ignorenulls=True).over(after)

    def placed(side: str) -> Column:
        l_ms, l_key = F.col(f"{side}.left_ms"), F.col(f"{side}.left_key")
        order = F.struct("rank", F.abs(ms - l_ms).alias("lag"), (-l_ms).alias("late"), l_key.alias("left_key"), "ms", l_ms.alias("left_ms"))
        return F.when((l_ms >= ms - o.max_time) & (l_ms <= ms + o.max_out_of_order), order)

    near = [placed(side) for side in sides]
    self_row = F.col("kind") == ""
    rows = rows.withColumns(sides).where(~is_left)
    rows = rows.withColumn("near", F.when(~self_row, F.least(*near) if len(near) > 1 else near[0])).where(self_row | F.col("near").isNotNull())

    # of right rows with one key the one that is nearest to its left row counts
    keys = [*USER, *[f"__k{n}" for n in range(len(o.right_key or ()))]]
    line = Window.partitionBy(*keys[::-1]).orderBy("ms")
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(*keys, "ms", "kind", "__hit", "__open", "__l_ms", "__row", F.min("near").over(every).alias("best"), F.max("__hit").over(every).alias("__hits"))
    pick = self_row & F.col("__open") & F.col("best").isNotNull() & (F.col("ms") == F.col("best.ms"))
    nth = F.sum(F.when(pick, 1).otherwise(0)).over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"__pick": F.coalesce(pick, F.lit(False)), "__nth": nth}).where(self_row)
    inferred = F.col("__pick") & (F.col("__nth") == 1)
    kind = F.when(F.col("__hit"), "explicit").when(inferred, "inferred")
    if o.how != "inner":
        unkeyed = F.greatest(F.lit(False), *[F.col(c).isNull() for c in keys])
        kind = kind.when(unkeyed | ~(F.col("__hits") | F.col("best").isNotNull()), "none")
    key_type = left.schema[o.key].dataType
    return rows.withColumn("__kind", kind).where("__kind IS NOT NULL").select(
        *[F.col(f"__row.{c}").cast(right.schema[c].dataType).alias(c) for c in right.columns],
        F.when(F.col("__kind") == "explicit", F.col(f"__row.{o.key}")).when(F.col("__kind") == "inferred", F.col("best.left_key")).otherwise("").cast(key_type).alias("left_key"),
        F.when(F.col("__kind") == "explicit", F.col("__l_ms")).when(F.col("__kind") == "inferred", F.col("best.left_ms")).alias("left_ms"),
        F.col("__kind").alias("kind"),
    )


def by_id(left: DataFrame, right: DataFrame, o: JoinOptions, ids: list[str]) -> DataFrame:
    """The explicit rows that `attribute` gives for an inner join, each with the named ids of its left event under
    __<id>. Right rows without the left's id are ignored; the others never fall back, so the two can be taken apart.

    Both sides are shuffled once, together, by user and id, and sorted once.
    """
    key, named = F.col(o.key), ~S.blank(F.col(o.key))
    more = [c for c in right.columns if c not in (*USER, "ms", o.key)]
    row = F.struct(*more) if more else F.lit(None).cast("string")
    rights = right.where(named).select(*USER, key, "ms", F.lit(1).alias("__side"), row.alias("__row"))
    found = F.struct(F.col("ms").alias("left_ms"), *ids).alias("__left")
    lefts = left.where(named).select(*USER, key, "ms", F.lit(0).alias("__side"), F.lit(None).cast(rights.schema["__row"].dataType).alias("__row"), found)
    rights = rights.withColumn("__left", F.lit(None).cast(lefts.schema["__left"].dataType))
    line = Window.partitionBy(o.key, *_SORTED).orderBy("__side", "ms", "__left")
    rows = lefts.unionByName(rights).withColumn("__left", F.first("__left").over(line))
    whole = F.col("__left").isNotNull() & F.col(USER[0]).isNotNull() & F.col(USER[1]).isNotNull()
    rows = rows.where((F.col("__side") == 1) & whole)
    if o.retention:
        lag = F.col("ms") - F.col("__left.left_ms")
        rows = rows.where((lag <= o.max_time * o.retention) & (lag >= -o.max_out_of_order))
    return rows.select(
        *[F.col(f"__row.{c}").alias(c) if c in more else F.col(c) for c in right.columns],
        key.cast(left.schema[o.key].dataType).alias("left_key"), F.col("__left.left_ms").alias("left_ms"), F.lit("explicit").alias("kind"), *[F.col(f"__left.{c}").alias(f"__{c}") for c in ids],
    )


def dropped(right: DataFrame, joined: DataFrame, keys: list[str]) -> DataFrame:
    """The right rows an inner attribution has left over."""
    rest = right.join(joined.select(*keys), keys[::-1], "left_anti")
    return rest.select(*keys, *[c for c in right.columns if c not in keys])


def mismatches(joined: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Error rows (the id columns, field, lhs, rhs) where both sides of a merged field are set (not blank; numbers not 0)
    and differ."""
    text = lambda c: (F.col(c) if joined.schema[c].dataType.simpleString() == "string" else F.nullif(F.col(c), F.lit(0))).cast("string")
    each = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("field"), text(a).alias("lhs"), text(b).alias("rhs"))
                for name, (a, b) in pairs.items()
            ]
        )
    )
    used = {c for pair in pairs.values() for c in pair}
    rows = joined.select(*[c for c in joined.columns if c not in used], each.alias("x")).select("*", "x.*").drop("x")
    return rows.where(~S.blank(F.col("lhs")) & ~S.blank(F.col("rhs")) & (F.col("lhs") != F.col("rhs")))


def split_cart(actions: DataFrame, cart_types: tuple[int, ...] = (3, 8)) -> DataFrame:
    """Purchases and checkouts with a cart: one row per different content of the base and the cart, their foreign ids
    cleared; other actions as they are. actions: content_id, cart array<string>, action_type, impression_id, …"""
    has = F.col("action_type").isin(*cart_types) & (F.size("cart") > 0)
    all_ = F.filter(F.array_distinct(F.array_union(F.array("content_id"), F.col("cart"))), lambda c: ~S.blank(c))
    out = actions.withColumn("__has", has).withColumn("content_id", F.explode(F.when(has, all_).otherwise(F.array("content_id"))))
    foreign = [c for c in ("impression_id", "insertion_id", "request_id", "view_id") if c in actions.columns]
    return out.withColumns({c: F.when(F.col("__has"), "").otherwise(F.col(c)) for c in foreign}).drop("__has", "cart")


ROOT = (*USER, "root_a", "root_b")


def _rooted(df: DataFrame) -> DataFrame:
    """df with what its root is found by: the insertion, else view and content."""
    by_insertion = ~S.blank(F.col("insertion_id"))
    return df.withColumn("root_a", F.when(by_insertion, F.col("insertion_id")).otherwise(F.col("view_id"))).withColumn(
        "root_b", F.when(by_insertion, F.lit("")).otherwise(F.col("content_id"))
    )


def _ranked(rooted: DataFrame, ttl: int) -> DataFrame:
    from trailmark.operators.dedupe import with_first

    grouped = with_first(rooted, list(ROOT), "ms", ["impression_id"], ttl)
    line = Window.partitionBy(*ROOT, "first_ms").orderBy("ms", "impression_id")
    return grouped.withColumn("__n", F.row_number().over(line))


def _redundant(ranked: DataFrame) -> DataFrame:
    return ranked.where("__n > 1").drop("__n", "first_ms", "root_a", "root_b")


def redundant(impressions: DataFrame, ttl: int) -> DataFrame:
    """Only the redundant impressions of `reduce_redundant`. An impression that is alone at its insertion (else view and
    content) can't be one, so only the others are ranked."""
    rooted = _rooted(impressions)
    met = rooted.withColumn("__met", F.count(F.lit(1)).over(Window.partitionBy(*ROOT[2:], *_SORTED))).where("__met > 1").drop("__met")
    return _redundant(_ranked(met, ttl))


def reduce_redundant(impressions: DataFrame, actions: DataFrame, ttl: int, cut=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, redundant impressions, actions re-pointed to their root).

    Impressions of one insertion (else of one view and content) within `ttl` of the first are redundant; a later one
    opens a new root. Actions take all ids and the content of the root in force at their time, else of the first root
    after it (they waited for it); without any root they stay as they are. cut(df, name) may write the ranked
    impressions, which all three are made of, and give back what it reads.
    """
    keys = list(ROOT)
    ranked = _ranked(_rooted(impressions), ttl)
    ranked = cut(ranked, "ranked") if cut else ranked
    roots = ranked.where("__n = 1").drop("__n", "first_ms")
    ids = ["impression_id", "insertion_id", "request_id", "view_id", "content_id"]
    marked = roots.select(*keys, "ms", F.lit(0).alias("side"), F.struct(*ids).alias("root"), F.lit(None).cast("string").alias("action_id"), F.lit(None).cast("struct<" + ",".join(f"{c}:string" for c in ids) + ">").alias("own"))
    acts = _rooted(actions).select(*keys, "ms", F.lit(1).alias("side"), F.lit(None).cast(marked.schema["root"].dataType).alias("root"), "action_id", F.struct(*ids).alias("own"))
    order = Window.partitionBy(*keys).orderBy("ms", "side", "action_id")
    back = F.last("root", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("root", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    placed = marked.unionByName(acts).withColumn("to", F.coalesce(back, ahead, F.col("own"))).where("side = 1")
    pointed = placed.select(*USER, "ms", "action_id", *[F.col(f"to.{c}").alias(c) for c in ids])
    return roots.drop("root_a", "root_b"), _redundant(ranked), pointed
