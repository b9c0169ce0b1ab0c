"""Shapes of records between the steps of the join job: narrow events, unions, joined events and their required fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import scalars as S

#: Fields of a joined event that its common ids and its user repeat.
COMMON_FIELDS = ("platform_id", "user_info", "client_info")
ID_FIELDS = ("view_id", "request_id", "insertion_id", "impression_id", "session_id")


def _user_key(base: str = "") -> list[Column]:
    ms = F.coalesce(F.nullif(F.col(f"{base}timing.event_api_timestamp"), F.lit(0)), F.col(f"{base}timing.log_timestamp"))
    return [F.col("platform_id"), F.col(f"{base}user_info.log_user_id").alias("log_user_id"), ms.alias("ms")]


def tiny_view(views: DataFrame) -> DataFrame:
    """Views narrowed to what joins read: user key, time, id, content."""
    return views.select(*_user_key(), "view_id", F.coalesce("content_id", F.lit("")).alias("content_id"))


def tiny_insertions(logs: DataFrame) -> DataFrame:
    """One narrow row per response insertion of a delivery log that has a content."""
    rows = logs.select(*_user_key("request."), F.col("request.view_id").alias("view_id"), F.col("request.request_id").alias("request_id"), F.explode("response.insertion").alias("i"))
    out = rows.select("platform_id", "log_user_id", "ms", *[F.coalesce(c, F.lit("")).alias(c) for c in ("view_id", "request_id")], "i.insertion_id", "i.content_id")
    return out.where(~S.blank(F.col("content_id")))


def tiny_impression(impressions: DataFrame) -> DataFrame:
    ids = ["impression_id", "insertion_id", "request_id", "view_id", "content_id"]
    return impressions.select(*_user_key(), *[F.coalesce(c, F.lit("")).alias(c) for c in ids])


def tiny_action(actions: DataFrame) -> DataFrame:
    """Narrow actions; of a cart only the contents are kept, which `split_cart` makes rows of."""
    ids = ["action_id", "impression_id", "insertion_id", "request_id", "view_id", "content_id"]
    cart = F.transform(F.coalesce("cart", F.expr("array()").cast(actions.schema["cart"].dataType)), lambda c: c["content_id"])
    return actions.select(*_user_key(), *[F.coalesce(c, F.lit("")).alias(c) for c in ids], "action_type", cart.alias("cart"))


def _without(record: Column, names: list[str], drop: tuple[str, ...]) -> Column:
    return F.when(record.isNotNull(), F.struct(*[record[n].alias(n) for n in names if n not in drop]))


def cleared(df: DataFrame, record: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """df with a nested record without the fields that the joined event has once for all of its records."""
    names = df.schema[record].dataType.names
    return df.withColumn(record, _without(F.col(record), names, COMMON_FIELDS + extra))


def joined_event(df: DataFrame, records: list[str], key: dict[str, str] | None = None) -> DataFrame:
    """A joined event of side-by-side records (structs, null where absent): `ids` has for each id the value of the first
    record, in order, that is not blank; `user_info` and `timing` are those of the last record that has them; the
    records lose the fields that are now common, ids that are their own (key: record to id) excepted."""
    key = key or {}
    have = {r: df.schema[r].dataType.names for r in records}

    def first_of(name: str, zero) -> Column:
        found = [F.when(F.col(r)[name] != F.lit(zero), F.col(r)[name]) for r in records if name in have[r]]
        return F.coalesce(*found, F.lit(zero)).alias(name)

    def last_of(name: str) -> Column:
        return F.coalesce(*[F.col(r)[name] for r in reversed(records) if name in have[r]]).alias(name)

    seen = [i for i in ID_FIELDS if any(i in have[r] for r in records)]
    ids = F.struct(first_of("platform_id", 0), *[first_of(i, "") for i in seen]).alias("ids")
    out = df.select(ids, last_of("user_info"), last_of("timing"), *[c for c in df.columns if c not in ("ids", "user_info", "timing")])
    for r in records:
        out = cleared(out, r, tuple(i for i in ID_FIELDS if i != key.get(r)))
    return out


def union_events(parts: dict[str, DataFrame]) -> DataFrame:
    """One tagged union of several kinds of records: `kind`, and a struct column for each kind, null in the rows of the
    others. One pass per part; nothing is shuffled."""
    tagged = [df.select(F.lit(kind).alias("kind"), F.struct(*df.columns).alias(kind)) for kind, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def required_fields(joined: DataFrame) -> DataFrame:
    """Joined events narrowed to what counters read, before the user is looked up. An action keeps its type and content,
    but neither cart nor single cart content, so counters add 1 for it."""
    have = {f.name: f.dataType for f in joined.schema.fields}
    narrow = {
        "request": ("search_query", "user_agent"),
        "response_insertion": ("insertion_id", "content_id", "position"),
        "impression": ("content_id",),
        "action": ("action_type", "custom_action_type", "content_id"),
    }
    cols = [F.col(c) for c in ("ids", "timing", "user_info") if c in have]
    for record, names in narrow.items():
        if record in have:
            kept = [n for n in have[record].names if n in names]
            cols.append(F.when(F.col(record).isNotNull(), F.struct(*[F.col(f"{record}.{n}").alias(n) for n in kept])).alias(record))
    return joined.select(*cols)
