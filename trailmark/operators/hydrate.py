"""Putting the details back: narrow attributed rows joined with views, delivery logs, impressions and actions."""

from __future__ import annotations

import time

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions import scalars as S
from trailmark.operators.attribution import USER, other_ids


def bundle_insertions(logs: DataFrame) -> DataFrame:
    """(platform_id, request_id, response insertion, request insertion, execution insertion): the response's
    insertions, with the request's first of the same content, and the execution's of the same id, else content."""
    one = lambda items, key, value: F.get(F.filter(items, lambda x: (x[key] == value) & ~S.blank(value)), F.lit(0))
    rows = logs.select("platform_id", F.col("request.request_id").alias("request_id"), F.col("request.insertion").alias("rq"), F.col("execution.insertion").alias("ex"), F.explode("response.insertion").alias("response_insertion"))
    r = F.col("response_insertion")
    return rows.select(
        "platform_id",
        "request_id",
        "response_insertion",
        one(F.col("rq"), "content_id", r["content_id"]).alias("request_insertion"),
        F.coalesce(one(F.col("ex"), "insertion_id", r["insertion_id"]), one(F.col("ex"), "content_id", r["content_id"])).alias("execution_insertion"),
    )


def impression_details(tiny: DataFrame, views: DataFrame, deliveries: DataFrame, impressions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(joined impressions, dropped rows): the view may be missing, delivery and impression may not.

    tiny: user key, impression_id, request_id, view_id. The details have one column for the record and its id.
    """
    full = (
        tiny.join(views, [*USER, "view_id"], "left")
        .join(deliveries, [*USER, "request_id"], "left")
        .join(impressions, [*USER, "impression_id"], "left")
    )
    whole = F.col("delivery").isNotNull() & F.col("impression").isNotNull()
    return full.where(whole), full.where(~whole).select(*tiny.columns)


def single_cart_content(cart: Column, content_id: Column, others: Column) -> Column:
    """The first cart item with the content id, else with the first other id that has one; a quantity of 0 becomes 1."""
    match = lambda test: F.get(F.filter(cart, test), F.lit(0))
    of_other = F.transform(others, lambda other: match(lambda c: c["content_id"] == other))
    item = F.coalesce(match(lambda c: c["content_id"] == content_id), F.get(F.filter(of_other, lambda c: c.isNotNull()), F.lit(0)))
    return F.when(item.isNotNull(), item.withField("quantity", F.when(item["quantity"] == 0, F.lit(1).cast("bigint")).otherwise(item["quantity"])))


def action_details(tiny: DataFrame, joined_impressions: DataFrame, actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(joined actions, dropped rows): both details are required. tiny: user key, action_id, impression_id, content_id,
    and other_content_ids (an array or a map) where events have other contents, which the cart is searched for next."""
    full = tiny.join(joined_impressions, [*USER, "impression_id"], "left").join(actions, [*USER, "action_id"], "left")
    whole = F.col("joined_impression").isNotNull() & F.col("action").isNotNull()
    done = full.where(whole).withColumn(
        "single_cart_content", single_cart_content(F.col("action.cart"), F.col("content_id"), other_ids(tiny))
    )
    return done, full.where(~whole).select(*tiny.columns)


def with_content(df: DataFrame, dimension: DataFrame, content: str, names: list[str]) -> DataFrame:
    """df with a content's other ids from the dimension under those that were logged (a map), which win."""
    found = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("string") for n in names]))
    side = dimension.select(F.col("content_id").alias(content), found.alias("__found"))
    none = F.create_map().cast("map<string,string>")
    logged = F.coalesce("other_content_ids", none)
    kept = F.map_filter(F.coalesce("__found", none), lambda k, v: ~F.map_contains_key(logged, k) & ~S.blank(v))
    return df.join(side, content, "left").withColumn("other_content_ids", F.map_concat(kept, logged)).drop("__found")


def looked_up(df: DataFrame, content: str, fetch, names: list[str], batch: int = 100, tries: int = 3, wait: float = 0.1) -> DataFrame:
    """A dimension (content_id and the named other ids, for `with_content`) from a service instead of a table.

    fetch(list of content ids) gives {content id: {name: other id}}. Each different content is asked for once, in lists
    of at most `batch`; an error is tried again after `wait` seconds, then twice that, and so on. What can't be had
    after so many tries has no other ids, as the logged ones stand without them.
    """

    def ask(ids: list[str]) -> dict:
        for n in range(tries):
            try:
                return fetch(ids)
            except Exception:  # noqa: BLE001
                if n + 1 < tries:
                    time.sleep(wait * 2**n)
        return {}

    def run(frames):
        for frame in frames:
            ids = frame["content_id"].tolist()
            for k in range(0, len(ids), batch):
                part = ids[k : k + batch]
                got = ask(part)
                yield pd.DataFrame({"content_id": part} | {n: [got.get(i, {}).get(n) for i in part] for n in names})

    contents = df.select(F.col(content).alias("content_id")).where(~S.blank(F.col("content_id"))).distinct()
    return contents.mapInPandas(run, "content_id string, " + ", ".join(f"`{n}` string" for n in names))


def without_lookup(df: DataFrame) -> DataFrame:
    """In place of a lookup where there is no service: other ids are those that were logged."""
    none = F.create_map().cast("map<string,string>")
    return df.withColumn("other_content_ids", F.coalesce("other_content_ids", none) if "other_content_ids" in df.columns else none)
