"""From log batches to typed tables: splitting, defaults of the batch, fixes, privacy, side tables, schema changes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from trailmark import schemas
from trailmark.functions import scalars as S


def parse_batches(df: DataFrame, value: str = "value", mode: str = "FAILFAST") -> DataFrame:
    """Log batches from a column of JSON; a value that can't be read fails the query (or is null, PERMISSIVE)."""
    return df.select(F.from_json(F.col(value).cast("string"), schemas.LOG_REQUEST, {"mode": mode}).alias("b")).select("b.*")


def _pushed(e: Column, record: str) -> dict[str, Column]:
    """The common fields of a record with the batch's as defaults. The user id goes only to users."""
    text = lambda inner, outer: S.merged(inner, outer, "")
    number = lambda inner, outer: S.merged(inner, outer, 0)
    own = F.coalesce(e["user_info"]["user_id"], F.lit(""))
    user_id = text(own, F.col("user_info.user_id")) if record == "user" else own
    return {
        "platform_id": number(e["platform_id"], F.col("platform_id")),
        "user_info": F.struct(
            user_id.alias("user_id"),
            F.lower(text(e["user_info"]["log_user_id"], F.col("user_info.log_user_id"))).alias("log_user_id"),
            F.coalesce(e["user_info"]["is_internal_user"], F.col("user_info.is_internal_user"), F.lit(False)).alias("is_internal_user"),
            F.coalesce(e["user_info"]["ignore_usage"], F.col("user_info.ignore_usage"), F.lit(False)).alias("ignore_usage"),
        ),
        "timing": F.struct(
            *[number(e["timing"][f], F.col(f"timing.{f}")).alias(f) for f in ("client_log_timestamp", "event_api_timestamp", "log_timestamp")]
        ),
        "client_info": F.struct(*[text(e["client_info"][f], F.col(f"client_info.{f}")).alias(f) for f in ("client_type", "traffic_type")]),
    }


def split(batches: DataFrame, record: str) -> DataFrame:
    """The records of one type, one row each, with the batch's fields as defaults (log user ids in lower case)."""
    e = F.col("e")
    rows = batches.select("platform_id", "user_info", "timing", "client_info", F.explode(record).alias("e"))
    if record != "delivery_log":
        common = _pushed(e, record)
        rest = [f for f in batches.schema[record].dataType.elementType.names if f not in common]
        return rows.select(*[c.alias(k) for k, c in common.items()], *[e[f].alias(f) for f in rest])
    platform = S.merged(e["platform_id"], F.col("platform_id"), 0)
    request = e["request"]
    for name, value in _pushed(request, record).items():
        request = request.withField(name, value)
    # the request has its delivery log's platform, whatever it says itself
    return rows.select(
        platform.alias("platform_id"), request.withField("platform_id", platform).alias("request"),
        e["response"].alias("response"), e["execution"].alias("execution"),
    )


def split_all(batches: DataFrame) -> dict[str, DataFrame]:
    return {record: split(batches, record) for record in schemas.RECORDS}


def set_log_timestamp(df: DataFrame, event_time: Column) -> DataFrame:
    return df.withColumn("timing", F.col("timing").withField("log_timestamp", S.floor_millis(event_time, 1)))


def clear_user_id(df: DataFrame) -> DataFrame:
    """Without user ids: at the top and in every nested record that has user_info, arrays of records included."""

    def strip(c: Column, kind: DataType) -> Column:
        if "user_info" not in kind.simpleString():
            return c
        if isinstance(kind, ArrayType):
            return F.transform(c, lambda x: strip(x, kind.elementType))
        for f in kind.fields:
            if f.name == "user_info":
                c = c.withField("user_info", c["user_info"].withField("user_id", F.lit("")))
            elif "user_info" in f.dataType.simpleString():
                c = c.withField(f.name, strip(c[f.name], f.dataType))
        return c

    return df.select(
        *[
            F.col(f.name).withField("user_id", F.lit("")).alias(f.name) if f.name == "user_info" else strip(F.col(f.name), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


#: Matrix headers that have a column of their own.
MATRIX_FIELDS = {"contentId": ("content_id", "string"), "retrievalRank": ("retrieval_rank", "bigint"), "retrievalScore": ("retrieval_score", "double")}


def matrix_insertions(headers: Column, matrix: Column, properties: Column) -> Column:
    """Insertions from a header row, value rows and the rows' properties (JSON, by row). A row and the headers are
    matched as far as both go."""

    def one(row: Column, index: Column) -> Column:
        n = F.least(F.size(headers), F.size(row))
        cells = F.map_from_arrays(F.slice(headers, F.lit(1), n), F.slice(row, F.lit(1), n))
        return F.struct(
            F.lit("").alias("insertion_id"),
            F.coalesce(F.try_element_at(cells, F.lit("contentId")), F.lit("")).alias("content_id"),
            index.cast("bigint").alias("position"),
            F.try_element_at(cells, F.lit("retrievalRank")).cast("bigint").alias("retrieval_rank"),
            F.try_element_at(cells, F.lit("retrievalScore")).cast("double").alias("retrieval_score"),
            F.get(properties, index).alias("properties"),
        )

    return F.transform(matrix, one)


@F.pandas_udf(ArrayType(StringType()))
def _nested_rows(headers: pd.Series, matrix: pd.Series) -> pd.Series:
    """The properties of each row of a matrix whose headers go down levels."""

    def one(names, rows):
        out = []
        for cells in rows:
            top: dict = {}
            for name, cell in zip(names, cells, strict=False):
                if name in MATRIX_FIELDS:
                    continue
                *path, leaf = name.rstrip(".").split(".")
                at = top
                for part in path:
                    if not isinstance(at.get(part), dict):
                        at[part] = {}
                    at = at[part]
                at[leaf] = cell
            out.append(json.dumps(top, separators=(",", ":"), ensure_ascii=False))
        return out

    return pd.Series([None if names is None or rows is None else one(names, rows) for names, rows in zip(headers, matrix, strict=True)])


def _flat_rows(headers: Column, matrix: Column) -> Column:
    """The same where no header has a dot, without leaving the JVM."""

    def one(row: Column) -> Column:
        n = F.least(F.size(headers), F.size(row))
        cells = F.map_from_arrays(F.slice(headers, F.lit(1), n), F.slice(row, F.lit(1), n))
        return F.to_json(F.map_filter(cells, lambda k, v: ~k.isin(list(MATRIX_FIELDS))))

    return F.transform(matrix, one)


def restructure(logs: DataFrame) -> DataFrame:
    """Delivery logs with their insertion matrix turned into request insertions; the matrix goes. Headers other than
    contentId, retrievalRank and retrievalScore are properties (a JSON object); each dot in one goes a level down, and
    only matrices with such headers are handed to Python."""
    r = F.col("request")
    none = F.array().cast("array<array<string>>")
    has = F.size(F.coalesce(r["insertion_matrix"], none)) > 0
    dotted = has & F.exists(r["insertion_matrix_headers"], lambda h: h.contains("."))
    nested = _nested_rows(F.when(dotted, r["insertion_matrix_headers"]), F.when(dotted, r["insertion_matrix"]))
    rows = logs.withColumn("__nested", nested)
    properties = F.when(dotted, F.col("__nested")).otherwise(_flat_rows(r["insertion_matrix_headers"], r["insertion_matrix"]))
    rows = rows.withColumn("__properties", F.when(has, properties))
    made = matrix_insertions(r["insertion_matrix_headers"], r["insertion_matrix"], F.col("__properties"))
    request = r.withField("insertion", F.when(has, made).otherwise(r["insertion"])).withField("insertion_matrix", F.lit(None).cast("array<array<string>>"))
    rows = rows.withColumn("request", request.withField("insertion_matrix_headers", F.lit(None).cast("array<string>")))
    return rows.drop("__nested", "__properties")


def fix_response(logs: DataFrame) -> DataFrame:
    """Response insertions without an id get request, position and content joined by '-'.

    SDK logs that have response insertions only hold the request's in them: those become the request's insertions,
    without a position, and the response keeps id, content and position.
    """
    new = F.transform(
        F.col("response.insertion"),
        lambda i: i.withField(
            "insertion_id",
            F.when(
                S.blank(i["insertion_id"]),
                F.concat_ws("-", F.col("request.request_id"), i["position"].cast("string"), i["content_id"]),
            ).otherwise(i["insertion_id"]),
        ),
    )
    fixed = logs.withColumn("response", F.col("response").withField("insertion", new))
    n = lambda side: F.coalesce(F.size(F.col(f"{side}.insertion")), F.lit(0))
    merged = F.coalesce((F.col("execution.execution_server") == "SDK") & (n("request") <= 0) & (n("response") > 0), F.lit(False))
    kind = logs.schema["response"].dataType["insertion"].dataType.elementType
    given = F.transform("response.insertion", lambda i: i.withField("position", F.lit(0).cast("bigint")))
    blank = {"string": F.lit(""), "bigint": F.lit(0), "double": F.lit(0.0)}
    bare = F.transform(
        "response.insertion",
        lambda i: F.struct(
            *[
                (i[f.name] if f.name in ("insertion_id", "content_id", "position") else blank[f.dataType.simpleString()].cast(f.dataType)).alias(f.name)
                for f in kind.fields
            ]
        ),
    )
    return fixed.withColumns(
        {
            "request": F.col("request").withField("insertion", F.when(merged, given).otherwise(F.col("request.insertion"))),
            "response": F.col("response").withField("insertion", F.when(merged, bare).otherwise(F.col("response.insertion"))),
        }
    )


def log_user_users(batches: DataFrame) -> DataFrame:
    """(platform_id, log_user_id, user_id, event_api_timestamp) of the batch and of every record of any type whose own
    user has both ids; platform and time are the batch's where the record has none. One scan of the batches."""
    top = F.struct(F.lit(0).cast("bigint").alias("platform_id"), F.col("user_info").alias("user_info"), F.lit(0).cast("bigint").alias("ms"))

    def of(record: str) -> Column:
        if record == "delivery_log":
            return F.transform(
                record,
                lambda e: F.struct(
                    S.merged(e["platform_id"], e["request"]["platform_id"], 0).alias("platform_id"),
                    e["request"]["user_info"].alias("user_info"),
                    e["request"]["timing"]["event_api_timestamp"].alias("ms"),
                ),
            )
        return F.transform(
            record, lambda e: F.struct(e["platform_id"].alias("platform_id"), e["user_info"].alias("user_info"), e["timing"]["event_api_timestamp"].alias("ms"))
        )

    empty = F.array().cast(f"array<struct<platform_id:bigint,user_info:{schemas.USER_INFO.replace(' ', '').lower()},ms:bigint>>")
    every = F.concat(F.array(top), *[F.coalesce(of(r), empty) for r in schemas.RECORDS if r in batches.columns])
    rows = batches.select(F.col("platform_id").alias("p"), F.col("timing.event_api_timestamp").alias("t"), F.explode(every).alias("e"))
    out = rows.select(
        S.merged(F.col("e.platform_id"), F.col("p"), 0).alias("platform_id"),
        F.coalesce("e.user_info.log_user_id", F.lit("")).alias("log_user_id"),
        F.coalesce("e.user_info.user_id", F.lit("")).alias("user_id"),
        S.merged(F.col("e.ms"), F.col("t"), 0).alias("event_api_timestamp"),
    )
    return out.where("log_user_id <> '' AND user_id <> ''")


def delivery_ids(logs: DataFrame) -> DataFrame:
    return logs.select("platform_id", F.col("request.request_id").alias("request_id"), F.col("request.view_id").alias("view_id"), F.col("request.client_request_id").alias("client_request_id"), F.col("request.user_info.log_user_id").alias("log_user_id"))


def insertion_ids(logs: DataFrame, side: str) -> DataFrame:
    """One row per insertion of the request or the response."""
    return logs.select("platform_id", F.col("request.request_id").alias("request_id"), F.explode(f"{side}.insertion").alias("i")).select(
        "platform_id", "request_id", "i.insertion_id", "i.content_id", "i.position"
    )


def other_contents(properties: Column, names: list[str]) -> Column:
    """Map of the named properties to their values as strings; nested and missing ones are left out."""
    values = F.array(*[F.struct(F.lit(n).alias("k"), F.get_json_object(properties, f"$.{n}").alias("v")) for n in names])
    good = F.filter(values, lambda x: x["v"].isNotNull() & ~x["v"].rlike(r"^\s*[\[{]"))
    return F.map_from_entries(good)


def aligned(df: DataFrame, target: StructType, defaults: dict[str, object] | None = None) -> DataFrame:
    """df in another schema: columns matched by name and cast, new ones with a default (or null), others left out."""
    defaults = defaults or {}
    cols = []
    for f in target.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def lake_row(df: DataFrame, keys: list[str], parts: dict[str, Column]) -> DataFrame:
    """A table row: nested key fields first, under their last name, then partitions, then all else."""
    picked = [F.col(k).alias(k.split(".")[-1]) for k in keys]
    taken = {k.split(".")[-1] for k in keys} | set(parts)
    return df.select(*picked, *[c.alias(n) for n, c in parts.items()], *[c for c in df.columns if c not in taken])
