"""Sources: dated directories, streams of files, message topics, and generated events."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def dated(spark: SparkSession, path: str, start: str, end: str, fmt: str = "parquet") -> DataFrame:
    """A table partitioned by dt, from start to end inclusive; other partitions are not listed for reading."""
    return spark.read.format(fmt).load(path).where(F.col("dt").between(start, end))


def until(df: DataFrame, ts: str, end: Column) -> DataFrame:
    """Rows before the cut-off."""
    return df.where(F.col(ts) < end)


def stream(spark: SparkSession, path: str, schema: StructType | str, event_time: str, delay: str | None = "1 second", files: int = 1_000) -> DataFrame:
    """A stream of parquet files with a watermark that trails event time (none where the flow sets its own)."""
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    return df.withWatermark(event_time, delay) if delay else df


def topic(group: str, name: str, label: str = "", dataset: str = "") -> str:
    """<group>.<label.dataset>.<name>, without parts that are empty."""
    middle = ".".join(x for x in (label, dataset) if x)
    return ".".join(x for x in (group, middle, name) if x)


def messages(spark: SparkSession, servers: str, name: str, start: str = "earliest") -> DataFrame:
    """A stream of a topic's (key, value, timestamp); needs the kafka source on the class path."""
    offsets = {"startingOffsets": start} if start in ("earliest", "latest") else {"startingTimestamp": start}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .options(**offsets)
        .load()
        .select("key", "value", "timestamp")
    )


def event_stream(df: DataFrame, schema: StructType | str, ms: Column, delay: str = "1 second") -> DataFrame:
    """Records from a topic's JSON values, with their event time as ts and a watermark; a value that can't be read fails
    the query with the value (in base64) in its message."""
    x = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    failed = F.raise_error(F.concat(F.lit("unreadable message: "), F.base64(F.col("value").cast("binary"))))
    broken = F.col("value").isNotNull() & F.coalesce(F.try_parse_json(F.col("value").cast("string")).isNull(), F.lit(True))
    rows = df.select(F.when(broken, failed.cast(x_type(schema))).otherwise(x).alias("x")).select("x.*")
    return rows.withColumn("ts", F.timestamp_millis(ms)).withWatermark("ts", delay)


def x_type(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


#: Spark types of Avro's.
AVRO_TYPES = {"string": "string", "bytes": "binary", "int": "int", "long": "bigint", "boolean": "boolean", "float": "float", "double": "double"}


def _avro_reader(fields: list) -> Callable[[bytes], dict]:
    """A reader of a record's binary form; fields are of AVRO_TYPES, or unions of one of them with null."""

    def number(b: bytes, at: int) -> tuple[int, int]:
        n = shift = 0
        while True:
            n |= (b[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if b[at - 1] < 128:
                return (n >> 1) ^ -(n & 1), at

    def value(kind, b: bytes, at: int):
        if isinstance(kind, list):
            n, at = number(b, at)
            return value(kind[n], b, at)
        if kind == "null":
            return None, at
        if kind in ("int", "long"):
            return number(b, at)
        if kind == "boolean":
            return b[at] == 1, at + 1
        if kind in ("float", "double"):
            code, size = ("<f", 4) if kind == "float" else ("<d", 8)
            return struct.unpack_from(code, b, at)[0], at + size
        n, at = number(b, at)
        raw = bytes(b[at : at + n])
        if n < 0 or len(raw) < n:
            raise ValueError("message ends within a value")
        return (raw.decode() if kind == "string" else raw), at + n

    def read(b: bytes) -> dict:
        out, at = {}, 0
        for name, kind in fields:
            out[name], at = value(kind, b, at)
        if at != len(b):
            raise ValueError("message goes on after its record")
        return out

    return read


def avro_records(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """df with the fields of an Avro record (its schema as JSON; flat) in place of its binary column, also on a stream.
    A null value gives nulls; one that can't be read fails the query with the value (in base64)."""
    fields = [(f["name"], f["type"]) for f in json.loads(schema)["fields"]]
    plain = lambda kind: next(k for k in kind if k != "null") if isinstance(kind, list) else kind
    ddl = ", ".join(f"`{name}` {AVRO_TYPES[plain(kind)]}" for name, kind in fields)

    @F.pandas_udf(ddl)
    def records(values: pd.Series) -> pd.DataFrame:
        import base64

        read = _avro_reader(fields)
        rows = []
        for v in values:
            try:
                rows.append({} if v is None else read(v))
            except (IndexError, ValueError, struct.error) as bad:
                raise ValueError("unreadable message: " + base64.b64encode(v).decode()) from bad
        return pd.DataFrame(rows, columns=[n for n, _ in fields], dtype=object)

    return df.withColumn("__x", records(F.col(value))).select(*[c for c in df.columns if c != value], "__x.*")


@dataclass(frozen=True)
class FunnelOptions:
    """Rates of the generated funnel, in percent of the step before, and ids left out, in percent."""

    users: int = 100
    insertions_per_request: int = 5
    impressed: int = 70
    navigated: int = 30
    purchased: int = 20
    missing_impression_id: int = 0
    redundant: int = 0
    start_ms: int = 1_600_000_000_000


def _chance(salt: str, percent: int, *on: Column) -> Column:
    """True for about so many percent of ids, the same ids each time (by md5, so other engines can follow)."""
    digest = F.md5(F.concat_ws(":", F.lit(salt), *[c.cast("string") for c in on]).cast("binary"))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint") % 100 < percent


def generated_funnel(spark: SparkSession, requests: int, o: FunnelOptions | None = None) -> DataFrame:
    """(platform_id, log_user_id, ms, kind, request_id, insertion_id, impression_id, action_id, content_id) rows of a
    deterministic view → request → impression → action funnel; each row depends only on its own number."""
    o = o or FunnelOptions()
    base = spark.range(requests * o.insertions_per_request).select(
        F.col("id"),
        F.floor(F.col("id") / o.insertions_per_request).cast("bigint").alias("r"),
    )
    base = base.select(
        F.lit(1).cast("bigint").alias("platform_id"),
        F.concat(F.lit("u"), (F.col("r") % o.users).cast("string")).alias("log_user_id"),
        (F.lit(o.start_ms) + F.col("r") * 1000 + F.col("id") % o.insertions_per_request).alias("ms"),
        "id",
        F.concat(F.lit("r"), F.col("r").cast("string")).alias("request_id"),
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("insertion_id"),
        F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("content_id"),
        _chance("impression", o.impressed, F.col("id")).alias("imp"),
    ).withColumns(
        {
            "nav": F.col("imp") & _chance("navigate", o.navigated, F.col("id")),
            "buy": F.col("imp") & _chance("purchase", o.purchased, F.col("id")),
            "twice": F.col("imp") & _chance("redundant", o.redundant, F.col("id")),
            "lost": _chance("missing", o.missing_impression_id, F.col("id")),
        }
    )
    number = F.col("id").cast("string")
    event = lambda flag, kind, after, imp, act: F.when(
        flag, F.struct(F.lit(kind).alias("kind"), F.lit(after).alias("after"), imp.alias("impression_id"), act.alias("action_id"))
    )
    imp_id, blank = F.concat(F.lit("m"), number), F.lit("")
    shown = F.when(F.col("lost"), blank).otherwise(imp_id)
    kinds = F.array(
        event(F.lit(True), "insertion", 0, blank, blank),
        event(F.col("imp"), "impression", 100, imp_id, blank),
        event(F.col("twice"), "impression", 150, F.concat(imp_id, F.lit("b")), blank),
        event(F.col("nav"), "navigate", 200, shown, F.concat(F.lit("n"), number)),
        event(F.col("buy"), "purchase", 300, shown, F.concat(F.lit("p"), number)),
    )
    rows = base.select("*", F.explode(F.array_compact(kinds)).alias("x"))
    return rows.select(
        "platform_id", "log_user_id", (F.col("ms") + F.col("x.after")).alias("ms"), "x.kind", "request_id", "insertion_id",
        "x.impression_id", "x.action_id", "content_id",
    )
