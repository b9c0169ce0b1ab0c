"""Sinks: dated tables, CSV, JSON, message records, key-value commands, upserted lake tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions import scalars as S
from trailmark.operators.dedupe import latest_per_key


def table_path(root: str, *parts: str, label: str = "") -> str:
    """<root>/<label>/<parts…>, without empty parts."""
    return "/".join(p.strip("/") if k else p.rstrip("/") for k, p in enumerate((root, label, *parts)) if p)


def with_date_hour(df: DataFrame, ms: Column) -> DataFrame:
    """Adds dt and hour of the event-API time (UTC)."""
    ts = F.timestamp_millis(ms)
    return df.withColumns({"dt": F.date_format(ts, "yyyy-MM-dd"), "hour": F.date_format(ts, "HH")})


def write_dated(df: DataFrame, path: str, fmt: str = "parquet", codec: str = "snappy", mode: str = "append", hours: bool = True) -> None:
    """Files under dt=/hour=. Rows are dealt by partition first, so a task writes few files; a large hour is split by
    adaptive execution rather than kept in one task."""
    parts = ["dt", "hour"] if hours else ["dt"]
    df.hint("rebalance", *parts).write.mode(mode).partitionBy(*parts).option("compression", codec).format(fmt).save(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def overwrite_partitions(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replaces only the partitions that df has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", quote: str = '"', escape: str = "\\", null: str = "", array_sep: str = ";") -> None:
    """CSV with a header in each file; arrays of scalars are joined by array_sep."""
    flat = [
        F.array_join(F.col(n), array_sep).alias(n) if t.startswith("array") else F.col(n) for n, t in df.dtypes
    ]
    df.select(*flat).write.option("header", True).option("sep", sep).option("quote", quote).option("escape", escape).option("nullValue", null).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssXXX").json(path)


def metrics_document(df: DataFrame, source: str = "content-metrics") -> DataFrame:
    """(id, header, body) documents of cumulated metrics: the id is date, platform and content joined by '@'."""
    ident = F.concat_ws("@", F.date_format("window_start", "yyyy-MM-dd"), F.col("platform_id").cast("string"), "content_id")
    measures = [c for c in df.columns if c not in ("window_start", "window_end", "platform_id", "content_id")]
    time = F.date_format(F.col("window_end").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return df.select(
        ident.alias("id"),
        F.struct(F.lit(source).alias("source"), time.alias("eventDateTimestamp")).alias("header"),
        F.struct("platform_id", "content_id", *measures).alias("body"),
    )


def message_records(df: DataFrame, key: Column) -> DataFrame:
    """(key, value) with each row as JSON; Kafka or Kinesis writers take these as they are."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def user_messages(df: DataFrame, platform: str = "platform_id", user: str = "log_user_id") -> DataFrame:
    """(key bytes, value): keyed so that a user's records stay in order."""
    return df.select(S.user_key_bytes(F.col(platform), F.col(user)).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def apply_commands(commands: DataFrame, store: DataFrame | None = None) -> DataFrame:
    """The key-value store's content (key, field, value, ttl) after commands (op, key, field, value, ttl, seq).

    HSET sets, HDEL deletes, HINCRBY adds up on top of the last HSET. The time to live is the last one that isn't 0
    (0 leaves it, below 0 is for ever).
    """
    if store is not None:
        base = store.select(F.lit("HSET").alias("op"), "key", "field", "value", "ttl", F.lit(-1).cast("bigint").alias("seq"))
        commands = base.unionByName(commands)
    reset = F.max(F.when(F.col("op") != "HINCRBY", F.col("seq")))
    keyed = commands.groupBy("key", "field").agg(reset.alias("at")).withColumnsRenamed({"key": "k", "field": "f"})
    on = (F.col("key") == F.col("k")) & (F.col("field") == F.col("f"))
    rows = commands.join(keyed, on).where("at IS NULL OR seq >= at")
    grouped = rows.groupBy("key", "field").agg(
        F.sum(F.when(F.col("op") != "HDEL", F.col("value")).otherwise(0)).alias("value"),
        F.max_by("op", "seq").alias("last"),
        F.coalesce(F.max_by("ttl", F.when(F.col("ttl") != 0, F.col("seq"))), F.lit(0)).alias("ttl"),
    )
    return grouped.where("last <> 'HDEL'").drop("last")


def store_metadata(spark: SparkSession, families: dict[str, tuple[list[str], list[int]]]) -> DataFrame:
    """Commands sent before a run: for each key family the names of its key's parts and its feature ids, for ever."""
    rows = []
    for name, (parts, ids) in families.items():
        rows.append(("HSET", "row_format", name, ",".join(parts), -1))
        rows.append(("HSET", "feature_ids", name, ",".join(map(str, sorted(ids))), -1))
    return spark.createDataFrame(rows, "op string, key string, field string, value string, ttl bigint")


def prepare_store(send, metadata: DataFrame, wipe: bool = False) -> None:
    """Before a run: PING, FLUSHDB where the store is to be wiped, then the metadata (a row or two for each family).
    send takes an iterator of rows, as in `command_writer`."""
    spark = metadata.sparkSession
    first = [("PING",), ("FLUSHDB",)] if wipe else [("PING",)]
    send(iter(spark.createDataFrame(first, "op string").collect()))
    send(iter(metadata.collect()))


def command_writer(send):
    """For writeStream.foreachBatch: send(rows) gets each partition's commands in order."""

    def each(batch: DataFrame, _: int) -> None:
        batch.sortWithinPartitions("key", "seq").foreachPartition(send)

    return each


def upsert(new: DataFrame, old: DataFrame | None, keys: list[str], order: list[str]) -> DataFrame:
    """A lake table's rows after new ones came in: the last of each key in the order given."""
    rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
    return latest_per_key(rows, keys, order)


def between(df: DataFrame, ms: str, start: int, stop: int) -> DataFrame:
    """The output time gate, both ends inclusive."""
    return df.where(F.col(ms).between(start, stop))


def record_writer(put, key: str = "key", value: str = "value", most: int = 500):
    """For writeStream.foreachBatch: put([(key, value), …]) gets each partition's records in lists of at most `most`, as
    shard services take them; a row's key says which shard."""

    def partition(rows) -> None:
        held = []
        for row in rows:
            held.append((row[key], row[value]))
            if len(held) == most:
                put(held)
                held = []
        if held:
            put(held)

    def each(batch: DataFrame, _: int) -> None:
        batch.select(key, value).foreachPartition(partition)

    return each


def compact(spark: SparkSession, source: str, target: str, parts: dict[str, str], schema=None, fmt: str = "parquet") -> None:
    """Writes the partitions of a dated table that match `parts` (static values, such as a day) to another place in few
    large files; what lies there of other partitions stays."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(source)
    for name, value in parts.items():
        df = df.where(F.col(name) == value)
    by = [c for c in ("dt", "hour") if c in df.columns]
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(fmt).save(target)


def counter_debug(df: DataFrame, keys: list[str], ms: str, count: str, as_of_ms: int, width_ms: int) -> DataFrame:
    """Rows of a sliding counter's state, for looking at: per key the time of its last event, its counts by bucket, their
    sum, and the buckets that have left the window of width_ms by then. One row a key and bucket is added up first; a
    key's row holds as many buckets as the window and the data before it have."""
    hour = 3_600_000
    bucket = (F.floor(F.col(ms) / hour) * hour).cast("bigint")
    sums = df.where(F.col(ms) <= as_of_ms).groupBy(*keys, bucket.alias("b")).agg(F.sum(count).alias("n"), F.max(ms).alias("last"))
    inside = F.col("b") > as_of_ms - width_ms
    entries = F.sort_array(F.collect_list(F.when(inside, F.struct(F.col("b").cast("string").alias("key"), F.col("n").alias("value")))))
    return sums.groupBy(*keys).agg(
        F.lit(as_of_ms).cast("bigint").alias("watermark"), F.max("last").alias("event_api_timestamp"), F.map_from_entries(entries).alias("window_counts"),
        F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias("bucket_sum"), F.sort_array(F.collect_list(F.when(~inside, F.col("b")))).alias("removed"),
    )
