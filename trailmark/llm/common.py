"""Shared pieces: input tables, tables written to the shared folder, word splitting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a folder of our own only where none is set (tests on one machine)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = known.get() if known.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="trailmark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df, computed once and written to the shared folder; it outlives any executor and cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def row_key(docs: DataFrame) -> Column:
    """128 bits that tell the rows of docs apart by all their columns; only rows repeated as a whole share them."""
    whole = [F.coalesce("text", F.lit("\x00null")), F.to_json(F.struct(*[f"`{c}`" for c in docs.columns if c.lower() != "text"]))]
    return F.concat_ws(":", *[F.hex(F.xxhash64(F.lit(k), *whole)) for k in range(2)])


def one_of_each(docs: DataFrame, mark: Column, stay: DataFrame) -> DataFrame:
    """The rows of docs whose mark is in stay (column __mark), one for each mark: that with the least row key, so that
    a rerun gives the same. Minima and repeats are combined before the shuffle."""
    marked = docs.withColumns({"__mark": mark, "__key": row_key(docs)})
    least = marked.select("__mark", "__key").join(stay, "__mark", "left_semi").groupBy("__mark").agg(F.min("__key").alias("__key"))
    kept = marked.join(least, ["__mark", "__key"], "left_semi")
    return kept.dropDuplicates(["__mark", "__key"]).drop("__mark", "__key")


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than the six spaces; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
