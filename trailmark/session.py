"""Session helpers: defaults for a local run and reading of input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "trailmark", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings every query assumes (UTC, adaptive execution)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
