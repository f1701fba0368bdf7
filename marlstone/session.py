"""The Spark session the engine expects, and how tables of the driver's folders are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC time and adaptive execution; sizes are left to the cluster unless given."""
    builder = SparkSession.builder.appName("marlstone").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
