"""Landed observations as a stream: the optional continuous form of the batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBSERVATION = "observed_at timestamp, source_url string, status_code int, content_sha256 string, content_length bigint"


def observations(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Landed observation files (JSON lines) as a stream."""
    return spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def fresh(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each body of an address once: what repeats within the watermark goes."""
    return stream.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark(["source_url", "content_sha256"])


def hourly(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Observations and bytes by status in windows of an hour; late rows beyond the watermark are dropped."""
    w = stream.withWatermark("observed_at", delay).groupBy(F.window("observed_at", "1 hour"), "status_code")
    return w.agg(F.count("*").alias("n"), F.sum("content_length").alias("bytes")).select("window.start", "status_code", "n", "bytes")


def keep_latest(stream: DataFrame, table: str, checkpoint: str):
    """A query that keeps, of each address, the latest successful observation: every batch is reduced, joined with
    what is kept, and written as the table's next version; the newest version is the state. Older versions than the
    one a batch has read are deleted once it is written, so a batch looks at two or three folders only."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.where("status_code = 200")
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(path(table))] if fs.exists(path(table)) else []
        there = sorted(int(n[2:]) for n in names if n.startswith("v="))
        before = [v for v in there if v < number and fs.exists(path(f"{table}/v={v}/_SUCCESS"))]
        if before:
            new = new.unionByName(spark.read.schema(OBSERVATION).parquet(f"{table}/v={before[-1]}"))
        latest = new.groupBy("source_url").agg(F.max_by(F.struct(*[c for c in new.columns if c != "source_url"]), F.struct("observed_at", "content_sha256")).alias("x"))
        latest.select("source_url", "x.*").select(*new.columns).write.mode("overwrite").parquet(f"{table}/v={number}")
        for v in there:
            if before and v < before[-1]:
                fs.delete(path(f"{table}/v={v}"), True)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
