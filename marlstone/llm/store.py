"""Tables between steps, in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows go to Python in batches by number alone unless this is set; long texts would make batches of any size.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = 4 << 20


_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, the warehouse, which all executors share too. In a
    session of one process (master local, as in tests) it is a folder of this machine, deleted at the end."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not spark.sparkContext.master.split("[")[0] == "local":
        found = spark.conf.get("spark.sql.warehouse.dir")
    if not found:
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="marlstone-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        found = f"file://{_own[0]}"
    return found.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it again: lineage ends there, and the
    shuffle files that led to it are given back as soon as the write is done."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marlstone/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def delete(table: DataFrame) -> None:
    """Deletes the files of a table that materialize() gave and that nothing will read again."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``df.mapInArrow`` over batches of about BATCH bytes (one row at least), unless the session sets another size. A
    worker gives back what memory it can at the end of each task; it may stand idle beside another step's."""
    spark = df.sparkSession
    if not spark.conf.get(BATCH_BYTES, None):
        spark.conf.set(BATCH_BYTES, str(BATCH))

    def run(batches):
        from .blocks import give_back, large_apart

        large_apart()
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def row_is(docs: DataFrame, id_col: str, text_col: str, decided: DataFrame) -> Column:
    """The rows of ``docs`` that a row of ``decided`` (id, same) means: by id, null or not, and hash of the text."""
    return docs[id_col].cast("long").eqNullSafe(decided["id"]) & (F.xxhash64(docs[text_col].cast("string")) == decided["same"])
