"""Tables written to, and read from, the folder that the whole cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Only where that is unset (local tests) a folder is made here."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.folioflow.stage.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="folioflow-stage-")
        spark.conf.set("spark.folioflow.stage.dir", found)
    return found.rstrip("/")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to all of the session's shuffle partitions. Spark puts small ones together by their compressed
    bytes, where what a task holds in its aggregates goes by rows: many times as much."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it again: it cuts the lineage, and outlives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete staged tables whose last reader has run. What was written from them stands in tables of its own."""
    for table in tables:
        if table is not None and (path := getattr(table, "staged_path", None)):
            spark = table.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def sweep(spark: SparkSession) -> None:
    """Have the files of past shuffles deleted: Spark keeps them until the driver's next garbage collection."""
    gc.collect()
    spark._jvm.System.gc()
