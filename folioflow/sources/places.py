"""Where inputs are: dated names, search paths, batch folders."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import two_digit_suffix
from ..schemas import SCHEMAS


def dated(base: str, day: date, pattern: str) -> str:
    """A path with the day in it: {mmdd} and {yyyymmdd} in the pattern are filled in."""
    return f"{base.rstrip('/')}/" + pattern.format(mmdd=f"{day:%m%d}", yyyymmdd=f"{day:%Y%m%d}")


def first_existing(spark: SparkSession, folders: Iterable[str], name: str) -> str | None:
    """The first folder's file of that name, looked up through the file system that Spark uses."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        if path.getFileSystem(conf).exists(path):
            return path.toString()
    return None


def with_batch(material: DataFrame, level: int = 2) -> DataFrame:
    """material with batch_no: the two digits that end the name of the folder; null if there are none."""
    return material.withColumn("batch_no", two_digit_suffix(F.try_element_at(F.split("path", "/"), F.lit(-level))).cast("int"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Batch records, one JSON object a file."""
    return spark.read.schema(SCHEMAS["batch"]).option("multiLine", "true").option("dateFormat", "yyyy-MM-dd").json(path)


def batch_findings(batches: DataFrame, material: DataFrame, run_id: str = "") -> DataFrame:
    """Findings for a batch whose folder isn't what its record says.

    batches as in read_batches; material: batch_id, name, sha256. Codes: file_missing, file_extra, file_changed
    (the name is there with another content). A batch that a name or hash is blank in matches nothing.
    """
    items = batches.select("batch_id", F.explode("items").alias("i")).select("batch_id", F.col("i.name").alias("name"), F.col("i.sha256").alias("sha256"))
    own, there = items.groupBy("batch_id", "name").agg(F.collect_set("sha256").alias("want")), material.groupBy("batch_id", "name").agg(F.collect_set("sha256").alias("have"))
    both = own.join(there, ["batch_id", "name"], "full_outer")
    code = F.when(F.col("have").isNull(), "file_missing").when(F.col("want").isNull(), "file_extra").when(F.size(F.array_except("want", "have")) > 0, "file_changed")
    return both.withColumn("code", code).filter("code is not null").select(
        F.lit(run_id).alias("run_id"), F.lit("batch").alias("stage"), F.lit("error").alias("severity"),
        F.concat_ws("/", "batch_id", "name").alias("entity"), "code", F.lit("folder and record differ").alias("reason"),
    )
