"""New files as a stream: each is taken in once, by content; a file that arrives again under another name is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension, file_name

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """A streaming DataFrame of files: path, name, ext, length, modificationTime, sha256, content."""
    found = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return found.select("path", file_name(F.col("path")).alias("name"), extension(F.col("path")).alias("ext"), "length", "modificationTime", F.sha2("content", 256).alias("sha256"), "content")


def take_in(files: DataFrame, out: str, checkpoint: str, keep_days: int | None = None) -> None:
    """Write what is new to out (Parquet) and stop. keep_days bounds the state: a copy that comes later than that is taken as new."""
    if keep_days is None:
        own = files.dropDuplicates(["sha256"])
    else:
        own = files.withWatermark("modificationTime", f"{keep_days} days").dropDuplicatesWithinWatermark(["sha256"])
    own.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
