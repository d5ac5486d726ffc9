"""What a reader found in a file, kept by the file's content, so that recognition runs once for each content.

The memo is a folder of Parquet folders: each call adds one, compact() puts them together. A row is a page; a content
without pages has one row without a page number. Each row says how many its content has, so a content whose rows were
partly lost counts as not read and is read again. Where a content is there several times (two runs read it at once, or a
compaction was cut off before it cleaned up), the latest reading wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SCHEMAS
from ..shipping import map_arrow
from .seams import PageReader, _pages

MEMO = SCHEMAS["memo"]


def _folders(spark: SparkSession, memo: str) -> list[str]:
    at = spark._jvm.org.apache.hadoop.fs.Path(memo)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [s.getPath() for s in fs.listStatus(at) if s.isDirectory()]
    # a folder without the mark of a finished write is another run's, or a lost one's
    return sorted(p.toString() for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def entries(spark: SparkSession, memo: str, version: str | None = None) -> DataFrame:
    """The whole, latest reading of each content and version."""
    folders = _folders(spark, memo)
    if not folders:
        return spark.createDataFrame([], MEMO)
    own = spark.read.schema(MEMO).parquet(*folders)
    own = own if version is None else own.filter(F.col("version") == version)
    own = own.dropDuplicates(["sha256", "version", "reading", "page_no"])  # a compaction may have copied a reading
    keys = ["sha256", "version"]
    whole = own.groupBy(*keys, "reading").agg(F.count(F.lit(1)).alias("__n"), F.max("n_rows").alias("__want")).filter("__n = __want")
    last = whole.groupBy(*keys).agg(F.max("reading").alias("reading"))
    return own.join(last, [*keys, "reading"], "left_semi")


def _new_reading() -> str:
    return f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}"


def read_pages_once(found: DataFrame, reader: PageReader, memo: str, version: str = "1") -> DataFrame:
    """The table pages of found files (path, content): from the memo where it knows the content, else by the reader.

    version: of the reader; another one's readings don't count. Files of equal content are read once. What is read is
    in the memo before this returns, so a later failure doesn't cost it.
    """
    spark = found.sparkSession
    hashed = found.select("path", F.sha2("content", 256).alias("sha256"), "content")
    known = entries(spark, memo, version).select("sha256").distinct()
    new = hashed.join(known, "sha256", "left_anti").groupBy("sha256").agg(F.first("content").alias("content"))
    reading = _new_reading()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sha, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pages = [(k, r, bool(t), t) for k, (r, t) in enumerate(_pages(reader, content), 1)] or [(None, None, None, None)]
                n, kinds = len(pages), (pa.int32(), pa.int32(), pa.bool_(), pa.string())
                own = [pa.array([x] * n, kind) for x, kind in ((sha, pa.string()), (version, pa.string()), (reading, pa.string()), (n, pa.int32()))]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array([p[i] for p in pages], kind) for i, kind in enumerate(kinds))], MEMO.fieldNames())

    if not new.select("sha256").isEmpty():
        map_arrow(new, run, MEMO).write.parquet(f"{memo.rstrip('/')}/{reading}")
    pages = entries(spark, memo, version).filter("page_no is not null")
    return hashed.select("path", "sha256").join(pages, "sha256").select(*SCHEMAS["pages"].fieldNames())


def compact(spark: SparkSession, memo: str) -> int:
    """Put the memo's folders into one; how many there were. The old ones go only after the new one is whole."""
    folders = _folders(spark, memo)
    if len(folders) > 1:
        entries(spark, memo).write.parquet(f"{memo.rstrip('/')}/{_new_reading()}")
        for folder in folders:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(folders)
