"""Merged print files and files split from a scan, written on the executors. One output file is made by one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from ..shipping import map_arrow, packed
from ..sources import pdf


def merged(files: DataFrame, batch: str, order: str, even: bool = False) -> DataFrame:
    """batch, content: the PDFs of each batch in order as one file. A batch is one person's print job, so it fits a task."""
    own = files.groupBy(F.col(batch).cast("string").alias(batch)).agg(F.array_sort(F.collect_list(F.struct(order, "content"))).alias("f"))
    own = own.select(batch, F.transform("f", lambda f: f["content"]).alias("f"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = ((b.column(0)[row].as_py(), pdf.merge(b.column(1)[row].as_py(), even)) for row in range(b.num_rows))
            yield from packed((([file], len(file[1])) for file in made), {batch: pa.string(), "content": pa.binary()})

    return map_arrow(own, run, f"`{batch}` string, content binary")


def split(scans: DataFrame, plan: DataFrame, batch: str) -> DataFrame:
    """batch, name, content: the parts of each scan. plan: batch, name, page_from, page_to as merge_plan gives it; a part beyond the scan's end gives no row."""
    parts = plan.filter("page_from <= page_to").groupBy(F.col(batch).cast("string").alias(batch)).agg(F.array_sort(F.collect_list(F.struct("page_from", "page_to", "name"))).alias("parts"))
    own = scans.select(F.col(batch).cast("string").alias(batch), "content").join(parts, batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content, want in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                for w in want:
                    try:
                        (part,) = pdf.split(content, [(w["page_from"], w["page_to"])])
                    except (IndexError, ValueError):
                        continue  # split_plan reports a scan that is too short
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([w["name"]], pa.string()), pa.array([part], pa.binary())], [batch, "name", "content"])

    return map_arrow(own, run, f"`{batch}` string, name string, content binary")


def text_files(rows: DataFrame, path: str, pages: str, keep: list[str] | None = None) -> DataFrame:
    """path, content: a plain PDF for each row; pages: array of texts. keep: more columns of rows that go along, so that
    files needn't be joined with the rows that they were made from."""
    keep = keep or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [pdf.text_pdf(p or [""]) for p in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array(made, pa.binary()), *b.columns[2:]], ["path", "content", *keep])

    own = rows.select(F.col(path).cast("string").alias("path"), pages, *keep)
    return map_arrow(own, run, StructType([StructField("path", StringType()), StructField("content", BinaryType()), *(own.schema[c] for c in keep)]))
