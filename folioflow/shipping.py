"""Python code on executors: the package travels with the application."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch that goes to a Python worker, where the session leaves Spark's default: whole texts are long, and a
#: batch is in memory on both sides.
BATCH_BYTES, _BATCH, _DEFAULT = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20
BATCH_ROWS = 8192
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of every executor, once for an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="folioflow-")) / f"{top.name}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent).as_posix())
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system: workers live on from task to task, and from one operator to the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)


def packed(files: Iterable[tuple[list[tuple], int]], kinds: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches of what many files gave, of about BATCH_ROWS rows: a batch for each small file costs more than its reading.
    files: (rows, bytes that they count for) of each; a batch ends where these reach BATCH_BYTES."""
    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), kinds.values(), strict=True)], list(kinds))

    held, weight = [], 0
    for rows, size in files:
        held += rows
        weight += size
        if held and (len(held) >= BATCH_ROWS or weight >= BATCH_BYTES):
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow, with this package at hand on the executors; a task gives its memory back when it ends."""
    ship(df.sparkSession)
    if df.sparkSession.conf.get(_BATCH) == f"{_DEFAULT}b":
        df.sparkSession.conf.set(_BATCH, BATCH_BYTES)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(tidy, schema)
