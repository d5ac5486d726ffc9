"""Pages of files by a reader; text recognition is a seam for a reader that lives outside the engine.

A seam takes a function on bytes and gives a DataFrame; results are kept by content hash, so a file is read once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SCHEMAS
from ..shipping import map_arrow
from .pdf import pdf_pages

PageReader = Callable[[bytes], list[tuple[int, str]]]  # content -> (rotation, text) of each page


def not_available(content: bytes) -> list[tuple[int, str]]:
    raise NotImplementedError("no reader for this format is installed; pass one")


def _pages(reader: PageReader, content: bytes) -> list[tuple[int, str]]:
    """A reader's pages; none if it fails on this file (unread files are reported as findings)."""
    try:
        return reader(content)
    except NotImplementedError:
        raise
    except Exception:  # noqa: BLE001  whatever a plug-in raises on one file doesn't stop the others
        return []


def read_pages(found: DataFrame, reader: PageReader = not_available) -> DataFrame:
    """The table pages of found files (path, content) by a reader that runs on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, k, r, bool(t), t) for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for k, (r, t) in enumerate(_pages(reader, c), 1)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], SCHEMAS["pages"].fieldNames())

    return map_arrow(found.select("path", "content"), run, SCHEMAS["pages"])


def not_yet_read(found: DataFrame, cache: DataFrame) -> DataFrame:
    """Files whose content hash is not in the cache."""
    own = found.withColumn("sha256", F.sha2("content", 256))
    return own.join(cache.select("sha256").distinct(), "sha256", "left_anti")


def read_text_pdfs(found: DataFrame) -> DataFrame:
    """The table pages of PDFs with a text layer. A scanned page comes with has_text false, for a recogniser."""
    return read_pages(found, pdf_pages)
