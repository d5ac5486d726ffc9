"""Workbooks as a data source of their own: spark.read.format("folioflow_cells").load(folder).

Filters on path, sheet, row and col reach the reader. By path, files aren't opened; by sheet, a workbook's other sheets
are not read from the file, let alone unpacked; by row, reading a sheet stops behind the last row asked for. What is
pushed is decided there in full, so Spark doesn't test it again. Files are planned into partitions by their size.

Rows are those of office.read_cells without num and ts (with_numbers adds them). The folder must be one that Python
reaches on driver and executors alike (filesystem.py); where only Spark's readers reach it, office.read_cells is the
way. A file that can't be read gives no rows; office.unreadable reports it.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..filesystem import files_below, reached
from ..schemas import SCHEMAS
from ..shipping import ship
from . import office

FORMAT, PARAGRAPHS = "folioflow_cells", "folioflow_paragraphs"
CELLS = "path string, sheet string, row int, col int, raw string, cell_type string"
#: Bytes of files in a partition, unless the option bytes says otherwise.
PARTITION_BYTES = 32 << 20
BATCH_ROWS = 10_000


@dataclass
class Wanted:
    """What the pushed filters leave of a column: one of some values, and bounds."""

    among: set | None = None
    low: int | None = None
    high: int | None = None
    tests: list = field(default_factory=list)

    def narrow(self, f: ds.Filter) -> bool:
        """Take a filter in; False if it isn't one for here."""
        kind = type(f)
        if kind in (ds.EqualTo, ds.EqualNullSafe):
            return self._only({f.value})
        if kind is ds.In:
            return self._only(set(f.value))
        if kind is ds.IsNotNull:
            return True  # these columns are never null
        if kind in (ds.GreaterThan, ds.GreaterThanOrEqual) and isinstance(f.value, int):
            low = f.value + (kind is ds.GreaterThan)
            self.low = low if self.low is None else max(self.low, low)
            return True
        if kind in (ds.LessThan, ds.LessThanOrEqual) and isinstance(f.value, int):
            high = f.value - (kind is ds.LessThan)
            self.high = high if self.high is None else min(self.high, high)
            return True
        if kind in (ds.StringStartsWith, ds.StringEndsWith, ds.StringContains):
            self.tests.append((kind.__name__, f.value))
            return True
        return False

    def _only(self, values: set) -> bool:
        self.among = values if self.among is None else self.among & values
        return True

    def __contains__(self, value) -> bool:
        if (self.among is not None and value not in self.among) or (self.low is not None and value < self.low) or (self.high is not None and value > self.high):
            return False
        say = {"StringStartsWith": str.startswith, "StringEndsWith": str.endswith, "StringContains": str.__contains__}
        return all(say[kind](value, part) for kind, part in self.tests)

    def last(self) -> int | None:
        """The greatest number that can still be wanted."""
        ends = [x for x in (self.high, max(self.among, default=0) if self.among is not None else None) if x is not None]
        return min(ends) if ends else None


class Pushed(dict):
    """Wanted values of each column that the reader prunes by."""

    def __init__(self, *columns: str) -> None:
        super().__init__((c, Wanted()) for c in columns or ("path", "sheet", "row", "col"))

    def take(self, filters: Iterable[ds.Filter]) -> Iterator[ds.Filter]:
        """Those that are left to Spark."""
        for f in filters:
            at = getattr(f, "attribute", None)
            if not (at and len(at) == 1 and at[0] in self and self[at[0]].narrow(f)):
                yield f


def xlsx_cells(file, want: Pushed) -> Iterator[office.Cell]:
    """Cells of an open workbook that are wanted; of the file only the parts that they lie in are read."""
    with zipfile.ZipFile(file) as z:
        shared: list[str] | None = None
        target = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        last = want["row"].last()
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{office.SHEET}sheet"):
            if sheet.get("name") not in want["sheet"]:
                continue
            part = target[sheet.get(office.RELATION)]
            with z.open(part.lstrip("/") if part.startswith("/") else f"xl/{part}") as xml:
                body = None
                for event, e in ElementTree.iterparse(xml, ("start", "end")):
                    if event == "start":
                        if e.tag == f"{office.SHEET}sheetData":
                            body = e
                        elif e.tag == f"{office.SHEET}row" and last is not None and int(e.get("r") or 0) > last:
                            break  # rows ascend in a sheet
                    elif e.tag == f"{office.SHEET}c":
                        row, col = office.split_ref(e.get("r"))
                        kind, value = e.get("t", "n"), e.find(f"{office.SHEET}v")
                        if row not in want["row"] or col not in want["col"]:
                            continue
                        if kind == "inlineStr":
                            text = "".join(t.text or "" for t in e.iter(f"{office.SHEET}t"))
                        elif value is None or value.text is None:
                            continue
                        elif kind == "s":
                            if shared is None:
                                shared = ["".join(t.text or "" for t in si.iter(f"{office.SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{office.SHEET}si")]
                            text = shared[int(value.text)]
                        else:
                            text = value.text
                        yield sheet.get("name"), row, col, text, {"n": "number", "b": "boolean", "e": "error"}.get(kind, "text")
                    elif e.tag == f"{office.SHEET}row" and body is not None:
                        body.clear()  # what has been read is let go


def html_cells(file, want: Pushed) -> Iterator[office.Cell]:
    return (c for c in office.html_cells(file.read()) if c[0] in want["sheet"] and c[1] in want["row"] and c[2] in want["col"])


READERS = {"xlsx": xlsx_cells, "html": html_cells}


@dataclass
class Files(ds.InputPartition):
    paths: list[str]


class CellReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.recursive, self.bytes = str(options.get("recursive", "true")).lower() == "true", int(options.get("bytes", PARTITION_BYTES))
        self.want = Pushed()

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        return list(self.want.take(filters))

    def partitions(self) -> Sequence[Files]:
        out, held = [Files([])], 0
        for path, size in files_below(self.path, self.recursive):
            if fnmatch.fnmatch(path.rsplit("/", 1)[-1], self.glob) and path in self.want["path"]:
                if out[-1].paths and held + size > self.bytes:
                    out.append(Files([]))
                    held = 0
                out[-1].paths.append(path)
                held += size
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            system, inner, _ = reached(path)
            rows: list[office.Cell] = []
            try:
                with system.open_input_file(inner) as file:
                    head = file.read(4096)
                    kind = "xlsx" if head[:2] == b"PK" else office.sniffed(head)
                    if kind not in READERS:
                        continue
                    file.seek(0)
                    for cell in READERS[kind](io.BufferedReader(_Raw(file)) if kind == "xlsx" else file, self.want):
                        rows.append(cell)
                        if len(rows) == BATCH_ROWS:
                            yield _cells(path, rows)
                            rows = []
            except (*office.UNREADABLE, KeyError):
                pass  # a broken file keeps what was read before the break
            if rows:
                yield _cells(path, rows)


class ParagraphReader(CellReader):
    """Paragraphs of .docx files: path and para_no are pushed; unwanted files aren't opened."""

    def __init__(self, options: dict) -> None:
        super().__init__({"glob": "*.docx"} | options)
        self.want = Pushed("path", "para_no")

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            system, inner, _ = reached(path)
            try:
                with system.open_input_file(inner) as file:
                    rows = [(k, text) for k, text in enumerate(office.docx_paragraphs(file.read()), 1) if k in self.want["para_no"]]
            except (*office.UNREADABLE, KeyError):
                continue  # office.unreadable reports it
            columns = [pa.array([path] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "para_no", "text"])


class _Raw(io.RawIOBase):
    """An Arrow file as one of Python's, so that reading a part of it reads no more than a buffer beyond."""

    def __init__(self, file) -> None:
        self.file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        got = self.file.read(len(into))
        into[: len(got)] = got
        return len(got)

    def seek(self, offset: int, whence: int = 0) -> int:
        self.file.seek(offset, whence)
        return self.file.tell()

    def tell(self) -> int:
        return self.file.tell()


def _cells(path: str, rows: list[office.Cell]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), *columns], ["path", "sheet", "row", "col", "raw", "cell_type"])


class CellSource(ds.DataSource):
    """Options: path; glob (of file names, *), recursive (true), bytes (of files in a partition)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> CellReader:
        return CellReader(dict(self.options))


class ParagraphSource(ds.DataSource):
    """spark.read.format("folioflow_paragraphs"): path, para_no, text of the .docx files of a folder; options as for cells."""

    @classmethod
    def name(cls) -> str:
        return PARAGRAPHS

    def schema(self) -> str:
        return "path string, para_no int, text string"

    def reader(self, schema) -> ParagraphReader:
        return ParagraphReader(dict(self.options))


@udtf(returnType="part_no int, text string")
class SplitText:
    """split_text(text, separator): the parts of a text with their number from 1; a null text has none. An empty separator
    gives the whole text."""

    def eval(self, text: str, separator: str):
        if text is not None:
            yield from enumerate(text.split(separator) if separator else [text], 1)


def register(spark: SparkSession) -> None:
    """Make the formats, and split_text for SQL, known to this session, with filters handed to it (Spark leaves that off for Python sources)."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (CellSource, ParagraphSource):
        spark.dataSource.register(source)
    spark.udtf.register("split_text", SplitText)


def with_numbers(cells: DataFrame) -> DataFrame:
    """The columns of the table cells: num is the number of a numeric cell."""
    number = F.when(F.col("cell_type") == "number", F.expr("try_cast(raw as decimal(38,10))"))
    return cells.withColumns({"num": number, "ts": F.lit(None).cast("timestamp_ntz")}).select(*SCHEMAS["cells"].fieldNames())
