"""Office files as DataFrames: binaryFile finds and ships them, the parsers below run on the executors.

A file that can't be read gives no rows but a finding, see unreadable().
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extension, file_name
from ..schemas import SCHEMAS
from ..shipping import map_arrow, packed

# Namespaces of the office formats.
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"

Cell = tuple[str, int, int, str, str]  # sheet, row, column, text, type


def split_ref(ref: str) -> tuple[int, int]:
    """A1 reference to (row, column)."""
    letters = re.match("[A-Z]+", ref)[0]
    column = 0
    for c in letters:
        column = column * 26 + ord(c) - 64
    return int(ref[len(letters) :]), column


class _Parts:
    """The parts of a small ZIP by name, as zipfile reads them. What its directory can't say in plain fields goes to zipfile itself."""

    def __init__(self, content: bytes):
        self.content, self.zip = content, None
        self.parts = _directory(content)
        if self.parts is None:
            self.zip = zipfile.ZipFile(io.BytesIO(content))
            self.parts = dict.fromkeys(self.zip.namelist())

    def __contains__(self, name: str) -> bool:
        return name in self.parts

    def read(self, name: str) -> bytes:
        if self.zip:
            return self.zip.read(name)
        crc, packed_size, size, at = self.parts[name]
        try:
            data = zlib.decompressobj(-15).decompress(self.content[at : at + packed_size], size)
        except zlib.error:
            data = b""
        if len(data) == size and zlib.crc32(data) == crc:
            return data
        self.zip = zipfile.ZipFile(io.BytesIO(self.content))  # damaged: zipfile says whether it still reads
        return self.zip.read(name)


_MOST_PLAIN = 64 << 20  # bytes of a part that is unpacked at once
_END_OF_DIRECTORY, _ENTRY, _LOCAL = struct.Struct("<4s4H2IH"), struct.Struct("<4s6H3I5H2I"), struct.Struct("<4s5H3I2H")


def _directory(content: bytes) -> dict[str, tuple[int, int, int, int]] | None:
    """(crc, packed size, size, place) of each part, where all are deflated under plain names and nothing is out of the ordinary."""
    if len(content) < 22:
        return None
    mark, disk, first, here, n, size, at, comment = _END_OF_DIRECTORY.unpack_from(content, len(content) - 22)
    if mark != b"PK\x05\x06" or disk or first or comment or here != n or at + size != len(content) - 22:
        return None
    parts, end, before, directory = {}, at + size, 0, at
    for _ in range(n):
        if at + 46 > end:
            return None
        mark, made, needs, flags, method, _, _, crc, packed_size, full, long, extra, note, disk, _, _, start = _ENTRY.unpack_from(content, at)
        name = content[at + 46 : at + 46 + long]
        if mark != b"PK\x01\x02" or flags or needs > 20 or method != 8 or extra or note or disk or len(name) != long or not name.isascii() or b"\0" in name or b"\\" in name or start + 30 + long + packed_size > directory:
            return None
        local = _LOCAL.unpack_from(content, start)
        if local[0] != b"PK\x03\x04" or local[2] or local[3] != 8 or local[9] != long or local[10] or content[start + 30 : start + 30 + long] != name:
            return None
        if (key := name.decode()) in parts or not 0 < full <= _MOST_PLAIN or start < before:
            return None
        before = start + 30 + long + packed_size
        parts[key] = (crc, packed_size, full, start + 30 + long)
        at += 46 + long
    return parts if at == end else None


@lru_cache(256)
def _targets(relations: bytes) -> dict[str, str]:
    return {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(relations)}


@lru_cache(256)
def _sheet_names(book: bytes) -> list[tuple[str, str]]:
    """(name, relation) of each sheet. These two parts are the same in file after file of one maker."""
    return [(sheet.get("name"), sheet.get(RELATION)) for sheet in ElementTree.fromstring(book).iter(f"{SHEET}sheet")]


_PLAIN_CELL = re.compile(r'<c r="([A-Z]+)([0-9]+)" t="inlineStr"><is><t xml:space="preserve">([ -%\'-;=?-~]*)</t></is></c>')
_PLAIN_SHEET = re.compile(
    rf'<worksheet xmlns="{SHEET[1:-1]}"><sheetData>(?:<row r="[0-9]+">(?:<c r="[A-Z]+[0-9]+" t="inlineStr"><is><t xml:space="preserve">[ -%\'-;=?-~]*+</t></is></c>)*+</row>)*+</sheetData></worksheet>'.encode()
)
_column = lru_cache(1024)(lambda letters: split_ref(letters + "1")[1])


def xlsx_cells(content: bytes, sheets: set[str] | None = None, parts: _Parts | None = None) -> Iterator[Cell]:
    """Cells that hold something; with sheets, only those sheets are parsed at all. A sheet of nothing but plain texts is read by
    an expression, which costs far less; any other goes to the parser as it is."""
    z = parts or _Parts(content)
    shared = []
    if "xl/sharedStrings.xml" in z:
        shared = ["".join(t.text or "" for t in si.iter(f"{SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
    target = _targets(z.read("xl/_rels/workbook.xml.rels"))
    for name, relation in _sheet_names(z.read("xl/workbook.xml")):
        if sheets is not None and name not in sheets:
            continue
        part = target[relation]
        body = z.read(part.lstrip("/") if part.startswith("/") else f"xl/{part}")
        if _PLAIN_SHEET.fullmatch(body):
            for letters, row, text in _PLAIN_CELL.findall(body.decode("ascii")):
                yield name, int(row), _column(letters), text, "text"
            continue
        for c in ElementTree.fromstring(body).iter(f"{SHEET}c"):
            kind, value = c.get("t", "n"), c.find(f"{SHEET}v")
            if kind == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(f"{SHEET}t"))
            elif value is None or value.text is None:
                continue
            else:
                text = shared[int(value.text)] if kind == "s" else value.text
            yield name, *split_ref(c.get("r")), text, {"n": "number", "b": "boolean", "e": "error"}.get(kind, "text")


def _span(attrs, name: str) -> int:
    said = dict(attrs).get(name) or "1"
    return max(1, int(said)) if said.strip().isdecimal() else 1


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[Cell] = []
        self.table, self.row, self.column, self.text = 0, 0, 0, None
        self.down: dict[int, int] = {}  # column -> rows below that a cell above reaches into

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.table, self.row, self.down = self.table + 1, 0, {}
        elif tag == "tr":
            self.row, self.column = self.row + 1, 0
            self.taken = {c for c, n in self.down.items() if n}
            self.down = {c: n - 1 for c, n in self.down.items() if n}
        elif tag in ("td", "th"):
            self.column, self.text = self.column + 1, ""
            while self.column in getattr(self, "taken", ()):
                self.column += 1
            self.span = _span(attrs, "colspan")
            if (rows := _span(attrs, "rowspan")) > 1:
                self.down |= {self.column + k: rows - 1 for k in range(self.span)}

    def handle_data(self, data: str) -> None:
        if self.text is not None:
            self.text += data

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.text is not None:
            if self.text.strip():
                self.cells.append((f"table{self.table}", self.row, self.column, self.text.strip(), "text"))
            self.column, self.text = self.column + self.span - 1, None


_TAG = re.compile(r'<(/?)([A-Za-z][A-Za-z0-9]*)((?:[ \t\n]+[A-Za-z-]+="[^"<>&]*")*)[ \t\n]*>')
_ATTRIBUTE = re.compile(r'([A-Za-z-]+)="([^"]*)"')
_NOT_PLAIN = {"script", "style", "xmp", "iframe", "noembed", "noframes", "noscript", "textarea", "title", "plaintext", "svg", "math"}


def _feed(parser: _Tables, text: str) -> None:
    """What parser.feed does. A page of nothing but plain tags and text is split at its tags, which costs far less; any other
    goes to the parser as it is."""
    parts = _TAG.split(text)
    names = [n.lower() for n in parts[2::4]]
    if any("<" in between for between in parts[::4]) or not _NOT_PLAIN.isdisjoint(names):
        parser.feed(text)
        return
    for end, name, attrs, after in zip(parts[1::4], names, parts[3::4], parts[4::4], strict=True):
        if end:
            parser.handle_endtag(name)
        else:
            parser.handle_starttag(name, [(k.lower(), v) for k, v in _ATTRIBUTE.findall(attrs)] if attrs else [])
        if after and parser.text is not None:
            parser.handle_data(unescape(after) if "&" in after else after)


def html_cells(content: bytes, sheets: set[str] | None = None) -> Iterator[Cell]:
    """Cells of the tables of an HTML page; the sheets are table1, table2 ..."""
    head = re.search(rb"charset=[\"']?([\w-]+)", content[:2000])
    parser = _Tables()
    _feed(parser, content.decode(head[1].decode() if head else "utf-8", "replace"))
    return (c for c in parser.cells if sheets is None or c[0] in sheets)


def docx_paragraphs(content: bytes) -> Iterator[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for p in ElementTree.fromstring(z.read("word/document.xml")).iter(f"{WORD}p"):
            yield "".join(t.text or "" for t in p.iter(f"{WORD}t"))


def sniffed(content: bytes, parts: _Parts | None = None) -> str:
    """What a file really is; the extension says little (an .xls may hold HTML)."""
    if content[:4] == b"PK\x03\x04":
        names = parts or _Parts(content)
        return "xlsx" if "xl/workbook.xml" in names else "docx" if "word/document.xml" in names else "zip"
    if content[:8] == b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1":
        return "biff"
    if content[:5] == b"%PDF-":
        return "pdf"
    return "html" if re.search(rb"<(html|table|!doctype)", content[:4096], re.I) else "other"


#: Kind -> cells of a file. Kinds without a parser here are seams: register one where its library is at hand.
CELL_READERS: dict[str, Callable[..., Iterator[Cell]]] = {"xlsx": xlsx_cells, "html": html_cells}


def files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower()).load(path)


#: What a broken, encrypted or oddly encoded file raises.
UNREADABLE = (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, LookupError, ValueError, TypeError, RuntimeError, EOFError, OSError)


def read_cells(found: DataFrame, sheets: list[str] | None = None, readers: dict | None = None) -> DataFrame:
    """The table cells of all workbooks in found (columns path, content); readers: more kinds, such as biff."""
    readers, only = CELL_READERS | (readers or {}), set(sheets) if sheets else None

    kinds = {"path": pa.string(), "sheet": pa.string(), "row": pa.int32(), "col": pa.int32(), "raw": pa.string(), "cell_type": pa.string()}

    def read(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple], int]]:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            try:
                parts = _Parts(content) if content[:4] == b"PK\x03\x04" else None
                if (kind := sniffed(content, parts)) in readers:
                    cells = xlsx_cells(content, only, parts) if readers[kind] is xlsx_cells else readers[kind](content, only)
                    yield [(path, *cell) for cell in cells], len(content)
            except UNREADABLE:
                continue  # unreadable() reports the file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from packed(read(batch), kinds)

    out = map_arrow(found.select("path", "content"), run, "path string, sheet string, row int, col int, raw string, cell_type string")
    number = F.when(F.col("cell_type") == "number", F.expr("try_cast(raw as decimal(38,10))"))
    out = out.withColumns({"num": number, "ts": F.lit(None).cast("timestamp_ntz")})
    return out.select(*SCHEMAS["cells"].fieldNames())


def read_paragraphs(found: DataFrame) -> DataFrame:
    """The table paragraphs of all .docx files in found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = list(docx_paragraphs(content))
                except UNREADABLE:
                    rows = []
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array(range(1, len(rows) + 1), pa.int32()), pa.array(rows, pa.string())], ["path", "para_no", "text"])

    return map_arrow(found.select("path", "content"), run, SCHEMAS["paragraphs"])


def unreadable(found: DataFrame, read: DataFrame, stage: str) -> DataFrame:
    """A finding for each file of which nothing was read."""
    lost = found.select("path").join(read.select("path").distinct(), "path", "left_anti")
    return lost.select(F.lit("").alias("run_id"), F.lit(stage).alias("stage"), F.lit("error").alias("severity"), F.col("path").alias("entity"), F.lit("unreadable").alias("code"), F.lit("no reader for it, or damaged, or empty").alias("reason"))


def material(found: DataFrame, run_id: str, case_level: int = 2) -> DataFrame:
    """The table material of found files; case_id is the folder case_level above the file."""
    name = file_name(F.col("path"))
    case = F.try_element_at(F.split("path", "/"), F.lit(-case_level))
    return found.select(
        F.lit(run_id).alias("run_id"), case.alias("case_id"), "path", name.alias("name"), extension(F.col("path")).alias("ext"),
        F.lit(None).cast("string").alias("kind"), "length", F.sha2("content", 256).alias("sha256"), F.lit(None).cast("int").alias("ordinal"),
    )
