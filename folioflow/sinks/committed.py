"""Files for people, written by tasks and delivered all or not at all.

df.write.format("folioflow_files").save(folder)        name, content: a file for each row
df.write.format("folioflow_zips").save(folder)         archive, name, content: one ZIP for each archive
df.write.format("folioflow_workbooks").save(folder)    workbook, sheet_no, sheet, row, cells: one .xlsx for each workbook

A task streams its files into a folder of its own attempt; rows pass through, none of them is held and none goes through
the driver. The driver's commit only moves the files of the attempts that Spark counts, then writes a manifest (names,
sizes, SHA-256). A folder without manifest is no delivery. A task that fails, is run twice or is lost leaves nothing
that counts; an abort removes what was staged; a second delivery into a folder is refused. A file is one task's work,
so files go through whole: zips() and workbooks() deal the rows by file and sort them.
"""

from __future__ import annotations

import hashlib
import json
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from ..filesystem import reached
from ..functions.text import column_letters
from ..shipping import ship
from . import workbook as xlsx

MANIFEST = "manifest.json"
FILES, ZIPS, WORKBOOKS = "folioflow_files", "folioflow_zips", "folioflow_workbooks"
CELL = "struct<text:string,number:double,note:string>"
#: Bytes of a sheet's notes kept in memory while its rows are written.
NOTES_HELD = 1 << 20


@dataclass
class Written(ds.WriterCommitMessage):
    folder: str
    files: list[tuple[str, int, str]]  # name, size, sha256


class _Counted:
    """A stream that counts and hashes what passes."""

    def __init__(self, stream) -> None:
        self.stream, self.size, self.hash = stream, 0, hashlib.sha256()

    def write(self, data) -> int:
        self.stream.write(data)
        self.hash.update(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()

    def tell(self) -> int:
        return self.size

    def seekable(self) -> bool:
        return False


class _Writer(ds.DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path, self.run = path.rstrip("/"), uuid.uuid4().hex

    @property
    def staging(self) -> str:
        return f"{self.path}/_staging-{self.run}"

    def files(self, batches: Iterator[pa.RecordBatch], target) -> None:
        """Write the files of a task's rows; target(name) opens one after the other."""
        raise NotImplementedError

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, inner, _ = reached(f"{self.staging}/{uuid.uuid4().hex}")
        system.create_dir(inner, recursive=True)
        done: list[tuple[str, int, str]] = []

        class target:
            def __init__(self, name: str) -> None:
                if name == MANIFEST or re.search(r"(^|/)(\.{0,2}(/|$)|_)", name):
                    raise ValueError(f"not a name for a file: {name!r}")
                if "/" in name:
                    system.create_dir(f"{inner}/{name.rsplit('/', 1)[0]}", recursive=True)
                self.name, self.raw = name, system.open_output_stream(f"{inner}/{name}", compression=None)
                self.out = _Counted(self.raw)

            def __enter__(self) -> _Counted:
                return self.out

            def __exit__(self, failed, *_) -> None:
                self.raw.close()
                if not failed:
                    done.append((self.name, self.out.size, self.out.hash.hexdigest()))

        self.files(iterator, target)
        return Written(inner, done)

    def commit(self, messages: list) -> None:
        system, inner, _ = reached(self.path)
        moved: list[str] = []
        try:
            if system.get_file_info(f"{inner}/{MANIFEST}").type != fs.FileType.NotFound:
                raise FileExistsError(f"{self.path} holds a delivery")
            names = [name for m in messages if m for name, _, _ in m.files]
            if len(names) != len(set(names)):
                raise ValueError(f"names of files occur twice: {sorted({n for n in names if names.count(n) > 1})[:5]}")
            for m in filter(None, messages):
                for name, _, _ in m.files:
                    if "/" in name:
                        system.create_dir(f"{inner}/{name.rsplit('/', 1)[0]}", recursive=True)
                    system.move(f"{m.folder}/{name}", f"{inner}/{name}")
                    moved.append(name)
            about = sorted((name, size, sha) for m in messages if m for name, size, sha in m.files)
            said = json.dumps({"run": self.run, "files": [{"name": n, "size": s, "sha256": h} for n, s, h in about]}, ensure_ascii=False)
            with system.open_output_stream(f"{inner}/_{self.run}.json", compression=None) as out:
                out.write(said.encode())
            system.move(f"{inner}/_{self.run}.json", f"{inner}/{MANIFEST}")  # from here on it is a delivery
        except Exception:
            for name in moved:
                system.delete_file(f"{inner}/{name}")
            raise
        finally:
            self.abort(messages)

    def abort(self, messages: list) -> None:
        system, inner, _ = reached(self.staging)
        if system.get_file_info(inner).type != fs.FileType.NotFound:
            system.delete_dir(inner)


class FilesWriter(_Writer):
    def files(self, batches, target) -> None:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with target(name) as out:
                    out.write(content or b"")


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[str, Iterator[dict]]]:
    """(value of key, its rows) for rows that come sorted by key; the rows have to be read before the next."""
    rows = (row for batch in batches for row in batch.to_pylist())
    ahead = next(rows, None)
    while ahead is not None:
        name = ahead[key]

        def own() -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and ahead[key] == name:
                row, ahead = ahead, next(rows, None)
                yield row

        yield name, own()


class ZipsWriter(_Writer):
    def files(self, batches, target) -> None:
        for name, rows in _runs(batches, "archive"):
            with target(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                for row in rows:
                    z.writestr(zipfile.ZipInfo(row["name"]), row["content"] or b"", zipfile.ZIP_DEFLATED)


class WorkbooksWriter(_Writer):
    def files(self, batches, target) -> None:
        for name, rows in _runs(batches, "workbook"):
            with target(name) as out:
                z = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                _write_workbook(z, rows)
                z.close()  # not where a row is wrong: its sheet is still open then


def _write_workbook(z: zipfile.ZipFile, rows: Iterator[dict]) -> None:
    """Sheets in the order that their rows come in; a cell without text and number is marked yellow, notes become comments."""
    sheets: list[tuple[str, bool]] = []
    last: dict | None = None
    part = notes = None
    n_notes = 0

    def close() -> None:
        nonlocal part, notes
        part.write(b"</sheetData>" + (b'<legacyDrawing r:id="v1"/>' if n_notes else b"") + b"</worksheet>")
        part.close()
        if n_notes:
            _write_notes(z, len(sheets), notes)
        notes.close()
        sheets[-1] = (sheets[-1][0], n_notes > 0)

    for row in rows:
        if last is None or row["sheet_no"] != last["sheet_no"]:
            if last is not None:
                close()
            sheets.append((row["sheet"], False))
            part = z.open(f"xl/worksheets/sheet{len(sheets)}.xml", "w", force_zip64=True)
            part.write(f'<worksheet xmlns="{xlsx._MAIN}" xmlns:r="{xlsx._REL}"><sheetData>'.encode())
            notes, n_notes = tempfile.SpooledTemporaryFile(NOTES_HELD), 0
        elif row["row"] <= last["row"]:
            raise ValueError(f"row {row['row']} of sheet {row['sheet']} comes twice or out of order")
        if row["row"] > xlsx.MOST_ROWS:
            raise ValueError(f"sheet {row['sheet']} has more rows than a sheet holds")
        cells = []
        for c, cell in enumerate(row["cells"] or [], 1):
            ref = f"{column_letters(c)}{row['row']}"
            cell = cell or {"text": None, "number": None, "note": None}
            if cell["number"] is not None:
                cells.append(f'<c r="{ref}"><v>{cell["number"]!r}</v></c>')
            elif cell["text"] is not None:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(cell["text"])}</t></is></c>')
            else:
                cells.append(f'<c r="{ref}" s="1"/>')
            if cell["note"] is not None:
                notes.write((json.dumps([ref, row["row"], c, cell["note"]]) + "\n").encode())
                n_notes += 1
        part.write(f'<row r="{row["row"]}">{"".join(cells)}</row>'.encode())
        last = row
    close()
    xlsx.write_frame(z, [name for name, _ in sheets], [k for k, (_, has) in enumerate(sheets, 1) if has])


def _write_notes(z: zipfile.ZipFile, sheet: int, notes) -> None:
    """The parts for a sheet's comments: their texts, and the boxes that they are shown in."""
    notes.seek(0)
    with z.open(f"xl/comments{sheet}.xml", "w") as out:
        out.write(f'<comments xmlns="{xlsx._MAIN}"><authors><author>folioflow</author></authors><commentList>'.encode())
        for line in notes:
            ref, _, _, note = json.loads(line)
            out.write(f'<comment ref="{ref}" authorId="0"><text><t xml:space="preserve">{escape(note)}</t></text></comment>'.encode())
        out.write(b"</commentList></comments>")
    notes.seek(0)
    with z.open(f"xl/drawings/notes{sheet}.vml", "w") as out:
        out.write(b'<xml xmlns:v="urn:schemas-microsoft-com:vml" xmlns:o="urn:schemas-microsoft-com:office:office" xmlns:x="urn:schemas-microsoft-com:office:excel"><v:shapetype id="note" coordsize="21600,21600" o:spt="202" path="m,l,21600r21600,l21600,xe"/>')
        for k, line in enumerate(notes, 1):
            _, row, col, _ = json.loads(line)
            out.write(f'<v:shape id="note{k}" type="#note" style="visibility:hidden"><x:ClientData ObjectType="Note"><x:Row>{row - 1}</x:Row><x:Column>{col - 1}</x:Column></x:ClientData></v:shape>'.encode())
        out.write(b"</xml>")
    z.writestr(f"xl/worksheets/_rels/sheet{sheet}.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="v1" Type="{xlsx._REL}/vmlDrawing" Target="../drawings/notes{sheet}.vml"/><Relationship Id="c1" Type="{xlsx._REL}/comments" Target="../comments{sheet}.xml"/></Relationships>')


class _Sink(ds.DataSource):
    kind: type[_Writer]

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("a delivery isn't overwritten: choose another folder")
        return self.kind(self.options["path"])


class FilesSink(_Sink):
    kind = FilesWriter

    @classmethod
    def name(cls) -> str:
        return FILES


class ZipsSink(_Sink):
    kind = ZipsWriter

    @classmethod
    def name(cls) -> str:
        return ZIPS


class WorkbooksSink(_Sink):
    kind = WorkbooksWriter

    @classmethod
    def name(cls) -> str:
        return WORKBOOKS


def register(spark: SparkSession) -> None:
    """Make the three formats known to this session."""
    ship(spark)
    for sink in (FilesSink, ZipsSink, WorkbooksSink):
        spark.dataSource.register(sink)


def files(rows: DataFrame, folder: str) -> None:
    """Deliver name, content as files."""
    register(rows.sparkSession)
    rows.select("name", "content").write.format(FILES).mode("append").save(folder)


def zips(rows: DataFrame, folder: str) -> None:
    """Deliver archive, name, content as one ZIP for each archive, its names in order."""
    register(rows.sparkSession)
    rows.select("archive", "name", "content").repartition("archive").sortWithinPartitions("archive", "name").write.format(ZIPS).mode("append").save(folder)


def workbooks(rows: DataFrame, folder: str) -> None:
    """Deliver workbook, sheet_no, sheet, row, cells as workbooks. cells: array of struct<text, number, note>; a cell
    with neither text nor number is marked as blank, a note becomes its comment. A row number twice is an error."""
    register(rows.sparkSession)
    own = rows.select("workbook", F.col("sheet_no").cast("int").alias("sheet_no"), "sheet", F.col("row").cast("int").alias("row"), F.col("cells").cast(f"array<{CELL}>").alias("cells"))
    own.repartition("workbook").sortWithinPartitions("workbook", "sheet_no", "row").write.format(WORKBOOKS).mode("append").save(folder)


def cell(value, note=None):
    """A cell of a text or number column."""
    value = F.col(value) if isinstance(value, str) else value
    return F.struct(value.cast("string").alias("text"), F.lit(None).cast("double").alias("number"), (F.lit(None) if note is None else note).cast("string").alias("note"))


def number_cell(value, note=None):
    value = F.col(value) if isinstance(value, str) else value
    return F.struct(F.lit(None).cast("string").alias("text"), value.cast("double").alias("number"), (F.lit(None) if note is None else note).cast("string").alias("note"))


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """name, size, sha256 of the files of a delivery, from its manifest; none where nothing was committed."""
    system, inner, _ = reached(folder.rstrip("/"))
    if system.get_file_info(f"{inner}/{MANIFEST}").type == fs.FileType.NotFound:
        return spark.createDataFrame([], "name string, size long, sha256 string")
    own = spark.read.schema("files array<struct<name:string,size:long,sha256:string>>").option("multiLine", "true").json(f"{folder.rstrip('/')}/{MANIFEST}")
    return own.select(F.explode("files").alias("f")).select("f.*")
