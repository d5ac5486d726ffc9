"""Parts of .xlsx files: values, a fill for blanks that wait. sinks.committed delivers workbooks of any number of rows."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterable
from functools import lru_cache
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.text import column_letters
from ..shipping import map_arrow, packed

MOST_ROWS = 1_048_576
_SMALL = 1 << 20  # bytes of a sheet; together with under 1000 of them, what a ZIP needs no longer fields for
_letters = lru_cache(1024)(column_letters)
_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{sheets}</Types>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_STYLES = f'<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill><fill><patternFill patternType="solid"><fgColor rgb="FFFFFF00"/></patternFill></fill></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fillId="2" applyFill="1"/></cellXfs></styleSheet>'


def write_frame(z: zipfile.ZipFile, names: list[str], noted: list[int] = ()) -> None:
    """The parts of a workbook besides its sheets. noted: numbers of the sheets that have comments."""
    n = range(1, len(names) + 1)
    more = '<Default Extension="vml" ContentType="application/vnd.openxmlformats-officedocument.vmlDrawing"/>' if noted else ""
    more += "".join(f'<Override PartName="/xl/comments{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.comments+xml"/>' for i in noted)
    z.writestr("[Content_Types].xml", _TYPES.format(sheets=more + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in n)))
    z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
    z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="s{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + f'<Relationship Id="st" Type="{_REL}/styles" Target="styles.xml"/></Relationships>')
    z.writestr("xl/styles.xml", _STYLES)
    z.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>' + "".join(f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="s{i}"/>' for i, name in zip(n, names, strict=True)) + "</sheets></workbook>")


@lru_cache(64)
def _frame(names: tuple[str, ...]) -> tuple[bytes, bytes, int]:
    """What all workbooks with these sheets begin with: the ZIP's bytes, its directory's entries, and how many they are."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        write_frame(z, list(names))
        start, n = z.start_dir, len(z.namelist())
    data = out.getvalue()
    return data[:start], data[start:-22], n


def _with_sheets(names: tuple[str, ...], bodies: list[bytes]) -> bytes:
    """The ZIP of a workbook. The frame is packed once for all workbooks of these sheets, only the sheets are packed for each."""
    front, directory, n = _frame(names)
    out, entries, at = [front], [directory], len(front)
    for i, body in enumerate(bodies, 1):
        name, packer = b"xl/worksheets/sheet%d.xml" % i, zlib.compressobj(wbits=-15)
        data = packer.compress(body) + packer.flush()
        common = struct.pack("<5H3I2H", 20, 0, 8, 0, 33, zlib.crc32(body), len(data), len(body), len(name), 0)  # deflated, 1980-01-01
        out += [b"PK\x03\x04", common, name, data]
        entries += [b"PK\x01\x02\x14\x03", common, struct.pack("<3H2I", 0, 0, 0, 0o600 << 16, at), name]
        at += 30 + len(name) + len(data)
    entries = b"".join(entries)
    return b"".join([*out, entries, struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, n + len(bodies), n + len(bodies), len(entries), at, 0)])


def _sheet(rows: Iterable[Iterable], first_row: int, mark_blank: bool) -> bytes:
    body = []
    for r, row in enumerate(rows, first_row):
        cells = []
        for c, v in enumerate(row, 1):
            ref = f"{_letters(c)}{r}"
            if type(v) is str:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>')
            elif v is None:
                cells.append(f'<c r="{ref}" s="1"/>' if mark_blank else "")
            elif isinstance(v, (int, float)) and not isinstance(v, bool):
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
        body.append(f'<row r="{r}">{"".join(cells)}</row>')
    return f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(body)}</sheetData></worksheet>'.encode()


def workbook(sheets: dict[str, Iterable[Iterable]], first_row: int = 1, mark_blank: bool = True) -> bytes:
    """Bytes of a workbook; blank cells (None) are marked yellow if asked for."""
    bodies = [_sheet(rows, first_row, mark_blank) for rows in sheets.values()]
    if max(map(len, bodies), default=0) < _SMALL and len(sheets) < 1000:
        return _with_sheets(tuple(sheets), bodies)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        write_frame(z, list(sheets))
        for i, body in enumerate(bodies, 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", body)
    return out.getvalue()


def workbooks(rows: DataFrame, path: str, values: str, sheet: str = "Sheet1") -> DataFrame:
    """A workbook for each row, written on the executors: path, content. values: array of arrays of text, one person's sheet."""

    def run(batches):
        for batch in batches:
            made = ((name, workbook({sheet: table or []})) for name, table in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            yield from packed((([file], len(file[1])) for file in made), {"path": pa.string(), "content": pa.binary()})

    return map_arrow(rows.select(path, values), run, "path string, content binary")
