"""Schemas of the engine's tables. Nothing is inferred; ids are strings, money is decimal, blank is null."""

from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType


def _struct(**fields: str | DataType) -> StructType:
    out = StructType()
    for name, kind in fields.items():
        out.add(name, kind)
    return out


_SOURCE = _struct(path="string", sheet="string", ref="string", page="integer")
_ITEM = _struct(ordinal="integer", name="string", sha256="string", pages="integer", page_from="integer", page_to="integer")

SCHEMAS = {
    "material": _struct(run_id="string", case_id="string", path="string", name="string", ext="string", kind="string", length="long", sha256="string", ordinal="integer"),
    "cells": _struct(path="string", sheet="string", row="integer", col="integer", raw="string", cell_type="string", num="decimal(38,10)", ts="timestamp_ntz"),
    "pages": _struct(path="string", page_no="integer", rotation="integer", has_text="boolean", text="string"),
    "tokens": _struct(path="string", page_no="integer", token_no="integer", text="string", x0="double", y0="double", x1="double", y1="double", confidence="double"),
    "paragraphs": _struct(path="string", para_no="integer", text="string"),
    "fields": _struct(case_id="string", entity="string", ordinal="integer", field="string", value="string", source=_SOURCE, basis="string", status="string"),
    "answers": _struct(path="string", q="integer", choices=ArrayType(StringType()), status="string"),
    "batch": _struct(batch_id="string", person="string", kind="string", task_date="date", batch_no="integer", items=ArrayType(_ITEM)),
    "findings": _struct(run_id="string", stage="string", severity="string", entity="string", code="string", reason="string"),
    "memo": _struct(sha256="string", version="string", reading="string", n_rows="integer", page_no="integer", rotation="integer", has_text="boolean", text="string"),
    "ledger": _struct(run_id="string", pipeline="string", started_at="timestamp_ntz", state="string", params=MapType(StringType(), StringType())),
}
