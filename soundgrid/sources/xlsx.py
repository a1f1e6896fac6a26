"""Survey spreadsheets: sheet rows from .xlsx files, read by Spark's `binaryFile` and unpacked with the standard library."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from soundgrid.plans.metadata import FIELD_LABELS, SHEETS, VALUE_LABEL
from soundgrid.ship import ship

ROWS = "path string, sheet string, position int, requirement string, field string, value string"
_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


# fixed values: built-in number formats that show a date or a time
_DATES = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _date_styles(styles) -> set[int]:
    """Cell styles that show their number as a date."""
    own = {int(f.get("numFmtId")) for f in styles.iter(f"{_M}numFmt") if re.search("[dmyhs]", re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode") or ""), re.I)}
    cells = styles.find(f"{_M}cellXfs")
    return {k for k, x in enumerate(cells if cells is not None else []) if int(x.get("numFmtId") or 0) in own | _DATES}


def date_text(serial: str, from_1904: bool = False) -> str:
    """A date cell's number of days as written text; days before March 1900 count a day that never was."""
    try:
        days = float(serial)
    except ValueError:
        return serial
    start = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31) if days < 60 else dt.datetime(1899, 12, 30)
    made = start + dt.timedelta(seconds=round(days * 86400))
    return made.isoformat(sep=" ")


def sheet_cells(data: bytes) -> dict[str, dict[int, dict[str, str]]]:
    """sheet -> row number -> column letters -> text."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        tree = lambda name: ElementTree.fromstring(z.read(name))
        shared = ["".join(t.text or "" for t in si.iter(f"{_M}t")) for si in tree("xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in z.namelist() else []
        files = {r.get("Id"): "xl/" + r.get("Target").lstrip("/").removeprefix("xl/") for r in tree("xl/_rels/workbook.xml.rels")}
        dates = _date_styles(tree("xl/styles.xml")) if "xl/styles.xml" in z.namelist() else set()
        from_1904 = any(x.get("date1904") in ("1", "true") for x in tree("xl/workbook.xml").iter(f"{_M}workbookPr"))
        out = {}
        for s in tree("xl/workbook.xml").iter(f"{_M}sheet"):
            cells: dict[int, dict[str, str]] = {}
            for c in tree(files[s.get(f"{_R}id")]).iter(f"{_M}c"):
                v, kind = c.find(f"{_M}v"), c.get("t")
                text = "".join(t.text or "" for t in c.iter(f"{_M}t")) if kind == "inlineStr" else None if v is None else shared[int(v.text)] if kind == "s" else v.text
                if text and kind in (None, "n") and int(c.get("s") or 0) in dates:
                    text = date_text(text, from_1904)
                column, row = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r")).groups()
                if text not in (None, ""):
                    cells.setdefault(int(row), {})[column] = text
            out[s.get("name")] = cells
    return out


def form_rows(path: str, data: bytes):
    """Rows of the form's sheets; labels stand in the second row."""
    for sheet, cells in sheet_cells(data).items():
        if sheet not in SHEETS:
            continue
        labels = {v.strip(): k for k, v in cells.get(2, {}).items()}
        field = next((labels[x] for x in FIELD_LABELS if x in labels), None)
        for n in sorted(r for r in cells if r > 2):
            row = cells[n]
            if field in row:
                yield path, sheet, n, row.get(labels.get("Requirement")), row[field], row.get(labels.get(VALUE_LABEL))


def read_form(spark: SparkSession, path: str | list[str]) -> DataFrame:
    ship(spark)

    def run(frames):
        for pdf in frames:
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                yield pd.DataFrame(list(form_rows(p, data)), columns=[c.split()[0] for c in ROWS.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, ROWS)
