"""Workbooks as tables: ``(path, sheet_no, sheet, row_idx, cells)``.

Spark hands out whole workbooks (``binaryFile``), one per row; the task that gets one streams its sheets.
A workbook cannot be split, but the format bounds it: 1,048,576 rows by 16,384 columns per sheet.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.joins import null_safe_join

CELL_SCHEMA = "path string, sheet_no int, sheet string, row_idx long, cells array<string>"
NAME_SCHEMA = "path string, sheet_no int, sheet string"
BATCH_ROWS = 5_000

# Fixed values of the workbook format.
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
DAY_ZERO = dt.datetime(1899, 12, 30)


def _tag(element: ET.Element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, member path) in workbook order."""
    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    out = []
    for element in ET.fromstring(book.read("xl/workbook.xml")).iter():
        if _tag(element) == "sheet":
            target = targets[element.get(RELATION_ID)]
            out.append((element.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return out


def _texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    items = (e for e in ET.fromstring(book.read("xl/sharedStrings.xml")) if _tag(e) == "si")
    return ["".join(t.text or "" for t in item.iter() if _tag(t) == "t") for item in items]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Style numbers that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ET.fromstring(book.read("xl/styles.xml"))
    dated = set(DATE_FORMAT_IDS)
    for e in root.iter():
        if _tag(e) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode", ""))
            if re.search(r"[ymdhs]", code, re.IGNORECASE):
                dated.add(int(e.get("numFmtId")))
    formats = next((e for e in root if _tag(e) == "cellXfs"), [])
    return {i for i, xf in enumerate(formats) if int(xf.get("numFmtId", 0)) in dated}


def _column(reference: str) -> int:
    number = 0
    for ch in reference:
        if not ch.isalpha():
            break
        number = number * 26 + ord(ch.upper()) - 64
    return number - 1


def _cell_text(cell: ET.Element, texts: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if _tag(t) == "t")
    raw = next((v.text for v in cell if _tag(v) == "v"), None)
    if raw is None or kind == "e":
        return None
    if kind == "s":
        return texts[int(raw)]
    if kind == "b":
        return "true" if raw == "1" else "false"
    if kind == "n" and int(cell.get("s", 0)) in dates:
        return (DAY_ZERO + dt.timedelta(seconds=round(float(raw) * 86400))).strftime("%Y-%m-%d %H:%M:%S")
    return raw


def _rows(book: zipfile.ZipFile, member: str, texts: list[str], dates: set[int]) -> Iterator[tuple[int, list[str | None]]]:
    first = number = None
    with book.open(member) as stream:
        for _, element in ET.iterparse(stream):
            if _tag(element) != "row":
                continue
            number = int(element.get("r", (number or 0) + 1))
            first = number if first is None else first
            cells: list[str | None] = []
            for position, cell in enumerate(e for e in element if _tag(e) == "c"):
                at = _column(cell.get("r")) if cell.get("r") else position
                cells.extend([None] * (at - len(cells)))
                cells.append(_cell_text(cell, texts, dates))
            yield number - first, cells
            element.clear()


def read_cells(
    books: DataFrame, skip: Sequence[str] = (), only: Sequence[str] | None = None, first_row_only: bool = False
) -> DataFrame:
    """Cells of every sheet of ``(path, content)`` workbooks as text; an unreadable workbook is left out."""
    skipped, wanted = set(skip), None if only is None else set(only)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "sheet_no", "sheet", "row_idx", "cells"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    book = zipfile.ZipFile(io.BytesIO(content))
                    sheets, texts, dates = _sheets(book), _texts(book), _date_styles(book)
                except (zipfile.BadZipFile, KeyError, ET.ParseError):
                    continue
                for number, (sheet, member) in enumerate(sheets):
                    if sheet in skipped or (wanted is not None and sheet not in wanted):
                        continue
                    pending = []
                    for row_idx, cells in _rows(book, member, texts, dates):
                        pending.append((path, number, sheet, row_idx, cells))
                        if first_row_only:
                            break
                        if len(pending) == BATCH_ROWS:
                            yield pd.DataFrame(pending, columns=names)
                            pending = []
                    if pending:
                        yield pd.DataFrame(pending, columns=names)

    return books.select("path", "content").mapInPandas(parse, CELL_SCHEMA)


def sheet_names(books: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Sheet names only; cells are not parsed. An unreadable workbook is left out."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    names = _sheets(zipfile.ZipFile(io.BytesIO(content)))
                except (zipfile.BadZipFile, KeyError, ET.ParseError):
                    continue
                found.extend((path, i, name) for i, (name, _) in enumerate(names))
            yield pd.DataFrame(found, columns=["path", "sheet_no", "sheet"])

    named = books.select("path", "content").mapInPandas(parse, NAME_SCHEMA)
    return named.where(~F.col("sheet").isin(*skip)) if skip else named


def unreadable(books: DataFrame) -> DataFrame:
    """Paths of workbooks that could not be opened, for the run manifest."""
    return books.select("path").join(sheet_names(books).select("path").distinct(), on="path", how="left_anti")


def workbooks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(path, content)`` of the .xlsx files (any case) below a folder or in a list."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xX]")
    return reader.load(path if isinstance(path, str) else list(path)).select("path", "content")


def sheet_table(books: DataFrame, sheet: str, lineage: str | None = None) -> DataFrame:
    """One sheet of every workbook with its first row as header, stacked by column name, all text.

    Only the distinct header rows visit the driver. A repeated header name keeps its first column.
    """
    heads = [
        r["cells"]
        for r in read_cells(books, only=[sheet], first_row_only=True).select("cells").distinct().collect()
    ]
    names = list(dict.fromkeys(n for h in sorted(heads, key=str) for n in h if n is not None))
    header = read_cells(books, only=[sheet], first_row_only=True).select("path", F.col("cells").alias("header"))
    body = null_safe_join(read_cells(books, only=[sheet]).where("row_idx > 0"), header, ["path"], "inner")
    position = {n: F.array_position("header", n) for n in names}
    columns = [
        F.when(position[n] > 0, F.get("cells", (position[n] - 1).cast("int"))).alias(n) for n in names
    ]
    extra = [F.element_at(F.split("path", "/"), -1).alias(lineage)] if lineage else []
    return body.select(*columns, *extra)
