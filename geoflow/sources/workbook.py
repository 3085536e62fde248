"""Sheets of many ``.xlsx`` workbooks as one table."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Namespaces of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _column_number(ref: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]+", ref).group():
        n = 26 * n + ord(letter) - 64
    return n - 1


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ET.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iter(f"{MAIN}t")) for item in root.findall(f"{MAIN}si")]


def _sheet_path(book: zipfile.ZipFile, name: str | None) -> str:
    sheets = ET.fromstring(book.read("xl/workbook.xml")).find(f"{MAIN}sheets")
    targets = {
        r.get("Id"): r.get("Target")
        for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")).findall(f"{PACKAGE}Relationship")
    }
    for sheet in sheets:
        if not name or sheet.get("name") == name:
            target = targets[sheet.get(f"{RELS}id")]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"no sheet {name!r}")


def sheet_rows(content: bytes, sheet: str | None) -> Iterator[list[str | None]]:
    """Cell texts of a sheet, row by row; an empty name is the first sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        with book.open(_sheet_path(book, sheet)) as stream:
            for _, row in ET.iterparse(stream):
                if row.tag != f"{MAIN}row":
                    continue
                cells: dict[int, str] = {}
                for cell in row.findall(f"{MAIN}c"):
                    value = cell.find(f"{MAIN}v")
                    if cell.get("t") == "s":
                        text = shared[int(value.text)]
                    elif cell.get("t") == "inlineStr":
                        text = "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
                    else:
                        text = value.text if value is not None else None
                    if text is not None:
                        cells[_column_number(cell.get("r"))] = text
                yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]
                row.clear()


def parse_workbooks(files: DataFrame, columns: dict[str, str], sheet: str | None = None) -> DataFrame:
    """Rows of workbooks given as ``path, content`` rows.

    ``columns`` names the wanted columns of the header row with their types; missing ones are null.
    """
    names = list(columns)
    ddl = ", ".join(["path string", "row_number bigint"] + [f"`{n}` string" for n in names])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                lines = sheet_rows(bytes(content), sheet)
                header = {h: i for i, h in enumerate(next(lines, [])) if h}
                places = [header.get(n) for n in names]
                out = [
                    [path, k, *[line[i] if i is not None and i < len(line) else None for i in places]]
                    for k, line in enumerate(lines, start=1)
                ]
                yield pd.DataFrame(out, columns=["path", "row_number", *names])

    texts = files.select("path", "content").mapInPandas(rows, ddl)
    return texts.select("path", "row_number", *[F.col(n).try_cast(t).alias(n) for n, t in columns.items()])
