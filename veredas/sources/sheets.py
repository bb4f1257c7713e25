"""Rows of XLSX files, read from the archive itself."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

CELL = re.compile(r"([A-Z]+)(\d+)")


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def sheet_rows(content: bytes, sheet: int = 1) -> list[dict[str, str]]:
    """Cells of one worksheet by column letter, row by row; shared and inline strings resolved. No rows if it is no such file."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        names = archive.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(archive.read("xl/sharedStrings.xml")):
                shared.append("".join(x.text or "" for x in item.iter() if _local(x.tag) == "t"))
        root = ElementTree.fromstring(archive.read(f"xl/worksheets/sheet{sheet}.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return []
    rows = []
    for row in (x for x in root.iter() if _local(x.tag) == "row"):
        cells: dict[str, str] = {}
        for cell in row:
            place = CELL.match(cell.get("r", ""))
            text = "".join(x.text or "" for x in cell.iter() if _local(x.tag) in ("v", "t"))
            if place and text:
                cells[place.group(1)] = shared[int(text)] if cell.get("t") == "s" else text
        rows.append(cells)
    return rows


def read_sheets(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """(path, row_no, cells map): the rows of every file under ``path``; files are parsed where they lie, one at a time."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                found = sheet_rows(content, sheet)
                yield pd.DataFrame({"path": name, "row_no": range(1, len(found) + 1), "cells": found})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(emit, "path string, row_no int, cells map<string,string>")
