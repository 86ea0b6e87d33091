"""The Python that runs inside tasks: file headers, and rows of spreadsheet workbooks.

Spark has built-in readers for text and Parquet; only the header line of each file and the
workbook format need Python. Files are opened through ``pyarrow.fs``, so any file system Spark
and Arrow both know will do. This module imports nothing else from the package and is shipped to
the workers by value, so they need no installed copy of it.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import re
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Numbers of the built-in number formats that show a date or a time.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_BATCH_ROWS = 10_000


def open_file(path: str):
    """A seekable, readable handle on a local path or a file-system URI."""
    import pyarrow.fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    fs, inner = (
        (pyarrow.fs.LocalFileSystem(), path)
        if path.startswith("/")
        else pyarrow.fs.FileSystem.from_uri(path)
    )
    return fs.open_input_file(inner)


class Workbook:
    """Streams the rows of one workbook's sheets as text."""

    def __init__(self, path: str) -> None:
        self._zip = zipfile.ZipFile(open_file(path))
        names = set(self._zip.namelist())
        book = ElementTree.fromstring(self._zip.read("xl/workbook.xml"))
        links = ElementTree.fromstring(self._zip.read("xl/_rels/workbook.xml.rels"))
        target = {link.get("Id"): link.get("Target") for link in links}
        self.sheets = {
            s.get("name"): self._member(target[s.get(_RELATION)]) for s in book.iter(_MAIN + "sheet")
        }
        setup = book.find(_MAIN + "workbookPr")
        from_1904 = setup is not None and setup.get("date1904") in ("1", "true")
        self._epoch = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 30)
        self._shared = self._shared_strings() if "xl/sharedStrings.xml" in names else []
        self._dated = self._date_styles() if "xl/styles.xml" in names else set()

    @staticmethod
    def _member(target: str) -> str:
        return target.lstrip("/") if target.startswith("/") else "xl/" + target

    def _shared_strings(self) -> list[str]:
        strings = []
        with self._zip.open("xl/sharedStrings.xml") as xml:
            for _, item in ElementTree.iterparse(xml):
                if item.tag == _MAIN + "si":
                    strings.append("".join(t.text or "" for t in item.iter(_MAIN + "t")))
                    item.clear()
        return strings

    def _date_styles(self) -> set[int]:
        styles = ElementTree.fromstring(self._zip.read("xl/styles.xml"))
        dated = set(_DATE_FORMATS)
        for custom in styles.iter(_MAIN + "numFmt"):
            bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get("formatCode", ""))
            if re.search("[dmyhs]", bare, re.IGNORECASE) and "general" not in bare.lower():
                dated.add(int(custom.get("numFmtId")))
        formats = styles.find(_MAIN + "cellXfs")
        used = [] if formats is None else [int(x.get("numFmtId", 0)) for x in formats]
        return {i for i, number in enumerate(used) if number in dated}

    def pick(self, sheet: str | int) -> list[str]:
        """Names of the sheets meant by a name, a position or ``*``."""
        names = list(self.sheets)
        if sheet == "*":
            return names
        if isinstance(sheet, int):
            if sheet >= len(names):
                raise ValueError(f"workbook has {len(names)} sheet(s), no position {sheet}")
            return [names[sheet]]
        if sheet not in self.sheets:
            raise ValueError(f"no sheet {sheet!r}; found {names}")
        return [sheet]

    def _text(self, cell) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in cell.iter(_MAIN + "t"))
        value = cell.findtext(_MAIN + "v")
        if value is None or kind == "e":
            return None
        if kind == "s":
            return self._shared[int(value)]
        if kind == "b":
            return "true" if value == "1" else "false"
        if kind != "n":
            return value
        if int(cell.get("s", 0)) in self._dated:
            moment = self._epoch + dt.timedelta(seconds=round(float(value) * 86400))
            return moment.strftime("%Y-%m-%d %H:%M:%S")
        if value.lstrip("-").isdigit():
            return value
        number = float(value)
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)

    def rows(self, sheet: str, width: int | None = None) -> Iterator[list[str | None]]:
        """Rows of a sheet in order, blank ones between them included, from the first used one."""
        expected = None
        with self._zip.open(self.sheets[sheet]) as xml:
            for _, row in ElementTree.iterparse(xml):
                if row.tag != _MAIN + "row":
                    continue
                cells: dict[int, str | None] = {}
                position = -1
                for cell in row.iter(_MAIN + "c"):
                    letters = re.match("[A-Z]+", cell.get("r", ""))
                    position = _column(letters.group()) if letters else position + 1
                    text = self._text(cell)
                    cells[position] = None if text is None or not text.strip() else text
                number = int(row.get("r", (expected or 1)))
                row.clear()
                for _ in range(number - (expected or number)):
                    yield [None] * (width or 0)
                expected = number + 1
                last = width or (max(cells) + 1 if cells else 0)
                yield [cells.get(i) for i in range(last)]


def _column(letters: str) -> int:
    index = 0
    for letter in letters:
        index = index * 26 + ord(letter) - 64
    return index - 1


def _header_of(path: str, options: dict) -> list[tuple[str, list[str | None]]]:
    """(sheet, headers) of every table in one file."""
    if options["format"] == "workbook":
        book = Workbook(path)
        found = []
        for sheet in book.pick(options["sheet"]):
            rows = book.rows(sheet)
            for _ in range(options["header_row"]):
                next(rows, None)
            found.append((sheet, next(rows, [])))
        return found
    if options["format"] == "parquet":
        import pyarrow.parquet

        with open_file(path) as raw:
            return [("0", pyarrow.parquet.read_schema(raw).names)]
    with open_file(path) as raw:
        text = io.TextIOWrapper(raw, encoding=options["encoding"], newline="")
        first = next(csv.reader(text, delimiter=options["sep"]), [])
    return [("0", [h.lstrip("﻿") for h in first])]


def header_scan(options: dict):
    """Function for ``mapInArrow``: files in, one row per table of each file out."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                {**file, "sheet": sheet, "headers": [h or "" for h in headers]}
                for file in batch.to_pylist()
                for sheet, headers in _header_of(file["path"], options)
            ]
            schema = batch.schema.append(pa.field("sheet", pa.string()))
            schema = schema.append(pa.field("headers", pa.list_(pa.string())))
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return scan


def workbook_rows(names: list[str], header_row: int):
    """Function for ``mapInArrow``: (path, sheet, modified, size, layout) in, the rows of those sheets out.

    ``names`` are the leading cells as text, and then the five columns that came in.
    """
    width = len(names) - 5

    def arrow(batch: list[list[str | None]], table: dict) -> pa.RecordBatch:
        columns = [pa.array(c, pa.string()) for c in zip(*batch, strict=True)]
        for constant in table.values():
            kind = pa.string() if isinstance(constant, str) else pa.int64()
            columns.append(pa.array([constant] * len(batch), kind))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def read(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in tables:
            for table in listed.to_pylist():
                rows = Workbook(table["path"]).rows(table["sheet"], width)
                for _ in range(header_row + 1):
                    next(rows, None)
                batch: list[list[str | None]] = []
                for row in rows:
                    batch.append(row)
                    if len(batch) == _BATCH_ROWS:
                        yield arrow(batch, table)
                        batch = []
                if batch:
                    yield arrow(batch, table)

    return read
