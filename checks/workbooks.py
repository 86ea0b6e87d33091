"""Workbooks as test inputs, written by Spark tasks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _sheet(rows: Sequence[Sequence[str | None]]) -> str:
    lines = []
    for number, row in enumerate(rows, 1):
        cells = "".join(
            f'<c r="{chr(65 + at)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
            for at, text in enumerate(row)
            if text is not None
        )
        lines.append(f'<row r="{number}">{cells}</row>')
    return f"<worksheet {_MAIN}><sheetData>{''.join(lines)}</sheetData></worksheet>"


def workbook(sheets: dict[str, Sequence[Sequence[str | None]]]) -> bytes:
    """A workbook of text cells."""
    out = io.BytesIO()
    numbered = list(enumerate(sheets.items(), 1))
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in numbered)
        book.writestr("xl/workbook.xml", f'<workbook {_MAIN} xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>')
        links = "".join(
            f'<Relationship Id="r{i}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{links}</Relationships>')
        for i, (_, rows) in numbered:
            book.writestr(f"xl/worksheets/sheet{i}.xml", _sheet(rows))
    return out.getvalue()


def write_workbooks(rows: DataFrame, columns: Sequence[str], folder: str) -> None:
    """One workbook for each `book` with a sheet for each `page`: a title, an empty row, headers, rows.

    The caller bounds the rows of a book, as a spreadsheet does.
    """

    def write(part: pd.DataFrame) -> pd.DataFrame:
        import pyarrow.fs

        sheets = {
            page: [["Relatório"], [], list(columns), *cells[list(columns)].to_numpy().tolist()]
            for page, cells in part.groupby("page", sort=True)
        }
        name = part["book"].iloc[0]
        if folder.startswith("/"):
            fs, path = pyarrow.fs.LocalFileSystem(), folder
        else:
            fs, path = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(path)
        with fs.open_output_stream(f"{path}/{name}.xlsx") as file:
            file.write(workbook(sheets))
        return pd.DataFrame({"rows": [len(part)]})

    # The write is the work: counting what was written runs it.
    rows.groupBy("book").applyInPandas(write, "rows long").agg({"rows": "sum"}).collect()
