"""A minimal spreadsheet writer for test inputs."""

import datetime as dt
import zipfile
from xml.sax.saxutils import escape

_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letters(i):
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(ref, value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, dt.date):
        return f'<c r="{ref}" s="1"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'


def write_workbook(path, sheets, shared=False):
    """``sheets``: name -> list of rows. ``shared`` stores text in the shared-string table."""
    path.parent.mkdir(parents=True, exist_ok=True)
    strings = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        listed = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1)
        )
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_NS}" xmlns:r="{_REL}"><sheets>{listed}</sheets></workbook>',
        )
        links = "".join(
            f'<Relationship Id="rId{i}" Type="t" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(names) + 1)
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f"{links}</Relationships>",
        )
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{_NS}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/>'
            "</cellXfs></styleSheet>",
        )
        for i, name in enumerate(names, 1):
            lines = []
            for r, row in enumerate(sheets[name], 1):
                cells = []
                for c, value in enumerate(row):
                    ref = f"{_letters(c)}{r}"
                    if shared and isinstance(value, str):
                        strings.append(value)
                        cells.append(f'<c r="{ref}" t="s"><v>{len(strings) - 1}</v></c>')
                    else:
                        cells.append(_cell(ref, value))
                if any(cells):
                    lines.append(f'<row r="{r}">{"".join(cells)}</row>')
            z.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{_NS}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
            )
        if strings:
            items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_NS}">{items}</sst>')
    return path
