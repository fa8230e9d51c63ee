"""Writers that turn table rows into workbooks, so that the workbook source has files to read.

Books hold a fixed number of rows and are named by their number, so a retried task writes the same file again.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

from snapflow.sources.paths import filesystem, ship

SPREADSHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def column_letters(index: int) -> str:
    letters = ""
    index += 1
    while index:
        index, digit = divmod(index - 1, 26)
        letters = chr(65 + digit) + letters
    return letters


def cell_xml(row: int, column: int, value, strings: dict[str, int]) -> str:
    """A cell; text goes to the shared strings, ``("date", n)`` is a date-styled number, ``("raw", xml)`` is kept."""
    at = f'r="{column_letters(column)}{row}"'
    if value is None or value != value:
        return ""
    if isinstance(value, tuple):
        return f'<c {at} s="1"><v>{value[1]}</v></c>' if value[0] == "date" else f"<c {at} {value[1]}</c>"
    if isinstance(value, bool):
        return f'<c {at} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {at}><v>{value!r}</v></c>"
    return f'<c {at} t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    strings: dict[str, int] = {}
    bodies = ["".join(f'<row r="{i}">' + "".join(cell_xml(i, j, v, strings) for j, v in enumerate(row)) + "</row>"
                      for i, row in enumerate(rows, start=1)) for rows in sheets.values()]
    names = list(sheets)
    rels = "".join(f'<Relationship Id="rId{i}" Type="{OFFICE}/worksheet" Target="worksheets/sheet{i}.xml"/>'
                   for i in range(1, len(names) + 1))
    listing = "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, start=1))
    shared = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{SPREADSHEET}" xmlns:r="{OFFICE}"><sheets>{listing}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}">{rels}</Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{SPREADSHEET}">{shared}</sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{SPREADSHEET}"><numFmts><numFmt numFmtId="170" '
                   'formatCode="yyyy\\-mm\\-dd hh:mm:ss"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>')
        for i, body in enumerate(bodies, start=1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{SPREADSHEET}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def write_workbooks(df: DataFrame, folder: str, book_column: str, sheet_column: str, dates: tuple[str, ...] = ()) -> None:
    """One workbook per value of ``book_column``, one sheet per value of ``sheet_column``, a blank row on top.

    A book must be small enough for one task; the caller numbers books so that each holds a fixed number of rows.
    ``dates`` hold day numbers.
    """
    ship(__name__)
    columns = [c for c in df.columns if c not in (book_column, sheet_column)]

    def write(key: tuple, book: pd.DataFrame) -> pd.DataFrame:
        sheets: dict[str, list[list]] = {}
        for record in book.sort_values(columns[0]).to_dict("records"):
            rows = sheets.setdefault(record[sheet_column], [[], list(columns)])
            rows.append([("date", record[c]) if c in dates and record[c] == record[c] else record[c] for c in columns])
        fs, base = filesystem(folder)
        fs.create_dir(base)
        with fs.open_output_stream(f"{base}/2026-03-02-Full Dump part{key[0]:05d}.xlsx") as out:
            out.write(workbook_bytes(dict(sorted(sheets.items()))))
        return pd.DataFrame({"n": [len(sheets)]})

    df.groupBy(book_column).applyInPandas(write, "n long").write.format("noop").mode("overwrite").save()
