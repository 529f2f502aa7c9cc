"""Cells of one worksheet as text, streamed row by row. Small helper of the workbook scan."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from decimal import Decimal, InvalidOperation
from xml.etree import ElementTree

MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# Number format ids that show dates or times, and texts that stand for "no value".
DATE_FORMATS = frozenset(range(14, 23)) | frozenset(range(45, 48))
NO_VALUE = frozenset([
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
])

_LITERALS = re.compile(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', re.IGNORECASE)
_COLUMN = re.compile(r"[A-Z]+")


def _text(node) -> str:
    """All text runs of a string node, phonetic hints left out."""
    if node is None:
        return ""
    runs = [t.text or "" for t in node.findall(f"{MAIN}t")]
    runs += [t.text or "" for r in node.findall(f"{MAIN}r") for t in r.findall(f"{MAIN}t")]
    return "".join(runs)


def _column_number(reference: str) -> int:
    number = 0
    for letter in _COLUMN.match(reference).group():
        number = number * 26 + ord(letter) - 64
    return number - 1


def _serial_text(serial: float, from_1904: bool) -> str:
    """A date serial as ISO text; a pure time of day has no date part."""
    if 0 <= serial < 1:
        moment = datetime(1900, 1, 1) + timedelta(seconds=round(serial * 86400))
        return moment.strftime("%H:%M:%S")
    if not from_1904 and serial < 60:
        serial += 1  # the 1900 calendar of the format has a 29 February
    start = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
    return (start + timedelta(days=int(serial), seconds=round(serial % 1 * 86400))).strftime("%Y-%m-%d %H:%M:%S")


def _number_text(text: str) -> str:
    """A number in plain digits: whole numbers exactly, others as short as their double allows."""
    try:
        value = Decimal(text)
    except InvalidOperation:
        return text
    if not value.is_finite() or abs(value.adjusted()) > 400:  # beyond what a cell can hold
        return text
    if value == value.to_integral_value():
        return format(value.to_integral_value(), "f") if value else "0"
    return format(Decimal(repr(float(value))), "f")


def _is_date_format(code: str) -> bool:
    return re.search("[dmhys]", _LITERALS.sub("", code.split(";")[0]), re.IGNORECASE) is not None


class _Book:
    """The parts of a workbook that its cells refer to."""

    def __init__(self, archive: zipfile.ZipFile):
        self.archive = archive
        self.parts = set(archive.namelist())
        book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
        settings = book.find(f"{MAIN}workbookPr")
        self.from_1904 = settings is not None and settings.get("date1904") in ("1", "true")
        self.sheet = self._first_sheet(book)
        self.strings = self._shared_strings()
        self.date_styles = self._date_styles()

    def _first_sheet(self, book) -> str:
        wanted = book.find(f"{MAIN}sheets/{MAIN}sheet").get(RELATION)
        for link in ElementTree.fromstring(self.archive.read("xl/_rels/workbook.xml.rels")):
            if link.get("Id") == wanted:
                target = link.get("Target")
                return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        raise ValueError("workbook without a first sheet")

    def _shared_strings(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.parts:
            return []
        strings = []
        with self.archive.open("xl/sharedStrings.xml") as part:
            for _, node in ElementTree.iterparse(part):
                if node.tag == f"{MAIN}si":
                    strings.append(_text(node))
                    node.clear()
        return strings

    def _date_styles(self) -> set[int]:
        if "xl/styles.xml" not in self.parts:
            return set()
        styles = ElementTree.fromstring(self.archive.read("xl/styles.xml"))
        dates = set(DATE_FORMATS)
        for entry in styles.iterfind(f"{MAIN}numFmts/{MAIN}numFmt"):
            if _is_date_format(entry.get("formatCode", "")):
                dates.add(int(entry.get("numFmtId")))
        return {i for i, style in enumerate(styles.iterfind(f"{MAIN}cellXfs/{MAIN}xf"))
                if int(style.get("numFmtId", "0")) in dates}

    def cell_text(self, cell) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            text = _text(cell.find(f"{MAIN}is"))
        else:
            text = cell.findtext(f"{MAIN}v")
            if text is None or kind == "e":
                return None
            if kind == "s":
                text = self.strings[int(text)]
            elif kind == "b":
                return "true" if text == "1" else "false"
            elif kind == "d":
                text = datetime.fromisoformat(text).strftime("%Y-%m-%d %H:%M:%S")
            elif kind == "n":
                if int(cell.get("s", "0")) in self.date_styles:
                    return _serial_text(float(text), self.from_1904)
                return _number_text(text)
        return None if text in NO_VALUE else text


def sheet_rows(content: bytes) -> Iterator[tuple[int, dict[int, str]]]:
    """``(row index, {column index: text})`` of the first sheet's rows that have a value, in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        book = _Book(archive)
        position = -1
        with archive.open(book.sheet) as part:
            rows = None
            for event, node in ElementTree.iterparse(part, ("start", "end")):
                if node.tag != f"{MAIN}row" or event == "start":
                    rows = node if node.tag == f"{MAIN}sheetData" and event == "start" else rows
                    continue
                position = int(node.get("r")) - 1 if node.get("r") else position + 1
                row, column = {}, -1
                for cell in node.iterfind(f"{MAIN}c"):
                    column = _column_number(cell.get("r")) if cell.get("r") else column + 1
                    text = book.cell_text(cell)
                    if text is not None:
                        row[column] = text
                rows.clear()  # a row that stayed in its sheet would stay in memory
                if row:
                    yield position, row


def header_names(row: dict[int, str], width: int) -> list[str]:
    """Column names of a header row: blanks are numbered, a repeated name gets ``.1``, ``.2`` and so on."""
    names: list[str] = []
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    for i in range(width):
        base = name = row.get(i, f"Unnamed: {i}")
        while name in taken:
            repeats[base] = repeats.get(base, 0) + 1
            name = f"{base}.{repeats[base]}"
        taken.add(name)
        names.append(name)
    return names
