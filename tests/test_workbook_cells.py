"""Worksheets written by hand, with what our own writer never writes."""

import io
import zipfile

import pytest

from daybook.sources.cells import _number_text, sheet_rows

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def book(rows, styles="", strings="", settings="", target="worksheets/sheet1.xml", sheets=None):
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}">{settings}<sheets>'
                           '<sheet name="b" sheetId="7" r:id="rId9"/><sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}">'
                                      f'<Relationship Id="rId1" Type="{RELATIONS}/worksheet" Target="worksheets/other.xml"/>'
                                      f'<Relationship Id="rId9" Type="{RELATIONS}/worksheet" Target="{target}"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{MAIN}"><sheetData>{rows}</sheetData></worksheet>',
        "xl/worksheets/other.xml": f'<worksheet xmlns="{MAIN}"><sheetData><row><c><v>0</v></c></row></sheetData></worksheet>',
    }
    if styles:
        parts["xl/styles.xml"] = f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>'
    if strings:
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{strings}</sst>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, text in parts.items():
            archive.writestr(name, text)
    return out.getvalue()


def read(*args, **kwargs):
    return list(sheet_rows(book(*args, **kwargs)))


def test_cell_addresses_and_gaps():
    rows = '<row r="2"><c r="C2"><v>5</v></c><c><v>6</v></c><c r="AA2"><v>7</v></c></row><row r="9"><c r="B9"><v>1</v></c></row>'
    assert read(rows) == [(1, {2: "5", 3: "6", 26: "7"}), (8, {1: "1"})]
    assert read(rows, target="/xl/worksheets/sheet1.xml") == read(rows)


def test_kinds_of_cells():
    strings = '<si><t>plain</t></si><si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si>'
    rows = ('<row><c t="s"><v>0</v></c><c t="s"><v>1</v></c><c t="e"><v>#DIV/0!</v></c><c t="str"><f>A1</f><v>made</v></c>'
            '<c t="d"><v>2024-01-05T12:30:00</v></c><c t="b"><v>0</v></c><c t="inlineStr"><is><r><t>in</t></r><r><t>line</t></r></is></c>'
            '<c t="str"><v>N/A</v></c><c><v>1</v></c></row>')
    assert read(rows, strings=strings) == [(0, {
        0: "plain", 1: "rich", 3: "made", 4: "2024-01-05 12:30:00", 5: "false", 6: "inline", 8: "1"})]


STYLES = ('<numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.00 &quot;days&quot;"/>'
          '<numFmt numFmtId="166" formatCode="[h]:mm"/><numFmt numFmtId="167" formatCode="[Red]0.0"/></numFmts>'
          '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="166"/><xf numFmtId="167"/></cellXfs>')
DATES = '<row>' + "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in (
    (0, "45296"), (1, "45296"), (2, "45296.5"), (3, "2.5"), (4, "0.25"), (5, "1.5"), (1, "59"), (1, "61"))) + '</row>'


def test_number_formats_and_calendars():
    assert read(DATES, STYLES) == [(0, {
        0: "45296", 1: "2024-01-05 00:00:00", 2: "2024-01-05 12:00:00", 3: "2.5", 4: "06:00:00", 5: "1.5",
        6: "1900-02-28 00:00:00", 7: "1900-03-01 00:00:00"})]
    later = read(DATES, STYLES, settings='<workbookPr date1904="1"/>')[0][1]
    assert later[1] == "2028-01-06 00:00:00" and later[6] == "1904-02-29 00:00:00"


@pytest.mark.parametrize("text, want", [
    ("-12345678901234567", "-12345678901234567"), ("-9007199254740993", "-9007199254740993"), ("12", "12"), ("007", "7"),
    ("1.0", "1"), ("-0", "0"), ("1E3", "1000"), ("1.5E+20", "150000000000000000000"), ("4.5499999999999998", "4.55"),
    ("1E-7", "0.0000001"), ("0.1", "0.1"), ("12345678.5", "12345678.5"), ("abc", "abc"), ("1E999999", "1E999999")])
def test_numbers_keep_their_digits(text, want):
    assert _number_text(text) == want


@pytest.mark.parametrize("content", [b"", b"no archive", book("<row>")[:300]])
def test_broken_files_raise(content):
    with pytest.raises(Exception):
        list(sheet_rows(content))
