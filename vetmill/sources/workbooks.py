"""Grouped reminder sheets from xlsx workbooks: a zip of XML, a task for each sheet.

Workbooks are opened by Spark's binary reader, so they may lie wherever Spark can read. One pass takes each workbook
apart into its sheets, still packed, with the shared texts and the styles that mean dates; these are dealt over tasks,
and a second pass reads each sheet as a stream of rows. A sheet has at most 1,048,576 rows by its format.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from functools import lru_cache
from io import BytesIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetmill.sources.feeds import SHEET

SHEETS = "file string, sheet string, from_1904 boolean, dates array<int>, texts binary, body binary"
ROWS = "file string, sheet string, row_number long, " + ", ".join(f"{c} string" for c in SHEET) + ", due_date_typed date"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ROW, _CELL, _V, _IS, _SI = (f"{_MAIN}{x}" for x in ("row", "c", "v", "is", "si"))
#: Bytes of XML that are read as a whole; longer texts are read as a stream.
WHOLE = 1 << 20
#: Sheets, and bytes of them, that one Arrow batch hands on.
SOME, MOST = 256, 8 << 20
#: Built-in number formats that show a day (fixed values of the file format).
DAY_FORMATS = {14, 15, 16, 17, 22, *range(27, 37), *range(50, 59)}


def _shows_day(code: str) -> bool:
    """Whether a number format shows a day, month or year; quoted text and colours and languages in brackets aside."""
    bare = re.sub(r'"[^"]*"|\[(?![hms]+\])[^\]]*\]|\\.', "", code.lower())
    return "d" in bare or "y" in bare or ("m" in bare and not re.search("[hs]", bare))


@lru_cache(16)
def _day_styles(xml: bytes) -> list[int]:
    """Workbooks of one maker have the same styles, byte for byte."""
    from xml.etree import ElementTree

    styles = ElementTree.fromstring(xml)
    own = {int(x.get("numFmtId")): x.get("formatCode", "") for x in styles.iter(f"{_MAIN}numFmt")}
    cells = styles.find(f"{_MAIN}cellXfs")
    ids = [int(x.get("numFmtId", 0)) for x in (cells if cells is not None else ())]
    return [i for i, n in enumerate(ids) if (_shows_day(own[n]) if n in own else n in DAY_FORMATS)]


@lru_cache(16)
def _places(xml: bytes) -> dict[str, str]:
    from xml.etree import ElementTree

    return {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(xml)}


def _take_apart(batches):
    """Workbooks to packed sheets, some hundreds or megabytes at a time."""
    import pyarrow as pa

    types = [pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = ["file", "sheet", "from_1904", "dates", "texts", "body"]
    out = lambda rows: pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
    rows, held = [], 0
    for b in batches:
        for file, content in zip(b["file"], b["content"], strict=True):
            for row in _sheets(file.as_py(), content.as_py()):
                rows.append(row)
                held += len(row[-1]) + len(row[-2] or b"")
                if len(rows) >= SOME or held >= MOST:
                    yield out(rows)
                    rows, held = [], 0
    if rows:
        yield out(rows)


def _sheets(file: str, content: bytes) -> Iterator[tuple]:
    """A workbook's sheets, each with what it takes to read it."""
    import zipfile
    from xml.etree import ElementTree

    with zipfile.ZipFile(BytesIO(content)) as z:
        held = set(z.namelist())
        book, places = ElementTree.fromstring(z.read("xl/workbook.xml")), _places(z.read("xl/_rels/workbook.xml.rels"))
        kind = book.find(f"{_MAIN}workbookPr")
        from_1904 = kind is not None and kind.get("date1904") in ("1", "true")
        dates = _day_styles(z.read("xl/styles.xml")) if "xl/styles.xml" in held else []
        texts = zlib.compress(z.read("xl/sharedStrings.xml"), 1) if "xl/sharedStrings.xml" in held else None
        for s in book.iter(f"{_MAIN}sheet"):
            at = places[s.get(_REL)]
            at = at.lstrip("/") if at.startswith("/") else f"xl/{at}"
            if "worksheets/" in at:  # a chart has no cells
                yield file, s.get("name"), from_1904, dates, texts, zlib.compress(z.read(at), 1)


def _text(node) -> str:
    """The text of a shared or inline string; phonetic readings aside."""
    return "".join(t.text or "" for x in node for t in ([x] if x.tag == f"{_MAIN}t" else x.iter(f"{_MAIN}t") if x.tag == f"{_MAIN}r" else ()))


def _day(serial: float, from_1904: bool) -> datetime:
    """Days count from 1 January 1904, or from 1900, which the format takes for a leap year."""
    first = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30) if serial >= 60 else datetime(1899, 12, 31)
    return first + timedelta(milliseconds=round(serial * 86_400_000))


def _value(cell, texts: list[str], dates: set[int], from_1904: bool) -> str | datetime | None:
    kind, v = cell.get("t", "n"), cell.find(_V)
    if kind == "inlineStr":
        node = cell.find(_IS)
        return None if node is None else _text(node)
    if v is None or v.text is None:
        return "" if v is not None and kind == "str" else None
    if kind == "s":
        return texts[int(v.text)]
    if kind == "b":
        return str(v.text == "1")
    if kind == "d":
        return datetime.fromisoformat(v.text)
    if kind != "n":
        return v.text
    if int(cell.get("s", 0)) in dates:
        return _day(float(v.text), from_1904)
    return str(float(v.text)) if re.search("[.eE]", v.text) else str(int(v.text))


@lru_cache(1024)
def _column(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _place(name: str) -> int:
    """The column of a cell's name, from 0."""
    return _column(name.rstrip("0123456789"))


def _elements(xml: bytes, tag: str) -> Iterator:
    """The elements of a name; those of a long text one at a time."""
    from xml.etree import ElementTree

    if len(xml) < WHOLE:
        yield from ElementTree.fromstring(xml).iter(tag)
    else:
        yield from (x for _, x in ElementTree.iterparse(BytesIO(xml)) if x.tag == tag)


def _read(body: bytes, texts: bytes | None, dates: list[int], from_1904: bool) -> Iterator[tuple]:
    """(row number, nine texts, day) for each row from 2 on; one blank row where rows are left out."""
    known = [_text(x) for x in _elements(zlib.decompress(texts), _SI)] if texts else []
    days, last = set(dates), 1
    blank = (None,) * (len(SHEET) + 1)
    for row in _elements(zlib.decompress(body), _ROW):
        number, cells, at = int(row.get("r", last + 1)), [None] * len(SHEET), -1
        for cell in row.iter(_CELL):
            at = _place(cell.get("r")) if cell.get("r") else at + 1
            if at < len(SHEET):
                cells[at] = _value(cell, known, days, from_1904)
        row.clear()
        if number < 2:
            continue
        if number > last + 1:
            yield (last + 1, *blank)
        last = number
        day: date | None = cells[-1].date() if isinstance(cells[-1], datetime) else None
        if day:
            cells[-1] = None
        yield (number, *[str(c) if isinstance(c, datetime) else c for c in cells], day)


def _rows(batches):
    """Packed sheets to rows, some thousands at a time, whatever sheets they are of."""
    from itertools import batched

    import pyarrow as pa

    types = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * len(SHEET), pa.date32()]
    names = ["file", "sheet", "row_number", *SHEET, "due_date_typed"]

    def read():
        for b in batches:
            columns = [b[n] for n in ("file", "sheet", "body", "texts", "dates", "from_1904")]
            for i in range(b.num_rows):
                file, sheet, *packed = (c[i].as_py() for c in columns)
                for row in _read(*packed):
                    yield file, sheet, *row

    for some in batched(read(), 5000):
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*some, strict=True), types, strict=True)], names=names)


def sheet_rows(workbooks: DataFrame, sheet: str | None = None) -> DataFrame:
    """Rows of the sheets (one, or all) of workbooks (file, content), as feeds.read_sheet gives them, and due_date_typed.

    Rows from 2 on, the first nine columns as text: whole numbers without a point, others as Python shows them, truth
    values as True and False, days with their time. A due date that is a day goes to due_date_typed instead. Where rows are
    left out, as workbooks do with blank ones, one blank row stands for them, for it ends a group. An empty cell is null. A
    file that is no workbook fails the job."""
    packed = workbooks.select("file", "content").mapInArrow(_take_apart, SHEETS)
    if sheet is not None:
        packed = packed.where(F.col("sheet") == sheet)
    return packed.repartition("file", "sheet").mapInArrow(_rows, ROWS)


def read_workbooks(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """The sheets of all *.xlsx files of a folder, or of one file; file is its full path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return sheet_rows(files.select(F.col("path").alias("file"), "content"), sheet)
