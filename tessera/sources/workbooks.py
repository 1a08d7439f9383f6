"""Excel workbooks (.xlsx) as a folder job.

No workbook library is installed; an .xlsx file is a zip of XML parts, read
and written here with the standard library inside Spark tasks:

* reading: ``binaryFile`` lists the folder, each task unzips its files and
  emits the sheet's rows as arrays of cell texts, some thousand rows at a time;
  the header row names the columns (``Unnamed: i`` for cells beyond it) and the
  text is typed like CSV input; numbers with a date format become date texts;
* writing: every partition makes its own workbook(s), each at most 1,048,575
  data rows (the sheet limit), which Spark's own writer puts into a staging
  folder that is then swapped in.  An empty table gives one book with the header.

Rows are zipped as they come and unzipped as they are read: a task holds one
zipped book (a new one is begun at ``BOOK_BYTES``), never a book's rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import io
import math
import re
import time
import uuid
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import text_tables
from tessera.sources.staging import swap_in, write_contents

MAX_SHEET_ROWS = 1_048_576          # rows per sheet, header included
READ_ROWS = 5_000                   # rows handed to Spark at a time
BOOK_BYTES = 64 << 20               # zipped bytes of a sheet after which the next row begins a new book
SHEET_BYTES = 1 << 30               # the same for the XML of a sheet (a part of 2 GB needs a zip that Excel warns of)
# Number formats of the file format that show dates or times.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
# Day numbers count from here (from 1 March 1900 on; the format's 1900 has a 29 February).
DAY_ZERO = dt.datetime(1899, 12, 30)
DAY_ZERO_1904 = dt.datetime(1904, 1, 1)
FIRST_DAY = dt.datetime(1900, 3, 1)
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def column_letters(i: int) -> str:
    """0 -> A, 25 -> Z, 26 -> AA (bijective base 26)."""
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def column_index(ref: str) -> int:
    """'B7' -> 1."""
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group(0):
        n = n * 26 + (ord(ch) - 64)
    return n - 1


# ---------------------------------------------------------------- reading --

def _sheet_part(z: zipfile.ZipFile, sheet_name: str | None) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.find(f"{_NS}sheets")
    chosen = None
    for sh in sheets:
        if sheet_name is None or sh.get("name") == sheet_name:
            chosen = sh.get(f"{_REL_NS}id")
            break
    if chosen is None:
        raise ValueError(f"worksheet {sheet_name!r} not found")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iter(f"{_PKG_REL_NS}Relationship"):
        if rel.get("Id") == chosen:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    raise ValueError(f"worksheet {sheet_name!r} has no part")


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out, root = [], None
    with z.open("xl/sharedStrings.xml") as part:
        for event, el in ET.iterparse(part, ("start", "end")):
            if event == "start":
                root = el if root is None else root
            elif el.tag == f"{_NS}si":
                # plain text or runs of it; readings of East Asian text (rPh) are no part of the value
                out.append(_decoded("".join(t.text or "" for path in (f"{_NS}t", f"{_NS}r/{_NS}t")
                                            for t in el.findall(path))))
                root.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Cell styles whose number format shows a date or time."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    dates = set(DATE_FORMATS)
    for fmt in root.iter(f"{_NS}numFmt"):
        # quoted texts, escaped characters and [conditions] are no date letters
        code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", fmt.get("formatCode", "")).lower()
        if re.search("[dmyhs]", code) and "general" not in code:
            dates.add(int(fmt.get("numFmtId")))
    styles = root.find(f"{_NS}cellXfs")
    return set() if styles is None else {i for i, xf in enumerate(styles) if int(xf.get("numFmtId", 0)) in dates}


def _day_zero(z: zipfile.ZipFile) -> dt.datetime:
    pr = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_NS}workbookPr")
    return DAY_ZERO_1904 if pr is not None and pr.get("date1904") in ("1", "true") else DAY_ZERO


def _date_text(serial: str, zero: dt.datetime) -> str | None:
    """'2024-01-31 10:00:00' for a day number (to the microsecond)."""
    days = float(serial)
    if zero is DAY_ZERO and days < 60:
        days += 1  # days before the format's 29 February 1900
    whole = math.floor(days)
    try:
        return (zero + dt.timedelta(days=whole, microseconds=round((days - whole) * 86_400_000_000))).isoformat(sep=" ")
    except OverflowError:
        return None


def sheet_rows(content, sheet_name: str | None = "Sheet1"):
    """Yield (row_number, [cell text or None, ...], [is a date, ...]) of one workbook's sheet.

    ``content`` is the book's bytes or an Arrow buffer of them.  A row or cell
    without a reference follows the one before it.
    """
    import pyarrow as pa
    with zipfile.ZipFile(pa.BufferReader(content)) as z:
        strings, dates, zero = _shared_strings(z), _date_styles(z), _day_zero(z)
        with z.open(_sheet_part(z, sheet_name)) as sheet:
            number, parents = 0, []
            for event, el in ET.iterparse(sheet, ("start", "end")):
                if event == "start":
                    if el.tag == f"{_NS}sheetData":
                        parents.append(el)
                    continue
                if el.tag != f"{_NS}row":
                    continue
                cells: dict[int, str | None] = {}
                dated = set()
                number, at = int(el.get("r", number + 1)), -1
                for c in el.iter(f"{_NS}c"):
                    at, t = column_index(c.get("r")) if c.get("r") else at + 1, c.get("t", "n")
                    if t == "inlineStr":
                        val = _decoded("".join(x.text or "" for x in c.iter(f"{_NS}t")))
                    else:
                        v = c.find(f"{_NS}v")
                        val = None if v is None else v.text
                        if val is None or t == "e":
                            val = None
                        elif t == "s":
                            val = strings[int(val)]
                        elif t == "b":
                            val = "True" if val == "1" else "False"
                        elif t == "n" and int(c.get("s", 0)) in dates:
                            val = _date_text(val, zero)
                            dated.add(at)
                    cells[at] = val
                width = max(cells) + 1 if cells else 0
                yield number, [cells.get(i) for i in range(width)], [i in dated for i in range(width)]
                el.clear()
                for data in parents:  # rows that were read leave the tree
                    data.clear()


def read_xlsx(spark: SparkSession, path: str, sheet_name: str | None = "Sheet1",
              schema: T.StructType | None = None) -> DataFrame:
    """``pd.read_excel(path, sheet_name=...)`` over a workbook file or folder.

    Without a schema, a column of date cells only is a timestamp column.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
             .option("recursiveFileLookup", True).load(path).select("path", "content"))

    def parse(batches):
        import itertools

        import pyarrow as pa
        types = {"path": pa.string(), "row": pa.int64(), "cells": pa.list_(pa.string()),
                 "dated": pa.list_(pa.bool_()), "header": pa.bool_()}
        for b in batches:
            for p, content in zip(*(b.column(c) for c in ("path", "content"))):
                rows = sheet_rows(content.as_buffer(), sheet_name)
                first = True
                while chunk := list(itertools.islice(rows, READ_ROWS)):
                    columns = ([p.as_py()] * len(chunk), *zip(*chunk), [first and i == 0 for i in range(len(chunk))])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())],
                                                     names=list(types))
                    first = False
    cells = files.mapInArrow(parse, "path string, row long, cells array<string>, dated array<boolean>, "
                                    "header boolean").checkpoint(eager=True)
    headers = cells.filter("header").select("cells").distinct().limit(2).collect()
    if not headers:
        return spark.createDataFrame([], schema or T.StructType([]))
    if len(headers) > 1:
        raise ValueError("workbooks in the folder have different header rows")
    names = list(headers[0]["cells"])
    names += [None] * (cells.agg(F.max(F.size("cells"))).first()[0] - len(names))
    names = [n if n is not None else f"Unnamed: {i}" for i, n in enumerate(names)]
    data = cells.filter(~F.col("header"))
    # a caller's filter may be evaluated beside this one: a header is no value in either
    text = data.select(*[F.when(~F.col("header"), F.get("cells", F.lit(i))).alias(n) for i, n in enumerate(names)])
    if schema is None:
        schema = text_tables.infer_types(text_tables.na_to_null(text))
        # a column whose values are all date cells
        r = data.agg(*[F.bool_and(F.when(F.get("cells", F.lit(i)).isNotNull(), F.get("dated", F.lit(i))))
                       .alias(f"d{i}") for i in range(len(names))]).first()
        schema = T.StructType([T.StructField(f.name, T.TimestampType() if r[i] else f.dataType)
                               for i, f in enumerate(schema.fields)])
    return text_tables.typed(text, schema, text_tables.NA_VALUES)


# ---------------------------------------------------------------- writing --

_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/styles.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
    '</Types>')
# Cell styles: 0 plain, 1 a date, 2 a date with its time.
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/>'
    '<numFmt numFmtId="165" formatCode="yyyy\\-mm\\-dd\\ hh:mm:ss"/></numFmts>'
    '<fonts count="1"><font/></fonts>'
    '<fills count="2"><fill/><fill><patternFill patternType="gray125"/></fill></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/>'
    '<xf numFmtId="165" applyNumberFormat="1"/></cellXfs></styleSheet>')
_ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
    'relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
_WB_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
    'relationships/worksheet" Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
    'relationships/styles" Target="styles.xml"/></Relationships>')


def _workbook_xml(sheet_name: str) -> str:
    return ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
            '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
            'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
            f'<sheets><sheet name="{escape(sheet_name, {chr(34): "&quot;"})}" sheetId="1" '
            'r:id="rId1"/></sheets></workbook>')


_CODE = re.compile(r"[\x00-\x08\x0b-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")
_CODED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _decoded(text: str) -> str:
    return _CODED.sub(lambda m: chr(int(m[1], 16)), text)


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, int):
        return f'<c r="{ref}"><v>{v}</v></c>'
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return ""
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    if isinstance(v, decimal.Decimal):
        return f'<c r="{ref}"><v>{v:f}</v></c>'
    if isinstance(v, dt.date):
        style = 2 if isinstance(v, dt.datetime) else 1
        v = v.replace(tzinfo=None) if style == 2 else dt.datetime(v.year, v.month, v.day)
        if v >= FIRST_DAY:  # earlier days have no agreed number: text
            gone = v - DAY_ZERO
            days = gone.days + (gone.seconds * 1_000_000 + gone.microseconds) / 86_400_000_000
            return f'<c r="{ref}" s="{style}"><v>{days!r}</v></c>'
    text = v.isoformat(sep=" ") if hasattr(v, "isoformat") else str(v)
    # characters that XML cannot hold, and what looks like their code
    text = _CODE.sub(lambda m: f"_x{ord(m[0][0]):04X}_" + m[0][1:], text)
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


class Workbook:
    """A workbook with a header row, zipped row by row."""

    def __init__(self, columns: list[str], sheet_name: str = "Sheet1"):
        self.letters = [column_letters(i) for i in range(len(columns))]
        self.rows = self.size = 0  # rows and bytes of the sheet so far, with the header
        self.buf = io.BytesIO()
        self.zip = zipfile.ZipFile(self.buf, "w", zipfile.ZIP_DEFLATED)
        self.zip.writestr("[Content_Types].xml", _CONTENT_TYPES)
        self.zip.writestr("_rels/.rels", _ROOT_RELS)
        self.zip.writestr("xl/workbook.xml", _workbook_xml(sheet_name))
        self.zip.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        self.zip.writestr("xl/styles.xml", _STYLES)
        sheet = zipfile.ZipInfo("xl/worksheets/sheet1.xml", time.localtime()[:6])
        sheet.compress_type, sheet.external_attr = zipfile.ZIP_DEFLATED, 0o600 << 16
        self.sheet = self.zip.open(sheet, "w")
        self._put('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
                  '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                  '<sheetData>')
        self.add(columns)

    def _put(self, xml: str) -> None:
        raw = xml.encode()
        self.sheet.write(raw)
        self.size += len(raw)

    def add(self, row) -> None:
        self.rows += 1
        i = self.rows
        self._put(f'<row r="{i}">' + "".join(_cell(f"{L}{i}", v) for L, v in zip(self.letters, row)) + "</row>")

    def full(self) -> bool:
        """Whether the next row should go to another book, for the size of this one."""
        return self.size >= SHEET_BYTES or self.buf.tell() >= BOOK_BYTES

    def content(self) -> bytes:
        """The finished book."""
        self._put("</sheetData></worksheet>")
        self.sheet.close()
        self.zip.comment = b"\n"  # the line feed that write_contents() asks for
        self.zip.close()
        return self.buf.getvalue()


def workbook_bytes(columns: list[str], rows, sheet_name: str = "Sheet1") -> bytes:
    """One workbook with a header row and ``rows`` (sequences of Python values)."""
    book = Workbook(columns, sheet_name)
    for row in rows:
        book.add(row)
    return book.content()


def write_xlsx(df: DataFrame, path: str, sheet_name: str = "Sheet1",
               rows_per_book: int = MAX_SHEET_ROWS - 1) -> str:
    """``to_excel(path, sheet_name=..., index=False)`` as a folder of workbooks."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    columns = df.columns

    def books(batches):
        import pyarrow as pa
        book = None

        def packed():
            return pa.RecordBatch.from_pydict({"content": [book.content()]})

        for b in batches:  # Arrow values: whole numbers with gaps stay whole
            for row in zip(*(c.to_pylist() for c in b.columns)):
                book = book or Workbook(columns, sheet_name)
                book.add(row)
                if book.rows > rows_per_book or book.full():
                    yield packed()
                    book = None
        if book:
            yield packed()

    if not write_contents(df.mapInArrow(books, "content binary"), "content", staging, ".xlsx"):
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration()).delete(
            spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging), True)
        header = spark.createDataFrame([(workbook_bytes(columns, [], sheet_name),)], "content binary")
        write_contents(header, "content", staging, ".xlsx")
    swap_in(spark, staging, path)
    return path
