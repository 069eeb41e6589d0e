"""Flat-sheet ``.xlsx`` reading as a Spark job.

``binaryFile`` lists the workbooks (one row per file); ``mapInPandas`` parses
each one inside a task with the standard library (an xlsx file is a zip of
XML parts) and streams rows out in batches. An xlsx sheet holds at most
1,048,576 rows, so one file per task is a bounded unit of work; many files
spread over many tasks.

Only what a flat snapshot sheet needs is read: the first worksheet, shared
and inline strings, numbers, booleans, and numbers styled as dates (which
come out as ``YYYY-MM-DD`` or ``YYYY-MM-DD HH:MM:SS`` text). Every column is
returned as text, named by the header row and bound to the requested schema
by position.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
# Built-in number formats that display dates (ECMA-376 part 1, 18.8.30).
DATE_FORMAT_IDS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
EXCEL_EPOCH = _dt.datetime(1899, 12, 30)
BATCH = 10_000


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as f:
        for _, el in ET.iterparse(f):
            if el.tag == NS + "si":
                out.append("".join(t.text or "" for t in el.iter(NS + "t")))
                el.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indices of cell styles whose number format shows a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = set()
    fmts = root.find(NS + "numFmts")
    if fmts is not None:
        for nf in fmts.findall(NS + "numFmt"):
            code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
            if any(ch in code for ch in "ymd"):
                custom.add(int(nf.get("numFmtId")))
    styles = set()
    xfs = root.find(NS + "cellXfs")
    if xfs is not None:
        for i, xf in enumerate(xfs.findall(NS + "xf")):
            fid = int(xf.get("numFmtId", "0"))
            if fid in DATE_FORMAT_IDS or fid in custom:
                styles.add(i)
    return styles


def _first_sheet(z: zipfile.ZipFile) -> str:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = wb.find(NS + "sheets").find(NS + "sheet")
    rid = sheet.get(REL_NS + "id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for r in rels.findall(PKG_REL_NS + "Relationship"):
        if r.get("Id") == rid:
            target = r.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    return "xl/worksheets/sheet1.xml"


def _cell_text(c, strings, date_styles) -> str | None:
    t = c.get("t")
    if t == "inlineStr":
        return "".join(x.text or "" for x in c.iter(NS + "t"))
    v = c.find(NS + "v")
    if v is None or v.text is None:
        return None
    raw = v.text
    if t == "s":
        return strings[int(raw)]
    if t == "b":
        return "TRUE" if raw == "1" else "FALSE"
    if t in ("str", "e"):
        return raw
    if int(c.get("s", "0")) in date_styles:
        ts = EXCEL_EPOCH + _dt.timedelta(days=float(raw))
        ts = ts.replace(microsecond=0) if ts.microsecond < 500_000 else \
            (ts + _dt.timedelta(seconds=1)).replace(microsecond=0)
        return ts.strftime("%Y-%m-%d") if ts.time() == _dt.time(0) else ts.strftime("%Y-%m-%d %H:%M:%S")
    f = float(raw)
    return str(int(f)) if f.is_integer() and "e" not in raw.lower() else raw


def iter_sheet_rows(data: bytes):
    """Rows of the first sheet as lists of text (NULL for empty cells)."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        strings = _shared_strings(z)
        date_styles = _date_styles(z)
        with z.open(_first_sheet(z)) as f:
            for _, el in ET.iterparse(f):
                if el.tag != NS + "row":
                    continue
                cells: dict[int, str | None] = {}
                for i, c in enumerate(el.findall(NS + "c")):
                    ref = c.get("r")
                    cells[_col_index(ref) if ref else i] = _cell_text(c, strings, date_styles)
                el.clear()
                if cells:
                    width = max(cells) + 1
                    yield [cells.get(i) for i in range(width)]


def _parse_files(names: list[str]):
    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                rows = iter_sheet_rows(bytes(content))
                next(rows, None)  # header row; columns bind by position
                buf = []
                for r in rows:
                    if all(v is None or str(v).strip() == "" for v in r):
                        continue
                    r = (r + [None] * len(names))[: len(names)]
                    buf.append(r)
                    if len(buf) >= BATCH:
                        yield pd.DataFrame(buf, columns=names, dtype=object)
                        buf = []
                if buf:
                    yield pd.DataFrame(buf, columns=names, dtype=object)
    return run


def read_xlsx(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the first sheet of each workbook under ``path``, as text columns of ``schema``."""
    names = schema.fieldNames()
    text_schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # binary files are not split: a large workbook gets a task of its own and
    # small ones are packed up to spark.sql.files.maxPartitionBytes per task
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
             .option("recursiveFileLookup", "true").load(path).select("content"))
    return files.mapInPandas(_parse_files(names), text_schema)


# --- writing (fixtures and tests) ---------------------------------------------------------

def _xml_escape(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def xlsx_bytes(header: list[str], rows: list[list]) -> bytes:
    """A minimal workbook: one sheet, inline strings, numbers, dates as ``yyyy-mm-dd`` styled serials."""
    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        if isinstance(v, (_dt.date, _dt.datetime)):
            d = v if isinstance(v, _dt.datetime) else _dt.datetime(v.year, v.month, v.day)
            serial = (d - EXCEL_EPOCH).total_seconds() / 86400
            return f'<c r="{ref}" s="1"><v>{serial}</v></c>'
        return f'<c r="{ref}" t="inlineStr"><is><t>{_xml_escape(str(v))}</t></is></c>'

    def col(i):
        s = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            s = chr(65 + r) + s
        return s

    body = []
    for ri, r in enumerate([header, *rows], start=1):
        body.append(f'<row r="{ri}">' + "".join(cell(f"{col(ci)}{ri}", v) for ci, v in enumerate(r)) + "</row>")
    sheet = ('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/'
             'spreadsheetml/2006/main"><sheetData>' + "".join(body) + "</sheetData></worksheet>")
    parts = {
        "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
        "_rels/.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": sheet,
    }
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buf.getvalue()


def write_xlsx(path: str, header: list[str], rows: list[list]) -> None:
    with open(path, "wb") as f:
        f.write(xlsx_bytes(header, rows))


XLSX_MAX_ROWS = 1_048_575   # a sheet holds 1,048,576 rows including the header


def write_xlsx_files(df: DataFrame, path: str) -> DataFrame:
    """Write each partition of ``df`` as one workbook under ``path``; returns (path, rows) per file.

    Lazy: run it with an action (the result is one row per file). Each task
    writes its own file through ``pyarrow.fs`` (local, HDFS or object store),
    so nothing passes through the driver. Partitions must stay below the
    sheet limit; repartition first for larger frames.
    """
    names = df.columns

    def write(batches):
        import uuid

        import pyarrow.fs as pafs
        uri = path
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        elif "://" not in uri:
            uri = "file://" + uri
        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        rows = []
        for pdf in batches:
            rows.extend([None if (isinstance(v, float) and v != v) else v for v in r]
                        for r in pdf.itertuples(index=False, name=None))
        if not rows:
            return
        if len(rows) > XLSX_MAX_ROWS:
            raise ValueError(f"{len(rows)} rows do not fit one sheet; repartition before writing")
        target = f"{root}/part-{uuid.uuid4().hex}.xlsx"
        with fs.open_output_stream(target) as f:
            f.write(xlsx_bytes(names, rows))
        yield pd.DataFrame({"path": [target], "rows": [len(rows)]})

    return df.mapInPandas(write, "path string, rows long")
