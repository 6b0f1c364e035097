"""xlsx files as a Spark data source (S7, S30, P10): one row per sheet row, everything a string.

``spark.dataSource.register(XlsxSource)``, then ``spark.read.format("xlsx").load(glob)``. Each file is one
partition; workbooks are zip files of XML, read with the standard library.
"""

from __future__ import annotations

import glob
import io
import re
import zipfile
from datetime import date, timedelta
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.functions import udtf

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Built-in number formats that are dates (fixed values).
_DATE_FORMATS = {14, 15, 16, 17, 22, 27, 28, 29, 30, 31, 34, 35, 36, 50, 51, 52, 53, 54, 55, 56, 57, 58}


def _plain(si) -> str:
    """Text of a string item; phonetic readings are left out."""
    direct = [t.text or "" for t in si.findall("m:t", _NS)]
    runs = [t.text or "" for r in si.findall("m:r", _NS) for t in r.findall("m:t", _NS)]
    return "".join(direct + runs)


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _date(value: str) -> str:
    n = int(float(value))
    return (date(1899, 12, 30) + timedelta(days=n)).isoformat() if n >= 1 else value


def sheets(raw: bytes):
    """(sheet, row_no, cells) of a workbook; rows are dense, numbers formatted as dates become yyyy-mm-dd."""
    z = zipfile.ZipFile(io.BytesIO(raw))
    names = set(z.namelist())
    xml = lambda p: ElementTree.fromstring(z.read(p))
    shared = [_plain(s) for s in xml("xl/sharedStrings.xml").findall("m:si", _NS)] if "xl/sharedStrings.xml" in names else []
    dated = set()
    if "xl/styles.xml" in names:
        st = xml("xl/styles.xml")
        own = {int(f.get("numFmtId")) for f in st.iterfind("m:numFmts/m:numFmt", _NS) if re.search("[ymdge]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")))}
        dated = {i for i, x in enumerate(st.iterfind("m:cellXfs/m:xf", _NS)) if int(x.get("numFmtId", 0)) in _DATE_FORMATS | own}
    targets = {r.get("Id"): r.get("Target") for r in xml("xl/_rels/workbook.xml.rels")}
    for s in xml("xl/workbook.xml").iterfind("m:sheets/m:sheet", _NS):
        target = targets[s.get(_REL)].lstrip("/")
        root = xml(target if target.startswith("xl/") else f"xl/{target}")
        for n, row in enumerate(root.iterfind("m:sheetData/m:row", _NS)):
            cells: dict[int, str] = {}
            for k, c in enumerate(row.findall("m:c", _NS)):
                v, kind = c.find("m:v", _NS), c.get("t")
                text = "" if v is None else v.text or ""
                if kind == "s" and text:
                    text = shared[int(text)]
                elif kind == "inlineStr":
                    text = _plain(c.find("m:is", _NS))
                elif text and kind is None and int(c.get("s", 0)) in dated:
                    text = _date(text)
                cells[_column(c.get("r")) if c.get("r") else k] = text
            yield s.get("name"), n, [cells.get(i, "") for i in range(max(cells, default=-1) + 1)]


@udtf(returnType="sheet string, row_no int, cells array<string>")
class xlsx_rows:  # noqa: N801
    """S7 over ``binaryFile`` content: reads wherever Spark reads, one workbook a call."""

    def eval(self, content: bytes):
        yield from sheets(bytes(content))


def read_workbooks(spark, path: str):
    """(path, sheet, row_no, cells) of all workbooks that ``path`` matches, on any storage that Spark reads."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.lateralJoin(xlsx_rows(F.col("content").outer())).drop("content")


class XlsxSource(DataSource):
    """For workbooks on a path that every executor mounts; :func:`read_workbooks` reads from any storage."""

    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        return "file string, sheet string, row_no int, cells array<string>"

    def reader(self, schema):
        return _Reader(self.options["path"])


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.removeprefix("file://")

    def partitions(self):
        return [InputPartition(p) for p in sorted(glob.glob(self.path))]

    def read(self, partition):
        with open(partition.value, "rb") as f:
            for sheet, n, cells in sheets(f.read()):
                yield partition.value, sheet, n, cells


def coerce_dates(cells: DataFrame, is_date: Column, as_date: Column, share: float = 0.6, least: int = 3) -> DataFrame:
    """P10: in a column (sheet, col) of at least ``least`` non-empty values of which ``share`` are dates, the
    others become dates too where they can; other columns stay as they are."""
    w = Window.partitionBy("file", "sheet", "col")
    some = F.when(F.col("value") != "", is_date.cast("int"))
    ok = (F.count(some).over(w) >= least) & (F.avg(some).over(w) >= share)
    return cells.withColumn("value", F.when(ok & ~is_date, F.coalesce(F.when(as_date != "", as_date), F.col("value"))).otherwise(F.col("value")))


def code_table(rows: DataFrame) -> DataFrame:
    """Rows (row_no, code, pref, city) -> five-digit codes; a ward takes the name of the last city before it
    that shares its first three digits; prefecture rows go."""
    r = rows.where(F.length("code") >= 5).withColumn("code5", F.substring("code", 1, 5)).withColumn("lead", F.substring("code", 1, 3))
    w = Window.partitionBy("lead").orderBy("row_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parent = F.last(F.when(F.col("city").endswith("市"), F.col("city")), ignorenulls=True).over(w)
    name = F.when(F.col("city").endswith("区") & parent.isNotNull(), F.concat(parent, F.col("city"))).otherwise(F.col("city"))
    return r.select("row_no", "code5", "pref", name.alias("name"), "city").where(F.coalesce("city", F.lit("")) != "").select(F.col("code5").alias("code"), "pref", F.col("name").alias("city"))
