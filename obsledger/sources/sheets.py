"""Sheet grids to records (S11-S13, S16, S22, S31-S32, S38): header search, two-level heads, history columns, quarantine.

A grid is (file, sheet, row_no, cells array<string>), as the xlsx sources give it.
"""

from __future__ import annotations

import io
import re
import zipfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions import dates, text

#: Kind of notice by what a file's name holds, in order (fixed values): pattern, article, kind.
FILE_KINDS = [
    (r"shinsetsu|-5-1", "第5条第1項", "新設"), (r"haishi|-6-5", "第6条第5項", "廃止"), (r"fusoku|husoku", "附則第5条第1項", "変更"),
    (r"henkou6-2|_6-2|-6-2", "第6条第2項", "変更"), (r"-6-1", "第6条第1項", "変更"),
]
#: Labels of files that hold data, and of those that do not (fixed values).
FILE_IS_DATA = r"概要|一覧|リスト|届出状況|縦覧|告示"
FILE_NOT_DATA = r"手引|要綱|しおり|フロー|意見書|様式|記入例|チェックリスト|指針"


def with_header(grid: DataFrame, must: str, within: int = 10) -> DataFrame:
    """Rows below each sheet's header as (file, sheet, row_no, cells, header); the header is the first of its
    first ``within`` rows with a cell that holds ``must``; its names lose white space and line breaks. Sheets
    without one yield nothing: :func:`headless` lists them."""
    head = grid.where((F.col("row_no") < within) & F.exists("cells", lambda c: c.contains(must)))
    head = head.groupBy("file", "sheet").agg(F.min_by(F.transform("cells", text.squash), "row_no").alias("header"), F.min("row_no").alias("_h"))
    return grid.join(head, ["file", "sheet"]).where("row_no > _h").drop("_h")


def headless(grid: DataFrame, must: str, within: int = 10) -> DataFrame:
    """Sheets in which no header was found."""
    found = grid.where((F.col("row_no") < within) & F.exists("cells", lambda c: c.contains(must))).select("file", "sheet").distinct()
    return grid.select("file", "sheet").distinct().join(found, ["file", "sheet"], "left_anti")


def record(rows: DataFrame) -> DataFrame:
    """Each row as a map of header -> cleaned cell (the first of equal heads counts), and ``history``: the non-empty
    cells of the columns 履歴1, 履歴2, ... in order."""
    pairs = F.arrays_zip(F.col("header").alias("k"), F.slice("cells", 1, F.greatest(F.size("header"), F.lit(1))).alias("v"))
    first = F.filter(pairs, lambda p, i: (p["k"] != "") & (F.array_position("header", p["k"]) == i + 1))
    cells = F.map_from_entries(F.transform(first, lambda p: F.struct(p["k"], F.coalesce(dates.clean(p["v"]), F.lit("")))))
    history = F.transform(F.filter(pairs, lambda p: p["k"].rlike(r"^履歴\d+$") & (F.coalesce(p["v"], F.lit("")) != "")), lambda p: p["v"])
    return rows.select("file", "sheet", "row_no", cells.alias("record"), history.alias("history"))


def two_level(header: Column, below: Column) -> Column:
    """A head of two rows: where the lower one names a column, that name counts."""
    return F.zip_with(header, below, lambda a, b: F.when(F.coalesce(text.squash(b), F.lit("")) != "", text.squash(b)).otherwise(a))


def kind_of_file(name: Column) -> tuple[Column, Column]:
    """(article, kind) by the file's name; ('', 不明) if it tells nothing."""
    article, kind = F.lit(""), F.lit("不明")
    for pattern, a, k in reversed(FILE_KINDS):
        article, kind = F.when(name.rlike(pattern), a).otherwise(article), F.when(name.rlike(pattern), k).otherwise(kind)
    return article, kind


def day_in_name(name: Column) -> Column:
    """the day in a file's name (yyyymmdd of this century), null without one."""
    p = r"(20\d{2})(\d{2})(\d{2})"
    return F.when(F.regexp_extract(name, p, 0) != "", F.concat_ws("-", *(F.regexp_extract(name, p, k) for k in (1, 2, 3))))


def gazette_index(rows: DataFrame, titled: list[str], first: str, last: str) -> tuple[DataFrame, DataFrame]:
    """(issues, set aside) of index sheets. Every sheet gives issues, only ``titled`` ones titles. Rows whose
    day lies outside ``first``..``last`` are set aside, not dropped; rows without a day or number are no entries."""
    r = record(rows)
    pick = lambda *names: F.coalesce(*(F.nullif(F.col("record")[n], F.lit("")) for n in names), F.lit(""))
    r = r.select("file", "sheet", dates.gazette_iso(pick("発行日", "発行年月日")).alias("day"), text.issue_number(pick("公報番号", "公報号数", "号数")).alias("no"), F.when(F.col("sheet").isin(*titled), text.collapse(pick("件名"))).otherwise("").alias("title"))
    r = r.where((F.col("day") != "") & (F.col("no") != "") & (~F.col("sheet").isin(*titled) | (F.col("title") != "")))
    ok = F.col("day").between(first, last)
    return r.where(ok), r.where(~ok & F.col("sheet").isin(*titled))


def issue_dates(issues: DataFrame) -> DataFrame:
    """One day per regular issue number: the one with most titles, ties to the oldest; extras keep their own."""
    n = issues.groupBy("no", "day").agg(F.count_if(F.col("title") != "").alias("titles"))
    extra = F.col("no").startswith("g")
    best = n.where(~extra).groupBy("no").agg(F.min_by("day", F.struct(-F.col("titles"), "day")).alias("day"), F.sum("titles").alias("titles"))
    return best.unionByName(n.where(extra))


def text_file(path: Column) -> tuple[Column, Column]:
    """(day, issue number) of a stored text's name ``yyyy-mm-dd-<no>.txt``; null if it cannot be read."""
    p = r"(\d{4}-\d{2}-\d{2})-(g?\d+)\.txt(?:\.gz)?$"
    return F.nullif(F.regexp_extract(path, p, 1), F.lit("")), F.nullif(F.regexp_extract(path, p, 2), F.lit(""))


def file_links(links: DataFrame, ending: str, rule: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(links to files, those set aside with a reason); each target once, the first in page order. A label
    that names a form or guide is set aside, as is one that fails ``rule`` (a source's own pattern) or, without
    one, names no data."""
    hit = links.where(F.col("target").rlike(ending))
    rank = F.row_number().over(Window.partitionBy("page_id", "target").orderBy("pos"))
    hit = hit.withColumn("_k", rank).where("_k = 1").drop("_k")
    own = F.coalesce(rule, F.lit(FILE_IS_DATA)) if rule is not None else F.lit(FILE_IS_DATA)
    reason = F.when(F.col("label").rlike(FILE_NOT_DATA), "form or guide").when(~F.regexp_like("label", own), "label names no data")
    out = hit.withColumn("reason", reason)
    return out.where("reason IS NULL").drop("reason"), out.where("reason IS NOT NULL")


def safe_name(url: Column) -> Column:
    """a file name made of an address."""
    base = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1)
    return F.substring(F.regexp_replace(F.when(base == "", "file").otherwise(base), r"[^A-Za-z0-9._-]", "_"), 1, 100)


def archive_names(content: bytes) -> list[str]:
    """Names in a zip file; those without the UTF-8 mark are read as cp932, or left where that fails."""
    out = []
    for info in zipfile.ZipFile(io.BytesIO(content)).infolist():
        name = info.filename
        if not info.flag_bits & 0x800:
            try:
                name = name.encode("cp437").decode("cp932")
            except UnicodeError:
                name = info.filename
        out.append(name)
    return out


@udtf(returnType="name string")
class zip_entries:  # noqa: N801
    def eval(self, content: bytes):
        for name in archive_names(bytes(content)):
            yield (name,)


def preferred(own: DataFrame, built_in: DataFrame) -> DataFrame:
    """A list from its table if that has rows, else the built-in one; ``used`` names which it was."""
    none = own.limit(1).agg(F.count("*") == 0)
    return own.withColumn("used", F.lit("table")).unionByName(built_in.withColumn("used", F.lit("built-in")).where(none.scalar()))


def write_mart(df: DataFrame, path: str, single: bool = False) -> None:
    """A mart as JSON lines; ``single`` gathers a small one in one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").json(path)


def tidy_reading(v: Column) -> Column:
    """optical reading tidied: gaps between digits, ruling debris, a form's label in front."""
    out = F.regexp_replace(F.coalesce(v, F.lit("")), r"(?U)(?<=[0-9０-９])\s+(?=[0-9０-９])", "")
    out = F.regexp_replace(out, r"(?U)\s*[|｜]\s*.*$", "")
    out = F.regexp_replace(out, r"(?U)^(?:氏名又は名称|名称|氏名|住所|所在地)\s*[:：]?\s*", "")
    return F.regexp_replace(out, "^[ 　:：]+|[ 　:：]+$", "")


def version_key(name: str) -> list[int]:
    """K6: the numbers of a name, for sorting versions."""
    return [int(x) for x in re.findall(r"\d+", name)]
