"""Acquisition policy as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAY, MUST_NOT, UNDECIDED, UNREAD = "取ってよい", "取ってはいけない", "規約未確定", "未確認"
UNKNOWN = "分からない"


def gaps(required: dict[str, Column]) -> Column:
    """The names of all required values that are missing or blank, in order."""
    return F.array_compact(F.array(*(F.when(v.isNull() | (F.trim(v.cast("string")) == ""), k) for k, v in required.items())))


def official_status(draft: Column, earlier: Column, approved: Column, expert_stops: Column, missing: Column) -> Column:
    """G1: one of four states. A draft of *may* needs approval, no objection and no gap, else it is undecided;
    without a draft the earlier refusal stands and nothing is upgraded."""
    ok = F.coalesce(approved, F.lit(False)) & ~F.coalesce(expert_stops, F.lit(False)) & (F.size(missing) == 0)
    return (
        F.when(draft.isin(MUST_NOT, UNDECIDED), draft).when(draft == MAY, F.when(ok, MAY).otherwise(UNDECIDED))
        .when(earlier.isin(MUST_NOT, UNDECIDED), earlier).otherwise(UNREAD)
    )


def blocking_reasons(checks: dict[str, Column]) -> Column:
    """Every reason that blocks (true or unknown), in order; an empty array lets pass."""
    return F.array_compact(F.array(*(F.when(F.coalesce(v, F.lit(True)), k) for k, v in checks.items())))


def obtainability(terms: Column, robots: Column, visible: Column, total: Column, fixed_urls: Column) -> Column:
    """Refused, unread, hard to get, or allowed. Unread and hard to get never mix."""
    return (
        F.when(terms == MUST_NOT, "拒否").when(terms.isNull() | (terms != MAY), UNREAD).when(robots == "拒否", "拒否").when(robots.isNull() | (robots != "許可"), UNREAD)
        .when(total.isNull(), UNREAD).when((total > 0) & (visible < total * 0.15), "技術的に取得困難").when(F.coalesce(fixed_urls, F.lit(0)) < 10, "技術的に取得困難").otherwise("許可")
    )


def data_origin(json_links: Column, marks: Column, visible: Column, total: Column, shapes: Column, fixed_urls: Column, images: Column) -> Column:
    """Where a page's data come from, strongest evidence first; *other* is not *none*."""
    return (
        F.when(json_links > 0, "公開JSON・API").when(marks > 0, "CMS等の構造化データ").when((total > 0) & (visible < total * 0.15), "その他")
        .when((shapes >= 10) | (fixed_urls >= 10), "静的HTML").when((images >= 20) & (shapes < 3), "画像").otherwise("その他")
    )


def usable_rows(rows: DataFrame, cards: DataFrame) -> DataFrame:
    """Rows with the first reason why a product may not use them, '' if it may.

    ``rows``: route, route_kind, and whatever the origin needs (url, taken_on); ``cards``: one per route.
    """
    j = rows.join(cards.select(F.col("route"), F.col("route_kind").alias("_kind"), F.col("continued").alias("_cont"), F.col("product").alias("_prod"), F.lit(True).alias("_card")), "route", "left")
    missing = gaps({c: F.col(c) for c in ("route", "route_kind", "url", "taken_on")})
    reason = (
        F.when(F.size(missing) > 0, F.concat(F.lit("origin lacks "), F.array_join(missing, ","))).when(F.col("_card").isNull(), "no card for the route")
        .when(~F.col("_kind").eqNullSafe(F.col("route_kind")), "route kind differs").when(~F.col("_cont").eqNullSafe(F.lit("可")), "not cleared for continued use")
        .when(~F.col("_prod").eqNullSafe(F.lit("使える")), "route not for products").otherwise("")
    )
    return j.withColumn("reason", reason).drop("_kind", "_cont", "_prod", "_card")


def retry_due(status: Column, version: Column, when: Column, today: Column, current: int, recheck_days: int = 30) -> Column:
    """Is another attempt due? Unknown: yes; done: only if made by an older version; 404: never; a lasting
    failure: after thirty days; anything else: next run."""
    lasting = status.rlike("月ページに号が無い|月ページが一覧に無い|文字なし|大きすぎる")
    return (
        F.when(status.isNull(), True).when(status.startswith("done"), F.coalesce(version, F.lit(1)) < current).when(status.contains("404"), False)
        .when(lasting, when.isNull() | (F.datediff(today, when) >= recheck_days)).otherwise(True)
    )


def transfer_marks(size: Column, declared: Column, encoding: Column, body: Column, listed: Column, counted: Column) -> dict[str, Column]:
    """Marks of a transfer, each true, false or unknown: all bytes, end of page, number of entries."""
    return {
        "bytes": F.when(declared.isNull() | (F.coalesce(encoding, F.lit("")) != ""), None).otherwise(size == declared),
        "end": F.lower(F.rtrim(body)).endswith("</html>"),
        "count": F.when(counted.isNull(), None).otherwise(listed == counted),
    }


def check_arguments(given: list[str], known: list[str]) -> None:
    """Unknown arguments stop a run."""
    unknown = [a for a in given if a.split("=")[0] not in known]
    if unknown:
        raise ValueError(f"unknown arguments: {', '.join(unknown)}")


def exhaustive(value: Column, allowed: list[str], what: str) -> Column:
    """the value, or an error for one outside the list."""
    return F.when(value.isin(*allowed), value).otherwise(F.raise_error(F.concat(F.lit(f"unknown {what}: "), F.coalesce(value, F.lit("null")))).cast("string"))


def leaked_tokens(row: Column, tokens: list[str]) -> Column:
    """the forbidden tokens that a row's JSON holds."""
    text = F.to_json(row)
    return F.array_compact(F.array(*(F.when(text.contains(t), t) for t in tokens)))
