"""Record-level operators and scans held against golden tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import enrich, policy
from ..sources import scans
from .golden import _values

RETRY = [  # status, version, when, due
    (None, None, None, True), ("done", 1, None, True), ("done", 2, None, False), ("404", None, None, False), ("文字なし", None, "2026-01-01", True),
    ("文字なし", None, "2026-01-20", False), ("大きすぎる", None, None, True), ("timeout", None, "2026-01-31", True),
]


def retry_golden(spark, sf_dir):
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(RETRY)], "id int, status string, version int, `when` string")
    due = policy.retry_due(F.col("status"), F.col("version"), F.col("when").cast("date"), F.lit("2026-02-01").cast("date"), 2)
    return df.select("id", due.alias("due"))


STATUS = [  # draft, earlier, approved, expert stops, operator, state
    ("取ってよい", None, True, False, "x", "取ってよい"), ("取ってよい", None, None, False, "x", "規約未確定"), ("取ってよい", None, True, True, "x", "規約未確定"),
    ("取ってよい", None, True, False, "", "規約未確定"), ("取ってはいけない", None, True, False, "x", "取ってはいけない"), (None, "規約未確定", True, False, "x", "規約未確定"), (None, "取ってよい", True, False, "x", "未確認"),
]


def status_golden(spark, sf_dir):
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(STATUS)], "id int, draft string, earlier string, approved boolean, stops boolean, operator string")
    missing = policy.gaps({"operator": F.col("operator")})
    return df.select("id", policy.official_status(F.col("draft"), F.col("earlier"), F.col("approved"), F.col("stops"), missing).alias("state"), F.array_join(missing, ",").alias("missing"))


VERDICTS = [  # terms, robots, visible, total, fixed, verdict
    ("取ってはいけない", "許可", 90, 100, 20, "拒否"), (None, "許可", 90, 100, 20, "未確認"), ("取ってよい", "拒否", 90, 100, 20, "拒否"), ("取ってよい", None, 90, 100, 20, "未確認"),
    ("取ってよい", "許可", None, None, None, "未確認"), ("取ってよい", "許可", 10, 100, 20, "技術的に取得困難"), ("取ってよい", "許可", 90, 100, 9, "技術的に取得困難"), ("取ってよい", "許可", 90, 100, 20, "許可"),
]


def obtainability_golden(spark, sf_dir):
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(VERDICTS)], "id int, terms string, robots string, visible int, total int, fixed int")
    return df.select("id", policy.obtainability(*(F.col(c) for c in ("terms", "robots", "visible", "total", "fixed"))).alias("verdict"))


def usable_rows(spark, sf_dir):
    rows = [("a", "web", "u", "d"), ("b", "web", "u", "d"), ("c", "api", "u", "d"), ("d", "web", None, "d"), ("e", "web", "u", "d"), ("f", "web", "u", "d")]
    cards = [("a", "web", "可", "使える"), ("c", "web", "可", "使える"), ("d", "web", "可", "使える"), ("e", "web", "不可", "使える"), ("f", "web", "可", None)]
    r = spark.createDataFrame(rows, "route string, route_kind string, url string, taken_on string")
    c = spark.createDataFrame(cards, "route string, route_kind string, continued string, product string")
    return policy.usable_rows(r, c).select("route", "reason")


RECORDS = [  # key, operator, address, kind, screen, cut
    ("1", "海鳴商事㈱", "海辺市なぎさ1丁目2番", "corp", "海鳴商事㈱", "海辺市なぎさ1丁目2番"), ("2", "海辺太郎", "海辺市なぎさ1丁目2番", "individual", "個人", "海辺市なぎさ1丁目"),
    ("3", "", "海辺町329-1", "individual", "", "海辺町"), ("4", None, "海辺町329-1", "none", "", "海辺町329-1"),
]


def record_privacy(spark, sf_dir):
    """F36, applied twice: the second time changes nothing."""
    df = spark.createDataFrame([(*r[:3], {"設置者（氏名）": "海辺花子", "設置者対応": "海辺花子", "備考": "x"}) for r in RECORDS], "key string, operator string, address string, extra map<string,string>")
    out = enrich.apply_privacy(enrich.apply_privacy(df))
    return out.select("key", "operator_kind", "operator", "address", F.col("extra")["設置者（氏名）"].alias("party"), F.col("extra")["設置者対応"].alias("other"))


def enriched_from_documents(spark, sf_dir):
    rows = [("1", "s", ["http://x/a.pdf", "http://x/b.pdf"], "", "元の", None), ("2", "s", ["http://x/c.pdf"], "", "", None), ("3", "s", ["http://x/b.pdf"], "町", "", 500)]
    read = [("s", "b", "海辺町", "海鳴㈱", "1,234㎡"), ("s", "c", "なぎさ町", "", "99㎡")]
    df = spark.createDataFrame(rows, "key string, source string, docs array<string>, address string, operator string, area_m2 int")
    out = enrich.from_documents(df, spark.createDataFrame(read, "source string, stem string, address string, applicant string, area string"), {"address": "address", "operator": "applicant"})
    return out.select("key", "address", "operator", "area_m2", F.array_join("from_ocr", ",").alias("from_ocr"))


GAZETTE = ["目次", "新設に関する届出 ......2", "都市計画 ......3", "令和5年6月20日 兵 庫 県 公 報", "12", "新設に関する届出", "大規模小売店舗立地法（平成10年法律第91号）第5条", "1 店舗名 みなと店", "変更に関する届出", "大規模小売店舗立地法（平成10年法律第91号）第6条", "1 店舗名", "なぎさ店"]


def gazette_sections(spark, sf_dir):
    df = spark.createDataFrame([("i1", n, x) for n, x in enumerate(GAZETTE)], "issue string, line_no int, line string")
    s = scans.gazette_sections(df, r"^(新設|変更)に関する届出\s*$", "法律第91号")
    g = s.groupBy("issue", "section_no", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("lines"))
    return g.select("section_no", "kind", scans.numbered_items(F.col("lines"))["店舗名"].alias("store"))


FLOOR = (
    '<option data-connection-value="floorId=3/shopName=みなと/value=mapA1" data-detail-url="/shop/77/"><option data-connection-value="value=mapA1" data-detail-url="/shop/78" data-shop-name="なぎさ" data-floor-id="3">'
    '<option data-connection-value="value=mapB2" data-shop-name="北階段"><option data-connection-value="value=mapC3" data-detail-url="/shop/77" data-shop-name="みなと"><option data-connection-value="value=other">'
)


def floor_map(spark, sf_dir):
    o = scans.floor_options(spark.createDataFrame([("p", FLOOR)], "page string, html string"))
    return o.select("map_id", "floor_id", "name", "shop_id", "area")


def floor_classes(spark, sf_dir):
    o = scans.floor_options(spark.createDataFrame([("p", FLOOR)], "page string, html string"))
    return scans.map_shop_classes(o)


CDX = [("u", "20260105000000", "d1", "200"), ("u", "20260120000000", "d1", "200"), ("u", "20260203000000", "d2", "200"), ("u", "20260301000000", "d2", "404"), ("u", "20260310000000", "d1", "200")]


def archive_backfill(spark, sf_dir):
    c = spark.createDataFrame(CDX, "url string, ts string, digest string, status string")
    have = spark.createDataFrame([("u", dt.date(2026, 1, 5), "d9")], "url string, day date, digest string")
    done = spark.createDataFrame([("u", "20260310000000")], "url string, ts string")
    todo = scans.backfill(scans.archive_snapshots(c, True), have, done, 5).select(F.lit("digest").alias("how"), "ts", "digest")
    return todo.unionByName(scans.archive_snapshots(c, False).select(F.lit("month").alias("how"), "ts", "digest"))


def catalogue_answers(spark, sf_dir):
    rows = [(1, '{"result":{"count":2,"results":[{"title":"t","resources":[{"name":"n","format":"CSV","url":"http://x"}]}]}}'), (2, '{"result":{"count":0,"results":[]}}'), (3, "<html>")]
    df = spark.createDataFrame(rows, "id int, body string")
    n = scans.catalogue_resources(df).groupBy("id").agg(F.count("*").alias("resources"))
    return df.select("id", scans.catalogue_count(F.col("body")).alias("count")).join(n, "id", "left")


QUERIES = {f.__name__: f for f in (retry_golden, status_golden, obtainability_golden, usable_rows, record_privacy, enriched_from_documents, gazette_sections, floor_map, floor_classes, archive_backfill, catalogue_answers)}

ORACLES = {
    "retry_golden": _values(["id", "due"], [(i, r[3]) for i, r in enumerate(RETRY)]),
    "status_golden": _values(["id", "state", "missing"], [(i, r[5], "" if r[4] else "operator") for i, r in enumerate(STATUS)]),
    "obtainability_golden": _values(["id", "verdict"], [(i, r[5]) for i, r in enumerate(VERDICTS)]),
    "usable_rows": _values(["route", "reason"], [("a", ""), ("b", "no card for the route"), ("c", "route kind differs"), ("d", "origin lacks url"), ("e", "not cleared for continued use"), ("f", "route not for products")]),
    "record_privacy": _values(["key", "operator_kind", "operator", "address", "party", "other"], [(k, kind, screen, cut, "個人", "海辺花子") for k, _, _, kind, screen, cut in RECORDS]),
    "enriched_from_documents": _values(["key", "address", "operator", "area_m2", "from_ocr"], [("1", "海辺町", "元の", 1234, "address,area_m2"), ("2", "なぎさ町", "", None, "address"), ("3", "町", "海鳴㈱", 500, "operator")]),
    "gazette_sections": _values(["section_no", "kind", "store"], [(1, "新設", "みなと店"), (2, "変更", "なぎさ店")]),
    "floor_map": _values(["map_id", "floor_id", "name", "shop_id", "area"], [("mapA1", "3", "みなと", "77", None), ("mapA1", "3", "なぎさ", "78", None), ("mapB2", None, "北階段", None, "階段"), ("mapC3", None, "みなと", "77", None)]),
    "floor_classes": _values(["class", "n"], [("no shop", 1), ("one shop", 1), ("several shops", 1), ("shop on several maps", 1)]),
    "archive_backfill": _values(["how", "ts", "digest"], [("digest", "20260203000000", "d2"), ("month", "20260105000000", "d1"), ("month", "20260203000000", "d2"), ("month", "20260310000000", "d1")]),
    "catalogue_answers": _values(["id", "count", "resources"], [(1, 2, 1), (2, 0, None), (3, None, None)]),
}
