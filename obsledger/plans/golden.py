"""Functions held against golden tables: inputs and expected values are literals, written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import address, dates, privacy, text, web, zoning
from ..operators import cells, places
from ..session import table
from ..sources import html_tables, robots


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def _values(columns: list[str], rows: list[tuple]) -> str:
    """A table of literals for the oracle."""
    body = ", ".join("(" + ", ".join(map(_sql, r)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(columns)})"


CORP = [  # a, b, same company, a has co-owners
    ("海鳴商事(株)", "海鳴商事株式会社", True, False),
    ("㈱海鳴商事", "株式会社海鳴商事", True, False),
    ("ＵＭＩリース(株)", "UMIリース株式会社", True, False),
    ("海鳴建設(株)　ほか2者", "海鳴建設株式会社　ほか２者", True, True),
    ("海鳴電鉄株式会社", "海鳴ホールディングス株式会社", False, False),
    ("株式会社", "株式会社", False, False),
    ("海鳴開発株式会社ほか3者", "海鳴開発株式会社", False, True),
]


def same_corp_pairs(spark, sf_dir):
    df = spark.createDataFrame([r[:2] for r in CORP], "a string, b string")
    return df.select("a", "b", privacy.same_corp(F.col("a"), F.col("b")).alias("same"), privacy.co_owners(F.col("a")).alias("co_owners"))


PARTIES = [  # name, disclosed, kind, on screen, in index
    ("株式会社うみなり", True, "corp", "株式会社うみなり", "株式会社うみなり"),
    ("(有）うみなり", True, "corp", "(有）うみなり", "(有）うみなり"),
    ("ウミナリ　ほか", True, "corp", "ウミナリ　ほか", "ウミナリ　ほか"),
    ("海辺太郎", True, "individual", "個人", ""),
    ("海辺　花子　ほか２者", True, "individual", "個人", ""),
    ("中村", True, "individual", "個人", ""),
    ("海辺町教育委員会", True, "corp", "海辺町教育委員会", "海辺町教育委員会"),
    ("（未定）", True, "individual", "（未定）", ""),
    ("個人", True, "individual", "個人", ""),
    ("", True, "individual", "", ""),
    ("うみなり", False, "undisclosed", "個人", ""),
    (None, True, "none", "", ""),
]


def corp_and_redact(spark, sf_dir):
    df = spark.createDataFrame([r[:2] for r in PARTIES], "name string, disclosed boolean")
    n = F.col("name")
    return df.select("name", "disclosed", privacy.party_kind(n, F.col("disclosed")).alias("kind"), privacy.redact_name(n).alias("screen"), privacy.party_for_index(n).alias("index_name"))


ADDRESSES = [  # address, cut to the town, granularity
    ("海辺市なぎさ九丁目300番１ほか", "海辺市なぎさ九丁目", "…番 まで"),
    ("海辺区なぎさ一丁目1663番1外7筆", "海辺区なぎさ一丁目", "…番 まで"),
    ("海辺市なぎさ下町３７７番地１ほか", "海辺市なぎさ下町", "地番（…番地…）"),
    ("海辺区なぎさ1-1-1", "海辺区なぎさ1丁目", "略記（印が無いが数字はある）"),
    ("海辺町329-1", "海辺町", "略記（印が無いが数字はある）"),
    ("海辺市なぎさ一丁目2番3号", "海辺市なぎさ一丁目", "住居表示（…番…号）"),
    ("海辺市なぎさ町", "海辺市なぎさ町", "町名まで"),
    ("", "", "住所が空"),
]


def address_granularity(spark, sf_dir):
    df = spark.createDataFrame([(r[0],) for r in ADDRESSES], "addr string")
    cut = privacy.redact_addr(F.col("addr"), F.lit("individual"))
    return df.select("addr", cut.alias("cut"), (privacy.redact_addr(cut, F.lit("individual")) == cut).alias("stable"), (privacy.redact_addr(F.col("addr"), F.lit("corp")) == F.col("addr")).alias("corp_whole"), address.granularity(F.col("addr")).alias("class"))


CODES = [("大阪府", "大阪市北区", "27127"), ("大阪府", "大阪市", "27100"), ("東京都", "北区", "13117"), ("兵庫県", "西宮市", "28204"), ("大阪府", "豊中市", "27203"), ("大阪府", "堺市", "27140"), ("兵庫県", "猪名川町", "28301"), ("岡山県", "備前市", "33211"), ("兵庫県", "川辺郡川西町", "28302")]
TOWNS = [("28204", "上ケ原2番町"), ("28204", "甲子園"), ("27203", "緑丘"), ("27203", "緑丘南"), ("27203", "本町")]
KEYS = [  # prefecture, city, address, key, town key, shown, error
    ("大阪府", "大阪市北区", "梅田一丁目２番３号", "27127|梅田1-2-3", "27127|梅田1", "大阪市北区梅田1-2-3", ""),
    ("大阪府", "大阪市北区", "大阪市北区梅田1-1-1 みなとビル3F", "27127|梅田1-1-1", "", "大阪市北区梅田1-1-1みなとビル3F", ""),
    ("兵庫県", "西宮市", "大字上ケ原　二番町3-5", "28204|上ケ原2番町3-5", "28204|上ケ原2番町", "西宮市上ケ原2番町3-5", ""),
    ("兵庫県", "西宮市", "甲子園口5-6", "28204|甲子園口5-6", "", "西宮市甲子園口5-6", ""),
    ("大阪府", "豊中市", "服部一丁目８４７番地の１ほか", "27203|服部1-847-1", "27203|服部1", "豊中市服部1-847-1ほか", ""),
    ("大阪府", "豊中市", "服部847番地の1", "27203|服部847-1", "", "豊中市服部847-1", ""),
    ("大阪府", "豊中市", "緑丘3番5号", "27203|緑丘3-5", "", "豊中市緑丘3-5", ""),
    ("大阪府", "豊中市", "緑丘南3番5号", "27203|緑丘南3-5", "27203|緑丘南", "豊中市緑丘南3-5", ""),
    ("大阪府", "大阪市北区", "堺市西区鳳1-1", "", "", "大阪市北区", "address names 堺市"),
    ("大阪府", "豊中市", "", "", "", "豊中市", ""),
    ("兵庫県", "川西町", "西二十三丁目十二三番地の4", "28302|西23-13-4", "28302|西23", "川西町西23-13-4", ""),
    ("兵庫県", "川辺郡猪名川町", "三田十丁目", "28301|三田10", "28301|三田10", "川辺郡猪名川町三田10", ""),
]


def _gazetteer(spark):
    return spark.createDataFrame(CODES, "pref string, city string, code string"), spark.createDataFrame(TOWNS, "code string, town string")


def address_normalize(spark, sf_dir):
    """Comparable keys of addresses, numerals and units in many spellings."""
    df = spark.createDataFrame([r[:3] for r in KEYS], "pref string, city string, raw string")
    n = places.address_keys(df, *_gazetteer(spark), addr="raw")
    return n.select("pref", "city", "raw", "keys.addr_key", "keys.addr_key_town", "keys.addr", "keys.error")


PLACES = [  # address, prefecture and city of the source, then prefecture, city, rest, precision, source
    ("大阪府大阪市北区梅田1", "", "", "大阪府", "大阪市北区", "梅田1", "区", "住所"),
    ("兵庫県川辺郡猪名川町松尾台", "", "", "兵庫県", "猪名川町", "松尾台", "市", "住所"),
    ("岡山県備前市東片上", "大阪府", "大阪市", "岡山県", "備前市", "東片上", "市", "住所"),
    ("北区　梅田一丁目", "大阪府", "大阪市", "大阪府", "大阪市北区", "梅田一丁目", "区", "台帳"),
    ("北区梅田一丁目", "", "", "東京都", "北区", "梅田一丁目", "区", "住所"),
    ("矢田五丁目", "大阪府", "大阪市", "大阪府", "大阪市", "矢田五丁目", "市", "台帳"),
    ("矢田五丁目", "", "", "", "", "矢田五丁目", "", ""),
    ("篠山市山内町64番３", "兵庫県", "", "兵庫県", "", "篠山市山内町64番３", "", ""),
    ("", "大阪府", "豊中市", "大阪府", "豊中市", "", "市", "台帳"),
]


def municipality_split(spark, sf_dir):
    """The municipality off the front of an address; the hint narrows and never widens."""
    df = spark.createDataFrame([r[:3] for r in PLACES], "addr string, pref string, city string")
    p = places.split_city(df, _gazetteer(spark)[0])
    return p.select("addr", "pref", "city", F.col("place.pref").alias("in_pref"), F.col("place.city").alias("in_city"), "place.rest", "place.precision", "place.source")


def customer_addresses(spark, sf_dir):
    """The keys of an address made from each customer, half of them with the municipality in front."""
    codes, towns = _gazetteer(spark)
    k = F.col("c_custkey")
    listed = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("pref", "city"), c[:2], strict=True))) for c in CODES[3:6]))
    ten, one = F.floor(k / 10) % 10, k % 10
    numeral = F.concat(F.when(ten == 0, "").when(ten == 1, "十").otherwise(F.concat(F.substring(F.lit("〇一二三四五六七八九"), ten.cast("int") + 1, F.lit(1)), F.lit("十"))), F.when((one == 0) & (ten > 0), "").otherwise(F.substring(F.lit("〇一二三四五六七八九"), one.cast("int") + 1, F.lit(1))))
    c = table(spark, sf_dir, "customer").select(k, F.get(listed, (k % 3).cast("int")).alias("c"), numeral.alias("numeral"), (k % 89 + 1).alias("lot"), (k % 23).alias("house"))
    where = F.when(F.col("c_custkey") % 2 == 0, F.concat("c.pref", "c.city")).otherwise("")
    raw = F.when(F.col("c_custkey") % 5 == 0, F.concat(where, F.lit("大字本町 "), "lot", F.lit("番地の"), "house")).otherwise(F.concat(where, F.lit("本町"), "numeral", F.lit("丁目"), "lot", F.lit("番"), "house", F.lit("号ほか")))
    keys = places.address_keys(c.select("c_custkey", "c.pref", "c.city", raw.alias("addr")), codes, towns)
    return places.split_city(keys, codes).select("c_custkey", "keys.city_code", "keys.addr_key", "keys.addr_key_town", "keys.error", F.col("place.city").alias("in_city"), "place.source")


ZONES = [  # cell, zones, unread
    ("第一種住居、\n第二種中高層\n住居専用地域", "第一種住居地域,第二種中高層住居専用地域", ""),
    ("商業\n第一種住居", "商業地域,第一種住居地域", ""),
    ("第１種低層住居／準工業", "第一種低層住居専用地域,準工業地域", ""),
    ("近隣商業、不明地域、近隣商業地域", "近隣商業地域", "不明地域"),
    ("", "", ""),
]


def zoning_normalize(spark, sf_dir):
    df = spark.createDataFrame([(r[0],) for r in ZONES], "cell string").withColumn("z", zoning.normalize_zoning(F.col("cell")))
    return df.select("cell", F.array_join("z.zones", ",").alias("zones"), F.array_join("z.unread", ",").alias("unread"))


DATES = [  # text, notice date, gazette date, last day of a range
    ("令和8年4月23日", "2026-04-23", "", None),
    ("令和元年６月30日", "2019-06-30", "", None),
    ("令和8(2026)年4月2日", "2026-04-02", "", None),
    ("2026年7月27日", "2026-07-27", "2026-07-27", None),
    ("受理 2021/4/7", "2021-04-07", "", None),
    ("H30.4.1", "2018-04-01", "", None),
    ("令和6年5月28日～ 同年9月30日", "2024-05-28", "", "2024-09-30"),
    ("46007", None, "2025-12-16", None),
    ("2463", None, "", None),
    ("なし", None, "", None),
]


def era_dates(spark, sf_dir):
    df = spark.createDataFrame([(r[0],) for r in DATES], "raw string")
    return df.select("raw", dates.to_iso(F.col("raw")).alias("iso"), dates.gazette_iso(F.col("raw")).alias("gazette"), dates.span(F.col("raw"))[1].alias("until"))


ARTICLES = [  # text, article, kind of the article, kind by words
    ("廃止の届出（法第6条第5項関係）", "第6条第5項", "廃止", "廃止"),
    ("届出（5条1項関係）", "第5条第1項", "新設", ""),
    ("附則5条1項の変更", "附則第5条第1項", "変更", "変更"),
    ("法第8条第7項", "第8条第7項", "変更", ""),
    ("承継について", "第11条第3項", "承継", "承継"),
    ("中規模小売店舗の新設", "中規模", "中規模", "中規模"),
    ("届出状況について", "", "不明", ""),
    ("第12条の公表", "", "不明", ""),
]


def article_kind(spark, sf_dir):
    df = spark.createDataFrame([(r[0],) for r in ARTICLES], "raw string").withColumn("article", text.article_in(F.col("raw")))
    return df.select("raw", "article", text.means_of(F.col("article")).alias("kind"), text.kind_of_words(F.col("raw")).alias("by_words"))


TITLES = [  # title, kind, topic, issue label, number
    ("大規模小売店舗の新設に関する届出", "新設", "大店立地法", "423", "423"),
    ("県の意見に対して講ずる措置", "措置", "", "号外", "g1"),
    ("県の意見 の概要", "県の意見", "", "第2号外", "g2"),
    ("都市計画法による工事完了公告", "その他", "工事完了公告", "-", ""),
    ("特定盛土の規制", "その他", "盛土規制法・宅造", "第１２号外", "g12"),
]


def gazette_titles(spark, sf_dir):
    df = spark.createDataFrame([(r[0], r[3]) for r in TITLES], "title string, label string")
    return df.select("title", text.title_kind(F.col("title")).alias("kind"), text.title_topic(F.col("title")).alias("topic"), "label", text.issue_number(F.col("label")).alias("issue"))


PAGE = (
    "<h3>届出状況</h3><table><tr><th colspan='2'>店舗名称</th><th>届出日</th><th>謎の列</th></tr>"
    "<tr><td>みなと店</td><td>本館</td><td rowspan='2'>令和8年1月2日</td><td>あ</td></tr><tr><td>なぎさ店</td><td></td><td>い</td></tr>"
    "<tr><td colspan='4'>注：この表は参考です</td></tr></table><h2>意見書</h2><table><tr><th>店舗名称</th><th>届出日</th></tr><tr><td>しお店</td><td>2026年1月3日</td></tr></table>"
)


def html_table_golden(spark, sf_dir):
    pages = spark.createDataFrame([("p1", PAGE)], "page string, html string")
    rows = pages.lateralJoin(html_tables.html_rows(F.col("html").outer(), F.lit("http://a.example/")))
    n = html_tables.notices(rows.drop("html"))
    return n.select("page", "table_no", "row_no", F.col("record")["store"].alias("store"), F.col("record")["date"].alias("day"), F.col("extra")["謎の列"].alias("extra"), F.coalesce("reason", F.lit("")).alias("reason"))


ROBOTS = [("a.example", "﻿User-agent: *\nDisallow: /p\nAllow: /p/open\nCrawl-delay: 7\n\nUser-agent: ledgerbot\nDisallow: /q$\n"), ("b.example", "User-agent: *\nDisallow:\n"), ("c.example", "User-agent: other\nuser-agent: *\nDisallow: /x*y\nAllow: /x*y\n")]
VISITS = [  # agent, host, path, allowed, rule
    ("plainbot", "a.example", "/p/x", False, "/p"), ("plainbot", "a.example", "/p/open/1", True, "/p/open"), ("plainbot", "a.example", "/z", True, None),
    ("ledgerbot", "a.example", "/p/x", True, None), ("ledgerbot", "a.example", "/q", False, "/q$"), ("ledgerbot", "a.example", "/q/1", True, None),
    ("plainbot", "b.example", "/any", True, None), ("plainbot", "c.example", "/xay", True, "/x*y"),
]


def robots_eval(spark, sf_dir):
    rules = spark.createDataFrame(ROBOTS, "host string, body string").lateralJoin(robots.robots_rules(F.col("body").outer())).drop("body")
    out = None
    for agent in ("plainbot", "ledgerbot"):
        urls = spark.createDataFrame([(h, p) for a, h, p, *_ in VISITS if a == agent], "host string, path string")
        one = robots.decide(urls, rules, agent).select(F.lit(agent).alias("agent"), "host", "path", "allowed", "rule")
        out = one if out is None else out.unionByName(one)
    return out


STATES = [  # status, content type, body, state
    (404, "text/html", "", "pass"), (503, "", "", "busy"), (403, "", "", "unknown"), (200, "text/html", "User-agent: *", "unknown"),
    (200, "text/plain", "", "pass"), (200, "text/plain", "hello", "unknown"), (200, "text/plain", "User-agent: *\nDisallow: /", "rules"), (None, None, None, "unknown"),
]


def robots_state(spark, sf_dir):
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(STATES)], "id int, status int, kind string, body string")
    return df.select("id", robots.response_state(F.col("status"), F.col("kind"), F.col("body")).alias("state"))


RANGES = [  # url, approved, inside
    ("https://a.example/x/1", "https://a.example/x/", True), ("https://a.example/x", "https://a.example/x/", False), ("https://a.example/x?q=1", "https://a.example/x", True),
    ("https://b.example/x/1", "https://a.example/x/", False), ("https://a.example/s?q=1", "https://a.example/s?q=1", True), ("https://a.example/s?q=2", "https://a.example/s?q=1", False),
]


def url_range(spark, sf_dir):
    df = spark.createDataFrame([r[:2] for r in RANGES], "url string, approved string")
    return df.select("url", "approved", web.in_range(F.col("url"), F.col("approved")).alias("inside"))


MASKS = [  # n, kinds, count, label
    (0, "", 0, "0"), (1, "", None, "1-2"), (2, "corp", 2, "2"), (2, "corp,individual", None, "1-2"), (1, "undisclosed", None, "1-2"), (1, "none", 1, "1"), (3, "individual", 3, "3"),
]


def mask_golden(spark, sf_dir):
    df = spark.createDataFrame([r[:2] for r in MASKS], "n long, kinds string")
    k = F.when(F.col("kinds") == "", F.array().cast("array<string>")).otherwise(F.split("kinds", ","))
    return df.select("n", "kinds", cells.masked(F.col("n"), k).alias("count"), cells.count_label(F.col("n"), k).alias("label"))


STORES = [  # name, key, facility key, without state, had one
    ("ｍｅｇａみなと", "megaみなと", "megaみなと", "ｍｅｇａみなと", False),
    ("（仮称）みなとモール", "みなとモル", "みなとモル", "（仮称）みなとモール", False),
    ("(株)みなと", "みなと", "みなと", "(株)みなと", False),
    ("なぎさ食堂（改装中）", "なぎさ食堂改装中", "なぎさ食堂", "なぎさ食堂", True),
]


def store_names(spark, sf_dir):
    df = spark.createDataFrame([(r[0],) for r in STORES], "name string")
    out, had = privacy.without_state(F.col("name"))
    return df.select("name", privacy.norm_store(F.col("name")).alias("store_key"), privacy.facility_key(F.col("name")).alias("facility"), out.alias("plain"), had.alias("had_state"))


QUERIES = {f.__name__: f for f in (same_corp_pairs, corp_and_redact, address_granularity, address_normalize, municipality_split, customer_addresses, zoning_normalize, era_dates, article_kind, gazette_titles, html_table_golden, robots_eval, robots_state, url_range, mask_golden, store_names)}

ORACLES = {
    "same_corp_pairs": _values(["a", "b", "same", "co_owners"], CORP),
    "corp_and_redact": _values(["name", "disclosed", "kind", "screen", "index_name"], PARTIES),
    "address_granularity": _values(["addr", "cut", "stable", "corp_whole", "class"], [(a, c, True, True, g) for a, c, g in ADDRESSES]),
    "municipality_split": _values(["addr", "pref", "city", "in_pref", "in_city", "rest", "precision", "source"], PLACES),
    "customer_addresses": """
WITH c AS (SELECT c_custkey, c_custkey % 3 AS w, c_custkey % 89 + 1 AS lot, c_custkey % 23 AS house, c_custkey % 100 AS chome FROM customer),
k AS (SELECT *, CASE w WHEN 0 THEN '28204' WHEN 1 THEN '27203' ELSE '27140' END AS code, CASE w WHEN 0 THEN '西宮市' WHEN 1 THEN '豊中市' ELSE '堺市' END AS city FROM c)
SELECT c_custkey, code AS city_code, code || '|本町' || CASE WHEN c_custkey % 5 = 0 THEN lot || '-' || house ELSE chome || '-' || lot || '-' || house END AS addr_key,
       CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN w = 1 THEN '27203|本町' ELSE '' END ELSE code || '|本町' || chome END AS addr_key_town, '' AS error, city AS in_city,
       CASE WHEN c_custkey % 2 = 0 THEN '住所' ELSE '台帳' END AS source FROM k""",
    "address_normalize": _values(["pref", "city", "raw", "addr_key", "addr_key_town", "addr", "error"], KEYS),
    "zoning_normalize": _values(["cell", "zones", "unread"], ZONES),
    "era_dates": _values(["raw", "iso", "gazette", "until"], DATES),
    "article_kind": _values(["raw", "article", "kind", "by_words"], ARTICLES),
    "gazette_titles": _values(["title", "kind", "topic", "label", "issue"], TITLES),
    "html_table_golden": _values(["page", "table_no", "row_no", "store", "day", "extra", "reason"], [
        ("p1", 0, 1, "みなと店", "令和8年1月2日", "あ", ""), ("p1", 0, 2, "なぎさ店", "令和8年1月2日", "い", ""), ("p1", 0, 3, None, None, None, "note across columns"), ("p1", 1, 1, None, None, None, "not a notice table"),
    ]),
    "robots_eval": _values(["agent", "host", "path", "allowed", "rule"], VISITS),
    "robots_state": _values(["id", "state"], [(i, r[3]) for i, r in enumerate(STATES)]),
    "url_range": _values(["url", "approved", "inside"], RANGES),
    "mask_golden": _values(["n", "kinds", "count", "label"], MASKS),
    "store_names": _values(["name", "store_key", "facility", "plain", "had_state"], STORES),
}
