"""Address rules: numerals, municipalities, towns, zones."""

import pytest
from pyspark.sql import functions as F

from obsledger.functions import address as ad
from obsledger.functions import dates, text, zoning
from obsledger.operators import places

CODES = [("大阪府", "大阪市北区", "27127"), ("大阪府", "大阪市", "27100"), ("東京都", "北区", "13117"), ("兵庫県", "猪名川町", "28301"), ("岡山県", "備前市", "33211"), ("大阪府", "豊中市", "27203"), ("大阪府", "太子町", "27381"), ("兵庫県", "太子町", "28464"), ("兵庫県", "赤穂郡上郡町", "28481")]
TOWNS = [("27203", t) for t in ("緑丘", "緑丘南", "本町")]


@pytest.fixture(scope="module")
def dims(spark):
    return spark.createDataFrame(CODES, "pref string, city string, code string"), spark.createDataFrame(TOWNS, "code string, town string")


def test_numerals(spark):
    want = {"一": 1, "九": 9, "十": 10, "十二": 12, "二十": 20, "四十七": 47, "九十九": 99, "〇": 0, "十二三": 13, "一二": 2}
    got = spark.createDataFrame([(k,) for k in want], "s string").select("s", ad.kanji_number(F.col("s")).alias("n")).collect()
    assert {r.s: r.n for r in got} == want


def test_cleaning(spark):
    want = {"大字本町　十二三番地の１": "本町13番地の1", "三田市一番町": "三田市1番町", "鳳東町七丁７３３－４": "鳳東町7丁733-4", "２４６３の１": "2463-1", None: "", "十三": "十三"}
    got = spark.createDataFrame([(k,) for k in want], "s string").select("s", ad.clean(F.col("s")).alias("a")).collect()
    assert {r.s: r.a for r in got} == want


def test_municipalities(spark, dims):
    cases = [
        ("大阪府大阪市北区梅田1", "", "", ("大阪府", "大阪市北区", "梅田1", "区", "住所")), ("岡山県備前市東片上", "大阪府", "大阪市", ("岡山県", "備前市", "東片上", "市", "住所")),
        ("北区梅田一丁目", "大阪府", "大阪市", ("大阪府", "大阪市北区", "梅田一丁目", "区", "台帳")), ("矢田五丁目", "大阪府", "大阪市", ("大阪府", "大阪市", "矢田五丁目", "市", "台帳")),
        ("矢田五丁目", "", "", ("", "", "矢田五丁目", "", "")), ("北区梅田一丁目", "", "", ("東京都", "北区", "梅田一丁目", "区", "住所")),
        ("太子町鵤123番", "大阪府", "", ("大阪府", "太子町", "鵤123番", "市", "住所")), ("太子町鵤123番", "兵庫県", None, ("兵庫県", "太子町", "鵤123番", "市", "住所")),
        (None, None, None, ("", "", "", "", "")), ("川辺郡猪名川町松尾台", "兵庫県", "", ("兵庫県", "猪名川町", "松尾台", "市", "住所")),
    ]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "n int, addr string, pref string, city string")
    got = {r.n: tuple(r.place) for r in places.split_city(df, dims[0]).collect()}
    assert got == {k: c[3] for k, c in enumerate(cases)}
    assert places.split_city(df.where("false"), dims[0]).count() == 0


def test_codes_with_and_without_county(spark, dims):
    df = spark.createDataFrame([("兵庫県", "川辺郡猪名川町"), ("兵庫県", "上郡町"), ("兵庫県", "無い市"), ("兵庫県", ""), ("兵庫県", None), (None, "太子町")], "pref string, city string")
    assert [r.city_code for r in sorted(places.with_code(df, dims[0]).collect(), key=lambda r: (r.pref or "", r.city or ""))] == ["", "", "", "28481", "28301", ""]


def test_towns_never_guess(spark, dims):
    want = {"緑丘南3-5": "27203|緑丘南", "緑丘北3-5": "", "本町": "27203|本町", "緑丘3番5号": "", "本町3番5号": "27203|本町", "緑丘南": "27203|緑丘南", "岡山県備前市1": ""}
    df = spark.createDataFrame([("大阪府", "豊中市", a) for a in want], "pref string, city string, addr string")
    got = {r.addr: r["keys"] for r in places.address_keys(df, *dims).collect()}
    assert {a: k.addr_key_town for a, k in got.items()} == want
    assert got["岡山県備前市1"].error == "address names 岡山県" and got["岡山県備前市1"].addr_key == ""


def test_normalizing_twice_changes_nothing(spark, dims):
    raws = ["本町一丁目2番3号", "本町847番地の1", "緑丘南3-5", "", None]
    df = spark.createDataFrame([("大阪府", "豊中市", a) for a in raws], "pref string, city string, addr string")
    one = places.address_keys(df, *dims).select("pref", "city", F.col("keys.addr").alias("addr"), F.col("keys.addr_key").alias("was"))
    assert all((r["keys"].addr, r["keys"].addr_key) == (r.addr, r.was) for r in places.address_keys(one, *dims).collect())


def test_places_of_records(spark):
    sources = spark.createDataFrame([("one", "兵庫県", None, False), ("two", "大阪府", "堺市", True)], "source string, pref string, city string, wards boolean")
    rows = [(1, "one", "", "愛媛県松山市1", "姫路店", ""), (2, "one", None, "川辺郡猪名川町2", "x", None), (3, "one", "", "姫路", "x", ""), (4, "two", "", "西区鳳1", "x", ""), (5, "two", "", "", "x", "北"), (6, "none", None, None, None, None)]
    df = spark.createDataFrame(rows, "n int, source string, city string, address string, store string, ward string")
    got = {r.n: tuple(r.located) for r in places.place_of(df, sources, [("姫路", "姫路市")]).collect()}
    assert got == {
        1: ("兵庫県", "姫路市", "", True, "愛媛県松山市1"), 2: ("兵庫県", "猪名川町", "", False, None), 3: ("兵庫県", "姫路市", "", False, None), 4: ("大阪府", "堺市", "西区", False, None),
        5: ("大阪府", "堺市", "北区", False, None), 6: ("", "", "", False, None),
    }


def test_store_match_key(spark):
    r = spark.createDataFrame([("西区", "みなと　店（仮称）(x)"), (None, None)], "a string, s string").select(ad.store_match_key(F.col("a"), F.col("s")).alias("k")).collect()
    assert [tuple(x.k) for x in r] == [("西区", "みなと店"), ("", "")]


def test_zones_need_the_whole_name():
    assert zoning.zone_of("準工業") == "準工業地域" and zoning.zone_of("準工") is None
    assert zoning.zones("商業\n商業地域") == (["商業地域"], [])


def test_dates_as_written(spark):
    want = {
        "令和8年4月23日": "2026-04-23", "平成31年4月1日（新）令和元年5月1日": "2019-04-01", "令和２（2020）年 6 月30日": "2020-06-30", "2019年7月8日 令和2年1月1日": "2020-01-01", "届出 2019/7/8": "2019-07-08", "2019-7/8": "2019-07-08",
        "R8.4.23": "2026-04-23", "H 30．1．2": "2018-01-02", "8.4.23": None, "XR8.4.23": None, "令和8年4月": None, "": None, "昭和99年99月99日": "2024-99-99", "2019 / 7/8": None,
    }
    got = spark.createDataFrame([(k,) for k in want], "s string").select("s", dates.to_iso(F.col("s")).alias("d")).collect()
    assert {r.s: r.d for r in got} == want


def test_stores_and_addresses_of_cells(spark):
    want = {
        "みなと店（海辺市1）": ("みなと店", "海辺市1"), "みなと店（仮称）(海辺市なぎさ町2番3": ("みなと店（仮称）", "海辺市なぎさ町2番3"), "みなと店（仮称）": ("みなと店（仮称）", ""), "みなと店 5条1項届出 [PDF 1]": ("みなと店", ""),
        "みなと店（海辺市） 縦覧資料[PDFファイル]": ("みなと店", "海辺市"), "（海辺市）": ("（海辺市）", ""), "": ("", ""),
    }
    got = spark.createDataFrame([(k,) for k in want], "s string").select("s", text.split_store(F.col("s")).alias("x")).collect()
    assert {r.s: tuple(r.x) for r in got} == want
