"""Municipalities and towns as relations: code lookup, splitting, address keys.

``codes`` (pref, city, code) and ``towns`` (code, town) are reference tables of some thousand rows. A prefix is
sought by one equi-join for each length that names have, longest first: a handful of broadcast joins in one
stage, no scan of the table for each address and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import clean, lot_parts
from ..functions.text import squash

_COUNTY = r"^\S{1,3}郡"


def _text(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit(""))


def _prefix(df: DataFrame, text: str, dim: DataFrame, name: str, out: str, on: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """``df`` with ``out``: the longest ``name`` of ``dim`` that ``text`` begins with; ``on``: equal (column, column of dim)."""
    sizes = sorted((r[0] for r in dim.select(F.length(name)).distinct().collect() if r[0]), reverse=True)  # a handful
    found = []
    for n in sizes:
        side = dim.where(F.length(name) == n).select(F.col(name).alias(f"_{out}_{n}"), *(F.col(b).alias(f"_{out}_{n}_{k}") for k, (_, b) in enumerate(on))).distinct()
        same = F.substring(df[text], 1, n) == side[f"_{out}_{n}"]
        for k, (a, _) in enumerate(on):
            same &= df[a] == side[f"_{out}_{n}_{k}"]
        df = df.join(side, same, "left").drop(*(f"_{out}_{n}_{k}" for k in range(len(on))))
        found.append(f"_{out}_{n}")
    return df.withColumn(out, F.coalesce(*map(F.col, found), F.lit(""))).drop(*found)


def _lookup(df: DataFrame, dim: DataFrame, keys: dict[str, Column], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the least ``value`` of ``dim`` where its columns equal the ``keys``; null without."""
    side = dim.groupBy(*keys).agg(F.min(value).alias(out)).select(out, *(F.col(k).alias(f"_{out}_{k}") for k in keys))
    same = F.lit(True)
    for k, c in keys.items():
        same &= c == F.col(f"_{out}_{k}")
    return df.join(side, same, "left").drop(*(f"_{out}_{k}" for k in keys))


def with_code(df: DataFrame, codes: DataFrame, pref: str = "pref", city: str = "city") -> DataFrame:
    """``city_code`` of (pref, city): as written, else without its county, else as one that is listed with a county; '' if none."""
    p, c = _text(pref), F.nullif(_text(city), F.lit(""))
    bare = codes.select("pref", F.regexp_replace("city", _COUNTY, "").alias("city"), "code").where("city <> ''")
    df = _lookup(df, codes, {"pref": p, "city": c}, "code", "_code1")
    df = _lookup(df, codes, {"pref": p, "city": F.regexp_replace(c, _COUNTY, "")}, "code", "_code2")
    df = _lookup(df, bare, {"pref": p, "city": c}, "code", "_code3")
    return df.withColumn("city_code", F.coalesce("_code1", "_code2", "_code3", F.lit(""))).drop("_code1", "_code2", "_code3")


def split_city(df: DataFrame, codes: DataFrame, addr: str = "addr", pref: str = "pref", city: str = "city") -> DataFrame:
    """``place``, a struct (pref, city, rest, precision, source), of an address and the hint (pref, city).

    What is written is believed before the hint; the hint narrows the search and never widens it. ``precision``
    is 区, 市 or ''; ``source`` is 住所 if read, 台帳 if filled from the hint, '' if undecided. Without any
    prefecture the one of the longest name, then of the least code, decides among equal beginnings.
    """
    cols = df.columns
    df = df.withColumn("_s", squash(F.coalesce(addr, F.lit("")))).withColumn("_pref", _text(pref)).withColumn("_city", _text(city))
    df = _prefix(df, "_s", codes, "pref", "_written")
    df = df.withColumn("_s", F.substr("_s", F.length("_written") + 1)).withColumn("_where", F.when(F.col("_written") != "", F.col("_written")).otherwise(F.col("_pref")))
    df = df.withColumn("_bare", F.regexp_replace("_s", "^.{1,5}?郡", ""))
    rank = codes.groupBy("pref").agg(F.struct(-F.length("pref"), F.min("code")).alias("rank"))
    ranked = codes.join(rank, "pref").groupBy("city").agg(F.min(F.struct("rank", "pref")).alias("first"))
    best = []
    for text in ("_s", "_bare"):
        df = _prefix(df, text, codes, "city", f"_in{text}", (("_where", "pref"),))
        best.append((F.col(f"_in{text}"), text))
    for text in ("_s", "_bare"):  # nowhere given: the first prefecture, there the longest name
        for n in sorted((r[0] for r in ranked.select(F.length("city")).distinct().collect()), reverse=True):
            side = ranked.where(F.length("city") == n).select(F.col("city").alias(f"_any{text}{n}"), F.struct("first.rank", F.lit(-n).alias("n"), F.lit(text).alias("text"), "first.pref", "city").alias(f"_first{text}{n}"))
            df = df.join(side, (F.col("_where") == "") & (F.substring(text, 1, n) == F.col(f"_any{text}{n}")), "left").drop(f"_any{text}{n}")
    firsts = [c for c in df.columns if c.startswith("_first")]
    df = df.withColumn("_first", F.least(*firsts) if len(firsts) > 1 else F.col(firsts[0])).drop(*firsts)
    df = df.withColumn("_ward", F.nullif(F.regexp_extract("_s", "^.+?区", 0), F.lit("")))
    given = F.nullif(F.col("_city"), F.lit(""))
    df = _lookup(df, codes, {"pref": F.col("_where"), "city": F.concat(given, F.col("_ward"))}, "city", "_of_ward")
    df = _lookup(df, codes, {"pref": F.col("_where"), "city": given}, "city", "_of_hint")
    after = lambda text, name: F.substr(text, F.length(name) + 1)
    made = lambda p, c, rest, precision, source: F.struct(p.alias("pref"), c.alias("city"), rest.alias("rest"), precision.alias("precision"), F.lit(source).alias("source"))
    fine = lambda c: F.when(c.contains("区"), "区").otherwise("市")
    (a, _), (b, _) = best
    place = (
        F.when((a != "") & (F.length(a) >= F.length(b)), made(F.col("_where"), a, after(F.col("_s"), a), fine(a), "住所"))
        .when(b != "", made(F.col("_where"), b, after(F.col("_bare"), b), fine(b), "住所"))
        .when(F.col("_first").isNotNull(), made(F.col("_first.pref"), F.col("_first.city"), after(F.when(F.col("_first.text") == "_s", F.col("_s")).otherwise(F.col("_bare")), F.col("_first.city")), fine(F.col("_first.city")), "住所"))
        .when(F.col("_of_ward").isNotNull(), made(F.col("_where"), F.col("_of_ward"), after(F.col("_s"), F.col("_ward")), F.lit("区"), "台帳"))
        .when(F.col("_of_hint").isNotNull() & F.col("_written").isin(F.lit(""), F.col("_pref")), made(F.col("_where"), F.col("_of_hint"), F.col("_s"), F.lit("市"), "台帳"))
        .otherwise(made(F.col("_where"), F.lit(""), F.col("_s"), F.lit(""), ""))
    )
    return df.withColumn("place", place).select(*cols, "place")


def conflicting_head(df: DataFrame, codes: DataFrame, text: str, pref: str, code: str) -> DataFrame:
    """``other``: another prefecture's name, or else the longest name of another 市, that ``text`` begins with; '' if none."""
    df = _prefix(df, text, codes, "pref", "_head_pref")
    cities = codes.where(F.col("city").endswith("市")).groupBy("city").agg(F.collect_set("code").alias("own"))
    found = []
    for n in sorted((r[0] for r in cities.select(F.length("city")).distinct().collect()), reverse=True):
        side = cities.where(F.length("city") == n).select(F.col("city").alias(f"_head_{n}"), F.col("own").alias(f"_own_{n}"))
        df = df.join(side, F.substring(text, 1, n) == F.col(f"_head_{n}"), "left")
        found.append(F.when(F.size(F.array_remove(f"_own_{n}", F.col(code))) > 0, F.col(f"_head_{n}")))
    other = F.when((F.col("_head_pref") != "") & (F.col("_head_pref") != F.col(pref)), F.col("_head_pref")).otherwise(F.coalesce(*found, F.lit("")))
    return df.withColumn("other", other).drop("_head_pref", *(c for c in df.columns if c.startswith(("_head_", "_own_"))))


def address_keys(df: DataFrame, codes: DataFrame, towns: DataFrame, pref: str = "pref", city: str = "city", addr: str = "addr") -> DataFrame:
    """``keys``, a struct (city_code, town, addr, addr_key, addr_key_town, error): the address in comparable form.

    The town is what stands before a 丁目; with other units only, the text before the numbers if it is a whole
    town and no other town begins with it (J15); without any unit, the longest town in front if a digit or
    nothing follows, never a shorter one instead (J14); otherwise empty: never a guess. An address that names
    another city than the caller's gives an error and no keys. Null and empty addresses have no keys.
    """
    cols = df.columns
    df = with_code(df, codes, pref, city).withColumn("_pref", _text(pref)).withColumn("_city", _text(city)).withColumn("_a", clean(F.trim(F.col(addr))))
    ward = F.when(F.col("_city").rlike("市.+区$"), F.regexp_replace("_city", "^.*?市", ""))
    heads = [F.concat("_pref", "_city"), F.col("_city"), F.col("_pref"), ward]
    df = df.withColumn("_head", F.coalesce(*(F.when((h != "") & F.startswith(F.col("_a"), h), h) for h in heads)))
    df = conflicting_head(df, codes, "_a", "_pref", "city_code").withColumn("other", F.when(F.col("_head").isNull(), F.col("other")).otherwise(""))
    df = df.withColumn("_p", lot_parts(F.substr("_a", F.length(F.coalesce("_head", F.lit(""))) + 1))).withColumn("_key", F.col("_p.key")).withColumn("_shown", F.col("_p.shown"))
    begun = F.expr("transform(sequence(1, length(town) - 1), n -> substring(town, 1, n))")
    longer = towns.where("length(town) > 1").select("code", F.explode(begun).alias("town")).distinct()
    alone = towns.join(longer, ["code", "town"], "left_anti")
    df = _lookup(df, alone, {"code": F.col("city_code"), "town": F.col("_p.before")}, "town", "_whole")
    df = _prefix(df, "_shown", towns, "town", "_long", (("city_code", "code"),))
    next_ = F.substr("_shown", F.length("_long") + 1, F.lit(1))
    fits = F.when((F.col("_long") != "") & next_.rlike("^[0-9]?$"), F.col("_long"))
    town = F.coalesce(F.when(F.col("_p.counted"), F.coalesce(F.col("_p.town"), F.col("_whole"))).otherwise(fits), F.lit(""))
    wrong = F.col("other") != ""
    keyed = lambda x: F.when(~wrong & (F.col("city_code") != "") & (x != ""), F.concat_ws("|", "city_code", x)).otherwise("")
    keys = F.struct(
        "city_code", F.when(wrong, "").otherwise(town).alias("town"), F.concat("_city", F.when(wrong, "").otherwise(F.col("_shown"))).alias("addr"), keyed(F.col("_key")).alias("addr_key"), keyed(town).alias("addr_key_town"),
        F.when(wrong, F.concat(F.lit("address names "), F.col("other"))).otherwise("").alias("error"),
    )
    return df.withColumn("keys", keys).select(*cols, "keys")


def place_of(df: DataFrame, sources: DataFrame, known: list[tuple[str, str]]) -> DataFrame:
    """``located``, a struct (pref, city, ward, guess, suspect), of records (source, city, ward, address, store).

    ``sources`` (source, pref, city or null, wards boolean): the place that a source stands for, and whether its
    addresses begin with a ward. An address that begins with another prefecture is no place of the store: it
    moves to ``suspect``. Without a city the address gives it, else its whole text, else the first of ``known``
    (name, city) that the store's name holds, which is a ``guess``.
    """
    cols = df.columns
    side = sources.select(F.col("source").alias("_source"), F.col("pref").alias("_pref"), F.col("city").alias("_own"), F.col("wards").alias("_wards"))
    df = df.join(side, F.col("source") == F.col("_source"), "left")
    addr = _text("address")
    named = F.regexp_extract(addr, "^(東京都|北海道|(?:大阪|京都)府|.{2,3}県)", 1)
    suspect = F.when((F.coalesce("_pref", F.lit("")) != "") & (named != "") & (named != F.col("_pref")), addr)
    a = F.when(suspect.isNull(), addr).otherwise("")
    given = F.when((_text("ward") != "") & ~_text("ward").endswith("区"), F.concat(_text("ward"), F.lit("区"))).otherwise(_text("ward"))
    ward = F.when(given != "", given).when(F.col("_wards"), F.regexp_extract(a, "^(.{1,4}?区)", 1)).otherwise("")
    written = F.coalesce(F.nullif(F.regexp_extract(a, "^.{1,4}?郡(.{1,5}?[町村])", 1), F.lit("")), F.nullif(F.regexp_extract(a, "^(.{1,6}?市)", 1), F.lit("")))
    whole = F.coalesce(*(F.when(a == name, c) for name, c in known), F.lit(None))
    guessed = F.coalesce(*(F.when(F.coalesce("store", F.lit("")).contains(name), c) for name, c in known), F.lit(None))
    sure = F.coalesce("_own", F.nullif(_text("city"), F.lit("")), written, whole)
    out = F.struct(F.coalesce("_pref", F.lit("")).alias("pref"), F.coalesce(sure, guessed, F.lit("")).alias("city"), F.coalesce(ward, F.lit("")).alias("ward"), (sure.isNull() & guessed.isNotNull()).alias("guess"), suspect.alias("suspect"))
    return df.withColumn("located", out).select(*cols, "located")
