"""Enrichment, provenance and record-level privacy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import privacy


def blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def from_documents(rows: DataFrame, read: DataFrame, fields: dict[str, str], key: str = "key") -> DataFrame:
    """Fill blank fields from what was read off a row's documents; the first document that was read counts.

    ``rows`` (key, source, docs array, fields, area_m2), ``read`` (source, stem, texts, area). Area counts
    from 100 to 300000. ``from_ocr`` names what was filled, sorted, joined to what it held.
    """
    docs = rows.select(key, "source", F.posexplode("docs").alias("pos", "url")).withColumn("stem", F.regexp_extract("url", r"([^/]+?)(\.[^./]*)?$", 1))
    first = docs.join(read, ["source", "stem"]).groupBy(key).agg(F.min_by(F.struct(*[c for c in read.columns if c not in ("source", "stem")]), "pos").alias("_o"))
    j = rows.join(first, key, "left")
    area = F.regexp_replace(F.col("_o.area"), "[^0-9]", "").try_cast("int")
    new = {f: F.when(blank(F.col(f)) & ~blank(F.col(f"_o.{o}")), F.col(f"_o.{o}")) for f, o in fields.items()}
    new["area_m2"] = F.when(blank(F.col("area_m2")) & area.between(100, 300000), area)
    names = F.array_compact(F.array(*(F.when(v.isNotNull(), k) for k, v in new.items())))
    had = F.coalesce(F.col("from_ocr"), F.array().cast("array<string>")) if "from_ocr" in rows.columns else F.array().cast("array<string>")
    out = j.withColumn("from_ocr", F.array_sort(F.array_union(had, names)))
    return out.withColumns({f: F.coalesce(v, F.col(f)) if f != "area_m2" else F.coalesce(F.col(f), v) for f, v in new.items()}).drop("_o")


def stamp(rows: DataFrame, files: DataFrame, pages: DataFrame, source: str = "source") -> DataFrame:
    """Where a row was taken and when: its own file, else the source's page of that day, else the source's
    latest page, else its last sighting; never today. Rows that stay without are null, to be counted."""
    page = pages.groupBy("source").agg(F.max_by("url", "day").alias("_url"), F.max("day").alias("_day"))
    same = pages.groupBy("source", "day").agg(F.min("url").alias("_durl"))
    j = rows.join(files.select("source", "file", F.col("url").alias("_furl"), F.col("day").alias("_fday")), ["source", "file"], "left")
    j = j.join(same.withColumnRenamed("day", "last_seen"), ["source", "last_seen"], "left").join(page, "source", "left")
    return j.withColumn("source_url", F.coalesce("_furl", "_durl", "_url")).withColumn("fetched_on", F.coalesce("_fday", F.when(F.col("_durl").isNotNull(), F.col("last_seen")), "_day", "last_seen")).drop("_furl", "_fday", "_durl", "_url", "_day")


def neighbour_year(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """A regular issue missing under its date, found a year later or earlier with the same number; later wins."""
    near = known.select("no", F.col("day").alias("found"))
    j = wanted.where(~F.col("no").startswith("g")).join(near, "no").withColumn("shift", F.when(F.col("found") == F.add_months("day", 12), 1).when(F.col("found") == F.add_months("day", -12), -1))
    w = Window.partitionBy("no", "day").orderBy(F.desc("shift"))
    return j.where("shift IS NOT NULL").withColumn("rank", F.row_number().over(w)).where("rank = 1").select("no", "day", "found")


def history_refs(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Every reference of a row's history with the record it names, null where there is none."""
    return rows.select("key", F.posexplode("history").alias("pos", "ref")).join(records.select("ref", F.col("key").alias("ref_key")), "ref", "left").select("key", "pos", "ref", "ref_key")


def apply_privacy(rows: DataFrame, bodies: list[str] | tuple = ()) -> DataFrame:
    """what may be published of a record (operator, address, extra map).

    The party's kind is taken from the name before it is cut, or kept once it has been; persons' names show as
    個人 and vanish from ``extra`` party columns, their address is cut to the town. Twice is the same as once.
    """
    known = F.col("operator_kind").isNotNull() if "operator_kind" in rows.columns else F.lit(False)
    kind = F.when(known, F.col("operator_kind")).otherwise(privacy.party_kind(F.col("operator"), None, bodies)) if "operator_kind" in rows.columns else privacy.party_kind(F.col("operator"), None, bodies)
    r = rows.withColumn("_kind", kind).withColumn("_addr", privacy.redact_addr(F.col("address"), F.col("_kind")))
    extra = F.transform_values("extra", lambda k, v: F.when(privacy.is_party_column(k) & ~privacy.is_corp(v, bodies), privacy.INDIVIDUAL).otherwise(v))
    extra = F.map_filter(extra, lambda k, v: ~(privacy.is_party_column(k) & (v == "")))
    display = F.when(F.col("_kind") == "individual", F.when(blank(F.col("operator")) | privacy.is_placeholder(F.col("operator")), F.coalesce("operator", F.lit(""))).otherwise(privacy.INDIVIDUAL)).otherwise(F.coalesce("operator", F.lit("")))
    return (
        r.withColumn("operator_kind", F.col("_kind")).withColumn("operator", display)
        .withColumn("address_redacted", (F.col("_addr") != privacy.strip(F.col("address"))) | (F.col("address_redacted") if "address_redacted" in rows.columns else F.lit(False)))
        .withColumn("address", F.col("_addr")).withColumn("extra", extra).drop("_kind", "_addr")
    )


def listing_sentence(mode: Column, listed: Column, last_complete: Column, gone_by: Column, last_seen: Column) -> Column:
    """F64: what is said about a record's listing; a date that is not known is never printed."""
    return (
        F.when(mode == "cumulative", "kept for good").when(listed & last_seen.isNotNull(), F.concat(F.lit("listed on "), last_seen))
        .when(~listed & last_complete.isNotNull() & gone_by.isNotNull(), F.concat(F.lit("gone between "), last_complete, F.lit(" and "), gone_by))
        .when(last_seen.isNotNull(), F.concat(F.lit("last seen on "), last_seen, F.lit(", now unknown"))).otherwise("not known")
    )


def suspects(rows: DataFrame, flags: list[str]) -> DataFrame:
    """Rows any of whose party flags says that an address stands in the name's place, once each."""
    hit = F.array_compact(F.array(*(F.when(F.col(f) == "address", f) for f in flags)))
    return rows.withColumn("flags", hit).where(F.size("flags") > 0).select("source", "file", "key", "store", "flags").distinct()


#: What the day of an event is called by kind, and what is added for readers; what its date of notice rests on (fixed values).
EVENT_LABELS = {"新設": ("新設日", "（開店日とは別に決まります）"), "廃止": ("廃止日", "（閉店日とは別に決まります）"), "変更": ("変更日", ""), "承継": ("承継日", ""), "中規模": ("日付", "")}
ORDINANCE, LAW = "市の条例にもとづく", "大規模小売店舗立地法の"
NO_ADDRESS, OTHER_PREFECTURE = "（取ってきた一覧に所在地が入っていませんでした）", "（自治体の表の所在地欄に別の県の住所が入っていたため、店舗の所在地としては表示していません）"
CUT_BECAUSE = {"individual": "設置者が個人のため", "address": "届出の一覧の設置者の欄に住所だけが書かれていて名称が読めないため", "": "設置者を確かめられないため"}


def event_label(kind: Column, part: int = 0) -> Column:
    """what the event day of a notice is called; a kind that is not listed stops the run."""
    known = F.coalesce(*(F.when(kind == k, F.lit(v[part])) for k, v in EVENT_LABELS.items()))
    return F.coalesce(known, F.raise_error(F.concat(F.lit("no name for the date of "), F.coalesce(kind, F.lit("null")))).cast("string"))


def address_note(absent: Column, redacted: Column, display: Column, suspect: Column, elsewhere: Column) -> Column:
    """why an address is not shown in full: the source has none, a person, a name that cannot be read, or unknown;
    and whether one of another prefecture was set aside."""
    why = F.when(display == privacy.INDIVIDUAL, CUT_BECAUSE["individual"]).when(suspect == "address", CUT_BECAUSE["address"]).otherwise(CUT_BECAUSE[""])
    note = F.when(F.coalesce(absent, F.lit(False)), NO_ADDRESS).when(F.coalesce(redacted, F.lit(False)), F.concat(F.lit("（"), why, F.lit("町丁目まで）"))).otherwise("")
    return F.concat(note, F.when(blank(elsewhere), "").otherwise(OTHER_PREFECTURE))


def description(area: Column, store: Column, kind: Column, notified: Column, size: Column, event: Column) -> Column:
    """one sentence on a notice: the law or ordinance it rests on, the size and the event day if known."""
    basis = F.when(kind == "中規模", ORDINANCE).otherwise(LAW)
    lead = F.concat(F.coalesce(area, F.lit("")), F.lit("の"), F.coalesce(store, F.lit("")), F.lit("について、"), F.coalesce(notified, F.lit("")), F.lit("に"), basis, kind, F.lit("届出。"))
    dated = F.when(blank(event), "").otherwise(F.concat(F.lit(" 届出に書かれた"), event_label(F.when(~blank(event), kind).otherwise("変更")), F.lit("は"), event, event_label(F.when(~blank(event), kind).otherwise("変更"), 1), F.lit("。")))
    return F.concat(lead, F.when(blank(size), "").otherwise(F.concat(F.lit(" 店舗面積"), size.cast("string"), F.lit("。"))), dated)
