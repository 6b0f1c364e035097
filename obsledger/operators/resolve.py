"""Entity resolution and history: cross-source merge, tiered match, rollups, change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def filled(*cols: Column) -> Column:
    """how many values are neither null, empty string, zero nor false."""
    out = F.lit(0)
    for c in cols:
        text = c.cast("string")
        out = out + F.when(text.isNull() | text.isin("", "0", "0.0", "false"), 0).otherwise(1)
    return out


def merge_sources(rows: DataFrame, key: list[str], article: str, fields: list[str], row_key: str, source: str = "source") -> DataFrame:
    """Settle records of several sources into one.

    Unit: the rows of ``key`` if they name at most one article; else those of each article, and every
    blank-article row alone. A unit settles only if it has several sources and each gives exactly one row;
    otherwise its rows pass untouched, as do rows without a key. The base is the fullest row (ties by source, key); each other field
    is the first non-empty value in that order.
    """
    art = F.coalesce(F.col(article), F.lit(""))
    keyless = " OR ".join(f"`{k}` IS NULL" for k in key)
    rest = rows.where(keyless)
    named = rows.groupBy(*key).agg(F.count_distinct(F.when(art != "", art)).alias("_n"))
    r = rows.where(f"NOT ({keyless})").join(named, key)
    unit = F.when(F.col("_n") <= 1, "").when(art != "", F.concat(F.lit("a:"), art)).otherwise(F.concat(F.lit("r:"), F.col(row_key).cast("string")))
    r = r.withColumn("_unit", unit).withColumn("_fill", filled(*(F.col(f) for f in fields)))
    per = r.groupBy(*key, "_unit", source).agg(F.count("*").alias("n"))
    ok = per.groupBy(*key, "_unit").agg(((F.count("*") > 1) & (F.max("n") == 1)).alias("_settles"))
    r = r.join(ok, [*key, "_unit"])
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("_fill")).alias("o"), F.col(source).alias("s"), F.col(row_key).alias("k"), *(F.col(f).alias(f"f_{f}") for f in fields))))
    some = lambda f: F.filter("_r", lambda x: x[f"f_{f}"].isNotNull() & ~x[f"f_{f}"].cast("string").isin("", "0"))
    first = lambda f: F.coalesce(F.get(some(f), F.lit(0))[f"f_{f}"], F.col("_r")[0][f"f_{f}"])
    settled = r.where("_settles").groupBy(*key, "_unit").agg(ranked.alias("_r")).select(
        *key, F.col("_r")[0]["k"].alias(row_key), *(first(f).alias(f) for f in fields),
        F.array_sort(F.transform("_r", lambda x: x["s"])).alias("sources"), F.array_sort(F.slice(F.transform("_r", lambda x: x["k"]), 2, 1 << 30)).alias("merged_keys"),
    )
    empty = F.array().cast(settled.schema["merged_keys"].dataType)
    out = lambda x: x.select(*key, row_key, *fields, F.array(source).alias("sources"), empty.alias("merged_keys"))
    return settled.unionByName(out(r.where(~F.col("_settles")))).unionByName(out(rest))


def _earlier(openings: DataFrame, exits: DataFrame, cols: list[str]) -> DataFrame:
    """(cols, day, _n): for each day on which exits fall, the openings of ``cols`` on earlier days. The running count
    goes over the days of a key, not over its rows."""
    days = openings.select(*cols, "day", F.lit(1).alias("_o")).unionByName(exits.select(*cols, "day", F.lit(0).alias("_o")))
    days = days.where("day IS NOT NULL").groupBy(*cols, "day").agg(F.sum("_o").alias("_o"))
    before = F.sum("_o").over(Window.partitionBy(*cols).orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    return days.withColumn("_n", F.coalesce(before, F.lit(0)))


def tiered_match(exits: DataFrame, openings: DataFrame, tiers: list[list[str]], near: list[str], differs: str) -> DataFrame:
    """Match exits with earlier openings, tier by tier.

    ``exits`` (id, day, kind, key columns), ``openings`` (day, key columns). In each tier the earliest
    opening on the tier's columns counts, and only if it lies before the exit; failing that test falls
    through to the next tier. Unmatched exits count near misses: earlier openings that agree on ``near``
    but not on ``differs``. Individuals keep the label and lose the dates. Every side is reduced per key
    before it is joined.
    """
    out = exits
    opened, label = F.lit(None).cast("date"), F.lit(None).cast("string")
    for i, cols in enumerate(tiers, 1):
        least = openings.where(" AND ".join(f"{c} IS NOT NULL" for c in cols)).groupBy(*cols).agg(F.min("day").alias(f"_o{i}"))
        out = out.join(least, cols, "left")
    for i in range(len(tiers), 0, -1):
        ok = F.coalesce(F.col(f"_o{i}") < F.col("day"), F.lit(False))
        opened, label = F.when(ok, F.col(f"_o{i}")).otherwise(opened), F.when(ok, f"tier{i}").otherwise(label)
    out = out.withColumn("_opened", opened).withColumn("_label", label).drop(*(f"_o{i}" for i in range(1, len(tiers) + 1)))
    out = out.withColumn("near_candidates", F.lit(0).cast("long"))
    for cols, sign in ((near, 1), ([*near, differs], -1)):  # those that agree on ``near``, less those that agree on both
        side = _earlier(openings, out, cols).select("_n", F.col("day").alias("_day"), *(F.col(c).alias(f"_k_{c}") for c in cols))
        same = F.col("day") == F.col("_day")
        for c in cols:
            same &= F.col(c).eqNullSafe(F.col(f"_k_{c}")) if c == differs else F.col(c) == F.col(f"_k_{c}")
        out = out.join(side, same, "left").withColumn("near_candidates", F.col("near_candidates") + sign * F.coalesce("_n", F.lit(0))).drop("_n", "_day", *(f"_k_{c}" for c in cols))
    out = out.withColumn("near_candidates", F.when(F.col("_label").isNull(), F.col("near_candidates")).otherwise(0))
    match = F.coalesce(F.col("_label"), F.when(F.col("near_candidates") > 0, "near miss"), F.lit("none"))
    person = F.col("kind") == "individual"
    return out.select("id", match.alias("match"), F.when(~person, F.col("_opened")).alias("opened_on"), F.when(~person, F.col("day")).alias("closed_on"), F.when(~person, F.datediff("day", "_opened")).alias("days"), "near_candidates")


def change_counts(rows: DataFrame, key: str, order: list[str], value: str, same: Column) -> DataFrame:
    """Per key, transitions over its non-blank values whose comparison form differs from the one before (A B A C: 3)."""
    w = Window.partitionBy(key).orderBy(*order)
    seq = rows.where(F.col(value).isNotNull() & (F.col(value) != "")).select(key, *order, same.alias("_same"))
    seq = seq.withColumn("_was", F.lag("_same").over(w))
    return seq.groupBy(key).agg(F.count_if(F.col("_was").isNotNull() & (F.col("_was") != F.col("_same"))).alias("changes"))


def change_events(rows: DataFrame, key: str, day: str, pos: str, fields: dict[str, Column]) -> DataFrame:
    """Per key and field, adjacent non-null dated values that differ, as (after, before) intervals.

    ``fields`` maps a name to its comparable value (blank as null). The unpivot comes first, so one window
    serves all fields.
    """
    cells = F.explode(F.array(*(F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in fields.items())))
    r = rows.where(F.col(day).isNotNull()).select(F.col(key), F.col(day).alias("_day"), F.col(pos).alias("_pos"), cells.alias("_c")).select(key, "_day", "_pos", "_c.field", "_c.value")
    r = r.where(F.col("value").isNotNull() & ~F.col("value").isin("", "0", "0.0"))
    w = Window.partitionBy(key, "field").orderBy("_day", "_pos")
    r = r.withColumn("_was", F.lag(F.struct("value", F.col("_day").alias("d"))).over(w))
    return r.where(F.col("_was.value") != F.col("value")).select(key, "field", F.col("_was.value").alias("before_value"), F.col("value").alias("after_value"), F.col("_was.d").alias("after"), F.col("_day").alias("before"))


def comparable_units(rows: DataFrame, key: str, day: str, fields: dict[str, Column]) -> DataFrame:
    """Per field, keys with at least two dated non-null values."""
    c = [F.count(F.when(F.col(day).isNotNull(), v)).alias(k) for k, v in fields.items()]
    per = rows.groupBy(key).agg(*c)
    return per.select(F.explode(F.array(*(F.struct(F.lit(k).alias("field"), (F.col(k) >= 2).alias("ok")) for k in fields))).alias("x")).groupBy("x.field").agg(F.count_if("x.ok").alias("comparable"))


def succession(rows: DataFrame, by: list[str], order: list[str], event: Column, holder: str) -> DataFrame:
    """At each event the nearest earlier non-null holder of the same unit, where it differs from the new one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("previous", F.last(holder, ignorenulls=True).over(w))
    return r.where(event & F.col("previous").isNotNull() & F.col(holder).isNotNull() & (F.col("previous") != F.col(holder)))


def majority(rows: DataFrame, by: str, value: str) -> DataFrame:
    """The most common value of each group; ties go to the least value."""
    n = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"))
    return n.groupBy(by).agg(F.max("_n").alias("n"), F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def compare(a: Column, b: Column) -> Column:
    """J18 for one field: null on either side is undecided."""
    return F.when(a.isNull() | b.isNull(), "undecided").when(a == b, "same").otherwise("differs")


def worst(*verdicts: Column) -> Column:
    """Differs beats undecided beats same."""
    any_ = lambda v: F.greatest(*((x == v).cast("int") for x in verdicts)) == 1
    return F.when(any_("differs"), "differs").when(any_("undecided"), "undecided").otherwise("same")
