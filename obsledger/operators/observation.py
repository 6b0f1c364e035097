"""Repeated observation: completeness, folding, three-valued listing state, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

YES, NO, UNKNOWN = "yes", "no", "unknown"


def all_marks(marks: dict[str, Column]) -> tuple[Column, Column]:
    """(complete, reason) of named marks ``yes``/``no``/``unknown``; a missing mark is unknown.

    Any *no* gives false; else any unknown gives null; else true. No marks required: null.
    """
    if not marks:
        return F.lit(None).cast("boolean"), F.lit("no marks required")
    named = [(k, F.coalesce(v, F.lit(UNKNOWN))) for k, v in marks.items()]
    no = F.concat_ws(",", *(F.when(v == NO, k) for k, v in named))
    unsure = F.concat_ws(",", *(F.when(~v.isin(YES, NO), k) for k, v in named))
    complete = F.when(no != "", False).when(unsure != "", F.lit(None).cast("boolean")).otherwise(True)
    reason = F.when(no != "", F.concat(F.lit("no:"), no)).when(unsure != "", F.concat(F.lit("unknown:"), unsure)).otherwise("all yes")
    return complete, reason


def tri(complete: Column) -> Column:
    """A nullable truth value as yes/no/unknown; unknown is never promoted."""
    return F.when(complete, YES).when(~complete, NO).otherwise(UNKNOWN)


def snapshot_fold(rows: DataFrame, keys: list[str], day: str, order: list[str], body: list[str]) -> DataFrame:
    """A1/A3: one row per key: the latest body, first and last day, number of distinct days."""
    latest = F.max_by(F.struct(*body), F.struct(day, *order)).alias("_body")
    return (
        rows.groupBy(*keys).agg(F.min(day).alias("first_seen"), F.max(day).alias("last_seen"), F.count_distinct(day).alias("days_seen"), latest)
        .select(*keys, "first_seen", "last_seen", "days_seen", *(F.col(f"_body.{b}").alias(b) for b in body))
    )


def first_of_day(rows: DataFrame, keys: list[str], order: list[str], day: str = "day", source: str = "source") -> DataFrame:
    """Of rows with one key on a day of a source, the first by ``order`` (file, then place in it).

    One aggregation that keeps a single row a key, so equal keys combine before they shuffle. Null keys are a key.
    """
    body = [c for c in rows.columns if c not in (source, day, *keys)]
    first = F.min_by(F.struct(*body), F.struct(*order)).alias("_first")
    return rows.groupBy(source, day, *keys).agg(first, F.count("*").alias("n_rows")).select(source, day, *keys, "n_rows", *(F.col(f"_first.{c}").alias(c) for c in body))


def listing_state(seen: DataFrame, obs: DataFrame) -> DataFrame:
    """Is a key still listed at its source?

    ``seen`` (source, key, day) sightings; ``obs`` (source, day, complete, origin, method), one row per
    observation, nullable ``complete``. With K the last complete day on which the key was seen and C the
    next complete day: seen on the source's latest day, true; no K, no C, another origin or method at C,
    or a sighting after C, null (C is never skipped); else false, gone by C. One aggregation per key; the
    observation log (days x sources) is the only other side of the join.
    """
    w = Window.partitionBy("source").orderBy("day")
    c = obs.where("complete").select("source", "day", *(F.struct(F.col("day").alias("k"), F.lead("day").over(w).alias("c"), (F.col("origin").eqNullSafe(F.lead("origin").over(w)) & F.col("method").eqNullSafe(F.lead("method").over(w))).alias("same")).alias(n) for n in ("at",)))
    latest = obs.groupBy("source").agg(F.max("day").alias("latest"))
    per_key = (
        seen.join(c, ["source", "day"], "left").groupBy("source", "key")
        .agg(F.min("day").alias("first_seen"), F.max("day").alias("last_seen"), F.max("at").alias("at"))
        .join(latest, "source")
    )
    gone = F.col("at.c").isNotNull() & F.col("at.same") & (F.col("last_seen") <= F.col("at.c"))
    listed = F.when(F.col("last_seen") == F.col("latest"), True).when(gone, False)
    out = per_key.select("source", "key", "first_seen", "last_seen", listed.alias("listed"), F.col("at.k").alias("kakunin_saigo"), F.col("at.c").alias("_c"))
    return out.withColumn("kieta_kakunin", F.when(~F.col("listed"), F.col("_c"))).drop("_c")


def batch_guards(seen: DataFrame, obs: DataFrame) -> DataFrame:
    """Per observation: keys now, keys of the last complete one before, how many of those are lost.

    ``mark`` is *unknown* for an empty batch after a non-empty one and for a loss of half or more. The key
    sets stay relations: losses are counted by a join on (source, key), never by collected sets.
    """
    w = Window.partitionBy("source").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    pairs = obs.select("source", "day", F.last(F.when(F.col("complete"), F.col("day")), ignorenulls=True).over(w).alias("prev"))
    keys = seen.select("source", "key", "day").distinct()
    n = keys.groupBy("source", "day").agg(F.count("*").alias("n"))
    kept = (
        keys.join(pairs, ["source", "day"]).where(F.col("prev").isNotNull()).alias("a")
        .join(keys.select("source", "key", F.col("day").alias("prev")).alias("b"), ["source", "key", "prev"])
        .groupBy("source", "day").agg(F.count("*").alias("kept"))
    )
    out = (
        pairs.join(n, ["source", "day"], "left").join(n.select("source", F.col("day").alias("prev"), F.col("n").alias("prev_n")), ["source", "prev"], "left")
        .join(kept, ["source", "day"], "left").fillna(0, ["n", "kept"])
    )
    lost = F.when(F.col("prev").isNotNull(), F.coalesce("prev_n", F.lit(0)) - F.col("kept"))
    drop = F.coalesce((F.col("prev_n") > 0) & (lost * 2 >= F.col("prev_n")), F.lit(False))
    return out.select("source", "day", "prev", "n", "prev_n", lost.alias("lost_n"), drop.alias("mass_drop"), F.when(drop | ((F.col("n") == 0) & (F.coalesce("prev_n", F.lit(0)) > 0)), UNKNOWN).otherwise(YES).alias("mark"))


def diff_reason(prev: str, now: str) -> Column:
    """T5: '' if a difference of two adjacent observations may be reported, else the first reason against it.

    Both are struct columns (complete, origin, method, ...); ``prev`` null for the first observation.
    """
    p, n = F.col(prev), F.col(now)
    return (
        F.when(p.isNull(), "no previous observation")
        .when(~F.coalesce(n["complete"], F.lit(False)), "this observation is not complete")
        .when(~F.coalesce(p["complete"], F.lit(False)), "the previous observation is not complete")
        .when(~p["origin"].eqNullSafe(n["origin"]), "origin changed")
        .when(~p["method"].eqNullSafe(n["method"]), "method changed")
        .otherwise("")
    )


def observation_diff(seen: DataFrame, obs: DataFrame) -> DataFrame:
    """Entered and left keys between adjacent observations of a source.

    ``seen`` (source, key, day, pos). Four success flags stay apart: processed, observed, saved, diffed; a
    difference without permission is null, never 0. A loss that is one cluster at the tail of the previous
    order (least position lost beyond the largest kept) is held: it looks like a cut transfer.
    """
    w = Window.partitionBy("source").orderBy("day")
    state = F.struct("day", "complete", "origin", "method")
    pairs = obs.select("source", "day", state.alias("now"), F.lag(state).over(w).alias("prev")).withColumn("reason", diff_reason("prev", "now"))
    keys = seen.groupBy("source", "day", "key").agg(F.min("pos").alias("pos"))
    both = pairs.select("source", "day", F.col("prev.day").alias("prev_day")).where(F.col("prev_day").isNotNull())
    now = keys.join(both, ["source", "day"]).select("source", "day", "key", F.lit(1).alias("now"))
    before = keys.select("source", F.col("day").alias("prev_day"), "key", "pos").join(both, ["source", "prev_day"]).select("source", "day", "key", "pos")
    joined = now.join(before, ["source", "day", "key"], "full")
    left, kept = F.col("now").isNull(), F.col("now").isNotNull() & F.col("pos").isNotNull()
    counts = joined.groupBy("source", "day").agg(
        F.count_if(F.col("pos").isNull()).alias("entered"), F.count_if(left).alias("left"), F.count_if(kept).alias("kept"),
        F.coalesce(F.min(F.when(left, F.col("pos"))) > F.max(F.when(kept, F.col("pos"))), F.lit(False)).alias("tail"),
    )
    out = pairs.join(counts, ["source", "day"], "left")
    ok = F.col("reason") == ""
    diffed = ok & ~F.coalesce("tail", F.lit(False))
    return out.select(
        "source", "day", F.lit(True).alias("processed"), tri(F.col("now.complete")).alias("observed"), F.lit(True).alias("saved"), diffed.alias("diffed"),
        F.when(ok & F.col("tail"), "held: loss at the tail").otherwise(F.col("reason")).alias("reason"),
        F.when(diffed, F.col("entered")).alias("entered"), F.when(diffed, F.col("left")).alias("gone"), F.when(ok, F.col("tail")).alias("tail"),
    )


def gaps(days: DataFrame, by: str, day: str) -> DataFrame:
    """Number of distinct days per group and median, least and largest gap; under two days null with a reason."""
    d = days.select(by, day).distinct()
    g = d.withColumn("gap", F.datediff(day, F.lag(day).over(Window.partitionBy(by).orderBy(day))))
    out = g.groupBy(by).agg(F.count("*").alias("n_days"), F.median("gap").alias("median_gap"), F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"))
    return out.withColumn("reason", F.when(F.col("n_days") < 2, "fewer than two days").otherwise(""))


def gone_intervals(state: DataFrame) -> DataFrame:
    """Disappearances by month of the last sighting and width (days) of the interval that brackets them."""
    width = F.datediff("kieta_kakunin", "kakunin_saigo")
    rows = state.where(~F.col("listed")).select("source", F.date_format("kakunin_saigo", "yyyy-MM").alias("month"), F.when(width == 1, "one day").otherwise("wider").alias("width"))
    return rows.groupBy("source", "month", "width").agg(F.count("*").alias("n"))
