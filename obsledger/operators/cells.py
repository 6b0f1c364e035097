"""Masked aggregation with reconciling totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counts up to this are hidden; rates below this population are not given (fixed values).
SUPPRESS_MAX, MIN_POPULATION = 2, 500
#: Party kinds that are no persons (fixed values).
NO_PERSON = ("corp", "none")


def has_person(kinds: Column | None) -> Column:
    """May the cell hold a person? No kinds given, or none known, counts as yes."""
    if kinds is None:
        return F.lit(True)
    return F.coalesce((F.size(kinds) <= 0) | F.exists(kinds, lambda k: ~k.isin(*NO_PERSON)), F.lit(True))


def masked(n: Column, kinds: Column | None = None) -> Column:
    """the count, null where it is 1 or 2 and a person may be among them; 0 stays 0."""
    n = F.coalesce(n, F.lit(0))
    return F.when(n.between(1, SUPPRESS_MAX) & has_person(kinds), None).otherwise(n)


def count_label(n: Column, kinds: Column | None = None) -> Column:
    """the same decision as text: ``0``, ``1-2`` or the number."""
    n = F.coalesce(n, F.lit(0))
    return F.when(n <= 0, "0").when((n <= SUPPRESS_MAX) & has_person(kinds), f"1-{SUPPRESS_MAX}").otherwise(n.cast("string"))


def suppress_rate(count: Column, population: Column) -> Column:
    """F34, in this order: no population, true; count 0, false; small population, true; count 1-2, true."""
    c, p = F.coalesce(count, F.lit(0)), F.coalesce(population, F.lit(0))
    return F.when(p <= 0, True).when(c == 0, False).when(p < MIN_POPULATION, True).otherwise(c.between(1, SUPPRESS_MAX))


def cell_counts(rows: DataFrame, by: list[str], kind: str) -> DataFrame:
    """A4: cells with masked count and label; the party kinds of a cell decide whether it may be shown."""
    g = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.collect_set(kind).alias("_k"))  # a handful of kinds
    return g.select(*by, masked(F.col("_n"), F.col("_k")).alias("count"), count_label(F.col("_n"), F.col("_k")).alias("count_label"))


def reasons_filled(spark, counts: DataFrame, reasons: list[str]) -> DataFrame:
    """Every reason appears, with 0 where nothing was left out for it."""
    dim = spark.createDataFrame([(r,) for r in reasons], "reason string")
    return F.broadcast(dim).join(counts, "reason", "left").select("reason", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def reconciled(total: Column, *parts: Column) -> Column:
    """A5: the total, or an error if the parts do not add up to it."""
    added = parts[0]
    for p in parts[1:]:
        added = added + p
    return F.when(total == added, total).otherwise(F.raise_error(F.concat(F.lit("does not reconcile: "), total.cast("string"), F.lit(" <> "), added.cast("string"))).cast("long"))


def pivot_masked(rows: DataFrame, by: str, kind: str, kinds: list[str]) -> DataFrame:
    """Counts by kind; hidden cells are null, and a row's total is null if any of its cells is."""
    p = rows.groupBy(by).agg(*(F.count_if(F.col(kind) == k).alias(k) for k in kinds))
    cells = [masked(F.col(k)).alias(k) for k in kinds]
    total = sum((masked(F.col(k)) for k in kinds[1:]), masked(F.col(kinds[0])))
    return p.select(by, *cells, total.alias("total"))


def kind_order(rows: DataFrame, kind: str, known: list[str]) -> DataFrame:
    """Kinds with their place; unknown ones come after the known, sorted, and none is lost."""
    n = rows.groupBy(kind).agg(F.count("*").alias("n"))
    place = F.array_position(F.array(*map(F.lit, known)), F.coalesce(F.col(kind), F.lit("")))
    return n.select(kind, F.when(place > 0, place).otherwise(len(known) + 1).cast("int").alias("place"), "n").orderBy("place", kind)
