"""Benchmark decontamination by template canonicalisation, in DataFrame operations only.

Numbers, names and units of a text become typed placeholders; windows of the resulting template words
are hashed and joined with those of the benchmark. An item whose windows are found to a given share is a
candidate; it counts as leaked if its slots are consistent along its best alignment or any other that holds
the share by itself: every value of the item stands for one value of the document, and slots that stand
against a word of another type stay below what the share allows. Re-parameterised questions are caught as
well as verbatim ones, chance matches of bare templates are not. Items without a window to index are sought
as whole token sequences instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, stage

#: Words of a window, the share of an item's windows that a leak needs, plain words that a window needs.
WIDTH, SHARE, PLAIN = 5, 0.8, 3
#: Rows and bytes up to which a side is broadcast; beyond, the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
#: Units that become a placeholder (fixed values).
UNITS = (
    "kg", "g", "mg", "km", "m", "cm", "mm", "mile", "miles", "foot", "feet", "inch", "inches", "yard", "yards", "liter", "liters", "litre", "litres", "ml",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years",
    "dollar", "dollars", "cent", "cents", "euro", "euros", "pound", "pounds", "percent", "mph", "kmh",
)
#: Words that open sentences and are no names, whatever their case (fixed values); any other capitalised word is a name.
OPENERS = (
    "a", "an", "the", "this", "that", "these", "those", "he", "she", "it", "we", "you", "they", "his", "her", "its", "our", "your", "their", "who", "what", "which", "when", "where", "why", "how",
    "if", "in", "on", "at", "by", "for", "from", "of", "to", "with", "and", "or", "but", "so", "then", "there", "as", "after", "before", "each", "every", "all", "some", "is", "are", "was", "were",
    "do", "does", "did", "can", "find", "let", "given", "suppose", "calculate", "compute", "determine", "consider",
)


def _by_first_letter(words: tuple[str, ...]) -> str:
    """An alternation that tests each word's first letter once."""
    return "|".join(f"{c}(?:{'|'.join(w[1:] for w in words if w[0] == c)})" for c in sorted({w[0] for w in words}))


_LETTER = r"[\p{L}\p{M}]"
NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"
TOKEN = rf"{_LETTER}+|{NUMBER}"
CAPITALISED = r"\p{Lu}\p{Ll}+"
_NAME = rf"(?=\p{{Lu}})(?<!{_LETTER})(?!(?:{'|'.join(w.capitalize() for w in OPENERS)})(?!{_LETTER})){CAPITALISED}(?!{_LETTER})"
_UNIT = rf"(?<!{_LETTER})(?:{_by_first_letter(UNITS)})(?!{_LETTER})"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, even where lambdas in ``use`` refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tokens(text: Column) -> Column:
    """Words and numbers of a text in order, as written; null as empty."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def template(text: Column, names: bool = True) -> Column:
    """The template words of :func:`tokens`, one for each: 0 number, 1 name, 2 unit, else the lower-cased word.

    Whole texts are rewritten at a time, numbers first, so that digits can mark the placeholders. Without
    ``names`` these stay words, as in a text that lost its capitals.
    """
    out = F.regexp_replace(F.coalesce(text, F.lit("")), NUMBER, " 0 ")
    if names:
        out = F.regexp_replace(out, _NAME, " 1 ")
    out = F.regexp_replace(F.lower(out), _UNIT, " 2 ")
    return F.regexp_extract_all(out, F.lit(rf"{_LETTER}+|[012]"), F.lit(0))


def _slot(token: Column) -> Column:
    """The placeholder of a single token, null for a plain word; agrees with :func:`template`."""
    low = F.lower(token)
    return F.when(token.rlike(r"^\p{N}"), "0").when(token.rlike(f"^{CAPITALISED}$") & ~low.isin(*OPENERS), "1").when(low.isin(*UNITS), "2")


def _windows(df: DataFrame, words: str, width: int, keep: list[str], at: str) -> DataFrame:
    """``keep``, ``at`` and ``h``: the hash of each window of ``words``; all in one generated stage."""
    every = df.select(*keep, words, F.posexplode_outer(words).alias(at, "_word")).where(F.col(at) <= F.size(words) - width)  # outer: no filter is inferred that would compute ``words`` twice
    return every.select(*keep, at, F.xxhash64(*(F.get(words, F.col(at) + k) for k in range(width))).alias("h"))


def _benchmark(items: DataFrame, id_col: str, text_col: str, width: int, plain: int) -> tuple[DataFrame, DataFrame]:
    """Items (item, toks, marks, total) and their indexed windows (h, item, at, total).

    A window is indexed as written and, at the same place, with its names as words.
    """
    text = F.col(text_col)
    base = items.where(text.isNotNull()).select(F.col(id_col).alias("item"), tokens(text).alias("toks"), template(text).alias("canon"), template(text, False).alias("flat"))
    base = stage(base.dropDuplicates(["item", "toks"]).withColumn("key", F.xxhash64("item", "toks")), "bench-items")
    own = _windows(base, "canon", width, ["key", "item", "canon"], "at")
    own = own.where(F.size(F.filter(F.slice("canon", F.col("at") + 1, width), lambda c: ~c.isin("0", "1", "2"))) >= plain).select("key", "item", "at", "h")
    flat = _windows(base, "flat", width, ["key", "item"], "at").join(own.select("key", "at"), ["key", "at"], "left_semi").select("key", "item", "at", "h")
    total = own.groupBy("key").agg(F.count("*").alias("total"))
    base = stage(base.join(total, "key", "left").select("key", "item", "toks", F.transform("toks", _slot).alias("marks"), F.coalesce("total", F.lit(0)).alias("total")), "bench-totals")
    windows = own.unionByName(flat).distinct().join(base.select("key", "total"), "key")
    return base, stage(windows.select("h", "key", "item", "at", "total"), "bench-windows")


def _small(df: DataFrame, size: Column | int = 40) -> DataFrame:
    """``df`` marked for broadcast if its counted rows and bytes (``size`` a row) allow it."""
    n, total = df.agg(F.count("*"), F.sum(F.lit(size) if isinstance(size, int) else size)).first()
    return F.broadcast(df) if n <= BROADCAST_ROWS and (total or 0) <= BROADCAST_BYTES else df


def _token_bytes(toks: str) -> Column:
    return F.aggregate(toks, F.lit(64).cast("long"), lambda n, t: n + F.octet_length(t) + 32)


def _inconsistent(share: float) -> Column:
    """Whether the item's slots break along an alignment: ``toks`` and ``marks`` of the item, ``theirs`` of the document."""
    pair = lambda t, b: F.struct(F.lower(t["toks"]).alias("a"), F.lower(b).alias("b"), F.coalesce((_slot(b) == t["marks"]) | (F.lower(b) == F.lower(t["toks"])), F.lit(False)).alias("ok"), t["marks"].isNotNull().alias("slot"))
    slots = F.filter(F.zip_with(F.arrays_zip("toks", "marks"), "theirs", pair), lambda p: p["slot"])

    def judge(s):
        good = F.array_distinct(F.transform(F.filter(s, lambda p: p["ok"]), lambda p: F.struct(p["a"], p["b"])))
        own = F.array_distinct(F.transform(good, lambda p: p["a"]))
        return (F.size(good) > F.size(own)) | (F.size(F.filter(s, lambda p: ~p["ok"])) > F.lit(1 - share) * F.size(s))

    return _let(slots, judge)


def _whole_items(docs: DataFrame, row: Column, text_col: str, short: DataFrame, width: int, plain: int) -> DataFrame:
    """(row, item, coverage 1) where the tokens of an item without windows stand in a text, case aside.

    Items of fewer than ``plain`` tokens count only where they are the whole text.
    """
    short = short.withColumn("own", F.transform("toks", F.lower)).withColumn("size", F.least(F.size("toks"), F.lit(width)))
    sizes = sorted(r["size"] for r in short.select("size").distinct().collect())  # at most ``width`` values
    head = F.coalesce(*(F.when(F.col("size") == n, F.xxhash64(*(F.get("own", F.lit(k)) for k in range(n)))) for n in sizes))
    short = short.select("item", "own", "size", head.alias("h"))
    words = docs.select(row, tokens(F.lower(F.col(text_col))).alias("w")).select("row", "w", F.posexplode("w").alias("pos", "_word"))
    at = [F.struct(F.lit(n).alias("size"), F.when(F.col("pos") <= F.size("w") - n, F.xxhash64(*(F.get("w", F.col("pos") + k) for k in range(n)))).alias("h")) for n in sizes]
    met = words.select("row", "w", "pos", F.explode(F.array(*at)).alias("x")).select("row", "w", "pos", "x.size", "x.h").join(_small(short, _token_bytes("own")), ["size", "h"])
    same = (F.slice("w", F.col("pos") + 1, F.size("own")) == F.col("own")) & ((F.size("own") >= plain) | (F.size("w") == F.size("own")))
    return met.where(same).select("row", "item", F.lit(1.0).alias("coverage")).distinct()


def find_leaks(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, share: float = SHARE, plain: int = PLAIN) -> DataFrame:
    """(row, item, coverage): benchmark items found in rows; ``row`` is the hash of a row's id and text.

    Null and empty texts hold and leak nothing, nor do items without a word or number. An item too short for
    an indexed window, or of placeholders only, is found where its whole token sequence stands (below
    ``plain`` tokens: where it is the whole text). Items that share an id are judged one by one. Rows alike
    in id and text share their findings; no rows or no items give no findings.
    """
    items, windows = _benchmark(bench, item_id, item_text, width, plain)
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")
    words = docs.select(row, template(F.col(text_col)).alias("w"))
    seen = _windows(words, "w", width, ["row"], "pos").join(_small(windows), "h")
    lines = seen.groupBy("row", "key", "item", "total", (F.col("pos") - F.col("at")).alias("shift")).agg(F.collect_set("at").alias("ats"))
    best = lines.groupBy("row", "key", "item", "total").agg(
        F.max(F.struct(F.size("ats").alias("n"), (-F.col("shift")).alias("back"))).alias("best"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("n"),
        F.collect_list(F.when(F.size("ats") >= F.lit(share) * F.col("total"), F.col("shift"))).alias("full"),
    )
    shifts = F.array_distinct(F.concat(F.array(-F.col("best.back")), F.col("full"))).alias("shifts")
    found = stage(best.where(F.col("n") >= F.lit(share) * F.col("total")).select("row", "key", "item", (F.col("n") / F.col("total")).alias("coverage"), shifts), "leak-candidates")
    slotted = items.where(F.exists("marks", lambda m: m.isNotNull())).select("key", "toks", "marks")
    side = _small(found.select("row", "key", "shifts"), 16 + 8 * F.size("shifts"))
    placed = docs.select(row, F.col(text_col).alias("text")).join(side, "row").join(_small(slotted, _token_bytes("toks")), "key")
    aligned = lambda doc: F.transform(F.sequence(F.lit(0), F.size("toks") - 1), lambda i: F.get(doc, i + F.col("shift")))
    placed = placed.select("row", "key", "toks", "marks", "text", F.explode("shifts").alias("shift")).withColumn("theirs", _let(tokens(F.col("text")), aligned))
    bad = placed.select("row", "key", _inconsistent(share).alias("bad")).groupBy("row", "key").agg(F.min("bad").alias("bad")).where("bad").select("row", "key")
    leaks = found.join(bad, ["row", "key"], "left_anti").select("row", "item", "coverage")
    short = items.where((F.col("total") == 0) & (F.size("toks") > 0)).select("item", "toks")
    return leaks if short.isEmpty() else leaks.unionByName(_whole_items(docs, row, text_col, short, width, plain))


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, ``leaked``, ``n_items``, ``items`` (sorted ids), ``coverage`` (the largest; 0 if none).

    Null, empty and repeated rows and null ids as in :func:`find_leaks`; every row is returned, no rows give none.
    """
    leaks = find_leaks(docs, bench, id_col, text_col, **options).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"), F.max("coverage").alias("coverage"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"))
    item = leaks.schema["items"].dataType.simpleString()
    return rows.join(leaks, "row", "left").select(
        F.col("id").alias(id_col), F.col("items").isNotNull().alias("leaked"), F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast(item)).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def drop_leaked(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with their own columns, whatever these are called.

    Rows with a null id or text are judged like any other (null text leaks nothing); repeated rows stay or go together.
    """
    with scratch() as keep:
        rows = keep(stage(find_leaks(docs, bench, id_col, text_col, **options).select("row").distinct(), "leaked-rows"))
    side = _small(rows.withColumnRenamed("row", "_leak_row")).alias("k")
    wide = docs.alias("d")
    return wide.join(side, F.xxhash64(F.col(f"d.`{id_col}`"), F.col(f"d.`{text_col}`")) == F.col("k._leak_row"), "left_anti")
