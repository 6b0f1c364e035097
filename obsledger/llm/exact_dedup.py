"""Exact dedup by two-pass Bloom filtering.

Pass one counts, per filter slot, how many texts fall on it; slots hit once or never prove a text
unique. Pass two tests each text against the slots hit repeatedly: only texts that pass may have a
copy, so only their (narrow) rows shuffle for the exact grouping by SHA-256, the others pass straight
through. A filter has a fixed largest size; a larger input is cut into slices of the hash space, each
with a filter of its own, so the broadcast never grows with the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, join_groups, maybe_in, scratch, stage

#: Largest filter, in bits (32 MiB), and bits spent on each text.
MAX_BITS = 1 << 28
BITS_PER_ROW = 16


def text_key(text: str = "text") -> Column:
    """SHA-256 in lowercase hex of the text without white space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", ""), 256)


def _slots(bits: int) -> list[Column]:
    """Two filter positions, from different hashes of the key."""
    return [F.pmod(F.xxhash64("sha", F.lit(k)), F.lit(bits)).alias(f"s{k}") for k in (1, 2)]


def _filter(keys: DataFrame, bits: int) -> bytes:
    """Bitmap of the slots that at least two rows fall on. Slot counts combine before they shuffle."""
    hit = (
        keys.select(F.explode(F.array(*_slots(bits))).alias("slot"))
        .groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("set"))
        .toArrow()
    )
    words = np.zeros(bits // 64, np.int64)
    words[hit["word"].to_numpy()] = hit["set"].to_numpy()
    return words.tobytes()


def _maybe_repeated(spark, bitmap: bytes, bits: int) -> Column:
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series) -> pd.Series:
        words = np.frombuffer(shared.value, np.uint8)
        a, b = a.to_numpy(np.int64), b.to_numpy(np.int64)
        return pd.Series(((words[a >> 3] >> (a & 7)) & (words[b >> 3] >> (b & 7)) & 1).astype(bool))

    return test(*_slots(bits))


def _flagged(keys: DataFrame, n: int, max_bits: int) -> list[DataFrame]:
    """The ``n`` staged ``keys`` with ``maybe``: whether another row may share their ``sha``; one part per hash slice.

    Beyond one filter the keys are written once more, a folder for each slice, so that each is read by its own filter only.
    """
    need = max(1 << 16, 1 << int(np.ceil(np.log2(max(1, n * BITS_PER_ROW)))))
    parts, bits = max(1, need // max_bits), min(need, max_bits)
    if parts == 1:
        return [keys.withColumn("maybe", _maybe_repeated(keys.sparkSession, _filter(keys, bits), bits))]
    dealt = stage(keys.withColumn("slice", F.pmod(F.xxhash64("sha"), F.lit(parts)).cast("int")), "exact-sliced", by="slice")
    out = []
    for k in range(parts):  # each result is written, which frees its filter before the next one is built
        own = dealt.where(F.col("slice") == k).drop("slice")
        out.append(stage(own.withColumn("maybe", _maybe_repeated(keys.sparkSession, _filter(own, bits), bits)), "exact-slice"))
    return out


def _keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, sha, row, uid) of every row, staged: id, code points, text key, hash of id and text, a number of the row."""
    size = F.length(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), size.alias("n"), text_key(text_col).alias("sha"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"))
    return stage(rows.withColumn("uid", F.monotonically_increasing_id()), "exact-keys")


def _groups(some: DataFrame) -> DataFrame:
    """(sha, best, group_size): of each text the row that stays: most code points, least id (null last), least hash."""
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("id").isNull().alias("z"), "id", "row", "uid")).alias("best")
    return some.groupBy("sha").agg(best, F.count("*").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after removing white space. Of equal texts the one with the most code
    points stays, then the smallest id. Null text counts as empty; a null id sorts after all others; of
    rows alike in text, length and id exactly one is kept. No rows in, no rows out.
    """
    keys = _keys(docs, id_col, text_col)
    n = keys.count()
    done = None
    for part in _flagged(keys, n, max_bits):
        alone = part.where(~F.col("maybe")).select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
        some = part.where("maybe")
        both = join_groups(some.select("id", "uid", "sha"), _groups(some), "sha", "group_size", n)
        found = both.select("id", F.col("best.id").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.uid")).alias("kept"), "sha")
        part = alone.unionByName(found)
        done = part if done is None else done.unionByName(part)
    return done.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    Texts are read and keyed once; only rows whose text has a copy shuffle, by the hash of id and text, so that
    no group meets in one task; every other row passes through the scan. Of rows alike in id and text the one of
    least hash over all columns stays. Other cases as in :func:`exact_dedup`.
    """
    with scratch() as keep:
        keys = _keys(docs, id_col, text_col)
        n = keys.count()
        several = None
        for part in _flagged(keys, n, max_bits):
            some = part.where("maybe")
            groups = _groups(some).where("group_size > 1")
            found = join_groups(some.select("row", "sha"), groups, "sha", "group_size", n).select("row", F.col("best.row").alias("best"))
            several = found if several is None else several.unionByName(found)
        several = keep(stage(several.groupBy("row").agg(F.max(F.col("row") == F.col("best")).alias("stays")), "exact-several"))
    every = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    wide = docs.select(every.alias("d"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")).withColumn("maybe", maybe_in(several, "row"))
    met = wide.where("maybe").join(several, "row", "left")
    kept = met.where("stays").groupBy("row").agg(F.min_by("d", F.xxhash64(F.to_json("d"))).alias("d")).select("d")
    out = wide.where(~F.col("maybe")).select("d").unionByName(met.where("stays IS NULL").select("d")).unionByName(kept)
    return out.select(*(F.col(f"d.`{c}`") for c in docs.columns))
