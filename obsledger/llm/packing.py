"""Packing into length buckets of least padding.

A text is cut into sequences of at most ``max_tokens`` tokens. Dynamic programming over the global
histogram of sequence lengths (rounded up to ``step``) finds the bucket boundaries that minimise padding;
in each bucket sequences are dealt, in an order given by a hash, into batches of a fixed token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, stage

#: Longest sequence, rounding of lengths, number of buckets, tokens of a batch with its padding.
MAX_TOKENS, STEP, BUCKETS, BUDGET = 4096, 32, 8, 65536
#: Rows that one group of equal hash digits is meant to hold.
GROUP_ROWS = 50_000
#: Rows of offsets up to which they are broadcast (some 30 bytes each); beyond, they are joined by a shuffle.
BROADCAST_ROWS = 600_000


def byte_tokens(text: str = "text") -> Column:
    """Tokens of a byte-level vocabulary: the bytes of the whole UTF-8 text; null has none."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")


def best_boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` upper bounds of lengths (in steps) that minimise the padded total; ties go to the lowest bounds.

    ``histogram``: rounded length in steps (from 1 on) -> sequences. The last bound is the longest length.
    """
    if not histogram:
        return []
    top = max(histogram)
    count = np.zeros(top + 1, np.int64)
    for k, v in histogram.items():
        count[k] = v
    below = count.cumsum()
    j = np.arange(top + 1)
    cost = np.where(j == 0, 0, np.iinfo(np.int64).max // 4)
    back = []
    for _ in range(buckets):
        total = cost[:, None] + (below[None, :] - below[:, None]) * j[None, :]  # from bound i to bound j
        total = np.where(j[:, None] <= j[None, :], total, np.iinfo(np.int64).max // 2)
        back.append(total.argmin(0))
        cost = total.min(0)
    bounds, at = [], top
    for choice in reversed(back):
        bounds.append(at)
        at = int(choice[at])
    return sorted({b for b in bounds if b > 0})


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None, max_tokens: int = MAX_TOKENS, step: int = STEP) -> DataFrame:
    """(id, name, piece, start, n_tokens, steps): every text in pieces of at most ``max_tokens``; an empty one keeps one of 0.

    ``name`` is the id as text, or the MD5 of the text where the id is null, so that rows without an id fall apart.
    """
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(as_bytes(text_col)))
    n = docs.select(F.col(id_col).alias("id"), name.alias("name"), (byte_tokens(text_col) if tokens is None else tokens).alias("n"))
    out = n.select("id", "name", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / max_tokens) - 1, F.lit(0)))).alias("piece"))
    out = out.withColumn("start", F.col("piece") * max_tokens).withColumn("n_tokens", F.least(F.col("n") - F.col("start"), F.lit(max_tokens)))
    return out.select("id", "name", "piece", "start", "n_tokens", F.greatest(F.ceil(F.col("n_tokens") / step), F.lit(1)).cast("long").alias("steps"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None, max_tokens: int = MAX_TOKENS, step: int = STEP, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """One row per sequence: the id, piece, start, n_tokens, ``bucket_tokens`` (padded length), ``batch``, ``slot``.

    ``batch`` counts from 0 in each bucket; a batch holds ``max(1, budget // bucket_tokens)`` sequences and
    only a bucket's last may hold fewer. The order is that of the MD5 of id (or text) and piece, so it depends on
    neither partitions nor run. Null text is empty; rows alike in id are separate sequences; no rows give none.
    """
    seq = stage(sequences(docs, id_col, text_col, tokens, max_tokens, step).withColumn("key", F.md5(F.concat_ws(":", "name", "piece").cast("binary"))), "pack-sequences")
    found = seq.groupBy("steps").agg(F.count("*").alias("n")).collect()  # at most max_tokens / step rows
    histogram = {r["steps"]: r["n"] for r in found}
    bounds = best_boundaries(histogram, buckets)
    if not bounds:
        return seq.select(F.col("id").alias(id_col), "piece", "start", "n_tokens", F.lit(0).cast("long").alias("bucket_tokens"), F.lit(0).cast("long").alias("batch"), F.lit(0).cast("long").alias("slot"))
    bucket = F.lit(bounds[-1])
    for b in reversed(bounds[:-1]):
        bucket = F.when(F.col("steps") <= b, F.lit(b)).otherwise(bucket)
    digits = 2
    while sum(histogram.values()) > 16**digits * GROUP_ROWS:
        digits += 1
    seq = seq.withColumn("bucket", bucket).withColumn("digits", F.substring("key", 1, digits))
    sizes = seq.groupBy("bucket", "digits").agg(F.count("*").alias("n"))  # at most buckets * 16^digits rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy("bucket").orderBy("digits").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("bucket", "digits", before.alias("before"))
    offsets = F.broadcast(offsets) if buckets * 16**digits <= BROADCAST_ROWS else offsets
    w = Window.partitionBy("bucket", "digits").orderBy("key", F.col("id").isNull(), "id", "piece", "n_tokens")
    at = seq.withColumn("k", F.row_number().over(w)).join(offsets, ["bucket", "digits"]).withColumn("at", F.col("before") + F.col("k") - 1)
    room = F.greatest(F.floor(F.lit(budget) / (F.col("bucket") * step)), F.lit(1)).cast("long")
    return at.select(F.col("id").alias(id_col), "piece", "start", "n_tokens", (F.col("bucket") * step).cast("long").alias("bucket_tokens"), F.floor(F.col("at") / room).cast("long").alias("batch"), (F.col("at") % room).cast("long").alias("slot"))
