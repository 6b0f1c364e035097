"""Helpers shared by the training-data operators: staged tables, row batches, skew-safe joins."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest filter of marked rows, in bits (32 MiB), and bits spent on each.
MAX_BITS, BITS_PER_ROW = 1 << 28, 16
#: Tables staged in each open :func:`scratch`, the innermost last.
_SCRATCH: list[list[DataFrame]] = []
#: ``\s`` of the contracts: space and \x09-\x0D, nothing else.
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode where none is configured."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='obsledger-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stage(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet below the shared folder and read it again; ``by``: a folder for each value.

    The written files survive the loss of any executor and fix values such as row ids.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{tag}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    if _SCRATCH:
        _SCRATCH[-1].append(out)
    return out


@contextmanager
def scratch():
    """Tables staged inside are deleted at the end, save those passed to the function that it gives: once what
    follows from them is written itself, nothing reads them again."""
    own: list[DataFrame] = []
    kept: list[DataFrame] = []
    _SCRATCH.append(own)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        _SCRATCH.pop()
        for df in own:
            if not any(df is k for k in kept):
                drop_staged(df)
            elif _SCRATCH:
                _SCRATCH[-1].append(df)


def drop_staged(df: DataFrame | None) -> None:
    """Delete a staged table that no later step reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def rows_of(batches, step: int = 256):
    """Python tuples of the rows of Arrow record batches, a slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def as_bytes(text: str | None = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join ``rows`` with one row per ``key``, whatever share of the rows a key holds.

    Groups of more than a thousandth of ``total`` rows are at most 1000 by arithmetic, so they are
    broadcast; the rest is joined by a shuffle whose largest group is that thousandth.
    Both inputs are read twice: pass staged or cheap ones. Null keys match nothing.
    """
    limit = max(total // 1000, 1)
    hot = F.broadcast(groups.where(F.col(size) > limit))
    few = groups.where(F.col(size) <= limit)
    rest = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(few, key))


def bitmap_of(marks: DataFrame, *cols: str, max_bits: int = MAX_BITS):
    """The slot of a row's ``cols`` and a broadcast bitmap, of fixed largest size, of the slots that ``marks`` (a staged table) has."""
    bits = min(max_bits, max(1 << 16, 1 << int(np.ceil(np.log2(max(1, marks.count() * BITS_PER_ROW))))))
    slot = F.pmod(F.xxhash64(*cols), F.lit(bits))
    hit = marks.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("set")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[hit["word"].to_numpy()] = hit["set"].to_numpy()
    return slot, marks.sparkSession.sparkContext.broadcast(words.tobytes())


def in_bitmap(bitmap: bytes, at: np.ndarray) -> np.ndarray:
    """Which of the slots ``at`` are set."""
    return ((np.frombuffer(bitmap, np.uint8)[at >> 3] >> (at & 7)) & 1).astype(bool)


def maybe_of(slot: Column, shared) -> Column:
    """Whether a row's slot is set in the broadcast bitmap."""

    @F.pandas_udf("boolean")
    def test(at: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, at.to_numpy(np.int64)))

    return test(slot)


def maybe_in(marks: DataFrame, *cols: str, max_bits: int = MAX_BITS) -> Column:
    """Whether a row's ``cols`` may be among those of ``marks`` (a staged table); false only if they are not."""
    return maybe_of(*bitmap_of(marks, *cols, max_bits=max_bits))


def order_id(name: str) -> list[Column]:
    """Ids in ascending order, null after all others."""
    return [F.col(name).isNull(), F.col(name)]
