"""Intermediate tables on storage that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only in local mode where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='obsledger-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written below the shared folder and read again: several steps read it, none computes it twice."""
    path = f"{shared_dir(df.sparkSession)}/staged/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
