"""Session defaults and table loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session with the settings that the library expects: UTC, adaptive plans, no progress bar."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("obsledger")
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for k, v in (base | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
