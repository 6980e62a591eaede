"""Immutable dataset snapshots, one directory per timestamp."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.text import ts_parse
from ticketloom.session import folder_names


def write_snapshot(df: DataFrame, root: str, stamp: str) -> str:
    """Write ``df`` as snapshot ``stamp`` (yyyyMMdd_HHmmss); an existing snapshot is never replaced.

    Snapshots are kept and hold whole texts, so they are compressed more than scratch tables.
    """
    path = f"{root}/snapshot={stamp}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return path


def snapshot_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the stored snapshots in order, from one listing by Spark's own file system."""
    names = folder_names(spark, root)
    return sorted(n.removeprefix("snapshot=") for n in names if n.startswith("snapshot="))


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """One row (snapshot, snapshot_at): the newest by name; none if there is no snapshot. Lists folders only."""
    name = spark.createDataFrame([(n,) for n in snapshot_names(spark, root)[-1:]], "snapshot string")
    return name.select("snapshot", ts_parse(F.col("snapshot")).alias("snapshot_at"))


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest snapshot; only its directory is scanned."""
    newest = snapshot_names(spark, root)[-1]
    return spark.read.parquet(f"{root}/snapshot={newest}").withColumn("snapshot", F.lit(newest))
