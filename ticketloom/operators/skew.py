"""Joins that hold up when one key has a large part of the rows.

``lookup_join`` attaches a table with one row per key: broadcast when a count shows it is small, by a
salted shuffle join otherwise. AQE's own skew handling does not reach these joins, because the lookup
side usually is an aggregate on the same key and then has no shuffle of its own to split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import cut_lineage

MAX_SHARE = 1 / 256
SALT_ROWS = 1_000_000
MIN_SALTS = 64
MAX_BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, keys: list[str], max_share: float = MAX_SHARE) -> DataFrame:
    """(keys, rows) of the keys holding more than ``max_share`` of the rows: fewer than ``1 / max_share``."""
    total = df.agg(F.count("*")).scalar()
    counts = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).groupBy(*keys)
    return counts.agg(F.count("*").alias("__n")).where(F.col("__n") > total * F.lit(max_share))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    salts: int = MIN_SALTS,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """Join where ``left`` may be skewed on ``keys``; ``how`` is 'inner', 'left' or 'left_semi'.

    Only rows of hot keys get a salt, one per ``SALT_ROWS`` rows of the key but ``salts`` at least, taken from ``spread_by`` (columns that differ between copies) so
    that a retried task draws the same one. The matching rows of ``right`` are repeated per salt.
    """
    # bounded: fewer than 1 / max_share rows, counted once
    found = cut_lineage(hot_keys(left, keys, max_share))
    wanted = F.greatest(F.lit(salts), F.ceil(F.col("__n") / SALT_ROWS)).cast("int")
    hot = F.broadcast(found.withColumn("__salts", wanted).drop("__n"))
    mark = F.xxhash64(*(spread_by or [c for c in left.columns if c not in keys]))
    spread = F.pmod(mark, F.coalesce("__salts", F.lit(salts)))
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salted_left = (
        left.join(hot, keys, "left")
        .withColumn("__salt", F.when(F.col("__salts").isNotNull() | some_null, spread).otherwise(F.lit(0)).cast("int"))
        .drop("__salts")
    )
    salted_right = (
        right.join(hot, keys, "left")
        .withColumn(
            "__salt",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts") - 1, F.lit(0)))),
        )
        .drop("__salts")
    )
    return salted_left.join(salted_right, [*keys, "__salt"], how).drop("__salt")


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    spread_by: list[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Attach ``table``, which has one row per key, to every row of ``left``.

    The table is evaluated once and counted. Up to ``max_rows`` narrow rows are broadcast, and ``left``
    is not shuffled at all; more go through ``skew_join``.
    """
    stored = cut_lineage(table)
    if is_small(stored, max_rows):
        return left.join(F.broadcast(stored), keys, how)
    return skew_join(left, stored, keys, how, spread_by)
