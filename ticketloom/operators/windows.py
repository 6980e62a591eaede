"""Ranking within keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def share_of_total(counts: DataFrame, col: str = "count", out: str = "share") -> DataFrame:
    """Adds each row's part of the grand total; the total is a scalar subquery, not a global window."""
    total = counts.agg(F.sum(col)).scalar()
    return counts.withColumn(out, F.col(col).cast("double") / total.cast("double"))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key; tasks cut their own rows to ``k`` before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def top_k_per_query(df: DataFrame, k: int, query: str = "qid", doc: str = "doc_id") -> DataFrame:
    return top_k(df, [query], [F.round("distance", 9), F.col(doc)], k)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "__rank").drop("__rank")


def latest_per_key(df: DataFrame, keys: list[str], time: str, tie: str) -> DataFrame:
    return first_per_key(df, keys, [F.desc(time), F.desc(tie)])


def first_user_message(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation the content of its first user message, '' if it has none."""
    first = F.min_by(F.col("content"), F.when(F.col("role") == "user", F.col(turn)))
    return messages.groupBy(conv).agg(F.coalesce(first, F.lit("")).alias("first_user_message"))
