"""Sorted heads, reproducible samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions import text
from ticketloom.functions.vectors import cosine_distance
from ticketloom.operators.ordering import hash_fraction, hash_key, hashed_position, row_index, with_cutoffs


def sort_desc_limit(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(n)


def preview(df: DataFrame, n: int, id_col: str = "id", cut: dict[str, int] | None = None) -> DataFrame:
    """First ``n`` rows by id, long columns cut to the given lengths."""
    cut = cut or {}
    shown = df.select(*[text.left_n(F.col(c), cut[c]).alias(c) if c in cut else F.col(c) for c in df.columns])
    return shown.orderBy(id_col).limit(n)


def first_matches(df: DataFrame, predicate: Column, n: int, id_col: str = "id") -> DataFrame:
    return df.where(predicate).orderBy(id_col).limit(n)


def nearest_k(df: DataFrame, vector: Sequence[float], k: int, id_col: str, col: str = "embedding") -> DataFrame:
    """The ``k`` rows nearest to one query vector; each task keeps ``k`` rows, and no row is shuffled."""
    query = F.array(*[F.lit(float(x)) for x in vector])
    ranked = df.withColumn("distance", cosine_distance(F.col(col), query)).where(F.col("distance").isNotNull())
    return ranked.orderBy(F.round("distance", 9), F.col(id_col)).limit(k)


def hash_sample(df: DataFrame, n: int, seed: int | str, id_col: str = "id") -> DataFrame:
    """``n`` rows at random, the same ones for the same seed."""
    return df.orderBy(hash_key(id_col, seed), F.col(id_col)).limit(n)


def top_sources(sources: Column, n: int = 3) -> Column:
    return F.slice(sources, 1, n)


def stratified_position(df: DataFrame, strata: list[str], seed: int | str, id_col: str = "id") -> DataFrame:
    """Adds ``position`` and ``stratum_size``."""
    return hashed_position(df, id_col, seed, strata)


def stratified_split(
    df: DataFrame,
    strata: list[str],
    test: float,
    val: float = 0.0,
    seed: int | str = 42,
    id_col: str = "id",
) -> DataFrame:
    """Adds ``split``: a ``test`` share of each stratum, then a ``val`` share of its rest, then train."""

    def ends(size: Column) -> list[Column]:
        n_test = F.round(size * F.lit(test))
        return [n_test, n_test + F.round((size - n_test) * F.lit(val))]

    placed = with_cutoffs(df, id_col, seed, strata, ends)
    h = F.col("__hash")
    split = F.when(h <= F.col("cut_0"), "test").when(h <= F.col("cut_1"), "val").otherwise("train")
    return placed.withColumn("split", split).drop("__hash", "cut_0", "cut_1")


def random_split(df: DataFrame, test: float = 0.2, seed: int | str = 42, id_col: str = "id") -> DataFrame:
    """Adds ``split`` from the hash alone; no shuffle."""
    return df.withColumn("split", F.when(hash_fraction(id_col, seed) < test, "test").otherwise("train"))


def split_part(df: DataFrame, part: str) -> DataFrame:
    return df.where(F.col("split") == part).drop("split")


def split_complement(df: DataFrame, part: str) -> DataFrame:
    """The rows outside one split; together with ``split_part`` they cover the table."""
    return df.where(F.col("split") != part).drop("split")


def stratified_sample(
    df: DataFrame, strata: list[str], n: int, seed: int | str = 42, id_col: str = "id"
) -> DataFrame:
    """About ``n`` rows, each stratum by its share and at least once; all rows if there are no more."""
    total = df.count()
    if total <= n:
        return df

    def quota(size: Column) -> list[Column]:
        return [F.greatest(F.lit(1), F.floor(size * F.lit(float(n)) / F.lit(total)))]

    placed = with_cutoffs(df, id_col, seed, strata, quota)
    return placed.where(F.col("__hash") <= F.col("cut_0")).drop("__hash", "cut_0")


def halves(df: DataFrame, fraction: float, id_col: str = "id") -> DataFrame:
    """Adds ``half``: 'reference' for the first ``fraction`` of the rows by id, else 'current'."""
    indexed = row_index(df, id_col, "__index", "__total")
    cut = F.floor(F.col("__total") * F.lit(fraction))
    half = F.when(F.col("__index") < cut, "reference").otherwise("current")
    return indexed.withColumn("half", half).drop("__index", "__total")


def ticket_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds ``row_index`` and ``ticket_id`` (``ticket_<index>``)."""
    indexed = row_index(df, id_col)
    return indexed.withColumn("ticket_id", F.concat(F.lit("ticket_"), F.col("row_index").cast("string")))
