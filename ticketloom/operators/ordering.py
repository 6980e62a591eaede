"""Positions and running sums over a whole table without a single-task window.

A window without partition keys, or with a few hot ones, runs in one task per key. Here every
partition key is cut into buckets of its order first: the inner window runs per bucket, and the
small table of bucket totals supplies the offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.operators.skew import is_small
from ticketloom.session import cut_lineage

ROWS_PER_BUCKET = 100_000
BUCKETS = 64


def hash_key(id_col: str | Column, seed: int | str) -> Column:
    """Reproducible random order: sha-256 of seed and id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.sha2(F.concat(F.lit(f"{seed}-"), c.cast("string")), 256)


def hash_fraction(id_col: str | Column, seed: int | str) -> Column:
    """A number in [0, 1) drawn from the hash; needs no shuffle."""
    return F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _digits(df: DataFrame) -> int:
    """Hex digits that tell apart enough buckets for the counted rows."""
    buckets = df.count() / ROWS_PER_BUCKET
    return next(n for n in range(1, 16) if 16**n >= buckets)


def hashed_position(
    df: DataFrame,
    id_col: str,
    seed: int | str,
    strata: list[str] | None = None,
    digits: int | None = None,
    position: str = "position",
    size: str = "stratum_size",
) -> DataFrame:
    """Adds the 1-based position in hash order within each stratum, and the size of the stratum.

    The first ``digits`` hex digits of the hash split a stratum into 16^digits equal buckets, by default so many
    that even a stratum of all rows has buckets of at most ``ROWS_PER_BUCKET`` rows on average.
    """
    strata, digits = list(strata or []), digits or _digits(df)
    keys = [*strata, "__bucket"]
    h = hash_key(id_col, seed)
    keyed = df.withColumn("__hash", h).withColumn("__bucket", F.substring("__hash", 1, digits))
    totals = keyed.groupBy(*keys).agg(F.count("*").alias("__n"))
    # one row per stratum and bucket: at most 16^digits rows per window partition
    whole = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        F.sum("__n").over(whole).alias("__size"),
    )
    inner = Window.partitionBy(*keys).orderBy("__hash", id_col)
    ranked = keyed.withColumn("__rn", F.row_number().over(inner))
    # one row per stratum and bucket: broadcast if few, so that the ranked rows are not shuffled again
    offsets = cut_lineage(offsets)
    side = F.broadcast(offsets) if is_small(offsets) else offsets
    joined = ranked.join(side, _same(ranked, offsets, keys))
    return joined.select(
        *[ranked[c] for c in df.columns],
        (F.col("__rn") + F.col("__offset")).alias(position),
        F.col("__size").alias(size),
    )


def hash_cutoffs(
    df: DataFrame,
    id_col: str,
    seed: int | str,
    strata: list[str],
    targets: Callable[[Column], list[Column]],
    digits: int | None = None,
) -> DataFrame:
    """Per stratum the hash at which each of the wanted positions is reached.

    ``targets`` gives the positions from the size of the stratum. Output: the strata and one column
    ``cut_<i>`` per target, '' for position 0. Only narrow (stratum, hash) rows are read, and only the
    one bucket of a stratum that holds a wanted position is ranked, so telling on which side of a
    position a row lies takes no shuffle of the rows themselves.
    """
    digits = digits or _digits(df)
    narrow = df.select(*strata, F.col(id_col), hash_key(id_col, seed).alias("__hash"))
    narrow = narrow.withColumn("__bucket", F.substring("__hash", 1, digits))
    totals = narrow.groupBy(*strata, "__bucket").agg(F.count("*").alias("__n"))
    # at most 16^digits rows per stratum
    whole = Window.partitionBy(*strata)
    before = whole.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.select(
        *strata,
        "__bucket",
        "__n",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"),
        F.sum("__n").over(whole).alias("__size"),
    )
    wanted = F.posexplode(F.array(*[t.cast("bigint") for t in targets(F.col("__size"))]))
    exploded = placed.select("*", wanted.alias("__target", "__position"))
    inside = F.col("__position").between(F.col("__offset") + 1, F.col("__offset") + F.col("__n"))
    edges = exploded.where(inside).select(
        *strata, "__bucket", "__target", (F.col("__position") - F.col("__offset")).alias("__place")
    )
    edges = cut_lineage(edges)
    # one row per stratum and target
    edges_side = F.broadcast(edges) if is_small(edges) else edges
    joined = narrow.join(edges_side, _same(narrow, edges, [*strata, "__bucket"])).select(
        *[narrow[s] for s in strata], narrow["__bucket"], "__hash", narrow[id_col], "__target", "__place"
    )
    order = Window.partitionBy(*strata, "__bucket", "__target").orderBy("__hash", id_col)
    hits = joined.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") == F.col("__place"))
    n_targets = len(targets(F.lit(0)))
    cuts = [
        F.coalesce(F.max(F.when(F.col("__target") == i, F.col("__hash"))), F.lit("")).alias(f"cut_{i}")
        for i in range(n_targets)
    ]
    return hits.groupBy(*strata).agg(*cuts)


def with_cutoffs(
    df: DataFrame,
    id_col: str,
    seed: int | str,
    strata: list[str],
    targets: Callable[[Column], list[Column]],
    hashed: str = "__hash",
) -> DataFrame:
    """``df`` with its hash and the cut-offs of its stratum; '' where no position was wanted."""
    cutoffs = cut_lineage(hash_cutoffs(df, id_col, seed, strata, targets))
    names = [c for c in cutoffs.columns if c.startswith("cut_")]
    side = F.broadcast(cutoffs) if is_small(cutoffs) else cutoffs
    joined = df.join(side, _same(df, cutoffs, strata), "left")
    return joined.select(
        *[df[c] for c in df.columns],
        hash_key(df[id_col], seed).alias(hashed),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in names],
    )


def bucket_count(df: DataFrame) -> int:
    """As many buckets as the session has shuffle partitions, but not fewer than 64."""
    return max(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def split_points(df: DataFrame, col: str, buckets: int) -> list[float]:
    """At most ``buckets - 1`` values that cut a numeric column into similar parts.

    Evaluated once, so that every use of a bucket sees the same borders.
    """
    probabilities = [i / buckets for i in range(1, buckets)]
    numeric = df.select(F.col(col).cast("double").alias("__v"))
    return sorted(set(numeric.approxQuantile("__v", probabilities, 1.0 / (4 * buckets))))


def with_bucket(df: DataFrame, col: str, points: list[float], out: str = "__bucket") -> DataFrame:
    """Adds the number of the interval between split points that holds the value, by binary search."""
    borders = [-math.inf, *points, math.inf]
    bucketizer = Bucketizer(splits=borders, inputCol="__value", outputCol=out, handleInvalid="keep")
    return bucketizer.transform(df.withColumn("__value", F.col(col).cast("double"))).drop("__value")


def row_index(
    df: DataFrame, id_col: str, index: str = "row_index", total: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Adds the dense 0-based index of each row in the order of a numeric unique key."""
    buckets = buckets or bucket_count(df)
    bucketed = with_bucket(df, id_col, split_points(df, id_col, buckets))
    totals = bucketed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    # one row per bucket
    order = Window.partitionBy(F.lit(0)).orderBy("__bucket")
    offsets = totals.select(
        "__bucket",
        F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "__offset"
        ),
        F.sum("__n").over(Window.partitionBy(F.lit(0))).alias("__total"),
    )
    inner = Window.partitionBy("__bucket").orderBy(id_col)
    # at most `buckets` rows, whatever the size of df
    ranked = bucketed.withColumn("__rn", F.row_number().over(inner)).join(F.broadcast(offsets), "__bucket")
    extra = [F.col("__total").alias(total)] if total else []
    return ranked.select(
        *[F.col(c) for c in df.columns], (F.col("__rn") - 1 + F.col("__offset")).alias(index), *extra
    )


def running_sums(
    df: DataFrame, group: str, value: str, measures: list[str], buckets: int | None = None
) -> DataFrame:
    """Running totals ``cum_<measure>`` by ``value`` within ``group``, plus ``next_value``.

    ``df`` has one row per (group, value) and is read more than once, so hand in a stored table when it is
    costly. Its rows are sorted into range partitions, by default of ``ROWS_PER_BUCKET`` rows; a partition's
    number is stored with its rows, and totals of the partitions before are added to the sums inside.
    """
    buckets = buckets or min(bucket_count(df), max(1, -(-df.count() // ROWS_PER_BUCKET)))
    bucketed = cut_lineage(df.repartitionByRange(buckets, group, value).withColumn("__bucket", F.spark_partition_id()))
    keys = [group, "__bucket"]
    totals = bucketed.groupBy(*keys).agg(
        *[F.sum(m).alias(f"__total_{m}") for m in measures], F.min(value).alias("__first")
    )
    # one row per group and bucket: few groups make few rows, many groups have few buckets each
    outer = Window.partitionBy(group).orderBy("__bucket")
    before = outer.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"__total_{m}").over(before), F.lit(0)).alias(f"__before_{m}") for m in measures],
        F.lead("__first").over(outer).alias("__next_first"),
    )
    inner = Window.partitionBy(*keys).orderBy(value)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = bucketed.select(
        "*",
        *[F.sum(m).over(upto).alias(f"__cum_{m}") for m in measures],
        F.lead(value).over(inner).alias("__next"),
    )
    # hashed by the same keys as the window, so the larger side is not shuffled again
    return local.join(offsets, keys).select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"__cum_{m}") + F.col(f"__before_{m}")).alias(f"cum_{m}") for m in measures],
        F.coalesce(F.col("__next"), F.col("__next_first")).alias("next_value"),
    )
