"""Counts, shares, profiles and weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import text
from ticketloom.operators.ordering import running_sums
from ticketloom.operators.skew import lookup_join
from ticketloom.operators.windows import share_of_total
from ticketloom.session import cut_lineage


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Values with their counts, most frequent first, optionally only the first ``n``."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("count"))
    ordered = counts.orderBy(F.desc("count"), "value")
    return ordered if n is None else ordered.limit(n)


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Values with their percentage of the rows."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("count"))
    return share_of_total(counts).select("value", (F.col("share") * 100.0).alias("pct"))


def class_distribution(df: DataFrame, col: str) -> DataFrame:
    """Per class the count and the percentage rounded to one decimal, largest first."""
    counts = df.groupBy(F.col(col).alias("class")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", text.round_pct(F.col("count"), total)).orderBy(F.desc("count"), "class")


def feature_means(df: DataFrame, cols: list[str] = K.NUMERIC_FEATURES) -> DataFrame:
    """Averages in one pass; for flags that is the share of rows carrying them."""
    return df.agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


def strata_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("count"))


def drop_rare_classes(df: DataFrame, label: str, minimum: int = 2) -> DataFrame:
    """Rows whose class has at least ``minimum`` of them."""
    counts = df.groupBy(label).agg(F.count("*").alias("__n")).where(F.col("__n") >= minimum)
    return lookup_join(df, counts.select(label), [label], "left_semi")


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (k * n_c) for each of the k classes present."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class"))
    counts = counts.agg(F.count("*").alias("n_c"))
    totals = counts.agg(F.struct(F.sum("n_c").alias("n"), F.count("*").alias("k"))).scalar()
    weight = totals["n"].cast("double") / (totals["k"] * F.col("n_c")).cast("double")
    return counts.select("class", weight.alias("weight"))


def cache_hit_rate(looked_up: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: rows, rows with a vector, and their percentage (0 when there are no rows)."""
    hit = F.col(vector).isNotNull()
    rate = F.coalesce(F.avg(hit.cast("double")) * 100.0, F.lit(0.0))
    return looked_up.agg(
        F.count("*").alias("total"), F.count_if(hit).alias("hits"), rate.alias("hit_rate")
    )


def mean_cv_score(scores: DataFrame, run: str = "run_id", score: str = "score") -> DataFrame:
    """Mean over the folds of each run; 0.01 where that is not a number or zero."""
    mean = F.avg(score)
    return scores.groupBy(run).agg(
        F.when(mean.isNull() | F.isnan(mean) | (mean == 0.0), 0.01).otherwise(mean).alias("mean_score")
    )


def best_run(runs: DataFrame, metric: str, params: list[str], defaults: dict | None = None) -> DataFrame:
    """One row with the parameters of the highest score, or the defaults if there is no run."""
    defaults = defaults or {}
    order = F.struct(F.col(metric), F.col("run_id"))
    scored = runs.where(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))

    def best(name: str):
        picked = F.max_by(F.col(name), order)
        return F.coalesce(picked, F.lit(defaults[name])) if name in defaults else picked

    return scored.agg(
        best("run_id").alias("run_id"), F.max(metric).alias(metric), *[best(p).alias(p) for p in params]
    )


def feedback_stats(
    feedback: DataFrame, now, min_new: int = 1000, min_satisfaction: float = 0.80, days: int = 7
) -> DataFrame:
    """One row: unused feedback, recent satisfaction, and whether one of three rules asks for retraining.

    Satisfaction is the share of positive scores among the scored rows of the last ``days`` days. The
    third rule is the weekly run, due on a Sunday.
    """
    ts = F.lit(now).cast("timestamp_ntz")
    recent = (F.col("created_at") >= ts - F.make_dt_interval(F.lit(days))) & (F.col("feedback_score") != 0)
    unused = F.count_if(~F.col("used_for_training"))
    satisfaction = F.avg(F.when(recent, (F.col("feedback_score") > 0).cast("double")))
    stats = feedback.agg(unused.alias("unused"), satisfaction.alias("satisfaction"))
    reason = (
        F.when(F.col("unused") >= min_new, "new feedback")
        .when(F.col("satisfaction") < min_satisfaction, "low satisfaction")
        .when(F.dayofweek(ts) == 1, "weekly")
        .otherwise("none")
    )
    return stats.withColumn("reason", reason).withColumn("retrain", F.col("reason") != "none")


def as_number(col: str) -> Column:
    """The column as a double; NaN counts as missing."""
    v = F.col(col).cast("double")
    return F.when(~F.isnan(v), v)


def long_numeric(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """(column, value) rows as doubles; NaN counts as missing."""
    keep = keep or []
    return df.select(*keep, *[as_number(c).alias(c) for c in cols]).unpivot(keep, cols, "column", "value")


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: rows, missing, mean, std, min, max; one wide aggregate over the rows as they are."""
    each = [
        F.struct(
            F.lit(c).alias("column"),
            F.count("*").alias("n_rows"),
            F.count_if(as_number(c).isNull()).alias("missing"),
            F.avg(as_number(c)).alias("mean"),
            F.stddev_samp(as_number(c)).alias("std"),
            F.min(as_number(c)).alias("min"),
            F.max(as_number(c)).alias("max"),
        )
        for c in cols
    ]
    return df.agg(F.array(*each).alias("each")).select(F.inline("each"))


def data_profile(df: DataFrame, cols: list[str] = K.NUMERIC_FEATURES) -> DataFrame:
    """Per column: rows, missing, mean, std, min, quartiles, max, distinct values, most frequent value.

    Quartiles are exact and interpolated. They come from the table of distinct values with their
    counts, summed over range partitions, so no task holds a whole column.
    """
    long = long_numeric(df, cols)
    present = long.where(F.col("value").isNotNull())
    counts = cut_lineage(present.groupBy("column", "value").agg(F.count("*").alias("n")))
    ranked = running_sums(counts, "column", "value", ["n"])
    sizes = counts.groupBy("column").agg(
        F.sum("n").alias("size"),
        F.count("*").alias("distinct"),
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("most_frequent"),
    )
    # one row per profiled column
    placed = ranked.join(F.broadcast(sizes.select("column", "size")), "column")

    def value_at(index):
        inside = (F.col("cum_n") - F.col("n") <= index) & (index < F.col("cum_n"))
        return F.max(F.when(inside, F.col("value")))

    def quantile(q: float):
        position = (F.col("size") - 1) * F.lit(q)
        low, high = value_at(F.floor(position)), value_at(F.ceil(position))
        weight = F.max(position - F.floor(position))
        return low + (high - low) * weight

    quartiles = placed.groupBy("column").agg(
        quantile(0.25).alias("q25"), quantile(0.5).alias("median"), quantile(0.75).alias("q75")
    )
    return moments(df, cols).join(sizes.drop("size"), "column", "left").join(quartiles, "column", "left")
