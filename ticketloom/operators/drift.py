"""Drift between a reference and a current sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.operators.aggregates import long_numeric
from ticketloom.operators.ordering import running_sums
from ticketloom.operators.projections import last_days, log_as_drift_tickets
from ticketloom.operators.sampling import hash_sample
from ticketloom.session import cut_lineage

NUMERIC_DISTINCT = 5
MIN_STD = 0.001


def reference_window(enriched: DataFrame, n: int | None = None, seed: int | str = 42) -> DataFrame:
    """Training features: all of them, or a reproducible sample of ``n`` rows if that is asked for."""
    features = enriched.select("id", "subject", "body_clean", "refined_queue", "urgency_level", *K.NUMERIC_FEATURES)
    return features if n is None else hash_sample(features, n, seed)


def current_window(
    log: DataFrame, now, days: int = 7, n: int | None = None, seed: int | str = 42, as_tickets=log_as_drift_tickets
) -> DataFrame:
    """The recent log as features, all of it unless ``n`` asks for a sample; ``as_tickets`` makes features of text."""
    recent = as_tickets(last_days(log, days, now))
    return recent if n is None else hash_sample(recent, n, seed)


def _divergence(p: Column, q: Column) -> Column:
    """One term of the Jensen-Shannon sum."""
    m = (p + q) / 2.0
    left = F.when(p > 0, p * F.ln(p / m)).otherwise(0.0)
    right = F.when(q > 0, q * F.ln(q / m)).otherwise(0.0)
    return (left + right) / 2.0


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    cols: list[str] = K.NUMERIC_FEATURES,
    threshold: float = K.COLUMN_DRIFT_THRESHOLD,
) -> DataFrame:
    """(column, method, score, threshold, drifted).

    Columns with more than five reference values: Wasserstein distance over the reference deviation.
    Others: Jensen-Shannon distance. Both work on distinct values with counts; the running totals
    behind the first are computed bucket by bucket.
    """
    sides = long_numeric(reference, cols).withColumn("ref", F.lit(True)).unionByName(
        long_numeric(current, cols).withColumn("ref", F.lit(False))
    )
    counts = (
        sides.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count_if("ref").alias("n_ref"), F.count_if(~F.col("ref")).alias("n_cur"))
    )
    counts = cut_lineage(counts)
    totals = counts.groupBy("column").agg(
        F.sum("n_ref").alias("size_ref"),
        F.sum("n_cur").alias("size_cur"),
        F.count_if(F.col("n_ref") > 0).alias("distinct_ref"),
        F.try_divide(F.sum(F.col("n_ref") * F.col("value")), F.sum("n_ref")).alias("mean_ref"),
    )
    # one row per compared column
    placed = running_sums(counts, "column", "value", ["n_ref", "n_cur"]).join(F.broadcast(totals), "column")

    def share(measure: str) -> Column:
        """NULL where the side has no rows at all, which makes the score NULL."""
        return F.try_divide(F.col(measure), F.col(f"size_{measure[-3:]}"))

    p, q = share("n_ref"), share("n_cur")
    gap = F.abs(share("cum_n_ref") - share("cum_n_cur"))
    width = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    spread = F.try_divide(F.sum(F.col("n_ref") * (F.col("value") - F.col("mean_ref")) ** 2), F.first("size_ref"))
    p_and_q = (F.first("size_ref") > 0) & (F.first("size_cur") > 0)
    scores = placed.groupBy("column").agg(
        F.first("distinct_ref").alias("distinct_ref"),
        F.sum(gap * width).alias("area"),
        F.sqrt(spread).alias("std_ref"),
        F.when(p_and_q, F.sqrt(F.greatest(F.sum(_divergence(p, q)), F.lit(0.0)))).alias("divergence"),
    )
    numeric = F.col("distinct_ref") > NUMERIC_DISTINCT
    score = F.when(numeric, F.col("area") / F.greatest("std_ref", F.lit(MIN_STD))).otherwise(F.col("divergence"))
    return scores.select(
        "column",
        F.when(numeric, "wasserstein").otherwise("jensen-shannon").alias("method"),
        score.alias("score"),
        F.lit(threshold).alias("threshold"),
        F.coalesce(score >= threshold, F.lit(False)).alias("drifted"),
    )


def dataset_drift(
    columns: DataFrame,
    reference: DataFrame,
    current: DataFrame,
    share: float = K.DATASET_DRIFT_SHARE,
    min_rows: int = K.MIN_DRIFT_ROWS,
) -> DataFrame:
    """One row: drift_share, measured_share, dataset_drift, n_ref, n_cur.

    On fewer than ``min_rows`` current rows no drift is reported; the measured share stays readable.
    """
    n_cur = current.agg(F.count("*")).scalar()
    n_ref = reference.agg(F.count("*")).scalar()
    drifted = F.coalesce(F.avg(F.col("drifted").cast("double")), F.lit(0.0))
    measured = columns.agg(drifted.alias("share")).select("share", n_ref.alias("n_ref"), n_cur.alias("n_cur"))
    drift_share = F.when(F.col("n_cur") < min_rows, 0.0).otherwise(F.col("share"))
    return measured.select(
        drift_share.alias("drift_share"), F.col("share").alias("measured_share"),
        (drift_share > share).alias("dataset_drift"), "n_ref", "n_cur",
    )


def class_mix_drift(reference: DataFrame, current: DataFrame, label: str) -> DataFrame:
    """Per class its share on either side and its part of the squared Jensen-Shannon distance."""
    sides = reference.select(F.col(label).alias("class"), F.lit(True).alias("ref")).unionByName(
        current.select(F.col(label).alias("class"), F.lit(False).alias("ref"))
    )
    counts = sides.groupBy("class").agg(F.count_if("ref").alias("n_ref"), F.count_if(~F.col("ref")).alias("n_cur"))
    totals = counts.agg(F.struct(F.sum("n_ref").alias("ref"), F.sum("n_cur").alias("cur"))).scalar()
    shares = counts.select(
        "class",
        F.coalesce(F.try_divide(F.col("n_ref").cast("double"), totals["ref"]), F.lit(0.0)).alias("ref_share"),
        F.coalesce(F.try_divide(F.col("n_cur").cast("double"), totals["cur"]), F.lit(0.0)).alias("cur_share"),
    )
    return shares.withColumn("divergence", _divergence(F.col("ref_share"), F.col("cur_share")))


def class_mix_distance(mix: DataFrame) -> DataFrame:
    return mix.agg(F.sqrt(F.greatest(F.sum("divergence"), F.lit(0.0))).alias("distance"))
