"""Monitoring loop: measure drift, decide, and retrain on data plus corrections."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.operators import (
    aggregates,
    drift,
    feedback,
    metrics,
    models,
    projections,
    sampling,
    textvec,
)
from ticketloom.operators.skew import is_small
from ticketloom.plans.enrich import training_table
from ticketloom.session import cut_lineage, scratch_scope
from ticketloom.sources import snapshots


#: What the search, the training and the evaluation read of the feature table.
TRAINED_ON = ["id", "refined_queue", "urgency_level", "features"]


@dataclass
class LoopParams:
    """Settings of one run; the drift windows hold all rows unless a sample size is given."""

    reference_rows: int | None = None
    current_rows: int | None = None
    days: int = 7
    retrain_share: float = K.RETRAIN_SHARE
    tuning_rows: int = 3000
    trials: int = 10
    space: dict = field(default_factory=lambda: models.SEARCH_SPACE)
    folds: int = 3
    kind: str = "boosted"
    holdout: float = 0.2
    test: float = 0.15
    seed: int = 42
    keywords: dict = field(default_factory=lambda: K.KEYWORDS)
    fragments: dict = field(default_factory=lambda: K.SUBSTRINGS)


def check_drift(enriched: DataFrame, log: DataFrame, now, params: LoopParams) -> DataFrame:
    """One row: drift_share, measured_share, dataset_drift, n_ref, n_cur, decision."""
    reference = drift.reference_window(enriched, params.reference_rows, params.seed)
    current = drift.current_window(
        log, now, params.days, params.current_rows, params.seed,
        lambda rows: projections.log_as_drift_tickets(rows, params.fragments),
    )
    reference = projections.fill_missing(reference, K.NUMERIC_FEATURES)
    current = projections.fill_missing(current, K.NUMERIC_FEATURES)
    columns = drift.column_drift(reference, current)
    return projections.drift_gate(drift.dataset_drift(columns, reference, current), params.retrain_share)


def drift_log_row(result: DataFrame, check_date, report_path: str) -> DataFrame:
    return result.select(
        F.lit(check_date).cast("timestamp_ntz").alias("check_date"),
        F.col("dataset_drift").alias("drift_detected"),
        "drift_share",
        F.lit(report_path).alias("report_path"),
    )


def append_drift_row(row: DataFrame, path: str) -> None:
    """Adds the row unless its date is recorded; the table is made by the first one."""
    try:
        recorded = row.sparkSession.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        recorded = row.limit(0)
    feedback.insert_ignore(row, cut_lineage(recorded), ["check_date"], ["drift_share"]).write.mode("append").parquet(path)


def training_data(base: DataFrame, log: DataFrame, since, root: str, stamp: str, params: LoopParams) -> DataFrame:
    """Base tickets plus corrections given since ``since``, stored once as a snapshot and read back.

    What counts is when a correction was given, not when the prediction was made. A prediction corrected
    again after the last snapshot replaces its older row. Such rows are found by their ids; where they are few, no
    texts are shuffled to leave them out.
    """
    corrected = projections.since(log, F.lit(since).cast("timestamp_ntz"), "feedback_at")
    replaced = base.select("id").join(corrected.select((-F.col("id") - 1).alias("id")), "id", "left_semi")
    replaced = cut_lineage(replaced.distinct())
    base = base.join(F.broadcast(replaced) if is_small(replaced) else replaced, "id", "left_anti")
    merged = feedback.append_feedback(base, corrected, params.keywords)
    path = snapshots.write_snapshot(merged, root, stamp)
    return base.sparkSession.read.parquet(path)


def embedded_features(data: DataFrame, cache: DataFrame, encoder, now) -> tuple[DataFrame, DataFrame]:
    """Training rows with their feature vector, and the cache rows to append."""
    table = training_table(data)
    vectors, additions = textvec.incremental_embeddings(table.select("id", "text"), cache, encoder, now)
    joined = table.join(vectors.select("id", "embedding"), "id")
    return textvec.assemble(joined, "embedding"), additions


def retrain(features: DataFrame, params: LoopParams, run_id: str, dataset: str) -> tuple[DataFrame, dict]:
    """Search, train, evaluate and gate both classifiers: the run record and the models by target.

    ``features`` is read several times; of its columns only ``TRAINED_ON`` are stored again.
    """
    usable = aggregates.drop_rare_classes(features.select(*TRAINED_ON), "refined_queue")
    data = cut_lineage(sampling.stratified_split(usable, ["refined_queue"], params.test, 0.0, params.seed))
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    tuning = sampling.stratified_sample(train, ["refined_queue", "urgency_level"], params.tuning_rows, params.seed)
    tuning = cut_lineage(tuning)
    fitted, scores, chosen = {}, {}, {}
    sets = models.draw_params(params.trials, params.seed, params.space, params.kind)
    # the queue by folds; the urgency, whose classes are weighted, on held-out rows
    for target, balanced, validation in (("refined_queue", False, models.FOLDS), ("urgency_level", True, models.HOLDOUT)):
        trials = models.random_search(
            tuning, target, sets, params.folds, params.kind, balanced, params.seed, validation=validation, share=params.holdout
        )
        best = aggregates.best_run(trials, "score", ["params"]).first()["params"]
        fitted[target] = models.train_classifier(train, target, params.kind, balanced, **best)
        report = models.evaluate(fitted[target], test.where(F.col(target).isNotNull()), target)
        scores[target] = report.where("class = 'weighted avg'").first()["f1"]
        chosen |= {f"{target}.{k}": v for k, v in best.items()}
    spark = features.sparkSession
    measured = spark.createDataFrame(
        [(run_id, dataset, scores["refined_queue"], scores["urgency_level"], chosen)],
        "run_id string, dataset string, f1_queue double, f1_urgency double, params map<string,string>",
    )
    gate = metrics.promotion_gate(measured)
    record = measured.join(gate, "run_id").select(
        "run_id", "dataset", F.struct("f1_queue", "f1_urgency").alias("metrics"), "params", "status", "reason"
    )
    return record, fitted


def base_and_since(enriched: DataFrame, root: str, since) -> tuple[DataFrame, str]:
    """What to add corrections to, and from when: the newest snapshot, or the enriched table."""
    spark = enriched.sparkSession
    newest = snapshots.latest_snapshot(spark, root).first()
    if newest is None:
        return enriched, since
    return snapshots.read_latest_snapshot(spark, root).drop("snapshot"), str(newest["snapshot_at"])


def monitor_and_retrain(
    enriched: DataFrame, log: DataFrame, cache: DataFrame, encoder, now, since, root: str, stamp: str,
    params: LoopParams, model_root: str | None = None, cache_path: str | None = None, drift_log: str | None = None,
) -> DataFrame:
    """One pass of the loop; the record says 'stable' or 'skip' when nothing had to be trained.

    ``root`` holds the dataset snapshots; ``since`` counts only while there is none. Models that pass
    the gate are saved below ``model_root``. New embeddings are appended to the cache table at
    ``cache_path``, so that a later run does not encode them again, and each check leaves a row in the table
    at ``drift_log``, one per date.
    """
    result = cut_lineage(check_drift(enriched, log, now, params))
    if drift_log:
        append_drift_row(drift_log_row(result, now, f"{root}/snapshot={stamp}"), drift_log)
    decision = result.first()["decision"]
    if decision != "retrain":
        empty = "struct<f1_queue:double,f1_urgency:double>"
        return result.select(
            F.lit(stamp).alias("run_id"),
            F.lit(None).cast("string").alias("dataset"),
            F.lit(None).cast(empty).alias("metrics"),
            F.lit(None).cast("map<string,string>").alias("params"),
            F.col("decision").alias("status"),
            F.lit("no retraining").alias("reason"),
        )
    base, since = base_and_since(enriched, root, since)
    data = training_data(base, log, since, root, stamp, params)
    with scratch_scope(enriched.sparkSession) as scope:  # feature tables and folds are not needed afterwards
        with scratch_scope(enriched.sparkSession) as encoding:  # nor hashes and new vectors once features are stored
            features, additions = embedded_features(data, cache, encoder, now)
            if cache_path:
                additions.write.mode("append").parquet(cache_path)
            features = encoding.kept(features.select(*TRAINED_ON))
        record, fitted = retrain(features, params, stamp, f"snapshot={stamp}")
        record = scope.kept(record)
    if model_root and record.first()["status"] == "success":
        for target, model in fitted.items():
            models.save_model(model, f"{model_root}/{target}/{stamp}")
    return record
