"""Quality of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("count")
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def _ratio(top, bottom):
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    One pass over the data: everything after the (label, prediction) counts works on k x k rows.
    """
    n = F.col("count")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("label").cast("string").alias("class"),
            n.alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
            hit.alias("tp"),
        ),
        F.struct(
            F.col("prediction").cast("string").alias("class"),
            F.lit(0).cast("bigint").alias("support"),
            n.alias("predicted"),
            F.lit(0).cast("bigint").alias("tp"),
        ),
    )
    per_class = (
        confusion_counts(df, label, prediction)
        .select(F.inline(sides))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
        .select(
            "class",
            "support",
            "tp",
            _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
            _ratio(F.col("tp"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        )
    )
    metrics = ["precision", "recall", "f1"]
    rolled = per_class.groupingSets([["class"], []], "class").agg(
        F.grouping("class").alias("is_total"),
        F.sum("support").alias("support"),
        F.sum("tp").alias("tp"),
        *[F.avg(m).alias(m) for m in metrics],
        *[_ratio(F.sum(F.col("support") * F.col(m)), F.sum("support")).alias(f"w_{m}") for m in metrics],
    )

    def line(name, values):
        return F.struct(name.alias("class"), *[v.alias(m) for v, m in zip(values, metrics)], F.col("support"))

    share = _ratio(F.col("tp"), F.col("support"))
    summary = F.array(
        line(F.lit("accuracy"), [share] * 3),
        line(F.lit("macro avg"), [F.col(m) for m in metrics]),
        line(F.lit("weighted avg"), [F.col(f"w_{m}") for m in metrics]),
    )
    single = F.array(line(F.col("class"), [F.col(m) for m in metrics]))
    return rolled.select(F.inline(F.when(F.col("is_total") == 1, summary).otherwise(single)))


def f1_weighted(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    report = classification_report(df, label, prediction)
    return report.where(F.col("class") == "weighted avg").select(F.col("f1").alias("f1_weighted"))


def promotion_gate(
    metrics: DataFrame, min_queue: float = K.MIN_F1_QUEUE, min_urgency: float = K.MIN_F1_URGENCY
) -> DataFrame:
    """(run_id, status, reason) for runs with ``f1_queue`` and ``f1_urgency``."""
    queue_ok = F.coalesce(F.col("f1_queue") >= min_queue, F.lit(False))
    urgency_ok = F.coalesce(F.col("f1_urgency") >= min_urgency, F.lit(False))
    reason = (
        F.when(queue_ok & urgency_ok, "both scores reach their minimum")
        .when(queue_ok, "f1_urgency below minimum")
        .when(urgency_ok, "f1_queue below minimum")
        .otherwise("both scores below minimum")
    )
    return metrics.select(
        "run_id", F.when(queue_ok & urgency_ok, "success").otherwise("rejected").alias("status"), reason.alias("reason")
    )
