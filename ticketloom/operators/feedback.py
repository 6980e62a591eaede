"""Corrections given by users: merging them into the log and into training data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import text
from ticketloom.functions.labels import map_urgency
from ticketloom.operators import joins
from ticketloom.operators.projections import align_schema, feedback_as_training_tickets, validate_labels
from ticketloom.operators.windows import first_per_key, latest_per_key


def insert_ignore(new: DataFrame, existing: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``new`` to append: the first per key by ``order``, unless the key exists."""
    unique = first_per_key(new, keys, [F.col(c) for c in order])
    return unique.join(existing.select(*keys), keys, "left_anti")


def valid_corrections(feedback: DataFrame, tie: str = "feedback_id") -> DataFrame:
    """The latest valid correction per prediction; tasks reduce their own rows before the shuffle."""
    usable = validate_labels(feedback).where("valid").drop("valid")
    return latest_per_key(usable, ["prediction_id"], "feedback_at", tie)


def apply_feedback(log: DataFrame, feedback: DataFrame, tie: str = "feedback_id") -> DataFrame:
    """The log with its correction columns replaced, NULLs included, where a correction was given."""
    joined = joins.feedback_to_log(log, valid_corrections(feedback, tie))
    given = F.col("corrected_at").isNotNull()
    changed = {
        "feedback_queue": F.when(given, F.col("correct_queue")).otherwise(F.col("feedback_queue")),
        "feedback_urgency": F.when(given, F.col("correct_urgency")).otherwise(F.col("feedback_urgency")),
        "feedback_at": F.coalesce("corrected_at", "feedback_at"),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in log.columns])


def rejected_feedback(log: DataFrame, feedback: DataFrame) -> DataFrame:
    """Corrections that were not usable, with the reason: 'invalid' or 'unknown prediction'."""
    checked = validate_labels(feedback)
    invalid = checked.where(~F.col("valid")).withColumn("reason", F.lit("invalid"))
    unknown = joins.unknown_feedback(log, checked.where("valid")).withColumn("reason", F.lit("unknown prediction"))
    return invalid.unionByName(unknown).drop("valid")


def append_feedback(
    base: DataFrame,
    log: DataFrame,
    keywords: dict[str, list[str]] = K.KEYWORDS,
    compat: bool = False,
    mapping: dict[str, str] | None = K.FEEDBACK_CLASS,
) -> DataFrame:
    """Training rows plus the corrected log rows in the same columns.

    Short correction labels become model classes by ``mapping`` (None keeps them); rows whose label
    stands for no class are left out and can be listed with ``joins.unmapped_feedback``. Log ids are
    numbered apart from ticket ids, so the added rows carry ``-id - 1``. An urgency that was not corrected
    stays as predicted, and all are mapped to the model's three levels.
    """
    urgency = map_urgency(F.coalesce("feedback_urgency", "predicted_urgency"))
    rows = feedback_as_training_tickets(log.withColumn("feedback_urgency", urgency), keywords, compat)
    rows = rows.withColumn("id", -F.col("id") - 1)
    if mapping is not None:
        mapped = joins.map_feedback_labels(rows, mapping, "refined_queue")
        rows = mapped.where(F.col("feedback_class").isNotNull()).withColumn("refined_queue", F.col("feedback_class"))
    return base.unionByName(align_schema(rows, base.schema))


def sft_pairs(tickets: DataFrame) -> DataFrame:
    """(id, prompt, completion) from a ticket and its answer."""
    return tickets.select(
        "id",
        text.combine_text(F.col("subject"), F.col("body")).alias("prompt"),
        F.col("answer").alias("completion"),
    )


def preference_pairs(feedback: DataFrame) -> DataFrame:
    """Unused, scored feedback: (chosen, rejected) where an agent corrected it, else a reward."""
    fresh = feedback.where(~F.col("used_for_training") & (F.col("feedback_score") != 0))
    correction = F.when(F.col("agent_correction") != "", F.col("agent_correction"))
    corrected = correction.isNotNull()
    return fresh.select(
        "feedback_id",
        F.col("question").alias("prompt"),
        correction.alias("chosen"),
        F.when(corrected, F.col("response")).alias("rejected"),
        F.when(~corrected, F.col("response")).alias("response"),
        F.when(~corrected, F.col("feedback_score")).alias("reward"),
    )


def mark_used(feedback: DataFrame) -> DataFrame:
    """The feedback table after its usable rows went into training."""
    used = F.col("used_for_training") | (F.col("feedback_score") != 0)
    return feedback.withColumn("used_for_training", used)
