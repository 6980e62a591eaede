"""Row-wise operators: filters, projections, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom import constants as K
from ticketloom.functions import labels, text

NUMERIC_TYPES = (T.NumericType, T.BooleanType)


def filter_lang_queue(df: DataFrame, lang: str, queues: list[str]) -> DataFrame:
    return df.where((F.col("language") == lang) & F.col("queue").isin(queues))


def filter_confirmed_lang(df: DataFrame, lang: str = "en", col: str = "detected_lang") -> DataFrame:
    """Rows whose detected language is ``lang``, without the helper column."""
    return df.where(F.col(col) == lang).drop(col)


def confirmed_lang_report(df: DataFrame, lang: str = "en", col: str = "detected_lang") -> DataFrame:
    """One row: rows before, kept and removed by ``filter_confirmed_lang``."""
    kept = F.count_if(F.col(col) == lang)
    return df.agg(
        F.count("*").alias("total"), kept.alias("kept"), (F.count("*") - kept).alias("removed")
    )


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def since(df: DataFrame, ts, col: str = "created_at") -> DataFrame:
    """Rows at or after ``ts`` (a literal or a column)."""
    return df.where(F.col(col) >= ts)


def last_days(df: DataFrame, days: int, now, col: str = "created_at") -> DataFrame:
    """Rows of the ``days`` days before ``now``; the caller says what now is."""
    return since(df, F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)), col)


def metadata_equals(df: DataFrame, key: str, value: str, col: str = "metadata") -> DataFrame:
    """Filter on one metadata field, kept either as a struct or as JSON text."""
    if isinstance(df.schema[col].dataType, T.StructType):
        field = F.col(f"{col}.{key}")
    else:
        field = text.json_get(F.col(col), key)
    return df.where(field == value)


def with_urgency(df: DataFrame) -> DataFrame:
    return df.withColumn("urgency_level", labels.map_urgency(F.col("priority")))


def with_refined_queue(df: DataFrame, merge_printer: bool = True) -> DataFrame:
    return df.withColumn("refined_queue", labels.refine_queue(F.col("queue"), merge_printer))


def merge_class(df: DataFrame, source: str, target: str, col: str = "refined_queue") -> DataFrame:
    return df.withColumn(col, F.when(F.col(col) == source, target).otherwise(F.col(col)))


def merged_count(df: DataFrame, source: str, col: str = "refined_queue") -> DataFrame:
    """How many rows ``merge_class`` changes."""
    return df.agg(F.count_if(F.col(col) == source).alias("changed"))


def log_as_drift_tickets(log: DataFrame, fragments: dict[str, list[str]] = K.SUBSTRINGS) -> DataFrame:
    """The log in the shape of the training features, as the drift check reads it."""
    t = F.col("input_text")
    return log.select(
        "id",
        t.alias("subject"),
        t.alias("body_clean"),
        F.col("predicted_queue").alias("refined_queue"),
        F.col("predicted_urgency").alias("urgency_level"),
        F.length(t).alias("body_length"),
        F.length(t).alias("answer_length"),
        F.lit(1.0).alias("response_ratio"),
        *labels.substring_flags(t, fragments),
    )


def feedback_as_training_tickets(
    log: DataFrame, keywords: dict[str, list[str]] = K.KEYWORDS, compat: bool = False
) -> DataFrame:
    """Corrected log rows in the shape of the training table.

    Flags are computed from the text; ``compat=True`` leaves them out, so that aligning the schema
    fills them with zeros.
    """
    t = F.col("input_text")
    return not_null(log, "feedback_queue").select(
        "id",
        t.alias("subject"),
        t.alias("body_clean"),
        F.col("feedback_queue").alias("refined_queue"),
        F.col("feedback_urgency").alias("urgency_level"),
        F.length(t).alias("body_length"),
        F.lit(0).alias("answer_length"),
        F.lit(1.0).alias("response_ratio"),
        F.lit("").alias("answer_clean"),
        F.lit("en").alias("language"),
        F.lit("").alias("queue"),
        *([] if compat else labels.keyword_flags(t, keywords)),
    )


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns of ``target`` in order; absent ones are 0 (numbers), '' (text) or NULL."""

    def column(field: T.StructField) -> Column:
        if field.name in df.columns:
            return F.col(field.name).cast(field.dataType).alias(field.name)
        if isinstance(field.dataType, NUMERIC_TYPES):
            return F.lit(0).cast(field.dataType).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.lit("").alias(field.name)
        return F.lit(None).cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in target.fields])


def fill_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """0 for numbers, '' for text."""
    return df.fillna(0, subset=cols).fillna("", subset=cols)


def validate_labels(feedback: DataFrame) -> DataFrame:
    """Adds ``valid``: a positive id, at least one correction, and only known labels."""
    queue, urgency = F.col("correct_queue"), F.col("correct_urgency")
    ok = (
        F.coalesce(F.col("prediction_id") > 0, F.lit(False))
        & (queue.isNotNull() | urgency.isNotNull())
        & (queue.isNull() | queue.isin(K.FEEDBACK_QUEUES))
        & (urgency.isNull() | urgency.isin(K.FEEDBACK_URGENCIES))
    )
    return feedback.withColumn("valid", ok)


def validate_text(df: DataFrame, col: str) -> DataFrame:
    """Adds ``query_text`` (trimmed, NULL if rejected) and ``valid``."""
    checked = df.withColumn("query_text", text.valid_query(F.col(col)))
    return checked.withColumn("valid", F.col("query_text").isNotNull())


def select_columns(df: DataFrame, cols: list[str], preview: dict[str, int] | None = None) -> DataFrame:
    """Projection; ``preview`` maps a column to the length it is shown with."""
    preview = preview or {}
    return df.select(*[text.left_n(F.col(c), preview[c]).alias(c) if c in preview else F.col(c) for c in cols])


def drift_gate(
    dataset: DataFrame, retrain_share: float = K.RETRAIN_SHARE, min_rows: int = K.MIN_DRIFT_ROWS
) -> DataFrame:
    """Adds ``decision`` to the one-row drift result: retrain, stable, or skip when data are few."""
    retrain = F.col("dataset_drift") | (F.col("drift_share") > retrain_share)
    return dataset.withColumn(
        "decision",
        F.when(F.col("n_cur") < min_rows, "skip").when(retrain, "retrain").otherwise("stable"),
    )
