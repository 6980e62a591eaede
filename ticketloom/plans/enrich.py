"""Offline chain: raw tickets to enriched tickets, documents and training features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import labels, text
from ticketloom.operators import language, projections


def ingest(raw: DataFrame, detector, lang: str = "en") -> DataFrame:
    """Tickets whose body really is in ``lang``."""
    return projections.filter_confirmed_lang(language.detect_language(raw, detector, "body"), lang)


def enrich(raw: DataFrame, keywords: dict[str, list[str]] = K.KEYWORDS, merge_printer: bool = True) -> DataFrame:
    """All features of a ticket in one pass over its row: no shuffle, no Python."""
    cleaned = raw.withColumns(
        {
            "urgency_level": labels.map_urgency(F.col("priority")),
            "body_clean": text.clean_text(F.col("body")),
            "answer_clean": text.clean_text(F.col("answer")),
        }
    )
    measured = cleaned.withColumns(
        {"body_length": F.length("body_clean"), "answer_length": F.length("answer_clean")}
    )
    flagged = measured.select(
        "*",
        text.response_ratio(F.col("answer_length"), F.col("body_length")).alias("response_ratio"),
        *labels.keyword_flags(F.col("body_clean"), keywords),
    )
    return projections.with_refined_queue(flagged, merge_printer)


def training_table(enriched: DataFrame) -> DataFrame:
    """Enriched tickets with the text a classifier sees."""
    combined = text.combine_text(F.col("subject"), F.col("body_clean"))
    return projections.fill_missing(enriched, K.NUMERIC_FEATURES).withColumn("text", combined)
