"""Knowledge documents built from resolved tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import text
from ticketloom.operators.sampling import split_part, stratified_split

TITLE_CHARS = 80
BODY_CHARS = 1000
ANSWER_CHARS = 800


def build_rag_docs(enriched: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, title, content, metadata): subject, problem and answer of each ticket in one text."""
    subject = text.default_if(F.col("subject"), "")
    body = text.left_n(text.default_if(F.col("body_clean"), ""), BODY_CHARS)
    answer = text.left_n(text.default_if(F.col("answer_clean"), ""), ANSWER_CHARS)
    content = F.concat(
        F.lit(f"{K.DOC_PROBLEM_HEADER}\n"), subject, F.lit("\n"), body,
        F.lit(f"\n\n{K.DOC_ANSWER_HEADER}\n"), answer,
    )
    metadata = F.struct(
        F.col("refined_queue"),
        F.col("urgency_level"),
        text.default_if(F.col("language"), "en").alias("language"),
    )
    return enriched.select(
        F.concat(F.lit("ticket_"), F.col(id_col).cast("string")).alias("id"),
        F.concat(F.col("refined_queue"), F.lit(" - "), text.left_n(subject, TITLE_CHARS)).alias("title"),
        text.strip(content).alias("content"),
        metadata.alias("metadata"),
    )


def index_train_only(enriched: DataFrame, test: float = 0.30, seed: int | str = 42, id_col: str = "id") -> DataFrame:
    """The part of the tickets that may be indexed; held-out tickets never become documents."""
    return split_part(stratified_split(enriched, ["queue", "urgency_level"], test, 0.0, seed, id_col), "train")
