"""A table of requests answered in one job: classify, retrieve, build prompts, log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import labels, text
from ticketloom.operators import dialog, models, projections, retrieval, textvec


def request_features(requests: DataFrame, encoder, keywords: dict = K.KEYWORDS, col: str = "query_text") -> DataFrame:
    """The feature vector of each request: text vector and the serving-time numbers."""
    numbers = labels.serving_features(F.col(col), keywords)
    named = {c: numbers[i] for i, c in enumerate(K.NUMERIC_FEATURES)}
    embedded = textvec.embed_texts(requests, encoder, col)
    return textvec.assemble(embedded.withColumns(named), "embedding").drop(*K.NUMERIC_FEATURES)


def rejected_requests(requests: DataFrame) -> DataFrame:
    """The requests that ``predict_requests`` leaves out: blank or too long."""
    return projections.validate_text(requests, "user_query").where(~F.coalesce("valid", F.lit(False))).drop("valid", "query_text")


def predict_requests(requests: DataFrame, encoder, classifiers: dict, keywords: dict = K.KEYWORDS) -> DataFrame:
    """Valid requests with predicted queue and urgency; ``classifiers`` maps target to model."""
    valid = projections.validate_text(requests, "user_query").where("valid").drop("valid")
    return models.predict_batch(request_features(valid, encoder, keywords), classifiers)


def answer_context(
    predicted: DataFrame, docs: DataFrame, encoder, group: str = "refined_queue", k: int = K.TOP_K, **kw
) -> DataFrame:
    """Per request the joined contents of its hits.

    ``docs`` has doc_id, content, embedding and the class column ``group``.
    """
    retrieval_text = dialog.rag_query(F.col("history"), F.col("query_text"))
    asked = predicted.select(
        F.col("request_id").alias("qid"), retrieval_text.alias("rag_query"), F.col(f"predicted_{group}").alias(group)
    )
    queries = textvec.embed_texts(asked, encoder, "rag_query")
    hits = retrieval.retrieve_with_fallback(queries, docs, group, k, content="content", **kw)
    contents = hits.join(docs.select("doc_id", "content"), "doc_id")
    listed = F.sort_array(F.collect_list(F.struct("rank", "content")))
    sources = contents.groupBy("qid").agg(F.transform(listed, lambda h: h["content"]).alias("sources"))
    return retrieval.context_of(contents, queries).join(sources, "qid", "left")


def prompts(predicted: DataFrame, contexts: DataFrame, queue: str = "refined_queue", urgency: str = "urgency_level") -> DataFrame:
    """Each request with the message list to send to a text model."""
    joined = predicted.join(contexts.withColumnRenamed("qid", "request_id"), "request_id", "left")
    message = dialog.user_message(
        F.col(f"predicted_{queue}"), F.col(f"predicted_{urgency}"), F.col("context"), F.col("query_text")
    )
    return joined.withColumn("messages", dialog.build_messages(F.col("history"), message))


def log_rows(
    predicted: DataFrame, created_at, queue: str = "refined_queue", urgency: str = "urgency_level",
    ids: Column | None = None,
) -> DataFrame:
    """Rows for the prediction log; corrections are still empty.

    ``ids`` are the requests' own, by which corrections find their rows; ``append_log`` draws ids otherwise.
    """
    return predicted.select(
        (F.lit(None) if ids is None else ids).cast("bigint").alias("id"),
        F.col("query_text").alias("input_text"),
        F.col(f"predicted_{queue}").alias("predicted_queue"),
        F.col(f"predicted_{urgency}").alias("predicted_urgency"),
        F.lit(None).cast("string").alias("response"),
        F.lit("en").alias("language"),
        F.col(f"confidence_{queue}").alias("confidence_queue"),
        F.col(f"confidence_{urgency}").alias("confidence_urgency"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("string").alias("feedback_queue"),
        F.lit(None).cast("string").alias("feedback_urgency"),
        F.lit(None).cast("timestamp_ntz").alias("feedback_at"),
    )


def short_replies(requests: DataFrame, col: str = "user_query") -> DataFrame:
    """Adds ``intent`` for messages that need no prediction, such as thanks."""
    return requests.withColumn("intent", text.intent_of(F.col(col)))
