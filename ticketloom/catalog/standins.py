"""Ticket tables derived from the given Parquet tables, as DataFrames and as SQL.

The given tables hold invented prose, so a substitute keyword dictionary with words that do occur is
used for the registered queries; the real dictionary is the default everywhere else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions.text import text_hash
from ticketloom.plans.enrich import enrich
from ticketloom.sources.tables import spread

# Keywords that occur in the test prose, and fragments that occur in the test log.
TEST_KEYWORDS = {
    "network": ["ention", "anble", "ating"],
    "printer": ["queque"],
    "security": ["mente", "estion", "intion"],
    "hardware": ["ersch", "enlich", "eding"],
    "software": ["inble", "reble", "edble", "edtion"],
}
TEST_FRAGMENTS = {
    "network": ["click", "k\": 1"],
    "printer": ["ERR"],
    "security": ["signup"],
    "hardware": ["view"],
    "software": ["purchase", "k\": 2"],
}
NOW = "2024-01-31 00:00:00"
MODEL = "hashed-ngrams"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    return tickets_from_documents(spread(table(spark, sf, "documents"), "doc_id"))


def tickets_from_documents(d: DataFrame) -> DataFrame:
    queue = (
        F.when(F.col("source").isin("src1", "src2", "src3"), K.PRODUCT_SUPPORT)
        .when(F.col("source").isin("src4", "src5"), K.OUTAGES_AND_MAINTENANCE)
        .otherwise("Technical Support")
    )
    priority = (
        F.when(F.col("n_chars") >= 4000, "critical")
        .when(F.col("n_chars") >= 2000, "high")
        .when(F.col("n_chars") >= 1000, "medium")
        .otherwise("low")
    )
    return d.select(
        F.col("doc_id").alias("id"),
        F.substring("text", 1, 80).alias("subject"),
        F.col("text").alias("body"),
        F.expr("substring(text, 81)").alias("answer"),
        queue.alias("queue"),
        priority.alias("priority"),
        F.col("lang").alias("language"),
        F.col("source").alias("type"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, doc_id, 0)").alias("created_at"),
    )


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(tickets(spark, sf), TEST_KEYWORDS)


def log_from_events(events: DataFrame) -> DataFrame:
    value = F.col("value")
    urgency = F.when(value >= 100, "high").when(value >= 30, "medium").otherwise("low")
    return events.select(
        F.col("event_id").alias("id"),
        F.concat_ws(" ", "event_type", "props").alias("input_text"),
        F.col("event_type").alias("predicted_queue"),
        urgency.alias("predicted_urgency"),
        F.concat(F.lit("see "), F.col("event_type")).alias("response"),
        F.lit("en").alias("language"),
        (value / 500.0).alias("confidence_queue"),
        (value / 1000.0).alias("confidence_urgency"),
        F.col("ts").alias("created_at"),
        F.lit(None).cast("string").alias("feedback_queue"),
        F.lit(None).cast("string").alias("feedback_urgency"),
        F.lit(None).cast("timestamp_ntz").alias("feedback_at"),
    )


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    return log_from_events(table(spark, sf, "events"))


def feedback_from_events(events: DataFrame) -> DataFrame:
    """Every event as a correction; few users, so each prediction gets many of them."""
    kind, value = F.col("event_type"), F.col("value")
    queue = (
        F.when(kind == "click", "network")
        .when(kind == "error", "security")
        .when(kind == "purchase", "hardware")
        .when(kind == "signup", "billing")
    )
    urgency = F.when(value >= 100, "critical").when(value >= 50, "high").when(value >= 20, "low")
    return events.select(
        F.col("event_id").alias("feedback_id"),
        (F.col("user_id") * 97).alias("prediction_id"),
        queue.alias("correct_queue"),
        urgency.alias("correct_urgency"),
        (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("feedback_at"),
    )


def feedback(spark: SparkSession, sf: str) -> DataFrame:
    return feedback_from_events(table(spark, sf, "events"))


def rated_feedback(spark: SparkSession, sf: str) -> DataFrame:
    """Answers with a score, from the events; half of them used already."""
    value, kind = F.col("value"), F.col("event_type")
    score = F.when(value >= 60, 1).when(value >= 15, 0).otherwise(-1)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("feedback_id"),
        F.col("props").alias("question"),
        F.concat(F.lit("see "), kind).alias("response"),
        score.alias("feedback_score"),
        F.when(kind == "error", F.concat(F.lit("rather "), F.col("props"))).alias("agent_correction"),
        (F.col("ts") < F.expr("timestamp_ntz'2024-01-16 00:00:00'")).alias("used_for_training"),
        F.col("ts").alias("created_at"),
    )


def embedding_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Stored vectors of all English documents, plus another model's of the French ones."""
    d = table(spark, sf, "documents").where(F.col("lang").isin("en", "fr"))
    rows = d.select(
        text_hash(F.col("text")).alias("text_hash"),
        F.when(F.col("lang") == "en", MODEL).otherwise("other").alias("model_name"),
        F.substring("text", 1, K.CACHE_TEXT_CHARS).alias("text_content"),
        F.array(F.length("text").cast("float"), F.lit(1.0).cast("float")).alias("embedding"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("created_at"),
    )
    return rows.dropDuplicates(["text_hash", "model_name"])


def vector_docs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("queue"))


def vector_queries(spark: SparkSession, sf: str, shift: int = 0) -> DataFrame:
    """Every vector as a query; ``shift`` moves the predicted class away from the true one."""
    e = table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("qid"), "embedding", ((F.col("label") + shift) % 10).alias("queue"))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").withColumnRenamed("text", "content")


def graded(spark: SparkSession, sf: str) -> DataFrame:
    """Quality labels with a rule's prediction from the length of the document."""
    lab = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    prediction = F.when(F.col("n_chars") >= 8000, 2).when(F.col("n_chars") >= 700, 1).otherwise(0)
    return lab.select("doc_id", F.col("quality").alias("label"), prediction.alias("prediction"))


# --- the same tables as common table expressions for DuckDB ------------------------------------

WS = r"[\s\x0b\x1c-\x1f\x{85}\pZ]+"


def clean_sql(col: str) -> str:
    return (
        f"regexp_replace(trim(regexp_replace(regexp_replace(coalesce({col}, ''), '<.*?>', '', 'g'), "
        rf"'{WS}', ' ', 'g')), '\d{{3}}-\d{{3}}-\d{{4}}', '<tel>', 'g')"
    )


def flag_sql(col: str, words: list[str]) -> str:
    return (
        rf"CAST(regexp_matches({col}, '(?i)(^|[^\pL\pN_])({'|'.join(words)})([^\pL\pN_]|$)') AS INTEGER)"
    )


TICKETS = """tickets AS (
  SELECT doc_id AS id, substring(text, 1, 80) AS subject, text AS body, substring(text, 81) AS answer,
    CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'Product Support'
         WHEN source IN ('src4', 'src5') THEN 'Service Outages and Maintenance'
         ELSE 'Technical Support' END AS queue,
    CASE WHEN n_chars >= 4000 THEN 'critical' WHEN n_chars >= 2000 THEN 'high'
         WHEN n_chars >= 1000 THEN 'medium' ELSE 'low' END AS priority,
    lang AS language, source AS type,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS created_at
  FROM documents)"""

ENRICHED = (
    TICKETS
    + f""",
cleaned AS (
  SELECT *, {clean_sql('body')} AS body_clean, {clean_sql('answer')} AS answer_clean,
    CASE WHEN priority IN ('critical', 'high') THEN 'high' WHEN priority = 'medium' THEN 'medium'
         ELSE 'low' END AS urgency_level
  FROM tickets),
flagged AS (
  SELECT *, CAST(length(body_clean) AS INTEGER) AS body_length,
    CAST(length(answer_clean) AS INTEGER) AS answer_length,
    CAST(length(answer_clean) AS DOUBLE) / CAST(length(body_clean) + 1 AS DOUBLE) AS response_ratio,
    {', '.join(f"{flag_sql('body_clean', w)} AS has_{t}" for t, w in TEST_KEYWORDS.items())}
  FROM cleaned),
enriched AS (
  SELECT *, CASE WHEN has_security = 1 THEN 'Security / Access'
    WHEN has_printer = 1 THEN 'Hardware / Device' WHEN has_hardware = 1 THEN 'Hardware / Device'
    WHEN has_network = 1 THEN 'Network / Infrastructure'
    WHEN has_software = 1 OR queue = 'Product Support' THEN 'Software / Product'
    WHEN queue = 'Service Outages and Maintenance' THEN 'Service Outages'
    ELSE 'General Technical Support' END AS refined_queue
  FROM flagged)"""
)

LOG = """log AS (
  SELECT event_id AS id, concat_ws(' ', event_type, props) AS input_text, event_type AS predicted_queue,
    CASE WHEN value >= 100 THEN 'high' WHEN value >= 30 THEN 'medium' ELSE 'low' END AS predicted_urgency,
    'see ' || event_type AS response, 'en' AS language, value / 500e0 AS confidence_queue,
    value / 1000e0 AS confidence_urgency, ts AS created_at, CAST(NULL AS VARCHAR) AS feedback_queue,
    CAST(NULL AS VARCHAR) AS feedback_urgency, CAST(NULL AS TIMESTAMP) AS feedback_at
  FROM events)"""

FEEDBACK = """feedback AS (
  SELECT event_id AS feedback_id, user_id * 97 AS prediction_id,
    CASE event_type WHEN 'click' THEN 'network' WHEN 'error' THEN 'security'
      WHEN 'purchase' THEN 'hardware' WHEN 'signup' THEN 'billing' END AS correct_queue,
    CASE WHEN value >= 100 THEN 'critical' WHEN value >= 50 THEN 'high' WHEN value >= 20 THEN 'low' END
      AS correct_urgency,
    ts + INTERVAL 2 HOUR AS feedback_at
  FROM events),
checked AS (
  SELECT *, coalesce(prediction_id > 0, false)
    AND (correct_queue IS NOT NULL OR correct_urgency IS NOT NULL)
    AND (correct_queue IS NULL
         OR correct_queue IN ('network', 'hardware', 'software', 'security', 'printer', 'other'))
    AND (correct_urgency IS NULL OR correct_urgency IN ('low', 'medium', 'high', 'critical')) AS valid
  FROM feedback)"""

LATEST = (
    LOG
    + ",\n"
    + FEEDBACK
    + """,
latest AS (
  SELECT * FROM checked WHERE valid AND prediction_id IN (SELECT id FROM log)
  QUALIFY row_number() OVER (PARTITION BY prediction_id ORDER BY feedback_at DESC, feedback_id DESC) = 1),
corrected AS (
  SELECT l.* EXCLUDE (feedback_queue, feedback_urgency, feedback_at), f.correct_queue AS feedback_queue,
    f.correct_urgency AS feedback_urgency, f.feedback_at
  FROM log l LEFT JOIN latest f ON f.prediction_id = l.id)"""
)

RATED = """rated AS (
  SELECT event_id AS feedback_id, props AS question, 'see ' || event_type AS response,
    CASE WHEN value >= 60 THEN 1 WHEN value >= 15 THEN 0 ELSE -1 END AS feedback_score,
    CASE WHEN event_type = 'error' THEN 'rather ' || props END AS agent_correction,
    ts < TIMESTAMP '2024-01-16 00:00:00' AS used_for_training, ts AS created_at
  FROM events)"""

CACHE = """cache AS (
  SELECT DISTINCT sha256(text) AS text_hash,
    CASE WHEN lang = 'en' THEN 'hashed-ngrams' ELSE 'other' END AS model_name
  FROM documents WHERE lang IN ('en', 'fr'))"""

VECS = """vecs AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS nrm
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))"""

VECTORS = f"""{VECS},
pairs AS (
  SELECT a.vec_id AS qid, b.vec_id AS doc_id, a.label AS q_label, b.label AS d_label,
    1 - list_dot_product(a.v, b.v) / (a.nrm * b.nrm) AS distance
  FROM vecs a CROSS JOIN vecs b)"""

MESSAGES = "messages AS (SELECT conv_id, turn, role, text AS content FROM conversations)"

GRADED = """graded AS (
  SELECT l.doc_id, l.quality AS label,
    CASE WHEN d.n_chars >= 8000 THEN 2 WHEN d.n_chars >= 700 THEN 1 ELSE 0 END AS prediction
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
