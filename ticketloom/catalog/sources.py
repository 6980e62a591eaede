"""Queries over sources and sinks."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ticketloom.catalog import standins as S
from ticketloom.catalog.registry import query
from ticketloom.operators import aggregates, feedback, metrics, windows
from ticketloom.session import scratch_path
from ticketloom.sources import records, snapshots, tables

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@query("read_tickets", "S1", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def read_tickets(spark, sf):
    return tables.read_tickets(spark, f"{sf}/documents.parquet", DOCUMENTS)


ENRICHED_COLUMNS = "id, subject, body_clean, answer_clean, refined_queue, urgency_level, queue, language, body_length, answer_length"


@query("write_dataset", "S2", S.with_(S.ENRICHED) + f"SELECT {ENRICHED_COLUMNS} FROM enriched")
def write_dataset(spark, sf):
    path = scratch_path(spark, "enriched")
    tables.write_dataset(S.enriched(spark, sf), path)
    return spark.read.parquet(path).select(*ENRICHED_COLUMNS.split(", "))


@query(
    "read_latest_snapshot",
    "S3 S4",
    "SELECT event_id, event_type, value, '20240131_060000' AS snapshot, '2024-01-31 06:00:00' AS snapshot_at "
    "FROM events",
)
def read_latest_snapshot(spark, sf):
    root = scratch_path(spark, "snapshots")
    events = S.table(spark, sf, "events").select("event_id", "event_type", "value")
    snapshots.write_snapshot(events.where("event_type = 'click'"), root, "20240124_060000")
    snapshots.write_snapshot(events, root, "20240131_060000")
    newest = snapshots.latest_snapshot(spark, root).select("snapshot_at").scalar()
    latest = snapshots.read_latest_snapshot(spark, root)
    return latest.withColumn("snapshot_at", F.date_format(newest, "yyyy-MM-dd HH:mm:ss"))


@query("read_table", "S5", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def read_table(spark, sf):
    S.table(spark, sf, "orders").createOrReplaceTempView("ticketloom_orders")
    return tables.read_table(spark, "ticketloom_orders").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("replace_table", "S6", S.with_(S.TICKETS) + "SELECT id, subject, body, answer, queue, priority, language FROM tickets")
def replace_table(spark, sf):
    t = S.tickets(spark, sf)
    path = scratch_path(spark, "replaced")
    tables.replace_table(t.select("id", "queue"), "ticketloom_replaced", path=path)
    tables.replace_table(t.select("id", "subject", "body", "answer", "queue", "priority", "language"), "ticketloom_replaced", path=path)
    return tables.read_table(spark, "ticketloom_replaced")


@query("reload_table", "S7", S.with_(S.TICKETS) + "SELECT id, queue FROM tickets WHERE language = 'en'")
def reload_table(spark, sf):
    t = S.tickets(spark, sf)
    tables.replace_table(t.select("id", "queue"), "ticketloom_reloaded", path=scratch_path(spark, "reloaded"))
    tables.reload_table(t.where("language = 'en'"), "ticketloom_reloaded")
    return tables.read_table(spark, "ticketloom_reloaded")


@query(
    "append_log",
    "S8",
    """SELECT batch, count(*) AS n_rows, count(*) AS n_ids, true AS positive, 0 AS shared FROM (
      SELECT CASE WHEN value < 50 THEN '1' ELSE '2' END AS batch FROM events) GROUP BY batch""",
)
def append_log(spark, sf):
    """Two batches written at the same time."""
    log = S.prediction_log(spark, sf)
    path = scratch_path(spark, "log")
    parts = [(log.where(F.col("confidence_queue") < 0.1), "1"), (log.where(F.col("confidence_queue") >= 0.1), "2")]
    with ThreadPoolExecutor(2) as pool:
        first, second = pool.map(lambda part: tables.append_log(part[0], path, part[1]), parts)
    both = first.withColumn("batch", F.lit("1")).unionByName(second.withColumn("batch", F.lit("2")))
    shared = first.join(second, "id").agg(F.count("*").cast("int")).scalar()
    return both.groupBy("batch").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        (F.min("id") > 0).alias("positive"),
        shared.alias("shared"),
    )


@query(
    "insert_ignore",
    "S9",
    """SELECT user_id, event_id, value FROM events
       WHERE user_id NOT IN (SELECT user_id FROM events WHERE value > 300)
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def insert_ignore(spark, sf):
    events = S.table(spark, sf, "events")
    existing = events.where("value > 300").select("user_id").distinct()
    return feedback.insert_ignore(events, existing, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query(
    "apply_feedback",
    "S10",
    S.with_(S.LATEST)
    + """SELECT id, predicted_queue, feedback_queue, feedback_urgency,
         strftime(feedback_at, '%Y-%m-%d %H:%M:%S') AS feedback_at FROM corrected""",
)
def apply_feedback(spark, sf):
    merged = feedback.apply_feedback(S.prediction_log(spark, sf), S.feedback(spark, sf))
    at = F.date_format("feedback_at", "yyyy-MM-dd HH:mm:ss").alias("feedback_at")
    return merged.select("id", "predicted_queue", "feedback_queue", "feedback_urgency", at)


@query(
    "rejected_feedback",
    "S10",
    S.with_(S.LOG, S.FEEDBACK)
    + """SELECT feedback_id, prediction_id,
         CASE WHEN NOT valid THEN 'invalid' ELSE 'unknown prediction' END AS reason
         FROM checked WHERE NOT valid OR prediction_id NOT IN (SELECT id FROM log)""",
)
def rejected_feedback(spark, sf):
    rejected = feedback.rejected_feedback(S.prediction_log(spark, sf), S.feedback(spark, sf))
    return rejected.select("feedback_id", "prediction_id", "reason")


@query(
    "add_columns",
    "S11",
    S.with_(S.TICKETS)
    + "SELECT id, queue, CAST(NULL AS VARCHAR) AS tag_1, CAST(NULL AS VARCHAR) AS tag_2 FROM tickets",
)
def add_columns(spark, sf):
    t = S.tickets(spark, sf).select("id", "queue")
    return tables.add_columns(t, {"tag_1": "string", "tag_2": "string", "queue": "string"})


@query(
    "run_record",
    "S13",
    S.with_(S.GRADED)
    + """SELECT 'run-1' AS run_id, round(avg(CAST(label = prediction AS DOUBLE)), 6) AS f1_queue,
         'graded' AS dataset, CAST(count(*) AS VARCHAR) AS n_rows FROM graded""",
)
def run_record(spark, sf):
    graded = S.graded(spark, sf)
    score = metrics.accuracy(graded)
    n = graded.agg(F.count("*").cast("string")).scalar()
    record = score.select(
        F.lit("run-1").alias("run_id"),
        F.lit("graded").alias("dataset"),
        F.struct(F.col("accuracy").alias("f1_queue"), F.col("accuracy").alias("f1_urgency")).alias("metrics"),
        F.create_map(F.lit("n_rows"), n).alias("params"),
    )
    path = scratch_path(spark, "runs")
    records.write_run_record(record, path)
    stored = records.read_run_record(spark, path)
    return stored.select(
        "run_id", F.round("metrics.f1_queue", 6).alias("f1_queue"), "dataset", F.col("params")["n_rows"].alias("n_rows")
    )


@query("count_rows", "S14", "SELECT count(*) AS n_rows FROM lineitem")
def count_rows(spark, sf):
    return aggregates.count_rows(S.table(spark, sf, "lineitem"))


@query(
    "latest_per_key",
    "W4",
    """SELECT user_id, event_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(spark, sf):
    events = S.table(spark, sf, "events")
    return windows.latest_per_key(events, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")
