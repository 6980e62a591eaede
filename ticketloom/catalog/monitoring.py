"""Queries over drift, conversations, streaming and the monitoring loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.catalog import standins as S
from ticketloom.catalog.registry import query
from ticketloom.catalog.rows import DRIFT_TICKETS
from ticketloom.operators import dialog, drift, feedback, models, projections, textvec, windows
from ticketloom.plans import monitor, serve
from ticketloom.plans.enrich import training_table
from ticketloom.session import cut_lineage, scratch_path
from ticketloom.sources.tables import spread
from ticketloom.streaming import jobs

# --- drift --------------------------------------------------------------------------------------


@query(
    "reference_window",
    "D1",
    S.with_(S.ENRICHED)
    + """SELECT id, refined_queue, body_length, has_software FROM enriched """,
)
def reference_window(spark, sf):
    return drift.reference_window(S.enriched(spark, sf)).select("id", "refined_queue", "body_length", "has_software")


@query(
    "current_window",
    "D2",
    S.with_(S.LOG, DRIFT_TICKETS)
    + """SELECT id, refined_queue, body_length, has_network, has_software FROM drift_tickets
         WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""",
)
def current_window(spark, sf):
    current = drift.current_window(
        S.prediction_log(spark, sf), S.NOW, as_tickets=lambda rows: projections.log_as_drift_tickets(rows, S.TEST_FRAGMENTS)
    )
    return current.select("id", "refined_queue", "body_length", "has_network", "has_software")


DRIFT_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber", "l_late"]

# reference: lines not yet returned; current: returned lines
SIDES = """side AS (SELECT l_returnflag = 'N' AS ref, CAST(l_quantity AS DOUBLE) AS l_quantity,
    CAST(l_extendedprice AS DOUBLE) AS l_extendedprice, CAST(l_discount AS DOUBLE) AS l_discount,
    CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_linestatus = 'O' AS DOUBLE) AS l_late FROM lineitem),
long AS (UNPIVOT side ON l_quantity, l_extendedprice, l_discount, l_linenumber, l_late INTO NAME "column" VALUE value),
counts AS (SELECT "column", value, CAST(count(*) FILTER (ref) AS DOUBLE) AS n_ref,
    CAST(count(*) FILTER (NOT ref) AS DOUBLE) AS n_cur FROM long GROUP BY 1, 2),
sized AS (SELECT *, sum(n_ref) OVER c AS s_ref, sum(n_cur) OVER c AS s_cur,
    count(*) FILTER (n_ref > 0) OVER c AS distinct_ref,
    sum(n_ref) OVER (c ORDER BY value) AS f_ref, sum(n_cur) OVER (c ORDER BY value) AS f_cur,
    lead(value) OVER (c ORDER BY value) - value AS width FROM counts WINDOW c AS (PARTITION BY "column")),
deviation AS (SELECT "column", stddev_pop(value) AS std FROM long WHERE ref GROUP BY 1),
terms AS (SELECT *, n_ref / s_ref AS p, n_cur / s_cur AS q, (n_ref / s_ref + n_cur / s_cur) / 2 AS m FROM sized),
scored AS (SELECT "column", any_value(distinct_ref) AS distinct_ref,
    sum(abs(f_ref / s_ref - f_cur / s_cur) * coalesce(width, 0)) AS area,
    sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0e0 END
      + CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0e0 END) / 2), 0e0)) AS divergence FROM terms GROUP BY 1),
col_drift AS (SELECT "column", CASE WHEN distinct_ref > 5 THEN 'wasserstein' ELSE 'jensen-shannon' END AS method,
    CASE WHEN distinct_ref > 5 THEN area / greatest(std, 1e-3) ELSE divergence END AS score
  FROM scored JOIN deviation USING ("column"))"""


def _sides(spark, sf):
    lines = S.table(spark, sf, "lineitem").withColumn("l_late", F.col("l_linestatus") == "O")
    return lines.where("l_returnflag = 'N'"), lines.where("l_returnflag <> 'N'")


@query(
    "column_drift",
    "D3",
    S.with_(SIDES)
    + """SELECT "column", method, round(score, 6) AS score, 1e-2 AS threshold, score >= 1e-2 AS drifted FROM col_drift""",
)
def column_drift(spark, sf):
    reference, current = _sides(spark, sf)
    return drift.column_drift(reference, current, DRIFT_COLUMNS, 0.01).withColumn("score", F.round("score", 6))


@query(
    "dataset_drift",
    "D4",
    S.with_(SIDES)
    + """SELECT avg(CAST(score >= 1e-2 AS DOUBLE)) AS drift_share, avg(CAST(score >= 1e-2 AS DOUBLE)) AS measured_share,
         avg(CAST(score >= 1e-2 AS DOUBLE)) > 5e-1 AS dataset_drift, (SELECT count(*) FROM side WHERE ref) AS n_ref,
         (SELECT count(*) FROM side WHERE NOT ref) AS n_cur FROM col_drift""",
)
def dataset_drift(spark, sf):
    reference, current = _sides(spark, sf)
    columns = drift.column_drift(reference, current, DRIFT_COLUMNS, 0.01)
    return drift.dataset_drift(columns, reference, current)


@query(
    "drift_gate",
    "P16",
    S.with_(SIDES)
    + """SELECT avg(CAST(score >= 1e-2 AS DOUBLE)) AS drift_share, CASE WHEN avg(CAST(score >= 1e-2 AS DOUBLE)) > 5e-2
         THEN 'retrain' ELSE 'stable' END AS decision FROM col_drift""",
)
def drift_gate(spark, sf):
    return projections.drift_gate(dataset_drift(spark, sf)).select("drift_share", "decision")


@query(
    "drift_log_append",
    "D5",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS check_date, avg(value) > 5e1 AS drift_detected,
       round(avg(value) / 1e2, 6) AS drift_share FROM events
       WHERE date_trunc('day', ts) NOT IN (SELECT date_trunc('day', ts) FROM events WHERE value > 400) GROUP BY 1""",
)
def drift_log_append(spark, sf):
    """One check per day of the log; days that are recorded already are left alone."""
    events = S.table(spark, sf, "events").withColumn("check_date", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    checks = events.groupBy("check_date").agg(
        (F.avg("value") > 50).alias("drift_detected"), F.round(F.avg("value") / 100.0, 6).alias("drift_share")
    )
    recorded = events.where("value > 400").select("check_date").distinct()
    added = feedback.insert_ignore(checks, recorded, ["check_date"], ["drift_share"])
    return added.withColumn("check_date", F.date_format("check_date", "yyyy-MM-dd"))


MIX = """sides AS (SELECT event_type AS class, ts < TIMESTAMP '2024-01-24' AS ref FROM events),
mix AS (SELECT class, count(*) FILTER (ref) / CAST(sum(count(*) FILTER (ref)) OVER () AS DOUBLE) AS p,
  count(*) FILTER (NOT ref) / CAST(sum(count(*) FILTER (NOT ref)) OVER () AS DOUBLE) AS q FROM sides GROUP BY 1),
parts AS (SELECT *, (CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0e0 END
  + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0e0 END) / 2 AS divergence FROM mix)"""


def _mix(spark, sf):
    log = S.prediction_log(spark, sf)
    cut = F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")
    before, after = log.where(F.col("created_at") < cut), log.where(F.col("created_at") >= cut)
    return drift.class_mix_drift(before, after, "predicted_queue")


@query(
    "class_mix_drift",
    "D6",
    S.with_(MIX)
    + """SELECT class, round(p, 6) AS ref_share, round(q, 6) AS cur_share, round(divergence, 8) AS divergence FROM parts""",
)
def class_mix_drift(spark, sf):
    rounded = {c: F.round(c, 6) for c in ("ref_share", "cur_share")} | {"divergence": F.round("divergence", 8)}
    return _mix(spark, sf).withColumns(rounded)


@query("class_mix_distance", "D6", S.with_(MIX) + "SELECT round(sqrt(sum(divergence)), 6) AS distance FROM parts")
def class_mix_distance(spark, sf):
    return drift.class_mix_distance(_mix(spark, sf)).select(F.round("distance", 6).alias("distance"))


# --- conversations ------------------------------------------------------------------------------


@query(
    "valid_messages",
    "C1",
    S.with_(S.MESSAGES) + "SELECT conv_id, turn, role FROM messages WHERE role IS NOT NULL AND content IS NOT NULL",
)
def valid_messages(spark, sf):
    return dialog.valid_message_rows(S.messages(spark, sf)).select("conv_id", "turn", "role")


@query(
    "first_user_message",
    "W5",
    S.with_(S.MESSAGES)
    + """SELECT conv_id, coalesce(arg_min(content, turn) FILTER (role = 'user'), '') AS first_user_message
         FROM messages GROUP BY conv_id""",
)
def first_user_message(spark, sf):
    return windows.first_user_message(S.messages(spark, sf))


LAST = """last AS (SELECT conv_id, max(turn) AS last_turn, arg_max(content, turn) AS query, count(*) AS n
  FROM messages GROUP BY conv_id),
first_user AS (SELECT m.conv_id, arg_min(content, turn) AS content FROM messages m JOIN last l USING (conv_id)
  WHERE role = 'user' AND turn < last_turn GROUP BY m.conv_id)"""


@query(
    "rag_query",
    "C2",
    S.with_(S.MESSAGES, LAST)
    + """SELECT l.conv_id, CASE WHEN n > 1 THEN coalesce(f.content, '') || ' ' || query ELSE query END AS rag_query
         FROM last l LEFT JOIN first_user f USING (conv_id)""",
)
def rag_query(spark, sf):
    return dialog.rag_queries(S.messages(spark, sf))


@query(
    "history_before_last",
    "C3",
    S.with_(S.MESSAGES, LAST)
    + "SELECT m.conv_id, turn, role, content FROM messages m JOIN last USING (conv_id) WHERE turn < last_turn",
)
def history_before_last(spark, sf):
    return dialog.history_before_last(S.messages(spark, sf))


@query(
    "build_messages",
    "C4",
    S.with_(S.MESSAGES, LAST)
    + f"""SELECT conv_id, CAST(-1 AS BIGINT) AS position, 'system' AS role, '{dialog.SYSTEM_PROMPT}' AS content FROM last
          UNION ALL SELECT m.conv_id, turn, role, content FROM messages m JOIN last USING (conv_id) WHERE turn < last_turn
          UNION ALL SELECT conv_id, last_turn, 'user', 'Categorie:General' || chr(10) || 'Urgence:low' || chr(10)
            || 'Contexte:' || chr(10) || 'none' || chr(10) || chr(10) || 'Question:' || chr(10) || query FROM last""",
)
def build_messages(spark, sf):
    m = S.messages(spark, sf)
    message = dialog.user_message(F.lit("General"), F.lit("low"), F.lit("none"), F.col("query"))
    prompts = dialog.last_turns(m).select("conv_id", message.alias("message"))
    return dialog.message_rows(m, prompts)


@query(
    "response_row",
    "C5",
    S.with_(S.LOG)
    + """SELECT id AS prediction_id, input_text AS query, predicted_queue, predicted_urgency, response,
         'see ' || predicted_queue || '|' || input_text || '|' || predicted_urgency AS rag_sources FROM log""",
)
def response_row(spark, sf):
    log = S.prediction_log(spark, sf)
    sources = F.array("response", "input_text", "predicted_urgency", "language")
    answered = log.select(
        F.col("id").alias("prediction_id"), F.col("input_text").alias("query"), "predicted_queue", "predicted_urgency",
        "response", sources.alias("sources"),
    )
    return dialog.response_row(answered).withColumn("rag_sources", F.array_join("rag_sources", "|"))


# --- streaming ----------------------------------------------------------------------------------

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _event_stream(spark, sf):
    return jobs.read_file_stream(spark, sf, EVENTS, "events.parquet")


def _log_stream(spark, sf):
    return jobs.event_time(S.log_from_events(_event_stream(spark, sf)))


def _run(df, label):
    path = scratch_path(df.sparkSession, label)
    return jobs.run_to_end(df, f"{path}/out", f"{path}/checkpoint")


@query(
    "stream_enrich",
    "X1",
    S.with_(S.ENRICHED)
    + """SELECT id, refined_queue, urgency_level, body_length, has_network, has_software, body_clean, answer_clean
         FROM enriched""",
)
def stream_enrich(spark, sf):
    arriving = S.tickets_from_documents(jobs.read_file_stream(spark, sf, DOCUMENTS, "documents.parquet"))
    path = scratch_path(spark, "stream-enrich")
    # a micro-batch of few splits is spread over the cores, a large one is not shuffled
    enriched = lambda batch: jobs.stream_enrich(spread(batch, "id"), S.TEST_KEYWORDS)
    jobs.write_batches(arriving, f"{path}/out", f"{path}/checkpoint", enriched).awaitTermination()
    return jobs.read_batches(spark, f"{path}/out").select(
        "id", "refined_queue", "urgency_level", "body_length", "has_network", "has_software", "body_clean", "answer_clean"
    )


def _classifiers(spark, sf, encoder):
    table = training_table(S.enriched(spark, sf))
    rows = textvec.assemble(textvec.embed_texts(table, encoder), "embedding")
    rows = cut_lineage(rows.select("id", "refined_queue", "urgency_level", "features"))
    return {
        target: models.train_classifier(rows, target, "forest", max_depth=5, n_estimators=10)
        for target in ("refined_queue", "urgency_level")
    }


def _streamed_log(spark, sf):
    """User messages arriving as a file stream, classified batch by batch into the prediction log."""
    encoder = textvec.HashEncoder(64)
    fitted = _classifiers(spark, sf, encoder)
    conversations = "conv_id bigint, turn bigint, role string, text string"
    arriving = jobs.read_file_stream(spark, sf, conversations, "conversations.parquet").where("role = 'user'")
    key = F.shiftleft("conv_id", 16) + F.col("turn") + 1
    requests = arriving.select(key.alias("request_id"), F.col("text").alias("user_query"))
    path = scratch_path(spark, "stream-predict")

    def predict(batch):
        found = serve.predict_requests(batch, encoder, fitted, S.TEST_KEYWORDS)
        return serve.log_rows(found, S.NOW, ids=F.col("request_id"))

    jobs.stream_predict(requests, predict, f"{path}/log", f"{path}/checkpoint").awaitTermination()
    return jobs.read_batches(spark, f"{path}/log").drop("batch")


@query("stream_predict", "X2")
def stream_predict(spark, sf):
    stored = _streamed_log(spark, sf)
    return stored.groupBy("predicted_queue", "predicted_urgency").agg(F.count("*").alias("count"))


REQUESTS = """requests AS (SELECT conv_id * 65536 + turn + 1 AS id, text FROM conversations
  WHERE role = 'user' AND length(text) BETWEEN 1 AND 5000 AND trim(text) <> '')"""


@query(
    "stream_predict_corrected",
    "X2 S10",
    S.with_(REQUESTS)
    + """SELECT id, true AS scored, CASE WHEN id % 3 = 0 THEN 'network' END AS feedback_queue FROM requests""",
)
def stream_predict_corrected(spark, sf):
    """Streamed predictions have the ids of their requests, so corrections given later reach them."""
    log = cut_lineage(_streamed_log(spark, sf))
    given = log.where("id % 3 = 0").select(
        F.col("id").alias("feedback_id"), F.col("id").alias("prediction_id"), F.lit("network").alias("correct_queue"),
        F.lit(None).cast("string").alias("correct_urgency"), F.lit(S.NOW).cast("timestamp_ntz").alias("feedback_at"),
    )
    corrected = feedback.apply_feedback(log, given)
    scored = F.col("predicted_queue").isNotNull() & F.col("confidence_queue").between(0, 1)
    return corrected.select("id", scored.alias("scored"), "feedback_queue")


def _run_totals(df, label, keys):
    """The newest totals after a run of the stateful plan, once as stored and once merged."""
    path = scratch_path(df.sparkSession, label)
    jobs.write_totals(df, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    jobs.compact_batches(df.sparkSession, f"{path}/out", lambda batches: jobs.latest_totals(batches, keys))
    return jobs.latest_totals(jobs.read_batches(df.sparkSession, f"{path}/out"), keys)


@query(
    "tumbling_class_counts",
    "X3",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS class,
       count(*) AS count FROM events GROUP BY 1, 2""",
)
def tumbling_class_counts(spark, sf):
    """Totals from the state store: all windows, the last ones and late rows included."""
    totals = jobs.running_class_counts(_log_stream(spark, sf), "predicted_queue")
    done = _run_totals(totals, "tumbling", ["window_start", "class"])
    return done.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "tumbling_class_counts_batch",
    "X3",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type AS class,
       count(*) AS count FROM events GROUP BY 1, 2""",
)
def tumbling_class_counts_batch(spark, sf):
    log = jobs.event_time(S.prediction_log(spark, sf))
    done = jobs.tumbling_class_counts(log, "predicted_queue")
    return done.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


SLIDING = """SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS count, round(avg(value / 500), 6) AS mean
  FROM (SELECT value, ts, date_trunc('day', ts) - to_days(CAST(d AS INTEGER)) AS s FROM events, range(7) r(d))
  {where} GROUP BY 1"""


@query("sliding_feature_means", "X4", SLIDING.format(where=""))
def sliding_feature_means(spark, sf):
    totals = _run_totals(
        jobs.running_feature_means(_log_stream(spark, sf), "confidence_queue"), "sliding", ["window_start"]
    )
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    return jobs.merged_feature_means(totals).withColumns({"window_start": start, "mean": F.round("mean", 6)})


@query("sliding_feature_means_batch", "X4", SLIDING.format(where=""))
def sliding_feature_means_batch(spark, sf):
    log = jobs.event_time(S.prediction_log(spark, sf))
    start = F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    return jobs.sliding_feature_means(log, "confidence_queue").withColumns({"window_start": start, "mean": F.round("mean", 6)})


@query("stream_insert_ignore", "X5", "SELECT DISTINCT event_type, props FROM events")
def stream_insert_ignore(spark, sf):
    path = scratch_path(spark, "first-rows")
    stream = jobs.stream_insert_ignore(
        _event_stream(spark, sf), ["event_type", "props"], ["ts", "event_id"], f"{path}/out", f"{path}/checkpoint"
    )
    stream.awaitTermination()
    return jobs.read_batches(spark, f"{path}/out").select("event_type", "props")


JOINED = """SELECT l.id, f.correct_queue, strftime(f.feedback_at, '%Y-%m-%d %H:%M:%S') AS feedback_at
  FROM log l LEFT JOIN feedback f ON f.prediction_id = l.id AND f.feedback_at >= l.created_at
    AND f.feedback_at <= l.created_at + INTERVAL 1 DAY"""


@query("feedback_stream_join", "X6", S.with_(S.LOG, S.FEEDBACK) + JOINED)
def feedback_stream_join(spark, sf):
    """The stream's matches, completed by what came after the watermark: every prediction, matched or not."""
    corrections = jobs.event_time(S.feedback_from_events(_event_stream(spark, sf)), "feedback_at")
    streamed = _run(jobs.feedback_stream_join(_log_stream(spark, sf), corrections), "joined")
    log = jobs.event_time(S.prediction_log(spark, sf))
    late = jobs.event_time(S.feedback(spark, sf), "feedback_at")
    matches = jobs.complete_matches(spark, scratch_path(spark, "matches"), streamed, log, late)
    return jobs.with_unmatched(matches, log).select("id", "correct_queue", F.date_format("feedback_at", "yyyy-MM-dd HH:mm:ss").alias("feedback_at"))


@query(
    "feedback_join_batch",
    "X6",
    S.with_(S.LOG, S.FEEDBACK) + JOINED,
)
def feedback_join_batch(spark, sf):
    log = jobs.event_time(S.prediction_log(spark, sf))
    corrections = jobs.event_time(S.feedback(spark, sf), "feedback_at")
    at = F.date_format("feedback_at", "yyyy-MM-dd HH:mm:ss").alias("feedback_at")
    return jobs.feedback_stream_join(log, corrections).select("id", "correct_queue", at)


# --- whole chains -------------------------------------------------------------------------------


def _answered(spark, sf):
    """The last message of every conversation classified, matched with documents and turned into a prompt."""
    encoder = textvec.HashEncoder(64)
    fitted = _classifiers(spark, sf, encoder)
    messages = S.messages(spark, sf)
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "content")))
    past = dialog.history_before_last(messages).groupBy("conv_id").agg(
        F.transform(turns, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("history")
    )
    requests = dialog.last_turns(messages).join(past, "conv_id", "left").select(
        F.col("conv_id").alias("request_id"), F.col("query").alias("user_query"), "history"
    )
    predicted = cut_lineage(serve.predict_requests(requests, encoder, fitted, S.TEST_KEYWORDS).drop("features", "embedding"))
    docs = S.enriched(spark, sf).select(
        F.col("id").alias("doc_id"), F.col("body_clean").alias("content"), "refined_queue"
    )
    docs = cut_lineage(textvec.embed_texts(docs, encoder, "content"))
    contexts = serve.answer_context(predicted, docs, encoder)
    return serve.prompts(predicted, contexts)


@query("answer_requests", "M12 C2 R7 C4")
def answer_requests(spark, sf):
    return _answered(spark, sf).select(
        "request_id", "predicted_refined_queue", "predicted_urgency_level", F.size("messages").alias("n_messages"),
        F.size(F.coalesce("sources", F.array().cast("array<string>"))).alias("n_sources"),
    )


@query(
    "answer_prompts",
    "C2 C4",
    """SELECT conv_id AS request_id, CAST(count(*) + 1 AS INTEGER) AS n_messages, true AS classified
       FROM conversations GROUP BY conv_id""",
)
def answer_prompts(spark, sf):
    """Every request's prompt: the system message, its whole history, and the new message."""
    classified = F.col("confidence_refined_queue").between(0, 1) & F.col("predicted_refined_queue").isNotNull()
    return _answered(spark, sf).select("request_id", F.size("messages").alias("n_messages"), classified.alias("classified"))


@query("monitor_and_retrain", "D1 D2 D3 D4 P16 U1 S3 L5 M6 M9 M11 M14")
def monitor_and_retrain(spark, sf):
    """Drift check over the log and, as it finds drift, search, training and the promotion gate."""
    encoder = textvec.HashEncoder(64)
    log = feedback.apply_feedback(S.prediction_log(spark, sf), S.feedback(spark, sf))
    params = monitor.LoopParams(
        reference_rows=None, current_rows=None, trials=2, folds=2, keywords=S.TEST_KEYWORDS, fragments=S.TEST_FRAGMENTS,
        space={"max_depth": ("choice", [4, 5, 6]), "n_estimators": ("choice", [5, 10])},
    )
    # an earlier run has encoded the English tickets; the others are encoded now and appended
    known = textvec.embed_texts(training_table(S.enriched(spark, sf)).where("language = 'en'"), encoder)
    cached = known.select(
        F.sha2("text", 256).alias("text_hash"), F.lit(encoder.name).alias("model_name"), F.col("text").alias("text_content"),
        "embedding", F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("created_at"),
    )
    path = scratch_path(spark, "cache")
    cached.dropDuplicates(["text_hash"]).write.parquet(path)
    cache = spark.read.parquet(path)
    record = monitor.monitor_and_retrain(
        S.enriched(spark, sf), log, cache, encoder, S.NOW, "2024-01-01 00:00:00",
        scratch_path(spark, "training"), "20240131_060000", params, cache_path=path,
        drift_log=scratch_path(spark, "drift-log"),
    )
    return record.select("run_id", "dataset", "status", "reason")


@query(
    "top_k_per_query",
    "W3",
    """SELECT user_id AS qid, event_id AS doc_id, value AS distance, CAST(row_number() OVER (PARTITION BY user_id
       ORDER BY round(value, 9), event_id) AS INTEGER) AS rank FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(value, 9), event_id) <= 5""",
)
def top_k_per_query(spark, sf):
    scored = S.table(spark, sf, "events").select(
        F.col("user_id").alias("qid"), F.col("event_id").alias("doc_id"), F.col("value").alias("distance")
    )
    return windows.top_k_per_query(scored, K.TOP_K)
