"""Queries over joins, aggregations, windows, samples and set operations."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.catalog import standins as S
from ticketloom.catalog.registry import query
from ticketloom.operators import (
    aggregates,
    feedback,
    joins,
    metrics,
    models,
    sampling,
    windows,
)
from ticketloom.session import cut_lineage

# --- joins --------------------------------------------------------------------------------------


@query(
    "cache_lookup",
    "J1",
    S.with_(S.CACHE)
    + """SELECT d.doc_id AS id, sha256(d.text) AS text_hash, c.text_hash IS NOT NULL AS cached,
         CASE WHEN c.text_hash IS NOT NULL THEN CAST(length(d.text) AS DOUBLE) ELSE -1e0 END AS first_value
         FROM documents d LEFT JOIN (SELECT * FROM cache WHERE model_name = 'hashed-ngrams') c
         ON c.text_hash = sha256(d.text)""",
)
def cache_lookup(spark, sf):
    texts = S.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    found = joins.cache_lookup(joins.text_keys(texts, S.MODEL), S.embedding_cache(spark, sf))
    first = F.coalesce(F.col("embedding")[0].cast("double"), F.lit(-1.0))
    return found.select("id", "text_hash", F.col("embedding").isNotNull().alias("cached"), first.alias("first_value"))


@query(
    "cache_misses",
    "J2",
    S.with_(S.CACHE)
    + """SELECT DISTINCT sha256(text) AS text_hash, text FROM documents
         WHERE sha256(text) NOT IN (SELECT text_hash FROM cache WHERE model_name = 'hashed-ngrams')""",
)
def cache_misses(spark, sf):
    return joins.cache_misses(S.table(spark, sf, "documents"), S.embedding_cache(spark, sf), S.MODEL)


@query(
    "feedback_to_log",
    "J3",
    S.with_(S.LATEST)
    + """SELECT l.id, l.predicted_queue, f.correct_queue, f.correct_urgency
         FROM log l LEFT JOIN latest f ON f.prediction_id = l.id""",
)
def feedback_to_log(spark, sf):
    log = S.prediction_log(spark, sf)
    given = feedback.valid_corrections(S.feedback(spark, sf))
    return joins.feedback_to_log(log, given).select("id", "predicted_queue", "correct_queue", "correct_urgency")


@query(
    "known_feedback",
    "J3",
    S.with_(S.LOG, S.FEEDBACK)
    + """SELECT prediction_id IN (SELECT id FROM log) AS known, count(*) AS n FROM feedback GROUP BY 1""",
)
def known_feedback(spark, sf):
    log, given = S.prediction_log(spark, sf), S.feedback(spark, sf)
    known = joins.known_feedback(log, given).withColumn("known", F.lit(True))
    unknown = joins.unknown_feedback(log, given).withColumn("known", F.lit(False))
    return known.unionByName(unknown).groupBy("known").agg(F.count("*").alias("n"))


@query("decode_label", "J4", "SELECT doc_id, source AS class FROM documents")
def decode_label(spark, sf):
    d = S.table(spark, sf, "documents").select("doc_id", "source")
    encoded = models.encode_label(d, "source", "prediction").drop("source")
    return joins.decode_label(encoded, models.class_index(d, "source")).select("doc_id", "class")


@query(
    "attach_class_weight",
    "J5",
    S.with_(S.TICKETS)
    + """SELECT t.id, t.queue, round(w.weight, 6) AS weight FROM tickets t JOIN (
           SELECT queue, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
           FROM tickets GROUP BY queue) w USING (queue)""",
)
def attach_class_weight(spark, sf):
    t = S.tickets(spark, sf)
    weighted = joins.attach_class_weight(t, aggregates.balanced_weights(t, "queue"), "queue")
    return weighted.select("id", "queue", F.round("weight", 6).alias("weight"))


@query(
    "hstack_by_id",
    "J7",
    """SELECT vec_id AS id, CAST(len(embedding) + 2 AS INTEGER) AS width,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) + label + vec_id, 6) AS total
       FROM embeddings""",
)
def hstack_by_id(spark, sf):
    e = S.table(spark, sf, "embeddings").withColumnRenamed("vec_id", "id")
    numbers = e.select("id", "label", F.col("id").alias("place"))
    stacked = joins.hstack_by_id(e.select("id", "embedding"), numbers, ["label", "place"])
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    return stacked.select("id", F.size(values).alias("width"), F.round(total, 6).alias("total"))


@query(
    "map_feedback_labels",
    "J8",
    S.with_(S.FEEDBACK)
    + """SELECT feedback_id, correct_queue, CASE correct_queue WHEN 'network' THEN 'Network / Infrastructure'
         WHEN 'hardware' THEN 'Hardware / Device' WHEN 'security' THEN 'Security / Access' END AS feedback_class
         FROM feedback""",
)
def map_feedback_labels(spark, sf):
    return joins.map_feedback_labels(S.feedback(spark, sf)).select("feedback_id", "correct_queue", "feedback_class")


@query(
    "unmapped_feedback",
    "J8",
    S.with_(S.FEEDBACK) + "SELECT feedback_id, correct_queue FROM feedback WHERE correct_queue = 'billing'",
)
def unmapped_feedback(spark, sf):
    mapped = joins.map_feedback_labels(S.feedback(spark, sf))
    return joins.unmapped_feedback(mapped).select("feedback_id", "correct_queue")


# --- aggregations -------------------------------------------------------------------------------


@query("value_counts", "A1", "SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return aggregates.value_counts(S.table(spark, sf, "orders"), "o_orderpriority")


@query(
    "value_counts_head",
    "A1",
    "SELECT user_id AS value, count(*) AS count FROM events GROUP BY 1 ORDER BY count DESC, value LIMIT 10",
)
def value_counts_head(spark, sf):
    return aggregates.value_counts(S.table(spark, sf, "events"), "user_id", 10)


@query(
    "value_shares",
    "A2",
    "SELECT user_id AS value, round(count(*) * 1e2 / sum(count(*)) OVER (), 6) AS pct FROM events GROUP BY 1",
)
def value_shares(spark, sf):
    shares = aggregates.value_shares(S.table(spark, sf, "events"), "user_id")
    return shares.select("value", F.round("pct", 6).alias("pct"))


@query(
    "class_distribution",
    "A3",
    S.with_(S.ENRICHED)
    + """SELECT refined_queue AS class, count(*) AS count,
         round(count(*) * 1e2 / sum(count(*)) OVER (), 1) AS pct FROM enriched GROUP BY 1""",
)
def class_distribution(spark, sf):
    return aggregates.class_distribution(S.enriched(spark, sf), "refined_queue")


@query(
    "feature_means",
    "A4",
    S.with_(S.ENRICHED)
    + "SELECT "
    + ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in K.NUMERIC_FEATURES)
    + " FROM enriched",
)
def feature_means(spark, sf):
    means = aggregates.feature_means(S.enriched(spark, sf))
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def profile_sql(col: str) -> str:
    return f"""SELECT '{col}' AS "column", count(*) AS n_rows, count(*) - count({col}) AS missing,
      count(DISTINCT {col}) AS "distinct", round(avg({col}), 7) AS mean, round(stddev_samp({col}), 7) AS std,
      CAST(min({col}) AS DOUBLE) AS min, round(quantile_cont(CAST({col} AS DOUBLE), 0.25), 6) AS q25,
      round(quantile_cont(CAST({col} AS DOUBLE), 0.5), 6) AS median,
      round(quantile_cont(CAST({col} AS DOUBLE), 0.75), 6) AS q75, CAST(max({col}) AS DOUBLE) AS max,
      (SELECT CAST({col} AS DOUBLE) FROM lineitem GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)
        AS most_frequent FROM lineitem"""


@query("data_profile", "A5", " UNION ALL ".join(profile_sql(c) for c in PROFILED))
def data_profile(spark, sf):
    profile = aggregates.data_profile(S.table(spark, sf, "lineitem"), PROFILED)
    digits = {"mean": 7, "std": 7, "q25": 6, "median": 6, "q75": 6}
    return profile.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in profile.columns])


@query("accuracy", "A6", S.with_(S.GRADED) + "SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM graded")
def accuracy(spark, sf):
    return metrics.accuracy(S.graded(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


REPORT = """classes AS (SELECT label AS class FROM graded UNION SELECT prediction FROM graded),
counted AS (
  SELECT class, (SELECT count(*) FROM graded WHERE label = class) AS support,
    (SELECT count(*) FROM graded WHERE prediction = class) AS predicted,
    (SELECT count(*) FROM graded WHERE label = class AND prediction = class) AS tp FROM classes),
per_class AS (
  SELECT CAST(class AS VARCHAR) AS class, support, tp,
    CASE WHEN predicted = 0 THEN 0e0 ELSE tp / CAST(predicted AS DOUBLE) END AS precision,
    CASE WHEN support = 0 THEN 0e0 ELSE tp / CAST(support AS DOUBLE) END AS recall,
    CASE WHEN predicted + support = 0 THEN 0e0 ELSE 2 * tp / CAST(predicted + support AS DOUBLE) END AS f1
  FROM counted),
report AS (
  SELECT class, precision, recall, f1, support FROM per_class
  UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support)
    FROM per_class
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(support * precision) / sum(support), sum(support * recall) / sum(support),
    sum(support * f1) / sum(support), sum(support) FROM per_class)"""


@query(
    "classification_report",
    "A7",
    S.with_(S.GRADED, REPORT)
    + """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
         CAST(support AS BIGINT) AS support FROM report""",
)
def classification_report(spark, sf):
    report = metrics.classification_report(S.graded(spark, sf))
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    return report.select("class", *rounded, "support")


@query(
    "f1_weighted",
    "A7",
    S.with_(S.GRADED, REPORT) + "SELECT round(f1, 6) AS f1_weighted FROM report WHERE class = 'weighted avg'",
)
def f1_weighted(spark, sf):
    return metrics.f1_weighted(S.graded(spark, sf)).select(F.round("f1_weighted", 6).alias("f1_weighted"))


@query(
    "balanced_weights",
    "A8",
    """SELECT o_orderpriority AS class,
       round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight
       FROM orders GROUP BY 1""",
)
def balanced_weights(spark, sf):
    weights = aggregates.balanced_weights(S.table(spark, sf, "orders"), "o_orderpriority")
    return weights.select("class", F.round("weight", 6).alias("weight"))


@query(
    "cache_hit_rate",
    "A9",
    S.with_(S.CACHE)
    + """SELECT count(*) AS total, count(c.text_hash) AS hits, round(count(c.text_hash) * 1e2 / count(*), 6) AS hit_rate
         FROM documents d LEFT JOIN (SELECT * FROM cache WHERE model_name = 'hashed-ngrams') c
         ON c.text_hash = sha256(d.text)""",
)
def cache_hit_rate(spark, sf):
    texts = S.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    found = joins.cache_lookup(joins.text_keys(texts, S.MODEL), S.embedding_cache(spark, sf))
    return aggregates.cache_hit_rate(found).withColumn("hit_rate", F.round("hit_rate", 6))


@query(
    "strata_counts",
    "A10",
    S.with_(S.ENRICHED) + "SELECT refined_queue, urgency_level, count(*) AS count FROM enriched GROUP BY 1, 2",
)
def strata_counts(spark, sf):
    return aggregates.strata_counts(S.enriched(spark, sf), ["refined_queue", "urgency_level"])


SCORES = """scores AS (SELECT 'run-' || user_id AS run_id, CASE WHEN event_type = 'error' THEN 0e0
  ELSE value / 500e0 END AS score FROM events)"""


def _scores(spark, sf):
    """Every event as the score of one fold of its user's run."""
    score = F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value") / 500.0)
    return S.table(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"), score.alias("score")
    )


@query(
    "mean_cv_score",
    "A11",
    S.with_(SCORES)
    + """SELECT run_id, round(CASE WHEN avg(score) = 0 THEN 1e-2 ELSE avg(score) END, 6) AS mean_score
         FROM scores GROUP BY 1""",
)
def mean_cv_score(spark, sf):
    scores = aggregates.mean_cv_score(_scores(spark, sf))
    return scores.select("run_id", F.round("mean_score", 6).alias("mean_score"))


@query(
    "best_run",
    "A12",
    """SELECT 'run-' || event_id AS run_id, value AS score, event_type AS kind, 6 AS max_depth FROM events
       ORDER BY value DESC, 'run-' || event_id DESC LIMIT 1""",
)
def best_run(spark, sf):
    runs = S.table(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.col("value").alias("score"),
        F.col("event_type").alias("kind"),
        F.lit(None).cast("int").alias("max_depth"),
    )
    return aggregates.best_run(runs, "score", ["kind", "max_depth"], {"kind": "none", "max_depth": 6})


@query(
    "feedback_stats",
    "A13",
    S.with_(S.RATED)
    + """SELECT unused, round(satisfaction, 6) AS satisfaction, reason, reason <> 'none' AS retrain FROM (
           SELECT *, CASE WHEN unused >= 1000 THEN 'new feedback' WHEN satisfaction < 8e-1 THEN 'low satisfaction'
             WHEN dayofweek(TIMESTAMP '2024-01-31 00:00:00') = 0 THEN 'weekly' ELSE 'none' END AS reason
           FROM (SELECT count(*) FILTER (NOT used_for_training) AS unused,
             avg(CASE WHEN created_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AND feedback_score <> 0
                 THEN CAST(feedback_score > 0 AS DOUBLE) END) AS satisfaction FROM rated))""",
)
def feedback_stats(spark, sf):
    stats = aggregates.feedback_stats(S.rated_feedback(spark, sf), S.NOW)
    return stats.withColumn("satisfaction", F.round("satisfaction", 6))


@query(
    "confusion_counts", "A14", S.with_(S.GRADED) + "SELECT label, prediction, count(*) AS count FROM graded GROUP BY 1, 2"
)
def confusion_counts(spark, sf):
    return metrics.confusion_counts(S.graded(spark, sf))


@query(
    "drop_rare_classes",
    "P12",
    """SELECT event_id, props FROM events WHERE props IN (SELECT props FROM events GROUP BY props HAVING count(*) >= 100)""",
)
def drop_rare_classes(spark, sf):
    events = S.table(spark, sf, "events").select("event_id", "props")
    return aggregates.drop_rare_classes(events, "props", 100)


# --- windows ------------------------------------------------------------------------------------


@query(
    "share_of_total",
    "W1",
    """SELECT l_returnflag, l_linestatus, count(*) AS count, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6)
       AS share FROM lineitem GROUP BY 1, 2""",
)
def share_of_total(spark, sf):
    counts = aggregates.strata_counts(S.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])
    return windows.share_of_total(counts).withColumn("share", F.round("share", 6))


@query(
    "row_index",
    "W2",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index,
       'ticket_' || (row_number() OVER (ORDER BY o_orderkey) - 1) AS ticket_id FROM orders""",
)
def row_index(spark, sf):
    return sampling.ticket_ids(S.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "stratified_position",
    "W6",
    """SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
         ORDER BY sha256('42-' || o_orderkey), o_orderkey) AS position,
       count(*) OVER (PARTITION BY o_orderpriority) AS stratum_size FROM orders""",
)
def stratified_position(spark, sf):
    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_position(orders, ["o_orderpriority"], 42, "o_orderkey")


@query(
    "halves",
    "W7",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) - 1 < floor(count(*) OVER () * 503e-3)
       THEN 'reference' ELSE 'current' END AS half FROM orders""",
)
def halves(spark, sf):
    return sampling.halves(S.table(spark, sf, "orders").select("o_orderkey"), 0.503, "o_orderkey")


# --- sorts, limits, samples ---------------------------------------------------------------------


@query(
    "sort_desc_limit",
    "L1",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def sort_desc_limit(spark, sf):
    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sort_desc_limit(orders, "o_totalprice", 25, "o_orderkey")


@query("preview", "L2", S.with_(S.TICKETS) + "SELECT id, queue, substring(body, 1, 60) AS body FROM tickets ORDER BY id LIMIT 10")
def preview(spark, sf):
    return sampling.preview(S.tickets(spark, sf).select("id", "queue", "body"), 10, cut={"body": 60})


@query(
    "nearest_k",
    "L3",
    S.with_(S.VECTORS)
    + """SELECT doc_id, round(distance, 6) + 0e0 AS distance FROM pairs
         WHERE qid = (SELECT min(vec_id) FROM embeddings) ORDER BY round(distance, 9), doc_id LIMIT 5""",
)
def nearest_k(spark, sf):
    docs = S.vector_docs(spark, sf)
    vector = docs.orderBy("doc_id").first()["embedding"]
    nearest = sampling.nearest_k(docs, vector, 5, "doc_id")
    return nearest.select("doc_id", F.round("distance", 6).alias("distance"))


@query(
    "hash_sample",
    "L4",
    "SELECT event_id, event_type FROM events ORDER BY sha256('7-' || event_id), event_id LIMIT 1000",
)
def hash_sample(spark, sf):
    return sampling.hash_sample(S.table(spark, sf, "events").select("event_id", "event_type"), 1000, 7, "event_id")


@query(
    "stratified_sample",
    "L5",
    """SELECT o_orderkey, o_orderpriority FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY sha256('42-' || o_orderkey), o_orderkey)
         <= greatest(1, floor(count(*) OVER (PARTITION BY o_orderpriority) * 3e3 / count(*) OVER ()))""",
)
def stratified_sample(spark, sf):
    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_sample(orders, ["o_orderpriority"], 3000, 42, "o_orderkey")


@query(
    "first_matches",
    "L6",
    S.with_(S.ENRICHED)
    + "SELECT id, refined_queue FROM enriched WHERE refined_queue = 'Network / Infrastructure' ORDER BY id LIMIT 5",
)
def first_matches(spark, sf):
    # stored first: a filter on the class would be pushed below the patterns that derive it and repeat them
    stored = cut_lineage(S.enriched(spark, sf).select("id", "refined_queue"))
    return sampling.first_matches(stored, F.col("refined_queue") == K.NETWORK_QUEUE, 5)


# --- set operations -----------------------------------------------------------------------------


@query(
    "append_feedback",
    "U1",
    S.with_(S.ENRICHED, S.LATEST)
    + """SELECT id, subject, refined_queue, urgency_level, language, queue, body_length, answer_length,
           round(response_ratio, 6) AS response_ratio FROM enriched
         UNION ALL
         SELECT -id - 1, input_text, CASE feedback_queue WHEN 'network' THEN 'Network / Infrastructure'
           WHEN 'hardware' THEN 'Hardware / Device' WHEN 'security' THEN 'Security / Access' END,
           CASE WHEN coalesce(feedback_urgency, predicted_urgency) IN ('critical', 'high') THEN 'high'
             WHEN coalesce(feedback_urgency, predicted_urgency) = 'medium' THEN 'medium' ELSE 'low' END,
           'en', '', CAST(length(input_text) AS INTEGER), 0, 1e0
         FROM corrected WHERE feedback_queue IN ('network', 'hardware', 'security')""",
)
def append_feedback(spark, sf):
    log = feedback.apply_feedback(S.prediction_log(spark, sf), S.feedback(spark, sf))
    merged = feedback.append_feedback(S.enriched(spark, sf), log, S.TEST_KEYWORDS)
    return merged.select(
        "id", "subject", "refined_queue", "urgency_level", "language", "queue", "body_length", "answer_length",
        F.round("response_ratio", 6).alias("response_ratio"),
    )


@query(
    "split_complement",
    "U3",
    S.with_(S.TICKETS)
    + """SELECT id, queue FROM tickets QUALIFY row_number() OVER (PARTITION BY queue
         ORDER BY sha256('42-' || id), id) > round(count(*) OVER (PARTITION BY queue) * 3e-1)""",
)
def split_complement(spark, sf):
    split = sampling.stratified_split(S.tickets(spark, sf).select("id", "queue"), ["queue"], 0.3)
    return sampling.split_complement(split, "test")


@query("distinct_texts", "U4", "SELECT DISTINCT sha256(text) AS text_hash, text FROM documents")
def distinct_texts(spark, sf):
    return joins.distinct_texts(S.table(spark, sf, "documents"))


# --- labels and splits --------------------------------------------------------------------------


@query(
    "encode_label",
    "M1",
    """SELECT o_orderkey, o_orderpriority,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label FROM orders""",
)
def encode_label(spark, sf):
    return models.encode_label(S.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query(
    "class_index",
    "M1",
    """SELECT o_orderpriority AS class, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS index
       FROM orders GROUP BY 1""",
)
def class_index(spark, sf):
    return models.class_index(S.table(spark, sf, "orders"), "o_orderpriority")


SPLIT = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY sha256('42-' || id), id) AS p,
    count(*) OVER (PARTITION BY {keys}) AS n FROM {table}),
cut AS (SELECT *, round(n * {test}) AS n_test FROM placed),
split AS (
  SELECT *, CASE WHEN p <= n_test THEN 'test' WHEN p <= n_test + round((n - n_test) * {val}) THEN 'val'
    ELSE 'train' END AS split FROM cut)"""


@query(
    "stratified_split",
    "M2",
    S.with_(S.ENRICHED, SPLIT.format(keys="queue, urgency_level", table="enriched", test="15e-2", val="15e-2"))
    + "SELECT id, queue, urgency_level, split FROM split",
)
def stratified_split(spark, sf):
    rows = S.enriched(spark, sf).select("id", "queue", "urgency_level")
    return sampling.stratified_split(rows, ["queue", "urgency_level"], 0.15, 0.15)


@query(
    "random_split",
    "M2b",
    """SELECT event_id, CASE WHEN CAST(('0x' || substring(sha256('42-' || event_id), 1, 8)) AS BIGINT) / 4294967296e0
       < 2e-1 THEN 'test' ELSE 'train' END AS split FROM events""",
)
def random_split(spark, sf):
    return sampling.random_split(S.table(spark, sf, "events").select("event_id"), 0.2, 42, "event_id")


@query(
    "promotion_gate",
    "M14",
    """SELECT 'run-' || user_id AS run_id, CASE WHEN avg(value) / 5e1 >= 7e-1 AND max(value) / 3e2 >= 65e-2
         THEN 'success' ELSE 'rejected' END AS status,
       CASE WHEN avg(value) / 5e1 >= 7e-1 AND max(value) / 3e2 >= 65e-2 THEN 'both scores reach their minimum'
         WHEN avg(value) / 5e1 >= 7e-1 THEN 'f1_urgency below minimum'
         WHEN max(value) / 3e2 >= 65e-2 THEN 'f1_queue below minimum' ELSE 'both scores below minimum' END AS reason
       FROM events GROUP BY user_id""",
)
def promotion_gate(spark, sf):
    runs = S.table(spark, sf, "events").groupBy("user_id").agg(
        (F.avg("value") / 50.0).alias("f1_queue"), (F.max("value") / 300.0).alias("f1_urgency")
    )
    named = runs.withColumn("run_id", F.concat(F.lit("run-"), F.col("user_id").cast("string")))
    return metrics.promotion_gate(named)


@query(
    "sft_pairs",
    "M16",
    S.with_(S.TICKETS) + "SELECT id, subject || ' ' || body AS prompt, answer AS completion FROM tickets",
)
def sft_pairs(spark, sf):
    return feedback.sft_pairs(S.tickets(spark, sf))


@query(
    "preference_pairs",
    "M17",
    S.with_(S.RATED)
    + """SELECT feedback_id, question AS prompt, agent_correction AS chosen,
         CASE WHEN agent_correction IS NOT NULL THEN response END AS rejected,
         CASE WHEN agent_correction IS NULL THEN response END AS response,
         coalesce(CASE WHEN agent_correction IS NULL THEN feedback_score END, 0) AS reward
         FROM rated WHERE NOT used_for_training AND feedback_score <> 0""",
)
def preference_pairs(spark, sf):
    pairs = feedback.preference_pairs(S.rated_feedback(spark, sf))
    return pairs.withColumn("reward", F.coalesce("reward", F.lit(0)))


@query(
    "mark_used",
    "M17",
    S.with_(S.RATED)
    + "SELECT feedback_id, used_for_training OR feedback_score <> 0 AS used_for_training FROM rated",
)
def mark_used(spark, sf):
    return feedback.mark_used(S.rated_feedback(spark, sf)).select("feedback_id", "used_for_training")
