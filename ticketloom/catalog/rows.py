"""Queries over row-wise operators and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.catalog import standins as S
from ticketloom.catalog.registry import query
from ticketloom.functions import labels, text, vectors
from ticketloom.operators import projections
from ticketloom.plans.serve import short_replies

LANG_SQL = "SELECT *, lang AS detected_lang FROM documents"


@query(
    "filter_lang_queue",
    "P1",
    S.with_(S.TICKETS)
    + """SELECT id, queue, language FROM tickets
         WHERE language = 'en' AND queue IN ('Technical Support', 'Product Support')""",
)
def filter_lang_queue(spark, sf):
    found = projections.filter_lang_queue(S.tickets(spark, sf), "en", ["Technical Support", "Product Support"])
    return found.select("id", "queue", "language")


@query("filter_confirmed_lang", "P2", "SELECT doc_id, source FROM documents WHERE lang = 'en'")
def filter_confirmed_lang(spark, sf):
    d = S.table(spark, sf, "documents").select("doc_id", "source", F.col("lang").alias("detected_lang"))
    return projections.filter_confirmed_lang(d)


@query(
    "confirmed_lang_report",
    "P2",
    """SELECT count(*) AS total, count(*) FILTER (lang = 'en') AS kept,
       count(*) - count(*) FILTER (lang = 'en') AS removed FROM documents""",
)
def confirmed_lang_report(spark, sf):
    return projections.confirmed_lang_report(S.table(spark, sf, "documents"), col="lang")


@query(
    "not_null",
    "P3",
    S.with_(S.FEEDBACK) + "SELECT feedback_id, correct_urgency FROM feedback WHERE correct_urgency IS NOT NULL",
)
def not_null(spark, sf):
    return projections.not_null(S.feedback(spark, sf), "correct_urgency").select("feedback_id", "correct_urgency")


@query("since", "P4", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'")
def since(spark, sf):
    moment = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return projections.since(S.table(spark, sf, "events"), moment, "ts").select("event_id", "event_type")


@query(
    "last_days", "P4", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY"
)
def last_days(spark, sf):
    return projections.last_days(S.table(spark, sf, "events"), 7, S.NOW, "ts").select("event_id", "event_type")


@query("metadata_equals", "P5", "SELECT event_id, props FROM events WHERE json_extract_string(props, '$.k') = '42'")
def metadata_equals(spark, sf):
    return projections.metadata_equals(S.table(spark, sf, "events"), "k", "42", "props").select("event_id", "props")


@query(
    "map_urgency",
    "P6",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
       WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS urgency_level FROM orders""",
)
def map_urgency(spark, sf):
    name = F.lower(F.expr("substring(o_orderpriority, 3)"))
    priority = F.when(name == "urgent", "critical").otherwise(name)
    return S.table(spark, sf, "orders").select("o_orderkey", labels.map_urgency(priority).alias("urgency_level"))


@query("refine_queue", "P7", S.with_(S.ENRICHED) + "SELECT id, refined_queue FROM enriched")
def refine_queue(spark, sf):
    return S.enriched(spark, sf).select("id", "refined_queue")


@query(
    "merge_class",
    "P8",
    S.with_(S.ENRICHED)
    + """SELECT id, CASE WHEN refined_queue = 'Service Outages' THEN 'General Technical Support'
         ELSE refined_queue END AS refined_queue FROM enriched""",
)
def merge_class(spark, sf):
    merged = projections.merge_class(S.enriched(spark, sf), K.OUTAGE_QUEUE, K.GENERAL_QUEUE)
    return merged.select("id", "refined_queue")


@query(
    "merged_count",
    "P8",
    S.with_(S.ENRICHED) + "SELECT count(*) FILTER (refined_queue = 'Service Outages') AS changed FROM enriched",
)
def merged_count(spark, sf):
    return projections.merged_count(S.enriched(spark, sf), K.OUTAGE_QUEUE)


def fragment_sql(col: str, words: list[str]) -> str:
    return "CAST(" + " OR ".join(f"{col} ILIKE '%{w}%'" for w in words) + " AS INTEGER)"


FRAGMENT_FLAGS = ", ".join(f"{fragment_sql('input_text', w)} AS has_{t}" for t, w in S.TEST_FRAGMENTS.items())
DRIFT_TICKETS = f"""drift_tickets AS (
  SELECT id, input_text AS subject, input_text AS body_clean, predicted_queue AS refined_queue,
    predicted_urgency AS urgency_level, CAST(length(input_text) AS INTEGER) AS body_length,
    CAST(length(input_text) AS INTEGER) AS answer_length, 1e0 AS response_ratio, {FRAGMENT_FLAGS}, created_at
  FROM log)"""


@query(
    "project_log_as_tickets", "P9", S.with_(S.LOG, DRIFT_TICKETS) + "SELECT * EXCLUDE (created_at) FROM drift_tickets"
)
def project_log_as_tickets(spark, sf):
    return projections.log_as_drift_tickets(S.prediction_log(spark, sf), S.TEST_FRAGMENTS)


@query(
    "project_feedback_as_tickets",
    "P9",
    S.with_(S.LATEST)
    + """SELECT id, input_text AS body_clean, feedback_queue AS refined_queue, feedback_urgency AS urgency_level,
         CAST(length(input_text) AS INTEGER) AS body_length, 0 AS answer_length, 1e0 AS response_ratio,
         'en' AS language, '' AS queue FROM corrected WHERE feedback_queue IS NOT NULL""",
)
def project_feedback_as_tickets(spark, sf):
    from ticketloom.operators.feedback import apply_feedback

    log = apply_feedback(S.prediction_log(spark, sf), S.feedback(spark, sf))
    rows = projections.feedback_as_training_tickets(log)
    return rows.select(
        "id", "body_clean", "refined_queue", "urgency_level", "body_length", "answer_length", "response_ratio",
        "language", "queue",
    )


@query(
    "align_schema",
    "P10",
    S.with_(S.LOG)
    + """SELECT id, '' AS subject, 0 AS body_length, 0e0 AS response_ratio, language,
         '' AS refined_queue FROM log""",
)
def align_schema(spark, sf):
    target = S.enriched(spark, sf).select(
        "id", "subject", "body_length", "response_ratio", "language", "refined_queue"
    )
    return projections.align_schema(S.prediction_log(spark, sf), target.schema)


@query(
    "fill_missing",
    "P11",
    S.with_(S.FEEDBACK, S.RATED)
    + """SELECT feedback_id, coalesce(agent_correction, '') AS agent_correction, question FROM rated""",
)
def fill_missing(spark, sf):
    rated = S.rated_feedback(spark, sf).select("feedback_id", "agent_correction", "question")
    return projections.fill_missing(rated)


@query(
    "validate_labels",
    "P13",
    S.with_(S.FEEDBACK) + "SELECT feedback_id, correct_queue, correct_urgency, valid FROM checked",
)
def validate_labels(spark, sf):
    checked = projections.validate_labels(S.feedback(spark, sf))
    return checked.select("feedback_id", "correct_queue", "correct_urgency", "valid")


SPACES = r"[\s\x0b\x1c-\x1f\x{85}\pZ]+"
TRIM = "regexp_replace(regexp_replace({c}, '^%s', ''), '%s$', '')" % ((SPACES.replace("{", "{{").replace("}", "}}"),) * 2)


@query(
    "validate_text",
    "P14",
    f"""SELECT doc_id, length(text) <= 5000 AND length({TRIM.format(c='text')}) > 0 AS valid,
        CASE WHEN length(text) <= 5000 AND length({TRIM.format(c='text')}) > 0
             THEN {TRIM.format(c='text')} END AS query_text FROM documents""",
)
def validate_text(spark, sf):
    checked = projections.validate_text(S.table(spark, sf, "documents"), "text")
    return checked.select("doc_id", "valid", "query_text")


@query(
    "select_columns",
    "P15",
    S.with_(S.TICKETS) + "SELECT id, queue, substring(body, 1, 100) AS body, subject FROM tickets",
)
def select_columns(spark, sf):
    return projections.select_columns(S.tickets(spark, sf), ["id", "queue", "body", "subject"], {"body": 100})


@query(
    "clean_text",
    "T1",
    f"SELECT page_id, cleaned, CAST(length(cleaned) AS INTEGER) AS n FROM "
    f"(SELECT page_id, {S.clean_sql('html')} AS cleaned FROM pages)",
)
def clean_text(spark, sf):
    cleaned = S.table(spark, sf, "pages").select("page_id", text.clean_text(F.col("html")).alias("cleaned"))
    return cleaned.withColumn("n", F.length("cleaned"))


@query("text_length", "T2", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def text_length(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", text.text_length(F.col("text")).alias("n"))


@query("response_ratio", "T3", S.with_(S.ENRICHED) + "SELECT id, round(response_ratio, 9) AS ratio FROM enriched")
def response_ratio(spark, sf):
    t = S.tickets(spark, sf)
    answer, body = (F.length(text.clean_text(F.col(c))) for c in ("answer", "body"))
    return t.select("id", F.round(text.response_ratio(answer, body), 9).alias("ratio"))


@query(
    "left_n",
    "T4",
    "SELECT doc_id, " + ", ".join(f"substring(text, 1, {n}) AS t{n}" for n in (80, 500, 600, 800, 1000)) + " FROM documents",
)
def left_n(spark, sf):
    cuts = [text.left_n(F.col("text"), n).alias(f"t{n}") for n in (80, 500, 600, 800, 1000)]
    return S.table(spark, sf, "documents").select("doc_id", *cuts)


@query(
    "ellipsize",
    "T5",
    """SELECT doc_id, CASE WHEN length(text) > 500 THEN substring(text, 1, 500) || '...' ELSE text END AS shown
       FROM documents""",
)
def ellipsize(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", text.ellipsize(F.col("text"), 500).alias("shown"))


@query("combine_text", "T6", S.with_(S.TICKETS) + "SELECT id, coalesce(subject, '') || ' ' || coalesce(body, '') AS combined FROM tickets")
def combine_text(spark, sf):
    return S.tickets(spark, sf).select("id", text.combine_text(F.col("subject"), F.col("body")).alias("combined"))


@query("text_hash", "T7", "SELECT doc_id, sha256(text) AS text_hash FROM documents")
def text_hash(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", text.text_hash(F.col("text")).alias("text_hash"))


@query("lower_upper", "T8", "SELECT page_id, lower(url) AS low, upper(url) AS up FROM pages")
def lower_upper(spark, sf):
    return S.table(spark, sf, "pages").select(
        "page_id", text.lower(F.col("url")).alias("low"), text.upper(F.col("url")).alias("up")
    )


@query(
    "keyword_flags",
    "T9",
    "SELECT doc_id, " + ", ".join(f"{S.flag_sql('text', w)} AS has_{t}" for t, w in S.TEST_KEYWORDS.items()) + " FROM documents",
)
def keyword_flags(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", *labels.keyword_flags(F.col("text"), S.TEST_KEYWORDS))


@query(
    "keyword_flags_real",
    "T9",
    "SELECT doc_id, " + ", ".join(f"{S.flag_sql('text', w)} AS has_{t}" for t, w in K.KEYWORDS.items()) + " FROM documents",
)
def keyword_flags_real(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", *labels.keyword_flags(F.col("text")))


@query("substring_flags", "T10", S.with_(S.LOG) + f"SELECT id, {FRAGMENT_FLAGS} FROM log")
def substring_flags(spark, sf):
    log = S.prediction_log(spark, sf)
    return log.select("id", *labels.substring_flags(F.col("input_text"), S.TEST_FRAGMENTS))


@query(
    "to_json_metadata",
    "T11",
    S.with_(S.ENRICHED)
    + """SELECT id, '{"refined_queue":"' || refined_queue || '","urgency_level":"' || urgency_level
         || '","language":"' || language || '"}' AS metadata FROM enriched""",
)
def to_json_metadata(spark, sf):
    metadata = text.to_json_metadata(F.col("refined_queue"), F.col("urgency_level"), F.col("language"))
    return S.enriched(spark, sf).select("id", metadata.alias("metadata"))


@query("json_get", "T12", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_get(spark, sf):
    return S.table(spark, sf, "events").select("event_id", text.json_get(F.col("props"), "k").alias("k"))


@query(
    "vector_text",
    "T13",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total, true AS same FROM embeddings""",
)
def vector_text(spark, sf):
    e = S.table(spark, sf, "embeddings")
    back = e.withColumn("back", vectors.parse_vector(vectors.vector_text(F.col("embedding"))))
    total = F.aggregate("back", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return back.select(
        "vec_id", F.size("back").alias("n"), F.round(total, 6).alias("total"), (F.col("back") == F.col("embedding")).alias("same")
    )


@query(
    "serving_features",
    "T14",
    "SELECT doc_id, CAST(length(text) AS DOUBLE) AS f0, round(length(text) * 8e-1, 6) AS f1, 8e-1 AS f2, "
    + ", ".join(f"CAST({S.flag_sql('text', w)} AS DOUBLE) AS f{i + 3}" for i, w in enumerate(S.TEST_KEYWORDS.values()))
    + " FROM documents",
)
def serving_features(spark, sf):
    f = labels.serving_features(F.col("text"), S.TEST_KEYWORDS)
    numbers = S.table(spark, sf, "documents").select("doc_id", f.alias("f"))
    rounded = F.round(F.col("f")[1], 6).alias("f1")
    return numbers.select("doc_id", *[rounded if i == 1 else F.col("f")[i].alias(f"f{i}") for i in range(8)])


@query(
    "ts_format",
    "T15",
    """SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp, strftime(ts, '%Y-%m-%d %H:%M:%S') AS sql_text,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events""",
)
def ts_format(spark, sf):
    ts = F.col("ts")
    return S.table(spark, sf, "events").select(
        "event_id",
        text.ts_format(ts).alias("stamp"),
        text.ts_format(ts, K.SQL_TS_FORMAT).alias("sql_text"),
        text.ts_iso(ts).alias("iso"),
    )


@query("ts_parse", "T15", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def ts_parse(spark, sf):
    stamped = S.table(spark, sf, "events").select("event_id", text.ts_format(F.col("ts")).alias("stamp"))
    return stamped.select("event_id", text.ts_parse(F.col("stamp")).alias("parsed"))


@query("round_pct", "T16", "SELECT event_id, round(value * 1e2 / 491e0, 1) AS pct FROM events")
def round_pct(spark, sf):
    return S.table(spark, sf, "events").select("event_id", text.round_pct(F.col("value"), F.lit(491)).alias("pct"))


@query("sanitize_id", "T17", r"SELECT page_id, regexp_replace(url, '[^\pL\pN_-]', '_', 'g') AS safe FROM pages")
def sanitize_id(spark, sf):
    return S.table(spark, sf, "pages").select("page_id", text.sanitize_id(F.col("url")).alias("safe"))


PARAGRAPHS = r"""SELECT conv_id, turn, array_to_string(list_transform(list_filter(list_transform(
  string_split(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), chr(10) || chr(10)),
  lambda p: regexp_replace(regexp_replace(p, '^[\s\pZ]+', ''), '[\s\pZ]+$', '')), lambda p: p <> ''),
  lambda p: '<p>' || replace(p, chr(10), '<br>') || '</p>'), '') AS html FROM conversations"""


@query("normalize_newlines", "T18", PARAGRAPHS)
def normalize_newlines(spark, sf):
    html = text.normalize_newlines(F.col("text")).alias("html")
    return S.table(spark, sf, "conversations").select("conv_id", "turn", html)


def intent_sql(col: str) -> str:
    def any_of(name: str) -> str:
        return "(" + " OR ".join("contains(t, '" + w.replace("'", "''") + "')" for w in K.INTENT_WORDS[name]) + ")"

    short = f"({any_of('confirmation')} AND length(t) < 20)"
    tests = {n: any_of(n) for n in K.INTENT_WORDS} | {"confirmation": short}
    return "CASE " + " ".join(f"WHEN {test} THEN '{n}'" for n, test in tests.items()) + " END"


@query(
    "intent_of",
    "T19",
    f"SELECT conv_id, turn, {intent_sql('t')} AS intent FROM "
    f"(SELECT conv_id, turn, {TRIM.format(c='lower(text)')} AS t FROM conversations)",
)
def intent_of(spark, sf):
    return short_replies(S.table(spark, sf, "conversations"), "text").select("conv_id", "turn", "intent")


@query(
    "lang_guard",
    "T20",
    f"SELECT doc_id, CASE WHEN length({TRIM.format(c='text')}) < 20 THEN 'unknown' END AS guard FROM documents",
)
def lang_guard(spark, sf):
    return S.table(spark, sf, "documents").select("doc_id", text.lang_guard(F.col("text")).alias("guard"))


@query(
    "arg_max_label",
    "T21",
    "SELECT vec_id, 'place ' || (list_position(embedding, list_max(embedding)) - 1) AS best FROM embeddings",
)
def arg_max_label(spark, sf):
    best = vectors.arg_max_label(F.col("embedding"), [f"place {i}" for i in range(64)])
    return S.table(spark, sf, "embeddings").select("vec_id", best.alias("best"))


@query(
    "cast_types",
    "T22",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(value >= 30 AS INTEGER) AS large,
       CAST(NULL AS DOUBLE) AS kind FROM events""",
)
def cast_types(spark, sf):
    e = S.table(spark, sf, "events").select(
        "event_id",
        text.json_get(F.col("props"), "k").alias("k"),
        (F.col("value") >= 30).alias("large"),
        F.col("event_type").alias("kind"),
    )
    return labels.cast_types(e, {"k": "int", "large": "int", "kind": "double"})


@query(
    "default_if",
    "T23",
    S.with_(S.FEEDBACK) + "SELECT feedback_id, coalesce(correct_queue, 'other') AS correct_queue FROM feedback",
)
def default_if(spark, sf):
    filled = text.default_if(F.col("correct_queue"), "other").alias("correct_queue")
    return S.feedback(spark, sf).select("feedback_id", filled)



