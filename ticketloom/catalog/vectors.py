"""Queries over text vectors, models, documents and retrieval."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ticketloom.catalog import standins as S
from ticketloom.catalog.registry import query
from ticketloom.catalog.relational import SPLIT
from ticketloom.functions import text, vectors
from ticketloom.operators import (
    aggregates,
    documents,
    language,
    metrics,
    models,
    retrieval,
    sampling,
    textvec,
)
from ticketloom.plans.enrich import ingest, training_table
from ticketloom.session import cut_lineage, scratch_path
from ticketloom.sources.tables import spread

HASHED_BELOW_HALF = "CAST(('0x' || substring(sha256('42-' || doc_id), 1, 8)) AS BIGINT) / 4294967296e0 < 5e-1"
ENCODER = textvec.HashEncoder(64)


def _texts(spark, sf):
    return spread(S.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), "id")


# --- language, text vectors ---------------------------------------------------------------------


def _halves_by_language(spark, sf):
    """Texts the model is trained on, and the others with the language it finds."""
    d = spread(S.table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    parts = sampling.random_split(d, 0.5, 42, "doc_id")
    model = language.fit_language(sampling.split_part(parts, "train"))
    return language.detect_language(sampling.split_part(parts, "test"), model)


SHORT = r"length(regexp_replace(text, '^[\s\x0b\x1c-\x1f\x{85}\pZ]+|[\s\x0b\x1c-\x1f\x{85}\pZ]+$', '', 'g')) < 20"


@query(
    "detect_language",
    "M3",
    f"""SELECT lang, count(*) AS n, count(*) FILTER ({SHORT}) AS unknown, true AS agrees FROM documents
        WHERE {HASHED_BELOW_HALF} GROUP BY lang""",
)
def detect_language(spark, sf):
    """Texts that the model was not trained on: rows, texts too short to tell, and whether 95 % of the others agree."""
    found = _halves_by_language(spark, sf)
    told = F.when(F.col("detected_lang") != "unknown", (F.col("detected_lang") == F.col("lang")).cast("double"))
    return found.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("detected_lang") == "unknown").alias("unknown"),
        (F.coalesce(F.avg(told), F.lit(1.0)) >= 0.95).alias("agrees"),
    )


@query(
    "ingest_tickets",
    "P2 M3",
    f"""SELECT lang, count(*) AS n, true AS as_expected FROM documents WHERE {HASHED_BELOW_HALF} AND NOT ({SHORT}) GROUP BY lang""",
)
def ingest_tickets(spark, sf):
    """The language filter at the head of the chain: English tickets pass, those of other languages do not."""
    d = spread(S.table(spark, sf, "documents"), "doc_id")
    parts = sampling.random_split(d, 0.5, 42, "doc_id")
    model = language.fit_language(sampling.split_part(parts, "train"))
    tickets = S.tickets_from_documents(sampling.split_part(parts, "test")).where(text.lang_guard(F.col("body")).isNull())
    passed = ingest(tickets, model).select("id", F.lit(1.0).alias("passed"))
    share = F.avg(F.coalesce("passed", F.lit(0.0)))
    told = tickets.join(passed, "id", "left").groupBy(F.col("language").alias("lang")).agg(F.count("*").alias("n"), share.alias("share"))
    expected = F.when(F.col("lang") == "en", F.col("share") >= 0.95).otherwise(F.col("share") <= 0.05)
    return told.select("lang", "n", expected.alias("as_expected"))


TERMS = r"""words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\pL\pN_]{2,}') AS w FROM documents),
terms AS (SELECT doc_id, unnest(w) AS term FROM words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
stats AS (SELECT term, count(*) AS count, count(DISTINCT doc_id) AS doc_count FROM terms GROUP BY term)"""


@query("term_statistics", "M4", S.with_(TERMS) + "SELECT * FROM stats")
def term_statistics(spark, sf):
    return textvec.term_statistics(textvec.with_terms(_texts(spark, sf)))


@query(
    "tfidf_vocabulary",
    "M4",
    S.with_(TERMS)
    + """SELECT term, count, doc_count, round(ln((1e0 + (SELECT count(*) FROM documents)) / (1e0 + doc_count)) + 1, 6)
         AS idf FROM stats ORDER BY count DESC, term LIMIT 5000""",
)
def tfidf_vocabulary(spark, sf):
    found = textvec.vocabulary(textvec.with_terms(_texts(spark, sf)))
    return found.withColumn("idf", F.round("idf", 6))


@query(
    "tfidf_features",
    "M4",
    S.with_(TERMS)
    + """, top AS (SELECT term, ln((1e0 + (SELECT count(*) FROM documents)) / (1e0 + doc_count)) + 1 AS idf FROM stats
           ORDER BY count DESC, term LIMIT 5000),
         weighted AS (SELECT doc_id, term, count(*) * any_value(idf) AS w FROM terms JOIN top USING (term)
           GROUP BY doc_id, term)
         SELECT d.doc_id AS id, count(w.term) AS n_terms,
           coalesce(round(sum(w) / sqrt(sum(w * w)), 5), 0e0) AS total
         FROM documents d LEFT JOIN weighted w USING (doc_id) GROUP BY d.doc_id""",
)
def tfidf_features(spark, sf):
    """Fitted and applied on all documents; of each vector the number of terms and the sum."""
    texts = _texts(spark, sf)
    found = textvec.tfidf_features(texts, texts).withColumn("v", vector_to_array("tfidf"))
    n = F.size(F.filter("v", lambda x: x != 0)).cast("bigint")
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    return found.select("id", n.alias("n_terms"), F.round(total, 5).alias("total"))


@query(
    "tfidf_terms",
    "M4",
    S.with_(TERMS)
    + """, top AS (SELECT term, ln((1e0 + (SELECT count(*) FROM documents)) / (1e0 + doc_count)) + 1 AS idf FROM stats
           ORDER BY count DESC, term LIMIT 5000),
         weighted AS (SELECT doc_id, term, count(*) * any_value(idf) AS w FROM terms JOIN top USING (term)
           GROUP BY doc_id, term),
         scaled AS (SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 5) AS weight FROM weighted)
         SELECT term, count(*) AS n_docs, max(weight) AS largest, arg_max(doc_id, weight * 1e6 - doc_id * 1e-9) AS doc_id
         FROM scaled GROUP BY term""",
)
def tfidf_terms(spark, sf):
    """Of every term of the vocabulary the documents with it, its largest weight, and the document that has it."""
    texts = _texts(spark, sf)
    model = textvec.fit_tfidf(texts)
    weights = vector_to_array(F.col("tfidf"))
    placed = model.transform(texts).select("id", F.posexplode(weights).alias("place", "w")).where("w <> 0")
    terms = spark.createDataFrame(list(enumerate(model.terms)), "place int, term string")
    scaled = placed.join(F.broadcast(terms), "place").select("term", "id", F.round("w", 5).alias("weight"))
    best = F.max_by("id", F.col("weight") * 1e6 - F.col("id") * 1e-9)
    return scaled.groupBy("term").agg(F.count("*").alias("n_docs"), F.max("weight").alias("largest"), best.alias("doc_id"))


@query("embed_texts", "M5")
def embed_texts(spark, sf):
    """One unit vector per document: its width and length."""
    found = textvec.embed_texts(_texts(spark, sf), textvec.HashEncoder())
    length = F.round(vectors.norm(F.col("embedding")), 4)
    return found.select("id", F.size("embedding").alias("width"), length.alias("length"))


@query(
    "embed_texts_in_batches",
    "M5 F4",
    """SELECT doc_id AS id, CAST(length(text) AS DOUBLE) AS n_chars,
       CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS n_e FROM documents""",
)
def embed_texts_in_batches(spark, sf):
    """A user's encoder, loaded once per task and called with batches of 64 texts."""

    def load():
        return lambda texts: np.array([[len(t), t.count("e")] for t in texts], dtype="float32")

    found = textvec.embed_texts(_texts(spark, sf), textvec.BatchEncoder(load, "letters"))
    v = F.col("embedding")
    return found.select("id", v[0].cast("double").alias("n_chars"), v[1].cast("double").alias("n_e"))


@query(
    "incremental_embeddings",
    "M6",
    S.with_(S.CACHE)
    + """SELECT d.doc_id AS id, sha256(d.text) AS text_hash, c.text_hash IS NOT NULL AS from_cache, true AS has_vector
         FROM documents d LEFT JOIN (SELECT * FROM cache WHERE model_name = 'hashed-ngrams') c
         ON c.text_hash = sha256(d.text)""",
)
def incremental_embeddings(spark, sf):
    rows, _ = textvec.incremental_embeddings(_texts(spark, sf), S.embedding_cache(spark, sf), ENCODER, S.NOW)
    return rows.select("id", "text_hash", "from_cache", F.col("embedding").isNotNull().alias("has_vector"))


@query(
    "embedding_cache_additions",
    "M6",
    S.with_(S.CACHE)
    + """SELECT DISTINCT sha256(text) AS text_hash, 'hashed-ngrams' AS model_name, substring(text, 1, 1000) AS text_content
         FROM documents WHERE sha256(text) NOT IN (SELECT text_hash FROM cache WHERE model_name = 'hashed-ngrams')""",
)
def embedding_cache_additions(spark, sf):
    _, added = textvec.incremental_embeddings(_texts(spark, sf), S.embedding_cache(spark, sf), ENCODER, S.NOW)
    return added.select("text_hash", "model_name", "text_content")


def _features(spark, sf):
    """Feature vectors of all tickets, stored once for the steps that follow."""
    table = textvec.embed_texts(training_table(S.enriched(spark, sf)), ENCODER)
    assembled = textvec.assemble(table, "embedding")
    return cut_lineage(assembled.select("id", "queue", "refined_queue", "urgency_level", "features"))


@query(
    "assemble",
    "M7",
    S.with_(S.ENRICHED)
    + """SELECT id, 72 AS width, CAST(body_length AS DOUBLE) AS body_length, CAST(has_software AS DOUBLE) AS has_software
         FROM enriched""",
)
def assemble(spark, sf):
    table = textvec.embed_texts(training_table(S.enriched(spark, sf)), ENCODER)
    v = vector_to_array("features")
    return textvec.assemble(table, "embedding").select(
        "id", F.size(v).alias("width"), v[64].alias("body_length"), v[71].alias("has_software")
    )


# --- models -------------------------------------------------------------------------------------


@query("train_and_evaluate", "M8 M9")
def train_and_evaluate(spark, sf):
    """Both classifiers on a 72/13/15 split, and their reports on the test part."""
    rows = _features(spark, sf)
    split = cut_lineage(sampling.stratified_split(rows, ["queue", "urgency_level"], 0.15, 0.15))
    train, test = sampling.split_part(split, "train"), sampling.split_part(split, "test")
    reports = []
    for target, balanced in (("refined_queue", False), ("urgency_level", True)):
        model = models.train_classifier(train, target, "forest", balanced, max_depth=6, n_estimators=20)
        reports.append(models.evaluate(model, test, target).withColumn("target", F.lit(target)))
    return reports[0].unionByName(reports[1])


@query("train_on_tfidf", "M8")
def train_on_tfidf(spark, sf):
    """Queue classifier on TF-IDF and numeric features; overall scores on the test part."""
    table = training_table(S.enriched(spark, sf))
    split = sampling.stratified_split(table, ["queue", "urgency_level"], 0.15, 0.15)
    model = textvec.fit_tfidf(sampling.split_part(split, "train"))
    rows = textvec.assemble(model.transform(split), "tfidf").select("id", "refined_queue", "split", "features")
    rows = cut_lineage(rows)
    fitted = models.train_classifier(sampling.split_part(rows, "train"), "refined_queue", "logistic", max_iter=20)
    report = models.evaluate(fitted, sampling.split_part(rows, "test"), "refined_queue")
    return report.where(F.col("class").isin("accuracy", "macro avg", "weighted avg"))


@query("cross_validate", "M10")
def cross_validate(spark, sf):
    rows = _features(spark, sf)
    score = models.cross_validate(rows, "urgency_level", 3, "forest", max_depth=4, n_estimators=10)
    return rows.agg(F.count("*").alias("n_rows"), F.lit(round(score, 4)).alias("mean_f1"))


@query("random_search", "M11 A12")
def random_search(spark, sf):
    """Three parameter sets by 3-fold cross-validation, best first."""
    runs = models.random_search(_features(spark, sf), "refined_queue", 3, kind="forest")
    best = aggregates.best_run(runs, "score", ["params"]).select("run_id").withColumn("best", F.lit(True))
    return runs.join(best, "run_id", "left").select(
        "run_id", F.round("score", 4).alias("score"), F.coalesce("best", F.lit(False)).alias("best")
    )


@query("predict_batch", "M12")
def predict_batch(spark, sf):
    """Queue and urgency with confidence for every ticket."""
    rows = _features(spark, sf)
    fitted = {
        target: models.train_classifier(rows, target, "forest", max_depth=5, n_estimators=10)
        for target in ("refined_queue", "urgency_level")
    }
    return models.predict_batch(rows, fitted).drop("features")


@query("save_load_model", "M13", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS differing FROM documents")
def save_load_model(spark, sf):
    """A stored and reloaded model must predict as before: rows and disagreements."""
    rows = _features(spark, sf)
    model = models.train_classifier(rows, "urgency_level", "forest", max_depth=4, n_estimators=5)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    again = models.predict(models.load_model(spark, path), rows, "urgency_level")
    before = models.predict(model, rows, "urgency_level").select("id", F.col("predicted_urgency_level").alias("first"))
    differs = F.count_if(F.col("first") != F.col("predicted_urgency_level"))
    return before.join(again, "id").agg(F.count("*").alias("n_rows"), differs.alias("differing"))


def _checked(rows, predicted, target):
    """Per row: whether the class is one of the training classes, and the confidence a probability."""
    classes = rows.select(F.col(target).alias(f"predicted_{target}")).distinct().withColumn("__known", F.lit(True))
    confidence = F.col(f"confidence_{target}")
    return predicted.join(F.broadcast(classes), f"predicted_{target}", "left").select(
        "id", F.coalesce("__known", F.lit(False)).alias("known_class"), ((confidence > 0) & (confidence <= 1)).alias("probable")
    )


PROBABLE = "SELECT id, true AS known_class, true AS probable FROM enriched"


@query("predict_batch_checked", "M12", S.with_(S.ENRICHED) + PROBABLE)
def predict_batch_checked(spark, sf):
    """A forest's predictions over all tickets: known classes with probabilities."""
    rows = _features(spark, sf)
    model = models.train_classifier(rows, "refined_queue", "forest", max_depth=5, n_estimators=10)
    return _checked(rows, models.predict_batch(rows, {"refined_queue": model}), "refined_queue")


@query("predict_boosted", "M8 M12", S.with_(S.ENRICHED) + PROBABLE.replace("FROM", ", 1e0 AS total FROM"))
def predict_boosted(spark, sf):
    """Boosted trees on balanced urgency classes: known classes, and probabilities that add up to one."""
    rows = _features(spark, sf)
    model = models.train_classifier(rows, "urgency_level", "boosted", True, max_depth=3, n_estimators=5)
    summed = models.class_probabilities(model, rows.select("id", "features"), "p").select(
        "id", F.round(F.aggregate("p", F.lit(0.0), lambda s, x: s + x), 6).alias("total")
    )
    predicted = models.predict(model, rows, "urgency_level")
    return _checked(rows, predicted, "urgency_level").join(summed, "id")


@query(
    "evaluate_supports",
    "M8 M9",
    S.with_(S.ENRICHED, SPLIT.format(keys="queue, urgency_level", table="enriched", test="15e-2", val="15e-2"))
    + """SELECT refined_queue AS class, count(*) AS support, true AS measured FROM split WHERE split = 'test' GROUP BY 1""",
)
def evaluate_supports(spark, sf):
    """The report of a trained model on the test part: its classes, their supports, scores within [0, 1]."""
    rows = _features(spark, sf)
    split = cut_lineage(sampling.stratified_split(rows, ["queue", "urgency_level"], 0.15, 0.15))
    model = models.train_classifier(
        sampling.split_part(split, "train"), "refined_queue", "forest", max_depth=5, n_estimators=10
    )
    report = models.evaluate(model, sampling.split_part(split, "test"), "refined_queue")
    classes = report.where(~F.col("class").isin("accuracy", "macro avg", "weighted avg") & (F.col("support") > 0))
    return classes.select("class", F.col("support").cast("bigint").alias("support"), F.col("f1").between(0, 1).alias("measured"))


FLOORS = [("refined_queue", "forest"), ("refined_queue", "boosted"), ("refined_queue", "logistic"), ("urgency_level", "boosted")]


@query(
    "model_floors",
    "M8 M9 M12",
    S.with_(S.ENRICHED, SPLIT.format(keys="queue, urgency_level", table="enriched", test="15e-2", val="15e-2"))
    + f"""SELECT target, kind, (SELECT count(*) FROM split WHERE split = 'test') AS n_test, true AS beats_majority,
            true AS classes_differ FROM (VALUES {", ".join(str(x) for x in FLOORS)}) AS f(target, kind)""",
)
def model_floors(spark, sf):
    """Each kind of model against the answer "largest class", by weighted F1 on the test part."""
    split = cut_lineage(sampling.stratified_split(_features(spark, sf), ["queue", "urgency_level"], 0.15, 0.15))
    train, test = sampling.split_part(split, "train"), sampling.split_part(split, "test")
    parts = []
    for target, kind in FLOORS:
        model = models.train_classifier(train, target, kind, max_depth=4, n_estimators=8, learning_rate=0.3)
        scored = cut_lineage(models.predict(model, test, target).select(target, f"predicted_{target}"))
        f1 = metrics.f1_weighted(scored, target, f"predicted_{target}").scalar()
        share = scored.groupBy(target).agg(F.count("*").alias("n")).agg((F.max("n") / F.sum("n")).alias("share")).scalar()
        row = scored.agg(F.count("*").alias("n_test"), F.count_distinct(f"predicted_{target}").alias("classes"))
        parts.append(row.select(
            F.lit(target).alias("target"), F.lit(kind).alias("kind"), "n_test",
            (f1 > share * 2 * share / (share + 1)).alias("beats_majority"), (F.col("classes") > 1).alias("classes_differ"),
        ))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "search_folds",
    "M10 M11",
    """WITH f AS (SELECT CAST(floor(CAST(('0x' || substring(sha256('fold-42-' || doc_id), 1, 8)) AS BIGINT) / 4294967296e0 * 2)
         AS INTEGER) AS fold, count(*) AS n_rows FROM documents GROUP BY 1)
       SELECT run_id, fold, n_rows, (SELECT count(*) FROM documents) - n_rows AS n_train, true AS measured
       FROM f, (VALUES ('run-000'), ('run-001')) AS r(run_id)""",
)
def search_folds(spark, sf):
    """Two parameter sets by 2-fold cross-validation: of each fit the rows it was validated and trained on."""
    sets = [{"max_depth": 3, "n_estimators": 5}, {"max_depth": 4, "n_estimators": 5}]
    runs = models.random_search(_features(spark, sf), "urgency_level", sets, 2, "forest")
    return runs.select("run_id", F.inline("parts")).select(
        "run_id", F.col("part").alias("fold"), F.col("n_valid").alias("n_rows"), "n_train", F.col("score").between(0, 1).alias("measured")
    )


@query(
    "search_holdout",
    "M11",
    S.with_(S.ENRICHED)
    + """, f AS (SELECT urgency_level, CAST(('0x' || substring(sha256('fold-42-' || id), 1, 8)) AS BIGINT) / 4294967296e0 < 2e-1
           AS held FROM enriched WHERE urgency_level IS NOT NULL)
         SELECT run_id, count(*) FILTER (held) AS n_valid, count(*) FILTER (NOT held) AS n_train, true AS beats_majority
         FROM f, (VALUES ('run-000'), ('run-001')) AS r(run_id) GROUP BY run_id""",
)
def search_holdout(spark, sf):
    """Boosted trees for the urgency on held-out rows, classes weighted: is it better than the largest class alone?"""
    rows = _features(spark, sf)
    sets = [{"max_depth": 3, "n_estimators": 6, "learning_rate": 0.3}, {"max_depth": 4, "n_estimators": 6, "learning_rate": 0.3}]
    runs = models.random_search(rows, "urgency_level", sets, balanced=True, validation=models.HOLDOUT)
    held = models.validation_parts(rows, "urgency_level", models.HOLDOUT).where("part = 0")
    shares = held.groupBy("urgency_level").agg(F.count("*").alias("count"))
    # weighted F1 of the answer "largest class" for every row
    share = shares.agg((F.max("count") / F.sum("count")).alias("share")).scalar()
    floor = share * 2 * share / (share + 1)
    return runs.select("run_id", F.inline("parts")).select("run_id", "n_valid", "n_train", (F.col("score") > floor).alias("beats_majority"))


@query(
    "language_agreement",
    "M3",
    f"""SELECT lang, count(*) AS n, true AS agrees FROM documents
        WHERE {HASHED_BELOW_HALF} GROUP BY lang""",
)
def language_agreement(spark, sf):
    """Rows per language, and whether nine in ten texts are recognised; those too short to tell count as recognised."""
    found = _halves_by_language(spark, sf)
    right = F.col("detected_lang").isin("unknown") | (F.col("detected_lang") == F.col("lang"))
    return found.groupBy("lang").agg(F.count("*").alias("n"), (F.avg(right.cast("double")) >= 0.9).alias("agrees"))


# --- documents ----------------------------------------------------------------------------------

CONTENT = (
    r"regexp_replace(regexp_replace('Problème :' || chr(10) || subject || chr(10) || substring(body_clean, 1, 1000) "
    r"|| chr(10) || chr(10) || 'Réponse agent typique :' || chr(10) || substring(answer_clean, 1, 800), "
    r"'^[\s\x0b\x1c-\x1f\x{85}\pZ]+', ''), '[\s\x0b\x1c-\x1f\x{85}\pZ]+$', '')"
)


@query(
    "build_rag_docs",
    "R1",
    S.with_(S.ENRICHED)
    + f"""SELECT 'ticket_' || id AS id, refined_queue || ' - ' || substring(subject, 1, 80) AS title,
          {CONTENT} AS content, refined_queue, urgency_level, language FROM enriched""",
)
def build_rag_docs(spark, sf):
    docs = documents.build_rag_docs(S.enriched(spark, sf))
    return docs.select("id", "title", "content", "metadata.*")


@query(
    "index_train_only",
    "R2",
    S.with_(S.ENRICHED)
    + """SELECT id, refined_queue FROM enriched QUALIFY row_number() OVER (PARTITION BY queue, urgency_level
         ORDER BY sha256('42-' || id), id) > round(count(*) OVER (PARTITION BY queue, urgency_level) * 3e-1)""",
)
def index_train_only(spark, sf):
    return documents.index_train_only(S.enriched(spark, sf)).select("id", "refined_queue")


# --- retrieval ----------------------------------------------------------------------------------

HIT = "round(distance, 6) + 0e0 AS distance, round(1 - distance / 2, 6) AS similarity"
RANKED = """ranked AS (
  SELECT qid, doc_id, distance, q_label, d_label,
    row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), doc_id) AS rank FROM pairs)"""


def _rounded(hits):
    return hits.withColumns({"distance": F.round("distance", 6), "similarity": F.round("similarity", 6)})


# the first vector of each class, then one pass
COSINE_TO_FIRST = """SELECT w.vec_id AS doc_id, round(1 - list_dot_product(w.v, c.v) / (w.nrm * c.nrm), 6) + 0e0 AS distance
  FROM vecs w JOIN (SELECT label, arg_min(v, vec_id) AS v, arg_min(nrm, vec_id) AS nrm FROM vecs GROUP BY label) c
    ON w.label = c.label"""


@query(
    "cosine_distance",
    "R3",
    S.with_(S.VECS)
    + COSINE_TO_FIRST,
)
def cosine_distance(spark, sf):
    """Distance of every vector to the first vector of its class."""
    docs = S.vector_docs(spark, sf)
    first = docs.groupBy("queue").agg(F.min_by("embedding", "doc_id").alias("centre"))
    distance = vectors.cosine_distance(F.col("embedding"), F.col("centre"))
    return docs.join(first, "queue").select("doc_id", F.round(distance, 6).alias("distance"))


@query(
    "similarity_score",
    "R8",
    "SELECT event_id, round(1 - value / 5e2 / 2, 9) AS similarity FROM events",
)
def similarity_score(spark, sf):
    score = vectors.similarity_score(F.col("value") / 500.0)
    return S.table(spark, sf, "events").select("event_id", F.round(score, 9).alias("similarity"))


@query("retrieve", "R4 W3", S.with_(S.VECTORS, RANKED) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM ranked WHERE rank <= 5")
def retrieve(spark, sf):
    return _rounded(retrieval.retrieve(S.vector_queries(spark, sf), S.vector_docs(spark, sf)))


@query(
    "retrieve_by_grid",
    "R4 W3",
    S.with_(S.VECTORS, RANKED) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM ranked WHERE rank <= 5",
)
def retrieve_by_grid(spark, sf):
    """The same search by the plan for query tables too large to broadcast."""
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)
    return _rounded(retrieval.retrieve(q, d, max_broadcast=0, query_block=200, doc_block=300))


SAME_QUEUE = RANKED.replace("FROM pairs)", "FROM pairs WHERE q_label = d_label)")


@query(
    "retrieve_filtered",
    "R5",
    S.with_(S.VECTORS, SAME_QUEUE) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM ranked WHERE rank <= 5",
)
def retrieve_filtered(spark, sf):
    return _rounded(retrieval.retrieve_filtered(S.vector_queries(spark, sf), S.vector_docs(spark, sf), "queue"))


@query(
    "retrieve_filtered_by_grid",
    "R5",
    S.with_(S.VECTORS, SAME_QUEUE) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM ranked WHERE rank <= 5",
)
def retrieve_filtered_by_grid(spark, sf):
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)
    hits = retrieval.retrieve_filtered(q, d, "queue", max_broadcast=0, query_block=30, doc_block=25)
    return _rounded(hits)


@query(
    "threshold",
    "R6",
    S.with_(S.VECTORS, RANKED)
    + f""", near AS (SELECT qid, doc_id, distance, row_number() OVER (PARTITION BY qid ORDER BY rank) AS rank
            FROM ranked WHERE rank <= 10 AND distance <= 0.7e0)
          SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM near WHERE rank <= 5""",
)
def threshold(spark, sf):
    hits = retrieval.retrieve(S.vector_queries(spark, sf), S.vector_docs(spark, sf))
    return _rounded(retrieval.threshold(hits, 0.65))


FALLBACK = (
    S.VECTORS.replace("a.label AS q_label", "(a.label + 5) % 10 AS q_label")
    + """,
queue_ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), doc_id) AS r
  FROM pairs WHERE q_label = d_label),
near AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY r) AS pos FROM queue_ranked
  WHERE r <= 10 AND distance <= 0.7e0),
kept AS (SELECT * FROM near WHERE pos <= 5),
short AS (SELECT vec_id AS qid FROM embeddings WHERE vec_id NOT IN
  (SELECT qid FROM kept GROUP BY qid HAVING count(*) >= 2)),
global_ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), doc_id) AS r
  FROM pairs WHERE qid IN (SELECT qid FROM short)),
fill AS (SELECT g.* FROM global_ranked g LEFT JOIN kept k ON k.qid = g.qid AND k.doc_id = g.doc_id
  WHERE g.r <= 5 AND g.distance <= 0.7e0 AND k.qid IS NULL),
merged AS (SELECT qid, doc_id, distance, r, 1 AS s, 'queue' AS stage FROM kept
  UNION ALL SELECT qid, doc_id, distance, r, 2, 'global' FROM fill),
final AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s, r) AS rank FROM merged)"""
)


def _fallback(spark, sf):
    q, d = S.vector_queries(spark, sf, 5), S.vector_docs(spark, sf)
    return retrieval.retrieve_with_fallback(q, d, "queue", 5, 0.65)


@query(
    "retrieve_with_fallback",
    "R7 U2",
    S.with_(FALLBACK) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT}, stage FROM final WHERE rank <= 5",
)
def retrieve_with_fallback(spark, sf):
    """Queries carry a wrong class, so that many have to be filled up from all documents."""
    return _rounded(_fallback(spark, sf))


@query(
    "merge_distinct",
    "U2",
    S.with_(S.VECTORS, RANKED, SAME_QUEUE.replace("ranked AS", "same AS"))
    + """, first AS (SELECT qid, doc_id, rank FROM same WHERE rank <= 3)
         SELECT qid, CAST(doc_id AS VARCHAR) AS content, 'same' AS stage FROM first
         UNION ALL SELECT r.qid, CAST(r.doc_id AS VARCHAR), 'all' FROM ranked r
           LEFT JOIN first f ON f.qid = r.qid AND f.doc_id = r.doc_id WHERE r.rank <= 5 AND f.qid IS NULL""",
)
def merge_distinct(spark, sf):
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)

    def hits(rows, stage):
        content = F.col("doc_id").cast("string")
        return rows.withColumns({"content": content, "stage": F.lit(stage)})

    first = hits(retrieval.retrieve(q, d, 3, "queue"), "same")
    merged = retrieval.merge_distinct(first, hits(retrieval.retrieve(q, d, 5), "all"))
    return merged.select("qid", "content", "stage")


@query(
    "query_doc_pairs",
    "J6",
    S.with_(S.VECTORS) + "SELECT qid, doc_id, round(distance, 6) + 0e0 AS distance FROM pairs WHERE distance <= 0.6e0",
)
def query_doc_pairs(spark, sf):
    pairs = retrieval.query_doc_pairs(S.vector_queries(spark, sf), S.vector_docs(spark, sf), 0.6)
    return pairs.withColumn("distance", F.round("distance", 6))


@query(
    "query_doc_pairs_by_grid",
    "J6",
    S.with_(S.VECTORS)
    + """SELECT qid, doc_id, round(distance, 6) + 0e0 AS distance FROM pairs
         WHERE distance <= 0.8e0 AND q_label = d_label""",
)
def query_doc_pairs_by_grid(spark, sf):
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)
    pairs = retrieval.query_doc_pairs(q, d, 0.8, "queue", max_broadcast=0, block=20)
    return pairs.withColumn("distance", F.round("distance", 6))


@query(
    "context_of",
    "R10",
    S.with_(FALLBACK)
    + """SELECT e.vec_id AS qid, coalesce(string_agg('document ' || doc_id, chr(10) || chr(10) ORDER BY rank),
           '[AUCUN DOCUMENT PERTINENT TROUVE DANS LA BASE DE CONNAISSANCES]') AS context
         FROM embeddings e LEFT JOIN (SELECT * FROM final WHERE rank <= 5) f ON f.qid = e.vec_id GROUP BY e.vec_id""",
)
def context_of(spark, sf):
    hits = _fallback(spark, sf).withColumn("content", F.concat(F.lit("document "), F.col("doc_id").cast("string")))
    return retrieval.context_of(hits, S.vector_queries(spark, sf))


@query(
    "top_sources",
    "L7",
    S.with_(S.VECTORS, RANKED)
    + """SELECT qid, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS sources FROM ranked
         WHERE rank <= 3 GROUP BY qid""",
)
def top_sources(spark, sf):
    hits = retrieval.retrieve(S.vector_queries(spark, sf), S.vector_docs(spark, sf))
    listed = F.sort_array(F.collect_list(F.struct("rank", F.col("doc_id").cast("string").alias("id"))))
    all_sources = hits.groupBy("qid").agg(F.transform(listed, lambda h: h["id"]).alias("sources"))
    return all_sources.select("qid", F.array_join(sampling.top_sources(F.col("sources")), ",").alias("sources"))


@query(
    "ann_retrieve",
    "R9",
    "SELECT count(DISTINCT vec_id) AS queries, true AS recall_reached FROM embeddings",
)
def ann_retrieve(spark, sf):
    """Approximate search with default parameters: does it find nine tenths of the exact hits?"""
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)
    near = cut_lineage(retrieval.ann_retrieve(q, retrieval.ann_index(d)))
    recall = retrieval.recall_at_k(near, retrieval.retrieve(q, d)).scalar()
    return near.agg(F.countDistinct("qid").alias("queries")).withColumn("recall_reached", recall >= 0.9)


@query(
    "ann_retrieve_bounded",
    "R9",
    S.with_(S.VECTORS, RANKED) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM ranked WHERE rank <= 5",
)
def ann_retrieve_bounded(spark, sf):
    """The index, searched list by list until the bounds rule out a nearer hit: the exact result."""
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)
    return _rounded(retrieval.retrieve_bounded(q, retrieval.ann_index(d)))


@query(
    "ann_retrieve_all_lists",
    "R9",
    S.with_(S.VECTORS, RANKED) + f"SELECT qid, CAST(rank AS INTEGER) AS rank, doc_id, {HIT} FROM ranked WHERE rank <= 5",
)
def ann_retrieve_all_lists(spark, sf):
    """Probing every list must give the exact result."""
    q, d = S.vector_queries(spark, sf), S.vector_docs(spark, sf)
    return _rounded(retrieval.ann_retrieve(q, retrieval.ann_index(d, lists=8), nprobe=8))


