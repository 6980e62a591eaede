"""Tables, feedback, conversations, models, streams and whole chains."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom import schemas
from ticketloom.catalog import standins as S
from ticketloom.operators import aggregates, dialog, feedback, metrics, models, projections, textvec
from ticketloom.plans import enrich, monitor, serve
from ticketloom.sources import records, snapshots, tables
from ticketloom.streaming import jobs


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- tables -------------------------------------------------------------------------------------


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snap")
    snapshots.write_snapshot(spark.range(3), root, "20240102_000000")
    snapshots.write_snapshot(spark.range(5), root, "20231231_235959")
    assert snapshots.read_latest_snapshot(spark, root).count() == 3
    assert str(snapshots.latest_snapshot(spark, root).first().snapshot_at) == "2024-01-02 00:00:00"
    with pytest.raises(AnalysisException):
        snapshots.write_snapshot(spark.range(1), root, "20240102_000000")
    assert all("snapshot=20240102_000000" in f for f in snapshots.read_latest_snapshot(spark, root).inputFiles())
    assert snapshots.latest_snapshot(spark, str(tmp_path / "none")).count() == 0


def test_append_log(spark, tmp_path):
    path = str(tmp_path / "log")
    df = spark.range(20, numPartitions=4).select(F.lit(None).cast("bigint").alias("id"), F.concat(F.lit("t"), "id").alias("t"))
    first, second = tables.append_log(df, path, "a"), tables.append_log(df, path, "b")
    assert first.agg(F.min("id")).first()[0] > 0
    ids = [r.id for r in first.unionByName(second).collect()]
    assert len(set(ids)) == 40 and min(ids) > 0
    assert spark.read.parquet(path).select("id").distinct().count() == 40
    with pytest.raises(AnalysisException):
        tables.append_log(df, path, "a")


def test_append_ignore_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "old")], "k int, v string").write.parquet(path)
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    for _ in range(2):
        assert rows(tables.append_ignore(new, path, ["k"], ["v"])) == [(1, "old"), (2, "a")]


def test_run_record_and_best_run(spark, tmp_path):
    record = spark.createDataFrame([("r1", "d", (0.9, 0.8), {"a": "1"}, "success", "x")], schemas.RUN_RECORD)
    records.write_run_record(record, str(tmp_path / "runs"))
    stored = records.read_run_record(spark, str(tmp_path / "runs")).first()
    assert stored.metrics.f1_queue == 0.9 and stored.params == {"a": "1"}
    (tmp_path / "one.json").write_text('{\n  "run_id": "r2",\n  "metrics": {"f1_queue": 0.5}\n}')
    assert records.read_run_record(spark, str(tmp_path / "one.json")).first().metrics.f1_queue == 0.5
    runs = spark.createDataFrame([("a", 0.5, 3), ("b", float("nan"), 4), ("c", 0.7, 5)], "run_id string, score double, depth int")
    assert aggregates.best_run(runs, "score", ["depth"]).first().depth == 5
    assert aggregates.best_run(runs.where("false"), "score", ["depth"], {"depth": 6}).first().depth == 6


def test_jdbc_options():
    options = tables.jdbc_options("jdbc:x", "t", "id", (0, 100), 4)
    assert options["batchsize"] == "1000" and options["numPartitions"] == "4" and options["upperBound"] == "100"


# --- feedback and labels ------------------------------------------------------------------------

FEEDBACK = "feedback_id int, prediction_id bigint, correct_queue string, correct_urgency string, feedback_at timestamp_ntz"


@pytest.fixture
def log(spark):
    texts = spark.createDataFrame([(1, "vpn is down"), (2, "slow laptop"), (3, "hello")], "id bigint, input_text string")
    return projections.align_schema(texts, spark.createDataFrame([], schemas.PREDICTION_LOG).schema).withColumns(
        {"feedback_queue": F.lit("software"), "feedback_urgency": F.lit("low")}
    )


def corrections(spark, data):
    df = spark.createDataFrame(data, FEEDBACK.replace("timestamp_ntz", "string"))
    return df.withColumn("feedback_at", F.col("feedback_at").cast("timestamp_ntz"))


def test_apply_feedback(spark, log):
    given = corrections(spark, [
        (1, 1, "network", "high", "2024-01-01"), (2, 1, None, "medium", "2024-01-03"), (3, 1, "hardware", None, "2024-01-02"),
        (4, 2, None, None, "2024-01-01"), (5, 9, "network", None, "2024-01-01"), (6, 3, "nonsense", None, "2024-01-01"),
        (7, -1, "network", None, "2024-01-01"), (8, None, "network", None, "2024-01-01"),
    ])
    merged = feedback.apply_feedback(log, given)
    assert rows(merged.select("id", "feedback_queue", "feedback_urgency")) == [
        (1, None, "medium"), (2, "software", "low"), (3, "software", "low"),
    ]
    assert rows(feedback.rejected_feedback(log, given).select("feedback_id", "reason")) == [
        (4, "invalid"), (5, "unknown prediction"), (6, "invalid"), (7, "invalid"), (8, "invalid"),
    ]
    assert rows(feedback.apply_feedback(merged, given)) == rows(merged)


def test_append_feedback(spark, log, sf):
    base = enrich.enrich(S.tickets(spark, sf))
    changed = log.withColumn("feedback_queue", F.when(F.col("id") == 1, "network").when(F.col("id") == 2, "bad"))
    added = feedback.append_feedback(base, changed).where("id < 0").collect()
    assert [(r.id, r.refined_queue, r.has_network, r.answer_length, r.response_ratio) for r in added] == [
        (-2, K.NETWORK_QUEUE, 1, 0, 1.0)
    ]
    raw = feedback.append_feedback(base, changed, compat=True, mapping=None).where("id < 0").collect()
    assert sorted((r.refined_queue, r.has_network) for r in raw) == [("bad", 0), ("network", 0)]


def test_report_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.createDataFrame([(float(i % 3), float(i % 7 % 4)) for i in range(200)], "label double, prediction double")
    want = MulticlassClassificationEvaluator(metricName="weightedFMeasure").evaluate(df)
    assert metrics.f1_weighted(df).first()[0] == pytest.approx(want)
    assert metrics.accuracy(df).first()[0] == pytest.approx(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df))


def test_promotion_gate(spark):
    runs = spark.createDataFrame([("a", 0.7, 0.65), ("b", 0.69, 0.9), ("c", 0.9, 0.6), ("d", None, 0.1)], "run_id string, f1_queue double, f1_urgency double")
    got = metrics.promotion_gate(runs).orderBy("run_id").collect()
    assert [r.status for r in got] == ["success", "rejected", "rejected", "rejected"]


def test_preference_pairs(spark):
    df = spark.createDataFrame(
        [(1, "q", "r", 1, None, False), (2, "q", "r", -1, "better", False), (3, "q", "r", 0, "x", False), (4, "q", "r", 1, "x", True)],
        "feedback_id int, question string, response string, feedback_score int, agent_correction string, used_for_training boolean",
    )
    got = {r.feedback_id: r for r in feedback.preference_pairs(df).collect()}
    assert set(got) == {1, 2} and got[1].reward == 1 and got[1].chosen is None
    assert (got[2].chosen, got[2].rejected, got[2].reward) == ("better", "r", None)
    assert feedback.preference_pairs(feedback.mark_used(df)).count() == 0


# --- conversations ------------------------------------------------------------------------------


def test_dialog_arrays(spark):
    history = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame(
        [(1, [("assistant", "hi"), ("user", None), ("user", "first"), ("user", "second")]), (2, []), (3, None), (4, [("assistant", "x")])],
        f"id int, h {history}",
    )
    q = F.lit("now")
    got = df.select(dialog.rag_query(F.col("h"), q)).collect()
    assert [r[0] for r in got] == ["first now", "now", "now", " now"]
    messages = df.select(dialog.build_messages(F.col("h"), q, "sys")).collect()
    assert [len(r[0]) for r in messages] == [5, 2, 2, 3]
    assert [m.role for m in messages[0][0]] == ["system", "assistant", "user", "user", "user"]


def test_long_dialogs_agree(spark, sf):
    m = S.messages(spark, sf)
    history = dialog.history_before_last(m)
    assert history.count() + m.select("conv_id").distinct().count() == m.count()


# --- models -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def features(spark, sf):
    encoder = textvec.HashEncoder(16)
    table = enrich.training_table(S.enriched(spark, sf))
    rows = textvec.assemble(textvec.embed_texts(table, encoder), "embedding")
    return rows.select("id", "refined_queue", "urgency_level", "features").cache()


@pytest.mark.parametrize("kind", ["forest", "logistic", "boosted"])
def test_classifiers(features, kind, tmp_path, spark):
    model = models.train_classifier(features, "urgency_level", kind, kind != "boosted", max_depth=3, n_estimators=3)
    scored = models.predict(model, features, "urgency_level")
    score = metrics.accuracy(scored, "urgency_level", "predicted_urgency_level").first()[0]
    assert score > 0.6
    models.save_model(model, str(tmp_path / "m"))
    again = models.predict(models.load_model(spark, str(tmp_path / "m")), features, "urgency_level")
    assert rows(again.select("id", "predicted_urgency_level")) == rows(scored.select("id", "predicted_urgency_level"))


def test_search(features):
    sets = [{"max_depth": 1, "n_estimators": 1}, {"max_depth": 5, "n_estimators": 8}]
    scores = {r.run_id: r.score for r in models.random_search(features, "urgency_level", sets, 2).collect()}
    assert scores["run-001"] > scores["run-000"]
    assert models.draw_params(4, 1) == models.draw_params(4, 1) != models.draw_params(4, 2)
    assert all(0.01 <= p["learning_rate"] <= 0.3 and p["max_depth"] in range(3, 9) for p in models.draw_params(50))


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "label_name string")
    assert rows(models.encode_label(df, "label_name").distinct()) == [("a", 0.0), ("b", 1.0), ("c", 2.0)]


def test_serving(spark, features):
    encoder = textvec.HashEncoder(16)
    fitted = {t: models.train_classifier(features, t, "forest", max_depth=3, n_estimators=3) for t in ("refined_queue", "urgency_level")}
    requests = spark.createDataFrame(
        [(1, " my vpn is broken ", None), (2, "   ", None), (3, "and now?", [("user", "printer jam")])],
        "request_id bigint, user_query string, history array<struct<role:string,content:string>>",
    )
    predicted = serve.predict_requests(requests, encoder, fitted)
    assert rows(predicted.select("request_id", "query_text")) == [(1, "my vpn is broken"), (3, "and now?")]
    docs = spark.createDataFrame([(10, "restart the printer", "x"), (11, "check the vpn", "x")], "doc_id bigint, content string, refined_queue string")
    contexts = serve.answer_context(predicted, textvec.embed_texts(docs, encoder, "content"), encoder, similarity=0.5)
    prompts = {r.request_id: r for r in serve.prompts(predicted, contexts).collect()}
    assert len(prompts[1].messages) == 2 and len(prompts[3].messages) == 3
    assert "check the vpn" in prompts[1].messages[-1].content and prompts[1].messages[-1].content.startswith("Categorie:")
    stored = serve.log_rows(predicted, "2024-01-01 00:00:00")
    assert stored.columns == spark.createDataFrame([], schemas.PREDICTION_LOG).columns
    # "broken" contains "ok", and the message is short
    assert rows(serve.short_replies(requests).select("request_id", "intent"))[0] == (1, "confirmation")


def test_monitoring_loop(spark, sf, tmp_path):
    enriched = S.enriched(spark, sf)
    log = S.prediction_log(spark, sf)
    cache = S.embedding_cache(spark, sf)
    encoder = textvec.HashEncoder(16, "tiny")
    run = lambda log, params: monitor.monitor_and_retrain(
        enriched, log, cache, encoder, S.NOW, "2024-01-01", str(tmp_path / "snap"), "20240131_000000", params, str(tmp_path / "models")
    )
    assert run(log.limit(50), monitor.LoopParams()).first().status == "skip"
    corrected = feedback.apply_feedback(log, S.feedback(spark, sf))
    params = monitor.LoopParams(trials=1, folds=2, space={"max_depth": ("choice", [3]), "n_estimators": ("choice", [3])}, keywords=S.TEST_KEYWORDS)
    record = run(corrected, params).first()
    assert record.status in ("success", "rejected") and record.dataset == "snapshot=20240131_000000"
    assert set(record.params) == {f"{t}.{p}" for t in ("refined_queue", "urgency_level") for p in ("max_depth", "n_estimators")}
    stored = snapshots.read_latest_snapshot(spark, str(tmp_path / "snap"))
    assert stored.select("id").distinct().count() == stored.count() > enriched.count()


# --- streams ------------------------------------------------------------------------------------


def test_stream_over_many_files(spark, sf, tmp_path):
    """Small files one per batch: same rows as the batch run, and a restart adds nothing."""
    source = str(tmp_path / "in")
    docs = S.table(spark, sf, "documents")
    docs.repartition(4).write.parquet(source)
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    arriving = S.tickets_from_documents(jobs.read_file_stream(spark, source, schema, files_per_batch=1))
    for _ in range(2):
        out = jobs.run_to_end(jobs.stream_enrich(arriving), str(tmp_path / "out"), str(tmp_path / "cp"))
        assert rows(out.select("id", "refined_queue", "body_length")) == rows(
            enrich.enrich(S.tickets(spark, sf)).select("id", "refined_queue", "body_length")
        )


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "created_at timestamp, kind string"
    stream = jobs.read_file_stream(spark, str(tmp_path / "in" / "*"), schema, files_per_batch=1)
    counts = jobs.tumbling_class_counts(stream, "kind", "1 hour")

    def arrive(name, days):
        df = spark.createDataFrame([(f"2024-01-{d:02d} 12:00:00", "a") for d in days], "created_at string, kind string")
        df.select(F.col("created_at").cast("timestamp"), "kind").coalesce(1).write.parquet(str(tmp_path / "in" / name))
        return jobs.run_to_end(counts, str(tmp_path / "out"), str(tmp_path / "cp"))

    assert arrive("1", [1, 1, 5]).select("count").collect() == [(2,)]
    late = arrive("2", [1, 9])
    assert rows(late.select(F.dayofmonth("window_start"), "count")) == [(1, 2), (5, 1)]


def test_stream_dedup(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1), ("2024-01-01 11:00:00", 1), ("2024-01-01 12:00:00", 2)], "created_at string, k int")
    df.select(F.col("created_at").cast("timestamp"), "k").write.parquet(str(tmp_path / "in"))
    stream = jobs.read_file_stream(spark, str(tmp_path / "in"), "created_at timestamp, k int")
    out = str(tmp_path / "out")
    jobs.stream_insert_ignore(stream, ["k"], ["created_at"], out, str(tmp_path / "cp")).awaitTermination()
    assert rows(jobs.read_batches(spark, out).select("k")) == [(1,), (2,)]


def test_stream_predict_replaces_replayed_batches(spark, tmp_path):
    spark.createDataFrame([("x",), ("y",)], "t string").write.parquet(str(tmp_path / "in"))
    stream = jobs.read_file_stream(spark, str(tmp_path / "in"), "t string")
    for checkpoint in ("cp1", "cp2"):
        predict = lambda batch: batch.withColumn("n", F.length("t"))
        jobs.stream_predict(stream, predict, str(tmp_path / "log"), str(tmp_path / checkpoint)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
