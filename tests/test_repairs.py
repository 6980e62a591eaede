"""Cases that once went wrong: lost keys and windows, failed loads, blank texts, corrections, record files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.catalog import standins as S
from ticketloom.functions import text
from ticketloom.operators import drift, feedback, joins, models, skew, textvec
from ticketloom.plans import monitor
from ticketloom.sources import records, snapshots, tables
from ticketloom.streaming import jobs

EVENT = "id bigint, name string, created_at timestamp, score double"


def one_file_each(spark, rows, path):
    for i, row in enumerate(rows):
        spark.createDataFrame([row], EVENT.replace("timestamp", "string")).withColumn(
            "created_at", F.col("created_at").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(f"{path}/{i:02d}")
    return jobs.read_file_stream(spark, f"{path}/*", EVENT, files_per_batch=1)


ROWS = [
    (1, "a", "2024-01-01 00:00:00", 1.0), (2, "a", "2024-01-05 00:00:00", 2.0), (3, "b", "2024-01-09 00:00:00", None),
    (4, "a", "2024-01-02 00:00:00", 4.0), (5, "b", "2024-01-20 00:00:00", 5.0), (6, "a", "2024-01-20 12:00:00", 6.0),
]


def test_a_key_is_stored_once_however_far_apart_it_comes(spark, tmp_path):
    stream = one_file_each(spark, ROWS, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.stream_insert_ignore(stream, ["name"], ["id"], out, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.name, r.id) for r in jobs.read_batches(spark, out).collect()) == [("a", 1), ("b", 3)]


def test_window_pieces_keep_late_rows_and_open_windows(spark, tmp_path):
    stream = one_file_each(spark, ROWS, str(tmp_path / "in"))
    for name, make, merge in (
        ("counts", lambda b: jobs.class_count_pieces(b, "name"), jobs.merged_class_counts),
        ("means", lambda b: jobs.feature_mean_pieces(b, "score"), jobs.merged_feature_means),
    ):
        out = str(tmp_path / name)
        jobs.write_batches(stream, out, f"{out}-cp", make).awaitTermination()
        pieces = jobs.read_batches(spark, out)
        assert pieces.select("batch").distinct().count() == len(ROWS)
        batch = spark.read.schema(EVENT).parquet(str(tmp_path / "in/*"))
        whole = jobs.tumbling_class_counts(batch, "name") if name == "counts" else jobs.sliding_feature_means(batch, "score")
        assert sorted(merge(pieces).collect(), key=str) == sorted(whole.collect(), key=str)


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    tables.replace_table(spark.range(5), "repair_reload", path=str(tmp_path / "t"))
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.reload_table(broken, "repair_reload")
    assert spark.table("repair_reload").count() == 5
    tables.reload_table(spark.range(3), "repair_reload")
    tables.reload_table(spark.range(4), "repair_reload")
    assert spark.table("repair_reload").count() == 4
    spark.sql("DROP TABLE repair_reload")


@pytest.mark.parametrize("blank", ["\x85", "\x1c\x1c", "  \n"])
def test_unicode_blanks_are_no_query(spark, blank):
    df = spark.createDataFrame([(blank,), (f"{blank}merci{blank}",)], "t string")
    got = df.select(text.valid_query(F.col("t")).alias("q"), text.lang_guard(F.col("t")).alias("g")).collect()
    assert [(r.q, r.g) for r in got] == [(None, "unknown"), ("merci", "unknown")]


LOG = "id bigint, input_text string, predicted_urgency string, feedback_queue string, feedback_urgency string, feedback_at timestamp_ntz"


def corrections(spark, rows):
    return spark.createDataFrame(rows, LOG.replace("timestamp_ntz", "string")).withColumn(
        "feedback_at", F.col("feedback_at").cast("timestamp_ntz")
    )


def test_corrected_urgencies_are_the_three_levels(spark):
    log = corrections(spark, [
        (1, "x", "low", "network", "critical", None), (2, "x", "medium", "network", None, None), (3, "x", None, "network", None, None),
    ])
    base = spark.createDataFrame([], "id bigint, refined_queue string, urgency_level string")
    got = {r.id: r.urgency_level for r in feedback.append_feedback(base, log).collect()}
    assert got == {-2: "high", -3: "medium", -4: "low"}


def test_late_corrections_enter_the_next_snapshot(spark, tmp_path):
    base = spark.createDataFrame([(7, "Other", "low")], "id bigint, refined_queue string, urgency_level string")
    first = corrections(spark, [(1, "x", "low", "network", None, "2024-01-03 00:00:00")])
    later = corrections(spark, [
        (1, "x", "low", "hardware", None, "2024-01-09 00:00:00"), (2, "y", "low", "security", "high", "2024-01-10 00:00:00"),
    ])
    root, params = str(tmp_path / "snap"), monitor.LoopParams()
    for log, stamp in ((first, "20240105_000000"), (later, "20240111_000000")):
        data, since = monitor.base_and_since(base, root, "2024-01-01 00:00:00")
        monitor.training_data(data, log, since, root, stamp, params)
    got = {(r.id, r.refined_queue) for r in snapshots.read_latest_snapshot(spark, root).collect()}
    assert got == {(7, "Other"), (-2, K.FEEDBACK_CLASS["hardware"]), (-3, K.FEEDBACK_CLASS["security"])}


def test_appended_records_are_all_read(spark, tmp_path):
    schema = "run_id string, dataset string"
    path = str(tmp_path / "records")
    records.append_run_record(spark.createDataFrame([("a", "d"), ("b", "d"), ("c", "d")], schema).coalesce(1), path)
    records.append_run_record(spark.createDataFrame([("e", "d")], schema), path)
    assert {r.run_id for r in records.read_run_record(spark, path, schema).collect()} == {"a", "b", "c", "e"}
    (tmp_path / "one.json").write_text(json.dumps({"run_id": "p", "dataset": "q"}, indent=2))
    one = records.read_run_record(spark, str(tmp_path / "one.json"), schema)
    assert [(r.run_id, r.dataset) for r in one.collect()] == [("p", "q")]


def test_the_measured_share_stays_readable_on_few_rows(spark):
    columns = spark.createDataFrame([("a", True), ("b", False)], "column string, drifted boolean")
    row = drift.dataset_drift(columns, spark.range(500), spark.range(3)).first()
    assert (row.drift_share, row.measured_share, row.dataset_drift) == (0.0, 0.5, False)


def test_a_second_run_encodes_nothing(spark, sf, tmp_path):
    encoder = textvec.HashEncoder(16, "tiny")
    path = str(tmp_path / "cache")
    S.embedding_cache(spark, sf).limit(0).write.parquet(path)
    sizes = []
    for _ in range(2):
        _, additions = monitor.embedded_features(S.enriched(spark, sf), spark.read.parquet(path), encoder, S.NOW)
        sizes.append(additions.count())
        additions.write.mode("append").parquet(path)
    assert sizes[0] > 0 and sizes[1] == 0


def test_one_drift_row_per_date(spark, tmp_path):
    columns = spark.createDataFrame([("a", True), ("b", False)], "column string, drifted boolean")
    result = drift.dataset_drift(columns, spark.range(500), spark.range(300))
    for date in ("2024-01-01", "2024-01-01", "2024-01-02"):
        monitor.append_drift_row(monitor.drift_log_row(result, f"{date} 00:00:00", "r"), str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).groupBy("check_date").count().where("count = 1").count() == 2


def test_hot_keys_get_salts_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "SALT_ROWS", 10)
    left = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("k"), "id")
    right = spark.createDataFrame([(1, "one"), (2500, "other")], "k long, v string")
    got = skew.skew_join(left, right, ["k"], "left", spread_by=["id"])
    assert got.count() == 3000 and got.where("v = 'one'").count() == 2000 and got.where("v = 'other'").count() == 1


def test_few_misses_fetch_texts_without_a_shuffle_of_them(spark, sf):
    texts = spark.read.parquet(f"{sf}/documents.parquet")
    plan = joins.cache_misses(texts, S.embedding_cache(spark, sf), S.MODEL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "strategy=broadcast" in plan


def test_search_draws_only_what_the_model_uses():
    assert all("learning_rate" not in p for p in models.draw_params(5, kind="forest"))
    assert all("learning_rate" in p for p in models.draw_params(5))
