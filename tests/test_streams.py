"""State, compaction and late corrections of the streaming jobs; bounded and fitted approximate search."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.operators import retrieval
from ticketloom.session import folder_names
from ticketloom.streaming import jobs


def arrive(spark, rows, schema, path, times=()):
    df = spark.createDataFrame(rows, schema)
    for c in times:
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(path)


SEEN = "k string, n bigint, note string"


def test_first_row_per_key_keeps_nulls_and_large_numbers(spark, tmp_path):
    big = 2**60 + 1
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def run():
        stream = jobs.read_file_stream(spark, source, SEEN, files_per_batch=1)
        jobs.stream_insert_ignore(stream, ["k"], ["n"], out, cp).awaitTermination()
        return sorted(map(tuple, jobs.read_batches(spark, out).select("k", "n", "note").collect()), key=str)

    arrive(spark, [("a", big, None), ("a", big + 1, "x"), (None, 3, "y"), ("b", None, "z"), ("b", 1, "w")], SEEN, source)
    first = [("a", big, None), ("b", None, "z"), (None, 3, "y")]
    assert run() == sorted(first, key=str)
    arrive(spark, [("a", 0, "earlier, but later"), (None, 1, None), ("c", 1, None), ("c", 1, None)], SEEN, source)
    assert run() == sorted([*first, ("c", 1, None)], key=str)


def test_insert_ignore_reads_nothing_of_what_is_stored(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for day in range(4):
        arrive(spark, [(f"key {i}", i, "") for i in range(day * 50, day * 50 + 100)], SEEN, source)
        stream = jobs.read_file_stream(spark, source, SEEN)
        jobs.stream_insert_ignore(stream, ["k"], ["n"], out, cp).awaitTermination()
        if day == 1:  # were it read, the third run would fail
            os.rename(f"{out}/batch=0", f"{out}/moved")
    os.rename(f"{out}/moved", f"{out}/batch=0")
    assert jobs.read_batches(spark, out).groupBy("batch").count().orderBy("batch").collect() == [
        (0, 100), (1, 50), (2, 50), (3, 50)
    ]


EVENT = "id bigint, name string, created_at timestamp, score double"
ROWS = [
    (1, "a", "2024-01-01 00:00:00", 1.0), (2, "a", "2024-01-05 00:00:00", 2.0), (3, "b", "2024-01-09 00:00:00", None),
    (4, "a", "2024-01-02 00:00:00", 4.0), (5, "b", "2024-01-20 00:00:00", 5.0), (6, "a", "2024-01-20 12:00:00", 6.0),
]


def test_totals_of_the_state_store_count_late_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    for row in ROWS:
        arrive(spark, [row], EVENT.replace("timestamp", "string"), source, ["created_at"])
    stream = jobs.read_file_stream(spark, source, EVENT, files_per_batch=1)
    batch = spark.read.schema(EVENT).parquet(source)
    for name, make, keys, finish, whole in (
        ("counts", lambda s: jobs.running_class_counts(s, "name"), ["window_start", "class"], lambda t: t,
         jobs.tumbling_class_counts(batch, "name")),
        ("means", lambda s: jobs.running_feature_means(s, "score"), ["window_start"], jobs.merged_feature_means,
         jobs.sliding_feature_means(batch, "score")),
    ):
        out = str(tmp_path / name)
        jobs.write_totals(make(stream), out, f"{out}-cp").awaitTermination()
        read = lambda: sorted(finish(jobs.latest_totals(jobs.read_batches(spark, out), keys)).collect(), key=str)  # noqa: B023, E731
        assert read() == sorted(whole.collect(), key=str)
        plan = jobs.read_batches(spark, out).select("batch").distinct().count()
        assert plan == len(ROWS)


def test_compaction(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    merge = jobs.merged_class_counts

    def run(rows):
        arrive(spark, rows, EVENT.replace("timestamp", "string"), source, ["created_at"])
        stream = jobs.read_file_stream(spark, source, EVENT)
        jobs.write_batches(stream, out, cp, lambda b: jobs.class_count_pieces(b, "name")).awaitTermination()

    def totals():
        return sorted(merge(jobs.read_batches(spark, out)).collect(), key=str)

    jobs.compact_batches(spark, out, merge)  # nothing is stored yet
    with pytest.raises(FileNotFoundError):
        jobs.read_batches(spark, out)
    run(ROWS[:2])
    run(ROWS[2:4])
    before = totals()
    # a merged folder that was not finished is ignored, and so is a replay of a merged micro-batch
    os.makedirs(f"{out}/merged=1")
    assert totals() == before
    jobs.compact_batches(spark, out, merge)
    assert [n for n in folder_names(spark, out)] == ["merged=1"] and totals() == before
    jobs.read_batches(spark, out).drop("batch").write.parquet(f"{out}/batch=1")
    assert totals() == before
    run(ROWS[4:])
    jobs.compact_batches(spark, out, merge)
    assert folder_names(spark, out) == ["merged=2"]
    batch = spark.read.schema(EVENT).parquet(source)
    assert totals() == sorted(jobs.tumbling_class_counts(batch, "name").collect(), key=str)


LOG = "id bigint, predicted_queue string, created_at string"
GIVEN = "feedback_id bigint, prediction_id bigint, correct_queue string, feedback_at string"


def test_late_second_corrections_arrive(spark, tmp_path):
    """The first correction comes in time, the second one after the watermark, others before their prediction."""
    paths = {x: str(tmp_path / x) for x in ("log", "given", "joined", "cp", "late")}

    def frames(read):
        log = read(LOG.replace("created_at string", "created_at timestamp"), paths["log"])
        return log, read(GIVEN.replace("feedback_at string", "feedback_at timestamp"), paths["given"])

    def run(predictions, corrections):
        if predictions:
            arrive(spark, predictions, LOG, paths["log"], ["created_at"])
        if corrections:
            arrive(spark, corrections, GIVEN, paths["given"], ["feedback_at"])
        log, given = frames(lambda schema, path: jobs.read_file_stream(spark, path, schema))
        streamed = jobs.run_to_end(jobs.feedback_stream_join(log, given), paths["joined"], paths["cp"])
        log, given = frames(lambda schema, path: spark.read.schema(schema).parquet(path))
        matches = jobs.complete_matches(spark, paths["late"], streamed, log, given)
        again = jobs.complete_matches(spark, paths["late"], streamed, log, given)
        assert sorted(map(str, matches.collect())) == sorted(map(str, again.collect()))
        got = sorted(map(str, jobs.with_unmatched(matches, log).collect()))
        assert got == sorted(map(str, jobs.feedback_stream_join(log, given).collect()))
        return streamed.where("feedback_id is not null").count(), matches.count()

    day = "2024-01-{:02d} {:02d}:00:00".format
    run([(1, "x", day(1, 0)), (2, "y", day(1, 1))], [(10, 1, "a", day(1, 2))])
    run([(3, "z", day(9, 0))], [(11, 3, "b", day(9, 1))])  # the watermark passes the first day
    streamed, matched = run([(4, "z", day(10, 0))], [(12, 1, "c", day(1, 3)), (13, 1, "a", day(3, 0)), (14, 5, "d", day(2, 2))])
    assert (streamed, matched) == (2, 3)  # 12 was too late for the stream
    streamed, matched = run([(5, "late prediction", day(2, 1))], [(15, 4, None, day(10, 5))])
    assert matched == 5  # 14 found its prediction, which came later than it
    run([], [(16, 99, "no prediction", day(11, 0))])


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    d = np.concatenate([centres[rng.integers(0, 30, 1200)] + 0.15 * rng.normal(size=(1200, 16)), np.zeros((2, 16))])
    q = centres[rng.integers(0, 30, 60)] + 0.15 * rng.normal(size=(60, 16))
    docs = [(i, v.tolist()) for i, v in enumerate(d)] + [(5000, None)]
    queries = [(i, v.tolist()) for i, v in enumerate(q)] + [(900, None), (901, [0.0] * 16)]
    schema = "embedding array<double>"
    return spark.createDataFrame(queries, f"qid bigint, {schema}"), spark.createDataFrame(docs, f"doc_id bigint, {schema}").repartition(4)


def ranks(df):
    return sorted((r.qid, r["rank"], r.doc_id) for r in df.collect())


def test_fitted_probes_reach_their_recall(clustered):
    queries, docs = clustered
    exact = retrieval.retrieve(queries, docs)
    for target in (0.9, 0.99):
        index = retrieval.ann_index(docs, recall=target)
        assert len(index.centers) == round(1203**0.5) and index.recall >= target
        found = retrieval.recall_at_k(retrieval.ann_retrieve(queries, index), exact).first().recall
        assert found >= target - 0.05
        assert index.nprobe < len(index.centers)
    assert retrieval.ann_index(docs, recall=1.0, queries=queries).recall == 1.0


def test_bounds_skip_lists_and_lose_nothing(clustered):
    queries, docs = clustered
    index = retrieval.ann_index(docs, lists=25)
    want = ranks(retrieval.retrieve(queries, docs))
    assert ranks(retrieval.retrieve_bounded(queries, index)) == want
    assert ranks(retrieval.retrieve_bounded(queries, index, nprobe=1)) == want
    # every document is within its list's radius
    for r in index.docs.collect():
        v = np.array(r.embedding)
        angle = np.arccos(np.clip(v @ index.centers[r.list_id] / np.linalg.norm(v), -1, 1))
        assert angle <= index.radii[r.list_id] + 1e-9
    first = retrieval.ann_retrieve(queries, index, nprobe=3)
    reach = queries.join(first.where("rank = 5").select("qid", F.col("distance").alias("reach")), "qid")
    left = retrieval.lists_within_reach(reach, index, 3).count()
    assert left < 0.3 * 60 * (25 - 3)  # most lists are ruled out by their bound


def test_random_vectors_need_more_lists(spark):
    rng = np.random.default_rng(8)
    d = rng.normal(size=(400, 24))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d)], "doc_id bigint, embedding array<double>")
    queries = docs.where("doc_id % 10 = 0").select(F.col("doc_id").alias("qid"), "embedding")
    index = retrieval.ann_index(docs)
    exact = retrieval.retrieve(queries, docs)
    assert retrieval.recall_at_k(retrieval.ann_retrieve(queries, index), exact).first().recall >= 0.9
    assert ranks(retrieval.retrieve_bounded(queries, index)) == ranks(exact)
    empty = retrieval.ann_retrieve(queries.limit(0), index)
    assert empty.count() == 0
