"""Retrieval against brute force in NumPy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.operators import retrieval, sampling, textvec


def brute(q, d, k, same=None):
    out = []
    for i, v in enumerate(q):
        distance = 1 - d @ v / (np.linalg.norm(d, axis=1) * np.linalg.norm(v))
        order = sorted((round(x, 9), j) for j, x in enumerate(distance) if same is None or same(i, j))[:k]
        out += [(i, r + 1, j) for r, (_, j) in enumerate(order)]
    return out


@pytest.fixture(scope="module")
def data(spark):
    """300 documents, a third of them copies of one and a third in one group; 40 queries."""
    rng = np.random.default_rng(0)
    d = np.round(rng.normal(size=(300, 8)), 3).astype("float32").astype("float64")
    d[100:200] = d[7]
    q = np.round(rng.normal(size=(40, 8)), 3).astype("float32").astype("float64")
    q[3] = d[7]
    group = [0 if j < 100 else j % 5 for j in range(300)]
    docs = spark.createDataFrame(
        [(j, v.tolist(), group[j], f"text {j % 250}") for j, v in enumerate(d)],
        "doc_id bigint, embedding array<float>, g int, content string",
    )
    queries = spark.createDataFrame(
        [(i, v.tolist(), i % 6) for i, v in enumerate(q)], "qid bigint, embedding array<float>, g int"
    )
    return q, d, group, queries.repartition(3), docs.repartition(5)


def ranks(df):
    return sorted((r.qid, r["rank"], r.doc_id) for r in df.collect())


@pytest.mark.parametrize("kw", [{}, {"max_broadcast": 0, "query_block": 7, "doc_block": 11}, {"max_broadcast": 10}])
def test_exact(data, kw):
    q, d, group, queries, docs = data
    assert ranks(retrieval.retrieve(queries, docs, 5, **kw)) == brute(q, d, 5)
    same = ranks(retrieval.retrieve(queries, docs, 4, "g", **kw))
    assert same == brute(q, d, 4, lambda i, j: i % 6 == group[j])


@pytest.mark.parametrize("kw", [{}, {"max_broadcast": 0, "block": 9}])
def test_pairs(data, kw):
    q, d, group, queries, docs = data
    unit = lambda m: m / np.linalg.norm(m, axis=1)[:, None]
    distance = 1 - unit(q) @ unit(d).T
    want = sorted(zip(*map(list, np.nonzero(distance <= 0.4))))
    assert sorted((r.qid, r.doc_id) for r in retrieval.query_doc_pairs(queries, docs, 0.4, **kw).collect()) == want


def test_few_documents_are_broadcast(data):
    q, d, _, queries, docs = data
    few = docs.where("doc_id < 30")
    hits = retrieval.retrieve(queries, few, 5, max_broadcast=35)
    assert ranks(hits) == brute(q, d[:30], 5)
    assert "FlatMapCoGroupsInPandas" not in hits._jdf.queryExecution().executedPlan().toString()
    pairs = retrieval.query_doc_pairs(queries, few, 0.8, max_broadcast=35)
    other = retrieval.query_doc_pairs(queries, few, 0.8)
    assert sorted(map(tuple, pairs.select("qid", "doc_id").collect())) == sorted(map(tuple, other.select("qid", "doc_id").collect()))


def test_few_documents_and_missing_vectors(spark, data):
    _, _, _, queries, docs = data
    few = docs.where("doc_id < 3")
    assert retrieval.retrieve(queries, few, 5).count() == 40 * 3
    broken = few.withColumn("embedding", F.when(F.col("doc_id") > 0, F.col("embedding")))
    zero = broken.withColumn("embedding", F.when(F.col("doc_id") == 1, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")))
    for kw in ({}, {"max_broadcast": 0}):
        assert {r.doc_id for r in retrieval.retrieve(queries, zero, 5, **kw).collect()} == {2}
    assert retrieval.retrieve(queries, docs.where("false"), 5).count() == 0
    assert retrieval.retrieve(queries.where("false"), docs, 5).count() == 0


def test_fallback(data):
    """Group hits first, whatever they are; then global hits with contents the query has not seen."""
    q, d, group, queries, docs = data
    got = retrieval.retrieve_with_fallback(queries, docs, "g", 5, 0.75, content="content").collect()
    limit = (1 - 0.75) * 2
    content = [f"text {j % 250}" for j in range(300)]
    want = []
    for i, v in enumerate(q):
        distance = 1 - d @ v / (np.linalg.norm(d, axis=1) * np.linalg.norm(v))
        order = sorted(range(300), key=lambda j: (round(distance[j], 9), j))
        mine = [j for j in order if group[j] == i % 6][:10]
        kept = [j for j in mine if distance[j] <= limit][:5]
        stages = ["queue"] * len(kept)
        if len(kept) < 2:
            for j in order[:5]:
                if distance[j] <= limit and content[j] not in [content[x] for x in kept] and len(kept) < 5:
                    kept.append(j)
                    stages.append("global")
        want += [(i, r + 1, j, s) for r, (j, s) in enumerate(zip(kept, stages))]
    assert sorted((r.qid, r["rank"], r.doc_id, r.stage) for r in got) == want
    assert {"queue", "global"} == {r.stage for r in got}


def test_ann(data):
    q, d, _, queries, docs = data
    index = retrieval.ann_index(docs, lists=6)
    assert ranks(retrieval.ann_retrieve(queries, index, 5, nprobe=6)) == brute(q, d, 5)
    recall = retrieval.recall_at_k(retrieval.ann_retrieve(queries, index, 5, nprobe=3), retrieval.retrieve(queries, docs))
    assert recall.first().recall > 0.5


def test_nearest_k(data):
    q, d, _, _, docs = data
    got = [r.doc_id for r in sampling.nearest_k(docs, q[3], 4, "doc_id").collect()]
    assert got == [j for _, _, j in brute(q[3:4], d, 4)]


def test_context(spark, data):
    *_, queries, _ = data
    hits = spark.createDataFrame([(0, 2, "b"), (0, 1, "a")], "qid bigint, rank int, content string")
    got = {r.qid: r.context for r in retrieval.context_of(hits, queries).collect()}
    assert got[0] == "a\n\nb" and got[1] == K.NO_CONTEXT and len(got) == 40


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "Red red blue"), (2, "blue sky, a"), (3, None)], "id int, text string").na.fill("")
    model = textvec.fit_tfidf(docs)
    assert model.terms[:2] == ["blue", "red"] and set(model.terms) == {"blue", "red", "sky", "red red", "red blue", "blue sky"}
    idf = dict(zip(model.terms, model.idf))
    assert idf["blue"] == pytest.approx(np.log(4 / 3) + 1) and idf["red"] == pytest.approx(np.log(4 / 2) + 1)
    first = model.transform(docs).where("id = 1").first().tfidf.toArray()
    raw = {"red": 2 * idf["red"], "blue": idf["blue"], "red red": idf["red red"], "red blue": idf["red blue"]}
    length = np.sqrt(sum(v * v for v in raw.values()))
    assert {t: x for t, x in zip(model.terms, first) if x} == {t: pytest.approx(v / length) for t, v in raw.items()}
    assert textvec.fit_tfidf(docs, size=2).terms == ["blue", "red"]


def test_incremental_embeddings(spark):
    def load():
        """Stands for a model that is loaded once per task."""
        return lambda texts: np.array([[len(t), 1.0] for t in texts], dtype="float32")

    texts = spark.createDataFrame([(i, "same" if i % 3 == 0 else f"text {i % 4}") for i in range(60)], "id int, text string")
    cache = spark.createDataFrame([], "text_hash string, model_name string, text_content string, embedding array<float>, created_at timestamp_ntz")
    encoder = textvec.BatchEncoder(load, "counting", batch_size=7)
    rows, added = textvec.incremental_embeddings(texts, cache, encoder, "2024-01-01")
    assert rows.count() == 60 and rows.where("from_cache").count() == 0
    assert added.count() == texts.select("text").distinct().count()
    joined = rows.join(texts, "id").collect()
    assert all(r.embedding[0] == len(r.text) for r in joined)
    again, nothing = textvec.incremental_embeddings(texts, added, encoder, "2024-01-02")
    assert again.where("not from_cache").count() == 0 and nothing.count() == 0
    other, fresh = textvec.incremental_embeddings(texts, added, textvec.BatchEncoder(load, "other"), "2024-01-02")
    assert other.where("from_cache").count() == 0 and fresh.count() == added.count()
