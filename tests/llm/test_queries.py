"""The corpus queries over the small tables: against SQL, or against a brute-force version."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from compare import differences, duck
from llm_helpers import (
    area_under_curve,
    check_packing,
    check_shards,
    repeated_words,
    slow_components,
    slow_fingerprint,
)

from ticketloom.llm.catalog import load

QUERIES, SQL = load()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, SQL[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_packing_round_trip(spark, sf, docs):
    check_packing(QUERIES["op2_pack"](spark, sf).collect(), dict(docs))


def test_simhash(spark, sf, docs):
    marks = {d: slow_fingerprint(t) for d, t in docs}
    component = slow_components(marks)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, sf).collect()}
    assert got == {d: (f"{marks[d]:016x}", component[d]) for d in marks}


def test_repeats_cover_exactly_the_shared_words(spark, sf, docs):
    _, want = repeated_words(docs)
    got = defaultdict(set)
    for r in QUERIES["op7_repeats"](spark, sf).collect():
        assert r.other_id != r.doc_id and r.words >= 50
        got[r.doc_id].update(range(r.start, r.start + r.words))
    assert want and dict(got) == want


def test_near_passages(spark, sf, docs):
    words, exact = repeated_words(docs)
    shingles = lambda d, s, n: {tuple(words[d][s : s + n][i : i + 5]) for i in range(n - 4)}
    linked = set()
    for r in QUERIES["op6_passages"](spark, sf).collect():
        a, b = shingles(r.doc_id, r.start, r.words), shingles(r.other_id, r.other_start, r.other_words)
        assert r.words >= 50 and r.other_words >= 50
        assert r.similarity >= 0.8 and abs(r.similarity - len(a & b) / len(a | b)) < 1e-9
        linked |= {r.doc_id, r.other_id}
    assert exact and set(exact) <= linked


def test_quality(spark, con):
    sf = "/root/testdata/sf0.01"  # the smaller table has too few labels to measure
    rows = {r.doc_id: r for r in QUERIES["op8_quality"](spark, sf).collect()}
    labels = dict(con.execute(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    assert len(rows) == 1000
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [d for d in labels if rows[d].held_out]
    assert area_under_curve([labels[d] for d in unseen], [rows[d].score for d in unseen]) > 0.9


def test_sharding(spark, sf, docs):
    rows = QUERIES["op10_shard"](spark, sf).collect()
    check_shards(rows, dict(docs))
    where = defaultdict(set)
    for r in rows:
        where[dict(docs)[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())  # no group is larger than a shard here


def test_top_k_has_full_recall(spark, sf, con):
    vectors = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids = np.array([v for v, _ in vectors])
    m = np.floor(1024 * np.array([e for _, e in vectors], dtype=np.float64)).astype(np.int64)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op4_top_k"](spark, sf).collect()}
    want = {}
    for q in ids[ids % 100 == 0]:
        scores = m @ m[ids == q][0]
        best = sorted((-s, v) for s, v in zip(scores.tolist(), ids.tolist()) if v != q)[:10]
        want |= {(int(q), i + 1): (v, -s) for i, (s, v) in enumerate(best)}
    assert got == want
