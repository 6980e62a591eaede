"""The prefix trie against a plain one, with and without a skeleton."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ticketloom.llm import prefix_trie as trie


def slow_rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + t[h:]
    return out


def slow_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    below = defaultdict(list)
    for p in members:
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    inner = {p[:-1] for p in members if p}
    children = defaultdict(int)
    for p in members:
        children[p[:-1]] += bool(p)
    out = []
    for p, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(paths[c]) == len(p))))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below[p] if q)
        out.append((
            min(held), len(p), min(members[p[:-1]]) if p else None, len(held), children[p],
            sum(q not in inner for q in below[p]), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def made(seed, conversations=400, kinds=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        c = rng.choice([c, c * 7])
        text = ["Be brief.", "é😀", ""]
        turns = [(rng.choice(["user", "assistant", None]), rng.choice([*text[:kinds], None])) for _ in range(rng.randint(1, longest))]
        if rng.random() < 0.4:
            turns = [("system", "Be brief."), ("user", "hello"), ("assistant", "hi")]  # a very common conversation
        rows += [(c, t, *x) for t, x in enumerate(turns)]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("turns", "path", "first", "shard", "n", "hash")])


def rows_of(turns, **options):
    return sorted((tuple(r) for r in trie.prefix_trie(turns, **options).collect()), key=str)


@pytest.mark.parametrize("shard_paths", [trie.SHARD_PATHS, 40, 7, 1])
def test_any_number_of_shards(spark, monkeypatch, shard_paths):
    monkeypatch.setattr(trie, "PER_SPLITTER", 3)
    monkeypatch.setattr(trie, "PIECE", 5)
    rows = made(shard_paths)
    turns = trie.rebuilt(trie.conversation_turns(frame(spark, rows)))
    assert rows_of(turns, shard_paths=shard_paths) == slow_trie(slow_rebuilt(rows))


def test_skeleton_stays_bounded(spark, monkeypatch):
    monkeypatch.setattr(trie, "PER_SPLITTER", 2)
    monkeypatch.setattr(trie, "SKELETON", 20)
    rows = made(3)
    turns = trie.rebuilt(trie.conversation_turns(frame(spark, rows)))
    distinct = trie.distinct_paths(trie._paths(turns)).cache()
    skeleton = trie.skeleton_of(distinct, distinct.count(), distinct.count())
    assert 0 < sum(map(len, skeleton.splitters)) <= 20 * trie.WIDTH
    distinct.unpersist()
    assert rows_of(turns, shard_paths=1) == slow_trie(slow_rebuilt(rows))


def test_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "PER_SPLITTER", 2)
    rows = [(c, t, "user", f"turn {t if t < 300 * c else -c - t}") for c in range(1, 9) for t in range(300 * c // 2 + 500)]
    turns = trie.conversation_turns(frame(spark, rows))
    paths = defaultdict(list)
    for c, _, role, text in rows:
        paths[c].append((role, text))
    got = {(r[0], r[1]): r for r in rows_of(turns, shard_paths=2)}
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[hash(tuple(p[:d])), d].append(c)
    assert set(got) == {(min(m), d) for (_, d), m in members.items()}
    assert all(got[min(m), d][3] == len(m) for (_, d), m in members.items())


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, "second"), (1, 0, "", "second"), (1, 0, "a", None), (2, 5, "user", "first"),
        (2, 5, "user", "first"), (None, 1, "user", "nobody"), (100, 1, "user", "x" * 100_000), (101, 1, "user", "x" * 100_000),
        (102, 3, "u", "y"), (102, 2, "u", "z"), (-5, 1, "user", "below zero"), (0, 1, "user", "zero"),
    ]
    got = rows_of(trie.rebuilt(trie.conversation_turns(frame(spark, rows))))
    paths = slow_rebuilt([r for r in rows if r[0] != -5])
    # SQL's remainder keeps the sign: conversation -5 belongs to the block of conversation 0
    h = zlib.crc32(b"-5") % 6
    paths[-5] = [("user", "zero")][:h] + [("user", "below zero")][h:]
    assert got == slow_trie(paths)
    assert trie.prefix_trie(trie.rebuilt(trie.conversation_turns(frame(spark, rows[:1]).limit(0)))).count() == 0
