"""Prefix trie of conversations, built in sorted shards under a skeleton of splitter paths.

Each distinct sequence of first turns (role, text) of some conversations is a node. A conversation's path is
the row of its turns' 128-bit hashes; conversations with equal paths are one path with a count, so copies cost
one row. Some paths, every so many in sorted order, are cut to what tells them from the one before and split
all paths into ranges. The trie of these splitters, the skeleton, is broadcast: a node that is no prefix of a
splitter has all its conversations in one range. Every shard sorts its paths and finishes such nodes in one
pass with a stack. Of skeleton nodes it emits what its own paths add; these parts are added up per node by a
reduction, and one pass over the skeleton, whose size is bounded by ``SKELETON``, finishes them.

Conversations can be rebuilt first, as if they continued others (``rebuilt``). The numbers of conversations
that end at a node are hashed in order: they are sorted into ranges, joined there to strings of at most
``PIECE`` numbers, and one running SHA-256 per path takes these strings in turn; as this hash has no parallel
form, the strings of one path are read by one task, piece by piece.

Tasks hold the path of one conversation (20 bytes a turn), the stack over it, and the finished children of
nodes that are still open in a shard.

Inputs: conversations (conv_id, turn, role, text). Cases: turns are ordered by (turn, role, text), null turns
first, so ties have one order; a null role or text is empty; repeated rows are turns of their own; rows with a
null conv_id belong to no conversation and are left out; other columns are ignored; an empty table has no
conversation, hence no node, not even a root, and gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial
from typing import Any

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import buckets_for, opened, shared, stored, table
from ticketloom.llm.registry import query

#: Turns that a conversation can take from the first one of its block of conversations.
BLOCK, TURNS = 100, 6
#: Distinct paths per shard, up to MAX_SHARDS shards; beyond that, shards grow.
SHARD_PATHS, MAX_SHARDS = 4_000, 100_000
#: Paths looked at per splitter, and turns of all splitters together.
PER_SPLITTER, SKELETON = 32, 2_000_000
PIECE = 50_000
ROWS_OUT = 20_000
WIDTH = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

_DISTINCT = "path binary, chars array<long>, n long, least long, ends string"
_PIECES = "path_id binary, path binary, chars array<long>, n long, least long, piece string"
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_FOUND = f"kind int, splitter int, level long, chars long, {_NODE}"
_FINISHED, _UNDER, _PART = 0, 1, 2


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order, as (hash of role and text, code points of the text)."""
    source = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"),
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turn = F.struct(
        F.row_number().over(order).alias("place"),
        F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text")).alias("hash"),
        F.length("text").cast("long").alias("chars"),
    )
    ordered = source.select("conv_id", turn.alias("t"))
    return ordered.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame, block: int = BLOCK, most: int = TURNS) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c % block, h being crc32(c) % most.

    Its own turns after its first h follow. Turns of an absent conversation are none.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    heads = turns.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, most - 1).alias("head")
    )
    joined = turns.withColumn("first", F.col("conv_id") - F.col("conv_id") % block).join(heads, "first", "left")
    taken = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    return joined.select("conv_id", F.concat(taken, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _paths(turns: DataFrame) -> DataFrame:
    path: Column = F.unhex(F.array_join(F.transform("turns", lambda t: t["hash"]), ""))
    chars = F.transform("turns", lambda t: t["chars"])
    return turns.select("conv_id", path.alias("path"), chars.alias("chars")).withColumn("path_id", F.unhex(F.md5("path")))


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [pa.field(x.split()[0], kinds[x.split()[1]]) for x in names.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


def _values(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one path, sorted by conversation, as rows of at most ``PIECE`` numbers."""
    rows, now, ids = [], None, []
    for path_id, path, chars, conv_id in _values(batches, "path_id", "path", "chars", "conv_id"):
        if now is not None and (now[0] != path_id or len(ids) >= PIECE):
            rows.append((*now, len(ids), ids[0], ",".join(map(str, ids))))
            ids = []
        now = (path_id, path, chars)
        ids.append(conv_id)
        if len(rows) >= ROWS_OUT:
            yield _batch(rows, _PIECES)
            rows = []
    if now is not None:
        rows.append((*now, len(ids), ids[0], ",".join(map(str, ids))))
    yield _batch(rows, _PIECES)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per path from its pieces, which follow each other in order."""
    rows: list[tuple] = []
    last: list[Any] | None = None
    for path_id, path, chars, n, least, piece in _values(batches, "path_id", "path", "chars", "n", "least", "piece"):
        if last is not None and last[0] == path_id:
            last[3] += n
            last[5].update(b"," + piece.encode())
            continue
        if last is not None:
            rows.append((*last[1:5], last[5].hexdigest()))
        last = [path_id, path, chars, n, least, hashlib.sha256(piece.encode())]
        if len(rows) >= ROWS_OUT:
            yield _batch(rows, _DISTINCT)
            rows = []
    if last is not None:
        rows.append((*last[1:5], last[5].hexdigest()))
    yield _batch(rows, _DISTINCT)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """One row per path: conversations, the smallest of them, and the hash of their numbers in order."""
    n = buckets_for(paths.count(), SHARD_PATHS)
    ranged = paths.repartitionByRange(n, "path_id", "conv_id").sortWithinPartitions("path_id", "conv_id")
    pieces = ranged.mapInArrow(_joined, _PIECES)
    return pieces.repartition(n, "path_id").sortWithinPartitions("path_id", "least").mapInArrow(_distinct, _DISTINCT)


def common_depth(a: bytes, b: bytes) -> int:
    """Turns that two paths share."""
    d, most = 0, min(len(a), len(b))
    while d < most and a[d : d + WIDTH] == b[d : d + WIDTH]:
        d += WIDTH
    return d // WIDTH


def _every(step: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every so many of sorted paths, cut to what tells it from the one before."""
    before = None
    for k, (path,) in enumerate(_values(batches, "path")):
        if before is not None and k % step == 0:
            yield pa.RecordBatch.from_pydict({"path": pa.array([path[: (common_depth(before, path) + 1) * WIDTH]], pa.binary())})
        before = path


class Skeleton:
    """The trie of sorted splitter paths. A node of it is (the first splitter it is a prefix of, its depth)."""

    def __init__(self, splitters: list[bytes]):
        self.splitters = splitters
        self.first: list[list[int]] = []  # by splitter and depth: the first splitter with that prefix
        for k, path in enumerate(splitters):
            same = common_depth(splitters[k - 1], path) if k else 0
            own = [k] * (len(path) // WIDTH + 1)
            if k:
                own[: same + 1] = self.first[k - 1][: same + 1]
            own[0] = 0
            self.first.append(own)

    def depth(self, shard: int, path: bytes) -> tuple[int, int]:
        """Depth to which a path of a shard runs along the skeleton, and a splitter that shares it."""
        best = (0, 0)
        for k in (shard - 1, shard):
            if 0 <= k < len(self.splitters):
                best = max(best, (common_depth(path, self.splitters[k]), k))
        return best

    def node(self, splitter: int, depth: int) -> int:
        return self.first[splitter][depth] if depth else 0


def skeleton_of(distinct: DataFrame, shards: int, total: int) -> Skeleton:
    """Splitters from paths picked by a hash, ``PER_SPLITTER`` for each; whichever they are, the result is the same."""
    if shards == 1:
        return Skeleton([])
    picked = distinct.where(F.pmod(F.xxhash64("path"), F.lit(total)) < PER_SPLITTER * shards).select("path")
    cut = picked.repartition(1).sortWithinPartitions("path").mapInArrow(partial(_every, PER_SPLITTER), "path binary")
    splitters = sorted(bytes(r.path) for r in cut.toLocalIterator())
    while sum(map(len, splitters)) > SKELETON * WIDTH:
        splitters = splitters[1::2]
    return Skeleton(splitters)


def _dealt(skeleton: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    splitters = opened(skeleton).splitters
    for batch in batches:
        shard = [bisect_right(splitters, p) for p in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], names=[*batch.schema.names, "shard"])


class _Node:
    __slots__ = ("n", "least", "children", "leaves", "saved", "chars", "ends", "waiting")

    def __init__(self, chars: int):
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.chars, self.ends = chars, None
        self.waiting: list[tuple] = []  # finished children, which lack their parent's smallest conversation

    def add(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)


class _Shard:
    """The stack over one sorted shard."""

    def __init__(self, skeleton: Skeleton, out: list[tuple]):
        self.skeleton, self.out = skeleton, out
        self.shard, self.path, self.stack, self.along, self.splitter = None, b"", [], 0, 0

    def push(self, shard: int, path: bytes, chars: list[int], n: int, least: int, ends: str) -> None:
        if shard != self.shard:
            self.close()
            self.shard = shard
            self.stack = [_Node(0)]
        else:
            self.close(common_depth(self.path, path))
        self.path = path
        self.along, self.splitter = self.skeleton.depth(shard, path)
        self.stack += [_Node(c) for c in chars[len(self.stack) - 1 :]]
        self.stack[-1].add(n, least)
        self.stack[-1].ends = ends

    def close(self, depth: int = -1) -> None:
        """Closes the nodes deeper than ``depth``."""
        while len(self.stack) - 1 > depth:
            node, level = self.stack.pop(), len(self.stack)
            if level <= self.along:
                self._emit_part(node, level)
            else:
                self._finish(node, level)
            if self.stack:
                self.stack[-1].add(node.n, node.least)

    def _emit_part(self, node: _Node, level: int) -> None:
        key = self.skeleton.node(self.splitter, level)
        body = (node.least, level, None, node.n, node.children, node.leaves, node.saved, node.ends)
        self.out.append((_PART, key, level, node.chars, *body))

    def _finish(self, node: _Node, level: int) -> None:
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.chars
        for child in node.waiting:
            self.out.append((_FINISHED, None, None, None, *child[:2], node.least, *child[2:]))
        parent = self.stack[-1]
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved
        row = (node.least, level, node.n, node.children, node.leaves, node.saved, node.ends or NO_ENDS)
        if level - 1 <= self.along:
            key = self.skeleton.node(self.splitter, level - 1)
            self.out.append((_UNDER, key, level - 1, None, *row[:2], None, *row[2:]))
        else:
            parent.waiting.append(row)


def _finished(skeleton: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    shard = _Shard(opened(skeleton), out)
    for row in _values(batches, "shard", "path", "chars", "n", "least", "ends"):
        shard.push(*row)
        if len(out) >= ROWS_OUT:
            yield _batch(out, _FOUND)
            out.clear()
    shard.close()
    yield _batch(out, _FOUND)


def _skeleton_nodes(skeleton: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finishes the skeleton: nodes in the order (splitter, depth) have their parents before them."""
    trie = opened(skeleton)
    names = ("splitter", "level", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens", "chars", "ends_sha256")
    nodes = {(row[0], row[1]): list(row[2:]) for row in _values(batches, *names)}
    parent = lambda key: (trie.node(key[0], key[1] - 1), key[1] - 1)
    for key in sorted(nodes, reverse=True):
        node = nodes[key]
        node[3] = node[3] or 1
        node[4] += (node[0] - 1) * node[5]
        if key[1]:
            above = nodes[parent(key)]
            above[2] += 1
            above[3] += node[3]
            above[4] += node[4]
    rows = []
    for key, (n, least, children, leaves, saved, chars, ends) in nodes.items():
        above = nodes[parent(key)][1] if key[1] else None
        rows.append((None, *key, chars, least, key[1], above, n, children, leaves, saved, ends or NO_ENDS))
        if len(rows) >= ROWS_OUT:
            yield _batch(rows, _FOUND)
            rows = []
    yield _batch(rows, _FOUND)


def prefix_trie(turns: DataFrame, shard_paths: int = SHARD_PATHS) -> DataFrame:
    """A row per node of the trie of ``turns`` (conv_id, turns), as ``conversation_turns`` returns them."""
    spark = turns.sparkSession
    names = [x.split()[0] for x in _NODE.split(", ")]
    distinct = stored(distinct_paths(stored(_paths(turns))))
    total = distinct.count()
    shards = min(MAX_SHARDS, buckets_for(total, shard_paths))
    trie = skeleton_of(distinct, shards, total)
    skeleton = shared(spark, trie)
    dealt = distinct.mapInArrow(partial(_dealt, skeleton), f"{_DISTINCT}, shard int")
    sorted_shards = dealt.repartitionById(len(trie.splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "path")
    found = stored(sorted_shards.mapInArrow(partial(_finished, skeleton), _FOUND))
    parts = found.where(F.col("kind") == _PART).groupBy("splitter", "level").agg(
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"), F.max("ends_sha256").alias("ends_sha256"),
    )
    top = stored(parts.repartition(1).mapInArrow(partial(_skeleton_nodes, skeleton), _FOUND))
    above = top.select("splitter", "level", F.col("conv_id").alias("above"))
    under = found.where(F.col("kind") == _UNDER).join(F.broadcast(above), ["splitter", "level"])
    under = under.withColumn("parent_conv_id", F.col("above"))
    rows = found.where(F.col("kind") == _FINISHED)
    return rows.select(*names).unionByName(under.select(*names)).unionByName(top.select(*names))


SQL = """
WITH t AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(x ORDER BY place) AS turns FROM t GROUP BY conv_id
), drawn AS (
  SELECT conv_id, turns, xor(list_reduce(
      list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
        lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) % 6 AS h
  FROM own
), built AS (
  SELECT d.conv_id, list_concat(coalesce(list_slice(o.turns, 1, d.h), []), list_slice(d.turns, d.h + 1, len(d.turns))) AS path
  FROM drawn d LEFT JOIN own o ON o.conv_id = d.conv_id - d.conv_id % 100
), held AS (
  SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM built
), node AS (
  SELECT list_slice(path, 1, depth) AS p, depth, min(conv_id) AS conv_id, count(*) AS n,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '') AS ends
  FROM held GROUP BY ALL
), family AS (
  SELECT c.*, a.conv_id AS parent_conv_id, (c.n - 1) * coalesce(length(c.p[c.depth].text), 0) AS own
  FROM node c LEFT JOIN node a ON a.depth = c.depth - 1 AND a.p = list_slice(c.p, 1, c.depth - 1)
), children AS (
  SELECT list_slice(p, 1, depth - 1) AS p, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), full_row AS (
  SELECT f.*, coalesce(n_children, 0) AS n_children FROM family f LEFT JOIN children USING (p)
), spread AS (
  SELECT p, own, n_children, unnest(range(depth + 1)) AS level FROM full_row
), below AS (
  SELECT list_slice(p, 1, level) AS p, sum(own) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM spread GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n AS n_convs, n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(ends) AS ends_sha256
FROM full_row JOIN below USING (p)
"""


@query("op13_prefix_trie", SQL)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie(rebuilt(conversation_turns(table(spark, sf_dir, "conversations"))))
