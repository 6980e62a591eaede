"""Exact top-k inner products, by tiles of queries and shards.

Queries are dealt into blocks and all vectors into shards; every pair of a block and a shard is one tile: a
matrix product in a task, of which only each query's ``k`` best leave the task. The lists of a query are
then merged up a tree: ``FAN_IN`` shards' lists at a time, until one is left.

Vectors are compared as integers, floor(scale * component). Products are exact: floating point is used only
where every partial sum stays below 2**53, Python integers elsewhere; scores beyond a long are clipped to it.

Inputs: vectors (vec_id, embedding). Cases: rows with a null vec_id, a null vector, or a null, infinite or NaN
component take no part; shorter vectors count as if filled with zeros; rows that repeat a vec_id count once,
with the smallest of their vectors; with fewer candidates than ``k`` all are returned; equal scores rank by
the smaller vec_id; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import buckets_for, stored, table
from ticketloom.llm.registry import query

K = 10
SCALE = 1024
QUERY_EVERY = 100
#: Rows of a shard and of a block of queries, and shards at least, so that small tables use all cores too.
SHARD, BLOCK, LEAST_SHARDS = 16_384, 65_536, 64
FAN_IN = 16
_CHUNK = 512
_RESULT = "query_id long, shard int, vec_id long, score long"


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in rising order, one row each, and their vectors as doubles, filled with zeros to one width."""
    lists = rows["embedding"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    width = int(size.max(initial=0))
    flat = np.zeros((len(size), width))
    flat[np.arange(width) < size[:, None]] = lists.flatten().to_numpy()
    ids = rows["vec_id"].to_numpy()
    order = np.lexsort((*flat.T[::-1], ids))
    first = np.append(True, np.diff(ids[order]) != 0)[: len(ids)]
    return ids[order][first], flat[order][first]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as longs (object rows are rounded into the range of a long)."""
    width = max(a.shape[1], b.shape[1], 1)
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < 2.0**53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], dtype=object) @ np.array([[int(x) for x in r] for r in b], dtype=object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _tile(k: int, scale: int, key: tuple, group: pa.Table) -> pa.Table:
    is_query = group["is_query"]
    query_ids, queries = _matrix(group.filter(is_query))
    ids, vectors = _matrix(group.filter(pa.compute.invert(is_query)))
    queries, vectors = np.floor(queries * scale), np.floor(vectors * scale)
    out = []
    for lo in range(0, len(query_ids), _CHUNK):
        block = query_ids[lo : lo + _CHUNK]
        scores = _products(queries[lo : lo + _CHUNK], vectors)
        own = block[:, None] == ids[None, :]
        n = min(k + 1, len(ids))  # one more, as the query itself may be among them
        for i in range(len(block)):
            row = scores[i]
            least = np.partition(row, len(ids) - n)[len(ids) - n] if n else 0
            some = np.flatnonzero((row >= least) & ~own[i])
            best = some[np.argsort(-row[some].astype(object) if row.min(initial=0) == -(2**63) else -row[some], kind="stable")][:k]
            out.append((np.full(len(best), block[i]), ids[best], row[best]))
    parts = [np.concatenate([x[j] for x in out]) if out else np.zeros(0, dtype=np.int64) for j in range(3)]
    shard = np.full(len(parts[0]), key[1].as_py(), dtype=np.int32)
    return pa.table([parts[0], shard, parts[1], parts[2]], names=["query_id", "shard", "vec_id", "score"])


def _best(lists: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy("query_id", *by).orderBy(F.col("score").desc(), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for every row where ``is_query`` holds."""
    whole = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = stored(rows.where(F.col("vec_id").isNotNull() & whole))
    asked = rows.where("is_query")
    shards = buckets_for(rows.count(), shard, LEAST_SHARDS)
    blocks = buckets_for(asked.count(), block)
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    tiles = rows.select(
        every(blocks).alias("block"), place(shards).alias("shard"), F.lit(False).alias("is_query"), "vec_id", "embedding"
    ).unionByName(
        asked.select(
            place(blocks).alias("block"), every(shards).alias("shard"), F.lit(True).alias("is_query"), "vec_id", "embedding"
        )
    )
    lists = tiles.groupBy("block", "shard").applyInArrow(lambda key, t: _tile(k, scale, key, t), _RESULT)
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        lists = _best(lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int")), k, "shard").drop("rank")
    return _best(lists, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.v, e.v) AS BIGINT) AS score
  FROM v q JOIN v e ON q.vec_id <> e.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""


@query("op4_top_k", SQL)
def op4_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % QUERY_EVERY == 0)
