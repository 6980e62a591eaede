"""Connected components of a graph that is only ever held as Spark tables.

Edges are first thinned inside tasks, where a union-find over whatever edges meet there replaces them by
stars. The rest is the alternation of large-star and small-star steps: every node links its larger (then
its smaller) neighbours to the smallest one it knows, until nothing changes. Each round is stored in the
shared folder, so a lost executor costs one round at most, and only a digest of the edges reaches the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import stored

_EDGE = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest reachable node) for the nodes that are not smallest themselves."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > 2_000_000:  # memory of a task; what is over goes out as a forest of its own
            yield _forest_batch(held)
            held, size = [], 0
    if held:
        yield _forest_batch(held)


def _forest_batch(held) -> pa.RecordBatch:
    a, b = forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a > b)."""
    both = edges
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b").distinct()
    out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return out.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node.

    ``edges`` has two long columns. Loops and repeated edges are allowed; rows with a null are no edges.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.mapInArrow(_thinned, _EDGE).distinct())
    digest = None
    while True:
        edges = stored(_star(_star(edges, large=True), large=False))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == digest or now[0] == 0:
            break
        digest = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(roots)
