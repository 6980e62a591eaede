"""Near-duplicates by SimHash, with candidates from the pigeonring filter.

A fingerprint has 64 bits, one per bit of the shingles' hashes: set if it is set in over half of them. The
ring of bits is cut into ``distance + 1`` segments. If two fingerprints differ in at most ``distance`` bits,
then from some segment on every chain of consecutive segments stays within its share of the budget: the
first segment differs in none, the first two in at most ``floor(2 * distance / segments)`` bits, and so on
round the ring. So fingerprints meet by the value of one segment, for each segment in turn; where they meet,
the next segment is matched through an index of its values within the chain's budget, longer chains prune
what is left, and only then the Hamming distance is taken.

Equal fingerprints are one node. Where more than ``tile`` distinct ones share a segment they are dealt into
tiles, and every pair of tiles is a task of its own. A task emits a spanning forest of its links, never all
pairs; connected components finish the job.

Inputs: documents (doc_id, text). Cases: null or empty text, or white space only, has fingerprint zero and
links like any other; fewer words than a shingle make one shingle of them all; a null doc_id gets its
fingerprint and component like any row but never names a component that has ids; repeated rows give one
row each; other columns are kept by ``keep_first`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import released, stored, table, with_row_key
from ticketloom.llm.components import components, forest
from ticketloom.llm.registry import query

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Distinct fingerprints that one task holds of those that share a segment.
TILE = 1 << 17
_BATCH = 1_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()  # of each word and the space behind it
    hashes = np.fromiter(
        (digest(line[s : e - 1], SEED) for s, e in zip([0, *ends], ends[min(shingle, len(words)) - 1 :])), np.uint64, n
    )
    bits = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 65_536):
        part = np.unpackbits(hashes[lo : lo + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view(np.int64)[0])


def _fingerprints(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        marks = []
        for lo in range(0, batch.num_rows, _BATCH):
            marks += [fingerprint(t, shingle) for t in texts.slice(lo, _BATCH).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_key"), batch.column("doc_id"), pa.array(marks, pa.int64())],
            names=["row_key", "doc_id", "mark"],
        )


def segments(distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(first bit, bits) of the ring's segments, one more than ``distance``."""
    m = distance + 1
    edges = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _near(width: int, most: int) -> np.ndarray:
    """All patterns of ``width`` bits with at most ``most`` set."""
    out = np.array([0], dtype=np.int64)
    for _ in range(most):
        out = np.unique(np.concatenate([out, (out[:, None] | (1 << np.arange(width))[None, :]).ravel()]))
    return out


def links_at(marks: np.ndarray, other: np.ndarray, start: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into marks, into other) within ``distance`` that differ in no bit of segment ``start``.

    The chain filter decides which pairs get the full check; pairs are made in blocks of bounded size.
    """
    ring = segments(distance)
    m = len(ring)
    budget = [distance * (i + 1) // m for i in range(m)]
    a, b = marks.view(np.uint64), other.view(np.uint64)
    part = lambda x, i: ((x >> np.uint64(ring[i % m][0])) & np.uint64((1 << ring[i % m][1]) - 1)).astype(np.int64)
    values = part(b, start + 1)
    order = np.argsort(values, kind="stable")
    values = values[order]
    mine = part(a, start + 1)
    for pattern in _near(ring[(start + 1) % m][1], budget[1] if m > 1 else 0).tolist():
        lo = np.searchsorted(values, mine ^ pattern, side="left")
        count = np.searchsorted(values, mine ^ pattern, side="right") - lo
        total = np.cumsum(count)
        cuts = np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, 4_000_000), side="right")
        for s, e in zip(cuts, [*cuts[1:], len(a)]):
            n = count[s:e]
            i = np.repeat(np.arange(s, e), n)
            j = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[s:e], n)]
            off = np.bitwise_count(part(a[i], start + 1) ^ part(b[j], start + 1)).astype(np.int64)
            for step in range(2, m):
                off += np.bitwise_count(part(a[i], start + step) ^ part(b[j], start + step))
                keep = off <= budget[step]
                i, j, off = i[keep], j[keep], off[keep]
            near = np.bitwise_count(a[i] ^ b[j]) <= distance
            yield i[near], j[near]


def _linked(distance: int, key: tuple, group: pa.Table) -> pa.Table:
    marks = group["mark"].to_numpy()
    left = group["left"].to_numpy(zero_copy_only=False)
    start = key[0].as_py()
    mine, other = (marks[left], marks[~left]) if not left.all() else (marks, marks)
    a, b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for i, j in links_at(mine, other, start, distance):
        x, y = mine[i], other[j]
        apart = x != y
        a, b = np.concatenate([a, x[apart]]), np.concatenate([b, y[apart]])
        if len(a) > 4_000_000:
            a, b = forest(a, b)
    a, b = forest(a, b)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_links(marks: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect whatever links within ``distance``.

    ``marks`` has one column ``mark`` of distinct values. Segments have at most 2**ceil(64 / (distance + 1))
    values each, which bounds the table of group sizes.
    """
    ring = segments(distance)
    value = [F.shiftrightunsigned("mark", a).bitwiseAND(F.lit((1 << n) - 1)) for a, n in ring]
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), v.alias("value")) for i, v in enumerate(value)]))
    rows = marks.select("mark", at.alias("at")).select("mark", "at.segment", "at.value")
    sizes = rows.groupBy("segment", "value").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select("segment", "value", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    if max(n for _, n in ring) <= 13:  # at most 5 * 2**13 rows
        sizes = F.broadcast(sizes)
    mine = F.pmod(F.xxhash64("mark"), F.col("tiles")).cast("int")
    dealt = rows.join(sizes, ["segment", "value"]).withColumn("mine", mine)
    # a tile meets itself and every other one; in a meeting of two, the lower one is "left"
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high")
    met = dealt.select("segment", "value", low, high, "mark", (F.col("mine") == F.least("mine", "other")).alias("left"))
    return met.groupBy("segment", "value", "low", "high").applyInArrow(
        lambda k, t: _linked(distance, k, t), "a long, b long"
    )


def _roots(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Stored (row_key, doc_id, mark) of every row, and (mark, root) of marks that link to others."""
    source = docs.select("row_key", F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(
        source.mapInArrow(lambda it: released(_fingerprints(shingle, it)), "row_key long, doc_id long, mark long")
    )
    edges = near_links(rows.select("mark").distinct(), distance)
    roots = components(edges).withColumnsRenamed({"node": "mark", "component": "root"})
    return rows, roots


def _near_duplicates(keyed: DataFrame, shingle: int, distance: int) -> DataFrame:
    """(row_key, doc_id, fingerprint, root, component_id) of rows (row_key, doc_id, text)."""
    rows, roots = _roots(keyed, shingle, distance)
    # per fingerprint first: copies shrink to one row before anything is joined
    least = rows.groupBy("mark").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots, "mark", "left").withColumn("root", F.coalesce("root", "mark"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(rooted.join(names, "root").select("mark", "root", "component_id"))
    shown = F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint")
    return rows.join(named, "mark").select("row_key", "doc_id", shown, "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row: doc_id, fingerprint (hexadecimal), root, component_id (smallest doc_id reachable).

    ``root`` names the component by its smallest fingerprint, also where all its doc_ids are null.
    """
    keyed = with_row_key(docs.select("doc_id", "text"))
    return _near_duplicates(keyed, shingle, distance).drop("row_key")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near-duplicates, all columns: the one with the smallest doc_id.

    Among rows of one doc_id any may stay. Only ids and roots are moved to find the rows that go.
    """
    keyed = stored(with_row_key(docs.select(F.struct("*").alias("row"))))
    found = _near_duplicates(keyed.select("row_key", "row.doc_id", "row.text"), shingle, distance)
    found = stored(found.select("row_key", "doc_id", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first")
    # stored, so that Spark shuffles both sides of the join and can split the rows of a large group
    kept = stored(found.groupBy("root").agg(first).select("root", F.col("first.row_key").alias("kept")))
    gone = found.join(kept, "root").where("row_key <> kept").select("row_key")
    return keyed.join(gone, "row_key", "left_anti").select("row.*")


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
