"""Exact and approximate nearest-neighbour retrieval for a table of queries.

Queries and documents meet block by block: a task multiplies one block of query vectors with one
block of document vectors and emits only the rows asked for, so pairs are never materialised. The
side below a row bound is broadcast and the other one stays where it is; if neither is, both are
hashed into a grid of blocks, sized per group from counted rows. A side has few blocks, so what is
shuffled grows with the input; a task holds the queries of its block, and the documents pass by.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ticketloom import constants as K
from ticketloom.functions import vectors
from ticketloom.operators.ordering import hash_fraction
from ticketloom.operators.skew import is_small, skew_join
from ticketloom.operators.windows import top_k, top_k_per_query
from ticketloom.session import cut_lineage

MAX_BROADCAST = 4096
QUERY_BLOCK = 16384
DOC_BLOCK = 65536
PAIR_BLOCK = 1024
#: A side of the grid is cut into so many blocks at most, unless a block would hold more than BLOCK_ROWS vectors.
MAX_BLOCKS, BLOCK_ROWS = 16, 65536
#: Queries and documents multiplied at once, and rows of a batch that leaves a task.
CHUNK, DOC_TILE, OUT_ROWS = 256, 4096, 65536
#: Distances are compared after rounding to 9 digits.
ROUNDING = 1e-9


def _unit_rows(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / np.sqrt((m * m).sum(axis=1))[:, None]


def _matrix(column: pd.Series) -> np.ndarray:
    return _unit_rows(np.stack(column.to_numpy()))


def _vectors(column: pa.ListArray) -> np.ndarray:
    """Unit vectors of an Arrow column of arrays of one length."""
    width = pc.max(pc.list_value_length(column)).as_py() or 0
    if pc.min(pc.list_value_length(column)).as_py() != width:
        raise ValueError("vectors have different lengths")
    return _unit_rows(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width))


class Search:
    """Queries of one block, and what is known of them after the documents given so far.

    With ``k`` the nearest documents of each query, ties by document id; else every pair at most ``max_distance``
    apart. Single-precision products, whose error is bounded, rule out most documents; the others are measured
    in double precision. Vectors without a direction take no part.
    """

    def __init__(self, qids: np.ndarray, q: np.ndarray, k: int | None, max_distance: float = 2.0, reach=None, lists=None):
        known = np.isfinite(q).all(axis=1)
        self.qids, self.q, self.k, self.max_distance = qids[known], q[known], k, max_distance
        self.lists = None if lists is None else lists[known]
        self.narrow = self.q.astype(np.float32)
        # a product of n single-precision terms of unit vectors is off by n units in the last place at most
        self.error = (q.shape[1] + 4) * 2.0**-23
        if k is None:
            self.floor = np.full(len(self.q), 1.0 - max_distance - self.error)
            return
        self.floor = np.full(len(self.q), -np.inf)
        if reach is not None:
            self.floor = 1.0 - reach[known] - 2 * ROUNDING - self.error
        self.key, self.distance = np.full((len(self.q), k), np.inf), np.full((len(self.q), k), np.inf)
        self.ids = None

    def add(self, dids: np.ndarray, d: np.ndarray, list_id: int | None = None) -> Iterator[tuple]:
        """Takes documents, all of one list if there are lists; gives the pairs found if all are wanted."""
        known = np.isfinite(d).all(axis=1)
        dids, d = dids[known], d[known]
        rows = np.arange(len(self.q))
        if self.lists is not None:  # one bit per list
            rows = np.flatnonzero(self.lists[:, list_id >> 3] >> (list_id & 7) & 1)
        if self.k is not None and self.ids is None:
            self.ids = np.zeros((len(self.q), self.k), dtype=dids.dtype)
        for at in range(0, len(dids), DOC_TILE):
            ids, exact = dids[at : at + DOC_TILE], d[at : at + DOC_TILE]
            narrow = exact.astype(np.float32).T
            for start in range(0, len(rows), CHUNK):
                found = self._tile(rows[start : start + CHUNK], exact, narrow)
                if found is None:
                    continue
                own, cols, distance = found
                if self.k is None:
                    near = distance <= self.max_distance
                    yield self.qids[own[near]], ids[cols[near]], distance[near]
                else:
                    self._keep(own, ids[cols], distance)

    def _tile(self, rows: np.ndarray, exact: np.ndarray, narrow: np.ndarray) -> tuple | None:
        """Query row, document row and distance of the pairs that may count."""
        cosine = self.narrow[rows] @ narrow
        floor, n = self.floor[rows], len(exact)
        fresh = np.isneginf(floor)
        if fresh.any() and n > self.k:
            floor[fresh] = np.partition(cosine[fresh], n - self.k, axis=1)[:, n - self.k] - 2 * self.error - 2 * ROUNDING
        places = np.flatnonzero(cosine >= floor.astype(np.float32)[:, None])
        if not len(places):
            return None
        r, c = np.divmod(places, n)
        if len(places) > cosine.size // 64:
            return rows[r], c, 1.0 - (self.q[rows] @ exact.T)[r, c]
        return rows[r], c, 1.0 - np.einsum("ij,ij->i", self.q[rows[r]], exact[c])

    def _keep(self, own: np.ndarray, ids: np.ndarray, distance: np.ndarray) -> None:
        touched = np.unique(own)
        old, place = np.nonzero(np.isfinite(self.key[touched]))
        old = touched[old]
        rows = np.concatenate([old, own])
        key = np.concatenate([self.key[old, place], np.round(distance, 9)])
        ids = np.concatenate([self.ids[old, place], ids])
        distance = np.concatenate([self.distance[old, place], distance])
        order = np.lexsort((ids, key, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        rows, rank, order = rows[rank < self.k], rank[rank < self.k], order[rank < self.k]
        self.key[rows, rank], self.ids[rows, rank], self.distance[rows, rank] = key[order], ids[order], distance[order]
        last = self.key[touched, -1]
        full = np.isfinite(last)
        self.floor[touched[full]] = np.maximum(self.floor[touched[full]], 1.0 - last[full] - 2 * ROUNDING - self.error)

    def finish(self) -> Iterator[tuple]:
        if self.k is not None and self.ids is not None:
            for start in range(0, len(self.q), OUT_ROWS):
                part = slice(start, start + OUT_ROWS)
                rows, place = np.nonzero(np.isfinite(self.key[part]))
                yield self.qids[part][rows], self.ids[part][rows, place], self.distance[part][rows, place]


def _out_schema(queries: DataFrame, docs: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", queries.schema["qid"].dataType),
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _tables(found: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of some ``OUT_ROWS`` rows from arrays of any length."""
    held, n = [], 0
    for arrays in found:
        held.append(arrays)
        n += len(arrays[0])
        if n >= OUT_ROWS:
            yield _batch(held, schema)
            held, n = [], 0
    if n:
        yield _batch(held, schema)


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [np.concatenate(arrays) for arrays in zip(*held)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, schema)], schema=schema)


def _runs(batch: pa.RecordBatch, by: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows that are equal in some columns."""
    changed = np.zeros(max(0, len(batch) - 1), dtype=bool)
    for name in by:
        codes = batch[name].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        changed |= codes[1:] != codes[:-1]
    ends = [0, *(np.flatnonzero(changed) + 1).tolist(), len(batch)]
    yield from zip(ends, ends[1:])


def _ids(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Table]]:
    """Rows of a batch by their group."""
    ordered = pa.Table.from_batches([batch]).sort_by("group").combine_chunks().to_batches()
    for part in ordered:
        for lo, hi in _runs(part, ["group"]):
            yield part["group"][lo].as_py(), part.slice(lo, hi - lo)


def _shared_blocks(local: pd.DataFrame, id_col: str, spark: SparkSession):
    blocks = {g: (part[id_col].to_numpy(), _matrix(part["embedding"])) for g, part in local.groupby("group")}
    return spark.sparkContext.broadcast(blocks)


def _with_broadcast_docs(queries: DataFrame, local: pd.DataFrame, wanted, schema) -> DataFrame:
    """Few documents: every batch of queries meets all of them, so its hits are final."""
    shared, arrow = _shared_blocks(local, "doc_id", queries.sparkSession), to_arrow_schema(schema)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for g, part in _by_group(batch):
                if g in shared.value:
                    search = Search(_ids(part["qid"]), _vectors(part["embedding"]), *wanted)
                    yield from search.add(*shared.value[g])
                    yield from search.finish()

    return queries.mapInArrow(lambda batches: _tables(found(batches), arrow), schema)


def _with_broadcast_queries(docs: DataFrame, local: pd.DataFrame, wanted, schema) -> DataFrame:
    """Few queries: a task keeps the running best of the documents it reads.

    The number of tasks follows the splits of the documents. Each emits up to k rows per query, which the
    top-k window that follows cuts again inside its tasks before anything is shuffled.
    """
    shared, arrow = _shared_blocks(local, "qid", docs.sparkSession), to_arrow_schema(schema)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        searches = {}
        for batch in batches:
            for g, part in _by_group(batch):
                if g not in shared.value:
                    continue
                if g not in searches:
                    searches[g] = Search(*shared.value[g], *wanted)
                yield from searches[g].add(_ids(part["doc_id"]), _vectors(part["embedding"]))
        for search in searches.values():
            yield from search.finish()

    return docs.mapInArrow(lambda batches: _tables(found(batches), arrow), schema)


def _blocks(rows: Column, size: int) -> Column:
    """Blocks of ``size`` rows, larger ones where that makes more than ``MAX_BLOCKS``, up to ``BLOCK_ROWS`` rows each.

    A row is sent once per block of the other side, so this bounds what is shuffled by a multiple of the input.
    """
    blocks = F.greatest(F.least(F.ceil(rows / size), F.lit(MAX_BLOCKS)), F.ceil(rows / BLOCK_ROWS))
    return F.greatest(blocks, F.lit(1)).cast("int")


CELL = ["group", "q_block", "d_block"]


def _met(q: DataFrame, d: DataFrame, n_cells: int, wanted, schema) -> DataFrame:
    """Queries and documents of each cell: the queries are held, the documents pass by in batches.

    ``q`` may have ``lists``, a bit per list, and ``reach``; ``d`` then has the ``list_id``, by which it is sorted.
    """
    extra = {f.name: f.dataType for f in [*q.schema.fields, *d.schema.fields] if f.name not in (*CELL, "embedding")}
    kinds = {q.schema["embedding"].dataType.simpleString(), d.schema["embedding"].dataType.simpleString()}
    vector = kinds.pop() if len(kinds) == 1 else "array<double>"

    def side(df: DataFrame, number: int) -> DataFrame:
        others = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in extra.items()]
        return df.select(*CELL, F.lit(number).cast("byte").alias("side"), *others, F.col("embedding").cast(vector).alias("embedding"))

    spark, by_list, arrow = q.sparkSession, ["list_id"] if "list_id" in extra else [], to_arrow_schema(schema)
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    both = side(q, 0).unionByName(side(d, 1)).repartition(max(1, min(2 * n_cells, most)), *CELL)
    ordered = both.sortWithinPartitions(*CELL, "side", *by_list)

    def begun(held: list[pa.RecordBatch]) -> Search:
        part = pa.Table.from_batches(held).combine_chunks()
        column = {c: part[c].combine_chunks() for c in part.column_names}
        more = {}
        if "reach" in column:
            more["reach"] = _ids(column["reach"])
        if "lists" in column:
            more["lists"] = np.stack([np.frombuffer(x, dtype=np.uint8) for x in column["lists"].to_pylist()])
        return Search(_ids(column["qid"]), _vectors(column["embedding"]), *wanted, **more)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cell, held, search = None, [], None
        for batch in batches:
            for lo, hi in _runs(batch, [*CELL, "side", *by_list]):
                part = batch.slice(lo, hi - lo)
                here = tuple(part[c][0].as_py() for c in CELL)
                if here != cell:
                    if search is not None:
                        yield from search.finish()
                    cell, held, search = here, [], None
                if part["side"][0].as_py() == 0:
                    held.append(part)
                elif search is not None or held:
                    if search is None:
                        search, held = begun(held), []
                    own = [part["list_id"][0].as_py()] if by_list else []
                    yield from search.add(_ids(part["doc_id"]), _vectors(part["embedding"]), *own)
        if search is not None:
            yield from search.finish()

    return ordered.mapInArrow(lambda batches: _tables(found(batches), arrow), schema)


def _with_grid(queries, docs, wanted, schema, query_block, doc_block) -> DataFrame:
    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        return df.groupBy("group").agg(_blocks(F.count("*"), size).alias(name))

    sizes = blocks(queries, query_block, "q_blocks").join(blocks(docs, doc_block, "d_blocks"), "group")
    # one row per group
    sizes = cut_lineage(sizes)
    small = is_small(sizes)
    n_cells = sizes.agg(F.sum(F.col("q_blocks").cast("bigint") * F.col("d_blocks"))).first()[0] or 1

    def cells(df: DataFrame, id_col: str, own: str, other: str) -> DataFrame:
        spread = F.pmod(F.xxhash64(id_col), F.col(f"{own}_blocks")).cast("int")
        joined = df.join(F.broadcast(sizes), "group") if small else skew_join(df, sizes, ["group"], "inner", [id_col])
        return joined.select(
            id_col,
            "embedding",
            "group",
            spread.alias(f"{own}_block"),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
        )

    return _met(cells(queries, "qid", "q", "d"), cells(docs, "doc_id", "d", "q"), n_cells, wanted, schema)


def _meet(queries, docs, wanted, group, max_broadcast, query_block, doc_block) -> DataFrame:
    """``wanted`` is (k,) or (None, max_distance)."""
    label = F.col(group).cast("string") if group else F.lit("all")
    q = queries.select("qid", "embedding", label.alias("group")).where(F.col("embedding").isNotNull())
    d = docs.select("doc_id", "embedding", label.alias("group")).where(F.col("embedding").isNotNull())
    if group:
        q, d = q.where(F.col("group").isNotNull()), d.where(F.col("group").isNotNull())
    schema = _out_schema(queries, docs)
    if max_broadcast:
        # bounded: at most max_broadcast + 1 vectors of a side reach the driver
        local = q.limit(max_broadcast + 1).toPandas()
        if len(local) <= max_broadcast:
            return _with_broadcast_queries(d, local, wanted, schema)
        local = d.limit(max_broadcast + 1).toPandas()
        if len(local) <= max_broadcast:
            return _with_broadcast_docs(q, local, wanted, schema)
    return _with_grid(q, d, wanted, schema, query_block, doc_block)


def _scored(hits: DataFrame) -> DataFrame:
    return hits.select(
        "qid", "rank", "doc_id", "distance", vectors.similarity_score(F.col("distance")).alias("similarity")
    )


def retrieve(
    queries: DataFrame,
    docs: DataFrame,
    k: int = K.TOP_K,
    group: str | None = None,
    max_broadcast: int = MAX_BROADCAST,
    query_block: int = QUERY_BLOCK,
    doc_block: int = DOC_BLOCK,
) -> DataFrame:
    """Exact top ``k`` by cosine distance: (qid, rank, doc_id, distance, similarity).

    ``queries`` has qid and embedding, ``docs`` doc_id and embedding. With ``group``, a column of both,
    a query sees only documents of its own group.
    """
    found = _meet(queries, docs, (k,), group, max_broadcast, query_block, doc_block)
    return _scored(top_k_per_query(found, k))


def retrieve_filtered(queries: DataFrame, docs: DataFrame, group: str, k: int = K.TOP_K, **kw) -> DataFrame:
    return retrieve(queries, docs, k, group, **kw)


def query_doc_pairs(
    queries: DataFrame,
    docs: DataFrame,
    max_distance: float,
    group: str | None = None,
    max_broadcast: int = MAX_BROADCAST,
    block: int = PAIR_BLOCK,
) -> DataFrame:
    """Every (qid, doc_id, distance) at most ``max_distance`` apart; nothing else leaves a task."""
    return _meet(queries, docs, (None, max_distance), group, max_broadcast, block, block)


def threshold(hits: DataFrame, similarity: float = K.SIMILARITY_THRESHOLD) -> DataFrame:
    """Hits that are similar enough.

    Fetching 2k, filtering and keeping k gives the same rows as filtering the first k, because both
    the cut and the rank follow the distance; so callers fetch k.
    """
    return hits.where(F.col("distance") <= vectors.max_distance(similarity))


def retrieve_with_fallback(
    queries: DataFrame,
    docs: DataFrame,
    group: str,
    k: int = K.TOP_K,
    similarity: float = K.SIMILARITY_THRESHOLD,
    min_hits: int = 2,
    content: str | None = None,
    **kw,
) -> DataFrame:
    """Hits within the query's group; queries with fewer than ``min_hits`` are filled up from all documents.

    Adds ``stage`` ('queue' or 'global'). ``content`` names the document column that must not repeat
    in the filled part; by default the document id.
    """
    near = cut_lineage(threshold(retrieve(queries, docs, k, group, **kw), similarity))
    enough = near.groupBy("qid").agg(F.count("*").alias("n")).where(F.col("n") >= min_hits)
    short = queries.join(enough, "qid", "left_anti")
    wide = threshold(retrieve(short, docs, k, **kw), similarity)
    both = near.withColumn("stage", F.lit("queue")).unionByName(wide.withColumn("stage", F.lit("global")))
    merged = both.withColumn("content", F.col("doc_id"))
    if content is not None:  # texts are compared by their hash, in one narrow lookup
        keys = docs.select("doc_id", F.sha2(F.col(content), 256).alias("content"))
        merged = both.join(keys, "doc_id", "left")
    # of one content a query keeps all hits of its class, or else the nearest of the others
    copy = Window.partitionBy("qid", "content").orderBy(F.desc("stage"), "rank")
    merged = merged.withColumn("__copy", F.row_number().over(copy)).where("stage = 'queue' or __copy = 1").drop("__copy")
    return top_k(merged, ["qid"], [F.desc("stage"), F.col("rank")], k, "position").select(
        "qid", F.col("position").alias("rank"), "doc_id", "distance", "similarity", "stage"
    )


def merge_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """``first`` as it is, then the rows of ``second`` whose content the query does not have yet."""
    fresh = second.join(first.select("qid", "content"), ["qid", "content"], "left_anti")
    fresh = top_k(fresh, ["qid", "content"], [F.col("rank")], 1, "__copy").drop("__copy")
    return first.unionByName(fresh)


def context_of(hits: DataFrame, queries: DataFrame, content: str = "content") -> DataFrame:
    """Per query the contents of its hits in rank order, parted by a blank line, or the fixed notice.

    Hits are already cut to k per query, so the collected list is short.
    """
    listed = F.sort_array(F.collect_list(F.struct("rank", F.col(content).alias("content"))))
    texts = hits.groupBy("qid").agg(
        F.array_join(F.transform(listed, lambda h: h["content"]), "\n\n").alias("context")
    )
    joined = queries.select("qid").join(texts, "qid", "left")
    return joined.select("qid", F.coalesce("context", F.lit(K.NO_CONTEXT)).alias("context"))


MAX_LISTS = 65_536
ROWS_PER_CENTRE = 256
#: Share of the true hits that the fitted number of lists has to hold, and the most queries it is fitted on.
RECALL, FIT_QUERIES = 0.95, 512
#: Added to angles, which near 0 are known to some 1e-8 only.
SLACK = 1e-6


@dataclass
class AnnIndex:
    """Documents with their inverted list, and what is known of the lists.

    ``centers`` are unit vectors, ``radii`` the largest angle between a centre and a document of its list (below
    zero for an empty list), ``sizes`` the documents of each list. ``nprobe`` lists held the share ``recall`` of the exact hits of a bounded sample.
    """

    docs: DataFrame
    centers: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    nprobe: int
    recall: float


def _unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1)[:, None]
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _present(df: DataFrame) -> DataFrame:
    length = vectors.norm(F.col("embedding"))
    return df.where(F.col("embedding").isNotNull() & (length > 0) & (length < float("inf")))


def _with_list(docs: DataFrame, centers: np.ndarray) -> DataFrame:
    """Adds the list with the nearest centre and the angle to it."""
    shared = docs.sparkSession.sparkContext.broadcast(centers)

    @F.pandas_udf("list_id int, angle double")
    def nearest(v: pd.Series) -> pd.DataFrame:
        cosine = _matrix(v) @ shared.value.T
        best = cosine.argmax(axis=1)
        angle = np.arccos(np.clip(cosine[np.arange(len(best)), best], -1.0, 1.0))
        return pd.DataFrame({"list_id": best.astype("int32"), "angle": angle})

    placed = docs.withColumn("__near", nearest("embedding"))
    return placed.withColumns({"list_id": F.col("__near.list_id"), "__angle": F.col("__near.angle")}).drop("__near")


def _probes(docs: DataFrame, centers: np.ndarray, k: int, target: float, seed: int, queries: DataFrame | None):
    """The least number of lists that holds the share ``target`` of the exact hits of some queries, and that share.

    Without queries, documents stand in for them; they are not hits of their own. At most ``FIT_QUERIES`` vectors
    and ``k`` hits of each reach the driver.
    """
    own = queries is None
    asked = docs.select(F.col("doc_id").alias("qid"), "embedding") if own else _present(queries.select("qid", "embedding"))
    asked = cut_lineage(asked.orderBy(F.xxhash64("qid", F.lit(seed))).limit(FIT_QUERIES))
    hits = retrieve(asked, docs, k + own)
    if own:
        hits = top_k_per_query(hits.where(F.col("qid") != F.col("doc_id")).drop("rank"), k)
    held = hits.select("qid", "doc_id").join(docs.select("doc_id", "list_id"), "doc_id").select("qid", "list_id").toPandas()
    if held.empty:
        return len(centers), 1.0
    local = asked.toPandas()
    place = np.argsort(np.argsort(-(_matrix(local["embedding"]) @ centers.T), axis=1), axis=1)
    row = pd.Series(np.arange(len(local)), index=local["qid"].to_numpy())[held["qid"].to_numpy()].to_numpy()
    needed = np.sort(place[row, held["list_id"].to_numpy()] + 1)
    probes = int(needed[max(0, int(np.ceil(target * len(needed))) - 1)])
    return probes, float((needed <= probes).mean())


def ann_index(
    docs: DataFrame,
    lists: int | None = None,
    seed: int = 42,
    iterations: int = 20,
    train_share: float | None = None,
    k: int = K.TOP_K,
    recall: float = RECALL,
    queries: DataFrame | None = None,
) -> AnnIndex:
    """Inverted lists by k-means on the unit sphere; the assigned documents are stored once.

    The number of lists is the square root of the number of documents, up to ``MAX_LISTS``. Centres are
    learnt from about ``ROWS_PER_CENTRE`` documents each, unless a share is given; all documents are indexed. The
    number of lists a search probes is fitted: the least that holds the share ``recall`` of the exact ``k`` hits
    of at most ``FIT_QUERIES`` queries (documents, if no queries are given).
    """
    prepared = _present(docs)
    total = docs.count()
    lists = lists or max(2, min(MAX_LISTS, round(total**0.5)))
    if train_share is None:
        train_share = ROWS_PER_CENTRE * lists / max(1, total)
    sample = prepared if train_share >= 1.0 else prepared.where(hash_fraction("doc_id", seed) < train_share)
    dense = sample.select(array_to_vector("embedding").alias("__vector"))
    unit = Normalizer(p=2.0, inputCol="__vector", outputCol="__unit").transform(dense)
    kmeans = KMeans(k=lists, seed=seed, maxIter=iterations, featuresCol="__unit", predictionCol="__list")
    centers = _unit(np.array(kmeans.fit(unit.select("__unit")).clusterCenters()))
    placed = cut_lineage(_with_list(prepared, centers))
    radii, sizes = np.full(len(centers), -1.0), np.zeros(len(centers), dtype=np.int64)
    # one row per list
    for r in placed.groupBy("list_id").agg(F.max("__angle").alias("radius"), F.count("*").alias("n")).collect():
        radii[r.list_id], sizes[r.list_id] = r.radius, r.n
    stored = placed.drop("__angle")
    return AnnIndex(stored, centers, radii, sizes, *_probes(stored, centers, k, recall, seed, queries))


def _probed(queries: DataFrame, lists: Callable[[np.ndarray, np.ndarray], np.ndarray], reach: str | None = None) -> DataFrame:
    """Queries, once per list that ``lists`` marks for their vectors and the column ``reach``."""

    @F.pandas_udf("array<int>")
    def named(v: pd.Series, r: pd.Series) -> pd.Series:
        marked = lists(_matrix(v), r.to_numpy(dtype=np.float64))
        return pd.Series([np.flatnonzero(row).astype("int32") for row in marked])

    asked = _present(queries)
    far = F.col(reach) if reach else F.lit(0.0)
    return asked.select("qid", "embedding", F.explode(named("embedding", far)).alias("list_id"))


def _dealt(sizes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists dealt to blocks of like size, large ones in pieces: each list's first piece, its pieces, a piece's block."""
    pieces = np.maximum(1, -(-sizes * 4 * blocks // max(1, int(sizes.sum()))))
    first = np.cumsum(pieces) - pieces
    rows = np.repeat(sizes / pieces, pieces)
    owner = np.zeros(len(rows), dtype=np.int32)
    load = [(0.0, b) for b in range(blocks)]
    for piece in np.argsort(-rows, kind="stable"):
        total, block = heapq.heappop(load)
        owner[piece] = block
        heapq.heappush(load, (total + rows[piece], block))
    return first, pieces, owner


def _search_lists(
    queries: DataFrame, index: AnnIndex, k: int, lists: Callable[[np.ndarray, np.ndarray], np.ndarray], reach: str | None = None,
    max_broadcast: int = MAX_BROADCAST, query_block: int = QUERY_BLOCK, doc_block: int = DOC_BLOCK,
) -> DataFrame:
    """Top ``k`` of each query among the documents of the lists marked for it.

    A query is sent once to each block of lists it needs, with one bit per list, not once per list. ``reach`` names
    the distance beyond which hits do not matter.
    """
    schema = _out_schema(queries, index.docs)
    single = _probed(queries, lists, reach)
    if max_broadcast and is_small(single, max_broadcast):
        return _meet(single, index.docs, (k,), "list_id", max_broadcast, query_block, doc_block)
    asked = _present(queries)
    counts = asked.agg(F.count("*").alias("n")).select(_blocks(F.col("n"), query_block).alias("q"), _blocks(F.lit(int(index.sizes.sum())), doc_block).alias("d"))
    q_blocks, d_blocks = counts.first()
    spark = queries.sparkSession
    first, pieces, owner = _dealt(index.sizes, d_blocks)
    held = np.zeros((len(pieces), d_blocks), dtype=np.float32)
    held[np.repeat(np.arange(len(pieces)), pieces), owner] = 1.0
    places = spark.sparkContext.broadcast((first, pieces, owner))
    shared = spark.sparkContext.broadcast(held)

    @F.pandas_udf("blocks array<int>, lists binary")
    def sent(v: pd.Series, r: pd.Series) -> pd.DataFrame:
        m, far, blocks, bits = _matrix(v), r.to_numpy(dtype=np.float64), [], []
        for at in range(0, len(m), 1024):
            marked = lists(m[at : at + 1024], far[at : at + 1024])
            blocks += [np.flatnonzero(row).astype("int32") for row in marked.astype(np.float32) @ shared.value]
            bits += [row.tobytes() for row in np.packbits(marked, axis=1, bitorder="little")]
        return pd.DataFrame({"blocks": blocks, "lists": bits})

    @F.pandas_udf("int")
    def block(list_id: pd.Series, mark: pd.Series) -> pd.Series:
        start, n, own = places.value
        at = list_id.to_numpy()
        return pd.Series(own[start[at] + mark.to_numpy() % n[at]])

    far = F.col(reach) if reach else F.lit(0.0)
    group = F.lit("all").alias("group")
    named = asked.select("qid", "embedding", *([F.col(reach).alias("reach")] if reach else []), sent("embedding", far).alias("__sent"))
    q = named.select(
        *[c for c in named.columns if c != "__sent"], group, F.pmod(F.xxhash64("qid"), F.lit(q_blocks)).cast("int").alias("q_block"),
        F.col("__sent.lists").alias("lists"), F.explode("__sent.blocks").alias("d_block"),
    )
    mark = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    d = index.docs.select("doc_id", "embedding", "list_id", group, block("list_id", mark).alias("d_block"))
    d = d.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    return _met(q, d, q_blocks * d_blocks, (k,), schema)


def _nearest_lists(queries: DataFrame, index: AnnIndex, probes: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    shared = queries.sparkSession.sparkContext.broadcast(index.centers)

    def nearest(m: np.ndarray, _) -> np.ndarray:
        cosine = m @ shared.value.T
        marked = np.zeros(cosine.shape, dtype=bool)
        np.put_along_axis(marked, np.argsort(-cosine, axis=1, kind="stable")[:, :probes], True, axis=1)
        return marked

    return nearest


def ann_retrieve(queries: DataFrame, index: AnnIndex, k: int = K.TOP_K, nprobe: int | None = None, **kw) -> DataFrame:
    """Top ``k`` among the documents of the lists nearest to each query, as many as the index was fitted to."""
    probes = min(nprobe or index.nprobe, len(index.centers))
    found = _search_lists(queries, index, k, _nearest_lists(queries, index, probes), **kw)
    return _scored(top_k_per_query(found, k))


def _lists_in_reach(queries: DataFrame, index: AnnIndex, nprobe: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    shared = queries.sparkSession.sparkContext.broadcast((index.centers, index.radii))

    def within(m: np.ndarray, reach: np.ndarray) -> np.ndarray:
        centers, radii = shared.value
        cosine = np.clip(m @ centers.T, -1.0, 1.0)
        angle = np.arccos(np.clip(1.0 - reach, -1.0, 1.0))[:, None]
        open_lists = (np.arccos(cosine) - radii <= angle + SLACK) & (radii >= 0)
        seen = np.argsort(-cosine, axis=1, kind="stable")[:, :nprobe]
        np.put_along_axis(open_lists, seen, False, axis=1)
        return open_lists

    return within


def lists_within_reach(queries: DataFrame, index: AnnIndex, nprobe: int) -> DataFrame:
    """Queries by the lists beyond the first ``nprobe`` that can hold a document as near as ``reach``, a distance.

    A document of a list is at least the angle to its centre less the list's radius away, so all other lists can
    be left out without losing a hit.
    """
    return _probed(queries, _lists_in_reach(queries, index, nprobe), "reach")


def retrieve_bounded(queries: DataFrame, index: AnnIndex, k: int = K.TOP_K, nprobe: int | None = None, **kw) -> DataFrame:
    """Exact top ``k`` by the index: the nearest lists first, then only lists whose bound allows a nearer hit.

    The distance of the k-th hit so far is the reach of a query; one with fewer hits reaches everywhere.
    """
    probes = min(nprobe or index.nprobe, len(index.centers))
    first = cut_lineage(ann_retrieve(queries, index, k, probes, **kw))
    last = first.where(F.col("rank") == k).select("qid", F.col("distance").alias("reach"))
    reached = cut_lineage(queries.select("qid", "embedding").join(last, "qid", "left").fillna(2.0, ["reach"]))
    second = _search_lists(reached, index, k, _lists_in_reach(reached, index, probes), "reach", **kw)
    both = first.select("qid", "doc_id", "distance").unionByName(second.select("qid", "doc_id", "distance"))
    return _scored(top_k_per_query(both, k))


def recall_at_k(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact hits that the approximate search returned."""
    found = approximate.select("qid", "doc_id").withColumn("found", F.lit(1))
    joined = exact.select("qid", "doc_id").join(found, ["qid", "doc_id"], "left")
    return joined.agg(F.avg(F.coalesce("found", F.lit(0))).alias("recall"))
