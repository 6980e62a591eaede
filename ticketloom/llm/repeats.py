"""Exact repeated passages across documents, by hash classes at sparse places.

Of all suffixes only those at content-selected places are kept: a place is a minimiser if its run of
``ANCHOR`` words has the least hash among some ``least - ANCHOR + 1`` consecutive runs. Equal passages select
equal places, and every passage of ``least`` words has one, so every repeated passage meets at a suffix that
starts with the same ``ANCHOR`` words. Suffixes are grouped by a hash of these words, not sorted; only
those that another document has too go on. They are then compared left and right of the common words,
as classes and not pair by pair: each passage of ``least`` words round the place is hashed, equal hashes of
different texts are a match, and runs of matching passages join into the maximal match. So a passage that a
third of all documents share costs each of them its own words and no pairs. Equal texts are one suffix
source: they are compared once, and each of their documents repeats as a whole.

Inputs: documents (doc_id, text). Words lie between ASCII white space, A-Z count as a-z. Cases: null and
short texts have no passages; rows that repeat (doc_id, text) are one document, as are rows of equal text
and null doc_id, and repeats inside one document do not count; texts of any length are taken whole; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import stored, table, text_of
from ticketloom.llm.registry import query
from ticketloom.llm.words import MAX, grams, minimisers, mix, words_of

LEAST = 50
ANCHOR = 25
_BATCH = 1_000


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text); the key is a hash of the text, the same in every pass over the table."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("string").alias("text"))
    return named.select(F.xxhash64("text", F.octet_length("text")).alias("key"), "doc_id", "text")


def texts_at(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (one row per key) with the text of its key; copies meet inside tasks first."""
    return source.groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key")


def parts_of(batches: Iterator[pa.RecordBatch], rows: int = _BATCH) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _anchors(least: int, anchor: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, place, gram) of every anchor; and, with a null gram, the number of words as the place."""
    for part in parts_of(batches):
        words = words_of(part.column("text"))
        room = words.room
        runs = grams(words.hashes, anchor)
        values = np.where(room[: len(runs)] >= anchor, mix(runs, 3) | np.uint64(1), MAX)
        at = minimisers(values, room[: len(runs)] >= least, least - anchor + 1)
        size = np.diff(words.offsets)
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([part.column("key").take(pa.array(words.owner[at])), part.column("key")]),
                pa.array(np.concatenate([words.place[at], size]), pa.int32()),
                pa.concat_arrays([pa.array(runs[at].view(np.int64)), pa.nulls(len(size), pa.int64())]),
            ],
            names=["key", "place", "gram"],
        )


def _passages(least: int, anchor: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every passage of ``least`` words that contains one of the row's ``places``."""
    for part in parts_of(batches):
        words = words_of(part.column("text"))
        lists = part.column("places")
        owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        at = words.offsets[owner] + lists.flatten().to_numpy()
        low = np.maximum(at - (least - anchor), words.offsets[owner])
        turns = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        np.add.at(turns, low, 1)
        np.add.at(turns, at + 1, -1)
        runs = grams(words.hashes, least)
        start = np.flatnonzero((np.cumsum(turns)[: len(runs)] > 0) & (words.room[: len(runs)] >= least))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("key").take(pa.array(words.owner[start])),
                pa.array(words.place[start], pa.int32()),
                pa.array(runs[start].view(np.int64)),
            ],
            names=["key", "start", "gram"],
        )


def _runs(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal runs of a text's matching passages, with the least key among the others of each."""
    for batch in batches:
        out = []
        for key, groups in zip(batch.column("key").to_pylist(), batch.column("groups").to_pylist()):
            starts = np.concatenate([np.array(g["starts"], dtype=np.int64) for g in groups])
            others = np.repeat([g["other"] for g in groups], [len(g["starts"]) for g in groups])
            order = np.argsort(starts, kind="stable")
            starts, others = starts[order], others[order]
            first = np.flatnonzero(np.append(True, np.diff(starts) > 1))
            last = np.append(first[1:], len(starts)) - 1
            least_other = np.minimum.reduceat(others, first)
            out += [(key, int(a), int(b - a + least), int(o)) for a, b, o in zip(starts[first], starts[last], least_other)]
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in columns], names=["key", "start", "words", "other"]
        )


def _shared(rows: DataFrame) -> DataFrame:
    """(gram, lo, hi): the least and the greatest text of each gram that several have."""
    return rows.groupBy("gram").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi")


def repeated_passages(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, start, words, other_id): maximal passages of at least ``least`` words found in another document.

    ``start`` counts words before the passage; ``other_id`` is one other document that has part of it, or,
    for a text that several documents have, another of them.
    """
    source = keyed_texts(docs)
    anchors = stored(
        source.select("key", "text").mapInArrow(lambda it: _anchors(least, anchor, it), "key long, place int, gram long")
    )
    suffixes = anchors.where(F.col("gram").isNotNull())
    # both tables of shared grams are stored, so that the joins with them have two shuffles of their own and
    # Spark can split the rows of a frequent gram
    met = stored(_shared(suffixes).select("gram"))
    places = suffixes.join(met, "gram").groupBy("key").agg(F.collect_set("place").alias("places"))
    passages = stored(
        texts_at(source, places).mapInArrow(lambda it: _passages(least, anchor, it), "key long, start int, gram long")
    )
    classes = stored(_shared(passages))
    other = F.when(F.col("lo") == F.col("key"), F.col("hi")).otherwise(F.col("lo")).alias("other")
    matched = passages.join(classes, "gram").groupBy("key", other).agg(F.collect_list("start").alias("starts"))
    grouped = matched.groupBy("key").agg(F.collect_list(F.struct("other", "starts")).alias("groups"))
    runs = grouped.mapInArrow(lambda it: _runs(least, it), "key long, start long, words long, other long")
    names = source.select("key", "doc_id").distinct()
    holders = stored(
        names.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
    )
    # the documents of each text with runs, or with copies, which repeat as a whole
    runs = runs.join(holders.select(F.col("key").alias("other"), F.col("lo").alias("other_id")), "other").drop("other")
    size = anchors.where(F.col("gram").isNull()).groupBy("key").agg(F.max("place").cast("long").alias("words"))
    copied = holders.where("n > 1").join(size.where(F.col("words") >= least), "key")
    part = runs.join(copied.select("key"), "key", "left_anti").join(names, "key")
    whole = copied.join(names, "key").withColumn(
        "other_id", F.when(F.col("lo").eqNullSafe(F.col("doc_id")), F.col("hi")).otherwise(F.col("lo"))
    )
    columns = ["doc_id", F.col("start").cast("long"), "words", "other_id"]
    return part.select(*columns).unionByName(whole.withColumn("start", F.lit(0)).select(*columns))


@query("op7_repeats")
def op7_repeats(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))
