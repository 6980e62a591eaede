"""Sharding by balanced label propagation.

Linked documents, here those of equal text, should share a shard, and shards should hold equal numbers of
rows. Every row starts with a label drawn from its hash. In each round a group of linked rows takes a vote
of its rows' labels and asks to move to the shard with most of them, among those with room for the whole
group; requests are granted while the shard's quota lasts, and the group's rows take the new label. Groups
larger than a shard fill whole shards before that, and groups that no quota admits are dealt out after it, in
one run over the shards that have room, so that both are cut as seldom as can be. Unlinked rows fill what is
left: counts are at most one apart whatever the links.

Only one number per shard reaches the driver in a round.

Inputs: documents (doc_id, text). Cases: null text has no bytes and links with empty texts, which have none
either; repeated rows and null doc_ids are rows of their own; fewer rows than shards leave shards empty;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import numbered, running_total, stored, table, text_of, with_row_key
from ticketloom.llm.registry import query

SHARDS = 16
ROUNDS = 6


def _proposals(groups: DataFrame, room: list[int]) -> DataFrame:
    """Adds ``target``: the shard with most of the group's rows among those that can take it whole."""
    choices = [
        F.when(
            F.col("n") <= left,
            F.struct(
                F.coalesce(F.element_at("votes", F.lit(s)), F.lit(0)).alias("votes"),
                F.xxhash64("link", F.lit(s)).alias("mark"),  # ties are spread over the shards
                F.lit(s).alias("shard"),
            ),
        )
        for s, left in enumerate(room)
    ]
    best = choices[0] if len(choices) == 1 else F.greatest(*choices)
    return groups.withColumn("target", best["shard"]).where(F.col("target").isNotNull())


def _room_of(target: str, room: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in room]), F.col(target) + 1)


def _dealt(position: Column, room: list[int]) -> Column:
    """The shard whose share of the positions from 0 on, ``room`` rows each, holds ``position``."""
    ends = list(accumulate(room))
    return reduce(lambda out, s: F.when(position < ends[s], s).otherwise(out), reversed(range(len(room))), F.lit(None))


def propagate(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (row_key, link, ...; stored) with a ``shard``; counts are at most one apart."""
    total = rows.count()
    room = [total // shards + (s < total % shards) for s in range(shards)]
    label = F.pmod(F.xxhash64("row_key", F.lit(1)), F.lit(shards)).cast("int")
    votes = rows.groupBy("link", label.alias("label")).agg(F.count("*").alias("c"))
    groups = votes.groupBy("link").agg(
        F.sum("c").alias("n"), F.map_from_entries(F.collect_list(F.struct("label", "c"))).alias("votes")
    )
    groups = stored(groups.where("n > 1"))  # votes have an entry per shard at most
    # groups larger than a shard, fewer than there are shards, fill whole shards before all others
    first = total // shards + 1
    large = groups.where(F.col("n") > first).select("link", "n").orderBy(F.desc("n"), "link").collect()
    begin, at = {}, 0
    for r in large:
        begin[r["link"]], at = at, at + r["n"]
    spent = [min(left, max(0, at - before)) for left, before in zip(room, accumulate(room, initial=0))]
    opening, room = room, [left - used for left, used in zip(room, spent)]
    spark = rows.sparkSession
    begun = spark.createDataFrame([(k, v) for k, v in begin.items()], "link long, first long")
    groups = groups.where(F.col("n") <= first)
    placed = [begun.select("link", F.lit(None).cast("int").alias("shard"), "first", F.lit(True).alias("large"))]
    for _ in range(rounds):
        asked = running_total(_proposals(groups, room), ["target"], "n", ["link"], "upto")
        granted = stored(asked.where(F.col("upto") <= _room_of("target", room)).select("link", "n", "target"))
        moved = {r["target"]: r["n"] for r in granted.groupBy("target").agg(F.sum("n").alias("n")).collect()}
        if not moved:
            break
        room = [left - moved.get(s, 0) for s, left in enumerate(room)]
        placed.append(granted.select("link", F.col("target").alias("shard"), F.lit(None).cast("long").alias("first"), F.lit(False).alias("large")))
        groups = stored(groups.join(granted.select("link"), "link", "left_anti"))
        if groups.isEmpty():
            break
    # what no quota admitted: each group gets the positions [first, first + n) of one run
    late = running_total(groups, [], "n", ["link"], "upto").withColumn("first", F.col("upto") - F.col("n"))
    placed.append(late.select("link", F.lit(None).cast("int").alias("shard"), "first", F.lit(False).alias("large")))
    known = stored(rows.join(stored(reduce(DataFrame.unionByName, placed)), "link", "left"))
    done = known.where(F.col("shard").isNotNull()).drop("first", "large")
    cut = numbered(known.where("shard is null and first is not null"), ["link"], ["row_key"], "at")
    cut = cut.withColumn("at", F.col("at") + F.col("first"))
    cut = cut.withColumn("shard", F.when(F.col("large"), _dealt(F.col("at"), opening)).otherwise(_dealt(F.col("at"), room)))
    before = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    single = numbered(known.where("shard is null and first is null"), [], ["row_key"], "at")
    single = single.withColumn("shard", _dealt(F.col("at") + before, room))
    dealt = cut.unionByName(single).withColumn("shard", F.col("shard").cast("int"))
    return done.unionByName(dealt.drop("first", "at", "large"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot (dense from 0 in its shard), grown_shard (null)."""
    text = text_of()
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text, F.octet_length(text)).alias("link"),
    )
    rows = stored(with_row_key(narrow))
    sharded = stored(propagate(rows, shards, rounds))
    # unlinked rows are dealt in the order of a hash of their key; slots need one that is independent of it
    return numbered(sharded, ["shard"], ["shard", "row_key"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_shard")
def op10_shard(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))
