"""Chat formatting: cumulative snapshots are collapsed, then what is left is rendered.

A log often holds a conversation again and again, each time some turns longer. A rolling hash over a
conversation's turns gives every turn-prefix an identity; a conversation whose own hash is that of a strict
prefix of another one is dropped by an anti-join, and of equal conversations the one with the smallest id
stays. The rest are rendered in a chat template.

The rolling hash is an exclusive or of hashes of (position, role, text), 128 bits in all, so it can be
added up piece by piece: a conversation's turns are sorted into range partitions, and totals of the pieces
are carried from one to the next. No task ever holds a whole conversation. Rendered text comes in parts of
about ``part_chars`` characters; a usual conversation is one part.

Inputs: conversations (conv_id, turn, role, text). Cases: turns are ordered by (turn, role, text), nulls
first, and numbered anew, so gaps, ties and null turns are allowed; repeated rows count once; rows with a
null conv_id form one conversation of their own; a null role is rendered as ``unknown`` and a null text as
empty, but both differ from those values when prefixes are compared; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import LEAST_BUCKETS, buckets_for, stored, table
from ticketloom.llm.registry import query

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
PART_CHARS = 1_000_000
_LANES = ("1", "2")


def rendered(role: str = "role", text: str = "text") -> Column:
    """One turn in the template."""
    shown = F.coalesce(F.col(role), F.lit("unknown"))
    return F.concat(F.lit(OPEN), shown, F.lit("\n"), F.coalesce(F.col(text), F.lit("")), F.lit(CLOSE))


def _pieces(messages: DataFrame) -> DataFrame:
    """Distinct turns with the range partition (``piece``) they sort into, their place there, and digests."""
    turns = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    turns = stored(turns.distinct())
    order = ["conv_id", "turn", "role", "text"]
    ranged = turns.repartitionByRange(buckets_for(turns.count(), least=LEAST_BUCKETS), *order)
    ranged = stored(ranged.withColumn("piece", F.spark_partition_id()))
    place = F.row_number().over(Window.partitionBy("conv_id", "piece").orderBy("turn", "role", "text")) - 1
    parts = [x for c in ("role", "text") for x in (F.col(c).isNull(), F.coalesce(c, F.lit("")))]
    digests = [F.xxhash64(F.lit(lane), *parts).alias(f"d{lane}") for lane in _LANES]
    chars = F.length(rendered()).cast("long").alias("chars")
    return stored(ranged.select("conv_id", "piece", place.alias("place"), "role", "text", chars, *digests))


def _same_piece(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on (conv_id, piece), where conv_id may be null."""
    right = right.withColumnsRenamed({"conv_id": "__conv", "piece": "__piece"})
    on = left["conv_id"].eqNullSafe(right["__conv"]) & (left["piece"] == right["__piece"])
    return left.join(right, on).drop("__conv", "__piece")


def _prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n, position, p1, p2) per turn, and per piece what lies before it."""
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    sizes = turns.groupBy("conv_id", "piece").agg(F.count("*").alias("rows"), F.sum("chars").alias("piece_chars"))
    sizes = stored(
        sizes.select(
            "conv_id",
            "piece",
            F.sum("rows").over(whole).alias("n"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("piece_chars").over(before), F.lit(0)).alias("chars_before"),
        )
    )
    placed = _same_piece(turns.drop("role", "text"), sizes).withColumn("position", F.col("rows_before") + F.col("place"))
    hashes = {f"t{lane}": F.xxhash64(F.lit(lane), "position", "d1", "d2") for lane in _LANES}
    placed = stored(placed.select("conv_id", "piece", "place", "position", "n", *[v.alias(k) for k, v in hashes.items()]))
    totals = placed.groupBy("conv_id", "piece").agg(*[F.bit_xor(t).alias(t) for t in hashes])
    carried = totals.select(
        "conv_id", "piece", *[F.coalesce(F.bit_xor(t).over(before), F.lit(0)).alias(f"c{t}") for t in hashes]
    )
    upto = Window.partitionBy("conv_id", "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.select("conv_id", "piece", "position", "n", *[F.bit_xor(t).over(upto).alias(t) for t in hashes])
    rolled = _same_piece(running, carried)
    rolling = [F.col(f"t{lane}").bitwiseXOR(F.col(f"ct{lane}")).alias(f"p{lane}") for lane in _LANES]
    return rolled.select("conv_id", "n", "position", *rolling), sizes


def maximal_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, copies) of the conversations that are no strict prefix of another, and the piece table."""
    rolled, sizes = _prefixes(turns)
    rolled = stored(rolled)
    key = ["position", "p1", "p2"]
    strict = rolled.where(F.col("position") < F.col("n") - 1).select(*key).distinct()
    whole = rolled.where(F.col("position") == F.col("n") - 1).groupBy(*key)
    whole = whole.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    return stored(whole.join(strict, key, "left_anti").select("conv_id", "copies")), sizes


def format_chats(messages: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, n_turns, copies, text): maximal conversations in the template, in parts."""
    turns = _pieces(messages)
    kept, sizes = maximal_conversations(turns)
    kept = kept.withColumnRenamed("conv_id", "__kept")
    pieces = sizes.join(kept, sizes["conv_id"].eqNullSafe(kept["__kept"])).drop("__kept")
    inside = Window.partitionBy("conv_id", "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begun = turns.withColumn("inside", F.coalesce(F.sum("chars").over(inside), F.lit(0)))
    placed = _same_piece(begun, pieces)
    line = F.struct((F.col("rows_before") + F.col("place")).alias("position"), rendered().alias("shown"))
    part = F.floor((F.col("chars_before") + F.col("inside")) / part_chars).cast("int").alias("part")
    return (
        placed.select("conv_id", part, F.col("n").alias("n_turns"), "copies", line.alias("line"))
        .groupBy("conv_id", "part")
        .agg(
            F.first("n_turns").alias("n_turns"),
            F.first("copies").alias("copies"),
            F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["shown"]), "").alias("text"),
        )
    )


SQL = rf"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS p,
             '{OPEN}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS shown FROM t),
c AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY p) AS l, count(*) AS n FROM o GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, l, any_value(n) AS n, count(*) AS copies FROM c GROUP BY l),
k AS (SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u AS v WHERE v.n > u.n AND list_slice(v.l, 1, u.n) = u.l)),
s AS (SELECT o.*, k.n AS n_turns, k.copies,
             CAST(floor(coalesce(sum(length(shown)) OVER (PARTITION BY o.conv_id ORDER BY p
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / {PART_CHARS}) AS INTEGER) AS part
      FROM o JOIN k ON o.conv_id IS NOT DISTINCT FROM k.conv_id)
SELECT conv_id, part, any_value(n_turns) AS n_turns, any_value(copies) AS copies, string_agg(shown, '' ORDER BY p) AS text
FROM s GROUP BY conv_id, part
"""


@query("op1_chat", SQL)
def op1_chat(spark, sf_dir):
    return format_chats(table(spark, sf_dir, "conversations"))
