"""Lookups between tables."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import text
from ticketloom.operators.skew import is_small, lookup_join, skew_join
from ticketloom.session import cut_lineage

CACHE_KEYS = ["text_hash", "model_name"]
#: Bits of a key filter: at most FILTER_BITS / 64 rows of 16 bytes, 2 MB, are broadcast.
FILTER_BITS = 1 << 23


def key_filter(keys: DataFrame, cols: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """(word, mask): one bit per hash of the keys, 64 to a word. Its size is bounded by ``bits``."""
    spot = F.pmod(F.xxhash64(*cols), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))
    marked = keys.select(F.shiftright(spot, 6).alias("word"), bit.alias("bit"))
    return marked.groupBy("word").agg(F.bit_or("bit").alias("mask"))


def only_possible(df: DataFrame, words: DataFrame, cols: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``df`` whose key may be among those of the filter, found before ``df`` is shuffled.

    All rows with such a key stay; others mostly go, so a large table meets a small batch with few rows.
    """
    spot = F.pmod(F.xxhash64(*cols), F.lit(bits))
    placed = df.withColumn("word", F.shiftright(spot, 6)).withColumn("__bit", (spot % 64).cast("int"))
    marked = F.call_function("getbit", "mask", "__bit") == 1
    return placed.join(F.broadcast(words), "word").where(marked).drop("word", "mask", "__bit")


def with_text_hash(texts: DataFrame, model: str, col: str = "text") -> DataFrame:
    return texts.withColumn("text_hash", text.text_hash(F.col(col))).withColumn("model_name", F.lit(model))


def text_keys(texts: DataFrame, model: str, col: str = "text", id_col: str = "id") -> DataFrame:
    """(id, text_hash, model_name) of every text, stored: the texts themselves are read once."""
    return cut_lineage(with_text_hash(texts, model, col).select(id_col, *CACHE_KEYS))


def cache_lookup(keys: DataFrame, cache: DataFrame, id_col: str = "id") -> DataFrame:
    """Each key of ``text_keys`` with the stored vector of its (hash, model), NULL if there is none.

    One text may make up a large part of the rows, so hot hashes are salted. Of the cache only rows whose key
    may be asked for are shuffled.
    """
    possible = only_possible(cache.select(*CACHE_KEYS, "embedding"), key_filter(keys, CACHE_KEYS), CACHE_KEYS)
    return skew_join(keys, possible, CACHE_KEYS, "left", spread_by=[id_col])


def distinct_texts(texts: DataFrame, col: str = "text") -> DataFrame:
    """One row (text_hash, text) per distinct text."""
    hashed = texts.select(text.text_hash(F.col(col)).alias("text_hash"), F.col(col).alias("text"))
    return hashed.dropDuplicates(["text_hash"])


def cache_misses(texts: DataFrame, cache: DataFrame, model: str, col: str = "text") -> DataFrame:
    """Distinct texts that have no stored vector for this model.

    Hashes are compared first; texts are fetched for the missing ones only, without a shuffle of the texts
    where these are few.
    """
    stored = cache.where((F.col("model_name") == model) & F.col("embedding").isNotNull()).select("text_hash")
    hashes = texts.select(text.text_hash(F.col(col)).alias("text_hash")).where("text_hash IS NOT NULL").distinct()
    hashes = cut_lineage(hashes)
    possible = only_possible(stored, key_filter(hashes, ["text_hash"]), ["text_hash"])
    missing = cut_lineage(hashes.join(possible, "text_hash", "left_anti"))
    side = F.broadcast(missing) if is_small(missing) else missing
    hashed = texts.select(text.text_hash(F.col(col)).alias("text_hash"), F.col(col).alias("text"))
    return hashed.join(side, "text_hash", "left_semi").dropDuplicates(["text_hash"])


def feedback_to_log(log: DataFrame, feedback: DataFrame) -> DataFrame:
    """Every log row with the correction for its id, if any; one correction per id."""
    given = feedback.select(
        F.col("prediction_id").alias("id"),
        "correct_queue",
        "correct_urgency",
        F.col("feedback_at").alias("corrected_at"),
    )
    return log.join(given, "id", "left")


def known_feedback(log: DataFrame, feedback: DataFrame) -> DataFrame:
    return feedback.join(log, feedback["prediction_id"] == log["id"], "left_semi")


def unknown_feedback(log: DataFrame, feedback: DataFrame) -> DataFrame:
    return feedback.join(log, feedback["prediction_id"] == log["id"], "left_anti")


def decode_label(predictions: DataFrame, index: DataFrame, col: str = "prediction") -> DataFrame:
    """Adds ``class`` for the numeric prediction; ``index`` is the (class, index) table of the encoder.

    """
    named = index.select(F.col("class"), F.col("index").cast("double").alias("__index"))
    keyed = predictions.withColumn("__index", F.col(col).cast("double"))
    return lookup_join(keyed, named, ["__index"]).drop("__index")


def attach_class_weight(df: DataFrame, weights: DataFrame, label: str) -> DataFrame:
    """Adds ``weight`` of the row's class."""
    return lookup_join(df, weights.select(F.col("class").alias(label), "weight"), [label])


def hstack_by_id(
    vectors: DataFrame, numbers: DataFrame, cols: list[str], vector: str = "embedding", id_col: str = "id"
) -> DataFrame:
    """The text vector and numeric columns of the same id as one ``features`` vector."""
    dense = vectors.select(id_col, array_to_vector(F.col(vector)).alias("__text"))
    joined = dense.join(numbers.select(id_col, *cols), id_col)
    assembled = VectorAssembler(inputCols=["__text", *cols], outputCol="features").transform(joined)
    return assembled.select(id_col, "features")


def map_feedback_labels(
    feedback: DataFrame, mapping: dict[str, str] = K.FEEDBACK_CLASS, col: str = "correct_queue"
) -> DataFrame:
    """Adds ``feedback_class``, the model class of a short label; the mapping is part of the plan."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return feedback.withColumn("feedback_class", F.try_element_at(F.create_map(*pairs), F.col(col)))


def unmapped_feedback(mapped: DataFrame, col: str = "correct_queue") -> DataFrame:
    """Corrections whose label stands for no class."""
    return mapped.where(F.col("feedback_class").isNull() & F.col(col).isNotNull())
