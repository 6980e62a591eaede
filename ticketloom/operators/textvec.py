"""Text vectors: TF-IDF, encoders, the incremental embedding cache, feature assembly."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.functions import text
from ticketloom.operators.feedback import insert_ignore
from ticketloom.operators.joins import CACHE_KEYS, cache_lookup, cache_misses, text_keys
from ticketloom.operators.skew import skew_join
from ticketloom.session import cut_lineage, free_shuffles

#: Texts whose terms a task counts at once.
TERM_ROWS = 2048


def with_terms(df: DataFrame, col: str = "text", out: str = "terms") -> DataFrame:
    """Adds the words of a text followed by its pairs of neighbouring words."""
    words = text.tokens(F.col(col))
    # the last word pairs with NULL, and concat of NULL is NULL
    nexts = F.slice(F.col("__words"), F.lit(2), F.greatest(F.size("__words") - 1, F.lit(0)))
    pairs = F.filter(
        F.zip_with("__words", nexts, lambda a, b: F.concat(a, F.lit(" "), b)), lambda p: p.isNotNull()
    )
    return df.withColumn("__words", words).withColumn(out, F.concat("__words", pairs)).drop("__words")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and rows of each term of a batch of term lists, ``TERM_ROWS`` lists at a time."""
    for batch in batches:
        for at in range(0, len(batch), TERM_ROWS):
            lists = batch.column(0).slice(at, TERM_ROWS)
            coded = pc.list_flatten(lists).dictionary_encode()
            codes, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
            if not n:
                continue
            key = np.sort(pc.list_parent_indices(lists).to_numpy(zero_copy_only=False) * np.int64(n) + codes)
            first = np.concatenate([[True], key[1:] != key[:-1]])
            count, docs = np.bincount(codes, minlength=n), np.bincount(key[first] % n, minlength=n)
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(count), pa.array(docs)], names=["term", "n", "docs"])


def term_statistics(df: DataFrame, terms: str = "terms") -> DataFrame:
    """(term, count, doc_count) over the whole table; counted per batch of texts before Spark adds the counts up."""
    counted = df.select(terms).mapInArrow(_counted, "term string, n bigint, docs bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("count"), F.sum("docs").alias("doc_count"))


def vocabulary(df: DataFrame, size: int = K.VOCABULARY_SIZE, terms: str = "terms") -> DataFrame:
    """The ``size`` most frequent terms with their smoothed inverse document frequency."""
    n = df.agg(F.count("*")).scalar()
    top = term_statistics(df, terms).orderBy(F.desc("count"), "term").limit(size)
    idf = F.ln((F.lit(1.0) + n) / (F.lit(1.0) + F.col("doc_count"))) + 1.0
    return top.withColumn("idf", idf)


@dataclass
class TfidfModel:
    """Vocabulary and weights; at most ``VOCABULARY_SIZE`` entries."""

    terms: list[str]
    idf: list[float]

    def stages(self, terms: str = "terms", out: str = "tfidf") -> list:
        counts = CountVectorizerModel.from_vocabulary(self.terms, inputCol=terms, outputCol="__counts")
        scaled = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol="__counts", outputCol="__scaled"
        )
        return [counts, scaled, Normalizer(p=2.0, inputCol="__scaled", outputCol=out)]

    def transform(self, df: DataFrame, col: str = "text", out: str = "tfidf") -> DataFrame:
        result = with_terms(df, col, "__terms")
        for stage in self.stages("__terms", out):
            result = stage.transform(result)
        return result.drop("__terms", "__counts", "__scaled")


def fit_tfidf(train: DataFrame, col: str = "text", size: int = K.VOCABULARY_SIZE) -> TfidfModel:
    """Vocabulary and weights of the training texts only."""
    rows = vocabulary(with_terms(train, col), size).orderBy(F.desc("count"), "term").collect()
    return TfidfModel([r["term"] for r in rows], [r["idf"] for r in rows])


def tfidf_features(train: DataFrame, df: DataFrame, col: str = "text", size: int = K.VOCABULARY_SIZE) -> DataFrame:
    return fit_tfidf(train, col, size).transform(df, col)


@dataclass
class HashEncoder:
    """Encoder without a model file: words and word pairs hashed into ``dim`` places, unit length."""

    dim: int = K.EMBEDDING_DIM
    name: str = "hashed-ngrams"

    def encode(self, df: DataFrame, col: str, out: str = "embedding") -> DataFrame:
        hashed = HashingTF(numFeatures=self.dim, inputCol="__terms", outputCol="__tf")
        unit = Normalizer(p=2.0, inputCol="__tf", outputCol="__unit")
        result = unit.transform(hashed.transform(with_terms(df, col, "__terms")))
        vector = vector_to_array("__unit", "float32")
        return result.withColumn(out, vector).drop("__terms", "__tf", "__unit")


@dataclass
class BatchEncoder:
    """Encoder from a user's model: ``load()`` runs once per task and returns texts -> 2-d array."""

    load: Callable[[], Callable[[list[str]], np.ndarray]]
    name: str
    batch_size: int = 64

    def encode(self, df: DataFrame, col: str, out: str = "embedding") -> DataFrame:
        load, size = self.load, self.batch_size

        @F.pandas_udf("array<float>")
        def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for batch in batches:
                texts = batch.fillna("").tolist()
                parts = [model(texts[i : i + size]) for i in range(0, len(texts), size)]
                rows = [np.asarray(v, dtype="float32") for part in parts for v in part]
                yield pd.Series(rows, index=batch.index, dtype=object)

        return df.withColumn(out, vectors(F.col(col)))


def embed_texts(df: DataFrame, encoder, col: str = "text", out: str = "embedding") -> DataFrame:
    return encoder.encode(df, col, out)


def incremental_embeddings(
    texts: DataFrame, cache: DataFrame, encoder, now, col: str = "text", id_col: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """One vector per row, encoding each distinct text only if the cache lacks it.

    Returns (id, text_hash, embedding, from_cache) and the rows to append to the cache. New vectors are
    written to the shared folder once, so they are encoded once however often the results are read.
    """
    model = encoder.name
    keys = text_keys(texts, model, col, id_col)
    new = embed_texts(cache_misses(texts, cache, model, col), encoder, "text")
    new = cut_lineage(new.withColumn("text", text.left_n(F.col("text"), K.CACHE_TEXT_CHARS)))
    free_shuffles(new.sparkSession)  # the texts that were looked up
    additions = new.select(
        "text_hash",
        F.lit(model).alias("model_name"),
        F.col("text").alias("text_content"),
        "embedding",
        F.lit(now).cast("timestamp_ntz").alias("created_at"),
    )
    additions = insert_ignore(additions, cache.where(F.col("embedding").isNotNull()), CACHE_KEYS, ["text_content"])
    known = cache_lookup(keys, cache, id_col)
    fresh = new.select("text_hash", F.col("embedding").alias("__new"))
    both = skew_join(known, fresh, ["text_hash"], "left", spread_by=[id_col])
    rows = both.select(
        id_col,
        "text_hash",
        F.coalesce("embedding", "__new").alias("embedding"),
        F.col("embedding").isNotNull().alias("from_cache"),
    )
    return rows, additions


def assemble(df: DataFrame, vector: str, cols: list[str] = K.NUMERIC_FEATURES, out: str = "features") -> DataFrame:
    """Text vector (array or vector) followed by the numeric columns; missing numbers count as 0."""
    if df.schema[vector].dataType.typeName() == "array":
        df = df.withColumn("__vector", array_to_vector(F.col(vector)))
    else:
        df = df.withColumn("__vector", F.col(vector))
    filled = df.fillna(0, subset=cols)
    return VectorAssembler(inputCols=["__vector", *cols], outputCol=out).transform(filled).drop("__vector")
