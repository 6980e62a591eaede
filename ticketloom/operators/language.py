"""Language of a text, learnt from labelled texts with character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import text

DIM = 4096
LONGEST = 3
#: Texts whose counts a task holds at once.
TEXTS = 128


def _letters(col: str) -> Column:
    """Lower-case letters of the whole text, everything between them as one blank."""
    return F.regexp_replace(F.lower(F.coalesce(F.col(col), F.lit(""))), r"[^\p{L}]+", " ")


def char_ngrams(letters: Column, longest: int = LONGEST) -> Column:
    """All overlapping runs of 1 to ``longest`` characters, one pass over the text per length."""
    runs = [F.regexp_extract_all(letters, F.lit(f"(?=(.{{{n}}}))"), 1) for n in range(1, longest + 1)]
    return F.concat(*runs)


def with_ngrams(df: DataFrame, col: str, dim: int = DIM, out: str = "__features") -> DataFrame:
    """Adds the sparse counts of character n-grams, hashed into ``dim`` places."""
    hashing = HashingTF(numFeatures=dim, inputCol="__ngrams", outputCol=out)
    return hashing.transform(df.withColumn("__ngrams", char_ngrams(_letters(col)))).drop("__ngrams")


def _places(texts: list[str], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of every n-gram of some texts of letters and blanks, hashed into ``dim`` places."""
    codes = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    row = np.cumsum(codes == 0) - (codes == 0)
    rows, places = [], []
    for n in range(1, LONGEST + 1):
        size = max(0, len(codes) - n + 1)
        key, inside = np.full(size, n, dtype=np.uint64), np.ones(size, dtype=bool)
        for at in range(n):
            key = key * np.uint64(0x9E3779B97F4A7C15) + codes[at : at + size]
            inside &= codes[at : at + size] != 0
        key = key[inside]
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        rows.append(row[:size][inside])
        places.append(((key ^ (key >> np.uint64(32))) % np.uint64(dim)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(places)


def _label_sums(labelled: DataFrame, dim: int) -> DataFrame:
    """(label, place, n): n-grams of all texts of a label by place, and their number of texts at place -1."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[float, np.ndarray] = {}
        for batch in batches:
            labels, texts = batch["label"].to_numpy(zero_copy_only=False), batch["letters"]
            for at in range(0, len(batch), TEXTS):
                row, place = _places(texts.slice(at, TEXTS).to_pylist(), dim)
                own = labels[at : at + TEXTS]
                for label in np.unique(own):
                    mine = own == label
                    total = sums.setdefault(float(label), np.zeros(dim + 1))
                    total[:dim] += np.bincount(place[mine[row]], minlength=dim)
                    total[dim] += mine.sum()
        for label, total in sums.items():
            at = np.flatnonzero(total)
            columns = [pa.array(np.full(len(at), label)), pa.array(np.where(at == dim, -1, at).astype(np.int32)), pa.array(total[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "place", "n"])

    found = labelled.mapInArrow(summed, "label double, place int, n double")
    return found.groupBy("label", "place").agg(F.sum("n").alias("n"))


def fit_language(labelled: DataFrame, col: str = "text", label: str = "lang", dim: int = DIM) -> PipelineModel:
    """Naive Bayes over hashed character n-grams.

    Its parameters follow from the sums per label: a label's mean counts, weighted by its texts, stand for its rows.
    """
    known = labelled.where(F.col(label).isNotNull())
    indexer = StringIndexer(inputCol=label, outputCol="__label", stringOrderType="alphabetAsc").fit(known.select(label))
    bayes = NaiveBayes(
        featuresCol="__features", labelCol="__label", predictionCol="__lang_index", weightCol="__weight",
        rawPredictionCol="__lang_raw", probabilityCol="__lang_prob",
    )
    decode = IndexToString(inputCol="__lang_index", outputCol="__lang", labels=indexer.labels)
    prepared = indexer.transform(known).select(F.col("__label").alias("label"), _letters(col).alias("letters"))
    # at most dim + 1 numbers per language
    sums: dict[float, np.ndarray] = {}
    for r in _label_sums(prepared, dim).collect():
        sums.setdefault(r.label, np.zeros(dim + 1))[r.place] = r.n
    means = [(c, float(total[-1]), Vectors.dense(total[:-1] / total[-1])) for c, total in sorted(sums.items())]
    rows = labelled.sparkSession.createDataFrame(means, T.StructType([
        T.StructField("__label", T.DoubleType()), T.StructField("__weight", T.DoubleType()), T.StructField("__features", VectorUDT()),
    ]))
    return Pipeline(stages=[bayes, decode]).fit(rows)


def detect_language(df: DataFrame, model: PipelineModel, col: str = "text") -> DataFrame:
    """Adds ``detected_lang``; texts under 20 characters are 'unknown'."""
    bayes, labels = model.stages[0], np.array(model.stages[1].getLabels(), dtype=object)
    shared = df.sparkSession.sparkContext.broadcast((bayes.pi.toArray(), np.ascontiguousarray(bayes.theta.toArray().T)))

    @F.pandas_udf("string")
    def likeliest(letters: pd.Series) -> pd.Series:
        prior, weights = shared.value
        dim, found = len(weights), []
        for at in range(0, len(letters), TEXTS):
            texts = letters.iloc[at : at + TEXTS].tolist()
            row, place = _places(texts, dim)
            counts = np.bincount(row * dim + place, minlength=len(texts) * dim).reshape(len(texts), dim)
            found.append(labels[(counts @ weights + prior).argmax(axis=1)])
        return pd.Series(np.concatenate(found) if found else [], dtype=object)

    # evaluated once, also below a filter on its result
    told = likeliest.asNondeterministic()(_letters(col))
    return df.withColumn("detected_lang", told).withColumn("detected_lang", F.coalesce(text.lang_guard(F.col(col)), F.col("detected_lang")))
