"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors: one per word and one per character n-gram of each word, all in
hashed buckets, and one for pairs of equal words. A softmax layer over the average gives the class. Both are trained together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows (``max_rows``); every row is scored.

For scoring the model folds into one number per bucket, the difference of the two classes' logits, so a
batch needs no vectors: the distinct words of a batch are scored once and looked up for every occurrence.

Inputs: documents (doc_id, text), labels (doc_id, quality). Cases: null and empty texts have no words and
get the score of the bias alone; labels that are null or of rows without a document are not used; without
labels of both classes the score is their smoothed share; repeated rows are scored each; other columns are
not read. Labels are learned only from rows whose CRC-32 of the doc_id is not divisible by 5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import opened, released, shared, table, text_of
from ticketloom.llm.registry import query

BUCKETS = 1 << 16
GRAMS = (2, 3)
DIM = 8
EPOCHS = 4
RATE = 1.0
#: Labelled rows the model is fitted on, at most; taken in the order of a hash of their id.
MAX_ROWS = 4_000
THRESHOLD = 0.3
_BATCH = 1_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


#: The bucket of word pairs whose two words are equal; pairs of different words have no bucket. A pair
#: counts as much as the parts of a word of usual length.
REPEAT, REPEAT_WEIGHT = BUCKETS, 16


def _bucket(codes: np.ndarray, n: int) -> np.ndarray:
    mixed = (codes ^ np.uint64(n * 0x51ED270B)) * _PRIME
    return ((mixed ^ (mixed >> np.uint64(29))) * _PRIME >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of the word) for each word and each of its character n-grams, ends marked."""
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words)), size)
    last = np.repeat(np.cumsum(size), size)
    place = np.arange(len(chars))
    buckets, owners = [], []
    whole = np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        end = place + n
        fits = end <= last
        whole = whole * np.uint64(1_000_003)
        whole[fits] += chars[np.minimum(end[fits] - 1, len(chars) - 1)]
        if n in GRAMS:
            buckets.append(_bucket(whole[fits], n))
            owners.append(owner[fits])
    if words:  # whole words, by a hash of all their characters
        starts = np.cumsum(size) - size
        spot = (place - starts[owner]).astype(np.uint64)
        mixed = (chars + spot * np.uint64(0x2545F491)) * _PRIME
        mixed ^= mixed >> np.uint64(31)
        buckets.append(_bucket(np.add.reduceat(mixed * _PRIME, starts), 0))
        owners.append(np.arange(len(words)))
    return np.concatenate(buckets), np.concatenate(owners)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares of all its features."""
    words = text.split()
    times = Counter(words)
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    buckets, owners = features(list(times))
    sums = np.bincount(buckets, weights=np.array(list(times.values()))[owners], minlength=BUCKETS + 1)
    sums[REPEAT] += REPEAT_WEIGHT * sum(map(eq, words, words[1:]))
    found = np.flatnonzero(sums)
    return found.astype(np.int32), (sums[found] / sums.sum()).astype(np.float32)


@dataclass
class Model:
    bias: float
    #: logit difference of each bucket
    weight: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        lists = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        buckets, owners = features(words)
        total = np.bincount(owners, weights=self.weight[buckets], minlength=len(words))
        count = np.bincount(owners, minlength=len(words))
        if "" in words:
            at = words.index("")
            total[at] = count[at] = 0
        at = coded.indices.to_numpy()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        summed = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x[at])])[bounds])
        again = np.zeros(len(at))
        again[1:] = at[1:] == at[:-1]
        again[bounds[bounds < len(at)]] = 0
        if "" in words:
            again[at == words.index("")] = 0
        again = REPEAT_WEIGHT * np.diff(np.concatenate([[0.0], np.cumsum(again)])[bounds])
        n = summed(count.astype(float)) + again
        logit = self.bias + (summed(total) + again * self.weight[REPEAT]) / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """Gradient descent over (label, buckets, shares), row by row, with a falling rate."""
    labels = np.array([r[0] for r in rows], dtype=int)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    if len(set(labels.tolist())) < 2:
        return Model(float(np.log(share / (1 - share))), np.zeros(BUCKETS + 1))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM)).astype(np.float32)
    output = np.zeros((2, DIM), dtype=np.float32)
    bias = np.array([0.0, np.log(share / (1 - share))], dtype=np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)).tolist():
            label, buckets, shares = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = shares @ vectors[buckets]
            logits = output @ hidden + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            bias -= 0.1 * rate * error
            # the average spreads the gradient over all features of a text; this rescales it to one of them
            vectors[buckets] -= (rate * np.sqrt(len(buckets) + 1.0) * shares)[:, None] * back
    weight = vectors @ (output[1] - output[0])
    return Model(float(bias[1] - bias[0]), weight.astype(np.float64))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [counted(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("mark"),
                batch.column("quality"),
                pa.array([x for x, _ in found], pa.list_(pa.int32())),
                pa.array([x for _, x in found], pa.list_(pa.float32())),
            ],
            names=["mark", "quality", "buckets", "shares"],
        )


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of at most ``max_rows`` labelled rows outside the held-out fold.

    The bound keeps the sample small enough to be broadcast, so documents are not shuffled, and to be
    fitted on the driver, to which only hashed counts go.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("int").alias("quality"))
        .withColumn("mark", F.xxhash64("doc_id"))
        .orderBy("mark", "doc_id")
        .limit(max_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = rows.select("mark", "quality", "text").mapInArrow(
        _counted, "mark long, quality int, buckets array<int>, shares array<float>"
    )
    fetched = found.orderBy("mark", F.xxhash64("buckets")).limit(max_rows).toArrow()
    lists = [fetched[c].combine_chunks() for c in ("buckets", "shares")]
    values = [x.flatten().to_numpy() for x in lists]
    at = lists[0].offsets.to_numpy() if len(fetched) else [0]
    examples = [
        (label, values[0][s:e], values[1][s:e])
        for label, s, e in zip(fetched["quality"].to_pylist(), at[:-1], at[1:])
    ]
    return fit(examples) if examples else Model(0.0, np.zeros(BUCKETS + 1))


def _scored(model, kept: float | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and scores, or, with ``kept``, the rows that score at least that."""
    m = opened(model)
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        scores = [m.scores(texts.slice(lo, _BATCH)) for lo in range(0, batch.num_rows, _BATCH)]
        score = np.concatenate([*scores, np.zeros(0)])
        if kept is not None:
            yield batch.filter(pa.array(score >= kept))
        else:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def score_quality(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted class of every row, in one narrow pass."""
    sent = shared(docs.sparkSession, model)
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = source.mapInArrow(lambda it: released(_scored(sent, None, it)), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the model accepts."""
    sent = shared(docs.sparkSession, model)
    return docs.mapInArrow(lambda it: released(_scored(sent, threshold, it)), docs.schema)


@query("op8_quality")
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
