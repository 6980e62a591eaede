"""Structured Streaming forms of the jobs that work on logs and arriving tickets.

The transformations take any DataFrame. Those with a watermark give each window or match once it is final
and forget rows that come later. The jobs are complete however late a row is and however the input is cut into
micro-batches: totals and known keys live in the state store, whose cost per micro-batch does not grow with
what was stored before, and what a micro-batch gives is stored in a folder of its own, which a replay replaces
and ``compact_batches`` merges with older ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, GroupedData, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ticketloom import constants as K
from ticketloom.plans.enrich import enrich
from ticketloom.session import folder_names, remove_folder

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession):
    """A stream started inside keeps its state in RocksDB, whatever the session is set to."""
    before = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, before)


def read_file_stream(
    spark: SparkSession, path: str, schema: str, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Files arriving in the folder ``path``; ``glob`` names the entries that count: files, or folders of files.

    It is part of the path, as a file-name filter looks into no folder, and always a pattern, as a path without one
    has to be a folder itself.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob and not set(glob) & set("*?[{"):
        glob = f"{glob[:-1]}[{glob[-1]}]"
    return reader.parquet(f"{path}/{glob}" if glob else path)


def write_file_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once Parquet sink that takes what is there and stops."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def run_to_end(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run the stream over all available files and return what it wrote."""
    write_file_stream(df, path, checkpoint).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def event_time(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Watermarks need a zoned timestamp; with the session in UTC the instant stays the same."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def stream_enrich(tickets: DataFrame, keywords: dict[str, list[str]] = K.KEYWORDS) -> DataFrame:
    """Ticket features, stateless: the batch chain works on a stream as it is, without a shuffle."""
    return enrich(tickets, keywords)


def write_batches(
    df: DataFrame, path: str, checkpoint: str, make: Callable[[DataFrame], DataFrame] = lambda batch: batch, mode: str = "append"
) -> StreamingQuery:
    """Stores ``make(rows)`` of each micro-batch in a folder of its own below ``path``; a replay replaces it."""

    def store(batch: DataFrame, batch_id: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    with state_on_disk(df.sparkSession):
        return (
            df.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .outputMode(mode)
            .trigger(availableNow=True)
            .start()
        )


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders of that name."""
    names = (n for n in folder_names(spark, path) if n.startswith(prefix))
    return sorted(int(n.removeprefix(prefix)) for n in names if "_SUCCESS" in folder_names(spark, f"{path}/{n}"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_batches`` stored, with the number of the ``batch``, a merged one having that of its last."""
    merged = _numbers(spark, path, "merged=")[-1:]
    later = [n for n in _numbers(spark, path, "batch=") if not merged or n > merged[0]]
    folders = [(n, f"merged={n}") for n in merged] + [(n, f"batch={n}") for n in later]
    if not folders:
        raise FileNotFoundError(f"no micro-batch has been stored in {path}")
    parts = spark.read.parquet(*[f"{path}/{name}" for _, name in folders])
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|merged)=(\d+)/", 1).cast("long")
    return parts.withColumn("batch", number)


def compact_batches(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merges all stored micro-batches into one folder and removes them.

    ``merge`` makes rows of the stored form from stored rows with their ``batch``. Readers take the newest complete
    merged folder and only the batches after it, so a run that fails midway changes nothing, and a replay of a
    merged micro-batch is not counted twice.
    """
    stored = _numbers(spark, path, "batch=")
    before = _numbers(spark, path, "merged=")
    last = max([*stored, *before], default=None)
    if last is None or last in before:
        return
    rows = merge(read_batches(spark, path))
    rows.drop("batch").write.mode("overwrite").parquet(f"{path}/merged={last}")
    for name in [f"batch={n}" for n in stored] + [f"merged={n}" for n in before]:
        remove_folder(spark, f"{path}/{name}")


def stream_predict(requests: DataFrame, predict, log_path: str, checkpoint: str) -> StreamingQuery:
    """Score each micro-batch with ``predict`` (DataFrame to log rows) and add it to the log.

    A micro-batch owns one partition of the log, so a replayed batch replaces its own rows.
    """

    return write_batches(requests, log_path, checkpoint, predict)


def tumbling_class_counts(log: DataFrame, label: str, delay: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Rows per class and day; a day is final once the watermark has passed it."""
    counted = (
        log.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", size), F.col(label).alias("class"))
        .agg(F.count("*").alias("count"))
    )
    return counted.select(F.col("window.start").alias("window_start"), "class", "count")


def sliding_feature_means(
    log: DataFrame, feature: str, delay: str = "1 hour", size: str = "7 days", slide: str = "1 day"
) -> DataFrame:
    """Count and mean of a feature over the last ``size``, once per ``slide``."""
    means = (
        log.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", size, slide))
        .agg(F.count("*").alias("count"), F.avg(feature).alias("mean"))
    )
    return means.select(F.col("window.start").alias("window_start"), "count", "mean")


def _windowed(log: DataFrame, size: str, slide: str | None, by: list) -> GroupedData:
    return log.groupBy(F.window("created_at", size, slide).getField("start").alias("window_start"), *by)


def class_count_pieces(log: DataFrame, label: str, size: str = "1 day") -> DataFrame:
    """Counts per window and class of one micro-batch; the counts of several add up."""
    return _windowed(log, size, None, [F.col(label).alias("class")]).agg(F.count("*").alias("count"))


def merged_class_counts(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("window_start", "class").agg(F.sum("count").alias("count"))


def feature_mean_pieces(log: DataFrame, feature: str, size: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Rows, present values and their sum per sliding window of one micro-batch."""
    return _windowed(log, size, slide, []).agg(
        F.count("*").alias("count"), F.count(feature).alias("present"), F.sum(feature).alias("sum")
    )


def merged_feature_means(pieces: DataFrame) -> DataFrame:
    total = pieces.groupBy("window_start").agg(*[F.sum(c).alias(c) for c in ("count", "present", "sum")])
    return total.select("window_start", "count", F.try_divide("sum", "present").alias("mean"))


def running_class_counts(log: DataFrame, label: str, size: str = "1 day") -> DataFrame:
    """Total count per window and class so far, for a stream in update mode: late rows raise it, whenever they come.

    State is one number per window and class, not per row, and is kept.
    """
    return class_count_pieces(log, label, size)


def running_feature_means(log: DataFrame, feature: str, size: str = "7 days", slide: str = "1 day") -> DataFrame:
    """Rows, present values and their sum per sliding window so far, for a stream in update mode."""
    return feature_mean_pieces(log, feature, size, slide)


def write_totals(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Stores the totals that each micro-batch changed; ``latest_totals`` reads them."""
    return write_batches(df, path, checkpoint, mode="update")


def latest_totals(batches: DataFrame, keys: list[str]) -> DataFrame:
    """The newest stored total per key; also the way to merge batches of totals."""
    values = [c for c in batches.columns if c not in (*keys, "batch")]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__newest"))
    return newest.select(*keys, *[F.col("__newest").getField(c).alias(c) for c in values])


def _first_rows(keys: list[str], order: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row per key of each batch, so that a frequent key is thinned before it is shuffled."""
    for batch in batches:
        places = pc.sort_indices(batch, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")
        table = pa.Table.from_batches([batch]).take(places)
        numbered = table.select(keys).append_column("__place", pa.array(range(len(table)), pa.int64()))
        first = numbered.group_by(keys).aggregate([("__place", "min")])["__place_min"]
        yield from table.take(first).to_batches()


class FirstRow(StatefulProcessor):
    """Lets the first row of a key pass, by ``order`` within a micro-batch, and none after it."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first = min(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order])
        if not self.seen.exists():
            self.seen.update((True,))
            yield first

    def close(self) -> None:
        pass


def first_per_key_ever(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key of a stream; keys, nulls included, are remembered in the state store for ever."""
    thinned = rows.mapInArrow(lambda batches: _first_rows(keys, order, batches), rows.schema)
    return thinned.groupBy(*keys).transformWithState(FirstRow(order), rows.schema, "Append", "None")


def stream_insert_ignore(
    rows: DataFrame, keys: list[str], order: list[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Stores the first row per key, for ever: a key that was stored is never let in again.

    A micro-batch looks up its own keys in the state store and reads nothing of what is stored.
    """
    with state_on_disk(rows.sparkSession):
        return write_batches(first_per_key_ever(rows, keys, order), path, checkpoint)


MATCH = ["id", "predicted_queue", "created_at", "correct_queue", "feedback_at", "feedback_id"]


def feedback_stream_join(
    log: DataFrame, feedback: DataFrame, within: str = "1 day", delay: str = "1 hour", how: str = "left"
) -> DataFrame:
    """Predictions with the corrections that arrive within a day, unmatched ones with NULLs.

    On a stream an unmatched prediction comes out once the watermark has passed it; ``complete_matches`` adds
    what comes after the watermark.
    """
    predictions = log.withWatermark("created_at", delay).alias("p")
    corrections = feedback.withWatermark("feedback_at", delay).alias("f")
    matched = (
        (F.col("p.id") == F.col("f.prediction_id"))
        & (F.col("f.feedback_at") >= F.col("p.created_at"))
        & (F.col("f.feedback_at") <= F.col("p.created_at") + F.expr(f"INTERVAL {within}"))
    )
    joined = predictions.join(corrections, matched, how)
    return joined.select(*[f"p.{c}" for c in MATCH[:3]], *[f"f.{c}" for c in MATCH[3:]])


def _between(df: DataFrame, column: str, low, high, before: str = "0 days", after: str = "0 days") -> DataFrame:
    """Rows whose time lies in the range, which reaches the scan as a filter."""
    bound = lambda v, shift: F.lit(v) + F.expr(f"INTERVAL {shift}")
    return df.where((F.col(column) >= F.lit(low) - F.expr(f"INTERVAL {before}")) & (F.col(column) <= bound(high, after)))


def complete_matches(
    spark: SparkSession, path: str, streamed: DataFrame, log: DataFrame, feedback: DataFrame, within: str = "1 day"
) -> DataFrame:
    """Stores the matches that a stream missed, and returns all: one row per prediction and correction.

    Ids grow with arrival on both sides. The largest ids seen are the high-water mark, kept in the name of the
    folder a run writes below ``path``: a run joins only the corrections that arrived after the mark with the
    predictions of their time, and the predictions after it with the older corrections of theirs. A match that
    the stream has given already, or gives later, counts once.
    """
    marks = [tuple(map(int, n.removeprefix("upto=").split("_"))) for n in folder_names(spark, path) if n.startswith("upto=")]
    done = [m for m in marks if "_SUCCESS" in folder_names(spark, f"{path}/upto={m[0]}_{m[1]}")]
    seen = max(done, default=(-1, -1))
    corrections, predictions = F.col("feedback_id") > seen[0], F.col("id") > seen[1]
    top = feedback.where(corrections).agg(F.max("feedback_id"), F.min("feedback_at"), F.max("feedback_at")).first()
    new = log.where(predictions).agg(F.max("id"), F.min("created_at"), F.max("created_at")).first()
    mark = (max(seen[0], top[0] or -1), max(seen[1], new[0] or -1))
    if mark != seen:
        known = streamed.where(F.col("feedback_id").isNotNull()).select("feedback_id", F.col("id").alias("prediction_id"))
        parts = []
        if top[0] is not None:
            fresh = feedback.where(corrections).join(known, ["feedback_id", "prediction_id"], "left_anti")
            parts.append(feedback_stream_join(_between(log, "created_at", *top[1:], before=within), fresh, within, how="inner"))
        if new[0] is not None and seen[0] >= 0:
            older = _between(feedback.where(~corrections), "feedback_at", *new[1:], after=within)
            older = older.join(known, ["feedback_id", "prediction_id"], "left_anti")
            parts.append(feedback_stream_join(log.where(predictions), older, within, how="inner"))
        missed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        missed.write.mode("overwrite").parquet(f"{path}/upto={mark[0]}_{mark[1]}")
        done.append(mark)
    stored = streamed.where(F.col("feedback_id").isNotNull()).select(*MATCH)
    if done:
        late = spark.read.schema(stored.schema).parquet(*[f"{path}/upto={a}_{b}" for a, b in done])
        stored = stored.unionByName(late)
    return stored.dropDuplicates(["id", "feedback_id"])


def with_unmatched(matches: DataFrame, log: DataFrame) -> DataFrame:
    """All matches, and each prediction without one once, with NULLs."""
    rest = log.join(matches.select("id").distinct(), "id", "left_anti")
    empty = [F.lit(None).cast(matches.schema[c].dataType).alias(c) for c in MATCH[3:]]
    return matches.select(*MATCH).unionByName(rest.select(*MATCH[:3], *empty))
