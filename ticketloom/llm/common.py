"""Helpers shared by the corpus operators: reading, stored steps, dense numbers without a single task."""

from __future__ import annotations

import ctypes
import pickle
import re
import sys
import types
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.session import cut_lineage, free_shuffles

ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 64


#: Bytes of an Arrow batch sent to a Python worker: it is held several times over, on both sides of the pipe.
BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes, unless it has a smaller bound; by default only rows are counted."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(_BATCH_SETTING).lower()).groups()
    bound = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    if not 0 < bound <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gives memory that a task has freed back to the system at its end, as the worker lives on for other tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: fixed rows, whatever executor is lost later.

    What it was made from is not needed again, and its shuffle files are deleted.
    """
    small_batches(df.sparkSession)
    table = cut_lineage(df)
    free_shuffles(df.sparkSession)
    return table


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds ``row_key``, a unique long per row. Only fixed once the result is ``stored``."""
    return df.withColumn("row_key", F.monotonically_increasing_id())


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET, least: int = 1) -> int:
    return max(least, -(-rows // per_bucket))


def running_total(df: DataFrame, by: list[str], amount: str, order: list[str], name: str) -> DataFrame:
    """Adds the sum of ``amount`` over this row and those before it, in the order of a hash of ``order``.

    As in ``numbered``, only buckets and a table of their totals pass through single tasks.
    """
    n = buckets_for(df.count(), least=LEAST_BUCKETS)
    dealt = df.withColumn("__mark", F.xxhash64(*order)).withColumn("__bucket", F.pmod("__mark", F.lit(n)).cast("int"))
    keys = [*by, "__bucket"]
    totals = dealt.groupBy(*keys).agg(F.sum(amount).alias("__n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.select(*keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    upto = Window.partitionBy(*keys).orderBy("__mark", *order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        dealt.withColumn("__upto", F.sum(amount).over(upto))
        .join(shift, keys)
        .withColumn(name, (F.col("__upto") + F.col("__before")).cast("long"))
        .drop("__mark", "__bucket", "__upto", "__before")
    )


def numbered(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Dense numbers from 0 within each value of ``by``, in the order of a hash of ``order``.

    ``order`` must tell rows apart. Rows are dealt into hash buckets of about ``ROWS_PER_BUCKET`` rows,
    numbered inside each, and shifted by the counts of the buckets before: no task holds a whole group.
    """
    one = df.withColumn("__one", F.lit(1))
    return running_total(one, by, "__one", order, name).withColumn(name, F.col(name) - 1).drop("__one")


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def shared(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast that carries its classes with it; for values of a proven size."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(broadcast: Broadcast) -> Any:
    return pickle.loads(broadcast.value)


def worker_state() -> dict[str, Any]:
    """A dict that lives as long as the Python worker, from task to task: for caches of pure functions."""
    return sys.modules.setdefault("_corpus_worker_state", types.ModuleType("_corpus_worker_state")).__dict__
