"""Reading and writing ticket tables and logs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom import schemas
from ticketloom.functions.text import left_n
from ticketloom.operators.feedback import insert_ignore
from ticketloom.session import create_once, cut_lineage, folder_names, remove_folder, scratch_scope

JDBC_BATCH = 1000


def read_tickets(spark: SparkSession, path: str, schema: str | None = schemas.RAW_TICKET) -> DataFrame:
    """Parquet tickets with a declared schema, so that no file is opened to infer one."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def spread(df: DataFrame, by: str) -> DataFrame:
    """Rows hashed over all cores if the source has fewer splits than that; else ``df`` as it is.

    For work that is heavy per row on small files. Large inputs have more splits than cores and are not
    shuffled.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, by) if df.rdd.getNumPartitions() < cores else df


def write_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 8, **extra
) -> dict[str, str]:
    """Options for the built-in JDBC source; with a partition column the table is read in parallel."""
    options = {"url": url, "dbtable": table, "batchsize": str(JDBC_BATCH), **extra}
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, name: str, jdbc: dict[str, str] | None = None) -> DataFrame:
    """A catalog table, or a database table when JDBC options are given."""
    if jdbc is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(**jdbc).load()


def replace_table(df: DataFrame, name: str, jdbc: dict[str, str] | None = None, path: str | None = None) -> None:
    """Drop and create with the columns of ``df``; ``path`` keeps the files outside the warehouse folder."""
    if jdbc is None:
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", path) if path else writer).saveAsTable(name)
    else:
        df.write.format("jdbc").options(**jdbc).mode("overwrite").save()


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def reload_table(df: DataFrame, name: str, jdbc: dict[str, str] | None = None) -> None:
    """Empty the table, keep its definition, and load ``df``.

    A file-based table's new rows are written to a folder beside the old one, and the table's location is
    switched when they are complete: a load that fails leaves the table as it was, and readers of the old
    files, which stay until ``drop_old_versions``, can finish. A database truncates instead of dropping.
    """
    if jdbc is None:
        spark = df.sparkSession
        target = spark.table(name)
        version = f"{_location(spark, name).split('-version-')[0]}-version-{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields]).write.parquet(version)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        df.write.format("jdbc").options(**jdbc).option("truncate", "true").mode("overwrite").save()


#: Ids in one reserved range, and the folder of the reservations, which readers of the log pass over.
ID_RANGE = 1 << 24
RESERVED = "_reserved"


def reserve_ranges(spark: SparkSession, path: str, count: int) -> list[int]:
    """Numbers of ranges of ``ID_RANGE`` ids that nobody else gets: each is a file that only one caller can make.

    Range n holds the ids n * ID_RANGE + 1 and on. Ranges of a writer that fails are not used again.
    """
    folder = f"{path}/{RESERVED}"
    taken = folder_names(spark, folder)
    at, mine = max((int(n) for n in taken if n.isdigit()), default=-1) + 1, []
    while len(mine) < count:
        if create_once(spark, f"{folder}/{at:012d}"):
            mine.append(at)
        at += 1
    return mine


def append_log(df: DataFrame, path: str, batch: str, id_col: str = "id") -> DataFrame:
    """Append rows as one named batch with new ids, and return them as stored.

    The rows are counted, ranges of ids are reserved for them, and they are numbered inside: ids are unique by
    construction, nothing stored is read, and writers of different batches do not wait for each other. A batch
    is written once; repeating it fails instead of adding rows twice.
    """
    spark = df.sparkSession
    target = f"{path}/batch={batch}"
    with scratch_scope(spark):
        rows = df.drop(id_col).withColumn("__at", F.monotonically_increasing_id())
        rows = cut_lineage(rows.withColumn("__part", F.shiftright("__at", 33)))
        # one row per partition
        counts = rows.groupBy("__part").agg(F.count("*").alias("__n"))
        before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        shift = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
        ranges = reserve_ranges(spark, path, -(-rows.count() // ID_RANGE))
        place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
        reserved = spark.createDataFrame(list(enumerate(ranges)), "__range bigint, __number bigint")
        numbered = (
            rows.join(F.broadcast(shift), "__part")
            .withColumn("__place", place)
            .withColumn("__range", F.floor(F.col("__place") / ID_RANGE))
            .join(F.broadcast(reserved), "__range")
            .withColumn(id_col, F.col("__number") * ID_RANGE + F.col("__place") % ID_RANGE + 1)
        )
        kept = [c for c in df.columns if c != id_col]
        numbered.select(id_col, *kept).write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)


def drop_old_versions(spark: SparkSession, name: str) -> list[str]:
    """Removes the folders that ``reload_table`` left behind, all but the one the table uses; their names."""
    location = _location(spark, name)
    folder, current = location.rsplit("/", 1)
    stem = current.split("-version-")[0]
    old = [n for n in folder_names(spark, folder) if n != current and (n == stem or n.startswith(f"{stem}-version-"))]
    for n in old:
        remove_folder(spark, f"{folder}/{n}")
    return old


def append_ignore(new: DataFrame, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """Append the rows whose key is not stored yet; returns the stored table."""
    spark = new.sparkSession
    insert_ignore(new, spark.read.parquet(path), keys, order).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def add_columns(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Add nullable columns of the given types unless they exist."""
    missing = {c: F.lit(None).cast(t) for c, t in spec.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def preview_table(df: DataFrame, cols: list[str], n: int, id_col: str, chars: int) -> DataFrame:
    return df.select(id_col, *[left_n(F.col(c), chars).alias(c) for c in cols]).orderBy(id_col).limit(n)
