"""Run records: parameters, scores and outcome of one run as nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import schemas


def write_run_record(record: DataFrame, path: str) -> None:
    record.write.mode("overwrite").json(path)


def append_run_record(record: DataFrame, path: str) -> None:
    record.write.mode("append").json(path)


def read_run_record(spark: SparkSession, path: str, schema: str = schemas.RUN_RECORD) -> DataFrame:
    """Records with a declared schema: one per line, or one pretty-printed document per file.

    A file is of the second kind if its first line is not JSON by itself. Files hold the records of one run
    and are small.
    """
    files = spark.read.text(path, wholetext=True)
    whole = F.get_json_object(F.substring_index("value", "\n", 1), "$").isNull()
    lines = F.when(whole, F.array("value")).otherwise(F.split("value", "\n"))
    parsed = files.select(F.explode(lines).alias("line")).where(F.trim("line") != "")
    return parsed.select(F.from_json("line", schema).alias("r")).select("r.*")
