"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_TEST_DIRS: dict[str, str] = {}


def build_session(app: str = "ticketloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; keyword arguments override any of them.

    Number of shuffle partitions is left to AQE: start high, let it coalesce.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # state of streams on disk, not on the executors' heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session (tests) may fall back to a folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if sc.applicationId not in _TEST_DIRS:
        _TEST_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="ticketloom-")
        sc.setCheckpointDir(_TEST_DIRS[sc.applicationId])
    return _TEST_DIRS[sc.applicationId]


@dataclass
class Scope:
    """Owns the scratch folders made while it is open."""

    paths: list[str] = field(default_factory=list)
    outer: Scope | None = None

    def kept(self, df: DataFrame) -> DataFrame:
        """``df`` stored outside this scope, for use after it is closed."""
        token = _SCOPE.set(self.outer)
        try:
            return cut_lineage(df)
        finally:
            _SCOPE.reset(token)


_SCOPE: ContextVar[Scope | None] = ContextVar("ticketloom_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Intermediate tables written inside are removed at the end, also after an error.

    A DataFrame that still reads them has to be stored by ``kept`` first. Shuffle files of finished plans go too.
    """
    scope = Scope(outer=_SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            remove_folder(spark, path)
        free_shuffles(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder; it belongs to the open scope, if there is one."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (scope := _SCOPE.get()) is not None:
        scope.paths.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read back.

    Later steps see its true size and read only the columns they need, and a lost executor costs
    nothing that was computed before.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of finished plans.

    It does so when the driver collects its garbage, which an idle driver may not do for long.
    """
    spark.sparkContext._jvm.System.gc()


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the path itself, as Spark itself opens them."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, from one listing; none if there is no such folder."""
    system, found = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(found)) if system.exists(found) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    system, found = _file_system(spark, path)
    system.delete(found, True)


def create_once(spark: SparkSession, path: str) -> bool:
    """Makes an empty file unless it is there; of several callers exactly one is told that it made it.

    File systems with an exclusive creation (HDFS and those like it, local ones) decide between the callers.
    """
    system, found = _file_system(spark, path)
    system.mkdirs(found.getParent())
    if system.getScheme() == "file":
        try:
            with open(found.toUri().getPath(), "x"):
                return True
        except FileExistsError:
            return False
    try:
        system.create(found, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    return True
