"""Session settings and shared storage locations."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Every setting here can also be changed on a running session.
SESSION_SETTINGS = {
    # dates and NTZ timestamps must not move with the host's zone
    "spark.sql.session.timeZone": "UTC",
    # raw records repeat keys; the last value wins, as in JSON parsers of the source system
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the JVM does not compile larger methods; Spark then splits wide nested projections
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # what a stored table was shuffled through goes when it is written, not when the driver next collects garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # texts can be long: a batch handed to Python stays small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}

_OWN_DIRS: dict[str, str] = {}
_RECORDS: list[list[str]] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "stratalake", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one ``spark.checkpoint.dir`` names.

    Where the setting is missing in local mode (driver and executors are one machine), one
    folder per application is made, set as the checkpoint folder and removed at exit; on a
    cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    if context.applicationId not in _OWN_DIRS:
        own = tempfile.mkdtemp(prefix="stratalake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _OWN_DIRS[context.applicationId] = own
    return _OWN_DIRS[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/stratalake-{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """Store a table in the shared folder and read it from there: it survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._kept_path = path
    for paths in _RECORDS[-1:]:
        paths.append(path)
    return stored


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of all tables that ``keep`` stores inside the block, for ``remove``."""
    paths: list[str] = []
    _RECORDS.append(paths)
    try:
        yield paths
    finally:
        _RECORDS.remove(paths)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``keep`` stored, once all that reads them is stored itself."""
    for table in tables:
        remove(table.sparkSession, table._kept_path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
