"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine is tuned for.  AQE picks join strategies from measured
#: sizes, splits skewed shuffle partitions and merges small ones, so no plan in
#: this package carries a broadcast hint.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Call-site capture costs several round trips to the JVM per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", app: str = "tutorlake", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    It is read from ``spark.checkpoint.dir``.  Only where a local session names
    none is a temporary folder chosen; on a cluster that is an error, because a
    machine-local folder is lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="tutorlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scope: contextvars.ContextVar[str | None] = contextvars.ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or below the folder of the scope that it is asked for in."""
    return f"{_scope.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession, label: str) -> Iterator[None]:
    """Tables stored inside go when the scope ends; what is to stay must have been written elsewhere by then."""
    folder = scratch_path(spark, label)
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        remove_path(spark, folder)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back.

    For results with several readers: each would otherwise compute it again,
    and a lost executor would send Spark back to the sources.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    # Once the table is written nothing reads the shuffles behind it; without this they stay until the driver collects garbage.
    kept = spark.conf.get(_CLEAN_SHUFFLES, None)
    spark.conf.set(_CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if kept is None:
            spark.conf.unset(_CLEAN_SHUFFLES)
        else:
            spark.conf.set(_CLEAN_SHUFFLES, kept)
    return spark.read.schema(df.schema).parquet(path)
