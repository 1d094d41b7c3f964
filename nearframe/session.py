"""Session helpers: checkpoint folder and a local session for tests/bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Resolve the checkpoint folder from the session (``spark.checkpoint.dir``).

    On a cluster this must be a shared folder named by the cluster's
    configuration; nothing here invents a machine-local one there. Only a
    local-mode session without the setting (tests, a laptop) gets a fresh
    temporary folder, since its executors share the driver's disk.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="nearframe-ckpt-")
    sc.setCheckpointDir(d)
    return d


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def storable(kind: T.DataType) -> bool:
    """Whether Parquet gives columns of this type back as they were."""
    if isinstance(kind, T.StructType):
        names = {f.name.lower() for f in kind.fields}
        return 0 < len(names) == len(kind.fields) and all(storable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return storable(kind.elementType)
    if isinstance(kind, T.MapType):
        return storable(kind.keyType) and storable(kind.valueType)
    plain = (T.BooleanType, T.IntegralType, T.FractionalType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return isinstance(kind, plain) or type(kind) is T.StringType


def release(spark: SparkSession) -> None:
    """Spark deletes files of shuffles that nothing refers to when the driver's JVM collects
    its garbage, which a driver with a quiet heap seldom does by itself."""
    spark.sparkContext._jvm.System.gc()


def store(df: DataFrame) -> DataFrame:
    """The rows as Parquet files in the checkpoint folder, one a partition and in its
    order: a reliable checkpoint with compressed columns, each read only where it is used."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", app: str = "nearframe", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks.

    Sets a checkpoint folder only when none is configured (a fresh temporary
    folder per session, as tests need); a cluster's setting is kept.
    """
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # tables of a local session (stored indexes name their own folder) leave nothing behind
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="nearframe-warehouse-"))
        # checkpoint files of frames that are no longer referenced are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("NEARFRAME_DRIVER_MEMORY", "16g"))
    )
    ev = os.environ.get("NEARFRAME_EVENT_LOG_DIR")
    if ev:  # stage timings for profiling, written to a folder the caller names
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", ev)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
