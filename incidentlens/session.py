"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# paths of the tables that the innermost `settled` has written
_written: ContextVar[list[str]] = ContextVar("_written")


def build_session(app: str = "incidentlens", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC dates and adaptive execution; everything sized by the
    cluster is left to its own configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # no Python call site per column expression: halves plan building time
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir.

    Only a local session may fall back to a folder of its own; on a cluster
    intermediate tables must outlive any single machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="incidentlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores if it has fewer partitions than the session
    has cores (a few small files ahead of costly parsing).  A scan that already
    has enough partitions is returned as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _own_scratch(spark: SparkSession) -> str:
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/incidentlens/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, at the end of a job.
    DataFrames that still read them stop working."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(_own_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage in iterative jobs and lets a result be used several times
    without recomputing it.  Being an ordinary table it survives the loss of
    executors, keeps column pruning, and has a known size and row count."""
    path = f"{_own_scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (inside := _written.get(None)) is not None:
        inside.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(build: Callable[[], DataFrame | tuple[DataFrame, ...]]) -> DataFrame | tuple[DataFrame, ...]:
    """Materialize what `build` returns (one or several) and delete the tables that were
    written on the way to it, so that the disk holds those of one operator at a time.
    Shuffle files go with the query that wrote them, and not when the driver happens to
    collect its garbage."""
    spark = SparkSession.active()
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    token = _written.set(on_the_way := [])
    try:
        out = build()
        _written.reset(token)
        token = None
        kept = tuple(materialize(df) for df in out) if isinstance(out, tuple) else materialize(out)
    finally:
        if token is not None:
            _written.reset(token)
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for name in on_the_way:
        path = hadoop.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return kept
