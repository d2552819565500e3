"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "ratescape", **extra: str) -> SparkSession:
    """A session with adaptive execution on; cluster settings stay the cluster's."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session without one gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = context.applicationId
        if app not in _LOCAL_SCRATCH:
            _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="ratescape-")
        base = _LOCAL_SCRATCH[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Tasks per core that list folders.
LISTING_TASKS = 4
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def list_in_few_tasks(spark: SparkSession) -> None:
    """List folders in a few tasks per core of this session, not in up to 10,000 tasks whose records the driver keeps."""
    tasks = LISTING_TASKS * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(_LISTING)) > tasks:
        spark.conf.set(_LISTING, tasks)


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver's heap be collected, on which Spark's cleaner removes the shuffle files of steps that are done and stored.

    Left alone they stay until the heap fills or half an hour has passed, and those of all steps add up on disk.
    """
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    For results that several later steps use: they start from the stored rows
    instead of repeating the work, also after executors are lost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
