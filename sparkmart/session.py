"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.java_gateway import JavaObject
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

# Runtime settings the plans rely on: adaptive joins turn small sides into
# broadcasts after measuring them and split skewed partitions of large ones.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Bytes of the driver's heap for each of several jobs at a time: for its plans, and for the states of its tasks by shuffle partition.
JOB_HEAP, TASK_HEAP = 64 << 20, 1 << 20
#: Up to this heap, garbage is collected when more than a part of it is taken.
SMALL_HEAP, TAKEN = 2 << 30, 0.5

_fallback: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may
    fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _fallback:
        _fallback[application] = tempfile.mkdtemp(prefix="sparkmart-")
    return _fallback[application]


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder; never reused."""
    return f"{shared_folder(spark)}/sparkmart/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: later steps read it instead of computing it again, and its size is known."""
    folder = scratch_folder(df.sparkSession, name)
    store(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def store(df: DataFrame, folder: str, *parts: str) -> None:
    """Write ``df``. A driver with little heap then collects the garbage of the job: else its heap grows to the limit, and shuffle files stay until it does."""
    df.write.partitionBy(*parts).parquet(folder)
    heap = _heap()
    if heap.maxMemory() <= SMALL_HEAP and heap.totalMemory() > TAKEN * heap.maxMemory():
        heap.gc()


def _heap() -> JavaObject:
    return SparkContext._active_spark_context._jvm.java.lang.Runtime.getRuntime()


def jobs_at_a_time() -> int:
    """Jobs that the driver's heap has room for."""
    spark = SparkSession.getActiveSession() or SparkSession._instantiatedSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _heap().maxMemory() // (JOB_HEAP + TASK_HEAP * partitions)


def in_parallel(actions: list[Callable[[], Result]]) -> list[Result]:
    """Start independent jobs together, so that small ones do not wait for each other.

    The driver's heap has to hold the plans and task states of all that run, so
    a small one takes fewer at a time, the larger the jobs are.
    """
    if len(actions) < 2 or (jobs := min(len(actions), jobs_at_a_time())) < 2:
        return [action() for action in actions]
    with ThreadPoolExecutor(jobs) as pool:
        return list(pool.map(lambda action: action(), actions))
