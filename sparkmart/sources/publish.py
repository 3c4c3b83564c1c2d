"""Snapshots that become visible all at once.

A run writes its zones under its own folder. Only when every check has passed
does one row appended to the publication log name it. The row appears whole or
not at all, so readers see the old or the new snapshot, and a failed run
leaves nothing visible.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators.checks import ContractError
from sparkmart.schemas import zone_tables

LOG = "published"


@dataclass(frozen=True)
class Snapshot:
    """Zones of one run: ``<out>/runs/<run id>/<zone>/<table>``."""

    spark: SparkSession
    out: str
    run_id: str

    def path(self, zone: str, table: str) -> str:
        return f"{self.out}/runs/{self.run_id}/{zone}/{table}"

    def write(
        self, zone: str, table: str, df: DataFrame, partition_by: list[str] | None = None
    ) -> DataFrame:
        """Write a table of the snapshot and return it as stored."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(zone, table))
        return self.read(zone, table)

    def read(self, zone: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(zone, table))


def new_snapshot(spark: SparkSession, out: str) -> Snapshot:
    return Snapshot(spark, out.rstrip("/"), uuid.uuid4().hex)


def publish(snapshot: Snapshot) -> None:
    """Make a finished snapshot the current one."""
    row = snapshot.spark.range(1).select(
        F.lit(snapshot.run_id).alias("run_id"), F.current_timestamp().alias("published_at")
    )
    row.write.mode("append").parquet(f"{snapshot.out}/{LOG}")


def current_snapshot(spark: SparkSession, out: str) -> Snapshot:
    """The snapshot published last."""
    out = out.rstrip("/")
    try:
        log = spark.read.parquet(f"{out}/{LOG}")
    except AnalysisException as error:
        raise FileNotFoundError(f"no published snapshot in {out}") from error
    return Snapshot(spark, out, log.orderBy(F.col("published_at").desc()).first().run_id)


def create_empty_zones(spark: SparkSession, out: str) -> Snapshot:
    """Publish a snapshot whose tables all exist and are empty."""
    snapshot = new_snapshot(spark, out)
    for zone, tables in zone_tables().items():
        for table, schema in tables.items():
            snapshot.write(zone, table, spark.createDataFrame([], schema))
    publish(snapshot)
    return snapshot


def require_rows(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise ContractError(f"{name} is empty")
