"""Dense row numbers without sending the table through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.schemas import ROW_NUMBER
from sparkmart.session import scratch_folder, store

_WITHIN_PARTITION = (1 << 33) - 1
#: Parts whose offsets are sent to every task; a part has one short row.
LOOKED_UP = 1 << 18


def number_rows(
    df: DataFrame, order: list[str], first: int = 1, name: str = ROW_NUMBER
) -> DataFrame:
    """Number rows densely in the given total order.

    Rows are range-partitioned on all order columns (so one frequent leading
    value is still spread), sorted and written once together with their
    place. The written places stay fixed if an executor is lost; only the
    partition sizes, one row per partition, go through a single window.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, "numbered")
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN_PARTITION)).alias("_pos"),
    )
    store(in_order, folder)
    placed = spark.read.parquet(folder)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    )
    number = F.col("_offset") + F.col("_pos") + F.lit(first)
    return look_up(placed, offsets, ["_part"]).withColumn(name, number.cast("bigint")).select(name, *df.columns)


def look_up(rows: DataFrame, parts: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """`rows` with the columns of `parts`, a table with one row for each part of the input.

    Up to LOOKED_UP parts are counted, then sent to every task, so that no row
    moves. Beyond that the rows are joined and, if they have an `order`, put
    back into it within each part.
    """
    spark = rows.sparkSession
    own = parts.limit(LOOKED_UP + 1).toArrow()
    if own.num_rows <= LOOKED_UP:
        return rows.join(F.broadcast(spark.createDataFrame(own, parts.schema)), keys, "left")
    joined = rows.join(parts, keys, "left")
    return joined.repartition(*keys).sortWithinPartitions(*keys, *order) if order else joined
