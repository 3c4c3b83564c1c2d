"""Numpy columns that Spark shuffles as binary rows, one row per sender and bucket.

Millions of small records then cost a handful of rows. Buckets grow in number
with the shuffle partitions, and those with the input, so that a bucket fits
in one task whatever the size of the input.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Input bytes that one partition is planned for.
PARTITION_BYTES = 64 << 20
BUCKETS_PER_PARTITION = 2


def planned_bytes(frame: DataFrame) -> int:
    """The planner's size estimate; of an unsized frame, what the session's shuffle partitions are planned for."""
    size = int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size < 1 << 50  # what unsized frames come to, also after a projection, says nothing
    return size if known else PARTITION_BYTES * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def partitions(frame: DataFrame) -> int:
    """Shuffle partitions for work over `frame`: the session's number, or more if the planner's size estimate asks for it."""
    session = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(session, math.ceil(planned_bytes(frame) / PARTITION_BYTES))


def buckets(frame: DataFrame) -> int:
    return BUCKETS_PER_PARTITION * partitions(frame)


def pack(bucket: np.ndarray, sender: int, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row per bucket that occurs, with the values of each column in one binary."""
    order = np.argsort(bucket, kind="stable")
    at = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    bounds = np.append(starts, len(at))
    out = {"bucket": pa.array(at[starts].astype(np.int32)), "sender": pa.array(np.full(len(starts), sender, np.int32))}
    for name, values in columns.items():
        own = np.ascontiguousarray(values[order])
        places = (bounds * own.itemsize).astype(np.int32)
        out[name] = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(own)])
    return pa.table(out)


def unpack(table: pa.Table, kinds: dict[str, type]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The packed values of all rows, and the row that each value is from."""
    out, counts = {}, None
    for name, kind in kinds.items():
        rows = table[name].to_pylist()
        out[name] = np.frombuffer(b"".join(rows), kind)
        if counts is None:
            counts = np.fromiter(map(len, rows), np.int64, len(rows)) // np.dtype(kind).itemsize
    return np.repeat(np.arange(table.num_rows), counts), out


def schema(columns: dict[str, type]) -> str:
    return ", ".join(["bucket int", "sender int", *(f"{name} binary" for name in columns)])


def empty(columns: dict[str, type]) -> pa.Table:
    return pack(np.zeros(0, np.int64), 0, {k: np.zeros(0, kind) for k, kind in columns.items()})
