"""Distinct texts: equal ones are brought together as one, with a mark if there are more."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blobs import buckets

#: Text bytes that array operations take at once; a longer text is taken whole.
STEP_BYTES = 4 << 20
KEYS = ["text_key_1", "text_key_2"]


def text_keys(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text (null counts as empty)."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias(KEYS[0]), F.xxhash64(F.lit("second"), whole).alias(KEYS[1])]


def distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    """`bucket`, keys and `text`, dealt by bucket; at most two rows of a text from each task, the second without the text.

    Copies are dropped before the shuffle, so a text that fills a third of all
    rows sends two rows per task.
    """
    n = buckets(docs)

    def first_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            keep, bare = [], []
            for i, key in enumerate(zip(*(batch[k].to_pylist() for k in KEYS), strict=True)):
                before = seen.get(key, 0)
                if before < 2:
                    seen[key] = before + 1
                    keep.append(i)
                    bare.append(before == 1)
            if keep:
                own = batch.take(pa.array(keep))
                whole = pc.if_else(pa.array(bare), pa.scalar(None, pa.string()), own["text"])
                yield pa.RecordBatch.from_arrays([own["bucket"], *(own[k] for k in KEYS), whole], names=["bucket", *KEYS, "text"])

    keys = text_keys(F.col(text))
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), *keys)
    rows = rows.select(F.pmod(F.col(KEYS[0]), F.lit(n)).cast("int").alias("bucket"), *KEYS, "text")
    sent = rows.mapInArrow(first_two, f"bucket int, {KEYS[0]} long, {KEYS[1]} long, text string")
    return sent.repartition(n // 2, "bucket")


def gathered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The distinct texts of one bucket in the order of their keys, and which of them have copies."""
    table = table.sort_by([*((k, "ascending") for k in KEYS), ("text", "ascending")])  # null last
    keys = [table[k].to_numpy() for k in KEYS]
    new = np.ones(table.num_rows, bool)
    new[1:] = (keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
    first = np.flatnonzero(new)
    return table.take(pa.array(first)), np.diff(np.append(first, table.num_rows)) > 1


def steps(batches: Iterator[pa.RecordBatch], most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches whose last column holds about `most` bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for i, own in enumerate(sizes.tolist()):
            if size and size + own > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += own
        if start < batch.num_rows:
            yield batch.slice(start)
