"""Embedding near-dedup by an epsilon grid order join (operator 6).

Unit vectors with a cosine of at least c lie within eps = sqrt(2 - 2c) of each
other. Vectors are turned so that the principal dimensions lead, and sorted by
their grid cells of width eps in the leading ones. The sequence is cut into
intervals; two intervals meet if their cells in the first dimension touch and
their boxes are no further apart than eps. Parts of the table of intervals meet
where they are read, so no pair of intervals is written or shuffled. A meeting
splits both sequences again and again, drops parts whose boxes are too distant,
and compares what is left by products in double precision.

A meeting says how many links each vector has and which vectors hang together,
not every link, so a group of near copies costs as many rows as it has vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blobs
from .components import components, local_labels, written

COSINE = 0.95
#: Leading dimensions that sort and that boxes are kept for; vectors in one interval; rows compared without further splits.
GRID, BOXED, INTERVAL, LEAF = 8, 16, 2048, 128


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _axes(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and principal axes of the unit vectors; sums of fixed size come to the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square, n = np.zeros(width), np.zeros((width, width)), 0
        for batch in batches:
            x = _unit(_matrix(batch["vector"], width))
            total, square, n = total + x.sum(axis=0), square + x.T @ x, n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()]), pa.array([square.ravel().tolist()])], names=["n", "total", "square"])

    rows = vectors.select("vector").mapInArrow(sums, "n long, total array<double>, square array<double>")
    n = rows.agg(F.sum("n")).first()[0] or 0
    if not n:
        return np.zeros(width), np.eye(width)
    summed = rows.select(F.posexplode("total").alias("i", "x"), F.lit(0).alias("kind")).union(rows.select(F.posexplode("square").alias("i", "x"), F.lit(1).alias("kind")))
    mean, square = np.zeros(width), np.zeros(width * width)
    for r in summed.groupBy("kind", "i").agg(F.sum("x").alias("x")).collect():
        (square if r["kind"] else mean)[r["i"]] = r["x"] / n
    _, axes = np.linalg.eigh(square.reshape(width, width) - np.outer(mean, mean))
    return mean, axes[:, ::-1]


def _unit(x: np.ndarray) -> np.ndarray:
    # components are scaled first: squares of very large or small ones have no double
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class _Meeting:
    """Two intervals (or one with itself) and what is found between them."""

    def __init__(self, left: dict, right: dict | None, cosine: float):
        self.left, self.right, self.cosine = left, left if right is None else right, cosine
        self.same = right is None
        self.eps2 = 2 - 2 * cosine + 1e-9
        self.n = len(left["x"])
        self.counts = [np.zeros(len(side["x"]), np.int64) for side in (self.left, self.right)]
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.boxes: list[dict] = [{}, {}]

    def _box(self, side: int, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        known = self.boxes[side]
        if (a, b) not in known:
            own = (self.left, self.right)[side]["lead"][a:b]
            known[a, b] = own.min(axis=0), own.max(axis=0)
        return known[a, b]

    def join(self, a: int, b: int, c: int, d: int) -> None:
        """Rows a..b of the left sequence with c..d of the right one."""
        if self.same and c < a:
            return
        (low, high), (other_low, other_high) = self._box(0, a, b), self._box(1, c, d)
        gap = np.maximum(np.maximum(other_low - high, low - other_high), 0)
        if gap @ gap > self.eps2:
            return
        if b - a <= LEAF and d - c <= LEAF:
            self._compare(a, b, c, d)
            return
        left = [(a, b)] if b - a <= LEAF else [(a, _half(a, b)), (_half(a, b), b)]
        right = [(c, d)] if d - c <= LEAF else [(c, _half(c, d)), (_half(c, d), d)]
        for p in left:
            for q in right:
                self.join(*p, *q)

    def _compare(self, a: int, b: int, c: int, d: int) -> None:
        close = self.left["x"][a:b] @ self.right["x"][c:d].T >= self.cosine
        if self.same and a == c:
            np.fill_diagonal(close, False)
        rows, columns = np.nonzero(close)
        if not len(rows):
            return
        self.counts[0][a:b] += close @ self.right["weight"][c:d]
        if not (self.same and a == c):
            self.counts[1][c:d] += self.left["weight"][a:b] @ close
        self.edges.append((rows + a, columns + c + (0 if self.same else self.n)))

    def hang_together(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.n + (0 if self.same else len(self.right["x"]))
        if not self.edges:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        labels = local_labels(n, np.concatenate([e[0] for e in self.edges]), np.concatenate([e[1] for e in self.edges]))
        at = np.flatnonzero(labels != np.arange(n))
        return at, labels[at]


def _half(a: int, b: int) -> int:
    """Halves by whole leaves, so that both sides of a meeting of an interval with itself split alike."""
    leaves = -(-(b - a) // LEAF)
    return a + (leaves // 2) * LEAF


def near_vectors(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Key, `n_links`, `component_id` and `kept` of every row.

    Links join rows whose vectors have a cosine of at least `cosine`, in double
    precision. Null, empty and zero vectors and those with null or non-finite
    components link with nothing; vectors of different lengths don't link.
    Equal vectors are compared once and weigh as many as they are. A null key
    is never the smallest of a component; a row without links keeps its own.
    """
    columns = frame.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    if dict(columns.dtypes)["vector"] != "array<float>":  # floats stay as they are until they are compared, in half the space
        columns = columns.withColumn("vector", F.col("vector").cast("array<double>"))
    finite = F.coalesce(F.size("vector") > 0, F.lit(False)) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    columns = columns.withColumn("fine", F.coalesce(finite, F.lit(False)))
    keys = [F.xxhash64("vector").alias("one"), F.xxhash64(F.lit("second"), "vector").alias("two")]
    rows = written(columns.select("key", "fine", *keys, F.size("vector").alias("width")), "vectors")
    ref = F.xxhash64("one", "two").alias("ref")
    reps = written(rows.where("fine").groupBy("one", "two").agg(F.count("*").alias("weight"), F.first("width").alias("width")).select("*", ref), "distinct_vectors")
    links = None
    for width, n in sorted(tuple(r) for r in reps.groupBy("width").count().collect()):
        own = _links(columns.where(F.col("fine") & (F.size("vector") == width)).select(*keys, "vector"), width, n, cosine)
        links = own if links is None else links.union(own)
    if links is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.col("key").isNotNull().alias("kept"))
    counts = links.where("a is null").groupBy("ref").agg(F.sum("n").alias("n"))
    labels = components(links.where("a is not null").select("a", "b"))
    found = reps.join(counts, "ref", "left").join(labels.withColumnRenamed("node", "ref"), "ref", "left")
    found = found.select("one", "two", "ref", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("label", "ref").alias("label"))
    out = rows.drop("width").join(found, ["one", "two"], "left")
    out = written(out.select("key", "fine", "n", "label"), "linked_vectors")
    smallest = out.where("fine").groupBy("label").agg(F.min("key").alias("smallest"))
    out = out.join(smallest, "label", "left")
    component = F.when(F.col("fine"), F.coalesce("smallest", "key")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.when(F.col("fine"), F.col("n")).otherwise(0).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))


def _links(vectors: DataFrame, width: int, n: int, cosine: float) -> DataFrame:
    """Rows `ref, n` (links of a vector, from one meeting) and `a, b` (two refs that hang together) of the `n` different vectors of a width."""
    mean, axes = _axes(vectors, width)
    element = dict(vectors.dtypes)["vector"]
    kind = np.dtype(np.float32 if element == "array<float>" else np.float64)
    reps = vectors.groupBy("one", "two").agg(F.count("*").alias("weight"), F.first("vector").alias("vector")).select(F.xxhash64("one", "two").alias("ref"), "weight", "vector")
    eps = math.sqrt(2 - 2 * cosine)
    grid, boxed = min(GRID, width), min(BOXED, width)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch["vector"], width))
            cell = np.floor(((x - mean) @ axes[:, :grid]) / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch["ref"], batch["weight"], batch["vector"], *(pa.array(cell[:, i]) for i in range(grid))], names=["ref", "weight", "vector", *(f"c{i}" for i in range(grid))])

    order = [*(f"c{i}" for i in range(grid)), "ref"]
    celled = reps.mapInArrow(cells, f"ref long, weight long, vector {element}, " + ", ".join(f"c{i} int" for i in range(grid)))
    planned = -(-n * width * kind.itemsize // blobs.PARTITION_BYTES)
    parts = max(1, min(max(planned, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))), -(-n // INTERVAL)))
    sequence = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = 0, []

        def cut(table: pa.Table) -> pa.RecordBatch:
            lead = (_unit(_matrix(table["vector"], width)) - mean) @ axes[:, :boxed]
            values = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
            name = TaskContext.get().partitionId() << 32 | number
            first = table["c0"].to_numpy()
            blob = [table["ref"].to_numpy().tobytes(), table["weight"].to_numpy().tobytes(), values.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([int(first.min())], pa.int32()), pa.array([int(first.max())], pa.int32()), pa.array([lead.min(axis=0).tolist()]), pa.array([lead.max(axis=0).tolist()]), *(pa.array([b]) for b in blob)],
                names=["interval", "from_cell", "to_cell", "low", "high", "refs", "weights", "x"],
            )

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held)
            while table.num_rows >= INTERVAL:
                yield cut(table.slice(0, INTERVAL))
                table, number = table.slice(INTERVAL), number + 1
            held = [table]
        if held and held[0].num_rows:
            yield cut(held[0])

    blocks = written(sequence.mapInArrow(intervals, "interval long, from_cell int, to_cell int, low array<double>, high array<double>, refs binary, weights binary, x binary"), "intervals")
    one, two = (blocks.select(*[F.col(c).alias(f"{c}_{side}") for c in blocks.columns]) for side in "ij")
    # a product of partitions: each task reads one of either side; a hash join would write each interval once for every other
    pairs = one.join(two.hint("shuffle_replicate_nl"), _meets(eps))

    def side(row: dict, of: str) -> dict:
        x = _unit(np.frombuffer(row[f"x_{of}"], kind).astype(np.float64).reshape(-1, width))
        return {"ref": np.frombuffer(row[f"refs_{of}"], np.int64), "weight": np.frombuffer(row[f"weights_{of}"], np.int64), "x": x, "lead": (x - mean) @ axes[:, :boxed]}

    def meet(row: dict) -> pa.Table:
        sides = [side(row, "i")] if row["interval_i"] == row["interval_j"] else [side(row, "i"), side(row, "j")]
        meeting = _Meeting(sides[0], sides[1] if len(sides) > 1 else None, cosine)
        meeting.join(0, len(sides[0]["x"]), 0, len(sides[-1]["x"]))
        ref = np.concatenate([s["ref"] for s in sides])
        if meeting.same:
            counts = meeting.counts[0] + meeting.counts[1]
        else:
            counts = np.concatenate(meeting.counts)
        hit = np.flatnonzero(counts)
        a, b = meeting.hang_together()
        n, m = len(hit), len(a)
        none = pa.nulls
        return pa.table(
            {
                "ref": pa.chunked_array([pa.array(ref[hit]), none(m, pa.int64())]),
                "n": pa.chunked_array([pa.array(counts[hit]), none(m, pa.int64())]),
                "a": pa.chunked_array([none(n, pa.int64()), pa.array(ref[a])]),
                "b": pa.chunked_array([none(n, pa.int64()), pa.array(ref[b])]),
            }
        )

    def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from meet(batch.slice(k, 1).to_pylist()[0]).combine_chunks().to_batches()

    own = [f"{c}_{side}" for side in "ij" for c in ("interval", "refs", "weights", "x")]
    return written(pairs.select(*own).mapInArrow(meetings, "ref long, n long, a long, b long"), "meetings")


def _meets(eps: float) -> Column:
    """Whether two intervals are near, for one order of each pair; which one changes, so that about half the pairs of two partitions are met in either order."""
    i, j = F.col("interval_i"), F.col("interval_j")
    number = lambda x: x + F.shiftright(x, 32)
    ordered = (i == j) | ((i < j) == ((number(i) + number(j)) % 2 == 0))
    touch = (F.col("from_cell_j") <= F.col("to_cell_i") + 1) & (F.col("from_cell_i") <= F.col("to_cell_j") + 1)
    gap = F.zip_with(F.zip_with("low_j", "high_i", lambda a, b: a - b), F.zip_with("low_i", "high_j", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    return ordered & touch & (apart <= eps * eps + 1e-9)
