"""Interventional Shapley values of tree ensembles, from the conditions on the paths to their leaves.

A leaf is reached by a row mixed with a background row if each of its k
conditions is met by the one that the feature comes from. Of a pair with a
conditions that only the row meets and b that only the background row meets,
and none that neither meets, each of the a features gets (a-1)! b! / (a+b)! of
the leaf's value and each of the b features loses a! (b-1)! / (a+b)! of it. As
the background rows that count meet all that the row doesn't, b follows from
the row alone and a from the background row alone; both are summed for the
conditions that rows really meet, at a cost of rows x background x k.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import factorial, prod
from typing import Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import written

#: Bytes of leaves that are sent to every task at once; larger models go in several passes over the rows.
LEAF_BYTES = 64 << 20
#: Conditions up to which met ones are looked up in a table instead of sorted.
TABLED = 12
#: States of a row that a group of leaves may tell apart, and of a single leaf; rows that are explained at once.
STATES, GROUPED, ROWS = 1 << 11, 1 << 20, 1 << 16

LEAF = "tree int, value double, features array<int>, low array<double>, high array<double>, other array<long>, n array<long>"


def _weights(most: int = 64) -> tuple[np.ndarray, np.ndarray]:
    gain, loss = np.zeros((most, most)), np.zeros((most, most))
    for a in range(most):
        for b in range(most - a):
            if a:
                gain[a, b] = factorial(a - 1) * factorial(b) / factorial(a + b)
            if b:
                loss[a, b] = factorial(a) * factorial(b - 1) / factorial(a + b)
    return gain, loss


GAIN, LOSS = _weights()


def _paths(nodes: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[int, tuple[float, float]]]]:
    """Leaves of a tree with the range each split feature must lie in."""
    at = {int(i): row for row, i in enumerate(nodes["id"])}
    stack = [(0, {})]
    while stack:
        node, ranges = stack.pop()
        row = at[node]
        if nodes["left"][row] < 0:
            if ranges:
                yield row, ranges
            continue
        feature, cut = int(nodes["feature"][row]), float(nodes["cut"][row])
        low, high = ranges.get(feature, (-np.inf, np.inf))
        stack.append((int(nodes["left"][row]), {**ranges, feature: (low, min(high, cut))}))
        stack.append((int(nodes["right"][row]), {**ranges, feature: (max(low, cut), high)}))


def _met(columns: np.ndarray, features: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The conditions each row meets, one bit each; ``columns`` has a row per feature."""
    out = np.zeros(columns.shape[1], np.int64)
    for j, f in enumerate(features):
        out |= ((columns[f] > low[j]) & (columns[f] <= high[j])).astype(np.int64) << j
    return out


def tree_leaves(spark: SparkSession, model_folder: str, background: np.ndarray, boosted: bool) -> DataFrame:
    """One row per leaf of a saved ensemble: its value, conditions, and those that background rows meet.

    Boosted trees explain log-odds, forests the probability. Each tree is
    unfolded in a task of its own; its size is bounded by the model's depth.
    """
    trees = spark.read.parquet(f"{model_folder}/treesMetadata").toDF("tree", "about", "weight")
    scale = 2.0 if boosted else 1.0 / trees.agg(F.sum("weight")).first()[0]
    scaled = trees.select("tree", (F.col("weight") * F.lit(scale)).alias("weight"))
    stats = F.col("nodeData.impurityStats")
    value = F.col("nodeData.prediction") if boosted else stats[1] / (stats[0] + stats[1])
    nodes = spark.read.parquet(f"{model_folder}/data").select(
        F.col("treeID").cast("int").alias("tree"),
        "nodeData.id",
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), F.lit(0)).alias("cut"),
        value.alias("value"),
    )
    columns = np.ascontiguousarray(background.T)

    def unfold(table: pa.Table) -> pa.Table:
        names = ("id", "left", "right", "feature", "cut", "value", "weight")
        own = {c: table[c].to_numpy() for c in names}
        rows = []
        for row, ranges in _paths(own):
            features = np.array(list(ranges))
            low, high = (np.array([r[i] for r in ranges.values()]) for i in (0, 1))
            other, n = np.unique(_met(columns, features, low, high), return_counts=True)
            leaf = (float(own["value"][row] * own["weight"][row]), features, low, high, other, n)
            rows.append((int(table["tree"][0].as_py()), *leaf))
        types = [pa.int32(), pa.float64(), pa.list_(pa.int32()), *[pa.list_(pa.float64())] * 2, *[pa.list_(pa.int64())] * 2]
        values = list(zip(*rows, strict=True)) or [[]] * len(types)
        arrays = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
        return pa.table(arrays, names=[c.split()[0] for c in LEAF.split(", ")])

    return written(nodes.join(scaled, "tree").groupBy("tree").applyInArrow(unfold, LEAF), "leaves")


def _add(out: np.ndarray, columns: np.ndarray, leaf: dict) -> None:
    """Add what one leaf gives the features of each row."""
    features, other, n = leaf["features"], leaf["other"], leaf["n"]
    k = len(features)
    met = _met(columns, features, leaf["low"], leaf["high"])
    if k <= TABLED:
        seen = np.zeros(1 << k, bool)
        seen[met] = True
        own = np.flatnonzero(seen)
        place = np.cumsum(seen) - 1
        rows = place[met]
    else:
        own, rows = np.unique(met, return_inverse=True)
    bits = np.arange(k)
    missing = ~own & ((1 << k) - 1)
    pairs = ((~other[None, :] & missing[:, None]) == 0) * n.astype(float)
    a, b = k - np.bitwise_count(other), k - np.bitwise_count(own)
    holds = (own[:, None] >> bits) & 1
    lacks = 1.0 - ((other[:, None] >> bits) & 1)
    gain, loss = (w[: k + 1, : k + 1].T.take(b, axis=0).take(a, axis=1) for w in (GAIN, LOSS))
    gains = (pairs * gain) @ lacks
    losses = np.einsum("ij,ij->i", pairs, loss)
    shares = np.where(holds, gains, -losses[:, None]) * (leaf["value"] / n.sum())
    out[features] += np.ascontiguousarray(shares.T).take(rows, axis=1, mode="clip")


def _passes(leaves: DataFrame) -> int:
    size = F.size("features") * 20 + F.size("other") * 16 + 12
    total = leaves.agg(F.sum(size)).first()[0] or 0
    return max(1, -(-total // LEAF_BYTES))


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> list[dict]:
    table = pa.ipc.open_stream(packed).read_all().combine_chunks()
    values = table["value"].to_numpy()
    out = [{"value": float(v)} for v in values]
    for c in ("features", "low", "high", "other", "n"):
        for column, start in zip(table[c].chunks, np.cumsum([0, *map(len, table[c].chunks)]).tolist()):
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            for i in range(len(column)):
                out[start + i][c] = flat[ends[i] : ends[i + 1]]
    return out


def _grouped(leaves: list[dict]) -> list[tuple[list[dict], dict[int, np.ndarray]]]:
    """Leaves that follow each other, which share most of their path, with the cuts of each feature that tell their conditions apart."""
    groups: list[tuple[list[dict], dict[int, set[float]]]] = []
    for leaf in leaves:
        own = {int(f): {b for b in (low, high) if np.isfinite(b)} for f, low, high in zip(leaf["features"], leaf["low"], leaf["high"])}
        if groups:
            known = groups[-1][1]
            merged = {f: known.get(f, set()) | own.get(f, set()) for f in {**known, **own}}
            if prod(len(c) + 1 for c in merged.values()) <= STATES:
                groups[-1] = ([*groups[-1][0], leaf], merged)
                continue
        groups.append(([leaf], own))
    return [(members, {f: np.array(sorted(c)) for f, c in cuts.items()}) for members, cuts in groups]


def _add_all(out: np.ndarray, columns: np.ndarray, groups: list[tuple[list[dict], dict[int, np.ndarray]]]) -> None:
    """Add what all leaves give the features of each row.

    Rows that lie between the same cuts of a group meet the same conditions of
    its leaves: one of them is explained for all.
    """
    known: dict[int, list[np.ndarray]] = {}
    for _, cuts in groups:
        for f, c in cuts.items():
            known.setdefault(f, []).append(c)
    edges = {f: np.unique(np.concatenate(c)) for f, c in known.items()}
    # of each row, the number of cuts below its value
    places = {f: np.searchsorted(e, columns[f]) for f, e in edges.items()}
    n = columns.shape[1]
    every, whole, real = np.arange(n), np.empty(n, np.intp), np.empty(n)
    for members, cuts in groups:
        state, states = np.zeros(n, np.intp), 1
        for f, c in cuts.items():
            below = np.searchsorted(np.searchsorted(edges[f], c), np.arange(len(edges[f]) + 1))
            state += (below * states).take(places[f], out=whole, mode="clip")
            states *= len(c) + 1
        if states > GROUPED:  # conditions of a single leaf
            for leaf in members:
                _add(out, columns, leaf)
            continue
        one = np.full(states, -1, np.intp)
        one[state] = every
        found = np.flatnonzero(one >= 0)
        if 2 * len(found) > n:
            for leaf in members:
                _add(out, columns, leaf)
            continue
        few = columns[:, one[found]]
        part = np.zeros_like(few)
        for leaf in members:
            _add(part, few, leaf)
        one[found] = np.arange(len(found))
        place = one.take(state, mode="clip")
        for f in cuts:
            out[f] += part[f].take(place, out=real, mode="clip")


def _adder(shared: Broadcast, width: int) -> Callable[..., Column]:
    def explained(held: list[tuple[np.ndarray, np.ndarray]], groups: list) -> Iterator[pd.Series]:
        columns, out = (np.ascontiguousarray(np.concatenate([pair[i] for pair in held]).T) for i in (0, 1))
        _add_all(out, columns, groups)
        rows = np.ascontiguousarray(out.T)
        for part in np.split(rows, np.cumsum([len(x) for x, _ in held])[:-1]):
            yield pd.Series(list(part))

    @F.pandas_udf("array<double>")
    def add(batches: Iterator[Tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        groups = _grouped(_unpacked(shared.value))
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for pair in batches:
            held.append(tuple(np.array(x.tolist(), dtype=float).reshape(len(x), width) for x in pair))
            if sum(len(x) for x, _ in held) >= ROWS:
                yield from explained(held, groups)
                held = []
        if held:
            yield from explained(held, groups)

    # else a filter on the factors is moved below the shuffle of the rows, and all of it is computed twice
    return add.asNondeterministic()


def tree_contributions(df: DataFrame, leaves: DataFrame, width: int) -> DataFrame:
    """Add ``contributions``, one per feature, to rows with a ``features`` vector.

    Leaves of up to LEAF_BYTES are sent to every task and all rows are explained
    in one pass without a shuffle. A larger model is dealt over several passes;
    each adds to the written rows of the one before, with its own part of the
    leaves, which is released after it.
    """
    passes = _passes(leaves)
    context = df.sparkSession.sparkContext
    part = F.pmod(F.xxhash64("tree", "features", "low"), F.lit(passes))
    found = df.withColumn("contributions", F.array_repeat(F.lit(0.0), width))
    for i in range(passes):
        shared = context.broadcast(_packed(leaves.where(part == i).drop("tree").toArrow()))
        add = _adder(shared, width)
        found = found.withColumn("contributions", add(vector_to_array("features"), "contributions"))
        if passes > 1:
            found = written(found, "contributions")
            shared.destroy()
    return found
