"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search (operator 12).

The tree is fitted on a bounded sample and every vector goes down it to a leaf.
A query opens nodes through a priority queue, the one first whose vectors can
be expected to reach the largest inner product, and so has an order of leaves.
How many leaves are visited is calibrated: for some of the queries the true
neighbours are found among all vectors, and visits are widened until these
queries have the recall that is asked for. Leaves then meet the queries that
visit them in groups of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blobs
from .components import written

EVERY, FIRST = 20, 20
#: Recall that calibration widens visits to; what is measured on other queries lies about it.
RECALL = 0.95
#: Vectors (at most, and in bytes) that the tree is fitted on; children of a node; its levels; fewest sampled vectors that a node is split at.
SAMPLE, SAMPLE_BYTES, BRANCHES, LEVELS, SPLIT, ROUNDS = 16384, 64 << 20, 16, 2, 64, 10
#: Queries whose neighbours are found among all vectors for calibration.
CALIBRATED = 256
#: Vectors and queries of one group; queries whose findings are merged at once; products held at once.
LEAF_ROWS, LEAF_QUERIES, MERGED, PRODUCTS = 1 << 16, 1 << 14, 1024, 1 << 22
NO_KEY = np.iinfo(np.int64).max  # stands for null, last of all ids
FOUND = {"query": np.int64, "score": np.float64, "key": np.int64}


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def _closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def _k_means(x: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    centres = x[draw.choice(len(x), BRANCHES, replace=False)]
    for _ in range(ROUNDS):
        own = _closest(x, centres)
        held = np.unique(own)
        centres = np.stack([x[own == i].mean(axis=0) for i in held])
    return centres


class Tree:
    """Centres of all nodes, their children, the leaf number of each node (-1 if it has children) and its reach."""

    def __init__(self, sample: np.ndarray):
        self.centres, self.children, self.leaf, self.reach = [], [], [], []
        self.leaves = 0
        self._add(sample, sample.mean(axis=0), 0, np.random.default_rng(1))
        self.centres, self.reach = np.stack(self.centres), np.array(self.reach)

    def _add(self, x: np.ndarray, centre: np.ndarray, level: int, draw: np.random.Generator) -> int:
        node = len(self.centres)
        # the largest of n products spread normally about the centre's, per unit of the query's length
        spread = math.sqrt(((x - centre) ** 2).sum() / max(x.size, 1))
        self.centres.append(centre)
        self.reach.append(spread * math.sqrt(2 * math.log(len(x) + 1)))
        self.children.append([])
        self.leaf.append(-1)
        if level < LEVELS and len(x) >= SPLIT:
            centres = _k_means(x, draw)
            own = _closest(x, centres)
            for i, c in enumerate(centres):
                if (own == i).any():
                    self.children[node].append(self._add(x[own == i], c, level + 1, draw))
        if not self.children[node]:
            self.leaf[node] = self.leaves
            self.leaves += 1
        return node

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf each vector goes down to, by the closest child at each node."""
        out = np.zeros(len(x), np.int32)
        open_nodes = [(0, np.arange(len(x)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            own = _closest(x[rows], self.centres[self.children[node]])
            open_nodes += [(child, rows[own == i]) for i, child in enumerate(self.children[node]) if (own == i).any()]
        return out

    def visits(self, queries: np.ndarray, n: int) -> np.ndarray:
        """The first `n` leaves of each query, best bins first."""
        hopes = queries @ self.centres.T + np.linalg.norm(queries, axis=1)[:, None] * self.reach
        out = np.zeros((len(queries), n), np.int32)
        for row, hope in enumerate((-hopes).tolist()):
            queue, found = [(hope[0], 0)], 0
            while found < n:
                _, node = heapq.heappop(queue)
                if self.leaf[node] >= 0:
                    out[row, found] = self.leaf[node]
                    found += 1
                for child in self.children[node]:
                    heapq.heappush(queue, (hope[child], child))
        return out


def _some(rows: DataFrame, n: int, width: int) -> pa.Table:
    """`n` rows in the order of a hash, or as many as SAMPLE_BYTES hold; others are left out before any are brought together."""
    n = max(1, min(n, SAMPLE_BYTES // (8 * width)))
    thin = max(1, rows.count() // (2 * n))
    place = F.xxhash64("two", "one")
    return rows.where(F.pmod(place, F.lit(thin)) == 0).orderBy(place).limit(n).select("one", "two", "vector").toArrow()


def _tree(vectors: DataFrame, width: int) -> Tree:
    return Tree(_matrix(_some(vectors, SAMPLE, width)["vector"], width))


def _visits_needed(leaved: DataFrame, queries: DataFrame, tree: Tree, width: int, first: int, recall: float) -> int:
    """Leaves to visit so that the calibration queries find `recall` of their true neighbours."""
    if recall >= 1 or tree.leaves == 1:
        return tree.leaves
    some = _some(queries, CALIBRATED, width)
    ones, twos, asked = some["one"].to_numpy(), some["two"].to_numpy(), _matrix(some["vector"], width)
    sent = leaved.sparkSession.sparkContext.broadcast((ones, twos, asked))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones, twos, asked = sent.value
        score = np.full((len(asked), first), -np.inf)
        leaf = np.full((len(asked), first), -1, np.int32)
        for batch in batches:
            for start in range(0, batch.num_rows, max(1, PRODUCTS // len(asked))):
                part = batch.slice(start, max(1, PRODUCTS // len(asked)))
                products = asked @ _matrix(part["vector"], width).T
                products[(ones[:, None] == part["one"].to_numpy()) & (twos[:, None] == part["two"].to_numpy())] = -np.inf
                score = np.concatenate([score, products], axis=1)
                leaf = np.concatenate([leaf, np.broadcast_to(part["leaf"].to_numpy(), products.shape)], axis=1)
                top = np.argpartition(-score, first - 1, axis=1)[:, :first]
                score, leaf = np.take_along_axis(score, top, axis=1), np.take_along_axis(leaf, top, axis=1)
        query, column = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score[query, column]), pa.array(leaf[query, column])], names=["query", "score", "leaf"])

    near = leaved.select("one", "two", "leaf", "vector").mapInArrow(best, "query long, score double, leaf int")
    ranking = Window.partitionBy("query").orderBy(F.desc("score"), "leaf")
    near = near.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= first).select("query", "leaf").toArrow()
    sent.destroy()
    if not near.num_rows:
        return tree.leaves
    order = tree.visits(asked, tree.leaves)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(tree.leaves, dtype=np.int32), order.shape), axis=1)
    needed = np.sort(place[near["query"].to_numpy(), near["leaf"].to_numpy()]) + 1
    return int(needed[math.ceil(recall * len(needed)) - 1])


def _first_of_each(query: np.ndarray, score: np.ndarray, key: np.ndarray, first: int) -> np.ndarray:
    """Rows of the `first` of each query, by query; larger scores first, then smaller keys."""
    order = np.lexsort([key, -score, query])
    query = query[order]
    new = np.ones(len(order), bool)
    new[1:] = query[1:] != query[:-1]
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[rank < first]


def _meeting(width: int, first: int, buckets: int):
    """What a group of vectors of a leaf gives the queries that visit it."""

    def meet(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return blobs.empty(FOUND)
        x, asked, names = _matrix(left["vector"], width), _matrix(right["vector"], width), right["query"].to_numpy()
        keys = left["keys"].combine_chunks()
        keys = pa.concat_arrays(keys.chunks) if isinstance(keys, pa.ChunkedArray) else keys
        ends, keys = keys.offsets.to_numpy() - keys.offsets[0].as_py(), keys.flatten().to_numpy()
        # products of blocks may differ in the last bits from sums of one row, by which scores are given
        slack = 4 * width * np.finfo(float).eps * np.linalg.norm(x, axis=1).max() * np.linalg.norm(asked, axis=1)
        out = {name: [] for name in FOUND}
        for start in range(0, len(asked), max(1, PRODUCTS // len(x))):
            own = slice(start, start + max(1, PRODUCTS // len(x)))
            products = asked[own] @ x.T
            if len(x) > first:
                last = np.partition(products, len(x) - first, axis=1)[:, len(x) - first]
                rows, columns = np.nonzero(products >= (last - slack[own])[:, None])
            else:
                rows, columns = (i.ravel() for i in np.indices(products.shape))
            score = np.empty(len(rows))
            for a in range(0, len(rows), max(1, PRODUCTS // width)):
                b = a + max(1, PRODUCTS // width)
                score[a:b] = (asked[own][rows[a:b]] * x[columns[a:b]]).sum(axis=1)
            counts = ends[columns + 1] - ends[columns]
            at = np.arange(counts.sum()) + np.repeat(ends[columns] - np.cumsum(counts) + counts, counts)
            query, score, key = np.repeat(names[own][rows], counts), np.repeat(score, counts), keys[at]
            kept = _first_of_each(query, score, key, first)
            for name, values in (("query", query), ("score", score), ("key", key)):
                out[name].append(values[kept])
        found = {name: np.concatenate(parts) for name, parts in out.items()}
        return blobs.pack(found["query"] % buckets, 0, found)

    return meet


def _spread(rows: DataFrame, own: str, own_parts: dict[int, int], other: str, other_parts: dict[int, int], name: str) -> DataFrame:
    """Rows in their part `own` of a leaf, once for each part `other`."""
    sizes = rows.sparkSession.createDataFrame([(leaf, n, other_parts.get(leaf, 1)) for leaf, n in own_parts.items()], f"leaf int, {own}_parts int, {other}_parts int")
    rows = rows.join(F.broadcast(sizes), "leaf")
    rows = rows.withColumn(own, F.pmod(F.xxhash64(name), F.col(f"{own}_parts")).cast("int"))
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1))).drop(f"{own}_parts", f"{other}_parts")


def _parts(leaves: DataFrame, most: int) -> dict[int, int]:
    """Parts of each leaf; there are BRANCHES ** LEVELS leaves at most."""
    return {r["leaf"]: -(-r["count"] // most) for r in leaves.groupBy("leaf").count().collect()}


def _search(vectors: DataFrame, queries: DataFrame, width: int, first: int, recall: float) -> DataFrame:
    """`query` and its `found` (key, score), nearest first."""
    tree = _tree(vectors, width)
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(tree)

    def leave(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("leaf", pa.array(sent.value.leaf_of(_matrix(batch["vector"], width))))

    leaved = written(vectors.select("one", "two", "keys", "vector").mapInArrow(leave, "one long, two long, keys array<long>, vector array<double>, leaf int"), "leaves")
    n_visits = _visits_needed(leaved, queries, tree, width, first, recall)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = sent.value.visits(_matrix(batch["vector"], width), n_visits)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(leaves) + 1, dtype=np.int32) * n_visits), pa.array(leaves.ravel()))
            yield pa.RecordBatch.from_arrays([batch["query"], batch["vector"], lists], names=["query", "vector", "leaves"])

    visits = written(queries.select("query", "vector").mapInArrow(visit, "query long, vector array<double>, leaves array<int>"), "visits")
    sent.destroy()
    visited = visits.select("query", "vector", F.explode("leaves").alias("leaf"))
    rows, askers = _parts(leaved, LEAF_ROWS), _parts(visited.select("leaf"), LEAF_QUERIES)
    left = _spread(leaved.select("leaf", "one", "keys", "vector"), "b", rows, "c", askers, "one").drop("one")
    right = _spread(visited, "c", askers, "b", rows, "query")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-queries.count() // MERGED))
    by = ["leaf", "b", "c"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_meeting(width, first, buckets), blobs.schema(FOUND))

    def merge(table: pa.Table) -> pa.Table:
        _, own = blobs.unpack(table, FOUND)
        kept = _first_of_each(own["query"], own["score"], own["key"], first)
        return pa.table({name: own[name][kept] for name in FOUND})

    merged = found.groupBy("bucket").applyInArrow(merge, "query long, score double, key long")
    # nearest first: by falling score, then rising key
    entry = F.struct((-F.col("score")).alias("below"), "key", "score")
    return written(merged.groupBy("query").agg(F.array_sort(F.collect_list(entry)).alias("found")), "neighbours")


def nearest(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, first: int = FIRST, recall: float = RECALL) -> DataFrame:
    """`query_id`, `rank`, `key` and `score` of the `first` nearest found of each row whose key is divisible by `every`.

    Nearest is the largest inner product of the vectors as they stand, in
    double precision; equal scores go to the smaller key, null last. Null,
    empty and zero vectors and those with null or non-finite components take no
    part; vectors of another length are no candidates, nor are rows with the
    query's own key. Rows that repeat key and vector count once. A recall of 1
    visits all leaves, which makes the result exact. Other columns are not
    read, whatever their names. No rows, or no queries, give no row.
    """
    rows = frame.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(_usable(F.col("vector")))
    # a negative zero is zero: equal vectors have equal keys
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = rows.select(F.coalesce("key", F.lit(int(NO_KEY))).alias("key"), "vector", F.xxhash64("vector").alias("one"), F.xxhash64(F.lit("second"), "vector").alias("two"))
    rows = written(rows.groupBy("one", "two", "key").agg(F.first("vector").alias("vector")), "vectors")
    # more copies of a vector than a result can hold have no part in it; the limit works before the shuffle
    smallest = Window.partitionBy("one", "two").orderBy("key")
    copies = rows.withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= first + 1)
    vectors = written(copies.groupBy("one", "two").agg(F.first("vector").alias("vector"), F.array_sort(F.collect_list("key")).alias("keys")), "distinct_vectors")
    asking = rows.where((F.col("key") % every == 0) & (F.col("key") != int(NO_KEY))).select("key", "one", "two")
    queries = vectors.join(asking.select("one", "two").distinct(), ["one", "two"], "left_semi")
    queries = written(queries.select("one", "two", "vector", F.monotonically_increasing_id().alias("query")), "queries")
    found = []
    for width in sorted(r[0] for r in queries.select(F.size("vector")).distinct().collect()):
        own = F.size("vector") == width
        found.append(_search(vectors.where(own), queries.where(own), width, first + 1, recall))
    if not found:
        return asking.select(F.col("key").alias("query_id"), F.lit(0).alias("rank"), F.col("key").alias(key), F.lit(0.0).alias("score")).where("false")
    results = queries.select("one", "two", "query").join(reduce(DataFrame.unionByName, found), "query").drop("query")
    answers = asking.join(results, ["one", "two"])
    others = F.slice(F.filter("found", lambda x: x["key"] != F.col("key")), 1, first)
    answers = answers.select(F.col("key").alias("query_id"), F.posexplode(others).alias("at", "near"))
    return answers.select("query_id", (F.col("at") + 1).alias("rank"), F.when(F.col("near.key") != int(NO_KEY), F.col("near.key")).alias(key), F.col("near.score").alias("score"))
