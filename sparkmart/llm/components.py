"""Connected components of a distributed set of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.session import scratch_folder


def written(frame: DataFrame, name: str, *parts: str) -> DataFrame:
    """`frame` as a table in the shared folder, in a folder for each value of `parts`: later steps read it, whatever executor is lost."""
    folder = scratch_folder(frame.sparkSession, name)
    frame.write.partitionBy(*parts).parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """`node` and `label`, the smallest node that links lead to, for each node of `links` (a, b) that is not its own label.

    Large-star and small-star steps in turn: each points neighbours to the
    smallest one known. Minima are taken before the shuffle and joined back as
    skewed joins, so a star of any size is split.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node points to one smaller node at most and nothing points to a node that points on; each star is a component then."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("points")), F.struct(F.col("v").alias("node"), F.lit(0).alias("points")))).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.points").alias("out"), F.count("*").alias("n"))
    return not nodes.where("out > 1 OR (out = 1 AND n > 1)").head(1)


def local_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of 0..n-1 that each is connected with by the edges (a, b)."""
    out = np.arange(n)
    while True:
        low = np.minimum(out[a], out[b])
        new = out.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, out[a], low)
        np.minimum.at(new, out[b], low)
        new = new[new]
        if (new == out).all():
            return out
        out = new
