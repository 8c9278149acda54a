"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from verbaloom.sources.tables import drop_path, new_path

MAX_ROUNDS = 60
# Edges that a task reduces to a forest at once.
HELD = 1 << 20
EDGE = "u bigint, v bigint"


def forest_labels(n: int, a, b):
    """The least of the n nodes that each is linked with, over links a, b or many."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            break
        label = new
    return label


def _stars(u, v):
    """Edges from each node to the least one it is linked with by the edges u, v."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    label = forest_labels(len(nodes), place[: len(u)], place[len(u) :])
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[linked], nodes[label[linked]]


def _local_forests(batches):
    """The edges of a partition as stars: fewer edges than nodes, which connect the same."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size > HELD:
            held = [_stars(*(np.concatenate(x) for x in zip(*held)))]
            size = len(held[0][0])
            if size > HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["u", "v"])
                held, size = [], 0
    if held:
        found = _stars(*(np.concatenate(x) for x in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["u", "v"])


def _written(edges: DataFrame, name: str) -> tuple:
    """The edges as a table, their number and its path, in one job."""
    spark, seen = edges.sparkSession, Observation()
    path = new_path(spark, name)
    edges.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(EDGE).parquet(path), seen.get["n"], path


def _settled(stars: DataFrame) -> bool:
    """Whether each edge goes from a node of one edge to a node that no edge goes from."""
    ends = stars.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("root"))
    roots = stars.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("root"))
    used = ends.unionByName(roots).groupBy("node").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return used.where("out > 1 OR (out = 1 AND root = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node of each node's component, from edges u, v (bigint).

    Each partition first reduces its edges to stars. Then large-star and small-star steps
    (Kiveris et al., SoCC 2014) follow until every edge is that of a node and its root. Both
    steps are joins with each node's least neighbour, which is aggregated before it is
    shuffled; a node with very many edges is split by adaptive execution. Each step is
    written to the shared folder, so that a lost executor repeats one step only. Null
    ends, loops and repeated edges do not count; nodes without an edge are not returned.
    """
    spark = edges.sparkSession
    ends = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars, n, path = _written(ends.mapInArrow(_local_forests, EDGE).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if not n or _settled(stars):
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, _, passed = _written(large.where("u <> v"), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        stars, n, after = _written(small, "stars")
        drop_path(spark, passed)
        drop_path(spark, path)
        path = after
    else:
        raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
