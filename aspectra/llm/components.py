"""Connected components of an edge table by alternating large-star and small-star steps.

Every round is a few equi-joins and aggregations on node ids; the edges of each round are
written to the shared scratch folder, which cuts the lineage and survives lost executors.
Before each round the edges inside a task are contracted to a spanning forest, so a dense
group costs a link per node, not a row per pair.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectra.plans.materialize import materialize


def local_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes that are not their own smallest."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(nodes))
    while True:
        ru, rv = root[u], root[v]
        open_ = ru != rv
        if not open_.any():
            break
        u, v, ru, rv = u[open_], v[open_], ru[open_], rv[open_]
        np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
        while True:  # pointer jumping
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            u, v = local_forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges run from the larger node u to v."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, label: str = "components", max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns); root: its component's smallest node.

    Self-loops, repeated and reversed edges and rows with a null end are allowed (a null end
    links nothing); an empty table gives an empty result. Nodes that occur only in self-loops
    are not returned. The loop ends when the edges are a star forest.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = materialize(e.mapInArrow(_contract, "u long, v long"), label)
    for _ in range(max_rounds):
        tops = e.select(F.col("v").alias("u")).distinct()
        n, nodes = e.agg(F.count(F.lit(1)), F.countDistinct("u")).first()
        if n == nodes and e.join(tops, "u", "left_semi").isEmpty():
            heads = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(heads)
        e = materialize(_round(e.mapInArrow(_contract, "u long, v long")), label)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
