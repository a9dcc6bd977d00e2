"""Connected components of a distributed edge list, by alternating stars.

Each round first replaces the edges of every block by stars that connect the
same nodes, then hangs every node on the smallest neighbour it can see. Blocks
hold at most ``BLOCK_EDGES`` edges whatever the input, so they only shorten the
chains; what runs across blocks is left to the rounds. Rounds are written to
the shared scratch folder, so lineage stays short and a lost executor costs one
round at most. Nothing is collected but a count and one flag a round.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged

#: Edges that are contracted in memory at once.
BLOCK_EDGES = 1 << 18


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Edges (node, smallest node reachable by the given edges)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    hang = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.record_batch({"u": nodes[hang], "v": nodes[root[hang]]})


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        if sum(len(u) for u, _ in held) >= BLOCK_EDGES:
            yield _stars(*map(np.concatenate, zip(*held, strict=True)))
            held = []
    if held:
        yield _stars(*map(np.concatenate, zip(*held, strict=True)))


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges block by block; files of few edges share a block."""
    return edges.coalesce(1 + edges.count() // BLOCK_EDGES).mapInArrow(_contract, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _done(edges: DataFrame) -> bool:
    """Whether the edges (greater, smaller) are stars: every node hangs on one
    other at most, and nothing hangs on a node that hangs itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    bad = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below + above > 1 and below > 0")
    return bad.isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges ``(u, v)`` of longs; the root
    is the smallest node reachable. Loops and repeated edges are harmless."""
    edges = staged(edges.where("u <> v").select("u", "v"), name)
    edges = staged(_contracted(edges), name)
    while not _done(edges):
        edges = staged(_small_star(_large_star(edges)), name)
        edges = staged(_contracted(edges), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
