"""Connected components of an edge table.

Edges are first contracted where they lie: each task joins the ends of its own edges and passes
on one edge per node. What is left is counted as it is written. Up to ``ONE_TASK`` edges are
contracted once more, by a single task whose memory that count bounds. More edges go through
alternating star operations: each round links every node's neighbours to the smallest one, first
for the larger, then for the smaller neighbours, until the edges form stars around each
component's smallest node. A node's smallest neighbour is a map-side combined minimum, so a hub
is no single task's group. Every round is written to the shared folder. Both ways give the same
stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from touchline.llm.common import staged, unstaged

ONE_TASK = 500_000
HELD = 500_000  # nodes a task holds before it passes on what it has


def _contracted(held: int):
    """(u, v) -> (u, v): each node of some edges and the smallest node they connect it with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                up = parent[x]
                if up in parent:
                    parent[x] = up = parent[up]
                x = up
            return x

        def stars() -> pa.RecordBatch:
            nodes = list(parent)
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([root(x) for x in nodes])], ["u", "v"])

        for batch in batches:
            for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist()):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) >= held:
                yield stars()
                parent.clear()
        if parent:
            yield stars()

    return run


def _with_least(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").select("u", "v", F.least("least", "u").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down)
    moved = starred.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(starred.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
    linked = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u")
    return twice.unionByName(linked).isEmpty()


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """Edges (u, v) -> (node, root) for every node that is not its component's root."""
    counted = Observation()
    contracted = edges.select("u", "v").mapInArrow(_contracted(HELD), "u long, v long")
    state = staged(contracted.observe(counted, F.count(F.lit(1)).alias("n")))
    if counted.get["n"] <= one_task:
        state = staged(state.coalesce(1).mapInArrow(_contracted(2 * one_task + 1), "u long, v long"))
    else:
        while not _are_stars(state):
            before, state = state, staged(_small_star(_large_star(state)).filter(F.col("u") != F.col("v")).distinct())
            unstaged(before)
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
