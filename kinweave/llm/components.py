"""Connected components of an edge table by contraction; no vertex gathers its neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.llm.tables import cut

#: Edges up to this number, which is counted, are joined up in one task (about 60 MB); more are contracted first.
LOCAL_EDGES = 200_000


class Forest:
    """Union-find over integers; the smallest member is the root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, v: int) -> int:
        up, path = self.up, []
        while (w := up.setdefault(v, v)) != v:
            path.append(v)
            v = w
        for p in path:
            up[p] = v
        return v

    def link(self, v: int, w: int) -> None:
        v, w = self.root(v), self.root(w)
        if v != w:
            self.up[max(v, w)] = min(v, w)

    def edges(self) -> list[tuple[int, int]]:
        return [(v, r) for v in list(self.up) if (r := self.root(v)) != v]


def _local(edges: DataFrame) -> DataFrame:
    """(v, root) from few edges (a, b)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.link(a, b)
        v = np.fromiter(forest.up, np.int64, len(forest.up))
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(np.array([forest.root(x) for x in v.tolist()], np.int64))], ["v", "root"])

    return edges.select("a", "b").coalesce(1).mapInArrow(work, "v long, root long")


def components(edges: DataFrame, local: int = LOCAL_EDGES, most: int | None = None) -> DataFrame:
    """(v, root) for every vertex of the edges (a, b), both long; root is the same for all vertices of a component.

    Each round sends every vertex to the least of itself and its neighbours, then
    sends the edges along and drops those that became loops, until at most
    ``local`` edges are left; one task joins these up. The least neighbour
    is an aggregate (combined map-side, so a vertex with very many edges costs one
    row per task); the joins read two plain tables, which Spark can split where a
    key is hot. Vertices should be spread like hashes: then a constant share
    disappears in each round. Every round is cut into the checkpoint folder. most:
    an upper bound of the edges, for the number of files, where the edges come from
    rows of about their size; else they are written by as many tasks as make them.
    """
    left = cut(edges.where("a != b").select("a", "b"), most)
    found, vertices = None, 2 * left.count()
    while (n := left.count()) > local:
        both = left.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(left.select(F.col("b").alias("v"), F.col("a").alias("w")))
        step = cut(both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("to")), 2 * n)
        if found is None:
            found = step.select("v", F.col("to").alias("root"))
        else:
            moved = found.join(step.withColumnsRenamed({"v": "root", "to": "on"}), "root", "left")
            found = cut(moved.select("v", F.coalesce("on", "root").alias("root")), vertices)
        sent = left.join(step.withColumnsRenamed({"v": "a", "to": "x"}), "a").join(step.withColumnsRenamed({"v": "b", "to": "y"}), "b")
        left = cut(sent.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), n)
    last = cut(_local(left), 2 * local)
    if found is None:
        return last
    moved = found.join(last.select(F.col("v").alias("root"), F.col("root").alias("on")), "root", "left")
    return cut(moved.select("v", F.coalesce("on", "root").alias("root")), vertices)
