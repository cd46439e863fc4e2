"""Connected components by alternating large-star and small-star contraction; small graphs by one task.

Each round of contraction shuffles the edges some six times, whatever their
number. With many shuffle partitions nearly all of these tasks are empty, and
the driver keeps a record of each, so graphs of up to FEW edges are settled by
one task that holds all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rows import give_back
from .shared import discard, materialise

#: Edges that one task settles, at most: some 60 MB of numbers.
FEW = 1 << 19


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b")))


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges ``a`` to ``b`` in order, and of each the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while (apart := root[x] != root[y]).any():
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))
        while ((up := root[root]) != root).any():
            root = up
    return nodes, nodes[root]


def _settled(edges: DataFrame) -> DataFrame:
    """(node, root) of few edges between long numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        for batch in batches:
            for column, end in zip(batch.columns, ends, strict=True):
                end.append(column.to_numpy().copy())
        node, root = least_reachable(*map(np.concatenate, ends))
        for at in range(0, len(node), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[at : at + (1 << 16)]) for x in (node, root)], ["node", "root"])
        give_back()

    return edges.coalesce(1).mapInArrow(run, "node long, root long")


def connected_components(edges: DataFrame, max_rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the smallest node of its component. A written table.

    ``edges`` has two comparable columns ``a`` and ``b``; direction, loops and
    repeats don't matter, rows with a null end are ignored, no edges give no
    rows. Up to ``few`` edges between long numbers, repeats included, go to one
    task. Of others each round writes its contracted edge list to the shared
    folder, so lineage stays short and nothing is gathered on the driver but a
    checksum. Both give the same rows.
    """
    now = materialise(edges.select("a", "b").where("a <> b"), "edges")
    if all(f.dataType == T.LongType() for f in now.schema) and now.count() <= few:
        found = materialise(_settled(now), "roots")
        discard(now)
        return found
    given, now = now, materialise(now.distinct(), "edges")
    discard(given)

    def seen(t: DataFrame):
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    mark = seen(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        new = materialise(_small_star(_large_star(now).distinct()).where("a <> b").distinct(), "edges")
        old, now, was = now, new, mark
        mark = seen(now)
        discard(old)
        if mark == was:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    found = materialise(now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root"))), "roots")
    discard(now)
    return found
