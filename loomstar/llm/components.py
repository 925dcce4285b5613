"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstar.llm.common import if_small, store

#: A vertex and its least neighbour, 16 bytes, travel by broadcast up to this many.
BROADCAST_ROWS = 100_000


#: Edges that a task contracts at a time, 16 bytes each and as much again for labels.
HELD = 1 << 20


def _contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars that connect what the edges connect: each vertex but the least of its component, and that one."""
    vertex, end = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = end[: len(a)], end[len(a) :]
    label = np.arange(len(vertex))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for side in (a, b):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    hangs = np.flatnonzero(label != np.arange(len(vertex)))
    return vertex[hangs], vertex[label[hangs]]


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's own edges as stars, without a shuffle; copies of an edge in one task become one."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a, b = np.append(a, batch["a"].to_numpy(np.int64)), np.append(b, batch["b"].to_numpy(np.int64))
        if len(a) >= HELD:
            a, b = _contracted(a, b)
            if 2 * len(a) >= HELD:
                yield pd.DataFrame({"a": a, "b": b})
                a = b = np.zeros(0, np.int64)
    if len(a):
        a, b = _contracted(a, b)
        yield pd.DataFrame({"a": a, "b": b})


def _stars(edges: DataFrame, name: str) -> DataFrame:
    return store(edges.select("a", "b").mapInPandas(_contract, "a long, b long"), name)


def _least(edges: DataFrame) -> DataFrame:
    """(a, m, most): the least and greatest of each vertex's neighbours, by map-side combine however many it has."""
    return store(edges.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("most")), "least")


def components(links: DataFrame) -> DataFrame:
    """(unit, component): each end of a link (a, b) and the least unit it is connected with.

    Tasks contract the links they have.  Then each step joins every vertex to the least of
    its neighbours, so a star of any size settles in two steps and a chain in a number of
    steps that grows as its logarithm.  Edges stay in Spark; each step ends in a stored
    table.  Self links and repeated links are harmless; no links give no rows.
    """
    edges = _stars(links.where("a <> b"), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both)
        # A vertex that has a lower neighbour and any other one does not hang on a star yet.
        if least.where("m < a and most <> m").isEmpty():
            return least.select(F.col("a").alias("unit"), F.least("a", "m").alias("component"))
        near = if_small(least.select("a", "m"), BROADCAST_ROWS)
        large = both.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        large = _stars(large, "large-star")
        joined = large.join(if_small(_least(large).select("a", "m"), BROADCAST_ROWS), "a")
        small = joined.select("a", F.col("m").alias("b")).unionByName(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = _stars(small, "edges")


def more_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """`found`, the components of some links, after more links (a, b) were added.

    Only links between different components are followed, by their components.
    """
    found = if_small(found, BROADCAST_ROWS)
    of = lambda end: found.select(F.col("unit").alias(end), F.col("component").alias(f"of_{end}"))
    placed = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = [F.coalesce(f"of_{end}", end).alias(end) for end in ("a", "b")]
    moved = components(placed.select(*ends))
    moved = if_small(store(moved.select(F.col("unit").alias("old"), F.col("component").alias("new")), "moved"), BROADCAST_ROWS)
    kept = found.join(moved, F.col("component") == F.col("old"), "left")
    kept = kept.select("unit", F.coalesce("new", "component").alias("component"))
    alone = moved.join(found, F.col("old") == F.col("unit"), "left_anti")  # units that no earlier link had
    return kept.unionByName(alone.select(F.col("old").alias("unit"), F.col("new").alias("component")))
