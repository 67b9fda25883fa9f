"""Connected components over an edge table, by forests of each task and contraction to least neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenpath.operators.skew import hot_keys, lookup
from lumenpath.session import checkpoint, ship

#: Up to so many different edges (a few MB) are joined by union-find in one task; the result is the same.
FINISH_EDGES = 100_000
#: Edges of which a task makes a forest at once (some tens of MB), and doublings a round.
CHUNK, JUMPS = 500_000, 3


def joined(edges: DataFrame) -> DataFrame:
    """``node, component`` of a bounded table ``edges(a, b)``, by union-find; the least node of a component names it."""
    kind = dict(edges.dtypes)["a"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(frames)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        at, names = pd.factorize(pd.concat([rows["a"], rows["b"]]), sort=True)
        up = list(range(len(names)))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for x, y in zip(at[: len(rows)].tolist(), at[len(rows) :].tolist()):
            x, y = root(x), root(y)
            up[max(x, y)] = min(x, y)
        yield pd.DataFrame({"node": names, "component": names[[root(x) for x in range(len(up))]]})

    return edges.repartition(1).mapInPandas(run, f"node {kind}, component {kind}")


def stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of nodes 0 to n - 1 and edges (a, b)."""
    up = np.arange(n)
    while len(a):
        np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
        while len(np.flatnonzero(up[up] != up)):
            up = up[up]
        a, b = up[a], up[b]
        a, b = a[a != b], b[a != b]
    return up


def thinned(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` that connect what ``edges(a, b)`` connects: a task replaces each CHUNK of its edges by a forest, which it keeps for the next chunk while it is small."""
    ship(edges.sparkSession)
    kind = dict(edges.dtypes)["a"]

    def forest(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts, ignore_index=True)
        at, names = pd.factorize(pd.concat([rows["a"], rows["b"]]))
        up = stars(at[: len(rows)], at[len(rows) :], len(names))
        own = np.flatnonzero(up != np.arange(len(up)))
        return pd.DataFrame({"a": names[up[own]], "b": names[own]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            held.append(frame)
            size += len(frame)
            if size >= CHUNK:
                held = [forest(held)]
                size = len(held[0])
                if size > CHUNK // 2:
                    yield held[0]
                    held, size = [], 0
        if held:
            yield forest(held)

    return edges.mapInPandas(run, f"a {kind}, b {kind}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Return ``(node, component)`` for every node that some edge touches.

    ``component`` is the smallest node reachable. Edges are undirected; self loops,
    repeated edges and edges with a null end are ignored, and an empty edge table gives
    an empty result. Every task first replaces its edges by a forest of them (``thinned``).
    Up to FINISH_EDGES different edges are joined at once. Of more, each round draws every
    node to its least neighbour and on to where that one is drawn, and keeps the edges
    between different nodes that are left, so the table shrinks from round to round; nodes of
    earlier rounds take the component of what they were drawn to. Every round is
    checkpointed; one number and a bounded list of hot keys per round reach the driver. A
    node with very many edges is dealt into parts, so that it does not land in one task.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null and a <> b")
    drawn = []
    while True:
        once = checkpoint(thinned(pairs).distinct())
        if once.count() <= FINISH_EDGES:
            parts = checkpoint(joined(once))
            break
        both = once.unionAll(once.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
        # Each jump doubles how far a node is drawn along a chain.
        for _ in range(JUMPS):
            least = checkpoint(least)
            least = lookup(least, least.select(F.col("node").alias("label"), F.col("label").alias("top")), "label").select("node", F.col("top").alias("label"))
        least = checkpoint(least)
        drawn.append(least)
        side = lambda name, to: least.select(F.col("node").alias(name), F.col("label").alias(to))
        pairs = lookup(lookup(once, side("a", "x"), "a"), side("b", "y"), "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    for least in reversed(drawn):
        found = lookup(least, parts.withColumnRenamed("node", "label"), "label", "left")
        parts = checkpoint(found.select("node", F.coalesce("component", "label").alias("component")))
    return parts
