"""Connected components of an edge table by alternating large-star and
small-star rounds (Kiveris et al., 2014): O(log n) rounds, each a few joins
and partial aggregates. Nothing is collected; a round's edges are a table in
the shared folder. A group's hub, whose edges may be a third of all, isn't
brought into one task: hubs are few by definition and sent to the edges."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickguard.llm.common import stored

#: Edges that one task contracts at a time before the rounds.
CONTRACT_ROWS = 500_000
#: A node with more than one in so many of the edges is a hub. An edge has two
#: ends, so there are at most 2 * HUB_SHARE hubs, whatever the input.
HUB_SHARE = 1000


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over edges a-b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _contract(frames):
    """A chunk of edges as stars: the same components, fewer hops."""
    kept, rows = [], 0

    def stars():
        e = pd.concat(kept)
        nodes, at = np.unique(e[["u", "v"]].to_numpy(np.int64), return_inverse=True)
        at = at.reshape(-1, 2)
        root = roots(at[:, 0], at[:, 1], len(nodes))
        out = root != np.arange(len(nodes))
        return pd.DataFrame({"u": nodes[out], "v": nodes[root[out]]})

    for f in frames:
        kept.append(f)
        rows += len(f)
        if rows >= CONTRACT_ROWS:
            yield stars()
            kept, rows = [], 0
    if kept:
        yield stars()


def _mark(e: DataFrame):
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _with_least(e: DataFrame, limit: int) -> DataFrame:
    """`e(u, v)` with m, the smallest v of each u. Rows of nodes with more than
    `limit` rows stay where they are and get m by broadcast."""
    ends = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    hubs = ends.where(F.col("n") > limit).select("u", F.col("m").alias("hub"))
    seen = e.join(F.broadcast(hubs), "u", "left")
    rest = seen.where("hub IS NULL").select("u", "v").join(ends.where(F.col("n") <= limit).select("u", "m"), "u")
    return seen.where("hub IS NOT NULL").select("u", "v", F.col("hub").alias("m")).unionByName(rest)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 200) -> DataFrame:
    """(node, component) for every node of the edge table `edges(a, b)` of
    bigint node ids; component is the smallest node reachable. Edges with a
    null end and self loops link nothing. Raises if `max_rounds` rounds don't
    converge (2^100 nodes would)."""
    e = (edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
         .where("u <> v").mapInPandas(_contract, "u long, v long"))
    e = stored(e, "components")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        limit = mark[0] // HUB_SHARE
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_with_least(both, limit).where("v > u")
                       .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "components")
        small = (_with_least(large, limit)
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                         .alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        e, last = stored(small, "components"), mark
        mark = _mark(e)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
