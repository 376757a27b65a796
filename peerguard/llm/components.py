"""Connected components of an edge table by alternating large-star and
small-star steps (distributed union-find). Each step is two joins with
partially aggregated minima; a table written in the shared folder ends each
round, and only a count and a checksum reach the driver."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_read
from .common import store


def _forest(batches):
    """Contract the edges of one partition to stars (its own union-find, no
    larger than the partition)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.get(top, top) != top:
            top = root[top]
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for pdf in batches:
        for a, b in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = [x for x in root if find(x) != x]
    if nodes:
        yield pd.DataFrame({"u": np.array(nodes, "int64"), "v": np.array([find(x) for x in nodes], "int64")})


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: two long columns. Returns (node, component) for each node that
    has an edge to another node; component is the smallest node reachable.
    Loops, repeated and reversed edges and null ends change nothing; no edge
    gives no row. Raises if ``max_rounds`` rounds don't settle it (needs more
    than 2**max_rounds nodes)."""
    a, b = (F.col(c) for c in edges.columns[:2])
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u <> v"))
    e = store(e.mapInPandas(_forest, "u long, v long").distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct())
        before, e = e, store(small, "cc")
        remove_read(before)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
    raise RuntimeError("components did not settle")


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``components`` after further links between them (pairs of
    component names; a node without a link is its own): only the links' graph is
    solved, which is small where few components meet."""
    links = store(links, "cc-links")
    if links.isEmpty():
        remove_read(links)
        return comp
    top = components(links)
    new = comp.join(top.select(F.col("node").alias("component"), F.col("component").alias("_top")), "component", "left")
    out = store(new.select("node", F.coalesce("_top", "component").alias("component")).unionByName(top), "cc")
    remove_read(links)
    remove_read(top)
    return out
