"""Connected components of an edge table: least label of the neighbours, then pointer jumping, until nothing changes.

Up to ``FEW`` edges are settled in one task, as a forest of pointers; a step of
the distributed loop costs more than that.  Both ways give the least node.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import Scratch

FEW = 200_000


def _forest(edges: pd.DataFrame) -> pd.DataFrame:
    """(node, comp) of the nodes of some edges; the smaller root becomes the parent."""
    parent: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x
    for a, b in zip(edges["a"].map(bytes), edges["b"].map(bytes)):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return pd.DataFrame({"node": list(parent), "comp": [root(x) for x in list(parent)]})


def components(nodes: DataFrame, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp) for every row of ``nodes`` (binary node); ``edges`` has columns a and b.  comp is the least node reached."""
    edges = scratch.keep(edges.select("a", "b"), f"{name}/pairs")
    if edges.limit(FEW + 1).count() <= FEW:
        found = edges.groupBy(F.lit(0).alias("all")).applyInPandas(_forest, "node binary, comp binary")
        return scratch.keep(nodes.join(found, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), f"{name}/forest")
    both = scratch.keep(edges.select(F.col("a").alias("node"), F.col("b").alias("to"))
                        .union(edges.select("b", "a")).distinct(), f"{name}/edges")
    labels = nodes.select("node", F.col("node").alias("comp"))
    step = 0
    while True:
        least = (both.join(labels.select(F.col("node").alias("to"), F.col("comp").alias("near")), "to")
                 .groupBy("node").agg(F.min("near").alias("near")))
        hooked = scratch.keep(labels.join(least, "node", "left").select(
            "node", F.col("comp").alias("was"), F.least("comp", F.coalesce("near", "comp")).alias("comp")), f"{name}/hook{step}")
        jump = hooked.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        jumped = scratch.keep(hooked.join(jump, "comp").select("node", "was", F.col("root").alias("comp")), f"{name}/jump{step}")
        labels = jumped.select("node", "comp")
        if jumped.where(F.col("was") != F.col("comp")).isEmpty():
            return labels
        step += 1


def merged(comps: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp) after more links (a, b) between nodes: components of the few classes that they join."""
    a = comps.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    b = comps.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    joins = scratch.keep(links.join(a, "a").join(b, "b").where("ca != cb").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
                         .distinct(), f"{name}/joins")
    if joins.isEmpty():
        return comps
    old = joins.select(F.col("a").alias("node")).union(joins.select("b")).distinct()
    new = components(old, joins, scratch, name).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return scratch.keep(comps.join(new, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), f"{name}/merged")
