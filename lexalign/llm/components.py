"""Connected components of an edge table, by contraction: hook every node to its smallest neighbour, follow the hooks,
replace edges by edges between the roots, and repeat until none is left.  Nodes should be hashes (random order keeps
the chains of hooks short); every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Scratch, salted_join


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, comp`` for every node of the undirected ``edges`` (``a``, ``b``); equal ``comp`` means connected."""
    e = scratch.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .where("a <> b").distinct(), f"{name}_e0")
    labels, k = None, 0
    while e.limit(1).count():
        k += 1
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        root = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("root"))
        root = scratch.save(root, f"{name}_r{k}_0")
        jump = 0
        while True:  # chains of hooks halve with every jump
            up = root.select(F.col("node").alias("root"), F.col("root").alias("up"))
            nxt = salted_join(root, up, ["root"], "node").select("node", F.coalesce("up", "root").alias("new"), "root")
            jump += 1
            nxt = scratch.save(nxt, f"{name}_r{k}_{jump}")
            moved = nxt.where("new <> root").limit(1).count()
            root = nxt.select("node", F.col("new").alias("root"))
            if not moved:
                break
        to_a = root.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        to_b = root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        if labels is None:
            labels = root.select("node", F.col("root").alias("comp"))
        else:
            up = root.select(F.col("node").alias("comp"), F.col("root").alias("up"))
            labels = scratch.save(salted_join(labels, up, ["comp"], "node").select(
                "node", F.coalesce("up", "comp").alias("comp")), f"{name}_l{k}")
        nxt = salted_join(salted_join(e, to_a, ["a"], "b"), to_b, ["b"], "a")
        e = scratch.save(nxt.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                         .where("a <> b").distinct(), f"{name}_e{k}")
    return labels if labels is not None else e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
