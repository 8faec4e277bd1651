"""Connected components by contraction: every round maps a node to the first of itself and its neighbours in a new random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, by_shuffle


def components(edges: DataFrame, scratch: Scratch, tag: str = "cc", rounds: list[int] | None = None) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component: the smallest node reachable. Edges with a null end count for nothing.

    Edges are renamed to the nodes their ends map to and those within one node go, so each round works on
    fewer; the rounds' maps are then composed from the last to the first. The order is a hash of node and
    round, not the nodes' own: whatever they are called and however they are linked, a constant share of them is
    expected to go each round, so a chain of n takes a logarithm of n rounds. No row count of a component meets in
    one task: minima combine before the exchange, and a common end is the large side of a skewed join. No map is broadcast. ``rounds``
    gets the number of rounds.
    """
    maps: list[DataFrame] = []
    edges = scratch.keep(edges.select("a", "b").where("a <> b").distinct(), f"{tag}-edges0")
    while not edges.isEmpty():
        n = len(maps)
        place = lambda node, n=n: F.xxhash64(node, F.lit(n))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        best = both.groupBy("node").agg(F.min_by("other", place(F.col("other"))).alias("other"))
        first = best.select("node", F.when(_before("other", "node", place), F.col("other")).otherwise(F.col("node")).alias("to"))
        first = scratch.keep(first, f"{tag}-map{n}")
        maps.append(first)
        by_a = first.select(F.col("node").alias("a"), F.col("to").alias("x"))
        by_b = first.select(F.col("node").alias("b"), F.col("to").alias("y"))
        renamed = edges.join(by_shuffle(by_a), "a").join(by_shuffle(by_b), "b").where("x <> y")
        edges = scratch.keep(renamed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{tag}-edges{n + 1}")
        scratch.drop(f"{tag}-edges{n}")
    if rounds is not None:
        rounds.append(len(maps))
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = maps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(maps[:-1]):
        later = out.select(F.col("node").alias("to"), "root")
        out = step.join(by_shuffle(later), "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    out = scratch.keep(out, f"{tag}-roots")
    names = out.groupBy("root").agg(F.min("node").alias("component"))
    return out.join(by_shuffle(names), "root").select("node", "component")


def _before(a: str, b: str, place) -> Column:
    """Whether ``a`` stands before ``b`` in the round's order; nodes of one hash in their own."""
    x, y = place(F.col(a)), place(F.col(b))
    return (x < y) | ((x == y) & (F.col(a) < F.col(b)))
