"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.common import staged


def _least_neighbour(links: DataFrame) -> DataFrame:
    """Per node the least of itself and its neighbours; counted down before the shuffle."""
    return links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the least node it sees."""
    links = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = links.join(_least_neighbour(links), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the least of them."""
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(links)
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it reaches, for every node of an edge ``(u, v)``.

    Edges with a null end and loops are left out, repeated edges count once. Each round is a
    written table; hubs are joined, never gathered, so the adaptive skew join can split them.
    """
    links = edges.select("u", "v").where("u is not null and v is not null and u <> v")
    current = staged(_small_star(_large_star(links)), "stars")
    while True:
        # Done when every larger end names one least node that is no larger end itself.
        parents = current.select(F.col("v").alias("u")).distinct()
        deeper = current.join(parents, "u", "left_semi")
        twice = current.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        if deeper.select("u").union(twice).isEmpty():
            break
        current = staged(_small_star(_large_star(current)), "stars")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
