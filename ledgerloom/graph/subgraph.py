"""Community tables and induced subgraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.edges import induced


def community_sizes(membership: DataFrame) -> DataFrame:
    return membership.groupBy("community_id").agg(F.count("*").alias("community_size"))


def top_communities(membership: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` largest communities; equal sizes by id."""
    return community_sizes(membership).orderBy(F.desc("community_size"), "community_id").limit(n)


def members_of_top_communities(table: DataFrame, n: int = 100) -> DataFrame:
    """Rows of ``table`` (with community_id) that belong to the ``n`` largest communities."""
    return table.join(top_communities(table, n).select("community_id"), "community_id", "left_semi")


def top_nodes(table: DataFrame, n: int, by: str = "influence_score", key: str = "id") -> DataFrame:
    """The ``n`` rows with the largest ``by``; a bounded sort, no full ordering."""
    return table.orderBy(F.desc(by), key).limit(n)


def random_neighbourhood(edges: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """(id): ``k`` nodes drawn by seeded hash, with their neighbours."""
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    drawn = nodes.orderBy(F.sha2(F.concat("id", F.lit(f":{seed}")), 256), "id").limit(k)
    out = edges.select(F.col("src").alias("id"), F.col("dst").alias("other"))
    back = edges.select(F.col("dst").alias("id"), F.col("src").alias("other"))
    near = out.unionByName(back).join(drawn, "id", "left_semi").select(F.col("other").alias("id"))
    return drawn.unionByName(near).distinct()


def sampled_subgraph(edges: DataFrame, k: int = 700, seed: int = 42) -> DataFrame:
    return induced(edges, random_neighbourhood(edges, k, seed))
