"""Degrees, density, graph summary and node typing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def degrees(edges: DataFrame) -> DataFrame:
    """(id, degree): in plus out, parallel edges counted, a self-loop counts twice."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))


def weighted_degrees(edges: DataFrame) -> DataFrame:
    """(id, w_degree): the weights of an edge summed at both ends."""
    return (
        edges.select(F.explode(F.array("src", "dst")).alias("id"), "weight")
        .groupBy("id")
        .agg(F.sum("weight").alias("w_degree"))
    )


def vertex_metrics(edges: DataFrame) -> DataFrame:
    """Both degrees in one pass."""
    return (
        edges.select(F.explode(F.array("src", "dst")).alias("id"), "weight")
        .groupBy("id")
        .agg(F.sum("weight").alias("w_degree"), F.count("*").alias("degree"))
    )


def density(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """One row: nodes, edges, density and average degree of an undirected graph."""
    nodes = nodes if nodes is not None else edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    n, m = F.col("nodes"), F.col("edges")
    return (
        nodes.agg(F.count("*").alias("nodes"))
        .withColumn("edges", edges.agg(F.count("*")).scalar())
        .select(
            "nodes",
            "edges",
            F.coalesce(F.try_divide(2 * m, n * (n - 1)), F.lit(0.0)).alias("density"),
            F.coalesce(F.try_divide(2 * m, n), F.lit(0.0)).alias("avg_degree"),
        )
    )
