"""Balance mart, client communities and the graph-enriched transaction fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..graph import cliques
from ..graph.degrees import vertex_metrics
from ..graph.ids import number_vertices
from ..graph.lpa import label_propagation
from ..graph.pagerank import pagerank
from ..graph.subgraph import community_sizes
from ..operators.flows import client_balance, daily_flows
from ..schemas import GRAPH_FACT_COLUMNS, GRAPH_FEATURE_COLUMNS
from ..session import cut
from ..sources.writers import merged


def balance_mart(tx: DataFrame) -> DataFrame:
    return client_balance(daily_flows(tx))


def client_communities(edges: DataFrame | cliques.CliqueGraph, lpa_rounds: int = 10, pagerank_rounds: int = 20) -> DataFrame:
    """(client_id, community_id, influence_score, community_size, w_degree, degree) per vertex.

    The edges are written once with numbered vertices; names return in the last step.
    """
    if isinstance(edges, cliques.CliqueGraph):
        numbering, metrics = edges.names, cliques.metrics(edges)
        communities, ranks = cliques.labels(edges, lpa_rounds), cliques.pagerank(edges, pagerank_rounds)
    else:
        edges = cut(edges.select("src", "dst", "weight"), "edges")
        numbering = number_vertices(edges)
        edges = cut(numbering.number(edges, "src", "dst"), "numbered")
        metrics, communities, ranks = vertex_metrics(edges), label_propagation(edges, lpa_rounds), pagerank(edges, pagerank_rounds)
    table = (
        communities.join(ranks, "id")
        .join(metrics, "id")
        .join(community_sizes(communities), "community_id", "left")
    )
    return numbering.named(table, "id", "community_id").select(
        F.col("id").alias("client_id"), "community_id", "influence_score", "community_size", "w_degree", "degree"
    )


def enriched(tx: DataFrame, communities: DataFrame) -> DataFrame:
    """Transactions with the graph features of their client; unknown clients keep NULLs."""
    features = communities.select("client_id", *GRAPH_FEATURE_COLUMNS)
    return tx.select(*GRAPH_FACT_COLUMNS).join(features, "client_id", "left").select(
        *GRAPH_FACT_COLUMNS, *GRAPH_FEATURE_COLUMNS
    )


def graph_fact(
    existing: DataFrame | None, tx: DataFrame, communities: DataFrame, load_time: Column | None = None
) -> DataFrame:
    """First load, or a merge that refreshes only the graph features of known transactions.

    ``created_at`` is ``load_time`` (the present time if not given) for new rows and for refreshed ones.
    """
    load_time = F.current_timestamp() if load_time is None else load_time
    fresh = enriched(tx, communities).withColumn("created_at", load_time)
    if existing is None:
        return fresh
    return merged(existing, fresh, "transaction_id", [*GRAPH_FEATURE_COLUMNS, "created_at"])
