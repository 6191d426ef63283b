"""Graph statistics, community reports and input profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph import cliques
from ..graph.clustering import average_clustering
from ..graph.components import connected_components, largest_component
from ..graph.degrees import density
from ..graph.louvain import louvain
from ..graph.lpa import label_propagation
from ..graph.modularity import modularity
from ..graph.pagerank import pagerank_weighted
from ..graph.paths import diameter
from ..graph.subgraph import community_sizes, top_communities
from ..operators.aggregates import dominant, group_counts, shares, value_counts
from ..operators.edges import induced
from ..session import cut


def _edge_count(edges: DataFrame | cliques.CliqueGraph, nodes: DataFrame | None = None) -> DataFrame:
    if isinstance(edges, cliques.CliqueGraph):
        return cliques.edge_count(edges, nodes)
    return (edges if nodes is None else induced(edges, nodes)).agg(F.count("*"))


def graph_statistics(table: DataFrame, edges: DataFrame | cliques.CliqueGraph, top: int = 100) -> DataFrame:
    """One row of graph measures with the size of each exported community as a map.

    ``table`` has id, community_id, degree and w_degree. The map is bounded by ``top``.
    """
    sizes = community_sizes(table)
    largest = top_communities(table, top)
    chosen = table.join(F.broadcast(largest.select("community_id")), "community_id", "left_semi").select("id")
    exported = largest.agg(
        F.count("*").alias("exported_communities"),
        F.sum("community_size").alias("filtered_nodes"),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("community_id").cast("string"), "community_size")))
        ).alias("community_distribution"),
    )
    nodes = table.agg(
        F.count("*").alias("total_nodes"),
        F.avg("degree").alias("avg_degree"),
        F.max("degree").alias("max_degree"),
        F.avg("w_degree").alias("avg_weighted_degree"),
    )
    communities = sizes.agg(
        F.count("*").alias("communities"),
        F.max("community_size").alias("largest_community_size"),
        F.min("community_size").alias("smallest_community_size"),
        F.avg("community_size").alias("avg_community_size"),
    )
    # One-row results are attached as scalar subqueries.
    return (
        nodes.withColumns(
            {
                "c": communities.select(F.struct("*")).scalar(),
                "x": exported.select(F.struct("*")).scalar(),
                "total_edges": _edge_count(edges).scalar(),
                "filtered_edges": _edge_count(edges, chosen).scalar(),
            }
        ).select(*nodes.columns, "total_edges", "filtered_edges", "c.*", "x.*")
    )


def structure_report(edges: DataFrame) -> DataFrame:
    """One row that describes an undirected weighted graph (src, dst, weight).

    Size, density, mean degree and clustering, the diameter of the largest component, and
    the modularity of both community searches.
    """
    edges = cut(edges.select("src", "dst", "weight"), "graph")
    core = cut(largest_component(connected_components(edges)), "core")
    return density(edges).withColumns(
        {
            "avg_clustering": average_clustering(edges).scalar(),
            "diameter_lcc": diameter(induced(edges, core)).select("diameter").scalar(),
            "modularity_louvain": modularity(edges, louvain(edges)).scalar(),
            "modularity_lp": modularity(edges, label_propagation(edges, 100, until_stable=True, self_vote=True)).scalar(),
        }
    )


def completed_nodes(nodes: DataFrame, edges: DataFrame, **pagerank_options) -> DataFrame:
    """Nodes read from a graph file, with missing communities and scores computed.

    A stored value always wins. Either measure is only computed when some node lacks it.
    Community ids that are numbers written with a fraction become whole numbers.
    """
    edges = edges.select(F.col("source").alias("src"), F.col("target").alias("dst"), F.coalesce("weight", F.lit(1.0)).alias("weight"))
    whole = F.col("community_id").try_cast("double").cast("long").cast("string")
    nodes = nodes.withColumn("community_id", F.coalesce(whole, "community_id"))
    if not nodes.filter(F.col("community_id").isNull()).isEmpty():
        found = louvain(edges).withColumnRenamed("community_id", "_found")
        nodes = nodes.join(found, "id", "left").withColumn("community_id", F.coalesce("community_id", "_found", "id")).drop("_found")
    if not nodes.filter(F.col("influence_score").isNull()).isEmpty():
        scores = pagerank_weighted(edges, vertices=nodes.select("id"), **pagerank_options)
        scores = scores.withColumnRenamed("influence_score", "_found")
        nodes = nodes.join(scores, "id", "left").withColumn("influence_score", F.coalesce("influence_score", "_found")).drop("_found")
    return nodes


# Texts of the recommendation report.
SUMMARY = "Сообщество #%s: %s клиентов, средняя транзакция $%s, тип: %s\n"
P2P_TEXT = (
    "Рекомендация: Запустить социальные фичи для группы. Лидер: %s\n"
    "Предложить: групповые переводы, совместные цели накопления."
)
DEPOSIT_TEXT = (
    "Рекомендация: Предложить инвестиционные продукты. Лидер: %s\n"
    "Предложить: накопительные счета, инвестиции с защитой капитала."
)
WITHDRAWAL_TEXT = (
    "Рекомендация: Улучшить удержание средств. Лидер: %s\n"
    "Предложить: кэшбэк в популярных магазинах (%s), программы лояльности."
)
OTHER_TEXT = (
    "Рекомендация: Провести дополнительный анализ. Лидер: %s\n"
    "Предложить: базовые программы лояльности."
)


def recommendations(communities: DataFrame, tx: DataFrame) -> DataFrame:
    """Per community: size, dominant type, mean amount, leader, top merchant and the text.

    ``tx`` has client_id, amount, transaction_type and merchant. Leader and merchant ties go
    to the smaller name.
    """
    members = communities.select("client_id", "community_id")
    labelled = tx.join(members, "client_id")
    leader = communities.groupBy("community_id").agg(
        F.min(F.struct(-F.col("influence_score"), "client_id")).alias("l")
    ).select("community_id", F.col("l.client_id").alias("leader"))
    amounts = labelled.groupBy("community_id").agg(F.avg("amount").alias("avg_amount"))
    table = (
        communities.groupBy("community_id").agg(F.count("*").alias("size"))
        .join(dominant(labelled, "community_id", "transaction_type", "dominant_tx_type"), "community_id", "left")
        .join(amounts, "community_id", "left")
        .join(leader, "community_id", "left")
        .join(dominant(labelled, "community_id", "merchant", "top_merchant"), "community_id", "left")
    )
    kind = F.coalesce("dominant_tx_type", F.lit("unknown"))
    lead, shop = F.coalesce("leader", F.lit("N/A")), F.coalesce("top_merchant", F.lit("N/A"))
    # Half cents go up, whatever the last bits of a sum are.
    money = F.format_string("%.2f", F.round(F.coalesce("avg_amount", F.lit(0.0)), 6))
    advice = (
        F.when(kind == "p2p", F.format_string(P2P_TEXT, lead))
        .when(kind == "deposit", F.format_string(DEPOSIT_TEXT, lead))
        .when(kind == "withdrawal", F.format_string(WITHDRAWAL_TEXT, lead, shop))
        .otherwise(F.format_string(OTHER_TEXT, lead))
    )
    head = F.format_string(SUMMARY, F.col("community_id").cast("string"), F.col("size").cast("string"), money, kind)
    return table.withColumn("recommendation", F.concat(head, advice))


def rule_distribution(hits: DataFrame) -> DataFrame:
    return value_counts(hits, "rule_triggered")


def type_distribution(tx: DataFrame) -> DataFrame:
    return shares(group_counts(tx, "transaction_type"))


def hub_sharing(tx: DataFrame) -> DataFrame:
    """(measure, value): how strongly clients meet in sessions, transfers and withdrawals."""
    pairs = F.col("transaction_type")
    flat = tx.agg(
        F.count_if(pairs == "p2p").alias("p2p_transactions"),
        F.count_if(pairs == "withdrawal").alias("withdrawal_transactions"),
        F.count_distinct(F.when(pairs == "p2p", F.col("recipient_id"))).alias("p2p_recipients"),
        F.count_distinct(F.when(pairs == "withdrawal", F.col("client_id"))).alias("withdrawal_clients"),
        F.count_distinct("region").alias("regions"),
    )
    shared = (
        tx.filter(F.col("session_id").isNotNull()).select("session_id", "client_id").distinct()
        .groupBy("session_id").agg(F.count("*").alias("n")).filter("n > 1")
        .agg(F.count("*").alias("value")).select(F.lit("shared_sessions").alias("measure"), "value")
    )
    return flat.unpivot([], flat.columns, "measure", "value").unionByName(shared)
