"""PageRank: directed with a fixed number of rounds, and undirected by weight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Rounds, cut
from .adjacency import adjacency, send
from .ids import by_number


@by_number("id")
def pagerank(edges: DataFrame, rounds: int = 20, reset: float = 0.15, cut_every: int = 5) -> DataFrame:
    """(id, influence_score) of the directed graph; the scores sum to the number of vertices.

    Each round is ``reset + (1 - reset) * sum(rank / out-degree)``, started at 1. Vertices
    without incoming edges take part through a zero row, so a round is one join and one
    aggregation.
    """
    spark = edges.sparkSession
    adj = adjacency(edges, directed=True)
    # Receivers without links of their own come in with a NULL total.
    receivers = adj.links.select(F.col("dst").alias("id"), F.lit(None).cast("long").alias("out"))
    nodes = cut(
        adj.sources.select("id", F.col("n").alias("out")).unionByName(receivers).groupBy("id").agg(F.max("out").alias("out")),
        "nodes",
    )
    zero = nodes.select("id", F.lit(0.0).alias("m"), "out")
    written = Rounds(spark, "ranks")
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for i in range(1, rounds + 1):
        shares = ranks.filter("out is not null").select("id", (F.col("rank") / F.col("out")).alias("share"))
        messages = send(adj, shares).select(
            F.col("dst").alias("id"), (F.col("share") * F.col("n")).alias("m"), F.lit(None).cast("long").alias("out")
        )
        ranks = (
            messages.unionByName(zero)
            .groupBy("id")
            .agg((F.lit(reset) + F.lit(1 - reset) * F.sum("m")).alias("rank"), F.max("out").alias("out"))
        )
        if i % cut_every == 0 or i == rounds:
            ranks = written.cut(ranks)
    adj.release()
    scale = ranks.agg(F.count("*") / F.sum("rank")).scalar()
    return ranks.select("id", (F.col("rank") * scale).alias("influence_score"))


@by_number("id")
def pagerank_weighted(
    edges: DataFrame,
    alpha: float = 0.85,
    tol: float = 1e-6,
    max_rounds: int = 100,
    vertices: DataFrame | None = None,
    rounds: int | None = None,
) -> DataFrame:
    """(id, influence_score) of the undirected weighted graph; the scores sum to 1.

    Stops when the summed change falls below ``nodes * tol`` and raises if it doesn't within
    ``max_rounds``; ``rounds`` asks for so many rounds instead. Vertices without edges all hold
    the same score, which one number on the driver tracks; their mass is spread evenly.
    """
    spark = edges.sparkSession
    adj = adjacency(edges, loops_twice=False)
    out = adj.sources.select("id", F.col("weight").alias("out"))
    linked = out.count()
    lonely = vertices.join(out, "id", "left_anti").select("id") if vertices is not None else None
    n_lonely = lonely.count() if lonely is not None else 0
    n = linked + n_lonely
    written = Rounds(spark, "ranks")
    ranks = out.withColumn("rank", F.lit(1.0 / n))
    idle = 1.0 / n
    for _ in range(max_rounds if rounds is None else rounds):
        base = (alpha * n_lonely * idle + 1 - alpha) / n
        shares = ranks.select("id", (F.col("rank") / F.col("out")).alias("share"))
        messages = send(adj, shares).select(
            F.col("dst").alias("id"), (F.col("share") * F.col("weight")).alias("m"),
            F.lit(None).cast("double").alias("out"), F.lit(None).cast("double").alias("old"),
        )
        kept = ranks.select("id", F.lit(0.0).alias("m"), "out", F.col("rank").alias("old"))
        ranks = written.cut(
            messages.unionByName(kept)
            .groupBy("id")
            .agg((F.lit(base) + alpha * F.sum("m")).alias("rank"), F.max("out").alias("out"), F.max("old").alias("old"))
        )
        moved = ranks.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0] + n_lonely * abs(base - idle)
        idle = base
        if rounds is None and moved < n * tol:
            break
    else:
        if rounds is None:
            adj.release()
            raise RuntimeError(f"ranks did not settle in {max_rounds} rounds")
    adj.release()
    result = ranks.select("id", F.col("rank").alias("influence_score"))
    return result if lonely is None else result.unionByName(lonely.withColumn("influence_score", F.lit(idle)))
