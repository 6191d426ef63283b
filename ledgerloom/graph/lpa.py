"""Label propagation with simultaneous updates; ties go to the smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Rounds
from .adjacency import adjacency, send
from .ids import by_number


def _round(adj, labels: DataFrame, self_vote: bool, packed: int | None) -> DataFrame:
    votes = send(adj, labels.select("id", "label")).select(F.col("dst").alias("id"), "label", F.col("n").alias("votes"))
    if self_vote:
        votes = votes.unionByName(labels.select("id", "label", F.lit(1).cast("long").alias("votes")))
    # Two map-side combined aggregations: no task ever holds all votes of one vertex.
    counted = votes.groupBy("id", "label").agg(F.sum("votes").alias("votes"))
    if packed is None:
        return counted.groupBy("id").agg(F.min(F.struct(-F.col("votes"), "label")).alias("best")).select(
            "id", F.col("best.label").alias("label")
        )
    # Most votes first, then the smallest label, as one number that aggregates by hash.
    best = F.max(F.col("votes") * packed + (packed - 1 - F.col("label"))).alias("best")
    return counted.groupBy("id").agg(best).select("id", (packed - 1 - F.col("best") % packed).alias("label"))


@by_number("id", "community_id")
def label_propagation(
    edges: DataFrame,
    rounds: int = 10,
    until_stable: bool = False,
    self_vote: bool = False,
    cut_every: int = 5,
    vertices: DataFrame | None = None,
) -> DataFrame:
    """(id, community_id). Starts with every vertex as its own community.

    A fixed number of rounds by default. ``until_stable`` stops as soon as nothing changes and
    raises if something still does after ``rounds``: simultaneous updates can swing forever on
    bipartite parts, which ``self_vote`` mostly prevents. Vertices without edges keep their own label.
    """
    spark = edges.sparkSession
    adj = adjacency(edges)
    written = Rounds(spark, "labels", keep=2)
    labels = adj.sources.select("id", F.col("id").alias("label"))
    size = adj.sources.agg(F.max("id")).first()[0] + 1
    packed = size if (adj.largest_n + 2) * size < 2**63 else None
    for i in range(1, rounds + 1):
        new = _round(adj, labels, self_vote, packed)
        if until_stable:
            old = labels.withColumnRenamed("label", "old")
            checked = written.cut(new.join(old, "id").withColumn("changed", F.col("label") != F.col("old")))
            labels = checked.select("id", "label")
            if checked.filter("changed").isEmpty():
                break
        else:
            labels = written.cut(new) if i % cut_every == 0 or i == rounds else new
    else:
        if until_stable:
            adj.release()
            raise RuntimeError(f"labels did not settle in {rounds} rounds")
    adj.release()
    result = labels.select("id", F.col("label").alias("community_id"))
    if vertices is not None:
        result = vertices.select("id").join(result, "id", "left").withColumn("community_id", F.coalesce("community_id", "id"))
    return result
