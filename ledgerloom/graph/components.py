"""Connected components by smallest label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Rounds
from .adjacency import adjacency, send
from .ids import by_number


@by_number("id", "component")
def connected_components(edges: DataFrame, max_rounds: int = 200, vertices: DataFrame | None = None) -> DataFrame:
    """(id, component): the smallest id of the component.

    A round takes the smallest label among neighbours, then replaces each label by the label
    of the vertex it names, which shortens long chains quickly. Runs until stable.
    """
    adj = adjacency(edges)
    written = Rounds(edges.sparkSession, "components")
    labels = written.cut(
        adj.links.groupBy(F.col("src").alias("id")).agg(F.least(F.min("src"), F.min("dst")).alias("label"))
    )
    for _ in range(max_rounds):
        heard = (
            send(adj, labels).select(F.col("dst").alias("id"), "label").unionByName(labels)
            .groupBy("id").agg(F.min("label").alias("label"))
        )
        # The jump is looked up once per distinct label, then handed to its members.
        named = heard.select("label").distinct().join(
            labels.select(F.col("id").alias("label"), F.col("label").alias("jump")), "label"
        )
        jumped = heard.join(named, "label").select("id", F.least("label", "jump").alias("label"))
        old = labels.select("id", F.col("label").alias("old"))
        checked = written.cut(jumped.join(old, "id").withColumn("changed", F.col("label") != F.col("old")))
        labels = checked.select("id", "label")
        if checked.filter("changed").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    adj.release()
    result = labels.select("id", F.col("label").alias("component"))
    if vertices is not None:
        result = vertices.select("id").join(result, "id", "left").withColumn("component", F.coalesce("component", "id"))
    return result


def largest_component(components: DataFrame) -> DataFrame:
    """(id) of the largest component; ties go to the smallest component id."""
    largest = (
        components.groupBy("component").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "component").limit(1).select("component")
    )
    return components.join(F.broadcast(largest), "component", "left_semi").select("id")
