"""The neighbour table that iterative jobs join against, and one message-passing step.

Links are written once, then kept partitioned by their source, so a round moves only vertex
state and messages. A vertex with very many links is cut into slices by its neighbours; its
state is repeated once per slice. The number of such vertices is bounded by construction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, partitions_for

LINKS_PER_SLICE = 1_000_000
MAX_HOT_VERTICES = 100_000


@dataclass
class Adjacency:
    links: DataFrame  # src, slice, dst, weight, n
    sources: DataFrame  # id, n_links, n, weight: totals of the outgoing links
    hot: DataFrame | None  # id, slices: at most MAX_HOT_VERTICES rows
    largest_n: int  # most parallel-counted links of one vertex

    def release(self) -> None:
        self.links.unpersist()


def both_directions(edges: DataFrame, loops_twice: bool = True) -> DataFrame:
    """(src, dst, weight) in both directions; a self-loop once or twice."""
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    if not loops_twice:
        ends = F.when(F.col("src") == F.col("dst"), F.slice(ends, 1, 1)).otherwise(ends)
    return edges.select(F.explode(ends).alias("e"), "weight").select("e.src", "e.dst", "weight")


def adjacency(
    edges: DataFrame, directed: bool = False, loops_twice: bool = True, links_per_slice: int = LINKS_PER_SLICE
) -> Adjacency:
    """Neighbours of ``edges`` (src, dst, weight); parallel links are merged and counted in ``n``."""
    rows = edges.select("src", "dst", F.col("weight").cast("double").alias("weight"))
    rows = rows if directed else both_directions(rows, loops_twice)
    links = cut(
        rows.groupBy("src", "dst").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")), "links"
    )
    n_links = links.count()
    sources = cut(
        links.groupBy(F.col("src").alias("id")).agg(
            F.count("*").alias("n_links"), F.sum("n").alias("n"), F.sum("weight").alias("weight")
        ),
        "sources",
    )
    most, largest_n = sources.agg(F.max("n_links"), F.max("n")).first()
    limit = max(links_per_slice, n_links // MAX_HOT_VERTICES)
    hot, sliced = None, links.withColumn("slice", F.lit(0))
    if (most or 0) > limit:
        hot = cut(
            sources.filter(F.col("n_links") > limit).select("id", F.ceil(F.col("n_links") / limit).cast("int").alias("slices")),
            "hot",
        )
        sliced = (
            links.join(F.broadcast(hot.withColumnRenamed("id", "src")), "src", "left")
            .withColumn("slice", F.pmod(F.xxhash64("dst"), F.coalesce("slices", F.lit(1))).cast("int"))
            .drop("slices")
        )
    kept = sliced.select("src", "slice", "dst", "weight", "n").repartition(
        partitions_for(n_links), "src", "slice"
    ).persist(StorageLevel.MEMORY_AND_DISK)
    return Adjacency(kept, sources, hot, largest_n or 0)


def send(adj: Adjacency, state: DataFrame) -> DataFrame:
    """Each link with the state of its source: state columns, src, dst, weight, n.

    ``state`` has one or more rows per ``id``.
    """
    if adj.hot is None:
        spread = state.withColumn("slice", F.lit(0))
    else:
        spread = (
            state.join(F.broadcast(adj.hot), "id", "left")
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)))
            .drop("slices")
        )
    return adj.links.join(spread.withColumnRenamed("id", "src"), ["src", "slice"]).drop("slice")
