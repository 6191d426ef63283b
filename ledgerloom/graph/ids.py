"""Dense vertex numbers in the order of the vertex names.

Iterative jobs move ids in every round. Numbers are an eighth of a hashed name, and numeric
minima and maxima aggregate by hash where text would need a sort. The numbers follow the
byte order of the names, so "smallest id" means the same vertex before and after.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ROWS_PER_PARTITION, cut, partitions_for


@dataclass
class Numbering:
    names: DataFrame  # id (number), name

    def number(self, df: DataFrame, *columns: str) -> DataFrame:
        return self._swap(df, columns, "name", "id")

    def named(self, df: DataFrame, *columns: str) -> DataFrame:
        return self._swap(df, columns, "id", "name")

    def _swap(self, df, columns, frm, to):
        order = df.columns
        for c in columns:
            table = self.names.select(F.col(frm).alias(c), F.col(to).alias("_other"))
            df = df.join(table, c).drop(c).withColumnRenamed("_other", c)
        return df.select(*order)


def number_vertices(edges: DataFrame, vertices: DataFrame | None = None) -> Numbering:
    """Numbers 0, 1, ... for all endpoints (and ``vertices``), by name.

    Names are range-partitioned once and written with their partition; a number is the rank
    inside the partition plus the sizes of the partitions before it.
    """
    ends = edges.select(F.explode(F.array("src", "dst")).alias("name"))
    if vertices is not None:
        ends = ends.unionByName(vertices.select(F.col("id").alias("name")))
    names = cut(ends.filter(F.col("name").isNotNull()).distinct(), "names")
    n = names.count()
    ranged = cut(
        names.repartitionByRange(partitions_for(n), "name").withColumn("part", F.spark_partition_id()), "ranged"
    )
    # One row per partition.
    sizes = ranged.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("name"))
    numbered = ranged.withColumn("rank", rank).join(F.broadcast(starts), "part")
    return Numbering(cut(numbered.select((F.col("start") + F.col("rank") - 1).alias("id"), "name"), "numbers"))


def is_numbered(edges: DataFrame) -> bool:
    return isinstance(edges.schema["src"].dataType, T.LongType)


def by_number(*id_columns: str):
    """Run a graph job on vertex numbers and return names in ``id_columns``.

    Edges whose ids are numbers already pass through. The frames ``vertices`` and ``sources``
    (id) are translated as well.
    """

    def wrap(fn):
        @wraps(fn)
        def run(edges, *args, vertices=None, **kwargs):
            extra = {} if vertices is None else {"vertices": vertices}
            if is_numbered(edges):
                return fn(edges, *args, **extra, **kwargs)
            # Written first: the edges are read twice, and may be expensive to build.
            edges = cut(edges.select("src", "dst", "weight"), "edges")
            numbering = number_vertices(edges, vertices)
            if vertices is not None:
                extra = {"vertices": numbering.number(vertices.select("id"), "id")}
            if kwargs.get("sources") is not None:
                kwargs["sources"] = numbering.number(kwargs["sources"].select("id"), "id")
            numbered = numbering.number(edges, "src", "dst")
            return numbering.named(fn(numbered, *args, **extra, **kwargs), *id_columns)

        return run

    return wrap
