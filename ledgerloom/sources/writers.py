"""Writers and table maintenance on plain Parquet.

A table is a catalog name whose location points at one finished folder. Replacing the
content writes a new folder first and then moves the location, so readers see the old or
the new content, and a job that dies before the move changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import node_type
from ..session import MAX_PARTITIONS, cut
from .readers import EDGE_KEYS, EDGE_TYPES, NODE_KEYS, NODE_TYPES


# --- catalog tables over versioned folders ------------------------------------------------


def _schema_of(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def publish(df: DataFrame, name: str, root: str) -> str:
    """Write ``df`` to a new folder under ``root`` and let the table ``name`` point at it.

    With the same columns the table's location moves in one step. With other columns the old
    table steps aside under another name until the new one stands; a publish or
    :func:`recover` after a crash between the two brings it back first.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    recover(spark, name)
    _point(spark, name, path, df)
    return path


def _aside(name: str) -> str:
    return f"{name}__before"


def recover(spark: SparkSession, name: str) -> None:
    """After a crash during a change of columns: the old table returns if there is no new one."""
    if spark.catalog.tableExists(_aside(name)):
        if spark.catalog.tableExists(name):
            spark.sql(f"DROP TABLE {_aside(name)}")
        else:
            spark.sql(f"ALTER TABLE {_aside(name)} RENAME TO {name}")


def _point(spark: SparkSession, name: str, path: str, df: DataFrame) -> None:
    if spark.catalog.tableExists(name):
        if _schema_of(spark.table(name)) == _schema_of(df):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"ALTER TABLE {name} RENAME TO {_aside(name)}")
    _create(spark, name, path, df)
    recover(spark, name)


def _create(spark: SparkSession, name: str, path: str, df: DataFrame) -> None:
    columns = ", ".join(f"`{c}` {t}" for c, t in _schema_of(df))
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def add_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> None:
    """Extend a table; old files read the new columns as NULL."""
    if columns:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in columns.items())})")


def append(df: DataFrame, name: str) -> None:
    """Append by column name; columns the frame lacks become NULL."""
    target = df.sparkSession.table(name)
    have = set(df.columns)
    df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    ).write.insertInto(name)


def truncate_and_load(df: DataFrame, name: str, root: str) -> str:
    """Replace all rows but keep the declared columns."""
    target = df.sparkSession.table(name)
    have = set(df.columns)
    return publish(
        df.select(
            *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
        ),
        name,
        root,
    )


ROWS_PER_FILE = 2_000_000


def replace_slice(
    df: DataFrame, path: str, column: str = "date", partition: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Replace the rows of every value of ``column`` that occurs in ``df``; others stay.

    Only the partitions that hold such rows are rewritten. ``partition`` names a coarser
    partition column (a month, say) when single slices are too small for folders of their own.
    A partition gets as many tasks as its measured rows need, and no file has more than ``rows_per_file``.
    """
    if partition is not None and _exists(df.sparkSession, path):
        old = df.sparkSession.read.schema(df.schema).parquet(path)
        touched = old.join(df.select(partition).distinct(), partition, "left_semi")
        kept = touched.join(df.select(column).distinct(), column, "left_anti")
        df = kept.select(*df.columns).unionByName(df)
    partition = partition or column
    # Written first: it is measured, and the partitions read above are the ones about to be overwritten.
    df = cut(df, "slice")
    sizes = cut(df.groupBy(F.col(partition).alias("_slice")).agg(F.count("*").alias("_rows")), "slice-sizes")
    tasks = F.ceil(F.col("_rows") / rows_per_file)
    total = sizes.agg(F.sum(tasks)).first()[0] or 1
    # Partitions of more than one file: at most one in ``rows_per_file`` rows.
    large = sizes.filter(F.col("_rows") > rows_per_file).select("_slice", tasks.cast("int").alias("_tasks"))
    dealt = df.join(F.broadcast(large), F.col(partition).eqNullSafe(F.col("_slice")), "left")
    # Dealt by a hash of the whole row, so that a slice with a third of all rows is spread.
    salt = F.pmod(F.xxhash64(*df.columns), F.coalesce("_tasks", F.lit(1)))
    dealt.repartition(min(total, MAX_PARTITIONS), partition, salt).select(*df.columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("maxRecordsPerFile", rows_per_file).partitionBy(partition).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


# --- keyed changes as frames ---------------------------------------------------------------


def key_replaced(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` without the keys of ``batch``, followed by ``batch``."""
    return target.join(batch.select(key).distinct(), key, "left_anti").select(*target.columns).unionByName(
        batch, allowMissingColumns=True
    )


def merged(
    target: DataFrame, source: DataFrame, key: str, update: list[str], set_on_match: dict[str, Column] | None = None
) -> DataFrame:
    """Insert new keys, and on known keys refresh only the ``update`` columns.

    ``set_on_match`` gives columns that matched rows receive, such as a load time.
    """
    set_on_match = set_on_match or {}
    joined = target.withColumn("_was", F.lit(True)).alias("t").join(
        source.withColumn("_in", F.lit(True)).alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full"
    )
    matched, new = F.col("_was") & F.col("_in"), F.col("_was").isNull()

    def column(c):
        old = F.col(f"t.{c}")
        fresh = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        out = F.when(new, set_on_match.get(c, fresh) if c not in source.columns else fresh)
        if c in set_on_match:
            out = out.when(matched, set_on_match[c])
        elif c in update:
            out = out.when(matched, fresh)
        return out.otherwise(old).alias(c)

    return joined.select(*[column(c) for c in target.columns])


# --- files ---------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite", truncate: bool = False) -> None:
    """``truncate`` keeps the declared table on overwrite instead of dropping it."""
    df.write.format("jdbc").mode(mode).options(**(properties or {})).options(
        url=url, dbtable=table, truncate=str(truncate).lower()
    ).save()


def _data(keys: dict[str, str], columns: list[str]) -> Column:
    entries = [
        F.when(F.col(name).isNotNull(), F.struct(F.lit(k).alias("_key"), F.col(name).cast("string").alias("_VALUE")))
        for k, name in keys.items()
        if name in columns
    ]
    return F.filter(F.array(*entries), lambda e: e.isNotNull()).alias("data")


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges with typed attributes as GraphML parts under ``path``.

    ``path/nodes`` and ``path/edges`` hold the records; ``path/keys`` declares the attribute
    types. Everything is written by the executors.
    """
    if "node_type" not in nodes.columns:
        nodes = nodes.withColumn("node_type", node_type(F.col("id")))
    nodes.select(F.col("id").alias("_id"), _data(NODE_KEYS, nodes.columns)).write.mode("overwrite").format("xml").options(
        rowTag="node", rootTag="graph edgedefault='undirected'"
    ).save(f"{path}/nodes")
    edges.select(
        F.col("src").alias("_source"), F.col("dst").alias("_target"), _data(EDGE_KEYS, edges.columns)
    ).write.mode("overwrite").format("xml").options(rowTag="edge", rootTag="graph edgedefault='undirected'").save(
        f"{path}/edges"
    )
    declared = [("node", k, n, NODE_TYPES[n]) for k, n in NODE_KEYS.items()] + [
        ("edge", k, n, EDGE_TYPES[n]) for k, n in EDGE_KEYS.items()
    ]
    nodes.sparkSession.createDataFrame(
        [(k, side, n, t) for side, k, n, t in declared], "_id string, _for string, `_attr.name` string, `_attr.type` string"
    ).coalesce(1).write.mode("overwrite").format("xml").options(rowTag="key", rootTag="graphml").save(f"{path}/keys")
