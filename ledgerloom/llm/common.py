"""Helpers that several operators share: row selection, free names, words, the query registry."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows are texts of any length: batches for Python and row groups are bounded by bytes.
TEXT_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "parquet.block.size": str(16 << 20)}
# Workers are reused by many steps: large arrays go back to the system when they are freed.
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": "1000000", "MALLOC_TRIM_THRESHOLD_": "1000000", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}
WHITE = r"[\x20\x09-\x0D]+"  # separators of the white-space words


def ready(spark: SparkSession) -> SparkSession:
    """Required settings, and this package on the workers' path: Spark serves it from the driver."""
    sc = spark.sparkContext
    sc.environment.update(WORKER_ENV)
    if not getattr(sc, "_ledgerloom_shipped", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="ledgerloom-")) / "ledgerloom.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))
        sc._ledgerloom_shipped = True
    for key, value in TEXT_SETTINGS.items():
        spark.conf.set(key, value)
    return prepare(spark)


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under ``name``."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ready(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so that no other column can clash or be read."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def row_code(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits of a row's id and text: rows that agree in both are one case with one result."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def keep_rows(docs: DataFrame, verdicts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without those whose (id, row code) is listed in ``verdicts`` (doc_id, code).

    The list is matched null-safe on the id; all columns and repeated rows are kept as they are.
    """
    code, listed_id, listed_code = (free_name(docs, c) for c in ("_row_code", "_listed_id", "_listed_code"))
    listed = verdicts.select(F.col("doc_id").alias(listed_id), F.col("code").alias(listed_code))
    coded = docs.withColumn(code, row_code(id_col, text_col))
    same = (F.col(code) == F.col(listed_code)) & F.col(f"`{id_col}`").eqNullSafe(F.col(listed_id))
    return coded.join(listed, same, "left_anti").drop(code)


def folded(text: Column) -> Column:
    """``text`` with A-Z (and no other letter) in lower case."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str) -> Column:
    """The words between ``separators``; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators, -1), "")


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of steps that are over.

    It does so when the driver's JVM collects their plans, which may be long after the results
    have been written to the shared folder.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


HOT_SHARE = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], n: str, how: str = "inner") -> DataFrame:
    """``rows`` joined (inner or left) with their group, when a few groups may hold most of the rows.

    ``groups`` (written, one row per group) counts its rows in ``n``. At most ``HOT_SHARE`` groups
    have more than that part of all rows of groups; they are broadcast, the others shuffled.
    """
    total = groups.agg(F.sum(n)).first()[0] or 0
    hot = groups.filter(F.col(n) > total // HOT_SHARE)
    rest = groups.filter(F.col(n) <= total // HOT_SHARE)
    by_hot = rows.join(F.broadcast(hot), on)
    return by_hot.unionByName(rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(rest, on, how))


ROWS_PER_CHUNK = 200_000


def ranked(df: DataFrame, key: str, number: str, rows: int, order: list[str], rank: str) -> DataFrame:
    """Add ``rank``: 0, 1, ... within equal ``key``, without ever sorting a whole group in one task.

    ``number`` is a stored unique number of the row. It deals every group into salted chunks; a
    row's rank is its place in the chunk plus the sizes of the group's chunks before it.
    """
    chunks = max(1, -(-rows // ROWS_PER_CHUNK))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(number), F.lit(chunks)).cast("int"))
    before = Window.partitionBy(key).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        salted.groupBy(key, "_salt").agg(F.count("*").alias("_n"))
        .select(key, "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    place = F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order, number)) - 1
    return (
        salted.withColumn("_place", place).join(starts, [key, "_salt"])
        .withColumn(rank, (F.col("_start") + F.col("_place")).cast("long")).drop("_salt", "_place", "_start")
    )
