"""Session settings, the shared scratch folder, and lineage cuts for iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results (time zone) and the skew handling depend on.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when the split costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# About this many rows per partition of a cached adjacency or state table: a round of some million links has work for all cores.
ROWS_PER_PARTITION = 250_000
MAX_PARTITIONS = 50_000


def build_session(app: str = "ledgerloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, "spark.ui.enabled": "false", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the required runtime settings to a session built elsewhere."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/ledgerloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once all results have been written."""
    remove_path(spark, _own_folder(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete one of our own intermediate tables from the shared folder."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Unlike a checkpoint this computes the plan once, and the file sizes give the
    optimizer a checked size for choosing between broadcast and shuffle joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Written tables of an iterative job; drops those older than ``keep`` rounds."""

    def __init__(self, spark: SparkSession, name: str, keep: int = 2):
        self.spark, self.name, self.keep = spark, name, keep
        self.paths: list[str] = []

    def cut(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        self.paths.append(path)
        while len(self.paths) > self.keep:
            remove_path(self.spark, self.paths.pop(0))
        return self.spark.read.schema(df.schema).parquet(path)


def partitions_for(rows: int) -> int:
    """Partition count for a table of ``rows`` rows, independent of the session default."""
    return max(1, min(MAX_PARTITIONS, -(-rows // ROWS_PER_PARTITION)))
