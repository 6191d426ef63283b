"""Staging views: the names under which the marts read their inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_staging(**frames: DataFrame) -> None:
    """``register_staging(stg_transactions=df, ...)`` makes each frame a view of that name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
