"""Loads of transactions, clients and rates as frames; the caller publishes the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import evolve_to, missing_columns, require_unique, restrict_to
from ..schemas import EVOLVED_COLUMNS
from ..sources.writers import key_replaced

# Rates of a run date.
RATES = {"USD": 90.0, "EUR": 98.0, "GBP": 110.0, "RUB": 1.0}


def load_transactions(target: DataFrame, batch: DataFrame, check: bool = True) -> DataFrame:
    """Target extended by the batch's new columns, with the batch's keys replaced.

    ``check`` fails the load on duplicate keys before anything is combined.
    """
    batch = batch.drop("id")
    if check:
        require_unique(batch, "transaction_id")
    added = missing_columns(target.columns, batch.columns)
    target = evolve_to(target, {c: EVOLVED_COLUMNS.get(c.lower(), "string") for c in added})
    names = {c.lower(): c for c in target.columns}
    batch = batch.select(*[F.col(c).alias(names.get(c.lower(), c)) for c in batch.columns])
    return key_replaced(target, batch, "transaction_id")


def load_clients(target_columns: list[str], batch: DataFrame) -> DataFrame:
    """The batch restricted to known columns; it replaces the whole table."""
    return restrict_to(batch, target_columns)


def rates_for(spark: SparkSession, date: str, rates: dict[str, float] = RATES) -> DataFrame:
    rows = spark.createDataFrame(list(rates.items()), "currency string, rate double")
    return rows.select(F.lit(date).cast("date").alias("date"), "currency", "rate")


def rates_of_days(days: DataFrame, rates: dict[str, float] = RATES) -> DataFrame:
    """The rates of every distinct ``date`` of ``days``."""
    pair = F.explode(F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])).alias("currency", "rate")
    return days.select("date").distinct().select("date", pair)


def load_rates(target: DataFrame, date: str, rates: dict[str, float] = RATES) -> DataFrame:
    """``target`` with the rows of one date replaced."""
    return target.filter(F.col("date") != F.lit(date).cast("date")).unionByName(
        rates_for(target.sparkSession, date, rates)
    )
