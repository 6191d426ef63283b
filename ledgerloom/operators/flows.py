"""Daily flows and running balances."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_flows(tx: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Inflow, outflow, count and net flow per (day, client, currency).

    A side that did not occur that day is NULL and makes ``net_flow`` NULL;
    ``zero_fill`` treats it as 0 instead.
    """
    def side(kind):
        total = F.sum(F.when(F.col("transaction_type") == kind, F.col("amount")))
        return F.coalesce(total, F.lit(0.0)) if zero_fill else total

    return (
        tx.groupBy(F.to_date("datetime").alias("dt"), "client_id", "currency")
        .agg(side("deposit").alias("inflow"), side("withdrawal").alias("outflow"), F.count("*").alias("tx_cnt"))
        .withColumn("net_flow", F.col("inflow") - F.col("outflow"))
    )


def client_balance(daily: DataFrame) -> DataFrame:
    """Opening and closing balance per (client, currency) and day.

    The input holds one row per day, so a window partition never exceeds the number of
    calendar days, however many transactions a client has.
    """
    by_day = Window.partitionBy("client_id", "currency").orderBy("dt")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    return daily.select(
        F.col("dt").alias("date"),
        "client_id",
        "currency",
        F.sum("net_flow").over(before).alias("opening_balance"),
        F.sum("net_flow").over(by_day).alias("closing_balance"),
        "inflow",
        "outflow",
        F.col("tx_cnt").alias("transaction_count"),
    )
