"""Fraud rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import epoch_seconds

DAY = 86_400


def large_transactions(tx: DataFrame, threshold: float = 600_000, score: int = 70) -> DataFrame:
    return tx.filter(F.col("amount") > threshold).select(
        "*", F.lit("large_tx").alias("rule_triggered"), F.lit(score).alias("risk_score")
    )


def trailing_counts(tx: DataFrame, seconds: int = DAY) -> DataFrame:
    """(client_id, sec, cnt): transactions of the client in ``[sec - seconds, sec]``.

    Rows are first counted per client and second. Each such row goes to the slot of its own
    time and, as history, to the next slot, so a window partition holds at most
    ``2 * seconds`` rows even for a client with a third of all transactions.
    """
    per_second = tx.groupBy("client_id", epoch_seconds(F.col("datetime")).alias("sec")).agg(
        F.count("transaction_id").alias("n")
    )
    own = F.floor(F.col("sec") / seconds)
    slots = per_second.withColumn("own", own).withColumn(
        "slot", F.explode(F.array_distinct(F.array(F.col("own"), F.col("own") + 1)))
    )
    trailing = Window.partitionBy("client_id", "slot").orderBy("sec").rangeBetween(-seconds, 0)
    return (
        slots.withColumn("cnt", F.sum("n").over(trailing))
        .filter(F.col("slot").eqNullSafe(F.col("own")))
        .select("client_id", "sec", "cnt")
    )


def frequent_transactions(
    tx: DataFrame, threshold: int = 10, score: int = 50, seconds: int = DAY
) -> DataFrame:
    """Every transaction that is preceded by more than ``threshold`` within the window, itself included."""
    hits = trailing_counts(tx, seconds).filter(F.col("cnt") > threshold).select(
        F.col("client_id").alias("_client"), F.col("sec").alias("_sec")
    )
    on = F.col("client_id").eqNullSafe(F.col("_client")) & epoch_seconds(F.col("datetime")).eqNullSafe(F.col("_sec"))
    return tx.join(hits, on, "left_semi").select(
        "*", F.lit("freq_tx").alias("rule_triggered"), F.lit(score).alias("risk_score")
    )


def suspicious_transactions(
    tx: DataFrame, amount_threshold: float = 600_000, count_threshold: int = 10, stamp: bool = True
) -> DataFrame:
    """Hits of both rules; a transaction that fires both appears twice."""
    hits = large_transactions(tx, amount_threshold).unionByName(frequent_transactions(tx, count_threshold))
    return hits.withColumn("detection_time", F.current_timestamp()) if stamp else hits
