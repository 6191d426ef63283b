"""Spending category of a transaction."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Merchants per category.
RETAIL = ["Amazon", "Ozon"]
TRAVEL = ["Uber"]


def category_of(transaction_type: Column, merchant: Column) -> Column:
    return (
        F.when(transaction_type == "p2p", "p2p")
        .when(merchant.isin(RETAIL), "retail")
        .when(merchant.isin(TRAVEL), "travel")
        .otherwise("other")
    )


def fill_categories(tx: DataFrame) -> DataFrame:
    """Fill missing categories only; the column is added when absent."""
    if "category" not in tx.columns:
        tx = tx.withColumn("category", F.lit(None).cast("string"))
    return tx.withColumn(
        "category", F.coalesce(F.col("category"), category_of(F.col("transaction_type"), F.col("merchant")))
    )
