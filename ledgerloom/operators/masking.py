"""Masking of personal data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ip_network, sha256_hex


def mask_clients(clients: DataFrame) -> DataFrame:
    return clients.withColumns(
        {"email_hash": sha256_hex(F.col("email")), "passport_hash": sha256_hex(F.col("passport_id"))}
    ).drop("email", "passport_id")


def mask_transactions(tx: DataFrame) -> DataFrame:
    """Network instead of address and, where present, the hash instead of the recipient."""
    out = tx.withColumn("ip_network", ip_network(F.col("ip_address")))
    if "recipient_id" in tx.columns:
        out = out.withColumn("recipient_id_hash", sha256_hex(F.col("recipient_id")))
    return out.drop("ip_address", "recipient_id")
