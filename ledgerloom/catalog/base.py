"""Registry of runnable queries, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _IPV4
from ..operators.masking import mask_transactions
from ..session import prepare
from ..sources import fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under ``name``."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        run.__name__ = fn.__name__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- inputs --------------------------------------------------------------------------------


def tx_orders(spark, sf):
    return fixtures.load(spark, sf, "tx_orders")


def tx_events(spark, sf):
    return fixtures.load(spark, sf, "tx_events")


def tx_baskets(spark, sf):
    return fixtures.load(spark, sf, "tx_baskets")


def clients(spark, sf):
    return fixtures.load(spark, sf, "clients")


def masked_orders(spark, sf):
    return mask_transactions(tx_orders(spark, sf))


def masked_baskets(spark, sf):
    return mask_transactions(tx_baskets(spark, sf))


# --- the same inputs for the checking SQL --------------------------------------------------

_NETWORK = (
    f"case when regexp_full_match(ip_address, '{_IPV4[2:-2]}') "
    r"then regexp_replace(ip_address, '\.[0-9]+$', '.0/24') end"
)


def _masked(source: str) -> str:
    return (
        f"select * exclude (ip_address, recipient_id), {_NETWORK} as ip_network, "
        f"sha256(recipient_id) as recipient_id_hash from {source}"
    )


VIEWS = {
    **{name: fixtures.select_sql(name) for name in ("tx_orders", "tx_events", "tx_baskets", "clients")},
    "masked": _masked("tx_orders"),
    "masked_baskets": _masked("tx_baskets"),
    "prepared": "select * replace (coalesce(merchant, 'no_merchant') as merchant, "
                "coalesce(device_type, 'unknown') as device_type) from masked",
}
NEEDS = {"masked": ["tx_orders"], "masked_baskets": ["tx_baskets"], "prepared": ["masked"]}


def views(*names: str) -> str:
    """``with`` clause that defines the named inputs (and what they need), materialised once."""
    order: list[str] = []

    def add(name):
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "with " + ", ".join(f"{n} as materialized ({VIEWS[n]})" for n in order)


# --- output helpers ------------------------------------------------------------------------


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def as_text(df: DataFrame, *cols: str) -> DataFrame:
    """Dates and timestamps as text, so that both engines compare the same characters."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def second_text(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def exact_mean(mean: Column, n: Column) -> Column:
    """A mean of two-decimal amounts rebuilt from its whole number of cents."""
    return F.round(mean * n * 100) / (n * 100.0)
