"""Canonical transaction and client views over the star-schema test tables.

Every column is one SQL expression valid in Spark and in the checking database, so both
sides read the same input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def _recipient(p2p: str) -> str:
    return f"case when {p2p} then concat('client_', (o_custkey * 13 + 7) % (select count(*) from {{customer}})) end"


VIEWS = {
    "tx_orders": (
        {
            "transaction_id": "concat('t', o_orderkey)",
            "client_id": "concat('client_', o_custkey)",
            "datetime": "cast(o_orderdate as timestamp)",
            "amount": "o_totalprice",
            "currency": "case substr(o_orderpriority, 1, 1) when '1' then 'USD' when '2' then 'EUR' "
                        "when '3' then 'GBP' else 'RUB' end",
            "merchant": "case o_orderkey % 7 when 0 then 'Amazon' when 1 then 'Ozon' when 2 then 'Uber' "
                        "when 3 then null else concat('m', o_orderkey % 400) end",
            "transaction_type": "case o_orderstatus when 'F' then 'deposit' when 'P' then 'withdrawal' "
                                "when 'O' then 'p2p' end",
            "ip_address": "case when o_orderkey % 31 = 0 then null when o_orderkey % 37 = 0 then '999.1.1.1' "
                          "else concat('10.', (o_custkey * 7) % 40, '.', o_orderkey % 50, '.', o_orderkey % 250) end",
            "region": "r_name",
            "device_type": "case o_orderkey % 4 when 0 then 'ios' when 1 then 'android' when 2 then 'web' end",
            "session_id": "case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then 's_big' "
                          "else concat('s', o_orderkey % 600) end",
            "recipient_id": _recipient("o_orderstatus = 'O'"),
        },
        "{orders} left join {customer} on o_custkey = c_custkey left join {nation} on c_nationkey = n_nationkey "
        "left join {region} on n_regionkey = r_regionkey",
    ),
    "tx_events": (
        {
            "transaction_id": "concat('e', event_id)",
            "client_id": "concat('client_', user_id)",
            "datetime": "cast(ts as timestamp)",
            "amount": "value",
            "currency": "case user_id % 4 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP' else 'RUB' end",
            "transaction_type": "case event_type when 'view' then 'deposit' when 'click' then 'withdrawal' "
                                "when 'purchase' then 'p2p' else event_type end",
            "session_id": "regexp_extract(props, '([0-9]+)', 1)",
            "region": "concat('R', user_id % 5)",
        },
        "{events}",
    ),
    "tx_baskets": (
        {
            "transaction_id": "concat('b', l_orderkey, '_', l_linenumber)",
            "client_id": "concat('client_', o_custkey)",
            "datetime": "cast(l_shipdate as timestamp)",
            "amount": "l_extendedprice",
            "currency": "'RUB'",
            "merchant": "concat('part_', l_partkey)",
            "transaction_type": "case l_returnflag when 'A' then 'deposit' when 'N' then 'withdrawal' else 'p2p' end",
            "ip_address": "concat(case when l_orderkey % 23 = 0 then '10.0.0' else concat(11 + cast(floor(l_orderkey / 32768) "
                          "as bigint) % 200, '.', cast(floor(l_orderkey / 128) as bigint) % 256, '.', l_orderkey % 16) "
                          "end, '.', l_linenumber)",
            "session_id": "concat('o', l_orderkey)",
            "recipient_id": _recipient("l_returnflag = 'R'"),
        },
        "{lineitem} join {orders} on l_orderkey = o_orderkey",
    ),
    "clients": (
        {
            "client_id": "concat('client_', c_custkey)",
            "first_name": "c_name",
            "last_name": "c_mktsegment",
            "email": "concat(c_name, '@example.com')",
            "passport_id": "concat('P', c_custkey)",
            "registration_date": "make_date(2023, 1, cast(1 + c_custkey % 28 as int))",
            "status": "case when c_acctbal < 0 then 'blocked' else 'active' end",
        },
        "{customer}",
    ),
}

TABLES = ["orders", "customer", "nation", "region", "events", "lineitem"]


def view_template(name: str) -> str:
    columns, source = VIEWS[name]
    return "select " + ", ".join(f"{sql} as {col}" for col, sql in columns.items()) + f" from {source}"


def select_sql(name: str) -> str:
    return view_template(name).format(**{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One canonical view over the tables of a folder."""
    template = view_template(name)
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in template}
    return spark.sql(template, **used)
