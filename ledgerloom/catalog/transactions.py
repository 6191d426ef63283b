"""Flows, rules, masking, quality and profile queries."""

from pyspark.sql import functions as F

from ..functions.times import epoch_seconds, floor_to, minute_label, to_minute
from ..functions.text import hub_key, hub_key_keep_null, node_type
from ..operators import aggregates as agg
from ..operators import quality, rules
from ..operators.categories import fill_categories
from ..operators.edges import prepare_transactions
from ..operators.flows import client_balance, daily_flows
from ..operators.masking import mask_clients, mask_transactions
from ..plans import loads, reports
from ..plans.staging import register_staging
from ..session import cut
from .base import (
    as_text, clients, exact_mean, masked_orders, query, rounded, second_text, tx_baskets, tx_events, tx_orders, views,
)

# The checks start from one total per side and look each side up by day; balances add up earlier days through a join.
_DAILY = """moves as materialized (select datetime::date as dt, client_id, currency, transaction_type as side, amount from tx_events),
sides as materialized (select dt, client_id, currency, side, sum(amount) as total from moves where side in ('deposit', 'withdrawal') group by all),
days as (select dt, client_id, currency, count(*) as tx_cnt from moves group by all),
daily as materialized (select d.*, i.total as inflow, o.total as outflow from days d
  left join sides i on i.side = 'deposit' and (i.dt, i.client_id, i.currency) is not distinct from (d.dt, d.client_id, d.currency)
  left join sides o on o.side = 'withdrawal' and (o.dt, o.client_id, o.currency) is not distinct from (d.dt, d.client_id, d.currency))"""


@query("daily_flows", f"""{views('tx_events')}, {_DAILY}
select cast(dt as varchar) as dt, client_id, currency, round(inflow, 2) as inflow, round(outflow, 2) as outflow,
       tx_cnt, round(inflow - outflow, 2) as net_flow from daily""")
def q_daily_flows(spark, sf):
    return as_text(rounded(daily_flows(tx_events(spark, sf)), 2, "inflow", "outflow", "net_flow"), "dt")


@query("daily_flows_zero_fill", f"""{views('tx_events')}, {_DAILY}
select cast(dt as varchar) as dt, client_id, currency, round(coalesce(inflow, 0), 2) as inflow,
       round(coalesce(outflow, 0), 2) as outflow, tx_cnt,
       round(coalesce(inflow, 0) - coalesce(outflow, 0), 2) as net_flow from daily""")
def q_daily_flows_zero(spark, sf):
    return as_text(rounded(daily_flows(tx_events(spark, sf), zero_fill=True), 2, "inflow", "outflow", "net_flow"), "dt")


@query("client_balance", f"""{views('tx_events')}, {_DAILY},
earlier as (select d.dt, d.client_id, d.currency, sum(p.inflow - p.outflow) as opening from daily d
  join daily p on p.client_id = d.client_id and p.currency = d.currency and p.dt < d.dt group by all)
select cast(dt as varchar) as date, client_id, currency, round(opening, 2) as opening_balance,
       round(case when opening is null then inflow - outflow else opening + coalesce(inflow - outflow, 0) end, 2) as closing_balance,
       round(inflow, 2) as inflow, round(outflow, 2) as outflow, tx_cnt as transaction_count
from daily left join earlier using (dt, client_id, currency)""")
def q_client_balance(spark, sf):
    df = client_balance(daily_flows(tx_events(spark, sf)))
    return as_text(rounded(df, 2, "opening_balance", "closing_balance", "inflow", "outflow"), "date")


_HIT_COLUMNS = ["transaction_id", "client_id", "amount", "rule_triggered", "risk_score"]


@query("large_tx", f"""{views('masked')}
select transaction_id, client_id, amount, 'large_tx' as rule_triggered, 70 as risk_score
from masked where amount > 400000""")
def q_large(spark, sf):
    return rules.large_transactions(masked_orders(spark, sf), 400_000).select(*_HIT_COLUMNS)


_FREQ = """counted as (
  select *, count(transaction_id) over (partition by client_id order by epoch(date_trunc('second', datetime))
            range between 86400 preceding and current row) as cnt from tx_events)"""


@query("freq_tx", f"""{views('tx_events')}, {_FREQ}
select transaction_id, client_id, amount, 'freq_tx' as rule_triggered, 50 as risk_score from counted where cnt > 5""")
def q_freq(spark, sf):
    return rules.frequent_transactions(tx_events(spark, sf), 5).select(*_HIT_COLUMNS)


@query("trailing_counts", f"""{views('tx_events')}, {_FREQ}
select client_id, cast(epoch(date_trunc('second', datetime)) as bigint) as sec, max(cnt) as cnt from counted group by 1, 2""")
def q_trailing(spark, sf):
    return rules.trailing_counts(tx_events(spark, sf))


_SUSPICIOUS = f"""{_FREQ}, hits as (
select transaction_id, client_id, amount, 'large_tx' as rule_triggered, 70 as risk_score from tx_events where amount > 50
union all
select transaction_id, client_id, amount, 'freq_tx', 50 from counted where cnt > 5)"""


def _hits(spark, sf):
    return rules.suspicious_transactions(tx_events(spark, sf), 50, 5)


@query("suspicious", f"{views('tx_events')}, {_SUSPICIOUS} select * from hits")
def q_suspicious(spark, sf):
    return _hits(spark, sf).drop("detection_time").select(*_HIT_COLUMNS)


@query("rule_distribution", f"{views('tx_events')}, {_SUSPICIOUS} select rule_triggered, count(*) as n from hits group by 1")
def q_rules(spark, sf):
    return reports.rule_distribution(_hits(spark, sf))


@query("mask_clients", f"""{views('clients')}
select client_id, first_name, last_name, cast(registration_date as varchar) as registration_date, status,
       sha256(email) as email_hash, sha256(passport_id) as passport_hash from clients""")
def q_mask_clients(spark, sf):
    return as_text(mask_clients(clients(spark, sf)), "registration_date")


@query("mask_tx", f"""{views('masked')}
select transaction_id, client_id, amount, currency, merchant, transaction_type, region, device_type, session_id,
       ip_network, recipient_id_hash from masked""")
def q_mask_tx(spark, sf):
    return mask_transactions(tx_orders(spark, sf)).drop("datetime")


@query("staging_counts", f"""{views('masked', 'clients')}
select 'stg_transactions' as name, count(*) as n from masked
union all select 'stg_clients', count(*) from clients
union all select 'stg_rates', 4 * count(distinct datetime::date) from tx_orders""")
def q_staging(spark, sf):
    register_staging(
        stg_transactions=masked_orders(spark, sf), stg_clients=mask_clients(clients(spark, sf)),
        stg_rates=loads.rates_of_days(tx_orders(spark, sf).select(F.to_date("datetime").alias("date"))),
    )
    return spark.sql(
        "select 'stg_transactions' as name, count(*) as n from stg_transactions "
        "union all select 'stg_clients', count(*) from stg_clients "
        "union all select 'stg_rates', count(*) from stg_rates"
    )


@query("refuse_empty", f"""{views('tx_orders')}
select 'all' as rows, count(*) as n, '' as refused from tx_orders
union all select 'none', 0, 'later holds no rows'""")
def q_refuse_empty(spark, sf):
    """Inputs that must hold rows: one that does, and one whose filter leaves none."""
    tx = tx_orders(spark, sf)
    found = quality.require_rows(tx, "orders").agg(F.count("*").alias("n")).select(F.lit("all").alias("rows"), "n", F.lit("").alias("refused"))
    later = tx.filter("datetime > timestamp '2999-01-01'")
    try:
        quality.require_rows(later, "later")
        refused = ""
    except quality.EmptyInput as e:
        refused = str(e)
    return found.unionByName(later.agg(F.count("*").alias("n")).select(F.lit("none").alias("rows"), "n", F.lit(refused).alias("refused")))


_CATEGORY = """case when transaction_type = 'p2p' then 'p2p' when merchant in ('Amazon', 'Ozon') then 'retail'
when merchant = 'Uber' then 'travel' else 'other' end"""


@query("categories", f"{views('masked')} select transaction_id, {_CATEGORY} as category from masked")
def q_categories(spark, sf):
    return fill_categories(masked_orders(spark, sf)).select("transaction_id", "category")


@query("category_backfill", f"""{views('masked')}
select coalesce(case when region = 'ASIA' then 'set' end, {_CATEGORY}) as category, count(*) as n from masked group by 1""")
def q_backfill(spark, sf):
    tx = masked_orders(spark, sf).withColumn("category", F.when(F.col("region") == "ASIA", "set"))
    return agg.group_counts(fill_categories(tx), "category")


# --- quality -------------------------------------------------------------------------------

_COPIES = "copies as (select transaction_id, count(*) as copies from tx_baskets group by 1 having count(*) > 1)"


@query("dup_rows", f"""{views('tx_baskets')}, {_COPIES}
select transaction_id, client_id, amount, copies from tx_baskets join copies using (transaction_id)""")
def q_dup_rows(spark, sf):
    return quality.duplicate_rows(tx_baskets(spark, sf), "transaction_id").select(
        "transaction_id", "client_id", "amount", "copies"
    )


@query("dup_report", f"""{views('tx_baskets')}, {_COPIES}
select cast(sum(copies) as bigint) as duplicate_rows, count(*) as duplicate_keys from copies""")
def q_dup_report(spark, sf):
    return quality.duplicate_summary(tx_baskets(spark, sf), "transaction_id")


@query("null_keys", f"{views('tx_orders')} select count(*) filter (where merchant is null) as null_keys from tx_orders")
def q_null_keys(spark, sf):
    return quality.null_key_count(tx_orders(spark, sf), "merchant")


@query("drop_null_keys", f"""{views('tx_orders')}
select merchant, count(*) as n from tx_orders where merchant is not null group by 1""")
def q_drop_null_keys(spark, sf):
    return agg.group_counts(quality.drop_null_keys(tx_orders(spark, sf), "merchant"), "merchant")


@query("hashed_ids", f"""{views('tx_orders')}
select sha256(concat_ws('|', client_id, transaction_id)) as transaction_id, amount from tx_orders""")
def q_hashed_ids(spark, sf):
    return quality.hashed_ids(tx_orders(spark, sf), "transaction_id", ["client_id", "transaction_id"]).select(
        "transaction_id", "amount"
    )


@query("random_ids", f"{views('tx_baskets')} select count(*) as n_rows, count(*) as n_ids from tx_baskets")
def q_random_ids(spark, sf):
    fresh = cut(quality.random_ids(tx_baskets(spark, sf), "transaction_id"), "ids")
    return fresh.agg(F.count("*").alias("n_rows"), F.count_distinct("transaction_id").alias("n_ids"))


@query("fill_missing", f"""{views('prepared')}
select merchant, device_type, count(*) as n from prepared group by 1, 2""")
def q_fill(spark, sf):
    return agg.group_counts(prepare_transactions(masked_orders(spark, sf)), "merchant", "device_type")


_PROFILED = ["transaction_id", "client_id", "currency", "merchant", "transaction_type", "ip_address", "region", "device_type", "datetime", "amount", "session_id", "recipient_id"]
_COLUMN_TYPES = {"datetime": "timestamp", "amount": "double", "registration_date": "date"}


@query("column_profile", f"{views('tx_orders')} " + " union all ".join(
    f"select '{c}' as column_name, '{_COLUMN_TYPES.get(c, 'string')}' as data_type, (select count(*) from tx_orders) as n_rows, "
    f"count(distinct {c}) as distinct_values from tx_orders" for c in _PROFILED))
def q_profile(spark, sf):
    return quality.column_profile(tx_orders(spark, sf))


_CLIENT_PROFILED = ["client_id", "first_name", "last_name", "email", "passport_id", "status", "registration_date"]


@query("client_profile", f"{views('clients')} " + " union all ".join(
    f"select '{c}' as column_name, '{_COLUMN_TYPES.get(c, 'string')}' as data_type, (select count(*) from clients) as n_rows, "
    f"count(distinct {c}) as distinct_values from clients" for c in _CLIENT_PROFILED))
def q_client_profile(spark, sf):
    return quality.column_profile(clients(spark, sf))


@query("schema_evolve", f"""{views('tx_events')}
select transaction_id, client_id, cast(null as varchar) as merchant, cast(null as varchar) as device_type,
       region from tx_events""")
def q_evolve(spark, sf):
    df = quality.evolve_to(tx_events(spark, sf), {"Region": "string", "merchant": "string", "device_type": "string", "id": "long"})
    return df.select("transaction_id", "client_id", "merchant", "device_type", "region")


@query("column_intersection", f"{views('clients')} select client_id, status from clients")
def q_intersection(spark, sf):
    return quality.restrict_to(clients(spark, sf), ["STATUS", "Client_id", "unknown"])


# --- scalar expressions --------------------------------------------------------------------


@query("time_grains", f"""{views('tx_events')}
select transaction_id, strftime(date_trunc('minute', datetime), '%Y-%m-%d %H:%M:%S') as minute,
       strftime(time_bucket(interval '30 minutes', datetime), '%Y-%m-%d %H:%M:%S') as half_hour,
       strftime(datetime, '%Y-%m-%d-%H-%M') as label, cast(cast(datetime as date) as varchar) as day,
       cast(epoch(date_trunc('second', datetime)) as bigint) as sec from tx_events""")
def q_grains(spark, sf):
    ts = F.col("datetime")
    return tx_events(spark, sf).select(
        "transaction_id", second_text(to_minute(ts)).alias("minute"), second_text(floor_to(ts)).alias("half_hour"),
        minute_label(ts).alias("label"), F.to_date(ts).cast("string").alias("day"), epoch_seconds(ts).alias("sec"),
    )


@query("hub_keys", f"""{views('tx_orders')}
select transaction_id, 'm:' || merchant as strict_key, 'm:' || coalesce(merchant, 'nan') as kept_key,
       ln(1 + amount) is not null as has_weight,
       case when client_id like 'client\\_%' escape '\\' then 'client' else 'community' end as kind from tx_orders""")
def q_hub_keys(spark, sf):
    return tx_orders(spark, sf).select(
        "transaction_id", hub_key("m", F.col("merchant")).alias("strict_key"),
        hub_key_keep_null("m", F.col("merchant")).alias("kept_key"),
        F.log1p("amount").isNotNull().alias("has_weight"), node_type(F.col("client_id")).alias("kind"),
    )


# --- aggregates ----------------------------------------------------------------------------


@query("type_shares", f"""{views('tx_orders')}
select transaction_type, count(*) as n, round(count(*) / (select count(*) from tx_orders), 6) as share
from tx_orders group by 1""")
def q_type_shares(spark, sf):
    return rounded(reports.type_distribution(tx_orders(spark, sf)), 6, "share")


@query("max_multiplicity", f"{views('tx_orders')} " + " union all ".join(
    f"select '{c}' as column_name, max(n) as max_count from (select count(*) as n from tx_orders "
    f"where {c} is not null group by {c})" for c in ("client_id", "merchant", "ip_address")))
def q_max_multiplicity(spark, sf):
    return agg.max_multiplicity(tx_orders(spark, sf), ["client_id", "merchant", "ip_address"])


@query("clients_per_merchant", f"""{views('tx_orders')}
select merchant, count(distinct client_id) as n from tx_orders where merchant is not null group by 1""")
def q_clients_per_merchant(spark, sf):
    return agg.distinct_per_key(tx_orders(spark, sf), "merchant", "client_id")


@query("top_networks", f"""{views('masked')}
select ip_network, count(*) as n from masked where ip_network is not null group by 1 order by n desc, ip_network limit 5""")
def q_top_networks(spark, sf):
    return agg.top_values(masked_orders(spark, sf), "ip_network", 5)


@query("top_merchant_values", f"""{views('masked')}
select merchant, count(*) as n from masked where merchant is not null group by 1 order by n desc, merchant limit 5""")
def q_top_merchants(spark, sf):
    return agg.top_values(masked_orders(spark, sf), "merchant", 5)


@query("amount_histogram", f"""{views('tx_orders')},
span as (select min(amount) as a, max(amount) as b from tx_orders),
w as (select a, (b - a) / 50 as w from span),
c as (select least(cast(floor((amount - a) / w) as bigint), 49) as bin, count(*) as n from tx_orders, w group by 1)
select r.range as bin, round(a + r.range * w, 4) as low, round(a + (r.range + 1) * w, 4) as high, coalesce(n, 0) as n
from range(50) r cross join w left join c on c.bin = r.range""")
def q_histogram(spark, sf):
    return rounded(agg.histogram(tx_orders(spark, sf), F.col("amount"), 50), 4, "low", "high")


@query("amount_stats", f"""{views('tx_orders')}
select merchant, round(sum(amount) * 100) / (count(*) * 100.0) as mean, round(median(amount), 4) as median,
       min(amount) as min, max(amount) as max, count(*) as count from tx_orders where merchant is not null group by 1""")
def q_amount_stats(spark, sf):
    df = agg.group_statistics(tx_orders(spark, sf), "merchant", "amount")
    return rounded(df.withColumn("mean", exact_mean(F.col("mean"), F.col("count"))), 4, "median")


@query("amount_quartiles", f"""{views('tx_orders')}
select region, round(quantile_cont(amount, 0.25), 4) as q25, round(quantile_cont(amount, 0.5), 4) as q50,
       round(quantile_cont(amount, 0.75), 4) as q75 from tx_orders group by 1""")
def q_quartiles(spark, sf):
    df = agg.quantiles(tx_orders(spark, sf), "region", "amount", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return rounded(df, 4, "q25", "q50", "q75")


@query("other_bucket", f"""{views('tx_orders')},
c as (select merchant, count(*) as n from tx_orders where merchant is not null group by 1),
r as (select *, row_number() over (order by n desc, merchant) as rn from c)
select case when rn <= 10 then merchant else 'Другие' end as merchant, cast(sum(n) as bigint) as n from r group by 1""")
def q_other(spark, sf):
    return agg.top_with_other(agg.value_counts(tx_orders(spark, sf), "merchant"), "merchant", "n")


@query("hub_profile", f"""{views('tx_orders')}
select 'p2p_transactions' as measure, count(*) as value from tx_orders where transaction_type = 'p2p'
union all select 'withdrawal_transactions', count(*) from tx_orders where transaction_type = 'withdrawal'
union all select 'p2p_recipients', count(distinct recipient_id) from tx_orders where transaction_type = 'p2p'
union all select 'withdrawal_clients', count(distinct client_id) from tx_orders where transaction_type = 'withdrawal'
union all select 'regions', count(distinct region) from tx_orders
union all select 'shared_sessions', count(*) from (select session_id from tx_orders where session_id is not null
  group by 1 having count(distinct client_id) > 1)""")
def q_hub_profile(spark, sf):
    return reports.hub_sharing(tx_orders(spark, sf))


def _spend_sql(unit, rows):
    tail = f" order by sum_amount desc, period, client_id limit {rows}" if rows else ""
    return f"""{views('tx_events')},
top as (select client_id from tx_events group by 1 order by round(sum(amount), 2) desc, client_id limit 10)
select strftime(date_trunc('{unit}', datetime), '%Y-%m-%d %H:%M:%S') as period, client_id,
       round(sum(amount), 2) as sum_amount from tx_events where client_id in (select client_id from top)
group by 1, 2{tail}"""


def _spend(spark, sf, unit, rows=None):
    df = agg.spend_over_time(tx_events(spark, sf), unit, 10, rows)
    return rounded(df.withColumn("period", second_text(F.col("period"))), 2, "sum_amount")


@query("hourly_big_spenders", _spend_sql("hour", None))
def q_hourly(spark, sf):
    return _spend(spark, sf, "hour")


@query("hourly_big_spenders_chart", _spend_sql("hour", 10))
def q_hourly_chart(spark, sf):
    return _spend(spark, sf, "hour", 10)


@query("daily_top_clients", _spend_sql("day", None))
def q_daily_top(spark, sf):
    return _spend(spark, sf, "day")
