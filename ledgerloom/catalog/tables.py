"""Queries that load, write, replace and read back tables and files."""

import uuid

from pyspark.sql import functions as F

from ..graph import cliques as cq
from ..graph import subgraph as sg
from ..operators import edges as ed
from ..operators.masking import mask_transactions
from ..plans import loads, reports
from ..schemas import CLIENTS, RATES, TRANSACTIONS_EVOLVED
from ..session import cut, scratch_path
from ..sources import readers, writers
from .base import as_text, clients, masked_orders, query, rounded, second_text, tx_baskets, tx_events, tx_orders, views
from .graphs import _METRICS, link_cliques, lpa_sql, pagerank_sql, pagerank_weighted_sql

_ORDER_COLUMNS = "transaction_id, client_id, amount, merchant, region"


@query("csv_roundtrip", f"""{views('tx_orders')}
select transaction_id, client_id, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime, amount, merchant, ip_address, recipient_id from tx_orders""")
def q_csv(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(tx_orders(spark, sf), path)
    back = readers.read_csv(spark, path, TRANSACTIONS_EVOLVED)
    return back.select(
        "transaction_id", "client_id", second_text(F.col("datetime")).alias("datetime"), "amount", "merchant",
        "ip_address", "recipient_id",
    )


@query("load_transactions", f"""{views('tx_orders', 'tx_events')}
select transaction_id, client_id, amount, cast(null as varchar) as merchant, cast(null as varchar) as device_type, region from tx_events
where cast(substr(transaction_id, 2) as bigint) % 3 <> 0
union all select transaction_id, client_id, amount, merchant, device_type, region from tx_orders
union all select transaction_id, client_id, amount * 2, 'again', null, region from tx_events
where cast(substr(transaction_id, 2) as bigint) % 3 = 0""")
def q_load_transactions(spark, sf):
    """The target lacks columns of the batch; a third of the target's keys arrive again."""
    target = tx_events(spark, sf)
    again = target.filter(F.substring("transaction_id", 2, 20).cast("long") % 3 == 0).withColumns(
        {"amount": F.col("amount") * 2, "merchant": F.lit("again")}
    )
    batch = tx_orders(spark, sf).withColumn("id", F.lit(1)).unionByName(again, allowMissingColumns=True)
    return loads.load_transactions(target, batch).select(
        "transaction_id", "client_id", "amount", "merchant", "device_type", "region"
    )


@query("key_replace", f"""{views('tx_orders')}
select transaction_id, amount, case when cast(substr(transaction_id, 2) as bigint) % 2 = 0 then 'new' else currency end as currency
from tx_orders""")
def q_key_replace(spark, sf):
    target = tx_orders(spark, sf)
    batch = target.filter(F.substring("transaction_id", 2, 20).cast("long") % 2 == 0).withColumn("currency", F.lit("new"))
    return writers.key_replaced(target, batch, "transaction_id").select("transaction_id", "amount", "currency")


@query("load_clients", f"""{views('clients')}
select client_id, first_name, last_name, email, passport_id, cast(registration_date as varchar) as registration_date, status from clients""")
def q_load_clients(spark, sf):
    """Truncate and load into a declared table; the batch carries one unknown column."""
    name, root = f"clients_{uuid.uuid4().hex}", scratch_path(spark, "warehouse")
    writers.publish(spark.createDataFrame([], CLIENTS), name, root)
    batch = clients(spark, sf).withColumn("comment", F.lit("x"))
    writers.truncate_and_load(loads.load_clients(spark.table(name).columns, batch), name, root)
    return as_text(readers.read_table(spark, name), "registration_date")


@query("load_rates", f"""{views('tx_orders')}, days as (select distinct cast(datetime as date) as date from tx_orders),
c(currency, rate) as (values ('USD', 90.0), ('EUR', 98.0), ('GBP', 110.0), ('RUB', 1.0))
select cast(date as varchar) as date, currency, cast(case when date = (select min(date) from days) then rate * 2 else rate end as double) as rate
from days, c""")
def q_load_rates(spark, sf):
    """Rates of every transaction day; then the first day's slice is loaded again with other rates."""
    path = scratch_path(spark, "rates")
    pair = F.explode(F.create_map(*[F.lit(x) for kv in loads.RATES.items() for x in kv])).alias("currency", "rate")
    days = tx_orders(spark, sf).select(F.to_date("datetime").alias("date")).distinct()
    month = F.date_format("date", "yyyy-MM")
    writers.replace_slice(days.select("date", pair).withColumn("month", month), path, "date", "month")
    first = days.agg(F.min("date")).first()[0]
    other = loads.rates_for(spark, str(first), {k: v * 2 for k, v in loads.RATES.items()})
    writers.replace_slice(other.withColumn("month", month), path, "date", "month")
    return as_text(spark.read.schema(RATES).parquet(path).drop("month"), "date")


@query("rates_slice", f"""{views('tx_orders')}, days as (select distinct cast(datetime as date) as date from tx_orders),
c(currency, rate) as (values ('USD', 90.0), ('EUR', 98.0), ('GBP', 110.0), ('RUB', 1.0))
select cast(date as varchar) as date, currency, cast(rate as double) as rate from days, c where date <> date '1998-01-01'
union all select '1998-01-01', currency, cast(rate as double) from c""")
def q_rates_slice(spark, sf):
    pair = F.explode(F.create_map(*[F.lit(x) for kv in loads.RATES.items() for x in kv])).alias("currency", "rate")
    target = tx_orders(spark, sf).select(F.to_date("datetime").alias("date")).distinct().select("date", pair)
    return as_text(loads.load_rates(target, "1998-01-01"), "date")


@query("table_swap", f"""{views('masked')}
select transaction_id, amount, ip_network, 'late' as channel from masked
union all select transaction_id, 0.0, null, 'extra' from masked where amount > 400000""")
def q_swap(spark, sf):
    """Publish, add a column, publish the new version over the old one, then append."""
    name, root = f"tx_{uuid.uuid4().hex}", scratch_path(spark, "warehouse")
    tx = masked_orders(spark, sf).select("transaction_id", "amount", "ip_network")
    writers.publish(tx, name, root)
    writers.add_columns(spark, name, {"channel": "string"})
    # The new version reads the table it replaces.
    writers.publish(spark.table(name).withColumn("channel", F.coalesce("channel", F.lit("late"))), name, root)
    extra = tx.filter("amount > 400000").select("transaction_id", F.lit(0.0).alias("amount"), F.lit("extra").alias("channel"))
    writers.append(extra, name)
    return readers.read_sql(spark, f"select transaction_id, amount, ip_network, channel from {name}")


_EXPORTED = 20  # communities of the exported graph
_MEMBERS = f"""{views('links')}, {_METRICS.replace('edges', 'links')}, {lpa_sql('links', 10)},
sizes as (select label, count(*) as n from lp10 group by 1),
top as materialized (select label, n from sizes order by n desc, label limit {_EXPORTED}),
member as materialized (select id, label, n from lp10 join top using (label))"""


@query("json_summary", f"""{_MEMBERS}
select (select count(*) from lp10) as total_nodes, (select count(*) from links) as total_edges,
(select round(avg(degree), 6) from metrics) as avg_degree, (select max(degree) from metrics) as max_degree,
(select count(*) from sizes) as communities, (select count(*) from member) as filtered_nodes,
(select count(*) from links where src in (select id from member) and dst in (select id from member)) as filtered_edges,
(select string_agg(label || '=' || n, ';' order by label) from top) as distribution""")
def q_json(spark, sf):
    """The one-record summary, written as JSON and read back."""
    graph = link_cliques(spark, sf)
    table = cut(graph.names.named(cq.labels(graph, 10).join(cq.metrics(graph), "id"), "id", "community_id"), "table")
    path = scratch_path(spark, "json")
    stats = reports.graph_statistics(table, graph, _EXPORTED)
    writers.write_json(stats, path)
    back = spark.read.schema(stats.schema).json(path)
    entries = F.array_sort(F.map_entries("community_distribution"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return rounded(
        back.select("total_nodes", "total_edges", "avg_degree", "max_degree", "communities", "filtered_nodes", "filtered_edges",
                    text.alias("distribution")), 6, "avg_degree"
    )


def _graphml(spark, sf, scores=True):
    """The largest communities with their attributes, as a graph file."""
    graph = link_cliques(spark, sf)
    membership = cut(cq.labels(graph, 10), "membership")
    members = sg.members_of_top_communities(membership, _EXPORTED)
    nodes = cq.metrics(graph).join(members, "id").join(sg.community_sizes(membership), "community_id")
    if scores:
        nodes = nodes.join(cq.pagerank(graph, 20), "id")
    nodes = cut(graph.names.named(nodes, "id", "community_id"), "exported")
    path = scratch_path(spark, "graphml")
    writers.write_graphml(nodes, cq.links(graph, nodes.select("id")).withColumnRenamed("relationship", "relationships"), path)
    return path


@query("graphml_nodes", f"""{_MEMBERS}, {pagerank_sql('links', 20)}
select m.id, m.label as community_id, round(influence_score, 6) as influence_score, n as community_size, round(w_degree, 6) as w_degree,
degree, case when starts_with(m.id, 'client_') then 'client' else 'community' end as node_type
from member m join metrics using (id) join pr using (id)""")
def q_graphml_nodes(spark, sf):
    return rounded(readers.read_graphml_nodes(spark, f"{_graphml(spark, sf)}/nodes"), 6, "w_degree", "influence_score")


@query("graphml_edges", f"""{_MEMBERS} select src as source, dst as target, weight, relationship as relationships from links
where src in (select id from member) and dst in (select id from member)""")
def q_graphml_edges(spark, sf):
    return readers.read_graphml_edges(spark, f"{_graphml(spark, sf)}/edges")


@query("graphml_completed", f"""{_MEMBERS},
part as materialized (select src, dst, weight from links where src in (select id from member) and dst in (select id from member)),
{pagerank_weighted_sql('part', 12)}
select m.id, m.label as community_id, round(r, 8) as influence_score from member m join w12 using (id)""")
def q_graphml_completed(spark, sf):
    """A graph file without scores, read back with the missing scores of its linked nodes computed."""
    path = _graphml(spark, sf, scores=False)
    edges = readers.read_graphml_edges(spark, f"{path}/edges")
    linked = ed.vertices(edges.select(F.col("source").alias("src"), F.col("target").alias("dst")))
    nodes = cut(readers.read_graphml_nodes(spark, f"{path}/nodes").join(linked, "id", "left_semi"), "nodes")
    full = reports.completed_nodes(nodes, edges, rounds=12)
    return rounded(full.select("id", "community_id", "influence_score"), 8, "influence_score")


@query("mask_pipeline", f"""{views('masked_baskets')}
select ip_network, recipient_id_hash, count(*) as n, round(sum(amount), 2) as amount from masked_baskets group by 1, 2""")
def q_mask_pipeline(spark, sf):
    """Load, write, read back, mask and aggregate."""
    path = scratch_path(spark, "staging")
    tx_baskets(spark, sf).write.parquet(path)
    masked = mask_transactions(spark.read.parquet(path))
    return rounded(
        masked.groupBy("ip_network", "recipient_id_hash").agg(F.count("*").alias("n"), F.sum("amount").alias("amount")),
        2, "amount",
    )
