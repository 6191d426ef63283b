"""Queries over client graph edges."""

from pyspark.sql import functions as F

from ..graph import classes
from ..graph.classes import LARGE, LARGE_PART
from ..graph.subgraph import top_nodes
from ..operators import edges as ed
from ..operators import projection as pj
from .base import NEEDS, VIEWS, clients, masked_baskets, masked_orders, query, rounded, second_text, tx_orders, views

# --- shared SQL ------------------------------------------------------------------------------

# relationship, key, cap, weight
KINDS = [
    ("merchant", "merchant", 100, 0.5),
    ("session", "session_id", 50, 0.7),
    ("ip", "ip_network", 50, 0.6),
    ("atm", "case when transaction_type = 'withdrawal' then region || '_' || strftime(datetime, '%Y-%m-%d-%H-%M') end", 20, 0.8),
]


def _hub_sql(kinds) -> str:
    return " union all ".join(
        f"select distinct '{name}' as kind, {key} as hub, client_id, {cap} as cap, cast({weight} as double) as weight "
        f"from prepared where ({key}) is not null"
        for name, key, cap, weight in kinds
    )


def _pairs_sql(hubs: str) -> str:
    return (
        f"select a.client_id as src, b.client_id as dst, a.kind as relationship, a.weight "
        f"from {hubs} a join {hubs} b on a.kind = b.kind and a.hub = b.hub and a.client_id < b.client_id "
        f"where (a.kind, a.hub) in (select (kind, hub) from {hubs} group by kind, hub, cap having count(*) between 2 and cap)"
    )


_P2P = ("select client_id as src, recipient_id_hash as dst, 'p2p' as relationship, ln(1 + amount) as weight "
        "from prepared where transaction_type = 'p2p' and recipient_id_hash is not null")

VIEWS["hubs"] = _hub_sql(KINDS)
NEEDS["hubs"] = ["prepared"]
VIEWS["all_edges"] = f"{_P2P} union all {_pairs_sql('hubs')}"
NEEDS["all_edges"] = ["hubs"]
VIEWS["edges"] = (
    "select src, dst, sum(weight) as weight, string_agg(distinct relationship, ',' order by relationship) as relationships_str "
    "from all_edges group by 1, 2 having sum(weight) >= 0.5"
)
NEEDS["edges"] = ["all_edges"]
VIEWS["vertices"] = "select src as id from edges union select dst from edges"
NEEDS["vertices"] = ["edges"]


def final_edges(spark, sf):
    return ed.client_edges(masked_orders(spark, sf))


# --- edges of the client graph ---------------------------------------------------------------


@query("edges_p2p", f"""{views('prepared')}, e as ({_P2P})
select src, dst, relationship, round(weight, 6) as weight from e""")
def q_p2p(spark, sf):
    return rounded(ed.transfer_edges(masked_orders(spark, sf)), 6, "weight")


def _register_kind(kind):
    name = kind[0]
    sql = f"{views('prepared')}, hubs as materialized ({_hub_sql([kind])}) {_pairs_sql('hubs')}"

    @query(f"edges_{name}", sql)
    def run(spark, sf):
        tx = ed.prepare_transactions(masked_orders(spark, sf))
        return ed.shared_edges(tx, [k for k in ed.standard_kinds() if k.name == name])


for _kind in KINDS:
    _register_kind(_kind)


@query("hub_sizes", f"{views('hubs')} select kind, hub, count(*) as n_clients from hubs group by 1, 2")
def q_hub_sizes(spark, sf):
    tx = ed.prepare_transactions(masked_orders(spark, sf))
    return ed.hub_sizes(ed.hub_members(tx, ed.standard_kinds()))


@query("edges_final", f"{views('edges')} select src, dst, round(weight, 6) as weight, relationships_str from edges")
def q_final(spark, sf):
    return rounded(final_edges(spark, sf).drop("relationships"), 6, "weight")


@query("edges_resolved", f"""{views('all_edges', 'clients')},
known as (select sha256(client_id) as h, client_id from clients),
e as (select src, coalesce(client_id, dst) as dst, relationship, weight from all_edges left join known
      on dst = h and relationship = 'p2p')
select src, dst, round(sum(weight), 6) as weight, string_agg(distinct relationship, ',' order by relationship) as relationships_str
from e group by 1, 2 having sum(weight) >= 0.5""")
def q_resolved(spark, sf):
    df = ed.client_edges(masked_orders(spark, sf), clients(spark, sf), recipient_key="resolve")
    return rounded(df.drop("relationships"), 6, "weight")


@query("vertices", f"{views('vertices')} select id from vertices")
def q_vertices(spark, sf):
    return ed.vertices(final_edges(spark, sf))


# --- distinct pairs ----------------------------------------------------------------------------

def _members(source, key, max_rows=None):
    keep = f"and {key} in (select {key} from {source} group by 1 having count(*) < {max_rows})" if max_rows else ""
    return f"(select distinct {key} as hub, client_id from {source} where {key} is not null {keep})"


def _branch(source, key, relationship, weight, max_rows=None):
    """SQL of one branch in hub form: each client of each hub that two or more clients share."""
    m = _members(source, key, max_rows)
    return (
        f"select client_id as source, hub as target, '{relationship}_hub' as relationship, cast({weight} as double) as weight "
        f"from {m} where hub in (select hub from {m} group by 1 having count(*) >= 2)"
    )


def _pair_branch(source, key, relationship, weight, max_rows=None):
    """SQL of one branch as distinct pairs."""
    m = _members(source, key, max_rows)
    return (
        f"select distinct a.client_id as source, b.client_id as target, '{relationship}' as relationship, "
        f"cast({weight} as double) as weight from {m} a join {m} b on a.hub = b.hub and a.client_id < b.client_id"
    )


def _transfers(source, weight):
    return (
        f"select distinct client_id as source, recipient_id_hash as target, 'p2p' as relationship, "
        f"cast({weight} as double) as weight from {source} where transaction_type = 'p2p' and client_id < recipient_id_hash"
    )


def _variant(source, *branches):
    return f"{views(source)} select * from (" + " union all ".join(branches) + ")"


B = "masked_baskets"


def most_active(tx, n):
    """The ids of the ``n`` clients with the most transactions."""
    return top_nodes(tx.groupBy(F.col("client_id").alias("id")).agg(F.count("*").alias("n")), n, "n")


@query("edges_sql_variant", _variant(B, _branch(B, "ip_network", "ip_shared", 1.0), _branch(B, "merchant", "merchant_shared", 0.5)))
def q_variant(spark, sf):
    return ed.distinct_pair_edges(masked_baskets(spark, sf), ed.network_and_merchant())


@query("edges_sql_filtered", _variant(B, _branch(B, "ip_network", "ip_shared", 1.0, 500), _branch(B, "merchant", "merchant_shared", 0.5)))
def q_filtered(spark, sf):
    return ed.distinct_pair_edges(masked_baskets(spark, sf), ed.network_and_merchant(ip_max_rows=500))


_REWEIGHTED = [_branch(B, "ip_network", "ip_shared", 0.1, 500), _branch(B, "merchant", "merchant_shared", 0.5), _transfers(B, 2.0)]


def reweighted(spark, sf):
    return ed.distinct_pair_edges(masked_baskets(spark, sf), ed.network_and_merchant(0.1, 0.5, 500), transfer_weight=2.0)


@query("edges_sql_reweighted", _variant(B, *_REWEIGHTED))
def q_reweighted(spark, sf):
    return reweighted(spark, sf)


@query("edges_no_ip", _variant(B, _branch(B, "merchant", "merchant_shared", 1.0), _transfers(B, 5.0)))
def q_no_ip(spark, sf):
    return ed.distinct_pair_edges(
        masked_baskets(spark, sf), [ed.PairRule("merchant", "merchant_shared", 1.0)], transfer_weight=5.0
    )


@query("edges_large_hubs", _variant("masked", _branch("masked", "ip_network", "ip_shared", 1.0), _branch("masked", "merchant", "merchant_shared", 0.5)))
def q_large_hubs(spark, sf):
    """Chains whose pairs could not be listed: client-to-hub rows hold the same links."""
    return ed.distinct_pair_edges(masked_orders(spark, sf), ed.network_and_merchant())


@query("edge_diagnostics", f"""{views(B)}, e as materialized ({' union all '.join(_REWEIGHTED)}),
h as (select relationship, target, count(*) as n from e where ends_with(relationship, '_hub') group by 1, 2),
c as (select relationship, source as client from e union select relationship, target from e where not ends_with(relationship, '_hub'))
select r as relationship, (select count(*) from e where relationship = r) as n_edges, (select count(*) from c where relationship = r) as n_clients,
  (select count(*) from h where relationship = r) as n_hubs,
  cast(case when ends_with(r, '_hub') then (select sum(n * (n - 1) // 2) from h where relationship = r)
            else (select count(*) from e where relationship = r) end as bigint) as n_pairs
from (select distinct relationship as r from e)""")
def q_diagnostics(spark, sf):
    return ed.edge_diagnostics(reweighted(spark, sf))


@query("edges_top_clients", f"""{views(B)},
top as materialized (select client_id, count(*) as n from {B} group by 1 order by n desc, client_id limit 100),
few as materialized (select * from {B} where client_id in (select client_id from top))
{_pair_branch('few', 'ip_network', 'ip_shared', 1.0)} union all {_pair_branch('few', 'merchant', 'merchant_shared', 0.5)}""")
def q_top_clients(spark, sf):
    """Pairs among the 100 most active clients; both ends are restricted before pairs are built."""
    tx = masked_baskets(spark, sf)
    return ed.distinct_pair_edges(tx, ed.network_and_merchant(), nodes=most_active(tx, 100))


# --- edges in time order and last-writer merge ---------------------------------------------------

_SEQUENTIAL = """select client_id as src, nc as dst, 'merchant_shared' as relationship, cast(1.0 as double) as weight from (
  select client_id, datetime, lead(client_id) over w as nc, lead(datetime) over w as nt
  from {t} where merchant in (select merchant from {t} group by 1 having count(*) <= 100)
  window w as (partition by merchant order by datetime, transaction_id))
where nt - datetime <= interval '1 day' and client_id <> nc"""
_RAW_P2P = """select distinct client_id as src, recipient_id as dst, 'p2p' as relationship, cast(10.0 as double) as weight
from {t} where transaction_type = 'p2p' and client_id < recipient_id"""


def _hub_rows_sql(source, key, relationship, weight, min_rows):
    """SQL of row counts by hub and client, of hubs with enough rows."""
    c = f"(select {key} as hub, client_id, count(*) as n from {source} where ({key}) is not null group by 1, 2)"
    return (
        f"select client_id as src, hub as dst, '{relationship}_hub' as relationship, cast({weight} as double) as weight, n as multiplicity "
        f"from {c} where hub in (select hub from {c} group by 1 having sum(n) >= {min_rows})"
    )


def _row_pairs_sql(source, key, relationship, weight, min_rows):
    """SQL of all pairs of rows in a hub: the definition, one pair of rows after the other."""
    r = f"(select {key} as hub, client_id, transaction_id from {source} where ({key}) is not null)"
    return (
        f"select least(a.client_id, b.client_id) as src, greatest(a.client_id, b.client_id) as dst, '{relationship}' as relationship, "
        f"cast({weight} as double) as weight, count(*) as multiplicity from {r} a join {r} b on a.hub = b.hub and a.transaction_id < b.transaction_id "
        f"where a.hub in (select hub from {r} group by 1 having count(*) >= {min_rows}) group by 1, 2"
    )


_SESSION_OF = ("tx_orders", "session_id", "session_shared", 0.5, 6)
_WITHDRAWAL_OF = (
    "(select * from tx_orders where transaction_type = 'withdrawal')",
    "region || '@' || epoch_us(datetime)", "withdrawal_shared", 2.0, 2,
)
_SESSION, _WITHDRAWAL = _row_pairs_sql(*_SESSION_OF), _row_pairs_sql(*_WITHDRAWAL_OF)


@query("edges_sequential", f"{views('tx_orders')} {_SEQUENTIAL.format(t='tx_orders')}")
def q_sequential(spark, sf):
    return ed.sequential_edges(tx_orders(spark, sf))


@query("edges_p2p_raw", f"{views('tx_orders')} {_RAW_P2P.format(t='tx_orders')}")
def q_raw(spark, sf):
    return ed.raw_transfer_pairs(tx_orders(spark, sf))


@query("edges_session_rows", f"{views('tx_orders')} {_hub_rows_sql(*_SESSION_OF)}")
def q_session_rows(spark, sf):
    return ed.session_edges(tx_orders(spark, sf))


@query("edges_withdrawal_pairs", f"{views('tx_orders')} {_WITHDRAWAL}")
def q_withdrawal_pairs(spark, sf):
    return ed.withdrawal_edges(tx_orders(spark, sf), pairs=True)


@query("edges_withdrawal_rows", f"{views('tx_orders')} {_hub_rows_sql(*_WITHDRAWAL_OF)}")
def q_withdrawal_rows(spark, sf):
    return ed.withdrawal_edges(tx_orders(spark, sf))


_SEQUENTIAL_ALL = """select client_id as src, nc as dst, 'merchant_shared' as relationship, cast(1.0 as double) as weight from (
  select client_id, datetime, lead(client_id) over w as nc, lead(datetime) over w as nt
  from {t} where merchant is not null window w as (partition by merchant order by datetime, transaction_id))
where nt - datetime <= interval '1 day' and client_id <> nc"""
VIEWS["lastwriter"] = f"""with e as (
  select src, dst, relationship, weight, 1 as o from ({_SEQUENTIAL_ALL.format(t='tx_orders')})
  union all select src, dst, relationship, weight, 2 from ({_RAW_P2P.format(t='tx_orders')})
  union all select src, dst, relationship, weight, 3 from ({_SESSION})
  union all select src, dst, relationship, weight, 4 from ({_WITHDRAWAL}))
select least(src, dst) as src, greatest(src, dst) as dst, max_by(relationship, o) as relationship, max_by(weight, o) as weight
from e group by 1, 2"""
NEEDS["lastwriter"] = ["tx_orders"]


@query("edges_lastwriter", f"{views('lastwriter')} select * from lastwriter")
def q_lastwriter(spark, sf):
    """Every pair is a row, whatever the size of its session; merchants of any size link neighbours in time."""
    return ed.last_writer_pairs(tx_orders(spark, sf))


# --- projection ------------------------------------------------------------------------------------

_FILLED = ("select * replace (coalesce(merchant, 'no_merchant') as merchant, coalesce(device_type, 'unknown') as device_type) "
           "from tx_orders")
VIEWS["incidence"] = f"""with f as ({_FILLED}),
i as (select client_id, 'm:' || merchant as hub, 'm' as kind, 1.0 as w from f
union all select client_id, 'sess:' || session_id, 'sess', 0.5 from f
union all select client_id, 'ip:' || ip_address, 'ip', 0.7 from f
union all select client_id, 'dev:' || device_type, 'dev', 0.3 from f
union all select client_id, 'reg:' || region, 'reg', 0.2 from f
union all select client_id, 'atm:' || coalesce(region, 'nan') || ':' ||
  strftime(time_bucket(interval '30 minutes', datetime), '%Y-%m-%d %H:%M:%S'), 'atm',
  case transaction_type when 'withdrawal' then 0.8 else 0.6 end from f where transaction_type in ('withdrawal', 'deposit'))
select client_id, hub, kind, cast(max(w) as double) as weight from i where hub is not null group by 1, 2, 3"""
NEEDS["incidence"] = ["tx_orders"]
VIEWS["hub_count"] = "select hub, count(*) as n_clients from incidence group by 1"
NEEDS["hub_count"] = ["incidence"]
HUB_REPORT = 100  # clients above which the report lists a hub
TOP = 300  # clients between which pairs are listed
VIEWS["top"] = f"select client_id from tx_orders group by 1 order by count(*) desc, client_id limit {TOP}"
NEEDS["top"] = ["tx_orders"]
VIEWS["projected"] = """select a.client_id as src, b.client_id as dst, count(*) as shared, ln(1 + count(*)) as weight from incidence a
  join incidence b on a.hub = b.hub and a.client_id < b.client_id
  where a.client_id in (select client_id from top) and b.client_id in (select client_id from top) group by 1, 2"""
NEEDS["projected"] = ["incidence", "top"]
VIEWS["all_projected"] = """select a.client_id as src, b.client_id as dst, count(*) as shared, ln(1 + count(*)) as weight from incidence a
  join incidence b on a.hub = b.hub and a.client_id < b.client_id group by 1, 2"""
NEEDS["all_projected"] = ["incidence"]
_LARGE_SQL = f"greatest({LARGE}, (select count(distinct client_id) // {LARGE_PART} from incidence))"
# Classes by the set of hubs above the bound, and the pairs that are listed: those in smaller hubs, and transfers.
VIEWS["classes"] = f"""select client_id, min(client_id) over (partition by s) as cls from
(select client_id, list_sort(list(hub)) as s from incidence where hub in (select hub from hub_count where n_clients > {_LARGE_SQL}) group by 1)"""
NEEDS["classes"] = ["incidence", "hub_count"]
VIEWS["small_pairs"] = f"""select distinct a.client_id as src, b.client_id as dst from incidence a join incidence b on a.hub = b.hub and a.client_id < b.client_id
where a.hub in (select hub from hub_count where n_clients <= {_LARGE_SQL})"""
NEEDS["small_pairs"] = ["incidence", "hub_count"]
VIEWS["collapsed"] = """select client_id as src, recipient_id as dst, arg_max(amount, row(datetime, transaction_id)) as amount,
max(datetime) as datetime from tx_orders where transaction_type = 'p2p' and recipient_id is not null group by 1, 2"""
NEEDS["collapsed"] = ["tx_orders"]
VIEWS["sent"] = """select least(src, dst) as src, greatest(src, dst) as dst, sum(ln(1 + amount)) as w, count(*) as c from collapsed group by 1, 2"""
NEEDS["sent"] = ["collapsed"]
VIEWS["all_merged"] = """select coalesce(p.src, t.src) as src, coalesce(p.dst, t.dst) as dst, coalesce(shared, 0) as shared,
  coalesce(p.weight, 0) + coalesce(t.w, 0) as weight, case when p.src is null then 'p2p' else 'shared' end as layer, t.c as p2p_count
from all_projected p full join sent t on p.src = t.src and p.dst = t.dst where coalesce(p.weight, 0) + coalesce(t.w, 0) >= 1"""
NEEDS["all_merged"] = ["all_projected", "sent"]
VIEWS["merged"] = """with t as (select least(src, dst) as src, greatest(src, dst) as dst, sum(ln(1 + amount)) as w, count(*) as c
  from collapsed where src in (select client_id from top) and dst in (select client_id from top) group by 1, 2)
select coalesce(p.src, t.src) as src, coalesce(p.dst, t.dst) as dst, coalesce(p.weight, 0) + coalesce(t.w, 0) as weight,
  case when p.src is null then 'p2p' else 'shared' end as layer, t.c as p2p_count
from projected p full join t on p.src = t.src and p.dst = t.dst
where coalesce(p.weight, 0) + coalesce(t.w, 0) >= 1"""
NEEDS["merged"] = ["projected", "collapsed"]


@query("incidence", f"{views('incidence')} select * from incidence")
def q_incidence(spark, sf):
    return pj.incidence(tx_orders(spark, sf))


def _compressed_sql(edges: str, listed: str) -> str:
    """Rows of ``edges`` that are in ``listed`` as they are, the others by pair of classes."""
    return f"""listed as materialized ({listed}),
rows_ as (select e.*, l.src is not null as one, a.cls as ca, b.cls as cb from {edges} e left join listed l using (src, dst)
  left join classes a on a.client_id = e.src left join classes b on b.client_id = e.dst)
select 'pair' as level, src, dst, shared, round(weight, 6) as weight, layer, p2p_count, 1 as n_pairs from rows_ where one
union all select 'class', least(ca, cb), greatest(ca, cb), shared, round(any_value(weight), 6), 'shared', null, count(*) from rows_ where not one group by 2, 3, 4"""


@query("projection", f"""{views('all_projected', 'classes', 'small_pairs')}, tagged as (select *, 'shared' as layer, cast(null as bigint) as p2p_count from all_projected),
{_compressed_sql('tagged', 'select * from small_pairs')}""")
def q_projection_all(spark, sf):
    """Every pair of clients that shares a hub, whatever its size; pairs that differ in nothing are one row of their classes."""
    return rounded(classes.compressed_rows(classes.class_graph(tx_orders(spark, sf), min_weight=0.0, transfers=False)), 6, "weight")


@query("merged_graph", f"""{views('all_merged', 'classes', 'small_pairs')},
{_compressed_sql('all_merged', 'select * from small_pairs union select src, dst from sent')}""")
def q_merged_all(spark, sf):
    """Every edge of projection plus transfers with a weight of 1 or more, in the same form."""
    return rounded(classes.compressed_rows(classes.class_graph(tx_orders(spark, sf))), 6, "weight")


@query("projection_top", f"{views('projected')} select src, dst, shared, round(weight, 6) as weight from projected")
def q_projection(spark, sf):
    """A report of the most active clients: all hubs count, pairs are listed between them."""
    tx = tx_orders(spark, sf)
    return rounded(pj.project(pj.incidence(tx), most_active(tx, TOP)), 6, "weight")


@query("projection_of_transfers", f"""{views('incidence')},
p as (select distinct client_id as src, recipient_id as dst from tx_orders where transaction_type = 'p2p' and client_id < recipient_id),
s as (select a.client_id as src, b.client_id as dst, count(*) as shared from incidence a join incidence b on a.hub = b.hub group by 1, 2)
select p.src, p.dst, coalesce(shared, 0) as shared, round(ln(1 + coalesce(shared, 0)), 6) as weight from p left join s using (src, dst)""")
def q_projection_of_transfers(spark, sf):
    """What the two sides of each transfer share, over all hubs."""
    tx = tx_orders(spark, sf)
    return rounded(pj.shared_of_pairs(pj.incidence(tx), ed.raw_transfer_pairs(tx)), 6, "weight")


@query("projection_large_hubs", f"""{views('hub_count')}
select hub, client_id, n_clients from incidence join hub_count using (hub) where n_clients > {HUB_REPORT}""")
def q_large(spark, sf):
    return pj.large_hubs(pj.incidence(tx_orders(spark, sf)), HUB_REPORT)


@query("p2p_collapsed", f"""{views('collapsed')}
select src, dst, amount, strftime(datetime, '%Y-%m-%d %H:%M:%S') as datetime from collapsed""")
def q_collapsed(spark, sf):
    df = pj.transfers_collapsed(tx_orders(spark, sf))
    return df.withColumn("datetime", second_text(F.col("datetime")))


@query("merged_graph_top", f"{views('merged')} select src, dst, round(weight, 6) as weight, layer, p2p_count from merged")
def q_merged(spark, sf):
    tx = tx_orders(spark, sf)
    return rounded(pj.merged_graph(tx, nodes=most_active(tx, TOP)), 6, "weight")
