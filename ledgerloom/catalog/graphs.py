"""Queries over graph measures, communities and the marts built from them."""

from pyspark.sql import functions as F

from ..functions.text import node_type
from ..graph import class_triangles as ct
from ..graph import classes
from ..graph import cliques as cq
from ..graph import components as cc
from ..graph import degrees as dg
from ..graph import paths
from ..graph import subgraph as sg
from ..graph.louvain import louvain
from ..graph.lpa import label_propagation
from ..graph.pagerank import pagerank
from ..operators import aggregates as agg
from ..operators import edges as ed
from ..operators.categories import fill_categories
from ..plans import marts, reports
from ..session import cut
from .base import NEEDS, ORACLES, VIEWS, exact_mean, masked_orders, query, rounded, second_text, tx_orders, views
from .edges import _RAW_P2P, _SEQUENTIAL, _WITHDRAWAL, final_edges

# --- graphs -----------------------------------------------------------------------------------


def transfer_graph(spark, sf):
    """Undirected graph of transfers between known clients."""
    return ed.raw_transfer_pairs(tx_orders(spark, sf)).select("src", "dst", "weight")


def link_graph(spark, sf):
    """Undirected graph (src, dst, weight) of sequential, transfer and withdrawal edges, last kind wins."""
    return named_link_graph(spark, sf).drop("relationship")


def named_link_graph(spark, sf):
    """The same with the relationship of each edge."""
    return ed.listed_links(*ed.link_parts(tx_orders(spark, sf)))


def link_cliques(spark, sf):
    """The same graph without listing the pairs of withdrawals, see :mod:`..graph.cliques`."""
    return cq.clique_graph(*ed.link_parts(tx_orders(spark, sf)))


VIEWS["transfers"] = _RAW_P2P.format(t="tx_orders")
NEEDS["transfers"] = ["tx_orders"]
VIEWS["links"] = f"""with e as (
  select src, dst, relationship, weight, 1 as o from ({_SEQUENTIAL.format(t='tx_orders')})
  union all select src, dst, relationship, weight, 2 from ({_RAW_P2P.format(t='tx_orders')})
  union all select src, dst, relationship, weight, 4 from ({_WITHDRAWAL}))
select least(src, dst) as src, greatest(src, dst) as dst, max_by(weight, o) as weight,
  max_by(relationship, o) as relationship from e where src <> dst group by 1, 2"""
NEEDS["links"] = ["tx_orders"]


def lpa_sql(edges: str, rounds: int, prefix: str = "lp", own: bool = False) -> str:
    """Round tables ``{prefix}0`` .. ``{prefix}{rounds}`` (id, label) as a chain of CTEs."""
    parts = [
        f"{prefix}_adj as materialized (select src, dst, count(*) as n from (select src, dst from {edges} "
        f"union all select dst, src from {edges}"
        f"{f' union all select distinct id, id from (select src as id from {edges} union select dst from {edges})' if own else ''}) group by 1, 2)",
        f"{prefix}0 as materialized (select distinct src as id, src as label from {prefix}_adj)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"{prefix}{i} as materialized (select id, label from (select dst as id, label, sum(n) as v "
            f"from {prefix}_adj join {prefix}{i - 1} on src = id group by 1, 2) "
            f"qualify row_number() over (partition by id order by v desc, label) = 1)"
        )
    return ", ".join(parts)


def pagerank_sql(edges: str, rounds: int, prefix: str = "pr") -> str:
    parts = [
        f"{prefix}_v as materialized (select src as id from {edges} union select dst from {edges})",
        f"{prefix}_out as materialized (select src as id, count(*) as o from {edges} group by 1)",
        f"{prefix}0 as materialized (select id, cast(1.0 as double) as r from {prefix}_v)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"{prefix}{i} as materialized (select v.id, 0.15 + 0.85 * coalesce(s, 0) as r from {prefix}_v v left join "
            f"(select dst as id, sum(r / o) as s from {edges} e join {prefix}{i - 1} p on e.src = p.id "
            f"join {prefix}_out u on u.id = e.src group by 1) m on m.id = v.id)"
        )
    parts.append(
        f"{prefix} as materialized (select id, r * (select count(*) / sum(r) from {prefix}{rounds}) as influence_score "
        f"from {prefix}{rounds})"
    )
    return ", ".join(parts)


def pagerank_weighted_sql(edges: str, rounds: int) -> str:
    parts = [
        f"w_adj as materialized (select src, dst, weight from {edges} union all select dst, src, weight from {edges} where src <> dst)",
        "w_out as materialized (select src as id, sum(weight) as o from w_adj group by 1)",
        "w_n as materialized (select count(*) as n from w_out)",
        "w0 as materialized (select id, 1.0 / n as r from w_out, w_n)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"w{i} as materialized (select dst as id, 0.15 / any_value(n) + 0.85 * sum(r * weight / o) as r "
            f"from w_adj join w{i - 1} p on p.id = src join w_out u on u.id = src, w_n group by 1)"
        )
    return ", ".join(parts)


_METRICS = """metrics as materialized (select id, sum(weight) as w_degree, count(*) as degree from
(select src as id, weight from edges union all select dst, weight from edges) group by 1)"""


def _communities_sql(edges: str) -> str:
    return f"""{lpa_sql(edges, 10)}, {pagerank_sql(edges, 20)}, {_METRICS.replace('from edges', f'from {edges}')},
communities as materialized (select id as client_id, label as community_id, influence_score,
  count(*) over (partition by label) as community_size, w_degree, degree
  from lp10 join pr using (id) join metrics using (id))"""


def communities(spark, sf, graph=final_edges):
    return marts.client_communities(graph(spark, sf))


# --- measures ---------------------------------------------------------------------------------


@query("degree", f"{views('edges')}, {_METRICS} select id, degree from metrics")
def q_degree(spark, sf):
    return dg.degrees(final_edges(spark, sf))


@query("weighted_degree", f"{views('edges')}, {_METRICS} select id, round(w_degree, 6) as w_degree from metrics")
def q_weighted_degree(spark, sf):
    return rounded(dg.weighted_degrees(final_edges(spark, sf)), 6, "w_degree")


@query("node_types", f"""{views('vertices')}
select case when starts_with(id, 'client_') then 'client' else 'community' end as node_type, count(*) as n from vertices group by 1""")
def q_node_types(spark, sf):
    return agg.group_counts(ed.vertices(final_edges(spark, sf)).select(node_type(F.col("id")).alias("node_type")), "node_type")


@query("lpa", f"{views('edges')}, {lpa_sql('edges', 10)} select id, label as community_id from lp10")
def q_lpa(spark, sf):
    return label_propagation(final_edges(spark, sf), 10)


_STABLE = 40


@query("lpa_stable", f"{views('links')}, {lpa_sql('links', _STABLE, own=True)} select id, label as community_id from lp{_STABLE}")
def q_lpa_stable(spark, sf):
    """Settles before the last of the rounds, else the operator raises; more rounds change nothing then."""
    return cq.named_labels(link_cliques(spark, sf), _STABLE, until_stable=True, self_vote=True)


@query("pagerank", f"{views('edges')}, {pagerank_sql('edges', 20)} select id, round(influence_score, 6) as influence_score from pr")
def q_pagerank(spark, sf):
    return rounded(pagerank(final_edges(spark, sf), 20), 6, "influence_score")


@query("pagerank_weighted", f"{views('links')}, {pagerank_weighted_sql('links', 12)} select id, round(r, 8) as influence_score from w12")
def q_pagerank_weighted(spark, sf):
    return rounded(_link_scores(link_cliques(spark, sf)), 8, "influence_score")


def _link_scores(graph):
    return graph.names.named(cq.pagerank_weighted(graph, rounds=12), "id")


_COMPONENTS = """adj as materialized (select src, dst from transfers union select dst, src from transfers),
reach(id, root) as (select distinct src, src from adj union select dst, root from reach join adj on id = src),
comp as materialized (select id, min(root) as component from reach group by 1)"""
_RECURSIVE = views("transfers").replace("with ", "with recursive ", 1)


@query("components", f"{_RECURSIVE}, {_COMPONENTS} select id, component from comp")
def q_components(spark, sf):
    return cc.connected_components(transfer_graph(spark, sf))


_LARGEST = """lcc as materialized (select id from comp where component =
  (select component from comp group by 1 order by count(*) desc, component limit 1))"""


@query("largest_component", f"{_RECURSIVE}, {_COMPONENTS}, {_LARGEST} select id from lcc")
def q_largest(spark, sf):
    return cc.largest_component(cc.connected_components(transfer_graph(spark, sf)))


_CLUSTERING = """g as materialized (select src, dst, weight / (select max(weight) from links) as w from links),
both_ways as materialized (select src, dst, w from g union all select dst, src, w from g),
deg as materialized (select src as id, count(*) as k from both_ways group by 1),
tri as (select a.src as id, sum(cbrt(a.w * b.w * c.w)) as s from both_ways a join both_ways b on a.src = b.src and a.dst < b.dst
  join both_ways c on c.src = a.dst and c.dst = b.dst group by 1),
coef as materialized (select deg.id, case when k > 1 then coalesce(2 * s / (k * (k - 1)), 0) else 0 end as clustering
  from deg left join tri on tri.id = deg.id)"""


@query("clustering", f"{views('links')}, {_CLUSTERING} select id, round(clustering, 6) as clustering from coef")
def q_clustering(spark, sf):
    graph = link_cliques(spark, sf)
    return rounded(graph.names.named(cq.clustering(graph), "id"), 6, "clustering")


@query("avg_clustering", f"{views('links')}, {_CLUSTERING} select round(avg(clustering), 6) as avg_clustering from coef")
def q_avg_clustering(spark, sf):
    return rounded(cq.clustering(link_cliques(spark, sf)).agg(F.avg("clustering").alias("avg_clustering")), 6, "avg_clustering")


@query("density", f"""{views('links')}, n as (select count(*) as n from (select src from links union select dst from links)),
m as (select count(*) as m from links)
select n as nodes, m as edges, round(2 * m / (n * (n - 1)), 9) as density, round(2 * m / n, 6) as avg_degree from n, m""")
def q_density(spark, sf):
    return rounded(rounded(cq.density(link_cliques(spark, sf)), 9, "density"), 6, "avg_degree")


def _hop_chain(levels: int) -> str:
    """All-pairs hop distances of the largest component, level by level."""
    parts = ["e as materialized (select src, dst from adj where src in (select id from lcc))",
             "h0 as materialized (select id as s, id, 0 as d from lcc)"]
    for i in range(1, levels + 1):
        parts.append(
            f"h{i} as materialized (select * from h{i - 1} union all (select distinct s, dst, {i} from h{i - 1} join e on src = id "
            f"where d = {i - 1} and (s, dst) not in (select (s, id) from h{i - 1})))"
        )
    return ", ".join(parts)


_LEVELS = 30


@query("diameter", f"{_RECURSIVE}, {_COMPONENTS}, {_LARGEST}, {_hop_chain(_LEVELS)} select max(d) as diameter, true as exact from h{_LEVELS}")
def q_diameter(spark, sf):
    graph = cut(transfer_graph(spark, sf), "graph")
    lcc = cut(cc.largest_component(cc.connected_components(graph)), "lcc")
    return paths.diameter(ed.induced(graph, lcc)).select("diameter", "exact")


# --- measures of the whole merged graph ---------------------------------------------------------------

_NODES = "nodes as materialized (select client_id as id from incidence union select src from sent union select dst from sent)"
_ENDS = """ends as materialized (select src, dst, weight from all_merged union all select dst, src, weight from all_merged where src <> dst)"""
_MERGED = f"{views('all_merged')}, {_NODES}, {_ENDS}"


def _merged(spark, sf):
    return classes.class_graph(tx_orders(spark, sf))


@query("merged_degrees", f"""{_MERGED} select id, count(src) as degree, round(coalesce(sum(weight), 0), 5) as w_degree
from nodes left join ends on src = id group by 1""")
def q_merged_degrees(spark, sf):
    return rounded(classes.merged_degrees(_merged(spark, sf)), 5, "w_degree")


@query("merged_density", f"""{_MERGED}, n as (select count(*) as n from nodes), m as (select count(*) as m from all_merged)
select n as nodes, m as edges, round(2 * m / (n * (n - 1)), 9) as density, round(2 * m / n, 6) as avg_degree from n, m""")
def q_merged_density(spark, sf):
    return rounded(rounded(classes.merged_density(_merged(spark, sf)), 9, "density"), 6, "avg_degree")


def _settled_pagerank_sql(rounds: int) -> str:
    """Rounds on ``ends`` until the summed change is below nodes * 1e-6; the first such round is the result."""
    parts = ["outs as materialized (select id, coalesce(sum(weight), 0) as o from nodes left join ends on src = id group by 1)",
             "many as materialized (select count(*) as n from nodes)",
             "r0 as materialized (select id, 1.0 / n as r, cast(null as double) as moved from nodes, many)"]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} as materialized (select p.id, (0.85 * (select coalesce(sum(q.r), 0) from r{i - 1} q join outs using (id) where o = 0) + 0.15) / n "
            f"+ 0.85 * coalesce(s, 0) as r, abs((0.85 * (select coalesce(sum(q.r), 0) from r{i - 1} q join outs using (id) where o = 0) + 0.15) / n "
            f"+ 0.85 * coalesce(s, 0) - p.r) as moved from r{i - 1} p left join (select dst as id, sum(q.r * weight / o) as s "
            f"from ends join r{i - 1} q on q.id = src join outs u on u.id = src group by 1) m on m.id = p.id, many)"
        )
    still = [f"(select sum(moved) from r{i}) >= (select n from many) * 1e-6" for i in range(1, rounds + 1)]
    picks = []
    for i in range(1, rounds + 1):
        before = " and ".join(["true", *still[:i - 1]])
        picks.append(f"select id, round(r, 9) as influence_score from r{i} where {before} and not ({still[i - 1]})")
    return ", ".join(parts) + " " + " union all ".join(picks)


@query("merged_pagerank", f"{_MERGED}, {_settled_pagerank_sql(12)}")
def q_merged_pagerank(spark, sf):
    return rounded(classes.merged_pagerank(_merged(spark, sf)), 9, "influence_score")


_LABEL_ROUNDS = ", ".join(
    ["m0 as materialized (select id, id as label from nodes)"]
    + [f"m{i} as materialized (select p.id, least(any_value(p.label), coalesce(min(q.label), any_value(p.label))) as label from m{i - 1} p "
       f"left join ends on dst = p.id left join m{i - 1} q on q.id = src group by 1)" for i in range(1, 9)]
)


@query("merged_components", f"{_MERGED}, {_LABEL_ROUNDS} select id, label as component from m8")
def q_merged_components(spark, sf):
    return classes.merged_components(_merged(spark, sf))


@query("merged_modularity", f"""{_MERGED}, lab as materialized (select id, any_value(region) as community_id from nodes join
  (select client_id as id, region from tx_orders where region is not null group by 1, 2) using (id) group by 1),
d as (select community_id, sum(case when src = dst then 2 * weight else weight end) as deg from ends join lab on lab.id = src group by 1),
i as (select a.community_id, sum(case when src = dst then 2 * weight else weight end) as twice from ends join lab a on a.id = src join lab b on b.id = dst
  where a.community_id = b.community_id group by 1),
t as (select sum(deg) as t from d)
select round(sum(coalesce(twice, 0) / t - (deg / t) ** 2), 6) as modularity from d left join i using (community_id), t""")
def q_merged_modularity(spark, sf):
    """How far the clients of a region keep to themselves. A client is in one region."""
    return rounded(classes.merged_modularity(_merged(spark, sf), _regions(spark, sf)), 6, "modularity")


def _regions(spark, sf):
    return tx_orders(spark, sf).filter("region is not null").groupBy(F.col("client_id").alias("id")).agg(F.min("region").alias("community_id"))


@query("merged_meta_graph", f"""{_MERGED}, lab as materialized (select client_id as id, min(region) as c from tx_orders where region is not null group by 1)
select a.c as src, b.c as dst, count(*) as edges, round(sum(weight), 4) as weight from ends join lab a on a.id = src join lab b on b.id = dst
where a.c < b.c group by 1, 2""")
def q_merged_meta(spark, sf):
    """The graph between regions."""
    return rounded(ct.merged_meta_graph(_merged(spark, sf), _regions(spark, sf)), 4, "weight")


# Each vertex as a vector of its neighbours' strengths: an edge closes as many triangles as the product of its ends' vectors.
_MERGED_CLUSTERING = f"""{_MERGED}, kept as materialized (select src, dst, cbrt(weight / (select max(weight) from ends where src <> dst)) as s from ends where src <> dst),
vectors as materialized (select a.id, list(coalesce(s, 0) order by b.id) as v from nodes a cross join nodes b left join kept on src = a.id and dst = b.id group by 1),
closed as (select src as id, sum(s * list_dot_product(a.v, b.v)) as s, count(*) as k from kept join vectors a on a.id = src join vectors b on b.id = dst group by 1),
coef as materialized (select id, case when k > 1 then s / (k * (k - 1)) else 0 end as clustering from nodes left join closed using (id))"""


@query("merged_clustering", f"{_MERGED_CLUSTERING} select id, round(clustering, 6) as clustering from coef")
def q_merged_clustering(spark, sf):
    return rounded(ct.merged_clustering(_merged(spark, sf)), 6, "clustering")


@query("merged_avg_clustering", f"{_MERGED_CLUSTERING} select round(avg(clustering), 6) as avg_clustering from coef")
def q_merged_avg_clustering(spark, sf):
    return rounded(ct.merged_average_clustering(_merged(spark, sf)), 6, "avg_clustering")


_SETTLED = 8


@query("merged_labels", f"""{_MERGED}, {lpa_sql('all_merged', _SETTLED, 'ml', own=True)}
select id, coalesce(label, id) as community_id from nodes left join ml{_SETTLED} using (id)""")
def q_merged_labels(spark, sf):
    """Settles before the last of the rounds, else the operator raises."""
    return classes.merged_labels(_merged(spark, sf), _SETTLED, self_vote=True)


def _far_chain(levels: int) -> str:
    """Pairs (s < t) of the largest component that are more than 1, 2, ... hops apart."""
    parts = [
        "big as materialized (select id from m8 where label = (select label from m8 group by 1 order by count(*) desc, label limit 1))",
        "near as materialized (select src, dst from ends where src <> dst)",
        "far1 as materialized (select a.id as s, b.id as t from big a join big b on a.id < b.id where not exists (select 1 from near where src = a.id and dst = b.id))",
    ]
    for k in range(2, levels + 1):
        last = f"(select s, t from far{k - 1} union all select t, s from far{k - 1})"
        parts.append(
            f"far{k} as materialized (select s, t from far{k - 1} except select f.s, f.t from far{k - 1} f join near on src = f.s "
            f"left join {last} g on g.s = dst and g.t = f.t where g.s is null)"
        )
    return ", ".join(parts)


_HOPS = 8


@query("merged_diameter", f"""{_MERGED}, {_LABEL_ROUNDS}, {_far_chain(_HOPS)}
select cast({' + '.join(f'(case when exists (select 1 from far{k}) then 1 else 0 end)' for k in range(1, _HOPS + 1))} + 1 as int) as diameter,
  true as exact, (select count(*) from big) as nodes""")
def q_merged_diameter(spark, sf):
    return classes.merged_diameter(_merged(spark, sf)).select("diameter", "exact", "nodes")


_LINK_LPA = f"{views('links')}, {lpa_sql('links', 10)}"


def _link_lpa(spark, sf):
    """The graph and its communities, by number."""
    graph = link_cliques(spark, sf)
    return graph, cq.labels(graph, 10)


def _link_sizes(spark, sf):
    graph, membership = _link_lpa(spark, sf)
    return graph.names.named(sg.community_sizes(membership), "community_id")


@query("modularity", f"""{_LINK_LPA}, m as (select sum(weight) as m from links),
d as (select label, sum(w) as deg from (select src as id, weight as w from links union all select dst, weight from links)
  join lp10 using (id) group by 1),
i as (select a.label, sum(weight) as s from links join lp10 a on a.id = src join lp10 b on b.id = dst
  where a.label = b.label group by 1)
select round(sum(coalesce(s, 0) / m - (deg / (2 * m)) ** 2), 6) as modularity from d left join i using (label), m""")
def q_modularity(spark, sf):
    return rounded(cq.modularity(*_link_lpa(spark, sf)), 6, "modularity")


@query("meta_graph", f"""{_LINK_LPA}
select least(a.label, b.label) as src, greatest(a.label, b.label) as dst, round(sum(weight), 6) as weight
from links join lp10 a on a.id = src join lp10 b on b.id = dst where a.label <> b.label group by 1, 2""")
def q_meta(spark, sf):
    graph, membership = _link_lpa(spark, sf)
    return rounded(graph.names.named(cq.meta_graph(graph, membership), "src", "dst"), 6, "weight")


@query("louvain")
def q_louvain(spark, sf):
    return louvain(link_graph(spark, sf))


@query("betweenness")
def q_betweenness(spark, sf):
    return paths.betweenness(cut(link_graph(spark, sf), "graph"))


@query("sampled_subgraph", f"""{views('links')}, v as (select src as id from links union select dst from links),
drawn as materialized (select id from v order by sha256(id || ':42'), id limit 700),
near as materialized (select id from drawn union select dst from links where src in (select id from drawn)
  union select src from links where dst in (select id from drawn))
select src, dst, weight from links where src in (select id from near) and dst in (select id from near)""")
def q_sampled(spark, sf):
    graph = link_cliques(spark, sf)
    return cq.links(graph, cut(cq.sampled_nodes(graph), "sampled")).select("src", "dst", "weight")


# --- communities and subgraphs -------------------------------------------------------------------

_C = f"{views('edges')}, {_communities_sql('edges')}"


@query("communities", f"""{_C} select client_id, community_id, round(influence_score, 6) as influence_score, community_size,
round(w_degree, 6) as w_degree, degree from communities""")
def q_communities(spark, sf):
    return rounded(communities(spark, sf), 6, "influence_score", "w_degree")


def _lpa(spark, sf, graph=final_edges):
    edges = graph(spark, sf)
    if isinstance(edges, cq.CliqueGraph):
        return edges, cq.named_labels(edges, 10)
    edges = cut(edges.select("src", "dst", "weight"), "graph")
    return edges, label_propagation(edges, 10)


_L = f"{views('edges')}, {lpa_sql('edges', 10)}"


@query("community_sizes", f"{_L} select label as community_id, count(*) as community_size from lp10 group by 1")
def q_sizes(spark, sf):
    return sg.community_sizes(_lpa(spark, sf)[1])


_TOP = "top as materialized (select label from lp10 group by 1 order by count(*) desc, label limit 100)"


@query("top_communities_subgraph", f"""{_L}, {_TOP}, t as materialized (select id from lp10 where label in (select label from top))
select src, dst, round(weight, 6) as weight from edges where src in (select id from t) and dst in (select id from t)""")
def q_top_subgraph(spark, sf):
    edges, membership = _lpa(spark, sf)
    return rounded(ed.induced(edges, sg.members_of_top_communities(membership, 100).select("id")), 6, "weight")


@query("top_influencers", f"""{views('edges')}, {pagerank_sql('edges', 20)}
select id, round(influence_score, 6) as influence_score from pr order by round(influence_score, 9) desc, id limit 100""")
def q_top_influencers(spark, sf):
    scores = pagerank(final_edges(spark, sf), 20).withColumn("influence_score", F.round("influence_score", 9))
    return rounded(sg.top_nodes(scores, 100), 6, "influence_score")


@query("top_nodes_subgraph", f"""{views('links')}, {pagerank_weighted_sql('links', 12)},
t as materialized (select id from w12 order by round(r, 10) desc, id limit 100)
select src, dst, weight from links where src in (select id from t) and dst in (select id from t)""")
def q_top_nodes(spark, sf):
    graph = link_cliques(spark, sf)
    scores = _link_scores(graph).withColumn("influence_score", F.round("influence_score", 10))
    return cq.links(graph, cut(sg.top_nodes(scores, 100).select("id"), "top")).select("src", "dst", "weight")


@query("node_display_sizes", f"""{views('links')}, {pagerank_weighted_sql('links', 12)},
t as (select id, r from w12 order by round(r, 10) desc, id limit 100), s as (select min(r) as a, max(r) as b from t)
select id, round(100 + (r - a) / (b - a) * 4900, 2) as size from t, s""")
def q_display(spark, sf):
    scores = _link_scores(link_cliques(spark, sf))
    top = sg.top_nodes(scores.withColumn("r", F.round("influence_score", 10)), 100, "r")
    return rounded(agg.min_max_scale(top, "influence_score", 100, 5000, "size").select("id", "size"), 2, "size")


@query("graph_stats", f"""{_L}, {_METRICS}, {_TOP},
sizes as (select label, count(*) as n from lp10 group by 1),
t as materialized (select id, label from lp10 where label in (select label from top))
select (select count(*) from lp10) as total_nodes, (select count(*) from edges) as total_edges,
 (select count(*) from t) as filtered_nodes,
 (select count(*) from edges where src in (select id from t) and dst in (select id from t)) as filtered_edges,
 (select count(*) from sizes) as communities, (select count(*) from top) as exported_communities,
 (select string_agg(label || '=' || n, ';' order by label) from sizes where label in (select label from top)) as distribution,
 (select max(n) from sizes) as largest_community_size, (select min(n) from sizes) as smallest_community_size,
 (select round(avg(n), 6) from sizes) as avg_community_size, (select round(avg(degree), 6) from metrics) as avg_degree,
 (select max(degree) from metrics) as max_degree, (select round(avg(w_degree), 6) from metrics) as avg_weighted_degree""")
def q_stats(spark, sf):
    edges, membership = _lpa(spark, sf)
    table = membership.join(dg.vertex_metrics(edges), "id")
    stats = rounded(reports.graph_statistics(table, edges), 6, "avg_community_size", "avg_degree", "avg_weighted_degree")
    entries = F.array_sort(F.map_entries("community_distribution"))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return stats.withColumn("distribution", text).drop("community_distribution")


@query("community_sizes_links", f"{_LINK_LPA} select label as community_id, count(*) as community_size from lp10 group by 1")
def q_sizes_links(spark, sf):
    """The same report on the sparser graph, which has many communities."""
    return _link_sizes(spark, sf)


_TOP_LINKS = _TOP.replace("limit 100", "limit 20")


@query("top_communities_links", f"""{_LINK_LPA}, {_TOP_LINKS}, t as materialized (select id from lp10 where label in (select label from top))
select src, dst, weight from links where src in (select id from t) and dst in (select id from t)""")
def q_top_links(spark, sf):
    graph, membership = _link_lpa(spark, sf)
    top = graph.names.named(sg.members_of_top_communities(membership, 20).select("id"), "id")
    return cq.links(graph, cut(top, "top")).select("src", "dst", "weight")


@query("describe_sizes_links", f"""{_LINK_LPA}, s as (select count(*) as n from lp10 group by label)
select count(*) as count, round(avg(n), 6) as mean, round(stddev_samp(n), 6) as std, min(n) as min,
round(quantile_cont(n, 0.25), 4) as q25, round(quantile_cont(n, 0.5), 4) as q50, round(quantile_cont(n, 0.75), 4) as q75,
max(n) as max from s""")
def q_describe_links(spark, sf):
    df = agg.describe(sg.community_sizes(_link_lpa(spark, sf)[1]), "community_size")
    return rounded(rounded(df, 6, "mean", "std"), 4, "q25", "q50", "q75")


@query("describe_sizes", f"""{_L}, s as (select count(*) as n from lp10 group by label)
select count(*) as count, round(avg(n), 6) as mean, round(stddev_samp(n), 6) as std, min(n) as min,
round(quantile_cont(n, 0.25), 4) as q25, round(quantile_cont(n, 0.5), 4) as q50, round(quantile_cont(n, 0.75), 4) as q75,
max(n) as max from s""")
def q_describe(spark, sf):
    df = agg.describe(sg.community_sizes(_lpa(spark, sf)[1]), "community_size")
    return rounded(rounded(df, 6, "mean", "std"), 4, "q25", "q50", "q75")


@query("largest_share", f"{_L} select round(max(n) / sum(n), 6) as largest_share from (select count(*) as n from lp10 group by label)")
def q_largest_share(spark, sf):
    return rounded(agg.largest_share(sg.community_sizes(_lpa(spark, sf)[1]), "community_size"), 6, "largest_share")


@query("degree_histogram", f"""{views('edges')}, {_METRICS},
v as (select ln(1 + round(w_degree, 6)) as x from metrics), s as (select min(x) as a, (max(x) - min(x)) / 30 as w from v),
c as (select least(cast(floor(round((x - a) / w, 9)) as bigint), 29) as bin, count(*) as n from v, s group by 1)
select r.range as bin, coalesce(n, 0) as n from range(30) r left join c on c.bin = r.range""")
def q_degree_histogram(spark, sf):
    deg = dg.weighted_degrees(final_edges(spark, sf))
    return agg.histogram(deg, F.log1p(F.round("w_degree", 6)), 30).select("bin", "n")


# --- marts and reports -----------------------------------------------------------------------------

_FACT_COLUMNS = "transaction_id, client_id, amount, currency, merchant, transaction_type, ip_network"
_CATEGORY = """case when transaction_type = 'p2p' then 'p2p' when merchant in ('Amazon', 'Ozon') then 'retail'
when merchant = 'Uber' then 'travel' else 'other' end"""
_FACT = f"""fact as materialized (select {_FACT_COLUMNS}, {_CATEGORY} as category, community_id, influence_score, community_size, w_degree
from masked left join communities using (client_id))"""


def _fact_inputs(spark, sf, graph=final_edges):
    return fill_categories(masked_orders(spark, sf)), cut(communities(spark, sf, graph), "communities")


@query("graph_fact", f"""{_C}, {_FACT} select * replace (round(influence_score, 6) as influence_score, round(w_degree, 6) as w_degree),
'2024-05-01 00:00:00' as created_at from fact""")
def q_fact(spark, sf):
    df = marts.graph_fact(None, *_fact_inputs(spark, sf), F.lit("2024-05-01").cast("timestamp"))
    return rounded(df.drop("datetime"), 6, "influence_score", "w_degree").withColumn("created_at", second_text(F.col("created_at")))


@query("upsert_fact", f"""{_C}, {_FACT}
select transaction_id, case when cast(substr(transaction_id, 2) as bigint) % 2 = 0 then 'old' else category end as category,
amount, community_id, community_size, round(influence_score, 6) as influence_score, round(w_degree, 6) as w_degree,
'2024-05-02 00:00:00' as created_at from fact""")
def q_upsert(spark, sf):
    """Half of the fact exists with another category and stale features; both halves are merged."""
    tx, table = _fact_inputs(spark, sf)
    stale = marts.enriched(tx, table).filter(F.substring("transaction_id", 2, 20).cast("long") % 2 == 0).withColumns(
        {"category": F.lit("old"), "community_id": F.lit("stale"), "influence_score": F.lit(0.0),
         "community_size": F.lit(0).cast("long"), "w_degree": F.lit(0.0), "created_at": F.lit("2024-05-01").cast("timestamp")}
    )
    df = marts.graph_fact(cut(stale, "fact"), tx, table, F.lit("2024-05-02").cast("timestamp"))
    return rounded(df, 6, "influence_score", "w_degree").select(
        "transaction_id", "category", "amount", "community_id", "community_size", "influence_score", "w_degree",
        second_text(F.col("created_at")).alias("created_at"),
    )


_LABELLED = f"{_L}, labelled as materialized (select t.*, label as community_id from masked t join lp10 on id = client_id)"


def _labelled(spark, sf, graph=final_edges):
    membership = _lpa(spark, sf, graph)[1]
    return masked_orders(spark, sf).join(membership.withColumnRenamed("id", "client_id"), "client_id")


@query("community_amounts", f"""{_LABELLED}
select community_id, round(sum(amount) * 100) / (count(*) * 100.0) as mean, round(median(amount), 4) as median,
min(amount) as min, max(amount) as max, count(*) as count from labelled group by 1""")
def q_amounts(spark, sf, graph=final_edges):
    df = agg.group_statistics(_labelled(spark, sf, graph), "community_id", "amount")
    return rounded(df.withColumn("mean", exact_mean(F.col("mean"), F.col("count"))), 4, "median")


@query("type_mix", f"""{_LABELLED}
select community_id, round(count(*) filter (where transaction_type = 'deposit') / count(*), 6) as deposit,
round(count(*) filter (where transaction_type = 'p2p') / count(*), 6) as p2p,
round(count(*) filter (where transaction_type = 'withdrawal') / count(*), 6) as withdrawal from labelled group by 1""")
def q_mix(spark, sf, graph=final_edges):
    kinds = ["deposit", "p2p", "withdrawal"]
    return rounded(agg.mix(_labelled(spark, sf, graph), "community_id", "transaction_type", kinds), 6, *kinds)


@query("dominant_type", f"""{_LABELLED}
select community_id, transaction_type as dominant from (select community_id, transaction_type, count(*) as n from labelled group by 1, 2)
qualify row_number() over (partition by community_id order by n desc, transaction_type) = 1""")
def q_dominant(spark, sf, graph=final_edges):
    return agg.dominant(_labelled(spark, sf, graph), "community_id", "transaction_type")


@query("top_merchants", f"""{_LABELLED}
select community_id, merchant, n, cast(rn as integer) as rank from (select *, row_number() over (partition by community_id order by n desc, merchant) as rn
from (select community_id, merchant, count(*) as n from labelled where merchant is not null group by 1, 2)) where rn <= 3""")
def q_community_merchants(spark, sf, graph=final_edges):
    counts = agg.group_counts(_labelled(spark, sf, graph).filter(F.col("merchant").isNotNull()), "community_id", "merchant")
    return agg.top_per_group(counts, "community_id", "n", "merchant", 3)


@query("leaders", f"""{_C}
select community_id, client_id, cast(rn as integer) as rank from (select *, row_number() over (partition by community_id
order by round(influence_score, 9) desc, client_id) as rn from communities) where rn <= 3""")
def q_leaders(spark, sf, graph=final_edges):
    table = communities(spark, sf, graph).withColumn("influence_score", F.round("influence_score", 9))
    return agg.top_per_group(table, "community_id", "influence_score", "client_id", 3).select("community_id", "client_id", "rank")


@query("recommendations", f"""{_C},
labelled as materialized (select t.*, community_id from masked t join communities using (client_id)),
kinds as (select community_id, transaction_type from (select community_id, transaction_type, count(*) as n from labelled group by 1, 2)
  qualify row_number() over (partition by community_id order by n desc, transaction_type) = 1),
shops as (select community_id, merchant from (select community_id, merchant, count(*) as n from labelled where merchant is not null group by 1, 2)
  qualify row_number() over (partition by community_id order by n desc, merchant) = 1),
means as (select community_id, floor(round(sum(amount) * 100) / count(*) + 0.5 + 1e-7) / 100 as m from labelled group by 1),
heads as (select community_id, client_id from communities qualify row_number() over (partition by community_id
  order by round(influence_score, 9) desc, client_id) = 1),
sizes as (select community_id, count(*) as size from communities group by 1)
select community_id, size, transaction_type as dominant_tx_type, h.client_id as leader, merchant as top_merchant,
'Сообщество #' || community_id || ': ' || size || ' клиентов, средняя транзакция $' || printf('%.2f', coalesce(m, 0)) || ', тип: '
|| coalesce(transaction_type, 'unknown') || chr(10) || case transaction_type
when 'p2p' then 'Рекомендация: Запустить социальные фичи для группы. Лидер: ' || h.client_id || chr(10)
  || 'Предложить: групповые переводы, совместные цели накопления.'
when 'deposit' then 'Рекомендация: Предложить инвестиционные продукты. Лидер: ' || h.client_id || chr(10)
  || 'Предложить: накопительные счета, инвестиции с защитой капитала.'
when 'withdrawal' then 'Рекомендация: Улучшить удержание средств. Лидер: ' || h.client_id || chr(10)
  || 'Предложить: кэшбэк в популярных магазинах (' || coalesce(merchant, 'N/A') || '), программы лояльности.'
else 'Рекомендация: Провести дополнительный анализ. Лидер: ' || h.client_id || chr(10)
  || 'Предложить: базовые программы лояльности.' end as recommendation
from sizes left join kinds using (community_id) left join shops using (community_id) left join means using (community_id)
left join heads h using (community_id)""")
def q_recommendations(spark, sf, graph=final_edges):
    tx, table = masked_orders(spark, sf), cut(communities(spark, sf, graph), "communities")
    table = table.withColumn("influence_score", F.round("influence_score", 9))
    return reports.recommendations(table, tx).drop("avg_amount")


@query("community_tx_count", f"""{_C}, {_FACT}
select community_id, count(*) as tx_count from fact group by 1 order by tx_count desc, community_id nulls last limit 10000""")
def q_tx_count(spark, sf, graph=final_edges):
    return agg.transactions_per_community(marts.graph_fact(None, *_fact_inputs(spark, sf, graph)), 10_000)


# --- the same reports on the graph of many communities ----------------------------------------------

_ON_LINKS = {
    _C: f"{views('links', 'masked')}, {_communities_sql('links')}",
    _L: f"{views('links', 'masked')}, {lpa_sql('links', 10)}",
}
REPORTS = {
    "community_amounts": q_amounts, "type_mix": q_mix, "dominant_type": q_dominant, "top_merchants": q_community_merchants,
    "leaders": q_leaders, "recommendations": q_recommendations, "community_tx_count": q_tx_count,
}


def _register_on_links(name, report):
    head = next(h for h in _ON_LINKS if ORACLES[name].startswith(h))
    query(f"{name}_links", _ON_LINKS[head] + ORACLES[name][len(head):])(lambda spark, sf: report(spark, sf, link_cliques))


for _name, _report in REPORTS.items():
    _register_on_links(_name, _report)
