import random

import pytest
import reference as ref
from pyspark.sql import functions as F

from ledgerloom.graph import adjacency as adj_mod
from ledgerloom.graph import clustering, components, degrees, ids, lpa, modularity, paths, subgraph
from ledgerloom.graph.adjacency import adjacency, send
from ledgerloom.graph.louvain import louvain
from ledgerloom.graph.lpa import label_propagation
from ledgerloom.graph.pagerank import pagerank, pagerank_weighted

PATH = [("a", "b", 1.0), ("b", "c", 1.0), ("c", "d", 1.0)]
TRIANGLES = [("a", "b", 1.0), ("b", "c", 2.0), ("a", "c", 3.0), ("c", "d", 0.5), ("d", "e", 1.0), ("e", "f", 1.0), ("d", "f", 1.0)]
STAR = [("hub", f"s{i}", 1.0) for i in range(6)]


def random_graph(n, m, seed):
    rng = random.Random(seed)
    pairs = set()
    while len(pairs) < m:
        a, b = rng.sample(range(n), 2)
        pairs.add((f"v{min(a, b):02d}", f"v{max(a, b):02d}"))
    return [(a, b, rng.choice([0.5, 1.0, 2.0])) for a, b in sorted(pairs)]


GRAPHS = {"path": PATH, "triangles": TRIANGLES, "star": STAR, "random": random_graph(25, 60, 3), "sparse": random_graph(40, 35, 5)}


def frame(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string, weight double")


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


@pytest.mark.parametrize("name", ["triangles", "star", "random"])
def test_label_propagation(spark, name):
    got = as_dict(label_propagation(frame(spark, GRAPHS[name]), 5))
    assert got == ref.label_propagation(GRAPHS[name], 5)


def test_label_propagation_counts_parallel_edges(spark):
    edges = [("a", "b", 1.0), ("b", "a", 1.0), ("b", "c", 1.0)]
    assert as_dict(label_propagation(frame(spark, edges), 1)) == ref.label_propagation(edges, 1)


def test_label_propagation_stable_and_isolated(spark):
    vertices = spark.createDataFrame([(v,) for v in ["hub", "s0", "s1", "s2", "s3", "s4", "s5", "alone"]], "id string")
    got = as_dict(label_propagation(frame(spark, STAR), 20, vertices=vertices, until_stable=True, self_vote=True))
    assert got["alone"] == "alone"
    assert len({got[v] for v in got if v != "alone"}) == 1


@pytest.mark.parametrize("name", ["path", "random"])
def test_pagerank(spark, name):
    got = as_dict(pagerank(frame(spark, GRAPHS[name]), 20))
    want = ref.pagerank(GRAPHS[name], 20)
    assert got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert abs(sum(got.values()) - len(got)) < 1e-9


def test_pagerank_weighted_with_isolated_vertices(spark):
    edges = GRAPHS["random"]
    nodes = sorted(ref.neighbours(edges)) + ["x1", "x2"]
    got = as_dict(pagerank_weighted(frame(spark, edges), vertices=spark.createDataFrame([(v,) for v in nodes], "id string")))
    want = ref.pagerank_weighted(edges, ["x1", "x2"])
    assert got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert abs(sum(got.values()) - 1) < 1e-6


@pytest.mark.parametrize("name", ["path", "sparse"])
def test_components(spark, name):
    got = components.connected_components(frame(spark, GRAPHS[name]))
    assert as_dict(got) == ref.components(GRAPHS[name])


def test_components_of_a_long_chain_and_isolated(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}", 1.0) for i in range(120)]
    random.Random(1).shuffle(chain)
    nodes = spark.createDataFrame([("zz",)] + [(f"n{i:03d}",) for i in range(121)], "id string")
    got = as_dict(components.connected_components(frame(spark, chain), vertices=nodes))
    assert got.pop("zz") == "zz" and set(got.values()) == {"n000"}


def test_hot_vertices_are_sliced_without_changing_results(spark):
    edges = frame(spark, STAR + GRAPHS["random"])
    plain, sliced = adjacency(edges), adjacency(edges, links_per_slice=2)
    assert plain.hot is None and sliced.hot.count() > 1
    assert sliced.links.filter("src = 'hub'").select("slice").distinct().count() > 1
    state = plain.links.select(F.col("src").alias("id")).distinct().withColumn("x", F.length("id"))
    rows = [sorted(map(tuple, send(a, state).select("src", "dst", "x", "weight", "n").collect())) for a in (plain, sliced)]
    assert rows[0] == rows[1]


def test_numbers_follow_the_names(spark, monkeypatch):
    edges = frame(spark, GRAPHS["random"])
    want = {v: i for i, v in enumerate(sorted(ref.neighbours(GRAPHS["random"])))}
    assert {r.name: r.id for r in ids.number_vertices(edges).names.collect()} == want
    # The same numbers from several ranges.
    monkeypatch.setattr(ids, "ROWS_PER_PARTITION", 10)
    monkeypatch.setattr(ids, "partitions_for", lambda n: 4)
    assert {r.name: r.id for r in ids.number_vertices(edges).names.collect()} == want


def test_votes_that_do_not_fit_one_number(spark, monkeypatch):
    edges = GRAPHS["random"]
    original = lpa._round
    monkeypatch.setattr(lpa, "_round", lambda adj, labels, own, packed: original(adj, labels, own, None))
    assert as_dict(label_propagation(frame(spark, edges), 4)) == ref.label_propagation(edges, 4)


def test_links_of_a_round_are_dealt_to_many_tasks(spark):
    """A million links, both ways counted, were one task of every round."""
    edges = spark.range(500_000).select(F.col("id").alias("src"), (F.col("id") + 500_000).alias("dst"), F.lit(1.0).alias("weight"))
    adj = adjacency(edges)
    assert adj.links.rdd.getNumPartitions() >= 4 and adj.links.count() == 1_000_000
    adj.release()


def test_algorithms_on_sliced_adjacency(spark, monkeypatch):
    edges = STAR + [("s0", "s1", 1.0), ("s4", "s5", 2.0)]
    original = adj_mod.adjacency
    for module in ("lpa", "pagerank", "components", "paths", "louvain"):
        target = __import__(f"ledgerloom.graph.{module}", fromlist=["adjacency"])
        monkeypatch.setattr(target, "adjacency", lambda *a, **k: original(*a, **k, links_per_slice=2))
    assert as_dict(label_propagation(frame(spark, edges), 4)) == ref.label_propagation(edges, 4)
    want = ref.pagerank(edges, 10)
    got = as_dict(pagerank(frame(spark, edges), 10))
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert as_dict(components.connected_components(frame(spark, edges))) == ref.components(edges)


def test_clustering(spark):
    for edges in (TRIANGLES, GRAPHS["random"]):
        got, want = as_dict(clustering.clustering(frame(spark, edges))), ref.clustering(edges)
        assert got.keys() == want.keys()
        assert all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert as_dict(clustering.clustering(frame(spark, STAR)))["hub"] == 0.0


def test_self_loops_do_not_make_triangles(spark):
    edges = TRIANGLES + [("a", "a", 9.0)]
    assert as_dict(clustering.clustering(frame(spark, edges)))["a"] == pytest.approx(ref.clustering(TRIANGLES)["a"])


def test_modularity_and_meta_graph(spark):
    edges = GRAPHS["random"]
    label = {v: f"c{int(v[1:]) % 3}" for v in ref.neighbours(edges)}
    membership = spark.createDataFrame(list(label.items()), "id string, community_id string")
    got = modularity.modularity(frame(spark, edges), membership).first()[0]
    assert got == pytest.approx(ref.modularity(edges, label))
    assert -0.5 <= got <= 1
    meta = {(r.src, r.dst): r.weight for r in modularity.meta_graph(frame(spark, edges), membership).collect()}
    assert all(a < b for a, b in meta)
    assert sum(meta.values()) == sum(w for a, b, w in edges if label[a] != label[b])


def test_louvain_separates_two_triangles(spark):
    got = as_dict(louvain(frame(spark, TRIANGLES)))
    assert got["a"] == got["b"] == got["c"] != got["d"] == got["e"] == got["f"]


def test_louvain_is_no_worse_than_label_propagation(spark):
    edges = GRAPHS["random"]
    best = ref.modularity(edges, as_dict(louvain(frame(spark, edges))))
    assert best >= ref.modularity(edges, ref.label_propagation(edges, 20)) - 1e-9
    assert best > 0.2


def test_louvain_keeps_disconnected_pairs_apart(spark):
    edges = [("a", "b", 1.0), ("c", "d", 1.0)]
    got = as_dict(louvain(frame(spark, edges)))
    assert got["a"] == got["b"] != got["c"] == got["d"]


@pytest.mark.parametrize("name", ["path", "triangles", "random"])
def test_diameter(spark, name):
    edges = GRAPHS[name]
    adj = ref.neighbours(edges)
    row = paths.diameter(frame(spark, edges), batch=3).first()
    assert row.diameter == max(max(ref.hops(adj, v).values()) for v in adj) and row.exact


def test_searches_that_do_not_settle_raise(spark):
    swing = frame(spark, [("a", "b", 1.0)])
    with pytest.raises(RuntimeError, match="did not settle"):
        label_propagation(swing, 5, until_stable=True)
    with pytest.raises(RuntimeError, match="did not settle"):
        pagerank_weighted(frame(spark, GRAPHS["random"]), tol=0.0, max_rounds=3)


def test_hop_distances(spark):
    edges = GRAPHS["random"]
    sources = spark.createDataFrame([("v01",), ("v07",)], "id string")
    got = {(r.source, r.id): r.dist for r in paths.hop_distances(frame(spark, edges), sources=sources).collect()}
    adj = ref.neighbours(edges)
    assert got == {(s, v): d for s in ("v01", "v07") for v, d in ref.hops(adj, s).items()}


@pytest.mark.parametrize("name", ["path", "triangles", "random"])
def test_betweenness(spark, name):
    edges = GRAPHS[name]
    nodes = sorted(ref.neighbours(edges))
    got = as_dict(paths.betweenness(frame(spark, edges), k=500))
    want = ref.betweenness(edges, nodes)
    assert got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_betweenness_from_chosen_sources(spark):
    edges = GRAPHS["random"]
    sources = ["v03", "v11", "v20"]
    got = as_dict(paths.betweenness(frame(spark, edges), sources=spark.createDataFrame([(s,) for s in sources], "id string")))
    want = ref.betweenness(edges, sources)
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_the_betweenness_query_takes_500_sources(spark, monkeypatch):
    from ledgerloom.catalog import graphs

    edges = GRAPHS["random"]
    monkeypatch.setattr(graphs, "link_graph", lambda s, sf: frame(s, edges))
    got = as_dict(graphs.q_betweenness(spark, None))
    want = ref.betweenness(edges, sorted(ref.neighbours(edges)))
    assert len(want) > 16 and got.keys() == want.keys()
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_betweenness_in_batches(spark):
    edges = GRAPHS["random"]
    got = as_dict(paths.betweenness(frame(spark, edges), rows=10 * 12))
    want = ref.betweenness(edges, sorted(ref.neighbours(edges)))
    assert all(abs(got[v] - want[v]) < 1e-9 for v in want)


def test_degrees_and_density(spark):
    edges = TRIANGLES + [("a", "a", 1.0), ("b", "a", 1.0)]
    got = as_dict(degrees.degrees(frame(spark, edges)))
    assert sum(got.values()) == 2 * len(edges) and got["a"] == 5
    assert as_dict(degrees.weighted_degrees(frame(spark, PATH)))["b"] == 2.0
    row = degrees.density(frame(spark, PATH)).first()
    assert (row.nodes, row.edges, row.density, row.avg_degree) == (4, 3, 0.5, 1.5)
    single = degrees.density(frame(spark, []), spark.createDataFrame([("x",)], "id string")).first()
    assert single.density == 0.0


def test_subgraphs(spark):
    table = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("d", "3")], "id string, community_id string")
    assert [r.community_id for r in subgraph.top_communities(table, 2).collect()] == ["1", "2"]
    assert {r.id for r in subgraph.members_of_top_communities(table, 2).collect()} == {"a", "b", "c"}
    edges = frame(spark, GRAPHS["random"])
    one = sorted(map(tuple, subgraph.sampled_subgraph(edges, 2, seed=7).collect()))
    assert one == sorted(map(tuple, subgraph.sampled_subgraph(edges, 2, seed=7).collect()))
    assert subgraph.random_neighbourhood(edges, 2).count() >= 2


def merged_transactions(spark):
    """Few clients with shared hubs of every kind, transfers to oneself and to strangers, and one client alone."""
    from datetime import datetime

    rnd = random.Random(5)
    rows = []
    for i in range(90):
        c = f"client_{rnd.randrange(24)}"
        rows.append((f"t{i}", c, datetime(2024, 1, 1, rnd.randrange(24)), float(rnd.randint(1, 50)), rnd.choice(["Amazon", "Ozon", f"m{i % 9}", None]),
                     rnd.choice(["p2p", "deposit", "withdrawal"]), f"s{i % 30}", None, f"10.0.0.{i % 40}", rnd.choice(["N", "S"]), rnd.choice(["ios", "web", None]),
                     rnd.choice([c, f"client_{rnd.randrange(30)}", "elsewhere"]), None))
    rows.append(("lone", "client_z", datetime(2023, 1, 1), 1.0, "only here", "deposit", "alone", None, "1.1.1.1", None, "own", None, None))
    return spark.createDataFrame(rows, "transaction_id string, client_id string, datetime timestamp, amount double, merchant string, transaction_type string, "
                               "session_id string, ip_network string, ip_address string, region string, device_type string, recipient_id string, recipient_id_hash string")


def test_merged_graph_in_classes_against_listed_pairs(spark):
    from ledgerloom.graph import classes
    from ledgerloom.operators import projection as pj
    from ledgerloom.operators.edges import induced

    tx = merged_transactions(spark)
    plain = {(r.src, r.dst): r for r in pj.merged_graph(tx).collect()}
    g = classes.class_graph(tx, large=5)
    assert {(r.src, r.dst): round(r.weight, 9) for r in classes.expanded(g).collect()} == {k: round(r.weight, 9) for k, r in plain.items()}
    made = classes.compressed_rows(g).collect()
    assert sum(r.n_pairs for r in made) == len(plain) and any(r.level == "class" for r in made)
    assert all((plain[r.src, r.dst].layer, plain[r.src, r.dst].p2p_count) == (r.layer, r.p2p_count) for r in made if r.level == "pair")
    nodes = {r.id for r in g.members.collect()}
    degree = {r.id: (r.degree, round(r.w_degree, 6)) for r in classes.merged_degrees(g).collect()}
    for v in nodes:
        own = [r.weight for k, r in plain.items() if v in k]
        assert degree[v] == (len(own), round(sum(own), 6))
    edges = spark.createDataFrame([(a, b, r.weight) for (a, b), r in plain.items()], "src string, dst string, weight double")
    vertices = spark.createDataFrame([(v,) for v in nodes], "id string")
    want = as_dict(pagerank_weighted(edges, vertices=vertices))
    got = as_dict(classes.merged_pagerank(g))
    assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)
    assert as_dict(classes.merged_components(g)) == as_dict(components.connected_components(edges, vertices=vertices))
    row = classes.merged_density(g).first()
    assert (row.nodes, row.edges) == (len(nodes), len(plain))
    community = spark.createDataFrame([(v, str(i % 3)) for i, v in enumerate(sorted(nodes))], "id string, community_id string")
    assert abs(classes.merged_modularity(g, community).first()[0] - modularity.modularity(edges, community).first()[0]) < 1e-9
    want = as_dict(label_propagation(edges, 30, until_stable=True, self_vote=True, vertices=vertices))
    for large in (5, 1000):
        assert as_dict(classes.merged_labels(classes.class_graph(tx, large=large), 30, self_vote=True)) == want
    assert not classes.merged_diameter(classes.class_graph(tx.limit(0))).first().diameter
    for large, cut_off in ((5, 1.0), (9, 1.5)):
        g = classes.class_graph(tx, large=large, min_weight=cut_off)
        listed = classes.expanded(g).filter("src <> dst")
        core = components.largest_component(components.connected_components(listed, vertices=vertices))
        assert classes.merged_diameter(g).first().diameter == paths.diameter(induced(listed, core)).first().diameter
    counts = classes.class_graph(tx, large=5, min_weight=0.0, transfers=False)
    shared = {(r.src, r.dst): r.weight for r in pj.project(pj.incidence(tx)).collect()}
    assert {(r.src, r.dst): r.weight for r in classes.expanded(counts).collect()} == pytest.approx(shared)
    assert classes.compressed_rows(classes.class_graph(tx.limit(0))).count() == 0


def test_merged_clustering_and_meta_graph_against_listed_pairs(spark):
    from ledgerloom.graph import class_triangles, classes

    tx = merged_transactions(spark)
    # No classes at all beyond 1,000.
    for large, cut_off in ((5, 1.0), (9, 1.5), (1000, 1.0)):
        other = classes.class_graph(tx, large=large, min_weight=cut_off)
        listed = classes.expanded(other).cache()
        nodes = sorted(r.id for r in other.members.collect())
        community = spark.createDataFrame([(v, str(i % 3)) for i, v in enumerate(nodes)], "id string, community_id string")
        want = {v: 0.0 for v in nodes} | as_dict(clustering.clustering(listed))
        got = as_dict(class_triangles.merged_clustering(other))
        assert got.keys() == want.keys() and all(abs(got[v] - want[v]) < 1e-9 for v in want)
        want = {(r.src, r.dst): r.weight for r in modularity.meta_graph(listed, community).collect()}
        assert {(r.src, r.dst): r.weight for r in class_triangles.merged_meta_graph(other, community).collect()} == pytest.approx(want)
    empty = classes.class_graph(tx.limit(0))
    assert class_triangles.merged_clustering(empty).count() == 0 and class_triangles.merged_meta_graph(empty, community).count() == 0


def test_merged_graph_adds_up_pairs_where_they_are_listed(spark, monkeypatch):
    """In many cells the same graph as in one, and no row per pair passes a shuffle."""
    from ledgerloom.graph import classes
    from ledgerloom.operators import projection as pj

    tx = merged_transactions(spark)
    plain = {(r.src, r.dst): (round(r.weight, 9), r.p2p_count) for r in pj.merged_graph(tx).collect()}
    monkeypatch.setattr(classes, "PRODUCTS_PER_CELL", 40)
    g = classes.class_graph(tx, large=5)
    assert {(r.src, r.dst): round(r.weight, 9) for r in classes.expanded(g).collect()} == {k: w for k, (w, _) in plain.items()}
    assert sum(r.n_pairs for r in classes.compressed_rows(g).collect()) == len(plain)
    assert all(plain[r.src, r.dst][1] == r.p2p_count for r in classes.compressed_rows(g).filter("level = 'pair'").collect())
    row = classes.merged_density(g).first()
    assert (row.nodes, row.edges) == (len(as_dict(classes.merged_degrees(g).select("id", "degree"))), len(plain))
    rows = spark.createDataFrame([(h, i) for h in range(6) for i in range(h, 40)], "hub long, id long")
    met = classes._listed_pairs(rows.selectExpr("hub", "id", "cast(null as long) as cls", "true as listed"))
    steps = [s.strip(" +-:") for s in met._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert steps[0].startswith(("Project", "FlatMapGroupsInArrow")) and not any(s.startswith(("Aggregate", "Join")) for s in steps[:2])
    assert {(r.src, r.dst): r.extra for r in met.collect()} == {(i, j): min(i, 5) + 1 for i in range(40) for j in range(i + 1, 40)}


def test_merged_diameter_searches_from_few_clients(spark):
    """Groups that large hubs link bound all distances, so clients with links of their own need no search of their own."""
    from datetime import datetime

    from ledgerloom.graph import classes
    from ledgerloom.operators.edges import induced

    rnd = random.Random(5)
    rows = []
    for i in range(900):
        c = f"client_{i % 220}"
        rows.append((f"t{i}", c, datetime(2024, 1, 1 + i % 28), 1.0, f"m{rnd.randrange(60)}", "deposit", f"s{rnd.randrange(60)}", None, f"10.0.0.{rnd.randrange(40)}",
                     rnd.choice(["N", "S"]) if i < 220 else None, rnd.choice(["ios", "web", "android", "tv"]), None, None))
    tx = spark.createDataFrame(rows, merged_transactions(spark).schema)
    for cut_off in (0.5, 1.0):  # an edge needs one hub, or two
        g = classes.class_graph(tx, large=40, min_weight=cut_off)
        listed = classes.expanded(g).filter("src <> dst")
        core = components.largest_component(components.connected_components(listed, vertices=g.members.select("id")))
        row = classes.merged_diameter(g).first()
        assert (row.diameter, row.nodes) == (paths.diameter(induced(listed, core)).first().diameter, core.count())
        assert row.sources <= 64 < row.nodes


@pytest.mark.parametrize("few, opposite, products, large, cut_off", [(0, 4096, 4_000_000, 5, 1.0), (0, 7, 50, 12, 1.5), (1e9, 3, 10, 1000, 1.0)])
def test_merged_measures_list_no_pairs_that_classes_imply(spark, monkeypatch, few, opposite, products, large, cut_off):
    """Sums leave their cells added up, and edges are listed only where a pair of classes is none: both as in the listed corrections."""
    from ledgerloom.graph import class_triangles, classes, meeting

    monkeypatch.setattr(meeting, "FEW", few)
    monkeypatch.setattr(meeting, "OPPOSITE", opposite)
    monkeypatch.setattr(meeting, "PRODUCTS_PER_CELL", products)
    tx = merged_transactions(spark).cache()
    # Amounts below 0 take weight off, down to edges that go.
    tx = tx.unionByName(tx.filter("transaction_type = 'p2p'").limit(6).withColumn("amount", F.lit(-0.99)).withColumn("recipient_id", F.lit("client_1")))
    g = classes.class_graph(tx, large=large, min_weight=cut_off)
    rows = g.whole()
    assert g.corrections is None
    if not few:
        monkeypatch.setattr(g.meeting, "listing", lambda: pytest.fail("corrections were listed"))
        g.meeting.written.clear()
    change = {(r.src, r.dst) for r in rows.corrections.collect() if (r.weight >= cut_off) != (r.base > 0)}
    assert {(r.src, r.dst): r.base > 0 for r in g.only_edges().corrections.collect()} == {
        (r.src, r.dst): r.base > 0 for r in rows.corrections.collect() if (r.src, r.dst) in change}
    assert classes.merged_density(g).collect() == classes.merged_density(rows).collect()
    want = {r.id: (r.degree, round(r.w_degree, 9)) for r in classes.merged_degrees(rows).collect()}
    assert {r.id: (r.degree, round(r.w_degree, 9)) for r in classes.merged_degrees(g).collect()} == want
    community = spark.createDataFrame([(v, str(i % 3)) for i, v in enumerate(sorted(want)) if i % 5], "id string, community_id string")
    got, listed = ({(r.src, r.dst): (r.edges, round(r.weight, 9)) for r in class_triangles.merged_meta_graph(x, community).collect()} for x in (g, rows))
    assert got == listed and len(got) == 3
    assert classes.merged_modularity(g, community).first()[0] == pytest.approx(classes.merged_modularity(rows, community).first()[0])
