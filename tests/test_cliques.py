"""The graph of cliques against the same graph with all its pairs listed."""

import random
from datetime import datetime

import pytest

from ledgerloom.graph import cliques, clustering, degrees, modularity
from ledgerloom.graph.lpa import label_propagation
from ledgerloom.graph.pagerank import pagerank, pagerank_weighted
from ledgerloom.operators import edges as ed


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def close(got, want):
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("many", [256, 1])
def test_measures_are_those_of_the_listed_pairs(spark, monkeypatch, many):
    monkeypatch.setattr(ed, "MANY_HUBS", many)
    monkeypatch.setattr(cliques, "MANY_HUBS", many)
    rnd = random.Random(3)
    rows = {(f"h{rnd.randrange(12)}", f"c{rnd.randrange(30):02d}") for _ in range(45)}
    rows |= {(h, f"d{i}") for i in range(4) for h in ("h1", "h2", "h3")}  # four clients alike
    members = {}
    for h, c in rows:
        members.setdefault(h, set()).add(c)
    pairs = {(a, b) for m in members.values() for a in m for b in m if a < b}
    others = {}
    for _ in range(25):
        p = tuple(sorted(rnd.sample([f"c{i:02d}" for i in range(36)], 2)))
        if p not in pairs:
            others[p] = rnd.choice([1.0, 10.0])
    hubs = spark.createDataFrame(sorted((c, h) for h, c in rows if len(members[h]) > 1), "client_id string, hub string")
    kinds = "src string, dst string, weight double"
    edges = spark.createDataFrame([(*p, 2.0) for p in sorted(pairs)] + [(*p, w) for p, w in others.items()], kinds).cache()
    g = cliques.clique_graph(hubs, spark.createDataFrame([(*p, w) for p, w in others.items()], kinds))
    named = g.names.named
    assert sorted(map(tuple, cliques.links(g).select("src", "dst", "weight").collect())) == sorted(map(tuple, edges.collect()))
    for rounds, stable in ((1, False), (10, False), (40, True)):
        want = as_dict(label_propagation(edges, rounds, until_stable=stable, self_vote=stable))
        assert as_dict(cliques.named_labels(g, rounds, stable, stable)) == want
    close(as_dict(named(cliques.pagerank(g, 20), "id")), as_dict(pagerank(edges, 20)))
    close(as_dict(named(cliques.pagerank_weighted(g, 12), "id")), as_dict(pagerank_weighted(edges, rounds=12)))
    close(as_dict(named(cliques.clustering(g), "id")), as_dict(clustering.clustering(edges)))
    assert cliques.density(g).collect() == degrees.density(edges).collect()
    found = label_propagation(edges, 2)
    by_number = g.names.number(found, "id", "community_id")
    assert abs(cliques.modularity(g, by_number).first()[0] - modularity.modularity(edges, found).first()[0]) < 1e-9
    meta = sorted(map(tuple, named(cliques.meta_graph(g, by_number), "src", "dst").collect()))
    assert meta == sorted(map(tuple, modularity.meta_graph(edges, found).collect()))
    got = {r.id: (r.w_degree, r.degree) for r in named(cliques.metrics(g), "id").collect()}
    assert got == {r.id: (r.w_degree, r.degree) for r in degrees.vertex_metrics(edges).collect()}
    some = found.filter("id < 'c18'").select("id")
    assert cliques.edge_count(g, some).first()[0] == ed.induced(edges, some).count() == cliques.links(g, some).count()


def test_a_crowd_is_measured_without_its_pairs(spark, monkeypatch):
    """2,000 clients at one place: two million pairs, none of which is listed."""
    def refuse(*_, **__):
        raise AssertionError("pairs were listed")

    at = datetime(2024, 1, 1)
    rows = [(f"t{i:04d}", f"c{i:04d}", at, 1.0, None, "withdrawal", "N", None) for i in range(2000)]
    rows.append(("p", "c0000", at, 1.0, None, "p2p", "N", "z"))
    tx = spark.createDataFrame(rows, "transaction_id string, client_id string, datetime timestamp, amount double, merchant string, transaction_type string, "
                                     "region string, recipient_id string")
    from ledgerloom.catalog import graphs

    monkeypatch.setattr(graphs, "tx_orders", lambda s, sf: tx)
    for name in ("_pairs_in_cells", "expand_pairs"):
        monkeypatch.setattr(ed, name, refuse)
    row = graphs.q_density(spark, None).first()
    assert (row.nodes, row.edges) == (2001, 2000 * 1999 // 2 + 1)
    assert {r.community_id for r in graphs.q_lpa_stable(spark, None).collect()} == {"c0000"}
    assert graphs.q_avg_clustering(spark, None).first()[0] > 0


@pytest.mark.parametrize("own", [False, True])
def test_votes_are_counted_for_labels_that_can_win(spark, monkeypatch, own):
    """F3, F9, F10, F11. Unlike clients of large hubs: labels are those of the listed pairs, and few votes of a class are written."""
    rnd = random.Random(5)
    rows = sorted({(f"c{i:04d}", f"h{rnd.randrange(60):02d}") for i in range(1500) for _ in range(3)})
    hubs = spark.createDataFrame(rows, "client_id string, hub string").cache()
    kinds = "src string, dst string, weight double"
    members = {}
    for c, h in rows:
        members.setdefault(h, set()).add(c)
    pairs = {(a, b) for m in members.values() for a in m for b in m if a < b}
    others = {p for p in (tuple(sorted(rnd.sample([f"c{i:04d}" for i in range(1500)], 2))) for _ in range(300)) if p not in pairs}
    g = cliques.clique_graph(hubs, spark.createDataFrame([(*p, 1.0) for p in sorted(others)], kinds))
    edges = spark.createDataFrame([(*p, 1.0) for p in sorted(pairs | others)], kinds)
    written = []

    class Counted(cliques.Rounds):
        def cut(self, df):
            df = super().cut(df)
            if self.name == "votes":
                written.append(df.count())
            return df

    monkeypatch.setattr(cliques, "Rounds", Counted)
    # After one round the clients of a hub still differ in their labels.
    assert as_dict(cliques.named_labels(g, 2, self_vote=own)) == as_dict(label_propagation(edges, 2, self_vote=own))
    assert max(written) <= 10 * g.sizes().count()
