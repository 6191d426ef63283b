import hashlib
import math
from datetime import datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import edges as ed
from ledgerloom.operators import projection as pj

T0 = datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = (
    "transaction_id string, client_id string, datetime timestamp, amount double, merchant string, transaction_type string, "
    "session_id string, ip_network string, ip_address string, region string, device_type string, recipient_id string, "
    "recipient_id_hash string"
)


def frame(spark, rows):
    out = []
    for i, r in enumerate(rows):
        full = dict(transaction_id=f"t{i:04d}", client_id="c", datetime=T0, amount=1.0, merchant=None, transaction_type="deposit",
                    session_id=None, ip_network=None, ip_address=None, region=None, device_type=None, recipient_id=None)
        full.update(r)
        full["recipient_id_hash"] = hashlib.sha256(full["recipient_id"].encode()).hexdigest() if full["recipient_id"] else None
        out.append(tuple(full[c.split()[0]] for c in SCHEMA.split(", ")))
    return spark.createDataFrame(out, SCHEMA)


def pairs(df, a="src", b="dst"):
    return sorted((r[a], r[b]) for r in df.collect())


def kind(name, cap):
    return [ed.HubKind(name, F.col("merchant"), cap, 0.5)]


def test_hubs_of_one_two_cap_and_more(spark):
    rows = [dict(client_id=f"c{i}", merchant=m) for m, n in (("one", 1), ("two", 2), ("cap", 4), ("over", 5)) for i in range(n)]
    rows += [dict(client_id="c0", merchant="repeat")] * 3
    got = pairs(ed.shared_edges(frame(spark, rows), kind("merchant", 4)))
    want = [("c0", "c1")] + list(combinations([f"c{i}" for i in range(4)], 2))
    assert got == sorted(want)


def test_missing_merchants_are_one_ordinary_hub(spark):
    rows = [dict(client_id="a"), dict(client_id="b"), dict(client_id="x", merchant="m")]
    got = ed.client_edges(frame(spark, rows)).collect()
    assert [(r.src, r.dst, r.weight, r.relationships) for r in got] == [("a", "b", 0.5, ["merchant"])]


def test_kinds_are_summed_and_sorted(spark):
    rows = [dict(client_id=c, merchant="m", session_id="s", ip_network="n") for c in ("b", "a")]
    row = ed.client_edges(frame(spark, rows)).first()
    assert (row.src, row.dst, row.relationships_str) == ("a", "b", "ip,merchant,session")
    assert row.weight == pytest.approx(1.8)


def test_cash_points_need_a_region(spark):
    rows = [dict(client_id=c, transaction_type="withdrawal", region=r, merchant=c) for c, r in (("a", None), ("b", None), ("c", "R"), ("d", "R"))]
    late = dict(client_id="e", transaction_type="withdrawal", region="R", merchant="e", datetime=T0 + timedelta(minutes=1))
    got = ed.client_edges(frame(spark, rows + [late]))
    assert pairs(got) == [("c", "d")]
    wide = ed.client_edges(frame(spark, rows + [late]), kinds=ed.standard_kinds("30min"))
    assert pairs(wide) == [("c", "d"), ("c", "e"), ("d", "e")]


def test_weak_transfers_are_cut_and_hashes_resolve(spark):
    rows = [dict(client_id="a", transaction_type="p2p", recipient_id="b", amount=0.5, merchant="m1"),
            dict(client_id="a", transaction_type="p2p", recipient_id="c", amount=9.0, merchant="m2")]
    df = frame(spark, rows)
    row = ed.client_edges(df).collect()
    assert [(r.src, r.dst) for r in row] == [("a", hashlib.sha256(b"c").hexdigest())]
    assert row[0].weight == pytest.approx(math.log1p(9.0))
    clients = spark.createDataFrame([("c",)], "client_id string")
    assert pairs(ed.client_edges(df, clients, recipient_key="resolve")) == [("a", "c")]


def test_hub_rows_hold_the_same_links_as_pairs(spark):
    rows = [dict(client_id=f"c{i}", merchant=m) for m, n in (("small", 3), ("large", 6), ("single", 1)) for i in range(n)] * 2
    df = frame(spark, rows)
    rule = [ed.PairRule("merchant", "merchant_shared", 0.5)]
    every = pairs(ed.distinct_pair_edges(df, rule, pairs=True), "source", "target")
    assert every == sorted(combinations([f"c{i}" for i in range(6)], 2))
    hubs = ed.distinct_pair_edges(df, rule)
    assert {r.relationship for r in hubs.collect()} == {"merchant_shared_hub"}
    assert pairs(hubs, "source", "target") == sorted([(f"c{i}", "small") for i in range(3)] + [(f"c{i}", "large") for i in range(6)])
    chosen = spark.createDataFrame([("c0",), ("c5",)], "id string")
    assert pairs(ed.distinct_pair_edges(df, rule, nodes=chosen), "source", "target") == [("c0", "c5")]


def test_network_row_limit_counts_transactions(spark):
    rows = [dict(client_id=f"c{i % 2}", ip_network="busy") for i in range(6)] + [dict(client_id=c, ip_network="calm") for c in ("x", "y")]
    rule = [ed.PairRule("ip_network", "ip_shared", 1.0, 6)]
    assert pairs(ed.distinct_pair_edges(frame(spark, rows), rule, pairs=True), "source", "target") == [("x", "y")]


def test_diagnostics(spark):
    df = spark.createDataFrame([("a", "b", "p"), ("a", "c", "p"), ("x", "y", "q")], "source string, target string, relationship string")
    assert {r.relationship: (r.n_edges, r.n_clients, r.n_hubs, r.n_pairs) for r in ed.edge_diagnostics(df).collect()} == {
        "p": (2, 3, 0, 2), "q": (1, 2, 0, 1)}
    hubs = spark.createDataFrame([(c, h, "m_hub") for h, cs in (("h", "abc"), ("i", "ab")) for c in cs], "source string, target string, relationship string")
    assert [tuple(r) for r in ed.edge_diagnostics(hubs).collect()] == [("m_hub", 5, 3, 2, 4)]


def test_sequential_edges(spark):
    day = timedelta(days=1)
    rows = [dict(client_id="a", merchant="m"), dict(client_id="a", merchant="m", datetime=T0 + timedelta(hours=1)),
            dict(client_id="b", merchant="m", datetime=T0 + timedelta(hours=1) + day),
            dict(client_id="c", merchant="m", datetime=T0 + timedelta(hours=1, microseconds=1) + 2 * day)]
    rows += [dict(client_id=f"z{i}", merchant="crowd", datetime=T0 + timedelta(seconds=i)) for i in range(101)]
    assert pairs(ed.sequential_edges(frame(spark, rows))) == [("a", "b")]


def test_the_last_writer_links_neighbours_at_merchants_of_any_size(spark, monkeypatch):
    from ledgerloom.catalog import edges as catalog

    hours = [0, 1, 5, 5, 24, 47, 48, 49, 97, 98, 171] + list(range(300, 420))  # no row within a day of 49, 98 and 171
    rows = [dict(client_id=f"c{i:03d}", merchant="crowd", datetime=T0 + timedelta(hours=h, microseconds=i)) for i, h in enumerate(hours)]
    rows += [dict(client_id="lone", merchant="small"), dict(client_id="lone", merchant="crowd", datetime=None)]
    want = {(f"c{i:03d}", f"c{i + 1:03d}") for i in range(len(hours) - 1) if hours[i + 1] - hours[i] < 24}
    tx = frame(spark, rows)
    assert set(pairs(ed.sequential_edges(tx, max_rows=None))) == want and len(want) == len(hours) - 4
    monkeypatch.setattr(catalog, "tx_orders", lambda s, sf: tx)
    assert set(pairs(catalog.q_lastwriter(spark, None))) == want
    assert set(pairs(ed.last_writer_graph(tx))) == want


@pytest.mark.parametrize("products", [4_000_000, 60])
def test_last_writer_pairs_are_listed_once_in_many_cells(spark, monkeypatch, products):
    """The latest kind of each pair, and no row per pair passes a shuffle."""
    import random

    monkeypatch.setattr(ed, "LAST_WRITER_PRODUCTS", products)
    rnd = random.Random(7)
    rows = [dict(client_id=rnd.choice([f"c{rnd.randrange(30)}"] * 9 + [None]), session_id=rnd.choice(["big", "s1", "s2", None]), merchant=f"m{i % 3}",
                 region=rnd.choice(["N", "S"]), transaction_type=rnd.choice(["p2p", "withdrawal"]), recipient_id=f"c{rnd.randrange(35)}",
                 datetime=T0 + timedelta(hours=rnd.randrange(60))) for i in range(120)]
    tx = frame(spark, rows)
    columns = ["src", "dst", "relationship", "weight"]
    plain = ed.merge_last_writer(
        ed.sequential_edges(tx, max_rows=None).unionByName(ed.raw_transfer_pairs(tx))
        .unionByName(ed.session_edges(tx, True, collapse=False).select(*columns)).unionByName(ed.withdrawal_edges(tx, True, collapse=False).select(*columns))
    )
    made = ed.last_writer_pairs(tx)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, made.select(*columns).collect())) == sorted(map(key, plain.select(*columns).collect()))
    steps = [s.strip(" +-:") for s in made._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert steps[0].startswith("Union") and any(s.startswith("FlatMapGroupsInArrow") for s in steps[1:3])


def row_pairs(clients):
    return [tuple(sorted(p)) for p in combinations(clients, 2)]


def test_session_rows_count_pairs_of_rows(spark):
    clients = ["a", "b", "a", "c", "b", "a"]
    rows = [dict(client_id=c, session_id="s") for c in clients] + [dict(client_id=c, session_id="five") for c in "vwxyz"]
    got = {(r.src, r.dst): r.multiplicity for r in ed.session_edges(frame(spark, rows), pairs=True).collect()}
    want = {}
    for p in row_pairs(clients):
        want[p] = want.get(p, 0) + 1
    assert got == want
    whole = ed.session_edges(frame(spark, rows)).collect()
    assert sorted((r.src, r.dst, r.relationship, r.multiplicity) for r in whole) == [
        ("a", "s", "session_shared_hub", 3), ("b", "s", "session_shared_hub", 2), ("c", "s", "session_shared_hub", 1)]


def test_last_writer_wins_in_kind_order(spark):
    df = spark.createDataFrame(
        [("b", "a", "p2p", 10.0), ("a", "b", "merchant_shared", 1.0), ("a", "b", "session_shared", 0.5), ("c", "d", "p2p", 10.0)],
        "src string, dst string, relationship string, weight double")
    got = sorted(map(tuple, ed.merge_last_writer(df).collect()))
    assert got == [("a", "b", "session_shared", 0.5), ("c", "d", "p2p", 10.0)]


def test_last_writer_graph_holds_the_listed_pairs(spark):
    import random

    rnd = random.Random(2)
    rows = [dict(client_id=f"c{rnd.randrange(30)}", session_id=rnd.choice(["big", "big", f"s{i % 9}", None]), merchant=f"m{i % 20}",
                 region=rnd.choice(["N", "S"]), transaction_type=rnd.choice(["p2p", "withdrawal"]), recipient_id=f"c{rnd.randrange(35)}",
                 datetime=T0 + timedelta(hours=rnd.randrange(30))) for i in range(200)]
    tx = frame(spark, rows)
    plain = {(r.src, r.dst): (r.relationship, r.weight) for r in ed.last_writer_pairs(tx).collect()}
    made = ed.last_writer_graph(tx, large=10).collect()
    hubs = {}
    for r in made:
        if r.relationship == "session_shared_hub":
            hubs.setdefault(r.dst, set()).add(r.src)
    assert set(hubs) == {"big"}
    got = {p: ("session_shared", 0.5) for m in hubs.values() for p in combinations(sorted(m), 2)}
    got.update({(r.src, r.dst): (r.relationship, r.weight) for r in made if r.relationship != "session_shared_hub"})
    assert got == plain and len({k for k, _ in plain.values()}) > 2


def test_the_last_writer_query_lists_all_pairs_of_large_sessions(spark, monkeypatch):
    from ledgerloom.catalog import edges as catalog

    crowd = [f"c{i:03d}" for i in range(130)]
    rows = [dict(client_id=c, session_id="big", merchant=f"m{c}") for c in crowd]
    rows += [dict(client_id="c000", transaction_type="p2p", recipient_id=r, merchant="x") for r in ("c001", "z")]
    monkeypatch.setattr(catalog, "tx_orders", lambda s, sf: frame(s, rows))
    got = {(r.src, r.dst): r.relationship for r in catalog.q_lastwriter(spark, None).collect()}
    assert got == {p: "session_shared" for p in combinations(crowd, 2)} | {("c000", "z"): "p2p"}


def test_pairs_in_cells_are_those_of_the_whole_hub(spark):
    members = spark.createDataFrame([(h, f"c{i:02d}") for h, n in (("x", 23), ("y", 4), ("z", 1)) for i in range(n)], "hub string, client_id string")
    for gap in (0, 1):
        got = sorted((r.a.client_id, r.b.client_id) for r in ed._pairs_in_cells(members, F.struct("client_id"), gap, block=5).collect())
        want = [(f"c{i:02d}", f"c{j:02d}") for n in (23, 4, 1) for i in range(n) for j in range(i + gap, n)]
        assert got == sorted(want)


@pytest.mark.parametrize("many", [256, 2])
def test_pairs_of_common_hubs_are_listed_once(spark, monkeypatch, many):
    import random

    monkeypatch.setattr(ed, "MANY_HUBS", many)
    rnd = random.Random(4)
    rows = {(f"h{rnd.randrange(8)}", rnd.choice(["a", "b", "c", "d", "e", "f", "g", None])): rnd.randrange(1, 4) for _ in range(40)}
    made = spark.createDataFrame([(h, c, n) for (h, c), n in rows.items()], "hub string, client_id string, n long")
    want = {}
    for (h, x), (k, y) in combinations(sorted(rows, key=lambda r: (r[1] or "", r[0])), 2):
        if h == k:
            want[x, y] = want.get((x, y), 0) + rows[h, x] * rows[k, y]
    got = ed._counted_pairs(made).collect()
    assert {(r.src, r.dst): r.multiplicity for r in got} == want and len(got) == len(want)
    plain = ed.hub_pairs(made).collect()
    assert sorted((r.src, r.dst) for r in plain) == sorted(p for p in want if p[0])
    assert len(want) > 15


def test_incidence_keeps_missing_region_of_cash_points(spark):
    rows = [dict(client_id="a", transaction_type="withdrawal"), dict(client_id="a", transaction_type="deposit")]
    hubs = {r.hub: r.weight for r in pj.incidence(frame(spark, rows)).collect()}
    assert hubs == {"m:no_merchant": 1.0, "dev:unknown": 0.3, "atm:nan:2024-01-01 12:00:00": 0.8}


def test_projection_counts_all_shared_hubs(spark):
    people = [f"c{i}" for i in range(6)]
    rows = [dict(client_id=c, region="R", device_type="web", session_id="s1" if i < 3 else f"own{i}", merchant=f"m{i}") for i, c in enumerate(people)]
    links = pj.incidence(frame(spark, rows))
    # Cash points (deposits at one time) are shared by everyone as well.
    full = {(r.src, r.dst): r.shared for r in pj.project(links).collect()}
    assert full[("c0", "c1")] == 4 and full[("c0", "c5")] == 3 and len(full) == 15
    chosen = spark.createDataFrame([(p,) for p in people[:3]], "id string")
    assert {(r.src, r.dst): r.shared for r in pj.project(links, chosen).collect()} == {p: 4 for p in combinations(people[:3], 2)}
    asked = spark.createDataFrame([("c0", "c1"), ("c0", "c5"), ("c0", "nobody")], "src string, dst string")
    assert {(r.src, r.dst): r.shared for r in pj.shared_of_pairs(links, asked).collect()} == {("c0", "c1"): 4, ("c0", "c5"): 3, ("c0", "nobody"): 0}
    assert {r.hub for r in pj.large_hubs(links, 3).collect()} == {"reg:R", "dev:web", "atm:R:2024-01-01 12:00:00"}


def test_clients_that_share_device_and_region_only(spark):
    rows = [dict(client_id=c, region="R", device_type="web", merchant=f"m{c}", transaction_type="payment") for c in "abc"]
    got = {(r.src, r.dst): (r.shared, round(r.weight, 4)) for r in pj.project(pj.incidence(frame(spark, rows))).collect()}
    assert got == {p: (2, 1.0986) for p in (("a", "b"), ("a", "c"), ("b", "c"))}


def test_merge_refuses_unknown_kinds(spark):
    df = spark.createDataFrame([("a", "b", "withdrawal_shared_hub", 2.0)], "src string, dst string, relationship string, weight double")
    with pytest.raises(Exception, match="no place in the merge order"):
        ed.merge_last_writer(df).collect()


def test_collapsed_transfers_keep_the_latest(spark):
    rows = [dict(client_id="a", recipient_id="b", transaction_type="p2p", amount=5.0, datetime=T0 + timedelta(days=1)),
            dict(client_id="a", recipient_id="b", transaction_type="p2p", amount=7.0),
            dict(client_id="b", recipient_id="a", transaction_type="p2p", amount=3.0),
            dict(client_id="a", recipient_id=None, transaction_type="p2p")]
    got = {(r.src, r.dst): r.amount for r in pj.transfers_collapsed(frame(spark, rows)).collect()}
    assert got == {("a", "b"): 5.0, ("b", "a"): 3.0}


def test_merged_graph_cuts_single_hub_pairs(spark):
    rows = [dict(client_id="a", merchant="m", device_type="x"), dict(client_id="b", merchant="m", device_type="y", region="Q"),
            dict(client_id="a", merchant="n", device_type="x", transaction_type="p2p", recipient_id="b", amount=2.0),
            dict(client_id="b", merchant="o", device_type="y", transaction_type="p2p", recipient_id="a", amount=3.0),
            dict(client_id="c", merchant="m", device_type="z", datetime=T0 + timedelta(days=9), region="P")]
    df = frame(spark, rows)
    got = {(r.src, r.dst): (round(r.weight, 6), r.layer, r.p2p_count) for r in pj.merged_graph(df).collect()}
    want = math.log1p(1) + math.log1p(2.0) + math.log1p(3.0)
    assert got == {("a", "b"): (round(want, 6), "shared", 2)}
