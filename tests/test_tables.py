import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators import quality
from ledgerloom.plans import loads, marts, reports
from ledgerloom.schemas import CLIENT_COMMUNITIES, TRANSACTIONS
from ledgerloom.sources import readers, writers


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_csv_is_matched_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text("AMOUNT,transaction_id,extra\n1.5,t1,x\n,t2,\n")
    df = readers.read_csv(spark, str(tmp_path / "t.csv"), TRANSACTIONS)
    assert dict(df.dtypes) == {"AMOUNT": "double", "transaction_id": "string", "extra": "string"}
    assert rows(df) == [(1.5, "t1", "x"), (None, "t2", None)]


def test_key_replace_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 9, "x"), ("c", 3, "y")], "k string, v int, extra string")
    once = writers.key_replaced(target, batch, "k")
    twice = writers.key_replaced(once, batch, "k")
    assert rows(once) == rows(twice) == [("a", 1, None), ("b", 9, "x"), ("c", 3, "y")]


def test_merge_updates_only_named_columns(spark):
    target = spark.createDataFrame([("a", "old", 1), ("b", "old", 2)], "k string, name string, v int")
    source = spark.createDataFrame([("b", "new", 20), ("c", "new", None)], "k string, name string, v int")
    once = writers.merged(target, source, "k", ["v"])
    want = [("a", "old", 1), ("b", "old", 20), ("c", "new", None)]
    assert rows(once) == want
    assert rows(writers.merged(once, source, "k", ["v"])) == want
    # An update to NULL on a match is an update.
    none = spark.createDataFrame([("a", "x", None)], "k string, name string, v int")
    assert rows(writers.merged(target, none, "k", ["v"]))[0] == ("a", "old", None)
    stamped = writers.merged(target.withColumn("at", F.lit("t0")), source, "k", ["v"], {"at": F.lit("t1")})
    assert [(r.k, r.at) for r in stamped.orderBy("k").collect()] == [("a", "t0"), ("b", "t1"), ("c", "t1")]


def test_load_transactions_gates_duplicates_and_evolves(spark):
    target = spark.createDataFrame([("t1", 1.0), ("t2", 2.0)], "transaction_id string, amount double")
    batch = spark.createDataFrame([("t2", 5.0, "R", 7)], "Transaction_ID string, amount double, region string, id int")
    out = loads.load_transactions(target, batch.withColumnRenamed("Transaction_ID", "transaction_id"))
    assert out.columns == ["transaction_id", "amount", "region"]
    assert rows(out) == [("t1", 1.0, None), ("t2", 5.0, "R")]
    with pytest.raises(quality.DuplicateKeys):
        loads.load_transactions(target, batch.union(batch).withColumnRenamed("Transaction_ID", "transaction_id"))


def test_rates_slice_is_replaced(spark, tmp_path):
    path = str(tmp_path / "rates")
    for day, factor in (("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-01", 3)):
        rates = {k: v * factor for k, v in loads.RATES.items()}
        writers.replace_slice(loads.rates_for(spark, day, rates), path)
    got = {(r.date, r.currency): r.rate for r in spark.read.parquet(path).collect()}
    assert len(got) == 8
    assert got[(date(2024, 1, 1), "USD")] == 270.0 and got[(date(2024, 1, 2), "USD")] == 90.0
    target = loads.rates_for(spark, "2024-01-01").union(loads.rates_for(spark, "2024-01-02"))
    assert loads.load_rates(target, "2024-01-02").count() == 8


def test_rates_slice_within_a_month(spark, tmp_path):
    path = str(tmp_path / "rates")
    def load(day, factor):
        df = loads.rates_for(spark, day, {k: v * factor for k, v in loads.RATES.items()})
        writers.replace_slice(df.withColumn("month", F.date_format("date", "yyyy-MM")), path, "date", "month")
    for day, factor in (("2024-01-01", 1), ("2024-01-02", 1), ("2024-02-01", 1), ("2024-01-01", 2)):
        load(day, factor)
    got = {(str(r.date), r.currency): r.rate for r in spark.read.parquet(path).collect()}
    assert len(got) == 12
    assert [got[(d, "USD")] for d in ("2024-01-01", "2024-01-02", "2024-02-01")] == [180.0, 90.0, 90.0]


def test_slice_files_are_bounded_by_measured_rows(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "slices"
    day = F.when(F.col("id") < 1000, "big").when(F.col("id") < 2995, F.concat(F.lit("d"), (F.col("id") % 20).cast("string")))
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("x"), day.alias("date"), F.lit("m").alias("_rows"))
    writers.replace_slice(df, str(path), rows_per_file=100)
    writers.replace_slice(df.filter("date = 'big'"), str(path), rows_per_file=100)
    got = spark.read.parquet(str(path))
    assert got.filter("date is null").count() == 5 and rows(got.select(*df.columns)) == rows(df)
    sizes = [pq.read_metadata(f).num_rows for f in path.glob("*/*.parquet")]
    assert sum(sizes) == 3000 and max(sizes) <= 100
    writers.replace_slice(spark.range(1000).select(F.col("id").alias("x"), F.lit("e").alias("date")), str(tmp_path / "e"), rows_per_file=100)
    files = list((tmp_path / "e").glob("*/*.parquet"))
    assert 5 <= len(files) <= 20  # dealt by measured rows


def test_publish_swaps_and_a_failed_build_changes_nothing(spark, tmp_path):
    name, root = f"t_{uuid.uuid4().hex}", str(tmp_path)
    writers.publish(spark.range(3), name, root)
    writers.publish(spark.table(name).withColumn("id", F.col("id") + 10), name, root)
    assert [r.id for r in spark.table(name).orderBy("id").collect()] == [10, 11, 12]
    with pytest.raises(Exception):
        writers.publish(spark.table(name).withColumn("id", F.raise_error(F.lit("broken")).cast("long")), name, root)
    assert spark.table(name).count() == 3
    writers.add_columns(spark, name, {"note": "string"})
    writers.append(spark.createDataFrame([("x", 99)], "note string, id long"), name)
    assert rows(spark.table(name))[-1] == (99, "x")
    writers.truncate_and_load(spark.createDataFrame([(1, "drop me")], "id long, other string"), name, root)
    assert rows(spark.table(name)) == [(1, None)]


def test_graphml_round_trip_and_old_keys(spark, tmp_path):
    nodes = spark.createDataFrame(
        [("client_1", "7", 1.5, 2, 3.0, 4), ("ab", "7", None, 2, 1.0, 1)],
        "id string, community_id string, influence_score double, community_size long, w_degree double, degree long")
    edges = spark.createDataFrame([("client_1", "ab", 0.5, "p2p")], "src string, dst string, weight double, relationships string")
    path = str(tmp_path / "g")
    writers.write_graphml(nodes, edges, path)
    back = {r.id: r for r in readers.read_graphml_nodes(spark, f"{path}/nodes").collect()}
    assert (back["client_1"].influence_score, back["client_1"].node_type, back["ab"].node_type) == (1.5, "client", "community")
    assert back["ab"].influence_score is None and back["ab"].degree == 1
    assert rows(readers.read_graphml_edges(spark, f"{path}/edges")) == [("client_1", "ab", 0.5, "p2p")]
    old = tmp_path / "old.graphml"
    old.write_text(
        '<graphml><graph edgedefault="undirected"><node id="n1"><data key="d0">61.0</data></node>'
        '<node id="n2"><data key="d0">1</data><data key="{ns}d1">0.25</data><data key="influence_score">0.5</data></node>'
        '<node id="n3"/></graph></graphml>')
    got = {r.id: r for r in readers.read_graphml_nodes(spark, str(old)).collect()}
    assert set(got) == {"n1", "n2", "n3"}
    assert got["n1"].community_id == "61.0" and got["n2"].influence_score == 0.5 and got["n3"].community_id is None


def test_stored_attributes_win_over_computed_ones(spark):
    nodes = spark.createDataFrame(
        [("a", "61.0", 0.9), ("b", None, None), ("c", "x", None)], "id string, community_id string, influence_score double")
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", None)], "source string, target string, weight double")
    got = {r.id: r for r in reports.completed_nodes(nodes, edges).collect()}
    assert got["a"].community_id == "61" and got["a"].influence_score == 0.9
    assert got["c"].community_id == "x" and got["b"].community_id is not None
    assert got["b"].influence_score > got["c"].influence_score > 0


def test_structure_report(spark):
    edges = spark.createDataFrame(
        [("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 1.0), ("c", "d", 1.0), ("x", "y", 1.0)], "src string, dst string, weight double")
    row = reports.structure_report(edges).first()
    assert (row.nodes, row.edges, row.diameter_lcc) == (6, 5, 2)
    assert row.avg_clustering == pytest.approx((1 + 1 + 1 / 3) / 6)
    assert -0.5 <= row.modularity_lp <= 1 and row.modularity_louvain > 0


def test_graph_fact_merge_refreshes_features_only(spark):
    tx = spark.createDataFrame(
        [("t1", "c1", None, 1.0, "USD", None, "p2p", None, "p2p"), ("t2", "c9", None, 2.0, "USD", None, "p2p", None, "p2p")],
        "transaction_id string, client_id string, datetime timestamp, amount double, currency string, merchant string, "
        "transaction_type string, ip_network string, category string")
    table = spark.createDataFrame([("c1", "A", 1.0, 3, 2.0, 1)], CLIENT_COMMUNITIES)
    at = lambda day: F.lit(f"2024-01-0{day}").cast("timestamp")
    first = marts.graph_fact(None, tx.filter("transaction_id = 't1'"), table, at(1))
    assert [r.created_at.day for r in first.collect()] == [1]
    moved = spark.createDataFrame([("c1", "B", 5.0, 4, 2.5, 1)], CLIENT_COMMUNITIES)
    second = marts.graph_fact(first, tx.withColumn("category", F.lit("other")), moved, at(2))
    got = {r.transaction_id: r for r in second.collect()}
    assert (got["t1"].community_id, got["t1"].category) == ("B", "p2p")
    assert got["t2"].community_id is None and len(got) == 2
    assert got["t1"].created_at.day == got["t2"].created_at.day == 2  # refreshed, and new
    kept = marts.graph_fact(second, tx.filter("transaction_id = 't2'"), moved, at(3)).collect()
    assert {r.transaction_id: r.created_at.day for r in kept} == {"t1": 2, "t2": 3}


def test_statistics_invariants(spark, tmp_path):
    table = spark.createDataFrame([("a", "1", 2, 2.0), ("b", "1", 1, 1.0), ("c", "2", 1, 1.0)],
                                  "id string, community_id string, degree long, w_degree double")
    edges = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0)], "src string, dst string, weight double")
    stats = reports.graph_statistics(table, edges, top=1)
    writers.write_json(stats, str(tmp_path / "s"))
    row = spark.read.json(str(tmp_path / "s")).first()
    assert row.avg_degree == pytest.approx(2 * row.total_edges / row.total_nodes)
    assert row.avg_community_size == row.total_nodes / row.communities
    assert (row.filtered_nodes, row.filtered_edges, row.exported_communities) == (2, 1, 1)
    assert stats.first().community_distribution == {"1": 2}


def test_recommendations_cover_every_kind(spark):
    people = spark.createDataFrame([("c1", "A", 2.0, 1, 1.0, 1), ("c2", "B", 1.0, 1, 1.0, 1), ("c3", "C", 1.0, 1, 1.0, 1),
                                    ("c4", "D", 1.0, 1, 1.0, 1)], CLIENT_COMMUNITIES)
    tx = spark.createDataFrame([("c1", 10.0, "p2p", None), ("c2", 2.5, "withdrawal", "Shop"), ("c3", 4.0, "deposit", None)],
                               "client_id string, amount double, transaction_type string, merchant string")
    got = {r.community_id: r for r in reports.recommendations(people, tx).collect()}
    assert got["A"].recommendation.startswith("Сообщество #A: 1 клиентов, средняя транзакция $10.00, тип: p2p\n")
    assert "(Shop)" in got["B"].recommendation and "Лидер: c3" in got["C"].recommendation
    assert "тип: unknown" in got["D"].recommendation and "$0.00" in got["D"].recommendation


def test_scratch_follows_the_cluster_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_root(spark) == named
    path = session.scratch_path(spark, "x")
    assert path.startswith(named) and path != session.scratch_path(spark, "x")
    kept = session.cut(spark.range(2), "kept")
    assert kept.count() == 2 and kept.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(named.lstrip("/"))


def test_rounds_drop_older_tables(spark):
    written = session.Rounds(spark, "r", keep=1)
    first = written.cut(spark.range(1))
    assert first.count() == 1
    assert written.cut(spark.range(2)).count() == 2
    assert len(written.paths) == 1


def test_partitions_follow_the_data():
    assert session.partitions_for(0) == 1
    assert session.partitions_for(10 * session.ROWS_PER_PARTITION) == 10
    assert session.partitions_for(10**15) == session.MAX_PARTITIONS


def test_publish_survives_a_crash_while_columns_change(spark, tmp_path, monkeypatch):
    name = "crash_table"
    writers.publish(spark.createDataFrame([(1,)], "a int"), name, str(tmp_path))

    def crash(*args):
        raise RuntimeError("crash")

    other = spark.createDataFrame([(2, "x")], "a int, b string")
    with monkeypatch.context() as m:
        m.setattr(writers, "_create", crash)
        with pytest.raises(RuntimeError, match="crash"):
            writers.publish(other, name, str(tmp_path))
    writers.recover(spark, name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1,)]
    writers.publish(other, name, str(tmp_path))
    assert [tuple(r) for r in spark.table(name).collect()] == [(2, "x")]
    assert not spark.catalog.tableExists(writers._aside(name))
    spark.sql(f"DROP TABLE {name}")
