import hashlib
import ipaddress
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text, times
from ledgerloom.operators import aggregates as agg
from ledgerloom.operators import flows, masking, quality, rules
from ledgerloom.operators.categories import fill_categories
from ledgerloom.plans import reports

T0 = datetime(2024, 1, 1, 12, 0, 0)


def tx_frame(spark, rows):
    return spark.createDataFrame(
        rows, "transaction_id string, client_id string, datetime timestamp, amount double, currency string, transaction_type string"
    )


def tx(i, client="c1", at=T0, amount=10.0, kind="deposit", currency="USD"):
    return (f"t{i}", client, at, amount, currency, kind)


def test_daily_flows_are_null_strict(spark):
    rows = [tx(1), tx(2, amount=5.0), tx(3, at=T0 + timedelta(days=1), kind="withdrawal", amount=3.0),
            tx(4, at=T0 + timedelta(days=1), amount=7.0), tx(5, at=T0 + timedelta(days=2), kind="p2p")]
    got = {str(r.dt): r for r in flows.daily_flows(tx_frame(spark, rows)).collect()}
    assert (got["2024-01-01"].inflow, got["2024-01-01"].outflow, got["2024-01-01"].net_flow) == (15.0, None, None)
    assert got["2024-01-02"].net_flow == 4.0
    assert (got["2024-01-03"].inflow, got["2024-01-03"].tx_cnt) == (None, 1)
    filled = {str(r.dt): r for r in flows.daily_flows(tx_frame(spark, rows), zero_fill=True).collect()}
    assert [filled[d].net_flow for d in sorted(filled)] == [15.0, 4.0, 0.0]


def test_balance_opens_with_the_previous_close(spark):
    rows = []
    for d in range(4):
        at = T0 + timedelta(days=d)
        rows += [tx(2 * d, at=at, amount=10.0 + d), tx(2 * d + 1, at=at, kind="withdrawal", amount=4.0)]
    days = flows.client_balance(flows.daily_flows(tx_frame(spark, rows))).orderBy("date").collect()
    assert days[0].opening_balance is None
    assert [r.closing_balance for r in days] == [6.0, 13.0, 21.0, 30.0]
    assert [r.opening_balance for r in days[1:]] == [r.closing_balance for r in days[:-1]]


def test_large_rule_is_strict(spark):
    hits = rules.large_transactions(tx_frame(spark, [tx(1, amount=600_000.0), tx(2, amount=600_000.01)])).collect()
    assert [(r.transaction_id, r.rule_triggered, r.risk_score) for r in hits] == [("t2", "large_tx", 70)]


def brute_force_counts(rows, seconds=86_400):
    stamp = [(r[1], int(r[2].timestamp())) for r in rows]
    return {r[0]: sum(1 for c, s in stamp if c == r[1] and int(r[2].timestamp()) - seconds <= s <= int(r[2].timestamp())) for r in rows}


def test_frequency_window_ends_are_inclusive_and_whole_seconds(spark):
    rows = [tx(0), tx(1, at=T0 + timedelta(seconds=86_400)), tx(2, at=T0 + timedelta(seconds=86_401)),
            tx(3, at=T0 + timedelta(milliseconds=900)), tx(4, client="c2")]
    frame = tx_frame(spark, rows)
    got = {(r.client_id, r.sec): r.cnt for r in rules.trailing_counts(frame).collect()}
    start = min(s for c, s in got if c == "c1")
    assert got[("c1", start)] == 2  # both rows of the first second
    assert got[("c1", start + 86_400)] == 3
    assert got[("c1", start + 86_401)] == 2


def test_frequency_rule_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [tx(i, client=f"c{i % 3 if i % 4 else 0}", at=T0 + timedelta(seconds=int(s))) for i, s in enumerate(rng.integers(0, 5 * 86_400, 200))]
    want = sorted(t for t, n in brute_force_counts(rows).items() if n > 10)
    got = sorted(r.transaction_id for r in rules.frequent_transactions(tx_frame(spark, rows)).collect())
    assert want and got == want


def test_frequency_rule_counts_missing_times_together(spark):
    rows = [tx(i, at=None) for i in range(4)] + [tx(9)]
    got = sorted(r.transaction_id for r in rules.frequent_transactions(tx_frame(spark, rows), 3).collect())
    assert got == ["t0", "t1", "t2", "t3"]


def test_transaction_can_fire_both_rules(spark):
    rows = [tx(i, amount=700_000.0 if i == 11 else 1.0, at=T0 + timedelta(minutes=i)) for i in range(12)]
    hits = rules.suspicious_transactions(tx_frame(spark, rows)).collect()
    assert Counter((r.transaction_id, r.rule_triggered) for r in hits) == {
        ("t11", "large_tx"): 1, ("t10", "freq_tx"): 1, ("t11", "freq_tx"): 1}
    assert all(r.detection_time is not None for r in hits)
    assert {r.rule_triggered: r.n for r in reports.rule_distribution(spark.createDataFrame(hits)).collect()} == {"large_tx": 1, "freq_tx": 2}


IPS = ["192.168.1.77", "256.1.1.1", "01.2.3.4", "1.2.3", " 1.2.3.4", None, "2001:db8::1", "::", "::1", "1::", "0:1f00::",
       "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "::ab00:3:4:5:6:7:8", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "fe80::1%eth0",
       "::1::2", "12345::", "1.2.3.4/8", "1:2:3:4:5:6:7:8:9", "", "::ab12:3:4:5:6:1.2.3.4", "10.0.0.1\n"]


def test_networks_match_the_standard_library(spark):
    def want(ip):
        try:
            return str(ipaddress.ip_network(f"{ip}/24", strict=False)) if ip is not None else None
        except ValueError:
            return None

    df = spark.createDataFrame(list(enumerate(IPS)), "i int, ip string")
    got = {r.i: r.n for r in df.select("i", text.ip_network(F.col("ip")).alias("n")).collect()}
    assert got == {i: want(ip) for i, ip in enumerate(IPS)}


def test_masking_keeps_nulls_and_hides_values(spark):
    df = spark.createDataFrame(
        [("t1", "client_1", "10.1.2.3", "client_2"), ("t2", "client_2", None, None)],
        "transaction_id string, client_id string, ip_address string, recipient_id string",
    )
    rows = {r.transaction_id: r for r in masking.mask_transactions(df).collect()}
    assert rows["t1"].recipient_id_hash == hashlib.sha256(b"client_2").hexdigest()
    assert rows["t1"].ip_network == "10.1.2.0/24"
    assert rows["t2"].ip_network is None and rows["t2"].recipient_id_hash is None
    assert "ip_address" not in rows["t1"] and "recipient_id" not in rows["t1"]
    assert "recipient_id_hash" not in masking.mask_transactions(df.drop("recipient_id")).columns
    people = spark.createDataFrame([("client_1", "a@b.c", None)], "client_id string, email string, passport_id string")
    row = masking.mask_clients(people).first()
    assert row.email_hash == hashlib.sha256(b"a@b.c").hexdigest() and row.passport_hash is None and "email" not in row


def test_categories_fill_only_missing(spark):
    df = spark.createDataFrame(
        [("p2p", "Amazon", None), ("deposit", "Ozon", None), ("deposit", "Uber", None), ("deposit", None, None), ("p2p", "x", "kept")],
        "transaction_type string, merchant string, category string",
    )
    assert [r.category for r in fill_categories(df).collect()] == ["p2p", "retail", "travel", "other", "kept"]


def test_time_grains_and_ntz(spark):
    df = spark.sql("select timestamp_ntz'2024-03-05 10:47:59.9' as t")
    row = df.select(
        times.epoch_seconds(F.col("t")).alias("s"), times.minute_label(times.to_minute(F.col("t"))).alias("m"),
        times.minute_label(times.floor_to(F.col("t"))).alias("h"),
    ).first()
    assert (row.s, row.m, row.h) == (1709635679, "2024-03-05-10-47", "2024-03-05-10-30")


def test_hub_keys(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = df.select(text.hub_key("h", F.col("x"), F.col("y")).alias("strict"), text.hub_key_keep_null("h", F.col("x"), F.col("y")).alias("kept")).first()
    assert row.strict is None and row.kept == "h:a:nan"


def test_quality_gates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    with pytest.raises(quality.DuplicateKeys):
        quality.require_unique(df, "k")
    assert quality.require_unique(df.filter("v > 1"), "k").count() == 3
    with pytest.raises(quality.EmptyInput):
        quality.require_rows(df.filter("v > 9"), "k")
    assert quality.duplicate_summary(df, "k").first() == (2, 1)
    assert sorted(r.v for r in quality.duplicate_rows(df, "k").collect()) == [1, 2]
    assert quality.null_key_count(df, "k").first()[0] == 1
    assert quality.drop_null_keys(df, "k").count() == 3
    assert quality.duplicate_summary(df.filter("v > 1"), "k").first() == (0, 0)


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "Client_ID int, Name string")
    assert quality.missing_columns(["client_id"], ["CLIENT_ID", "id", "region"]) == ["region"]
    grown = quality.evolve_to(df, {"client_id": "int", "region": "string", "ID": "long"})
    assert grown.columns == ["Client_ID", "Name", "region"] and grown.first().region is None
    assert quality.restrict_to(df, ["NAME", "other"]).columns == ["Name"]


def test_new_ids(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert quality.random_ids(df, "k").select("k").distinct().count() == 2
    again = [sorted(r.k for r in quality.hashed_ids(df, "k", ["k", "v"]).collect()) for _ in range(2)]
    assert again[0] == again[1] and len(set(again[0])) == 2


def test_observation_counts_rows(spark):
    df, seen = quality.observed(spark.range(7), "rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["n_rows"] == 7


def test_column_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    for approximate in (False, True):
        got = {r.column_name: (r.data_type, r.n_rows, r.distinct_values) for r in quality.column_profile(df, approximate).collect()}
        assert got == {"k": ("string", 3, 1), "v": ("int", 3, 3)}


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [("big", float(np.round(x, 2))) for x in rng.lognormal(8, 4, 4000)]
    rows += [("neg", float(np.round(x, 2))) for x in rng.normal(0, 50_000, 301)] + [("one", 5.25), ("two", 1.0), ("two", 2.0)]
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    df = spark.createDataFrame(rows + [(None, 1.0), ("one", None)], "g string, v double")
    got = {r.g: r for r in agg.quantiles(df, "g", "v", probs).collect()}
    assert set(got) == {"big", "neg", "one", "two"}
    for g in got:
        values = [v for k, v in rows if k == g]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-6)


def test_describe_and_histogram(spark):
    values = [1, 1, 2, 5, 9, 9, 10]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    row = agg.describe(df, "v").first()
    assert (row["count"], row["min"], row["max"]) == (7, 1, 10)
    assert (row.q25, row.q50, row.q75) == tuple(np.quantile(values, [0.25, 0.5, 0.75]))
    bins = agg.histogram(df, F.col("v"), 5).orderBy("bin").collect()
    assert [b.n for b in bins] == list(np.histogram(values, 5)[0])
    flat = agg.histogram(spark.createDataFrame([(3,), (3,)], "v int"), F.col("v"), 4).orderBy("bin").collect()
    assert [b.n for b in flat] == list(np.histogram([3, 3], 4)[0])


def test_rankings_and_shares(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "a"), ("g", "b"), ("h", "z"), (None, "z"), ("h", None)], "g string, v string")
    assert {r.g: r.dominant for r in agg.dominant(df, "g", "v").collect()} == {"g": "a", "h": "z"}
    assert [(r.v, r.n) for r in agg.top_values(df, "v", 2).collect()] == [("a", 2), ("b", 2)]
    shares = {r.v: r.share for r in agg.shares(agg.value_counts(df, "v")).collect()}
    assert shares == {"a": 2 / 6, "b": 2 / 6, "z": 2 / 6}
    counts = spark.createDataFrame([(f"k{i:02d}", i) for i in range(15)], "k string, n int")
    got = {r.k: r.n for r in agg.top_with_other(counts, "k", "n", 10).collect()}
    assert len(got) == 11 and got[agg.OTHER] == sum(range(5))
    assert agg.OTHER not in {r.k for r in agg.top_with_other(counts.limit(10), "k", "n", 10).collect()}
    mix = {r.g: (r.a, r.b, r.z) for r in agg.mix(df, "g", "v", ["a", "b", "z"]).collect()}
    assert mix == {"g": (0.5, 0.5, 0.0), "h": (0.0, 0.0, 1.0)}
    top = agg.top_per_group(counts.withColumn("g", F.lit(1)), "g", "n", "k", 3).collect()
    assert [r.k for r in sorted(top, key=lambda r: r["rank"])] == ["k14", "k13", "k12"]
    assert {r.column_name: r.max_count for r in agg.max_multiplicity(df, ["g", "v"]).collect()} == {"g": 4, "v": 2}


def test_scaling_guards_the_constant_case(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert [r.s for r in agg.min_max_scale(df, "v", 100, 5000, "s").collect()] == [100.0, 5000.0]
    assert agg.min_max_scale(df.limit(1), "v", 100, 5000, "s").first().s == 100.0


def test_statistics_skip_missing_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, 9.0)], "g string, v double")
    empty = agg.group_statistics(spark.createDataFrame([("b", None), ("b", None)], "g string, v double"), "g", "v").first()
    assert (empty.g, empty["mean"], empty["median"], empty["count"]) == ("b", None, None, 0)
    rows = agg.group_statistics(df, "g", "v").collect()
    assert [(r.g, r["mean"], r["median"], r["min"], r["max"], r["count"]) for r in rows] == [("a", 2.5, 2.5, 1.0, 4.0, 2)]
