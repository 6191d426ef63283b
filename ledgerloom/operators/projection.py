"""Client-hub incidence, its weighted projection and the merge with transfers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hub_key, hub_key_keep_null, ordered_pair
from ..functions.times import floor_to
from .edges import expand_pairs, induced, larger_hubs, prepare_transactions

# Column, hub prefix and base weight of each kind of hub.
HUBS = [
    ("merchant", "m", 1.0),
    ("session_id", "sess", 0.5),
    ("ip_address", "ip", 0.7),
    ("device_type", "dev", 0.3),
    ("region", "reg", 0.2),
]
CASH_WEIGHTS = {"withdrawal": 0.8, "deposit": 0.6}


def incidence(tx: DataFrame) -> DataFrame:
    """Distinct (client_id, hub, kind, weight) over all hub kinds, in one scan.

    A cash-point hub that saw both kinds of operation keeps the larger weight.
    """
    tx = prepare_transactions(tx)
    fields = [
        F.struct(hub_key(prefix, F.col(col)).alias("hub"), F.lit(prefix).alias("kind"), F.lit(weight).alias("weight"))
        for col, prefix, weight in HUBS
    ]
    cash = F.col("transaction_type").isin(list(CASH_WEIGHTS))
    slot = F.date_format(floor_to(F.col("datetime")), "yyyy-MM-dd HH:mm:ss")
    cash_weight = F.create_map(*[F.lit(x) for kv in CASH_WEIGHTS.items() for x in kv])[F.col("transaction_type")]
    fields.append(
        F.struct(
            F.when(cash, hub_key_keep_null("atm", F.col("region"), slot)).alias("hub"),
            F.lit("atm").alias("kind"),
            F.when(cash, cash_weight).alias("weight"),
        )
    )
    return (
        tx.select("client_id", F.explode(F.array(*fields)).alias("h"))
        .filter(F.col("h.hub").isNotNull() & F.col("client_id").isNotNull())
        .groupBy("client_id", F.col("h.hub").alias("hub"), F.col("h.kind").alias("kind"))
        .agg(F.max("h.weight").alias("weight"))
    )


def project(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(src, dst, shared, weight): clients that share a hub, weighted by log1p of the hubs shared.

    All hubs count, whatever their size. ``nodes`` (id) restricts both ends before pairs are
    built; without it every pair of every hub is listed, whose number grows with the square of
    a hub's clients. For given pairs use :func:`shared_of_pairs`, and the incidence itself is
    the whole graph without listing pairs.
    """
    members = links.select("kind", "hub", "client_id")
    if nodes is not None:
        members = members.join(nodes.select(F.col("id").alias("client_id")), "client_id", "left_semi")
    return expand_pairs(members).groupBy("src", "dst").agg(F.count("*").alias("shared")).withColumn("weight", F.log1p("shared"))


def shared_of_pairs(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, dst, shared, weight) of given distinct pairs (src, dst); 0 hubs give 0.

    Each end's hubs are joined to the pair as rows, so neither a client with many hubs nor a
    hub with many clients is ever gathered.
    """
    hubs = links.select("hub", F.col("client_id").alias("src"))
    both = pairs.select("src", "dst").join(hubs, "src").join(hubs.withColumnRenamed("src", "dst"), ["dst", "hub"])
    counted = both.groupBy("src", "dst").agg(F.count("*").alias("n"))
    shared = F.coalesce("n", F.lit(0)).cast("long")
    return pairs.select("src", "dst").join(counted, ["src", "dst"], "left").select(
        "src", "dst", shared.alias("shared"), F.log1p(shared).alias("weight")
    )


def large_hubs(links: DataFrame, least: int) -> DataFrame:
    """(hub, client_id, n_clients) of hubs with more than ``least`` clients, a report."""
    return larger_hubs(links.select("kind", "hub", "client_id"), least).select("hub", "client_id", "n_clients")


def transfers_collapsed(tx: DataFrame) -> DataFrame:
    """The latest transfer per (sender, recipient)."""
    return (
        tx.filter((F.col("transaction_type") == "p2p") & F.col("recipient_id").isNotNull())
        .groupBy(F.col("client_id").alias("src"), F.col("recipient_id").alias("dst"))
        .agg(F.max_by("amount", F.struct("datetime", "transaction_id")).alias("amount"), F.max("datetime").alias("datetime"))
    )


def merged_graph(tx: DataFrame, min_weight: float = 1.0, nodes: DataFrame | None = None) -> DataFrame:
    """Projection plus transfers: (src, dst, weight, layer, p2p_count), weak edges cut.

    ``p2p_count`` counts directions, 1 or 2, and is NULL without transfers. ``nodes`` (id)
    restricts both ends, as in :func:`project`.
    """
    shared = project(incidence(tx), nodes).select("src", "dst", F.col("weight").alias("shared_weight"))
    a, b = ordered_pair(F.col("src"), F.col("dst"))
    transfers = (
        transfers_collapsed(tx)
        .select(a.alias("src"), b.alias("dst"), F.log1p("amount").alias("w"))
        .groupBy("src", "dst")
        .agg(F.sum("w").alias("p2p_weight"), F.count("*").alias("p2p_count"))
    )
    if nodes is not None:
        transfers = induced(transfers, nodes)
    zero = F.lit(0.0)
    return (
        shared.join(transfers, ["src", "dst"], "full")
        .select(
            "src",
            "dst",
            (F.coalesce("shared_weight", zero) + F.coalesce("p2p_weight", zero)).alias("weight"),
            F.when(F.col("shared_weight").isNotNull(), "shared").otherwise("p2p").alias("layer"),
            "p2p_count",
        )
        .filter(F.col("weight") >= min_weight)
    )
