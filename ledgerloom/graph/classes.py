"""The merged client graph without listing its pairs: classes of clients, and corrections.

Hubs with very many clients (devices, regions, big merchants) link almost everybody. Clients with
the same set of such hubs form a class; any two clients of two classes share the same number of
them, so their pairs are one row. Pairs that share a smaller hub, too, or are linked by transfers
are listed as corrections with their full weight. Every edge is represented once, counts are
exact, and the tables grow with clients, pairs of classes and pairs in small hubs.

Measures that are sums over edges are computed on both levels: class sums by the weight of each
pair of classes, then what the corrections change. Corrections are written only for measures that
need them as rows, see :mod:`.meeting`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ordered_pair
from ..operators.edges import hub_sizes
from ..operators.projection import incidence, transfers_collapsed
from ..session import MAX_PARTITIONS, Rounds, cut
from .components import connected_components, largest_component
from .ids import Numbering, number_vertices
from .meeting import Meeting
from .paths import FIRST_SOURCES, Levels, settled_diameter

LARGE, LARGE_PART = 100, 10  # a hub of more clients than this, and than a tenth of all, is part of the classes
PRODUCTS_PER_CELL = 4_000_000  # pairs of all hubs, about, that one cell lists at a time


@dataclass
class ClassGraph:
    members: DataFrame  # id, cls (the smallest id of the class; null without large hubs)
    pairs: DataFrame  # a, b (a <= b), shared, weight, and n_pairs: pairs of clients without a correction, or every: all pairs of clients
    corrections: DataFrame | None  # src, dst (src <= dst), a, b, shared, weight, layer, p2p_count, base; None: ``meeting`` has them
    min_weight: float
    numbering: Numbering | None = None  # with it, pairs and corrections hold vertex numbers, and
    numbered: DataFrame | None = None  # so does this copy of members
    class_hubs: DataFrame | None = None  # cls, hub: the large hubs of each class, by number
    meeting: Meeting | None = None

    def whole(self) -> ClassGraph:
        """With all corrections as rows."""
        return self if self.corrections is not None else replace(self, corrections=self.meeting.listed())

    def only_edges(self) -> ClassGraph:
        """With the corrections that change which edges there are; weights are not theirs alone to tell."""
        return self if self.corrections is not None else replace(self, corrections=self.meeting.edges())

    @property
    def kept_pairs(self) -> DataFrame:
        return self.pairs.filter(F.col("weight") >= self.min_weight)

    @property
    def counted_pairs(self) -> DataFrame:
        """The kept pairs of classes with n_pairs."""
        if "n_pairs" in self.pairs.columns:
            return self.kept_pairs
        known = self.corrections.filter("base > 0").groupBy("a", "b").agg(F.count("*").alias("known"))
        return self.kept_pairs.join(known, ["a", "b"], "left").withColumn("n_pairs", F.col("every") - F.coalesce("known", F.lit(0)))

    @property
    def kept_corrections(self) -> DataFrame:
        return self.corrections.filter(F.col("weight") >= self.min_weight)


def on_numbers(*id_columns: str):
    """Run a measure on vertex numbers and return names in ``id_columns``. A membership (id, community_id) is translated as well."""

    def wrap(fn):
        @wraps(fn)
        def run(g: ClassGraph, *args, **kwargs):
            if g.numbering is None:
                return fn(g, *args, **kwargs)
            args = [g.numbering.number(x, "id") if isinstance(x, DataFrame) else x for x in args]
            found = fn(replace(g, members=g.numbered, numbering=None, numbered=None), *args, **kwargs)
            return g.numbering.named(found, *id_columns)

        return run

    return wrap


def _cell_pairs(table: pa.Table) -> pa.Table:
    """Pairs of one cell: each two clients of common listed hubs once, with the numbers of listed and of class hubs they share."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    block, hub, listed = (table[c].to_numpy() for c in ("block", "hub", "listed"))
    ids, at = np.unique(table["id"].to_numpy(), return_inverse=True)
    cls = np.full(len(ids), -1, np.int64)
    cls[at] = table["cls"].fill_null(-1).to_numpy()
    left, right = (np.flatnonzero(listed & (block == b)) for b in (low, high))
    right = right[np.argsort(hub[right], kind="stable")]
    first, last = (np.searchsorted(hub[right], hub[left], side) for side in ("left", "right"))
    n = last - first
    x = np.repeat(at[left], n)
    y = at[right][np.arange(len(x)) + np.repeat(first - np.cumsum(n) + n, n)]
    codes = np.minimum(x, y) * len(ids) + np.maximum(x, y)
    codes, extra = np.unique(codes[x < y] if low == high else codes, return_counts=True)
    src, dst = np.divmod(codes, max(1, len(ids)))
    hubs, bit = np.unique(hub[~listed], return_inverse=True)
    has = np.zeros((len(ids), -(-max(1, len(hubs)) // 64) * 64), bool)
    has[at[~listed], bit] = True
    shared = np.zeros(len(src), np.int32)
    for word in np.packbits(has, axis=1).view(np.uint64).T:
        shared += np.bitwise_count(word[src] & word[dst])
    a, b = (pa.array(pick(cls[src], cls[dst]), mask=shared == 0) for pick in (np.minimum, np.maximum))
    return pa.table({"src": ids[src], "dst": ids[dst], "extra": extra.astype(np.int32), "a": a, "b": b, "of_class": shared})


def _listed_pairs(rows: DataFrame) -> DataFrame:
    """(src, dst, extra, a, b, of_class): every two ids that share a listed hub of ``rows`` (hub, id, cls, listed), once.

    Ids are dealt to blocks by hash, and two blocks meet in a cell, so pairs are added up where they
    are made and none is shuffled. A hub goes only to the cells of its own blocks.
    """
    listed = rows.filter("listed")
    n = listed.groupBy("hub").agg(F.count("*").alias("n"))
    products = n.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0] or 0.0
    blocks = max(1, int(np.ceil(np.sqrt(products / PRODUCTS_PER_CELL))))
    own = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    met = own.filter("listed").groupBy("hub").agg(F.collect_set("block").alias("others"))
    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    meet = own.filter("listed").join(met, "hub").unionByName(own.filter("not listed").withColumn("others", every))
    cells = meet.withColumn("other", F.explode("others")).select(
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "hub", "id", "cls", "listed"
    )
    tasks = min(MAX_PARTITIONS, blocks * (blocks + 1) // 2)
    return cells.repartition(tasks, "low", "high").groupBy("low", "high").applyInArrow(_cell_pairs, "src long, dst long, extra int, a long, b long, of_class int")


def _classes(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, cls), and the hubs of each class (cls, hub)."""
    signed = own.groupBy("id").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("hub")).cast("array<string>"), "\n"), 256).alias("sig"))
    named = cut(signed.join(signed.groupBy("sig").agg(F.min("id").alias("cls")), "sig").select("id", "cls"), "classes")
    return named, own.join(named.filter("id = cls").select("id"), "id", "left_semi").select(F.col("id").alias("cls"), "hub")


def class_graph(tx: DataFrame, large: int | None = None, min_weight: float = 1.0, transfers: bool = True) -> ClassGraph:
    """Projection over all hubs (weight log1p of the hubs shared) plus transfers (log1p of the amounts).

    ``min_weight`` is the cut of weak edges that the measures apply; the tables keep all. Hubs of up to
    ``large`` clients list their pairs. By default that is a tenth of all clients, 100 at least:
    each client is in few larger hubs, so there are few classes. Pairs of classes are listed per large hub.
    """
    links = cut(incidence(tx).select("kind", "hub", "client_id"), "incidence")
    if large is None:
        large = max(LARGE, links.agg(F.count_distinct("client_id")).first()[0] // LARGE_PART)
    sizes = cut(hub_sizes(links).withColumn("number", F.monotonically_increasing_id()), "hub-sizes")
    a, b = ordered_pair(F.col("src"), F.col("dst"))
    sent = cut(
        transfers_collapsed(tx).filter(F.lit(transfers)).select(a.alias("src"), b.alias("dst"), F.log1p("amount").alias("w"))
        .groupBy("src", "dst").agg(F.sum("w").alias("p2p_weight"), F.count("*").alias("p2p_count")),
        "sent",
    )
    numbering = number_vertices(sent, links.select(F.col("client_id").alias("id")))
    sent = cut(numbering.number(sent, "src", "dst"), "numbered-sent")
    own = links.join(sizes, ["kind", "hub"]).select(F.col("number").alias("hub"), F.col("client_id").alias("id"), "n_clients")
    own = cut(numbering.number(own, "id"), "numbered-links")
    in_large = own.filter(F.col("n_clients") > large).select("hub", "id")
    classes, hubs = _classes(in_large)
    hubs = cut(hubs, "class-hubs")
    no_class = F.lit(None).cast("long")
    met = _listed_pairs(hubs.select("hub", F.col("cls").alias("id"), no_class.alias("cls"), F.lit(True).alias("listed")))
    itself = hubs.groupBy(F.col("cls").alias("a")).agg(F.count("*").alias("shared")).select("a", F.col("a").alias("b"), "shared")
    pairs = met.select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("extra").cast("long").alias("shared")).unionByName(itself)
    n = classes.groupBy("cls").agg(F.count("*").alias("n"))
    pairs = pairs.join(n.select(F.col("cls").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b")
    every = F.when(F.col("a") == F.col("b"), F.expr("na * (na - 1) div 2")).otherwise(F.col("na") * F.col("nb"))
    pairs = cut(pairs.select("a", "b", "shared", F.log1p("shared").alias("weight"), every.alias("every")), "class-pairs")

    def corrections() -> DataFrame:
        # The two sides of a transfer meet in a hub of their own, so that they are listed; it is not counted.
        apart = cut(sent.filter("src <> dst").select((-1 - F.monotonically_increasing_id()).alias("hub"), "src", "dst"), "transfer-hubs")
        small = own.filter((F.col("n_clients") >= 2) & (F.col("n_clients") <= large)).select("hub", "id")
        small = small.unionByName(apart.select("hub", F.explode(F.array("src", "dst")).alias("id")))
        met = small.withColumn("listed", F.lit(True)).unionByName(in_large.withColumn("listed", F.lit(False))).join(classes, "id", "left")
        listed = _listed_pairs(cut(met, "meeting")).join(sent, ["src", "dst"], "left").withColumn("extra", F.col("extra") - F.when(F.col("p2p_count").isNull(), 0).otherwise(1))
        # A transfer to oneself shares no hub with anybody.
        zero = F.lit(0).cast("int")
        loops = sent.filter("src = dst").select("*", zero.alias("extra"), no_class.alias("a"), no_class.alias("b"), zero.alias("of_class"))
        written = cut(listed.unionByName(loops), "corrections")
        shared = F.col("extra") + F.col("of_class")
        base = F.log1p("of_class")
        return written.select(
            "src", "dst", "a", "b", shared.cast("long").alias("shared"), (F.log1p(shared) + F.coalesce("p2p_weight", F.lit(0.0))).alias("weight"),
            F.when(shared > 0, "shared").otherwise("p2p").alias("layer"), "p2p_count", F.when(base >= min_weight, base).otherwise(0.0).alias("base"),
        )

    numbered = cut(numbering.names.select("id").join(classes, "id", "left"), "members")
    of = lambda c: numbering.names.select(F.col("id").alias(c), F.col("name").alias(f"{c}_name"))
    members = numbered.join(of("id"), "id").join(of("cls"), "cls", "left").select(F.col("id_name").alias("id"), F.col("cls_name").alias("cls"))
    meeting = Meeting(own, classes, pairs, sent, large, min_weight, corrections)
    return ClassGraph(members, pairs, None, min_weight, numbering, numbered, hubs.select("cls", "hub"), meeting)


@on_numbers("src", "dst")
def compressed_rows(g: ClassGraph) -> DataFrame:
    """(level, src, dst, shared, weight, layer, p2p_count, n_pairs): all kept edges; a ``class`` row stands for ``n_pairs`` of them."""
    g = g.whole()
    of_classes = g.counted_pairs.filter("n_pairs > 0").select(
        F.lit("class").alias("level"), F.col("a").alias("src"), F.col("b").alias("dst"), "shared", "weight",
        F.lit("shared").alias("layer"), F.lit(None).cast("long").alias("p2p_count"), "n_pairs",
    )
    listed = g.kept_corrections.select(
        F.lit("pair").alias("level"), "src", "dst", "shared", "weight", "layer", "p2p_count", F.lit(1).cast("long").alias("n_pairs")
    )
    return of_classes.unionByName(listed)


@on_numbers("src", "dst")
def expanded(g: ClassGraph) -> DataFrame:
    """All kept edges as pairs (src, dst, weight), for small graphs: their number grows with the square of a class."""
    g = g.whole()
    of = lambda end, cls: g.members.filter("cls is not null").select(F.col("id").alias(end), F.col("cls").alias(cls))
    plain = g.kept_pairs.join(of("u", "a"), "a").join(of("v", "b"), "b").filter((F.col("a") != F.col("b")) | (F.col("u") < F.col("v")))
    low, high = ordered_pair(F.col("u"), F.col("v"))
    plain = plain.select(low.alias("src"), high.alias("dst"), "weight").join(g.corrections.select("src", "dst"), ["src", "dst"], "left_anti")
    return plain.unionByName(g.kept_corrections.select("src", "dst", "weight"))


class _Sums:
    """For values of vertices: the sum over each vertex's neighbours, by edge weight or by edge."""

    def __init__(self, g: ClassGraph, by_weight: bool = True):
        strength = F.col("weight") if by_weight else F.lit(1.0)
        kept = g.kept_pairs.select("a", "b", strength.alias("w"))
        back = kept.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "w")
        self.pairs = cut(kept.unionByName(back), "directed-pairs")
        self.inside = self.pairs.filter("a = b").select(F.col("a").alias("cls"), F.col("w").alias("own"))
        kept_now = F.col("weight") >= g.min_weight
        change = F.when(kept_now, F.col("weight") if by_weight else 1.0).otherwise(0.0) - (F.col("base") if by_weight else F.when(F.col("base") > 0, 1.0).otherwise(0.0))
        rows = g.corrections.select("src", "dst", change.alias("w")).filter("w <> 0")
        back = rows.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
        self.corrections = cut(rows.unionByName(back), "directed-corrections")
        self.members = cut(g.members.join(self.inside, "cls", "left").select("id", "cls", F.coalesce("own", F.lit(0.0)).alias("own")), "sum-members")

    def __call__(self, state: DataFrame, x: str) -> DataFrame:
        """(id, total) of ``state`` (id, x): class by class without one's own value, then the corrections."""
        mine = self.members.join(state.select("id", F.col(x).alias("x")), "id")
        sums = mine.groupBy(F.col("cls").alias("b")).agg(F.sum("x").alias("s"))
        heard = self.pairs.join(sums, "b").groupBy(F.col("a").alias("cls")).agg(F.sum(F.col("w") * F.col("s")).alias("all"))
        more = self.corrections.join(state.select(F.col("id").alias("src"), F.col(x).alias("x")), "src").groupBy(F.col("dst").alias("id")).agg(
            F.sum(F.col("w") * F.col("x")).alias("more")
        )
        total = F.coalesce(F.col("all") - F.col("own") * F.col("x"), F.lit(0.0)) + F.coalesce("more", F.lit(0.0))
        return mine.join(heard, "cls", "left").join(more, "id", "left").select("id", total.alias("total"))


@on_numbers("id")
def merged_degrees(g: ClassGraph) -> DataFrame:
    """(id, degree, w_degree) of all clients; 0 without kept edges. A loop counts once."""
    n = cut(g.members.filter("cls is not null").groupBy("cls").agg(F.count("*").alias("n")), "class-sizes")
    kept = g.kept_pairs.select("a", "b", "weight")
    back = kept.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")
    others = F.col("n") - F.when(F.col("a") == F.col("b"), 1).otherwise(0)
    heard = (
        kept.unionByName(back).join(n.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls"))
        .agg(F.sum(others).alias("d"), F.sum(F.col("weight") * others).alias("w"))
    )
    if g.corrections is None:
        more = g.meeting.by_id().select("id", F.col("d").alias("more_d"), F.col("w").alias("more_w"))
    else:
        # Corrections are read once per end and added up as they are read.
        kept_now = F.col("weight") >= g.min_weight
        changes = g.corrections.select(
            "src", "dst", (kept_now.cast("long") - (F.col("base") > 0).cast("long")).alias("d"), (F.when(kept_now, F.col("weight")).otherwise(0.0) - F.col("base")).alias("w")
        )
        at = lambda rows, end: rows.groupBy(F.col(end).alias("id")).agg(F.sum("d").alias("more_d"), F.sum("w").alias("more_w"))
        more = at(changes, "src").unionByName(at(changes.filter("src <> dst"), "dst")).groupBy("id").agg(F.sum("more_d").alias("more_d"), F.sum("more_w").alias("more_w"))
    total = lambda c, zero: F.coalesce(c, F.lit(zero)) + F.coalesce(f"more_{c}", F.lit(zero))
    return g.members.join(heard, "cls", "left").join(more, "id", "left").select("id", total("d", 0).cast("long").alias("degree"), total("w", 0.0).alias("w_degree"))


@on_numbers()
def merged_density(g: ClassGraph) -> DataFrame:
    """One row: nodes, edges, density and average degree; nodes without kept edges count."""
    g = g.only_edges()
    listed = F.count_if(F.col("weight") >= g.min_weight) - F.count_if(F.col("base") > 0)
    edges = (
        g.kept_pairs.agg(F.coalesce(F.sum("every"), F.lit(0)).alias("m"))
        .unionByName(g.corrections.agg(listed.alias("m"))).agg(F.sum("m").cast("long").alias("edges"))
    )
    n, m = F.col("nodes"), F.col("edges")
    return edges.withColumn("nodes", g.members.agg(F.count("*")).scalar()).select(
        "nodes", "edges", F.coalesce(F.try_divide(2 * m, n * (n - 1)), F.lit(0.0)).alias("density"),
        F.coalesce(F.try_divide(2 * m, n), F.lit(0.0)).alias("avg_degree"),
    )


@on_numbers("id")
def merged_pagerank(g: ClassGraph, alpha: float = 0.85, tol: float = 1e-6, max_rounds: int = 100) -> DataFrame:
    """(id, influence_score) by weight; the scores sum to 1. Vertices without kept edges spread theirs evenly.

    Stops when the summed change falls below ``nodes * tol`` and raises if it doesn't.
    """
    g = g.whole()
    sums = _Sums(g)
    out = cut(sums(g.members.select("id", F.lit(1.0).alias("x")), "x").withColumnRenamed("total", "out"), "out")
    n = out.count()
    written = Rounds(g.members.sparkSession, "merged-ranks")
    ranks = out.withColumn("rank", F.lit(1.0 / max(1, n)))
    for _ in range(max_rounds):
        idle = ranks.filter("out <= 0").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        base = (alpha * idle + 1 - alpha) / max(1, n)
        shares = ranks.select("id", F.when(F.col("out") > 0, F.col("rank") / F.col("out")).otherwise(0.0).alias("share"))
        heard = sums(shares, "share")
        ranks = written.cut(
            ranks.join(heard, "id").select("id", "out", (F.lit(base) + alpha * F.col("total")).alias("rank"), F.abs(F.lit(base) + alpha * F.col("total") - F.col("rank")).alias("moved"))
        )
        if (ranks.agg(F.sum("moved")).first()[0] or 0.0) < n * tol:
            return ranks.select("id", F.col("rank").alias("influence_score"))
        ranks = ranks.drop("moved")
    if not n:
        return ranks.select("id", F.col("rank").alias("influence_score"))
    raise RuntimeError(f"ranks did not settle in {max_rounds} rounds")


@on_numbers("id", "component")
def merged_components(g: ClassGraph) -> DataFrame:
    """(id, component): the smallest id that kept edges reach. Classes take part as vertices of their own.

    Corrections only add to a pair's weight, so a kept pair of classes links all their clients, and
    only corrections without one are followed.
    """
    g = g.only_edges()
    beyond = (g.members.agg(F.max("id")).first()[0] or 0) + 1  # classes are numbered behind all ids, so none is a label
    node = lambda c: F.col(c) + beyond
    linked = g.kept_pairs.join(g.members.groupBy(F.col("cls").alias("a")).agg(F.count("*").alias("n")), "a").filter("a <> b or n > 1")
    joined = linked.filter("a <> b").select(node("a").alias("src"), node("b").alias("dst"))
    of = linked.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    inside = g.members.join(of, "cls").select(F.col("id").alias("src"), node("cls").alias("dst"))
    edges = joined.unionByName(inside).unionByName(g.kept_corrections.filter("base = 0").select("src", "dst")).withColumn("weight", F.lit(1.0))
    return connected_components(edges, vertices=g.members.select("id")).filter(F.col("id") < beyond)


@on_numbers()
def merged_modularity(g: ClassGraph, membership: DataFrame) -> DataFrame:
    """One row: modularity by weight of ``membership`` (id, community_id), in closed sums over classes."""
    between = cut(community_sums(g, membership), "between-communities").filter("c is not null or e is not null")
    inside = F.when(F.col("c") == F.col("e"), 2 * F.col("w")).otherwise(0.0)
    # An edge inside counts at both of its ends.
    ends = between.select(F.explode(F.array("c", "e")).alias("community_id"), "w", (inside / 2).alias("twice")).filter("community_id is not null")
    degree = cut(ends.groupBy("community_id").agg(F.sum("w").alias("deg"), F.sum("twice").alias("twice")), "community-degrees")
    total = degree.agg(F.sum("deg")).scalar()  # twice the weight of all edges
    return degree.agg(F.sum(F.col("twice") / total - F.pow(F.col("deg") / total, 2)).alias("modularity"))


def community_sums(g: ClassGraph, membership: DataFrame) -> DataFrame:
    """(c, e, d, w), c <= e: number and weight of kept edges inside and between communities; null is outside of all, and first.

    Clients by number. A loop is inside, and counts once.
    """
    membership = cut(membership.select("id", "community_id"), "membership")  # its size is known, so a small one is broadcast
    n = g.members.filter("cls is not null").join(membership, "id", "left").groupBy("cls", "community_id").agg(F.count("*").alias("n"))
    n = cut(n, "community-classes")
    kept = g.kept_pairs.select("a", "b", "weight")
    back = kept.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "weight")
    # A class adds up what it hears of each community before its own communities meet them; each pair is met from both ends.
    heard = (
        kept.unionByName(back).join(n.withColumnRenamed("cls", "b"), "b").groupBy("a", F.col("community_id").alias("e"))
        .agg(F.sum("n").alias("d"), F.sum(F.col("weight") * F.col("n")).alias("w"))
    )
    own = n.select(F.col("cls").alias("a"), F.col("community_id").alias("c"), "n")
    of_classes = own.join(heard, "a").select("c", "e", (F.col("n") * F.col("d")).cast("double").alias("d"), (F.col("n") * F.col("w")).alias("w"))
    itself = own.join(kept.filter("a = b").select("a", "weight"), "a").select("c", F.col("c").alias("e"), (-F.col("n")).cast("double").alias("d"), (-F.col("n") * F.col("weight")).alias("w"))
    first = F.col("c").isNull() | (F.col("c") <= F.col("e"))
    both = of_classes.unionByName(itself).select(
        F.when(first, F.col("c")).otherwise(F.col("e")).alias("c"), F.when(first, F.col("e")).otherwise(F.col("c")).alias("e"), (F.col("d") / 2).alias("d"), (F.col("w") / 2).alias("w"))
    if g.corrections is None:
        more = g.meeting.by_community(membership)
    else:
        of = lambda end, c: membership.select(F.col("id").alias(end), F.col("community_id").alias(c))
        kept_now = F.col("weight") >= g.min_weight
        more = g.corrections.join(of("src", "k1"), "src", "left").join(of("dst", "k2"), "dst", "left").select(
            F.when(F.col("k1").isNull() | (F.col("k1") <= F.col("k2")), F.col("k1")).otherwise(F.col("k2")).alias("c"),
            F.when(F.col("k1").isNull() | (F.col("k1") <= F.col("k2")), F.col("k2")).otherwise(F.col("k1")).alias("e"),
            (kept_now.cast("int") - (F.col("base") > 0).cast("int")).cast("double").alias("d"), (F.when(kept_now, F.col("weight")).otherwise(0.0) - F.col("base")).alias("w"),
        )
    return both.unionByName(more).groupBy("c", "e").agg(F.sum("d").alias("d"), F.sum("w").alias("w"))


def _two_best(votes: DataFrame) -> DataFrame:
    """(cls, l1, v1, l2, v2): the two labels with most votes of each class, ties to the smaller label."""
    place = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("votes"), "label"))
    top = votes.withColumn("place", place).filter("place <= 2")
    at = lambda c, k: F.max(F.when(F.col("place") == k, F.col(c)))
    return top.groupBy("cls").agg(at("label", 1).alias("l1"), at("votes", 1).alias("v1"), at("label", 2).alias("l2"), at("votes", 2).alias("v2"))


def _first_votes(sums: _Sums) -> DataFrame:
    """(cls, label, votes) of the first round, in which every vertex has a label of its own.

    All labels of adjacent classes have one vote, so only the two smallest can win. They are among
    the two smallest of each adjacent class.
    """
    of_class = sums.members.filter("cls is not null").groupBy(F.col("cls").alias("b")).agg(F.min(F.when(F.col("id") != F.col("cls"), F.col("id"))).alias("next"))
    low = sums.pairs.join(of_class, "b").select(F.col("a").alias("cls"), F.explode(F.array("b", "next")).alias("label")).filter("label is not null")
    place = F.row_number().over(Window.partitionBy("cls").orderBy("label"))
    return low.withColumn("place", place).filter("place <= 2").select("cls", "label", F.lit(1).cast("long").alias("votes"))


@on_numbers("id", "community_id")
def merged_labels(g: ClassGraph, max_rounds: int = 100, self_vote: bool = False) -> DataFrame:
    """(id, community_id): label propagation by kept edges until nothing changes; raises if it doesn't settle.

    The same as plain simultaneous rounds: ties go to the smallest label, a loop counts twice, vertices
    without kept edges keep their own label, and ``self_vote`` adds one's own. A class adds up its members'
    labels once for all who hear it. For a vertex only few labels can win: the two best of its class
    (its own vote is taken off) and those that corrections or its own vote add to.
    """
    g = g.only_edges()
    sums = _Sums(g, by_weight=False)
    spark = g.members.sparkSession
    extra = cut(
        sums.corrections.select("src", "dst", F.when(F.col("src") == F.col("dst"), 2).otherwise(1).cast("long").alias("n"))
        .unionByName(sums.members.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1).cast("long").alias("n")).filter(F.lit(self_vote)))
        .groupBy("src", "dst").agg(F.sum("n").alias("n")),
        "extra-votes",
    )
    written, heard = Rounds(spark, "merged-labels"), Rounds(spark, "class-votes")
    state = sums.members.select("id", "cls", (F.col("own") > 0).alias("own"), F.col("id").alias("label"))
    rank = lambda votes, label: F.when(votes > 0, F.struct((-votes).alias("less"), label.alias("label")))
    for i in range(max_rounds):
        if i:
            held = state.filter("cls is not null").groupBy(F.col("cls").alias("b"), "label").agg(F.count("*").alias("n"))
            votes = sums.pairs.join(held, "b").groupBy(F.col("a").alias("cls"), "label").agg(F.sum("n").alias("votes"))
        else:
            votes = _first_votes(sums)
        votes = heard.cut(votes)
        mine = state.join(_two_best(votes), "cls", "left")
        less = F.when(F.col("own") & (F.col("l1") == F.col("label")), 1).otherwise(0)
        by_class = F.least(rank(F.col("v1") - less, F.col("l1")), F.when(less == 1, rank(F.col("v2"), F.col("l2"))))
        more = extra.join(state.select(F.col("id").alias("src"), "label"), "src").groupBy(F.col("dst").alias("id"), "label").agg(F.sum("n").alias("n"))
        more = more.join(state.select("id", "cls", "own", F.col("label").alias("old")), "id").join(votes, ["cls", "label"], "left")
        total = F.col("n") + F.coalesce(F.col("votes") - F.when(F.col("own") & (F.col("label") == F.col("old")), 1).otherwise(0), F.lit(0))
        by_extra = more.groupBy("id").agg(F.min(rank(total, F.col("label"))).alias("by_extra"))
        best = F.least(by_class, F.col("by_extra"))
        new = mine.join(by_extra, "id", "left").withColumn("new", F.coalesce(best["label"], F.col("label")))
        state = written.cut(new.select("id", "cls", "own", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("changed")))
        if state.filter("changed").isEmpty():
            return state.select("id", F.col("label").alias("community_id"))
        state = state.drop("changed")
    raise RuntimeError(f"labels did not settle in {max_rounds} rounds")


def _class_hops(sums: _Sums, sources: DataFrame) -> DataFrame:
    """(source, id, dist) of everything the sources (id, or source, id: all that start at once) reach by kept edges, level by level.

    A source sends from each class and into each class once, however many of its clients are
    there; corrections are followed one by one. A neighbour of the current level is on it, on the
    one before, or new, so vertices are compared with two levels only.
    """
    spark = sources.sparkSession
    levels, sent, entered = (Levels(spark, name, "dist") for name in ("hops", "sent", "entered"))
    of_class = sums.members.select("id", "cls").filter("cls is not null")
    start = sources.select("source" if "source" in sources.columns else F.col("id").alias("source"), "id")
    front, before, level = levels.write(start, 0), None, 0
    while not front.isEmpty():
        out = front.join(of_class, "id").select("source", F.col("cls").alias("a")).distinct()
        out = sent.write(out if not level else out.join(sent.all(), ["source", "a"], "left_anti"), level)
        into = out.join(sums.pairs.select("a", "b"), "a").select("source", "b").distinct()
        into = entered.write(into if not level else into.join(entered.all(), ["source", "b"], "left_anti"), level)
        near = into.join(of_class, into["b"] == of_class["cls"]).select("source", "id").unionByName(
            front.join(sums.corrections, front["id"] == F.col("src")).select("source", F.col("dst").alias("id"))
        ).distinct()
        known = front if before is None else front.unionByName(before)
        level += 1
        before, front = front, levels.write(near.join(known, ["source", "id"], "left_anti"), level)
    return levels.all()


def _linked_by_hubs(g: ClassGraph, most: int = FIRST_SOURCES) -> DataFrame | None:
    """(source, id): the ``most`` largest groups of clients with one large hub, or the same two if an edge needs two.

    Any two of a group are linked. There are none where an edge needs three hubs or more. Groups are numbered -1, -2, ...
    """
    least = g.kept_pairs.agg(F.min("shared")).first()[0]
    if least is None or least > 2 or g.class_hubs is None:
        return None
    held = g.class_hubs.select("cls", F.col("hub").alias("h1"))
    other = g.class_hubs.select("cls", F.col("hub").alias("h2"))
    held = held.join(other, "cls").filter("h1 < h2" if least == 2 else "h1 = h2")
    n = g.members.filter("cls is not null").groupBy("cls").agg(F.count("*").alias("n"))
    largest = held.join(n, "cls").groupBy("h1", "h2").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h1", "h2").limit(most)
    numbered = largest.select("h1", "h2", (-F.row_number().over(Window.orderBy(F.desc("n"), "h1", "h2"))).cast("long").alias("source"))
    return g.members.join(held.join(F.broadcast(numbered), ["h1", "h2"]).select("cls", "source"), "cls").select("source", "id")


@on_numbers()
def merged_diameter(g: ClassGraph) -> DataFrame:
    """One row (diameter, exact, sources, nodes): the longest shortest path, in hops, of the largest component (ties: the first name).

    Clients of a class whom no correction links change places freely, so one of them searches for all.
    Groups of clients that large hubs link with each other search first, each as a whole: a client is no
    farther from any other than from a group, one hop inside it, and from there on. Few clients
    are left that may have a longer path, and those are searched from one by one.
    """
    g = g.only_edges()
    sums = _Sums(g, by_weight=False)
    inside = cut(largest_component(merged_components(g)).select("id"), "largest")
    linked = sums.corrections.filter("src <> dst").select(F.col("src").alias("id")).distinct()
    alike = g.members.filter("cls is not null").join(linked, "id", "left_anti").groupBy("cls").agg(F.min("id").alias("id")).select("id")
    searching = inside.join(linked.unionByName(alike), "id", "left_semi")
    degree = sums(g.members.select("id", F.lit(1.0).alias("x")), "x").join(searching, "id")
    size = inside.count()
    vertices = cut(degree.select("id", F.col("total").cast("long").alias("degree")), "searching")
    groups = _linked_by_hubs(g)
    if groups is not None:
        reach = _class_hops(sums, groups.join(inside, "id", "left_semi"))
        ecc = reach.groupBy("source").agg(F.max("dist").alias("ecc"))
        vertices = vertices.join(reach.join(ecc, "source").groupBy("id").agg(F.min(F.col("dist") + 1 + F.col("ecc")).alias("upper")), "id", "left")
    found = settled_diameter(vertices, lambda s: _class_hops(sums, s), size)
    return found.withColumn("nodes", F.lit(size).cast("long"))
