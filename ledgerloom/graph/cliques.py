"""A graph of cliques that overlap, and listed edges, measured without listing the pairs of a clique.

Any two clients of a hub are linked once, however many hubs they share. Clients with the same
hubs form a class, and the graph is a signed sum of cliques: every hub counts 1, and what is
counted twice is taken off, by the class for clients alike and by the pair of classes for those
that share two hubs or more. The signs of a client's cliques add up to 1, so a sum over its
neighbours is the signed sum over its cliques without its own value. Tables grow with clients,
their hubs, and pairs of classes that share several hubs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.edges import HUB_LINK, HUB_LINK_WEIGHT, MANY_HUBS, induced, listed_links
from ..session import Rounds, cut
from .classes import ClassGraph
from .class_triangles import merged_clustering
from .ids import Numbering, number_vertices


OF_HUB, OF_CLASS, OF_PAIR = 0, 1, 2  # kinds of cliques


@dataclass
class CliqueGraph:
    hubs: DataFrame  # client_id, hub: by name
    others: DataFrame  # src, dst, weight and what else listed edges have, src < dst by name; their ends share no hub
    relationship: str  # of a hub's pairs
    weight: float
    names: Numbering
    members: DataFrame  # id, cls (the smallest id of the class; null without hubs), all vertices
    class_hubs: DataFrame  # cls, hub
    groups: DataFrame  # g (four times its number, and its kind), cls, sign: the cliques in classes
    listed: DataFrame  # src, dst, weight by number

    def sizes(self) -> DataFrame:
        return self.members.filter("cls is not null").groupBy("cls").agg(F.count("*").alias("n"))

    def in_hubs(self) -> DataFrame:
        """(g, cls): the cliques that are hubs."""
        return self.groups.filter(F.col("g") % 4 == OF_HUB).select("g", "cls")

    def heard(self, values: DataFrame, x: str, *keys: str) -> DataFrame:
        """(cls, *keys, x): ``values`` (cls, *keys, x) summed over all adjacent clients and oneself."""
        of_clique = self.groups.join(values, "cls").groupBy("g", *keys).agg(F.sum(x).alias("x"))
        return self.groups.join(of_clique, "g").groupBy("cls", *keys).agg(F.sum(F.col("sign") * F.col("x")).alias(x))


def _overlaps(class_hubs: DataFrame, counts: DataFrame) -> DataFrame:
    """(a, b, more), a < b: pairs of classes that share two hubs or more, and how many beyond one.

    A class of up to MANY_HUBS hubs is looked up by its pairs of hubs, one of more hubs hub by hub.
    """
    heavy = counts.filter(F.col("m") > MANY_HUBS).select("cls")
    few = class_hubs.join(heavy, "cls", "left_anti").groupBy("cls").agg(F.array_sort(F.collect_list("hub")).alias("hubs"))
    twos = (
        few.select("cls", "hubs", F.posexplode("hubs").alias("i", "h1"))
        .select("cls", "h1", F.explode(F.expr("slice(hubs, i + 2, size(hubs))")).alias("h2"))
    )
    met = twos.withColumnRenamed("cls", "a").join(twos.withColumnRenamed("cls", "b"), ["h1", "h2"]).filter("a < b")
    k = F.count("*")
    light = met.groupBy("a", "b").agg(F.round((F.sqrt(1 + 8 * k) - 1) / 2).cast("long").alias("more"))
    own = class_hubs.join(heavy, "cls", "left_semi").select(F.col("cls").alias("a"), "hub")
    other = class_hubs.join(heavy.withColumn("many", F.lit(True)), "cls", "left").select(F.col("cls").alias("b"), "hub", "many")
    many = own.join(other, "hub").filter("a <> b and (many is null or a < b)").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return light.unionByName(many.agg((F.count("*") - 1).alias("more")).filter("more > 0"))


def clique_graph(hubs: DataFrame, others: DataFrame, relationship: str = HUB_LINK, weight: float = HUB_LINK_WEIGHT) -> CliqueGraph:
    """From ``hubs`` (client_id, hub: distinct, two clients or more in each) and ``others``, both read several times."""
    names = number_vertices(others.select("src", "dst"), hubs.select(F.col("client_id").alias("id")))
    hub_numbers = cut(hubs.select("hub").distinct().withColumn("h", F.monotonically_increasing_id()), "hub-numbers")
    own = names.number(hubs.select(F.col("client_id").alias("id"), "hub"), "id").join(hub_numbers, "hub").select("id", F.col("h").alias("hub"))
    own = cut(own, "numbered-hubs")
    signed = own.groupBy("id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("hub")).cast("array<string>"), ","), 256).alias("sig"))
    named = signed.join(signed.groupBy("sig").agg(F.min("id").alias("cls")), "sig").select("id", "cls")
    members = cut(names.names.select("id").join(named, "id", "left"), "members")
    heads = members.filter("id = cls").select("cls")
    class_hubs = cut(own.withColumnRenamed("id", "cls").join(heads, "cls"), "class-hubs")
    counts = cut(class_hubs.groupBy("cls").agg(F.count("*").alias("m")), "hub-counts")
    over = cut(_overlaps(class_hubs, counts).withColumn("p", F.monotonically_increasing_id()), "overlaps")
    more = over.select(F.explode(F.array("a", "b")).alias("cls"), "more").groupBy("cls").agg(F.sum("more").alias("more"))
    key = lambda kind, number: (F.col(number) * 4 + kind).alias("g")  # noqa: E731  # kinds of cliques have numbers of their own
    of_hubs = class_hubs.select(key(OF_HUB, "hub"), "cls", F.lit(1).cast("long").alias("sign"))
    of_classes = counts.join(more, "cls", "left").select(key(OF_CLASS, "cls"), "cls", (1 - F.col("m") + F.coalesce("more", F.lit(0))).alias("sign"))
    of_pairs = over.select(key(OF_PAIR, "p"), F.explode(F.array("a", "b")).alias("cls"), (-F.col("more")).alias("sign"))
    groups = cut(of_hubs.unionByName(of_classes.filter("sign <> 0")).unionByName(of_pairs), "cliques")
    listed = cut(names.number(others.select("src", "dst", "weight"), "src", "dst"), "numbered")
    return CliqueGraph(hubs, others, relationship, weight, names, members, class_hubs, groups, listed)


def links(g: CliqueGraph, nodes: DataFrame | None = None) -> DataFrame:
    """The edges by name as ``others`` has them, all or those among ``nodes`` (id, by name); see :func:`listed_links`."""
    return listed_links(g.hubs, g.others, g.relationship, g.weight, nodes)


def _both_ways(listed: DataFrame) -> DataFrame:
    return listed.unionByName(listed.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))


def metrics(g: CliqueGraph) -> DataFrame:
    """(id, w_degree, degree) of all vertices, by number."""
    near = g.heard(g.sizes(), "n").select("cls", (F.col("n") - 1).alias("k"))
    own = _both_ways(g.listed).groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    k = F.coalesce("k", F.lit(0))
    return g.members.join(near, "cls", "left").join(own, "id", "left").select(
        "id", (k * F.lit(g.weight) + F.coalesce("w", F.lit(0.0))).alias("w_degree"), (k + F.coalesce("n", F.lit(0))).alias("degree")
    )


def edge_count(g: CliqueGraph, nodes: DataFrame | None = None) -> DataFrame:
    """One row (edges): all edges, or those among ``nodes`` (id, by name)."""
    members, listed = g.members, g.listed
    if nodes is not None:
        chosen = cut(g.names.number(nodes.select("id"), "id"), "chosen")
        members, listed = members.join(chosen, "id", "left_semi"), induced(listed, chosen)
    sizes = members.filter("cls is not null").groupBy("cls").agg(F.count("*").alias("n"))
    of_clique = g.groups.join(sizes, "cls").groupBy("g", "sign").agg(F.sum("n").alias("n"))
    pairs = of_clique.agg(F.coalesce(F.sum(F.expr("sign * (n * (n - 1) div 2)")), F.lit(0)).alias("edges"))
    return pairs.unionByName(listed.agg(F.count("*").alias("edges"))).agg(F.sum("edges").alias("edges"))


def density(g: CliqueGraph) -> DataFrame:
    """One row: nodes, edges, density and average degree."""
    n, m = F.col("nodes"), F.col("edges")
    return edge_count(g).withColumn("nodes", g.members.agg(F.count("*")).scalar()).select(
        "nodes", "edges", F.coalesce(F.try_divide(2 * m, n * (n - 1)), F.lit(0.0)).alias("density"),
        F.coalesce(F.try_divide(2 * m, n), F.lit(0.0)).alias("avg_degree"),
    )


def _two_smallest(rows: DataFrame, key: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy("label"))
    return rows.select(key, "label").distinct().withColumn("place", place).filter("place <= 2").drop("place")


def _first_votes(g: CliqueGraph) -> DataFrame:
    """(cls, label, votes) of the round in which all labels differ and have one vote: only the two smallest can win."""
    own = _two_smallest(g.members.filter("cls is not null").select("cls", F.col("id").alias("label")), "cls")
    of_hub = _two_smallest(g.class_hubs.join(own, "cls"), "hub")
    return _two_smallest(g.class_hubs.join(of_hub, "hub"), "cls").withColumn("votes", F.lit(1).cast("long"))


def _candidates(g: CliqueGraph, of_clique: DataFrame, more: DataFrame) -> DataFrame:
    """(cls, label): every label that may be the best of a client of the class, by ``of_clique`` (g, label, x) and ``more`` (cls, n: votes from elsewhere).

    The commonest label of a class's hubs has as many votes at least, one's own off. A label that is to win
    needs as many, so in one of the class's m hubs it has an m-th of what it doesn't get from elsewhere.
    """
    hubs = g.in_hubs()
    in_hub = of_clique.filter(F.col("g") % 4 == OF_HUB)
    best = hubs.join(in_hub.groupBy("g").agg(F.max("x").alias("top")), "g").groupBy("cls").agg(F.max("top").alias("top"), F.count("*").alias("m"))
    best = best.join(more.filter("cls is not null").groupBy("cls").agg(F.max("n").alias("n")), "cls", "left")
    least = best.select("cls", "m", (F.col("top") - 1 - F.coalesce("n", F.lit(0))).alias("least"))
    return hubs.join(least, "cls").join(in_hub, "g").filter("x * m >= least").select("cls", "label").distinct()


def labels(g: CliqueGraph, rounds: int = 10, until_stable: bool = False, self_vote: bool = False) -> DataFrame:
    """(id, community_id) by number: the same simultaneous rounds as ``label_propagation`` on the listed edges.

    Cliques add up their labels once for all their classes. For a vertex only the two best labels of
    its class can win (its own vote is taken off), or one that listed edges or its own vote add to;
    votes are counted for these alone.
    """
    spark = g.members.sparkSession
    size = (g.members.agg(F.max("id")).first()[0] or 0) + 1
    extra = _both_ways(g.listed).select("src", "dst")
    if self_vote:
        extra = extra.unionByName(g.members.select(F.col("id").alias("src"), F.col("id").alias("dst")))
    written, counted, told, added = (Rounds(spark, name) for name in ("labels", "clique-labels", "votes", "extra-votes"))
    state = g.members.withColumn("label", F.col("id"))
    # Most votes first, then the smallest label, as one number.
    packed = lambda votes, label: F.when(votes > 0, votes * size + (size - 1 - label))
    for i in range(rounds):
        more = extra.join(state.select(F.col("id").alias("src"), "label"), "src").groupBy(F.col("dst").alias("id"), "label").agg(F.count("*").alias("n"))
        more = added.cut(more.join(state.select("id", "cls", F.col("label").alias("old")), "id"))
        if i:
            held = state.filter("cls is not null").groupBy("cls", "label").agg(F.count("*").alias("x"))
            of_clique = counted.cut(g.groups.join(held, "cls").groupBy("g", "label").agg(F.sum("x").alias("x")))
            votes = _candidates(g, of_clique, more).join(g.groups, "cls").join(of_clique, ["g", "label"]).groupBy("cls", "label").agg(F.sum(F.col("sign") * F.col("x")).alias("votes"))
            votes = votes.filter("votes > 0")
        else:
            votes = _first_votes(g)
        votes = told.cut(votes)
        place = F.row_number().over(Window.partitionBy("cls").orderBy(F.desc("votes"), "label"))
        top = votes.withColumn("place", place).filter("place <= 2")
        at = lambda c, k: F.max(F.when(F.col("place") == k, F.col(c)))
        two = top.groupBy("cls").agg(at("label", 1).alias("l1"), at("votes", 1).alias("v1"), at("label", 2).alias("l2"), at("votes", 2).alias("v2"))
        less = F.when(F.col("l1") == F.col("label"), 1).otherwise(0)
        by_class = F.greatest(packed(F.col("v1") - less, F.col("l1")), F.when(less == 1, packed(F.col("v2"), F.col("l2"))))
        total = F.col("n") + F.coalesce(F.col("votes") - F.when(F.col("label") == F.col("old"), 1).otherwise(0), F.lit(0))
        by_extra = more.join(votes, ["cls", "label"], "left").groupBy("id").agg(F.max(packed(total, F.col("label"))).alias("by_extra"))
        best = F.greatest(by_class, F.col("by_extra"))
        new = state.join(two, "cls", "left").join(by_extra, "id", "left").withColumn("new", F.coalesce(size - 1 - best % size, F.col("label")))
        state = written.cut(new.select("id", "cls", F.col("new").alias("label"), (F.col("new") != F.col("label")).alias("changed")))
        if until_stable and state.filter("changed").isEmpty():
            break
        state = state.drop("changed")
    else:
        if until_stable:
            raise RuntimeError(f"labels did not settle in {rounds} rounds")
    return state.select("id", F.col("label").alias("community_id"))


def pagerank(g: CliqueGraph, rounds: int = 20, reset: float = 0.15) -> DataFrame:
    """(id, influence_score) by number: ``pagerank`` of the edges from the smaller id to the larger.

    A vertex hears from those before it in each clique, which is a running sum.
    """
    rows = cut(g.groups.join(g.members, "cls").select("g", "sign", "id"), "clique-members")
    behind = Window.partitionBy("g").orderBy(F.desc("id")).rowsBetween(Window.unboundedPreceding, -1)
    after = rows.select("id", (F.col("sign") * F.count("*").over(behind)).alias("out")).unionByName(g.listed.select(F.col("src").alias("id"), F.lit(1).cast("long").alias("out")))
    nodes = cut(g.members.select("id").join(after.groupBy("id").agg(F.sum("out").alias("out")), "id").select("id", "out").unionByName(
        g.members.select("id", F.lit(0).cast("long").alias("out"))).groupBy("id").agg(F.sum("out").alias("out")), "nodes")
    before = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    zero = nodes.select("id", F.lit(0.0).alias("m"), "out")
    written = Rounds(g.members.sparkSession, "ranks")
    ranks = nodes.withColumn("rank", F.lit(1.0))
    for _ in range(rounds):
        shares = ranks.select("id", F.when(F.col("out") > 0, F.col("rank") / F.col("out")).otherwise(0.0).alias("share"))
        heard = rows.join(shares, "id").select("id", (F.col("sign") * F.sum("share").over(before)).alias("m"))
        told = g.listed.join(shares.withColumnRenamed("id", "src"), "src").select(F.col("dst").alias("id"), F.col("share").alias("m"))
        messages = heard.filter("m is not null").unionByName(told).withColumn("out", F.lit(None).cast("long"))
        ranks = written.cut(
            messages.unionByName(zero).groupBy("id").agg((F.lit(reset) + F.lit(1 - reset) * F.sum("m")).alias("rank"), F.max("out").alias("out"))
        )
    scale = ranks.agg(F.count("*") / F.sum("rank")).scalar()
    return ranks.select("id", (F.col("rank") * scale).alias("influence_score"))


def pagerank_weighted(g: CliqueGraph, rounds: int, alpha: float = 0.85) -> DataFrame:
    """(id, influence_score) by number, by weight and both ways; the scores sum to 1."""
    out = cut(metrics(g).select("id", F.col("w_degree").alias("out")).join(g.members, "id"), "out")
    n = max(1, out.count())
    both = _both_ways(g.listed)
    written = Rounds(g.members.sparkSession, "ranks")
    ranks = out.withColumn("rank", F.lit(1.0 / n))
    for _ in range(rounds):
        shares = ranks.select("id", "cls", "out", (F.col("rank") / F.col("out")).alias("share"))
        heard = g.heard(shares.filter("cls is not null").groupBy("cls").agg(F.sum("share").alias("x")), "x")
        told = both.join(shares.select(F.col("id").alias("src"), "share"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("weight") * F.col("share")).alias("m"))
        total = F.coalesce((F.col("x") - F.col("share")) * g.weight, F.lit(0.0)) + F.coalesce("m", F.lit(0.0))
        ranks = written.cut(shares.join(heard, "cls", "left").join(told, "id", "left").select("id", "cls", "out", (F.lit((1 - alpha) / n) + alpha * total).alias("rank")))
    return ranks.select("id", F.col("rank").alias("influence_score"))


def _in_cliques(g: CliqueGraph, membership: DataFrame) -> DataFrame:
    """(g, sign, community_id, n) of ``membership`` (id, community_id), by number."""
    held = g.members.filter("cls is not null").join(membership, "id").groupBy("cls", "community_id").agg(F.count("*").alias("n"))
    return cut(g.groups.join(held, "cls").groupBy("g", "sign", "community_id").agg(F.sum("n").alias("n")), "clique-communities")


def _labelled(g: CliqueGraph, membership: DataFrame) -> DataFrame:
    of = lambda end: membership.select(F.col("id").alias(end), F.col("community_id").alias(f"c_{end}"))
    return g.listed.join(of("src"), "src").join(of("dst"), "dst")


def modularity(g: CliqueGraph, membership: DataFrame) -> DataFrame:
    """One row: modularity by weight of ``membership`` (id, community_id), by number."""
    of_cliques = _in_cliques(g, membership).select("community_id", (F.expr("sign * (n * (n - 1) div 2)") * F.lit(g.weight)).alias("w"))
    more = _labelled(g, membership).filter("c_src = c_dst").select(F.col("c_src").alias("community_id"), F.col("weight").alias("w"))
    inside = of_cliques.unionByName(more).groupBy("community_id").agg(F.sum("w").alias("inside"))
    degree = cut(metrics(g).join(membership, "id").groupBy("community_id").agg(F.sum("w_degree").alias("deg")), "community-degrees")
    twice = degree.agg(F.sum("deg")).scalar()
    return degree.join(inside, "community_id", "left").agg(
        F.sum(2 * F.coalesce("inside", F.lit(0.0)) / twice - F.pow(F.col("deg") / twice, 2)).alias("modularity")
    )


def meta_graph(g: CliqueGraph, membership: DataFrame) -> DataFrame:
    """(src, dst, weight): summed weights between communities of ``membership``, src < dst, by number."""
    held = _in_cliques(g, membership)
    other = held.select("g", F.col("community_id").alias("dst"), F.col("n").alias("m"))
    met = held.withColumnRenamed("community_id", "src").join(other, "g").filter("src < dst")
    of_cliques = met.groupBy("src", "dst").agg((F.sum(F.expr("sign * n * m")) * F.lit(g.weight)).alias("weight"))
    more = _labelled(g, membership).filter("c_src <> c_dst").select(F.least("c_src", "c_dst").alias("src"), F.greatest("c_src", "c_dst").alias("dst"), "weight")
    return of_cliques.unionByName(more).groupBy("src", "dst").agg(F.sum("weight").alias("weight")).filter("weight > 0")


def near(g: CliqueGraph, drawn: DataFrame) -> DataFrame:
    """(id): ``drawn`` (id) and all their neighbours, by number."""
    hubs = g.class_hubs.join(g.members.join(drawn, "id", "left_semi").select("cls").distinct(), "cls", "left_semi").select("hub").distinct()
    classes = g.class_hubs.join(hubs, "hub", "left_semi").select("cls").distinct()
    told = _both_ways(g.listed).join(drawn.withColumnRenamed("id", "src"), "src", "left_semi").select(F.col("dst").alias("id"))
    return g.members.join(classes, "cls", "left_semi").select("id").unionByName(told).unionByName(drawn.select("id")).distinct()


def clustering(g: CliqueGraph) -> DataFrame:
    """(id, clustering) by number. Pairs of classes that share a hub are listed; they are few where clients are alike."""
    pairs = g.class_hubs.withColumnRenamed("cls", "a").join(g.class_hubs.withColumnRenamed("cls", "b"), "hub").filter("a <= b").select("a", "b").distinct()
    n = g.sizes()
    counted = pairs.join(n.select(F.col("cls").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b").select(
        "a", "b", F.lit(1).cast("long").alias("shared"), F.lit(g.weight).alias("weight"),
        F.when(F.col("a") == F.col("b"), F.expr("na * (na - 1) div 2")).otherwise(F.col("na") * F.col("nb")).alias("n_pairs"),
    )
    corrections = g.listed.select(
        "src", "dst", F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"), F.lit(0).cast("long").alias("shared"), "weight",
        F.lit("p2p").alias("layer"), F.lit(None).cast("long").alias("p2p_count"), F.lit(0.0).alias("base"),
    )
    return merged_clustering(ClassGraph(g.members, cut(counted, "class-pairs"), cut(corrections, "corrections"), 0.0))


def sampled_nodes(g: CliqueGraph, k: int = 700, seed: int = 42) -> DataFrame:
    """(id) by name: ``k`` nodes drawn by seeded hash, with their neighbours."""
    drawn = g.names.names.orderBy(F.sha2(F.concat("name", F.lit(f":{seed}")), 256), "name").limit(k).select("id")
    return g.names.named(near(g, cut(drawn, "drawn")), "id")


def named_labels(g: CliqueGraph, rounds: int = 10, until_stable: bool = False, self_vote: bool = False) -> DataFrame:
    """(id, community_id) by name."""
    return g.names.named(labels(g, rounds, until_stable, self_vote), "id", "community_id")
