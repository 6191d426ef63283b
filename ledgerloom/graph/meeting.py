"""Which clients of the merged graph meet in smaller hubs or by transfers, beyond what their classes say.

Such pairs grow with the square of a hub. They are written out only for queries that list them
(:meth:`Meeting.listed`). Sums over them are added up in cells, where two blocks of clients meet,
and only the sums leave a cell. What decides whether an edge exists is fewer still: a pair of
classes that share enough large hubs is linked anyway, so only clients of the other pairs of
classes have to meet (:meth:`Meeting.edges`).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_PARTITIONS, cut

PRODUCTS_PER_CELL = 4_000_000  # pairs of all hubs, about, that one cell adds up at a time
PRODUCTS_PER_SUM = 400_000_000  # that one cell may have in all, where it returns sums only
FEWEST_BLOCKS = 16  # up to which cells are small, so that all cores have some
HUBS_PER_BLOCK = 4_000_000  # hubs of all clients of a block
OPPOSITE = 4096  # clients that a part of a block is compared with at a time
BITS = 62  # large hubs of one word, as sums of their bits stay positive
PRODUCTS_PER_TASK = 8_000_000
FEW = 4  # one in this many products, at most, is worth a join instead of cells


def least_shared(min_weight: float) -> int:
    """How many shared hubs make an edge without a transfer; one at least."""
    least = 1
    while np.log1p(least) < min_weight:
        least += 1
    return least


def _met(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, extra) of a cell, part by part: rows of the table that share hubs, each two once, and the number of hubs."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    block = table["block"].to_numpy()
    own = np.repeat(np.arange(table.num_rows), pc.list_value_length(table["hubs"]).to_numpy())
    hubs, hub = np.unique(pc.list_flatten(table["hubs"]).to_numpy(), return_inverse=True)
    ends = [np.flatnonzero(block == b) for b in (low, high)]
    place = np.zeros(table.num_rows, np.int64)
    place[ends[1]] = np.arange(len(ends[1]))
    mine = block[own] == low
    left_hub, left_row = hub[mine], own[mine]
    theirs = block[own] == high
    right_hub, right_place = hub[theirs], place[own[theirs]]
    order = np.argsort(right_place // OPPOSITE * len(hubs) + right_hub, kind="stable")
    right_hub, right_place = right_hub[order], right_place[order]
    starts = np.searchsorted(right_place // OPPOSITE, np.arange(-(-len(ends[1]) // OPPOSITE) + 1))
    for part, (i, j) in enumerate(zip(starts[:-1], starts[1:])):
        y_in = right_place[i:j] - part * OPPOSITE
        count = np.bincount(right_hub[i:j], minlength=len(hubs))
        begin = np.cumsum(count) - count
        n = count[left_hub]
        if low == high:  # a client meets those behind it only
            n = np.where(place[left_row] < (part + 1) * OPPOSITE, n, 0)
        used = np.flatnonzero(n)
        n, row, first = n[used], left_row[used], begin[left_hub[used]]
        total = np.cumsum(n)
        k = 0
        while k < len(used):
            # Whole clients, up to the bound.
            done = total[k - 1] if k else 0
            end = min(int(np.searchsorted(total, done + PRODUCTS_PER_CELL)), len(used) - 1)
            end = int(np.searchsorted(row, row[end], "right"))
            m = n[k:end]
            kind = np.int32 if (row[end - 1] - row[k] + 1) * OPPOSITE < 2**31 else np.int64
            x = np.repeat(((row[k:end] - row[k]) * OPPOSITE).astype(kind), m)
            at = np.arange(total[end - 1] - done) + np.repeat(first[k:end] - (total[k:end] - m - done), m)
            codes = np.sort(x + y_in[at].astype(kind))
            new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            extra = np.diff(np.append(new, len(codes)))
            codes = codes[new].astype(np.int64)
            x, y = codes // OPPOSITE + row[k], codes % OPPOSITE + part * OPPOSITE
            k = end
            if low == high:
                behind = place[x] < y
                x, y, extra = x[behind], y[behind], extra[behind]
            yield x, ends[1][y], extra


def _cell_sums(table: pa.Table, min_weight: float, by: str) -> pa.Table:
    """What pairs that meet in hubs change: sums of edges (d) and weights (w) per id, or per two communities."""
    table = table.sort_by("block") if table.num_rows else table
    words = np.stack([table[c].to_numpy().astype(np.uint64) for c in table.column_names if c.startswith("word")], axis=1)
    most = int(pc.max(pc.list_value_length(table["hubs"])).as_py() or 0) + BITS * words.shape[1]
    weight = np.log1p(np.arange(most + 1))
    kept = weight >= min_weight
    kept[0] = False
    weight[~kept] = 0.0
    one = kept.astype(np.float64)
    keys, at = np.unique(table[by].to_numpy(), return_inverse=True)
    pairs = by != "id"
    size = len(keys) ** 2 if pairs else len(keys)
    dense = not pairs or size <= PRODUCTS_PER_CELL
    sums, found = np.zeros((2, size if dense else 0)), []
    for x, y, extra in _met(table):
        of_class = np.zeros(len(x), np.int64)
        for j in range(words.shape[1]):
            of_class += np.bitwise_count(words[x, j] & words[y, j])
        changes = one[of_class + extra] - one[of_class], weight[of_class + extra] - weight[of_class]
        if not pairs:
            for s, change in zip(sums, changes):
                s += np.bincount(at[x], change, size)
                s += np.bincount(at[y], change, size)
        elif dense:
            codes = at[x] * len(keys) + at[y]
            for s, change in zip(sums, changes):
                s += np.bincount(codes, change, size)
        else:
            codes, where = np.unique(at[x] * len(keys) + at[y], return_inverse=True)
            found.append((codes, *(np.bincount(where, change) for change in changes)))
    if pairs and not dense:
        codes, *sums = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    else:
        codes = np.flatnonzero((sums[0] != 0) | (sums[1] != 0))
        sums = [s[codes] for s in sums]
    names = {"id": keys[codes]} if not pairs else dict(zip(("c", "e"), (keys[k] for k in np.divmod(codes, len(keys)))))
    return pa.table(names | {"d": sums[0], "w": sums[1]})


@dataclass
class Meeting:
    own: DataFrame  # hub, id, n_clients: all hubs, by number
    classes: DataFrame  # id, cls
    pairs: DataFrame  # a, b, shared, weight: pairs of classes
    sent: DataFrame  # src, dst, p2p_weight, p2p_count by number, src <= dst
    large: int
    min_weight: float
    listing: object = field(repr=False)  # () -> all corrections
    written: dict = field(default_factory=dict, repr=False)

    def listed(self) -> DataFrame:
        """All corrections."""
        if "listed" not in self.written:
            self.written["listed"] = self.listing()
        return self.written["listed"]

    @cached_property
    def small(self) -> DataFrame:
        return self.own.filter((F.col("n_clients") >= 2) & (F.col("n_clients") <= self.large)).select("hub", "id")

    @cached_property
    def _words(self) -> list[str]:
        n = self.own.filter(F.col("n_clients") > self.large).select("hub").distinct().count()
        return [f"word{i}" for i in range(max(1, -(-n // BITS)))]

    @cached_property
    def clients(self) -> DataFrame:
        """(id, cls, word0, ...): the large hubs of all clients as bits."""
        own = self.own.filter(F.col("n_clients") > self.large)
        hubs = own.select("hub").distinct().collect()  # each has more than a tenth of all clients, or is named by the caller
        bits = self.own.sparkSession.createDataFrame([(r.hub, i // BITS, i % BITS) for i, r in enumerate(sorted(hubs))], "hub long, word int, bit int")
        rows = own.join(F.broadcast(bits), "hub")
        one = F.expr("shiftleft(1L, bit)")
        words = rows.groupBy("id").agg(*[F.coalesce(F.sum(F.when(F.col("word") == i, one)), F.lit(0)).cast("long").alias(w) for i, w in enumerate(self._words)])
        everyone = self.own.select("id").union(self.sent.select("src")).union(self.sent.select("dst")).distinct()
        return cut(everyone.join(self.classes, "id", "left").join(words, "id", "left").na.fill(0, self._words), "client-words")

    def _of_class(self, x: str = "x", y: str = "y") -> Column:
        shared = F.lit(0)
        for w in self._words:
            shared = shared + F.bit_count(F.col(f"{x}.{w}").bitwiseAND(F.col(f"{y}.{w}")))
        return shared.cast("int")

    @cached_property
    def transfers(self) -> DataFrame:
        """``sent`` with the hubs that both sides share: extra (smaller ones) and of_class (large ones); 0 for transfers to oneself."""
        of = lambda end: self.small.select("hub", F.col("id").alias(end))
        apart = self.sent.filter("src <> dst")
        extra = apart.select("src", "dst").join(of("src"), "src").join(of("dst"), ["dst", "hub"]).groupBy("src", "dst").agg(F.count("*").alias("n"))
        words = F.struct(*self._words)
        both = (
            apart.join(self.clients.select(F.col("id").alias("src"), words.alias("x")), "src")
            .join(self.clients.select(F.col("id").alias("dst"), words.alias("y")), "dst")
            .withColumn("of_class", self._of_class()).join(extra, ["src", "dst"], "left")
            .select(*self.sent.columns, F.coalesce("n", F.lit(0)).cast("int").alias("extra"), "of_class")
        )
        zero = F.lit(0).cast("int")
        return cut(both.unionByName(self.sent.filter("src = dst").select(*self.sent.columns, zero.alias("extra"), zero.alias("of_class"))), "transfer-hubs")

    # --- edges that no pair of classes implies ------------------------------------------------

    def _alone(self) -> DataFrame:
        """(id): of every two clients whose classes don't imply their edge, one at least."""
        n = cut(self.classes.groupBy("cls").agg(F.count("*").alias("n")), "class-sizes")
        kept = self.pairs.filter(F.col("shared") >= least_shared(self.min_weight)).select("a", "b")
        kept = cut(kept.unionByName(kept.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))), "kept-classes")
        open_ = n.select(F.col("cls").alias("a"), F.col("n").alias("na")).join(kept.groupBy("a").agg(F.count("*").alias("k")), "a", "left")
        open_ = cut(open_.filter(F.coalesce("k", F.lit(0)) < n.count()).select("a", "na"), "open-classes")
        apart = open_.crossJoin(open_.select(F.col("a").alias("b"), F.col("na").alias("nb"))).filter("a <= b").join(kept, ["a", "b"], "left_anti")
        fewer = F.when(F.struct("na", "a") <= F.struct("nb", "b"), F.col("a")).otherwise(F.col("b"))
        poor = apart.select(fewer.alias("cls")).distinct()
        return self.clients.filter("cls is null").select("id").unionByName(self.clients.join(poor, "cls", "left_semi").select("id"))

    def edges(self) -> DataFrame:
        """The corrections that are edges while their pair of classes is none, or the other way round; all others leave the edges as they are."""
        if "edges" not in self.written:
            self.written["edges"] = self._edges()
        return self.written["edges"]

    def _edges(self) -> DataFrame:
        least = least_shared(self.min_weight)
        alone = cut(self._alone().withColumn("alone", F.lit(True)), "alone")
        rows = cut(self.small.join(alone, "id", "left").select("hub", "id", F.coalesce("alone", F.lit(False)).alias("alone")), "meeting-clients")
        sizes = rows.groupBy("hub").agg(F.count("*").cast("double").alias("n"), F.count_if("alone").alias("k"))
        products, every = sizes.agg(F.sum(F.col("n") * F.col("k")), F.sum(F.col("n") * F.col("n"))).first()
        if (products or 0.0) * FEW > (every or 0.0):
            return self.listed().filter((F.col("base") == 0) != (F.col("weight") < self.min_weight))
        carried = cut(rows.join(self.clients.drop("cls"), "id").select("hub", F.struct("id", *self._words).alias("v"), "alone"), "carried")
        tasks = max(1, min(MAX_PARTITIONS, int((products or 0) // PRODUCTS_PER_TASK) + 1))
        one = carried.filter("alone").select("hub", F.col("v").alias("x")).repartition(tasks, "hub")
        other = carried.select("hub", F.col("v").alias("y"), "alone")
        # Two who are both alone meet once.
        met = one.join(other, "hub").filter("x.id <> y.id and (not alone or x.id < y.id)").withColumn("of_class", self._of_class()).filter(F.col("of_class") < least)
        met = met.groupBy(F.least("x.id", "y.id").alias("src"), F.greatest("x.id", "y.id").alias("dst")).agg(
            F.count("*").cast("int").alias("extra"), F.max("of_class").alias("of_class"))
        sent = self.transfers
        plain = met.join(sent.select("src", "dst"), ["src", "dst"], "left_anti").withColumns(
            {"p2p_weight": F.lit(None).cast("double"), "p2p_count": F.lit(None).cast("long")})
        both = plain.unionByName(sent.select(*plain.columns))
        no_class, shared = F.lit(None).cast("long"), F.col("extra") + F.col("of_class")
        made = both.select(
            "src", "dst", no_class.alias("a"), no_class.alias("b"), shared.cast("long").alias("shared"),
            (F.log1p(shared) + F.coalesce("p2p_weight", F.lit(0.0))).alias("weight"), F.when(shared > 0, "shared").otherwise("p2p").alias("layer"), "p2p_count",
            F.when(F.col("of_class") >= least, F.log1p("of_class")).otherwise(0.0).alias("base"),
        )
        return cut(made.filter((F.col("base") == 0) != (F.col("weight") < self.min_weight)), "edges-beyond-classes")

    # --- sums ----------------------------------------------------------------------------------

    def _sums(self, clients: DataFrame, by: str, schema: str) -> DataFrame:
        n = self.small.groupBy("hub").agg(F.count("*").cast("double").alias("n"))
        products, rows = n.agg(F.sum(F.col("n") * F.col("n")), F.sum("n")).first()
        products, rows = products or 0.0, rows or 0.0
        at_least = max(np.sqrt(products / PRODUCTS_PER_SUM), rows / HUBS_PER_BLOCK)
        blocks = max(1, int(np.ceil(max(at_least, min(FEWEST_BLOCKS, np.sqrt(products / PRODUCTS_PER_CELL))))))
        hubs = self.small.groupBy("id").agg(F.collect_list("hub").alias("hubs"))
        dealt = cut(hubs.join(clients, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), "dealt-clients")
        cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "hubs", by, *self._words)
        tasks = min(MAX_PARTITIONS, blocks * (blocks + 1) // 2)
        min_weight = self.min_weight

        def run(table: pa.Table) -> pa.Table:
            return _cell_sums(table, min_weight, by)

        return cells.repartition(tasks, "low", "high").groupBy("low", "high").applyInArrow(run, schema)

    def _of_transfers(self) -> DataFrame:
        """(src, dst, d, w): what a transfer changes beyond the hubs that its sides share."""
        plain = F.log1p(F.col("extra") + F.col("of_class"))
        whole = plain + F.coalesce("p2p_weight", F.lit(0.0))
        was, now = (plain >= self.min_weight) & (F.col("extra") + F.col("of_class") > 0), whole >= self.min_weight
        d = now.cast("int").cast("double") - was.cast("int").cast("double")
        w = F.when(now, whole).otherwise(0.0) - F.when(was, plain).otherwise(0.0)
        return self.transfers.select("src", "dst", d.alias("d"), w.alias("w"))

    def by_id(self) -> DataFrame:
        """(id, d, w): what all corrections change in a client's number and weight of edges. A loop counts once."""
        sent = self._of_transfers()
        ends = sent.select(F.col("src").alias("id"), "d", "w").unionByName(sent.filter("src <> dst").select(F.col("dst").alias("id"), "d", "w"))
        found = self._sums(self.clients, "id", "id long, d double, w double").unionByName(ends)
        return found.groupBy("id").agg(F.sum("d").alias("d"), F.sum("w").alias("w"))

    def by_community(self, membership: DataFrame) -> DataFrame:
        """(c, e, d, w), c <= e: the same between communities of ``membership`` (id, community_id); null is outside of all and first."""
        codes = cut(membership.select("community_id").distinct().withColumn("c", F.monotonically_increasing_id()), "communities")
        of = self.clients.select("id", *self._words).join(membership.join(codes, "community_id").select("id", "c"), "id", "left").na.fill(-1, ["c"])
        of = cut(of, "community-clients")
        end = lambda e, c: of.select(F.col("id").alias(e), F.col("c").alias(c))
        sent = self._of_transfers().join(end("src", "c"), "src").join(end("dst", "e"), "dst").select("c", "e", "d", "w")
        found = self._sums(of, "c", "c long, e long, d double, w double").unionByName(sent).groupBy("c", "e").agg(F.sum("d").alias("d"), F.sum("w").alias("w"))
        named = lambda c, k: codes.select(F.col("c").alias(c), F.col("community_id").alias(k))
        found = found.join(named("c", "k1"), "c", "left").join(named("e", "k2"), "e", "left")
        first = F.col("k1").isNull() | (F.col("k1") <= F.col("k2"))
        low, high = F.when(first, F.col("k1")).otherwise(F.col("k2")), F.when(first, F.col("k2")).otherwise(F.col("k1"))
        return found.groupBy(low.alias("c"), high.alias("e")).agg(F.sum("d").alias("d"), F.sum("w").alias("w"))
