"""N-gram Jaccard join with skipped index blocks and answers derived from similar sets.

A document's set is its distinct word n-grams as 64-bit codes in code order. The code range is
divided into more blocks than two linked sets may differ in (plus some slack for empty blocks),
so linked sets agree exactly in at least one block that isn't empty. An index list holds the sets
that agree in one block of one size class; every block in which two sets differ is skipped unseen.

1. Equal sets are one class (64-bit code of the set).
2. Each index list is read once, in code order, as a stream. Its first and last set are leaders,
   and every other set becomes a candidate of theirs. Candidates pass a parity sketch, whose
   distance never exceeds that of the sets, and are then compared in full.
3. Lists whose sets are linked into one component by now need no more. In the others, sets of
   different components meet. A set that was compared with a leader derives its answers from
   the leader's: it differs from a third set by at least the leader's sketch distance to it less
   its own distance to the leader. Only pairs which that bound leaves open get their sketches
   compared, and their sets after that: first the nearest of each component, then all that
   still reach over two components.

Nothing is capped: a list of any length is read, and no pair that could be linked is left out.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..graph.components import connected_components
from ..session import cut
from .common import WHITE, free_name, keep_rows, query, release, row_code, table, texts
from .shingles import mix, shingle_sets, slices

SHINGLE = 4
PERCENT = 85
BROADCAST_ROWS = 1_000_000  # row codes (8 bytes) that may be broadcast
SALTS = 16


@dataclass(frozen=True)
class Link:
    """Two sets link when 100 * common >= percent * union."""

    percent: int = PERCENT

    def common(self, total):
        """Fewest common members of two linked sets of ``total`` members together."""
        return -(-self.percent * total // (100 + self.percent))

    def differ(self, total):
        """Most members in which such sets differ."""
        return total - 2 * self.common(total)

    def differ_at_most(self, smaller: int) -> int:
        """Most members in which linked sets differ, the smaller of which has up to ``smaller`` members."""
        return (smaller + 100 * smaller // self.percent) * (100 - self.percent) // (100 + self.percent)

    def classes(self, largest: int) -> np.ndarray:
        """Smallest size of each size class; of linked sets the larger one is in the smaller one's class or near it."""
        ratio = 100 / self.percent
        out = [1]
        while out[-1] <= largest:
            out.append(max(out[-1] + 1, int(np.ceil(out[-1] * ratio))))
        return np.array(out + [max(out[-1] + 1, int(np.ceil(out[-1] * ratio)))], dtype=np.int64)


@functools.lru_cache(65536)
def slack(differ: int, size: int) -> int:
    """Blocks beyond ``differ`` + 1, so many that unlike sets of ``size`` members meet in the fewest lists.

    With few, sets leave more blocks empty than that and meet in the lists of empty blocks. With many,
    blocks are short, and sets meet where they have nothing but a member of a line that both contain.
    """
    def meetings(spare: int) -> float:
        blocks = differ + 1 + spare
        load = size / blocks
        alone = math.exp(-load)
        spread = math.sqrt(blocks * alone * (1 - (1 + load) * alone)) + 1e-9
        exceed = math.erfc((spare + 0.5 - blocks * alone) / spread / math.sqrt(2)) / 2
        return exceed**2 * blocks * alone**2 + 10 * alone**2

    tried, spare = [], 1
    while spare <= 5 + differ:
        tried.append(spare)
        spare += 1 + spare // 16
    return min(tried, key=meetings)


def index_keys(codes: np.ndarray, link: Link, bounds: np.ndarray) -> list[np.ndarray]:
    """Keys of the index lists that a set of sorted codes is in.

    The lists of a size class bring sets of that class together with each other and with the larger
    sets that they may link with, so a set is in its own class and in those of smaller partners.
    The smaller partner's size bounds the differences, which keeps blocks few and long.
    """
    n = len(codes)
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    least = int(np.searchsorted(bounds, -(-link.percent * n // 100), side="right")) - 1
    out = []
    for c in range(max(least, 0), own + 1):
        differ = link.differ_at_most(int(bounds[c + 1]) - 1)
        if not differ:
            continue  # only equal sets link
        spare = slack(differ, int(bounds[c]))
        blocks = differ + 1 + spare
        block = ((codes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        sums = np.add.reduceat(mix(codes), starts)
        place = block[starts] + np.uint64(c << 40)
        out.append(mix(sums + mix(place)))
        if blocks - len(starts) > spare:  # so many empty blocks that only those may agree
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), block[starts])
            out.append(mix(mix(empty + np.uint64(c << 40)) + np.uint64(1)))
    return out


def sketch(codes: np.ndarray) -> bytes:
    """Parity of the codes in each of two to four times as many cells as the set has members (a power of two)."""
    cells = max(64, 2 << (len(codes) - 1).bit_length())
    return np.packbits(np.bincount((mix(codes) & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint8) & 1,
                       bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """A sketch of fewer bytes: cells that agree modulo the new number of cells add up."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def distances(one: bytes, others: list[bytes]) -> np.ndarray:
    """Sketch distances; never above the number of members in which the sets differ."""
    a = np.frombuffer(one, np.uint8)
    out = np.empty(len(others), np.int64)
    by_size: dict[int, list[int]] = {}
    for i, o in enumerate(others):
        by_size.setdefault(len(o), []).append(i)
    for size, where in by_size.items():
        b = np.frombuffer(b"".join([others[i] for i in where]), np.uint8).reshape(len(where), size)
        least = min(size, len(a))
        out[where] = np.bitwise_count(fold(b, least) ^ fold(a, least)).sum(axis=1)
    return out


# --- tasks -----------------------------------------------------------------------------------


def _signed(x) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64).view(np.int64)


def _set_code(codes: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(codes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sets = list(shingle_sets(batch.column("text").to_pylist(), n))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "row": batch.column("row"),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "set": pa.array([_set_code(s) if len(s) else None for s in sets], pa.int64()),
                    "bits": pa.array([sketch(s) if len(s) else None for s in sets], pa.binary()),
                })

    return run


def _entries(n: int, link: Link, largest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = link.classes(largest)
        for whole in batches:
            for batch in slices(whole):
                seen, keys, sets = set(), [], []
                for s in shingle_sets(batch.column("text").to_pylist(), n):
                    if not len(s) or (code := _set_code(s)) in seen:
                        continue
                    seen.add(code)
                    for k in index_keys(s, link, bounds):
                        keys.append(k)
                        sets.append(np.full(len(k), code, np.int64))
                if keys:
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(_signed(np.concatenate(keys))), "set": pa.array(np.concatenate(sets)),
                    })

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From entries in order of (key, set): members of lists with two sets or more, and leader pairs.

    A list may reach over any number of batches: its first set is kept, and its last set of all is
    seen when the next key begins; between, only the set before the current one is held.
    """
    carry_key, first, previous = None, None, None  # of the list that the last batch ended in
    size = 0
    pairs: set[tuple[int, int]] = set()
    for batch in batches:
        key, sets = batch.column("key").to_numpy(), batch.column("set").to_numpy()
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (sets[1:] != sets[:-1])))
        if carry_key is not None and key[0] == carry_key and sets[0] == previous:
            new[0] = False
        key, sets = key[new], sets[new]
        if not len(key):
            continue
        joined = carry_key is not None and key[0] == carry_key
        start = np.concatenate(([not joined], key[1:] != key[:-1]))
        group = np.cumsum(start) - (0 if joined else 1)  # group 0 continues the carried list if joined
        lead = np.empty(int(group[-1]) + 1, np.int64)
        lead[group[start]] = sets[start]
        if joined:
            lead[0] = first
        count = np.bincount(group)
        if joined:
            count[0] += size
        open_end = np.zeros(len(key), bool)
        open_end[group == group[-1]] = True  # the list that may go on
        several = (count[group] > 1) | open_end
        member_key, member_set = key[several], sets[several]
        out_lead = (lead[group] != sets)
        a, b = lead[group][out_lead], sets[out_lead]
        # the last set of each closed list leads as well
        tail = np.concatenate((key[1:] != key[:-1], [False]))
        last = np.zeros(int(group[-1]) + 1, np.int64)
        last[group[tail]] = sets[tail]
        closed = group < group[-1]
        c, d = sets[closed], last[group[closed]]
        c, d = c[c != d], d[c != d]
        both = np.concatenate((np.stack((a, b)), np.stack((c, d))), axis=1) if len(a) + len(c) else np.empty((2, 0), np.int64)
        both = np.sort(both, axis=0)
        both = np.unique(both, axis=1)
        yield pa.RecordBatch.from_pydict({
            "key": pa.array(np.concatenate((member_key, np.zeros(both.shape[1], np.int64)))),
            "a": pa.array(np.concatenate((member_set, both[0]))),
            "b": pa.array(np.concatenate((member_set, both[1]))),
        })
        same = group == group[-1]
        if not (joined and group[-1] == 0):
            first, size = int(lead[-1]), 0
        size += int(same.sum())
        carry_key, previous = key[-1], int(sets[-1])


def _pair_distances(one: list[bytes], other: list[bytes]) -> np.ndarray:
    """Sketch distances of pairs, all pairs of the same two sketch sizes at once."""
    out = np.empty(len(one), np.int64)
    sizes: dict[tuple[int, int], list[int]] = {}
    for i, (a, b) in enumerate(zip(one, other)):
        sizes.setdefault((len(a), len(b)), []).append(i)
    for (la, lb), where in sizes.items():
        a = np.frombuffer(b"".join([one[i] for i in where]), np.uint8).reshape(-1, la)
        b = np.frombuffer(b"".join([other[i] for i in where]), np.uint8).reshape(-1, lb)
        least = min(la, lb)
        out[where] = np.bitwise_count(fold(a, least) ^ fold(b, least)).sum(axis=1)
    return out


def _may_link(link: Link, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(na, nb) >= link.percent * np.maximum(na, nb)


def _near(link: Link):
    """Pairs whose sketches don't rule out a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            ok = np.flatnonzero(_may_link(link, na, nb))
            t = batch.take(pa.array(ok))
            d = _pair_distances(t.column("bits_a").to_pylist(), t.column("bits_b").to_pylist())
            ok = np.flatnonzero(d <= link.differ(na[ok] + nb[ok]))
            yield t.select(["a", "b"]).take(pa.array(ok))

    return run


def _codes(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sets = [s for s in shingle_sets(batch.column("text").to_pylist(), n) if len(s)]
                yield pa.RecordBatch.from_pydict({
                    "set": pa.array([_set_code(s) for s in sets], pa.int64()),
                    "codes": pa.array([s.tobytes() for s in sets], pa.binary()),
                })

    return run


def _compare(link: Link):
    """From rows in order of (a, salt, b), the leader's own (b null) first: linked pairs and in how many members they differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, head = None, np.empty(0, np.uint64)
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            codes = batch.column("codes")
            for i, (a, b) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                mine = np.frombuffer(codes[i].as_buffer(), np.uint64)
                if b is None:
                    leader, head = a, mine.copy()
                    continue
                assert leader == a, "the leader's row comes first"
                at = np.searchsorted(head, mine)
                at[at == len(head)] = len(head) - 1
                common = int((head[at] == mine).sum())
                total = len(head) + len(mine)
                if 100 * common >= link.percent * (total - common):
                    out.append((a, b, total - 2 * common))
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in zip(("a", "b", "differ"), columns)})

    return run


def _list_pairs(t: dict[str, np.ndarray], bits: list[bytes], link: Link) -> np.ndarray:
    """Open pairs of one list of any length as (row, row, distance), row by row of all components but the largest."""
    sets, comp, n = t["set"], t["comp"], t["n"]
    names, where, count = np.unique(comp, return_inverse=True, return_counts=True)
    largest = int(np.argmax(count))
    position = {int(s): i for i, s in enumerate(sets)}
    lead = np.array([position.get(int(x), -1) for x in t["lead"]], np.int64)  # -1: the leader isn't in this list
    head = lead < 0
    out = [np.empty((3, 0), np.int64)]
    for i in np.flatnonzero(where != largest):
        others = np.flatnonzero(((where == largest) | (where > where[i])) & (where != where[i]) & _may_link(link, n, n[i]))
        if not len(others):
            continue
        allowed = link.differ(n + n[i])
        heads = others[head[others]]
        used = np.unique(np.concatenate((heads, lead[others[~head[others]]])))
        to_head = np.full(len(sets), -1, np.int64)
        to_head[used] = distances(bits[i], [bits[j] for j in used])
        close = heads[to_head[heads] <= allowed[heads]]
        rest = others[~head[others]]
        rest = rest[to_head[lead[rest]] - t["differ"][rest] <= allowed[rest]]  # derived from the leader's answer
        to_rest = distances(bits[i], [bits[j] for j in rest])
        ok = to_rest <= allowed[rest]
        found, apart = np.concatenate((close, rest[ok])), np.concatenate((to_head[close], to_rest[ok]))
        out.append(np.stack((np.full(len(found), i), found, apart)))
    return np.concatenate(out, axis=1)


SHORT = 32  # lists up to here are paired by offset, many lists at once


def _nearest(pairs: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Of the pairs (row, row, distance), one for each component: its nearest."""
    a, b, apart = pairs
    ends = np.concatenate((comp[a], comp[b]))
    which = np.tile(np.arange(len(a)), 2)
    order = np.lexsort((which, apart[which], ends))
    first = np.concatenate(([True], ends[order][1:] != ends[order][:-1]))
    return pairs[:, np.unique(which[order[first]])]


def _open_pairs(link: Link, nearest: bool):
    """From members in order of key: pairs of different components whose sketches don't rule out a link.

    With ``nearest``, one for each component of a batch; most links that join components are among
    them, and a later call without it finds the others.
    """

    def pairs(t: pa.Table) -> pa.RecordBatch:
        c = {k: t.column(k).to_numpy() for k in ("key", "set", "comp", "n", "lead", "differ")}
        bits = t.column("bits").to_pylist()
        start = np.flatnonzero(np.concatenate(([True], c["key"][1:] != c["key"][:-1])))
        size = np.diff(np.append(start, len(c["key"])))
        short = np.repeat(size <= SHORT, size)
        found = [np.empty((3, 0), np.int64)]
        for d in range(1, min(int(size.max()), SHORT)):
            i = np.flatnonzero(short[:-d] & (c["key"][d:] == c["key"][:-d]) & (c["comp"][d:] != c["comp"][:-d]))
            i = i[_may_link(link, c["n"][i], c["n"][i + d])]
            apart = _pair_distances([bits[k] for k in i], [bits[k + d] for k in i])
            near = apart <= link.differ(c["n"][i] + c["n"][i + d])
            found.append(np.stack((i[near], i[near] + d, apart[near])))
        for s, k in zip(start[size > SHORT], size[size > SHORT]):
            inside = _list_pairs({x: v[s:s + k] for x, v in c.items()}, bits[s:s + k], link)
            found.append(inside + np.array([[s], [s], [0]]))
        rows = np.concatenate(found, axis=1)
        if nearest and rows.shape[1]:
            rows = _nearest(rows, c["comp"])
        both = np.unique(np.sort(c["set"][rows[:2]], axis=0), axis=1)
        return pa.RecordBatch.from_pydict({"a": pa.array(both[0], pa.int64()), "b": pa.array(both[1], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # batches of the list that may go on
        for batch in batches:
            key = batch.column("key").to_numpy()
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last or (held and held[-1].column("key")[0].as_py() != key[0]):
                whole = pa.Table.from_batches([*held, batch.slice(0, last)])
                if whole.num_rows:
                    yield pairs(whole.combine_chunks())
                held = []
            held.append(batch.slice(last))
        if held:
            yield pairs(pa.Table.from_batches(held).combine_chunks())

    return run


# --- operator --------------------------------------------------------------------------------


class Join:
    """The steps over one table; intermediate tables are written to the shared folder."""

    def __init__(self, docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str):
        self.link, self.shingle = Link(percent), shingle
        self.rows = texts(docs, id_col, text_col).withColumn("row", row_code())
        schema = f"doc_id {self.rows.dtypes[0][1]}, row long, n long, set long, bits binary"
        self.sketches = cut(self.rows.mapInArrow(_sketches(shingle), schema), "sketches")
        self.sets = cut(
            self.sketches.filter("set is not null").groupBy("set")
            .agg(F.min("row").alias("row"), F.min("n").alias("n"), F.first("bits").alias("bits")),
            "sets",
        )
        self.largest = self.sets.agg(F.max("n")).first()[0] or 1

    def lists(self) -> DataFrame:
        """(key, a, b): a list's member (a = b), or a candidate pair (a < b) of a leader and another set."""
        entries = self.rows.select("text").mapInArrow(_entries(self.shingle, self.link, self.largest), "key long, set long")
        dealt = entries.repartition("key").sortWithinPartitions("key", "set")
        return cut(dealt.mapInArrow(_lists, "key long, a long, b long"), "lists")

    def near(self, pairs: DataFrame) -> DataFrame:
        one = self.sets.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a"))
        other = self.sets.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b"))
        return pairs.join(one, "a").join(other, "b").mapInArrow(_near(self.link), "a long, b long")

    def compared(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, differ) of the pairs that do link, by comparing whole sets."""
        pairs = cut(pairs, f"{name}-pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
        wanted = cut(ends.join(self.sets.select("set", "row"), "set").select("row"), f"{name}-rows")
        if wanted.count() <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        codes = cut(
            self.rows.join(wanted, "row", "left_semi").select("text").mapInArrow(_codes(self.shingle), "set long, codes binary"),
            f"{name}-codes",
        )
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
        members = salted.join(codes.withColumnRenamed("set", "b"), "b").select("a", "salt", "b", "codes")
        heads = salted.select("a", "salt").distinct().join(codes.withColumnRenamed("set", "a"), "a").select(
            "a", "salt", F.lit(None).cast("long").alias("b"), "codes"
        )
        dealt = members.unionByName(heads).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
        return cut(dealt.mapInArrow(_compare(self.link), "a long, b long, differ long").dropDuplicates(["a", "b"]), f"{name}-links")

    def components(self, links: DataFrame) -> DataFrame:
        """(set, comp) of all sets that link with another."""
        found = connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1.0).alias("weight")))
        return found.select(F.col("id").alias("set"), F.col("component").alias("comp"))

    def still_open(self, members: DataFrame, comps: DataFrame) -> DataFrame:
        """(key, set, comp) of the lists whose sets are in two components or more."""
        named = members.select("key", "set").join(comps, "set", "left").withColumn("comp", F.coalesce("comp", "set"))
        keys = (
            named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
            .filter("low != high").select("key")
        )
        return cut(named.join(keys, "key"), "open")

    def open_pairs(self, members: DataFrame, links: DataFrame, nearest: bool) -> DataFrame:
        answers = links.groupBy(F.col("b").alias("set")).agg(F.min("a").alias("lead")).join(
            links.select(F.col("b").alias("set"), F.col("a").alias("lead"), "differ"), ["set", "lead"]
        )
        rows = (
            members.join(self.sets.select("set", "n", "bits"), "set").join(answers, "set", "left")
            .select("key", "set", "comp", "n", F.coalesce("lead", "set").alias("lead"), F.coalesce("differ", F.lit(0)).alias("differ"), "bits")
        )
        # A set without a leader, or that leads itself, is compared directly.
        rows = rows.withColumn("lead", F.when(F.col("lead") == F.col("set"), F.lit(None).cast("long")).otherwise(F.col("lead")))
        rows = rows.withColumn("lead", F.coalesce("lead", F.lit(0)))
        dealt = rows.repartition("key").sortWithinPartitions("key", "comp", "set")
        return dealt.mapInArrow(_open_pairs(self.link, nearest), "a long, b long").distinct()

    def run(self) -> DataFrame:
        """(doc_id, row, n, component): each row of the table, and the smallest id that links reach from it."""
        spark = self.rows.sparkSession
        lists = self.lists()
        release(spark)
        leaders = lists.filter("a < b").select("a", "b").distinct()
        links = self.compared(self.near(leaders), "leaders")
        comps = cut(self.components(links), "first")
        members = lists.filter("a = b").select("key", F.col("a").alias("set"))
        for step, nearest in (("near", True), ("open", False)):
            members = self.still_open(members, comps)  # lists that are settled don't come back
            release(spark)
            if members.isEmpty():
                break
            more = self.compared(self.open_pairs(members, links, nearest), step)
            if not more.isEmpty():
                links = links.unionByName(more)
                comps = cut(self.components(links), f"{step}-components")
        named = self.sketches.join(comps, "set", "left").withColumn("comp", F.coalesce("comp", "set"))
        smallest = named.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component"))
        return named.join(smallest, "comp", "left").select(
            "doc_id", "row", "n", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component")
        )


def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, row, n_shingles, component_id.

    * Null, empty and blank texts have no shingle, link with nothing and are their own component.
    * A text of fewer words than ``shingle`` is one shingle of all its words.
    * Repeated rows and ids are one row each; equal sets are linked. A null id is never smallest.
    * An empty table gives no rows. Other columns are not read.
    """
    return Join(docs, shingle, percent, id_col, text_col).run().select(
        "doc_id", "row", F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id, then the smallest row code. Columns stay.

    Rows without shingles all stay. Of rows that agree in id and text, one stays; which of them is
    not defined.
    """
    found = components(docs, shingle, percent, id_col, text_col).filter("n_shingles > 0")
    # The kept row of a component: among rows with its id, the smallest code. A null id is kept only where no row has one.
    own = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = own.groupBy(F.col("component_id").alias("kept_id")).agg(F.min("row").alias("kept_row"), F.count("*").alias("times"))
    kept = cut(kept, "kept")
    judged = found.join(kept, F.col("component_id").eqNullSafe(F.col("kept_id")), "left")
    is_kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("row") == F.col("kept_row"))
    gone = judged.filter(~is_kept).select("doc_id", F.col("row").alias("code")).distinct()
    left = keep_rows(docs, gone, id_col, text_col)
    if kept.filter("times > 1").isEmpty():
        return left
    # Some kept rows may be there more than once, with equal id and text.
    number, code = free_name(left, "_number"), free_name(left, "_code")
    numbered = left.withColumn(code, row_code(id_col, text_col))
    one = F.row_number().over(Window.partitionBy(F.col(f"`{id_col}`"), code).orderBy(F.lit(0)))
    blank = F.coalesce(F.length(F.regexp_replace(F.col(f"`{text_col}`"), WHITE, "")), F.lit(0)) == 0
    return numbered.withColumn(number, one).filter((F.col(number) == 1) | blank).drop(number, code)


@query("op10_jaccard_join")
def op10_jaccard_join(spark, sf):
    return components(table(spark, sf, "documents")).drop("row")
