"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``VNODES`` points on a ring of 64-bit hashes. A row belongs to the first point at
or after the hash of its key. Each shard takes at most its share of the rows (shares differ by
one at most); rows that a full shard can't take go on clockwise to the next point whose shard has
room. Only row counts by arc (shards x VNODES numbers) reach the driver, which lays out who
takes how many rows of which arc; a row finds its place by its rank within its arc.
"""

from __future__ import annotations

import bisect
import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .common import query, ranked, table, texts

SHARDS = 8
VNODES = 128


@dataclass
class Ring:
    points: list[int]  # sorted signed 64-bit hashes
    owners: list[int]  # shard of each point


def ring(shards: int, vnodes: int = VNODES) -> Ring:
    """The points depend on the shard's number alone: a new shard adds points and moves none."""
    made = {}
    for s in range(shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"shard {s} point {v}".encode(), digest_size=8).digest()
            made[int.from_bytes(digest, "little", signed=True)] = s
    points = sorted(made)
    return Ring(points, [made[p] for p in points])


def arc_of(points: list[int], code: int) -> int:
    """Index of the first point at or after ``code``, around the ring."""
    return bisect.bisect_left(points, code) % len(points)


def shares(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def layout(arcs: dict[int, int], r: Ring, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rows, shard, first slot): first what fits at home, then the rest clockwise."""
    room = shares(sum(arcs.values()), shards)
    taken = [0] * shards
    done = {a: 0 for a in arcs}
    out = []

    def take(arc: int, shard: int) -> None:
        n = min(arcs[arc] - done[arc], room[shard])
        if n:
            out.append((arc, done[arc], n, shard, taken[shard]))
            done[arc] += n
            taken[shard] += n
            room[shard] -= n

    for arc in sorted(arcs):
        take(arc, r.owners[arc])
    for arc in sorted(arcs):
        point = arc
        while done[arc] < arcs[arc]:
            point = (point + 1) % len(r.owners)
            take(arc, r.owners[point])
    return out


def shard(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Row counts of shards differ by one at most (law ``rows``); slots count from 0 in each shard.
    Rows that share an id share an arc, and each still has a slot of its own. Null ids hash like
    any key, null texts count as empty, and an empty table gives no rows. ``grown_shard`` is
    null: it belongs to another law.
    """
    if shards < 1 or vnodes < 1:
        raise ValueError("shards and vnodes must be positive")
    r = ring(shards, vnodes)
    points = np.array(r.points, dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def arc(code: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(points, code.to_numpy(np.int64)) % len(points)).astype(np.int32))

    text = F.coalesce("text", F.lit(""))
    placed = cut(
        texts(docs, id_col, text_col).select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("doc_id").alias("code"),
            F.monotonically_increasing_id().alias("number"),
        ).withColumn("arc", arc("code")),
        "shards",
    )
    counts = {x.arc: x.n for x in placed.groupBy("arc").agg(F.count("*").alias("n")).collect()}  # shards * vnodes at most
    plan = docs.sparkSession.createDataFrame(
        [(a, f, f + n, s, slot - f) for a, f, n, s, slot in layout(counts, r, shards)],
        "arc int, first long, past long, shard int, shift long",
    )
    rows = ranked(placed, "arc", "number", sum(counts.values()), ["code"], "rank")
    # The plan has a row or a few per arc, whatever the data's size.
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")) & (rows["arc"] == plan["arc"])
    return rows.join(F.broadcast(plan), inside).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("rank") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_ring_shards")
def op7_ring_shards(spark, sf):
    return shard(table(spark, sf, "documents"))
