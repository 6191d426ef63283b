"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Targets share a budget of words between sources by weight, none above so many times its size.
Within a source, documents are ordered by a hash of their id. The hash is uniform, so its upper
bits are ranges of that order with about equal numbers of documents, and blocks of such ranges:
sums of blocks, of ranges in a block and of documents in a range give each document's place among
its source's words, and no task holds a whole source. A budget takes whole epochs first and then
the words up to its place. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, partitions_for
from .common import WHITE, free_name, query, split_words, table

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
ROWS_PER_RANGE = 1_000
KEY_BITS = 60


def mix_key(id_col: str, seed: str = "mix") -> Column:
    """A number of ``KEY_BITS`` bits from the id; rows without an id share one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, KEY_BITS // 4), 16, 10).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with inclusive running sums in ``order``, by range partitions and the totals before them."""
    sorted_ = cut(df.repartitionByRange(partitions_for(df.count()), *order).withColumn("_range", F.spark_partition_id()), name)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    totals = sorted_.groupBy("_range").agg(*[F.sum(v).alias(f"_{c}") for c, v in sums.items()])
    starts = totals.select("_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sorted_.select("*", *[F.sum(v).over(inside).alias(c) for c, v in sums.items()]).join(starts, "_range")
    return placed.select(*df.columns, *[(F.col(c) + F.col(f"_{c}")).alias(c) for c in sums])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) of ``sizes`` (source, source_size).

    Sources in the order of their code points (null last) take the weights in turn. What a source
    can't take, since its target would be above ``epochs`` times its size, goes to the others by
    weight. In the order of size to weight, the sources that are full come first: one is full if
    the budget covers it, all before it, and as much by weight for all after it.
    """
    if not weights or min(weights) <= 0 or not 0 <= budget <= epochs:
        raise ValueError("weights must be positive, and the budget at most the epochs")
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {"_rank": F.lit(1)}, "sources")
    cycle = F.array(*[F.lit(w) for w in weights])
    limit = (epochs * F.col("source_size")).alias("limit")
    rows = ranked.select("source", "source_size", limit, F.get(cycle, (F.col("_rank") - 1) % len(weights)).alias("weight"))
    ratio = F.col("limit") / F.col("weight")
    rows = cut(
        running(
            rows, [ratio, F.col("source").asc_nulls_last()],
            {"limits": F.col("limit"), "weights": F.col("weight")}, "ratios",
        ),
        "targets",
    )
    all_ = rows.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if all_.size is None:
        return rows.select("source", "source_size", F.lit(0.0).alias("target"))
    words = budget * all_.size
    full = rows.filter(F.col("limits") + ratio * (all_.weight - F.col("weights")) <= words)
    taken = full.agg(F.coalesce(F.sum("limit"), F.lit(0)).alias("limit"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")).first()
    rest = all_.weight - taken.weight
    level = (words - taken.limit) / rest if rest else float("inf")
    return rows.select("source", "source_size", F.least(F.col("limit").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _before(of: list[str], order: str) -> Column:
    """Words of the rows before this one in ``order``, among those that agree in ``of``."""
    w = Window.partitionBy(*of).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("words").over(w), F.lit(0))


def _range_starts(ranges: DataFrame, bits: int) -> DataFrame:
    """(of, at, start): words of source ``of`` before its range ``at``. A source has about the root of
    its number of ranges in blocks, and a block as many ranges."""
    ranges = ranges.withColumn("block", F.shiftright("range", bits // 2))
    blocks = ranges.groupBy("source", "block").agg(F.sum("words").alias("words"))
    blocks = blocks.select(F.col("source").alias("of"), F.col("block").alias("in_block"), _before(["source"], "block").alias("base"))
    inside = ranges.withColumn("start", _before(["source", "block"], "range"))
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in_block"))
    return inside.join(blocks, same).select("of", F.col("range").alias("at"), (F.col("start") + F.col("base")).alias("start"))


def _taken(docs: DataFrame, weights: tuple[int, ...], budget: float, epochs: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, code, size, source_size, target, taken); rows with one code are alike."""
    doc_id, source, text = (F.col(f"`{c}`") for c in (id_col, source_col, text_col))
    rows = cut(
        docs.select(
            doc_id.alias("doc_id"), source.alias("source"), F.size(split_words(text, WHITE)).cast("long").alias("size"),
            F.xxhash64(doc_id, source, text).alias("code"), mix_key(id_col).alias("key"),
        ),
        "sizes",
    )
    bits = (rows.count() // ROWS_PER_RANGE).bit_length()
    rows = rows.withColumn("range", F.shiftright("key", KEY_BITS - bits))
    ranges = cut(rows.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    targets = source_targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, epochs)
    starts = _range_starts(ranges, bits).join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("source")
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size", "code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("upto", F.sum("size").over(inside))
    placed = placed.join(starts, (F.col("range") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
    words = F.least(F.round("target").cast("long"), epochs * F.col("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    placed = placed.withColumn("words", words).withColumn("whole", whole)
    left = F.col("words") - F.col("whole") * F.col("source_size") - (F.col("start") + F.col("upto") - F.col("size"))
    taken = F.col("whole") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select("doc_id", "source", "code", "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken.

    ``taken`` counts words, repeats included: a document of 100 words with taken 130 is used whole
    and once more up to its 30th word. A source's ``taken`` add up to its target, rounded.

    * Null and empty texts have no words and give none. Documents without a source are a source.
    * The order depends on the ids alone; equal ids are ordered by size, then by a code of the row.
      Rows equal in all are alike, so that reruns agree whatever the partitions.
    * Repeated rows are rows of their own. An empty table gives no rows. Other columns are not read.
    """
    return _taken(docs, weights, budget, epochs, id_col, text_col, source_col).drop("code")


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` once per epoch that uses it, numbered from 0 in ``epoch``.

    A text that the budget cuts ends with its last word taken, the others are whole; texts without
    words are in no mix. All columns are kept; if one is named ``epoch``, the new one gets
    underscores in front. Of rows equal in id, source and text, any may be the one that is cut.
    """
    code, nth, of, at, size, taken, epoch = (free_name(docs, c) for c in ("_code", "_nth", "_of", "_at", "_size", "_taken", "epoch"))
    mixed = cut(_taken(docs, weights, budget, epochs, id_col, text_col, source_col).filter("taken > 0").select("code", "size", "taken"), "mixed")
    repeated = not mixed.groupBy("code").count().filter("count > 1").isEmpty()
    text = F.col(f"`{text_col}`")
    rows = docs.withColumn(code, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{source_col}`"), text))
    number = lambda c, o: F.row_number().over(Window.partitionBy(c).orderBy(o)) if repeated else F.lit(1)
    rows = rows.withColumn(nth, number(code, F.lit(0)))
    own = mixed.select(F.col("code").alias(of), number("code", F.desc("taken")).alias(at), F.col("size").alias(size), F.col("taken").alias(taken))
    rows = rows.join(own, (F.col(code) == F.col(of)) & (F.col(nth) == F.col(at)))
    rows = rows.withColumn(epoch, F.explode(F.sequence(F.lit(0), (F.ceil(F.col(taken) / F.col(size)) - 1).cast("int"))))
    words = F.least(F.col(size), F.col(taken) - F.col(epoch) * F.col(size)).cast("int")
    # Words and separators in turn: the text up to its n-th word.
    runs = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return rows.withColumn(
        text_col, F.when(words == F.col(size), text).otherwise(F.array_join(F.slice(runs, F.lit(1), words), ""))
    ).drop(code, nth, of, at, size, taken)


SQL = r"""
with d as materialized (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || sha256('mix:' || coalesce(doc_id::varchar, ''))[1:15])::bigint as key from documents),
s as (select source, sum(size) as source_size, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
      from d group by source),
r as (select *, sum(2 * source_size) over z as limits, sum(w) over z as ws, sum(source_size) over () as total, sum(w) over () as all_w
      from s window z as (order by 2 * source_size / w, source nulls last rows unbounded preceding)),
f as (select *, limits + 2 * source_size / w * (all_w - ws) <= 1.5 * total as is_full from r),
t as (select source, source_size::bigint as source_size,
             least(2.0::double * source_size,
                   (1.5::double * total - coalesce(sum(2 * source_size) filter (where is_full) over (), 0))::double
                   / nullif(all_w - coalesce(sum(w) filter (where is_full) over (), 0), 0) * w)::double as target from f),
p as (select d.*, source_size, target, sum(size) over (partition by d.source order by key, doc_id nulls first, size rows unbounded preceding) as upto,
             least(round(target)::bigint, 2 * source_size) as words
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (case when source_size > 0 then words // source_size else 0 end * size
        + greatest(0, least(size, words - case when source_size > 0 then words // source_size else 0 end * source_size - (upto - size))))::bigint as taken
from p
"""


@query("op13_source_mix", SQL)
def op13_source_mix(spark, sf):
    return mix(table(spark, sf, "documents")).drop("source")
