"""Filter interaction audit: what each filter removes in every order, from relations of failing ids.

One id table is written per filter: the rows that fail it. What filter f removes after a set S of
others is that table without the ids of S's tables, so all sets are reached by left-anti joins:
one relation holds a row per (filter, set before it, removed id), and joining it with the table of
one more filter gives the sets with that filter. Five joins cover the 80 pairs of a filter and a
set. What an order does at a step depends on the set before it only, so orders are looked up in
the counts, which are by part and as many as there are parts.

Rows that pass everything never enter a join; ids are row numbers, so no join has a hot key.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import WHITE, query, split_words, table

MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
MARKS = r"[#$%&*|]"
COPY = "E"  # the filter that compares texts; the others look at one text
HOT_SHARE = 10_000  # texts with more than 1/10,000 of all rows each, so as many at most, are broadcast


def text_filters(text: str = "text") -> dict[str, Column]:
    """Failure conditions on the text alone; ``text`` must not be null."""
    t = F.col(text)
    words = split_words(t, WHITE)
    upper = F.octet_length(t) - F.octet_length(F.regexp_replace(t, "[A-Z]+", ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        "C": 100 * upper.cast("long") > MAX_UPPER_PERCENT * F.length(t).cast("long"),
        "D": t.rlike(MARKS),
    }


def _copies(rows: DataFrame) -> DataFrame:
    """Row numbers of ``rows`` (number, doc_id, sum) whose text a smaller doc_id has, too."""
    groups = rows.groupBy("sum").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    groups = cut(groups.filter("most > least"), "copies")  # texts of one id only fail nobody
    bound = max(1, rows.count() // HOT_SHARE)
    hot, rest = groups.filter(F.col("n") > bound), groups.filter(F.col("n") <= bound)
    by_hot = rows.join(F.broadcast(hot), "sum")
    by_rest = rows.join(F.broadcast(hot.select("sum")), "sum", "left_anti").join(rest, "sum")
    return by_hot.unionByName(by_rest).filter("doc_id > least").select("number")


def failing_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> tuple[DataFrame, dict[str, DataFrame]]:
    """The written rows (number, doc_id, part) and one table of failing (number, doc_id, part) per filter.

    Null texts are empty, null parts are the empty string. Rows without an id are never copies and
    make none; rows that share an id aren't copies of each other.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    named = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text.alias("text")
    )
    rows = cut(
        named.select(
            F.monotonically_increasing_id().alias("number"), "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("sum"),
            *[failed.alias(name) for name, failed in text_filters().items()],
        ),
        "audited",
    )
    own = rows.select("number", "doc_id", "part")
    failing = {name: cut(own.filter(rows[name]), f"fails-{name}") for name in text_filters()}
    copies = cut(_copies(rows.select("number", "doc_id", "sum")), "fails")
    failing[COPY] = cut(own.join(copies, "number", "left_semi"), f"fails-{COPY}")
    return own, failing


def removals(failing: dict[str, DataFrame]) -> DataFrame:
    """(filter, before, number, doc_id, part): ``filter`` removes the row after the filters of the set ``before``.

    ``before`` is the string of the set's letters in their order in ``failing``.
    """
    removed = reduce(
        DataFrame.unionByName, [t.select(F.lit(f).alias("filter"), F.lit("").alias("before"), "*") for f, t in failing.items()]
    )
    for f, t in failing.items():
        others = removed.filter(F.col("filter") != f)
        left = others.join(t.select("number"), "number", "left_anti").withColumn("before", F.concat("before", F.lit(f)))
        removed = cut(removed.unionByName(left), f"removed-{f}")
    return removed


def orders(names: list[str]) -> list[tuple[str, int, str, str]]:
    """(filter_order, step, filter, before) of all orders; ``before`` in the order of ``names``."""
    return [
        ("".join(p), i + 1, f, "".join(sorted(p[:i], key=names.index)))
        for p in permutations(names) for i, f in enumerate(p)
    ]


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """A row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    * Null and empty texts are alike: they fail A, and E if a smaller id's text is empty.
    * Repeated rows count as often as they occur; rows that share an id aren't copies of each other.
    * ``labels`` (doc_id, quality, toxic) may repeat ids: a document is good or toxic if any row says so.
      One without an id is neither.
    * An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows, failing = failing_ids(docs, id_col, text_col, part_col)
    names = list(failing)
    removed = removals(failing)
    key = ["part", "filter", "before"]
    counts = removed.groupBy(*key).agg(F.count("*").alias("removed"))
    for name, marked in (("good_lost", "quality"), ("toxic_lost", "toxic")):
        ids = labels.filter(F.col(marked) == 1).select("doc_id")
        lost = removed.join(ids, "doc_id", "left_semi").groupBy(*key).agg(F.count("*").alias(name))
        counts = counts.join(lost, key, "left")
    counts = cut(counts, "counts")  # at most 80 rows a part

    plan = F.broadcast(spark.createDataFrame(orders(names), "filter_order string, step int, filter string, before string"))
    parts = rows.groupBy("part").agg(F.count("*").alias("docs"))
    every = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(o, ("f", "b"))]) for o in sorted({(f, b) for _, _, f, b in orders(names)})])
    # All (filter, set) pairs of a part, with zeros where nothing is removed.
    full = (
        parts.withColumn("pair", F.explode(every)).select("part", "docs", F.col("pair.f").alias("filter"), F.col("pair.b").alias("before"))
        .join(counts, key, "left").fillna(0, ["removed", "good_lost", "toxic_lost"])
    )
    of_filter = Window.partitionBy("part", "filter")
    last = F.length("before") == len(names) - 1
    alone = full.select(
        "*", F.max(F.when(F.col("before") == "", F.col("removed"))).over(of_filter).alias("failed"),
        F.max(F.when(last, F.col("removed"))).over(of_filter).alias("unique_fails"),
    )
    each = alone.join(plan, ["filter", "before"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return each.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("docs") - F.sum("removed").over(so_far)).alias("kept"), "removed", (F.col("failed") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", F.sum("removed").over(of_filter).alias("shapley"),
    )


SQL = r"""
with d as materialized (
  select coalesce(source, '') as part, coalesce(text, '') as t, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
f as materialized (
  select part,
         len(ws) < 50 as a, 100 * len(list_distinct(ws)) < 65 * len(ws) as b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) as c,
         regexp_matches(t, '[#$%&*|]') as d, coalesce(doc_id > min(doc_id) over (partition by t), false) as e,
         doc_id in (select doc_id from labels where quality = 1) as good,
         doc_id in (select doc_id from labels where toxic = 1) as tox from d),
g as materialized (
  select part, if(a, 'A', '') || if(b, 'B', '') || if(c, 'C', '') || if(d, 'D', '') || if(e, 'E', '') as fails,
         count(*) as n, count(*) filter (where good) as good, count(*) filter (where tox) as tox from f group by all),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select p.x || q.x || r.x || s.x || u.x as filter_order from l p, l q, l r, l s, l u
      where len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
k as (select filter_order, cast(unnest(range(1, 6)) as int) as step from o),
j as (
  select part, filter_order, step, filter_order[step] as filter, n, good, tox, fails,
         contains(fails, filter_order[step]) as hit,
         length(translate(fails, filter_order[:step - 1], '')) = length(fails) as open,
         length(translate(fails, filter_order[:step], '')) = length(fails) as stays
  from g cross join k),
m as (
  select part, filter_order, step, filter, cast(sum(if(stays, n, 0)) as bigint) as kept,
         cast(sum(if(hit and open, n, 0)) as bigint) as removed, cast(sum(if(hit and not open, n, 0)) as bigint) as redundant,
         cast(sum(if(fails = filter, n, 0)) as bigint) as unique_fails,
         cast(sum(if(hit and open, good, 0)) as bigint) as good_lost, cast(sum(if(hit and open, tox, 0)) as bigint) as toxic_lost
  from j group by all)
select * exclude (filter), cast(sum(removed) over (partition by part, filter) as bigint) as shapley from m
"""


@query("op11_filter_audit", SQL)
def op11_filter_audit(spark, sf):
    return audit(table(spark, sf, "documents"), table(spark, sf, "labels"))
