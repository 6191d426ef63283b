"""Counts, shares, distributions and rankings used by reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

# Fixed value: label of the bucket that gathers everything beyond the largest groups.
OTHER = "Другие"


def group_counts(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Occurrences per value, NULL skipped."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))


def max_multiplicity(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, max_count): how often the commonest value of each column occurs."""
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    return (
        df.select(named.alias("c"))
        .select("c.column_name", "c.value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count("*").alias("n"))
        .groupBy("column_name").agg(F.max("n").alias("max_count"))
    )


def shares(counts: DataFrame, n: str = "n") -> DataFrame:
    """Counts with their share of the total (a scalar subquery, not a one-task window)."""
    return counts.withColumn("share", F.col(n) / counts.agg(F.sum(n)).scalar())


def largest_share(counts: DataFrame, n: str = "n") -> DataFrame:
    return counts.agg((F.max(n) / F.sum(n)).alias("largest_share"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std, min, quartiles, max of a column of group sizes.

    ``percentile`` keeps one counter per distinct value. Sizes that sum to N have at most
    sqrt(2 N) distinct values; other columns belong to :func:`quantiles`.
    """
    value = F.col(col)
    return df.agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.percentile(value, 0.25).alias("q25"),
        F.percentile(value, 0.5).alias("q50"),
        F.percentile(value, 0.75).alias("q75"),
        F.max(value).alias("max"),
    )


def quantiles(df: DataFrame, group: str, col: str, probs: dict[str, float], decimals: int = 2) -> DataFrame:
    """Exact interpolated quantiles per group without gathering a group in one task.

    Values are taken as integers of ``10**-decimals``. The first level counts them in buckets
    of 2**20, the second looks only inside the buckets that hold the wanted ranks. A window
    partition has at most 2**20 rows (for amounts up to 10**10), whatever the size of the
    group. Result: ``group`` and one column per entry of ``probs``.
    """
    return _quantiles(value_table(df.filter(F.col(col).isNotNull()), group, col, decimals), group, probs, decimals)


def value_table(df: DataFrame, group: str, col: str, decimals: int = 2) -> DataFrame:
    """(group, v, n, total, low, high) per group and value in units of ``10**-decimals``; rows without a group are left out.

    Written once: everything that follows reads this table instead of the rows. Missing values are one
    row per group with a null ``v`` and n = 0.
    """
    value = F.col(col)
    return cut(
        df.filter(F.col(group).isNotNull())
        .groupBy(F.col(group), F.round(value * 10**decimals).cast("long").alias("v"))
        .agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high")),
        "values",
    )


def _quantiles(base: DataFrame, group: str, probs: dict[str, float], decimals: int) -> DataFrame:
    unit = F.lit(10**decimals)
    base = base.filter("v is not null").select(group, "v", "n")
    totals = base.groupBy(group).agg(F.sum("n").alias("total"))
    position = F.create_map(*[F.lit(x) for k, p in probs.items() for x in (k, float(p))])
    wanted = totals.select(
        group,
        F.explode(F.array(*[F.lit(k) for k in probs])).alias("prob"),
        "total",
    ).withColumn("pos", position[F.col("prob")] * (F.col("total") - 1))
    # Both neighbours of the fractional position, as ranks counted from 0.
    wanted = wanted.select(
        group, "prob", (F.col("pos") - F.floor("pos")).alias("frac"),
        F.explode(F.array(F.struct(F.lit("lo").alias("end"), F.floor("pos").alias("rank")),
                          F.struct(F.lit("hi").alias("end"), F.ceil("pos").alias("rank")))).alias("r"),
    ).select(group, "prob", "frac", F.col("r.end").alias("end"), F.col("r.rank").alias("rank"),
             F.lit(0).cast("long").alias("prefix"))

    for shift in (20, 0):
        parent = F.shiftright("v", 20) if shift == 0 else F.lit(0).cast("long")
        buckets = base.groupBy(group, parent.alias("prefix"), F.shiftright("v", shift).alias("bucket")).agg(
            F.sum("n").alias("n")
        )
        buckets = buckets.join(wanted.select(group, "prefix").distinct(), [group, "prefix"], "left_semi")
        inside = Window.partitionBy(group, "prefix").orderBy("bucket")
        spans = buckets.withColumn("upto", F.sum("n").over(inside)).withColumn("below", F.col("upto") - F.col("n"))
        wanted = (
            wanted.join(spans, [group, "prefix"])
            .filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("upto")))
            .select(group, "prob", "frac", "end", (F.col("rank") - F.col("below")).alias("rank"),
                    F.col("bucket").alias("prefix"))
        )
    ends = wanted.groupBy(group, "prob", "frac").agg(
        F.max(F.when(F.col("end") == "lo", F.col("prefix") / unit)).alias("lo"),
        F.max(F.when(F.col("end") == "hi", F.col("prefix") / unit)).alias("hi"),
    )
    value = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    return ends.groupBy(group).agg(*[F.max(F.when(F.col("prob") == k, value)).alias(k) for k in probs])


def group_statistics(df: DataFrame, group: str, col: str) -> DataFrame:
    """mean, median, min, max and count per group; rows without a group are left out."""
    base = value_table(df, group, col)
    plain = base.groupBy(group).agg(
        F.try_divide(F.sum("total"), F.sum("n")).alias("mean"), F.min("low").alias("min"), F.max("high").alias("max"), F.sum("n").alias("count")
    )
    return plain.join(_quantiles(base, group, {"median": 0.5}, 2), group, "left")


def histogram(df: DataFrame, value: Column, bins: int) -> DataFrame:
    """(bin, low, high, n): equal-width bins over the range of ``value``, empty ones included.

    The last bin is closed on the right. A constant column gets a range of 1 around it.
    """
    values = df.select(value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    span = values.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    flat = F.col("a") == F.col("b")
    span = span.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("b"),
    )
    low, high = span.select("a").scalar(), span.select("b").scalar()
    width = (high - low) / bins
    counts = values.groupBy(F.least(F.floor((F.col("x") - low) / width), F.lit(bins - 1)).alias("bin")).agg(
        F.count("*").alias("n")
    )
    spark = df.sparkSession
    return (
        spark.range(bins).withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * width).alias("low"),
            (low + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("n", F.lit(0).cast("long")).alias("n"),
        )
    )


def mix(df: DataFrame, group: str, kind: str, values: list[str]) -> DataFrame:
    """One column per value with its share within the group; absent ones are 0."""
    counts = df.filter(F.col(group).isNotNull() & F.col(kind).isNotNull()).groupBy(group).pivot(kind, values).count().fillna(0)
    total = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    return counts.select(group, *[(F.col(v) / total).alias(v) for v in values])


def dominant(df: DataFrame, group: str, kind: str, name: str = "dominant") -> DataFrame:
    """The commonest value per group; ties go to the smallest value."""
    return (
        df.filter(F.col(group).isNotNull() & F.col(kind).isNotNull())
        .groupBy(group, kind).agg(F.count("*").alias("n"))
        .groupBy(group).agg(F.min(F.struct(-F.col("n"), F.col(kind).alias("value"))).alias("best"))
        .select(group, F.col("best.value").alias(name))
    )


def top_per_group(df: DataFrame, group: str, by: str, tie: str, k: int) -> DataFrame:
    """The first ``k`` rows per group by ``by`` descending.

    A rank filter over row_number lets each map task forward at most ``k`` rows per group.
    """
    order = Window.partitionBy(group).orderBy(F.desc(by), tie)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The ``k`` commonest values; equal counts by value."""
    return value_counts(df, col).orderBy(F.desc("n"), col).limit(k)


def top_with_other(counts: DataFrame, key: str, n: str, k: int = 10, other: str = OTHER) -> DataFrame:
    """The ``k`` largest groups and one row that gathers all others, when there are any."""
    top = counts.orderBy(F.desc(n), key).limit(k).select(key)
    label = F.broadcast(top.withColumn("label", F.col(key).cast("string")))
    return counts.join(label, key, "left").groupBy(F.coalesce("label", F.lit(other)).alias(key)).agg(F.sum(n).alias(n))


def distinct_per_key(df: DataFrame, key: str, col: str, name: str = "n") -> DataFrame:
    """Distinct values of ``col`` per key: first one row per (key, value), then a plain count."""
    return (
        df.filter(F.col(key).isNotNull() & F.col(col).isNotNull())
        .select(key, col).distinct().groupBy(key).agg(F.count("*").alias(name))
    )


def min_max_scale(df: DataFrame, col: str, low: float, high: float, name: str) -> DataFrame:
    """``col`` moved linearly to [low, high]; a constant column maps to ``low``."""
    span = df.agg(F.min(col).alias("a"), F.max(col).alias("b"))
    a, b = span.select("a").scalar(), span.select("b").scalar()
    return df.withColumn(name, F.lit(low) + F.coalesce(F.try_divide(F.col(col) - a, b - a), F.lit(0.0)) * (high - low))


def spend_over_time(tx: DataFrame, unit: str, top: int = 10, rows: int | None = None) -> DataFrame:
    """Summed amount per time unit and client, for the ``top`` clients by total amount.

    ``rows`` keeps only the largest sums, as a chart with a row limit does.
    """
    spenders = tx.groupBy("client_id").agg(F.sum("amount").alias("t")).orderBy(F.desc("t"), "client_id").limit(top)
    out = (
        tx.join(F.broadcast(spenders.select("client_id")), "client_id", "left_semi")
        .groupBy(F.date_trunc(unit, F.col("datetime").cast("timestamp")).alias("period"), "client_id")
        .agg(F.sum("amount").alias("sum_amount"))
    )
    return out if rows is None else out.orderBy(F.desc("sum_amount"), "period", "client_id").limit(rows)


def transactions_per_community(fact: DataFrame, limit: int | None = None) -> DataFrame:
    """Row counts by community; ``limit`` keeps the largest, as a chart with a row limit does."""
    counts = fact.groupBy("community_id").agg(F.count("*").alias("tx_count"))
    return counts if limit is None else counts.orderBy(F.desc("tx_count"), F.asc_nulls_last("community_id")).limit(limit)
