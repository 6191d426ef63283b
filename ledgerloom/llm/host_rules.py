"""Quality rules of documents, and of the hosts that they come from.

A document fails on its own text. Failures are summed by host, and each host's failure rate is
shrunk towards all hosts by a beta prior fitted to them by moments, so that a host with few
documents isn't judged by one or two of them. A host whose shrunk rate exceeds ``max_rate``
loses all its documents. Everything is a DataFrame expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import WHITE, query, split_words, table

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_RATE = 0.5
PRIOR_ROWS = (1.0, 1e6)  # the prior weighs as much as so many documents, at least and at most


def _repeated(triples: Column, words: Column) -> Column:
    """Sorted (code, at) of windows whose neighbour in code order has the same three words."""

    def same(a, b):
        equal = (a["code"] == b["code"]) & b.isNotNull()
        for k in range(3):
            equal = equal & (F.get(words, a["at"] + k) == F.get(words, b["at"] + k))
        return F.coalesce(equal, F.lit(False))

    return F.filter(triples, lambda x, j: same(x, F.get(triples, j - 1)) | same(x, F.get(triples, j + 1)))


def _covered(places: Column) -> Column:
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    return F.aggregate(
        places, start,
        lambda acc, p: F.struct(
            (acc["n"] + (p + 3 - F.greatest(acc["reach"], p))).alias("n"), (p + 3).alias("reach")
        ),
    )["n"]


def document_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: doc_id, host, counts of its text, base_failed.

    Null and empty texts have no words and fail. Windows are told apart by hash, and equal
    hashes by their words. Repeated rows stay; other columns of ``docs`` are not read.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").alias("host"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("words", split_words(F.col("text"), WHITE))
    rows = rows.withColumn("lines", F.filter(F.split("text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    rows = rows.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    n = F.size("codes")
    code = lambda i: F.xxhash64(F.get("codes", i), F.get("codes", i + 1), F.get("codes", i + 2))
    made = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(code(i).alias("code"), i.alias("at")))
    none = F.array().cast("array<struct<code:bigint,at:int>>")
    rows = rows.withColumn("triples", F.when(n >= 3, F.sort_array(made)).otherwise(none))
    rows = rows.withColumn("repeated", _repeated(F.col("triples"), F.col("words")))
    n_words = F.size("words").cast("long")
    n_repeat = _covered(F.sort_array(F.col("repeated")["at"]))
    counted = rows.select(
        "doc_id", "host", n_words.alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"),
    )
    too_much = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | too_much)


@dataclass
class Prior:
    alpha: float
    beta: float


def fit_prior(hosts: DataFrame) -> Prior:
    """Beta prior of the hosts' failure rates by moments; ``hosts`` has docs and failed per host."""
    rate = F.col("failed") / F.col("docs")
    row = hosts.agg(
        F.sum("docs").alias("n"), F.sum("failed").alias("f"), F.sum(F.col("docs") * rate * rate).alias("sq")
    ).first()
    if not row.n:
        return Prior(0.5, 0.5)
    mean = row.f / row.n
    spread = row.sq / row.n - mean * mean
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR_ROWS[1]
    weight = min(max(weight, PRIOR_ROWS[0]), PRIOR_ROWS[1])
    return Prior(mean * weight, (1 - mean) * weight)


def host_verdicts(rules: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """(host, host_docs, host_failed, host_rejected). Documents without a host give none."""
    hosts = rules.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("docs"), F.count(F.when(F.col("base_failed"), 1)).alias("failed")
    )
    prior = fit_prior(hosts)
    shrunk = (F.col("failed") + prior.alpha) / (F.col("docs") + (prior.alpha + prior.beta))
    return hosts.select(
        "host", F.col("docs").alias("host_docs"), F.col("failed").alias("host_failed"), (shrunk > max_rate).alias("host_rejected")
    )


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          max_rate: float = MAX_RATE) -> DataFrame:
    """Rules of every document and ``kept``: it passes, and its host isn't rejected.

    A document without a host is judged by its text alone. The counts are written once and used
    for the hosts and for the result.
    """
    rules = cut(document_rules(docs, id_col, text_col, host_col), "rules")
    joined = rules.join(host_verdicts(rules, max_rate), "host", "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"), "host", "host_docs", "host_failed",
    )


SQL = r"""
with d as materialized (
  select doc_id, source as host, coalesce(text, '') as text, row_number() over () as r,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
l as (select r, line, count(*) as n from (select r, unnest(string_split(text, chr(10))) as line from d)
      where regexp_matches(line, '[^\x20\x09-\x0D]') group by r, line),
dup as (select r, sum(n - 1) as n from l group by r),
w as materialized (select r, i, ws[i] || chr(0) || ws[i + 1] || chr(0) || ws[i + 2] as g
                   from (select r, ws, unnest(range(1, len(ws) - 1)) as i from d where len(ws) >= 3)),
rep as (select r, count(distinct p) as n from
          (select r, unnest(range(i, i + 3)) as p from (select r, i, count(*) over (partition by r, g) as n from w) where n > 1)
        group by r),
f as materialized (
  select doc_id, host, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
  from d left join dup using (r) left join rep using (r)),
b as materialized (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f),
h as materialized (select host, count(*) as docs, count(*) filter (where base_failed) as failed from b where host is not null group by host),
m as (select sum(failed) / sum(docs) as mean, sum(failed * 1.0 * failed / docs) / sum(docs) as sq from h),
p as (select mean, least(greatest(case when sq - mean * mean > 0 then mean * (1 - mean) / (sq - mean * mean) - 1 else 1e6 end, 1), 1e6) as k from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce((failed + mean * k) / (docs + k) > 0.5, false) as kept,
       b.host, docs as host_docs, failed as host_failed
from b left join h on b.host = h.host cross join p
"""


@query("op8_host_rules", SQL)
def op8_host_rules(spark, sf):
    return judge(table(spark, sf, "documents"))
