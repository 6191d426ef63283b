"""Benchmark decontamination: find the benchmark's word windows in documents.

The windows of the benchmark items form a hash set. Every window of a document is hashed and
looked up in it; a hit counts only if the words agree as well. All steps are DataFrame
expressions: the windows are exploded and joined inside one code-generated stage, where the
words of a window are cut out only for hits.

The hash set is broadcast while the benchmark has at most ``BROADCAST_WINDOWS`` different
windows (counted first; about 300 bytes each). Above, each document window carries its words
through a shuffled join on the hash: slower, same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, folded, free_name, keep_rows, query, row_code, split_words, table, texts

WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after folding: words are a-z, 0-9 and beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_WINDOWS = 500_000


def _words(text: Column) -> Column:
    return split_words(folded(text), SEPARATORS)


def _windows(codes: Column, width: int) -> Column:
    """array<struct<at, width, code>> of all windows of ``width`` words; ``at`` counts from 1."""
    starts = F.sequence(F.lit(1), F.size(codes) - (width - 1))
    made = F.transform(
        starts,
        lambda i: F.struct(i.alias("at"), F.lit(width).alias("width"), F.xxhash64(F.slice(codes, i, width)).alias("code")),
    )
    return F.when(F.size(codes) >= width, made).otherwise(F.array().cast("array<struct<at:int,width:int,code:bigint>>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(code, width, phrase, items): each different window and the ids of the items that have it."""
    items = texts(benchmark, id_col, text_col).select(F.col("doc_id").alias("item"), _words(F.col("text")).alias("words"))
    width = F.least(F.size("words"), F.lit(window))
    cut_out = (
        items.filter(F.size("words") > 0)
        .withColumn("width", width)
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)))
        .select("item", "width", F.slice("words", F.col("at"), F.col("width")).alias("phrase"))
    )
    code = F.xxhash64(F.transform("phrase", lambda w: F.xxhash64(w)))
    return (
        cut_out.withColumn("code", code).groupBy("code", "width", "phrase")
        .agg(F.collect_set("item").alias("items"))
    )


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, code, at, end, items): verified occurrences, in words counted from 1, ``end`` exclusive."""
    known = benchmark_windows(benchmark, window)
    widths = sorted(r.width for r in known.select("width").distinct().collect())  # at most ``window`` numbers
    small = known.count() <= broadcast_windows
    rows = texts(docs, id_col, text_col).select("doc_id", row_code().alias("row"), _words(F.col("text")).alias("words"))
    rows = rows.withColumn("codes", F.transform("words", lambda w: F.xxhash64(w)))
    made = [_windows(F.col("codes"), w) for w in widths] or [_windows(F.col("codes"), window)]
    rows = rows.withColumn("made", F.concat(*made) if len(made) > 1 else made[0])
    # The outer form: for the inner one, the optimizer adds a filter on the array's size that computes
    # the hashes anew for every window.
    rows = rows.select("doc_id", "row", "words", F.explode_outer("made").alias("w")).select(
        "doc_id", "row", "words", "w.at", "w.width", "w.code"
    )
    k = known.alias("k")
    if small:
        k = F.broadcast(k)
        phrase = F.slice(F.col("d.words"), F.col("d.at"), F.col("d.width"))
    else:
        rows = rows.select("doc_id", "row", "at", "width", "code", F.slice("words", F.col("at"), F.col("width")).alias("seen"))
        phrase = F.col("d.seen")
    same = (F.col("d.code") == F.col("k.code")) & (F.col("d.width") == F.col("k.width")) & (phrase == F.col("k.phrase"))
    return rows.alias("d").join(k, same).select(
        "d.doc_id", F.col("d.row").alias("code"), "d.at", (F.col("d.at") + F.col("d.width")).alias("end"), "k.items"
    )


def _covered(spans: str) -> Column:
    """Number of words in the union of sorted [at, end) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))

    def step(acc, s):
        new = F.greatest(F.lit(0), s["end"] - F.greatest(acc["reach"], s["at"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["reach"], s["end"]).alias("reach"))

    return F.aggregate(F.col(spans), start, step)["n"]


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
           broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: doc_id, code, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    * Null and empty texts have no words and no hits; an item without words has no window.
    * An item shorter than ``window`` words is one window of its own length.
    * Overlapping occurrences count each word once. Repeated rows give repeated rows.
    * Items without an id hit, but are not counted or named.
    * Empty tables give no rows (documents) or no hits (benchmark).
    """
    found = (
        hits(docs, benchmark, window, id_col, text_col, broadcast_windows)
        .groupBy("doc_id", "code")
        .agg(
            F.array_sort(F.collect_set(F.struct("at", "end"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select(F.col("doc_id").alias("hit_id"), F.col("code").alias("hit_code"), "spans", "items", _covered("spans").alias("hit"))
    )
    rows = texts(docs, id_col, text_col).select(
        "doc_id", row_code().alias("code"), F.size(_words(F.col("text"))).cast("long").alias("n_words")
    )
    same = (F.col("code") == F.col("hit_code")) & F.col("doc_id").eqNullSafe(F.col("hit_id"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return rows.join(found, same, "left").select(
        "doc_id", "code", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join(names, ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) without the words that were hit.

    Columns stay as they are. Removing spans takes each hit word together with the separators
    before it; all other characters stay.
    """
    verdict = report(docs, benchmark, window, id_col, text_col)
    if remove == "documents":
        return keep_rows(docs, verdict.filter("contaminated").select("doc_id", "code").distinct(), id_col, text_col)
    if remove != "spans":
        raise ValueError("remove must be 'documents' or 'spans'")
    hit_id, hit_code, hit_spans = (free_name(docs, c) for c in ("_hit_id", "_hit_code", "_hit_spans"))
    found = verdict.filter("n_hit > 0").select(
        F.col("doc_id").alias(hit_id), F.col("code").alias(hit_code), F.col("spans").alias(hit_spans)
    ).dropDuplicates([hit_id, hit_code])
    code, pieces = free_name(docs, "_row_code"), free_name(docs, "_pieces")
    upper = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    text = F.col(f"`{text_col}`")
    same = (F.col(code) == F.col(hit_code)) & F.col(f"`{id_col}`").eqNullSafe(F.col(hit_id))
    joined = docs.withColumn(code, row_code(id_col, text_col)).join(found, same, "left")
    joined = joined.withColumn(pieces, F.regexp_extract_all(text, F.lit(f"(?s).*?{upper}"), F.lit(0)))
    inside = lambda i: F.exists(hit_spans, lambda s: (i + 1 >= s["at"]) & (i + 1 < s["end"]))
    kept = F.array_join(F.filter(F.col(pieces), lambda p, i: ~inside(i)), "")
    rest = F.substring(text, F.length(F.array_join(F.col(pieces), "")) + 1, F.length(text))
    cleaned = F.when(F.col(hit_spans).isNotNull(), F.concat(kept, rest)).otherwise(text)
    return joined.select(*[cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


_FOLD = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
SQL = f"""
with d as materialized (select doc_id, regexp_extract_all({_FOLD}, '{WORD}') as ws from documents),
b as (select item_id, regexp_extract_all({_FOLD}, '{WORD}') as ws from benchmark),
bw as (select distinct item_id, ws[i:i + least(len(ws), {WINDOW}) - 1] as phrase, least(len(ws), {WINDOW}) as width
       from (select item_id, ws, unnest(range(1, len(ws) - least(len(ws), {WINDOW}) + 2)) as i from b where len(ws) > 0)),
dw as (select doc_id, p0, width, ws[p0:p0 + width - 1] as phrase
       from (select doc_id, ws, width, unnest(range(1, len(ws) - width + 2)) as p0
             from d, (select distinct width from bw) where len(ws) >= width)),
h as materialized (select doc_id, p0, dw.width, item_id from dw join bw on dw.phrase = bw.phrase),
w as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(p0, p0 + width)) as p from h) group by doc_id),
i as (select doc_id, count(*) as n, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
      from (select distinct doc_id, item_id from h) group by doc_id)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(w.n, 0) as bigint) as n_hit,
       cast(coalesce(i.n, 0) as bigint) as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
       coalesce(w.n, 0) > 0 and 20 * coalesce(w.n, 0) >= len(ws) as contaminated
from d left join w using (doc_id) left join i using (doc_id)
"""


@query("op1_decontaminate", SQL)
def op1_decontaminate(spark, sf):
    return report(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("code", "spans")
