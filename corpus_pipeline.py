"""The corpus pipeline: toxic documents, near copies, repeated passages and benchmark text go; the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a driver may write every result
as Parquet and hand the reread table to the next stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, jaccard_join, packing, repeats, toxicity
from ledgerloom.llm.common import ready, table
from ledgerloom.session import cut

SHINGLE, PERCENT = 5, 80  # near copies: five words, a similarity of 0.8 or more


def _toxicity(spark, docs, sf_dir):
    """Documents that don't score as toxic."""
    return toxicity.without_toxic(docs, table(ready(spark), sf_dir, "labels"))


def _near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: that with the smallest id."""
    ready(spark)
    return jaccard_join.one_of_each(docs, SHINGLE, PERCENT)


def _repeats(spark, docs, sf_dir):
    """All documents; of a passage that occurs again, the first copy stays. n_chars counts what is left."""
    ready(spark)
    return repeats.dedup(docs).withColumn(
        "n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    )


def _decontaminate(spark, docs, sf_dir):
    """Documents without the contaminated ones."""
    return decontaminate.decontaminate(docs, table(ready(spark), sf_dir, "benchmark"))


def _pack(spark, docs, sf_dir):
    """The pieces of all documents and their places in sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("jaccard_join", _near_copies),
    ("suffix_repeats", _repeats),
    ("decontamination", _decontaminate),
    ("packing", _pack),
]


def run(spark, sf_dir):
    """All stages over ``documents``; results between stages are written to the shared folder."""
    docs = table(ready(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{name}")
    return docs


# A trained classifier, suffix order and a packing plan have no SQL form; tests compare with plain versions.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
