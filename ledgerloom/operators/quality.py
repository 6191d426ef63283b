"""Schema evolution, key checks and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    pass


class EmptyInput(ValueError):
    pass


def evolve_to(df: DataFrame, target: dict[str, str], default_type: str = "string") -> DataFrame:
    """``df`` with the target's columns that it lacks, as typed NULLs (names compared without case)."""
    have = {c.lower() for c in df.columns}
    missing = {c: t or default_type for c, t in target.items() if c.lower() not in have and c.lower() != "id"}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()}) if missing else df


def missing_columns(target: list[str], incoming: list[str]) -> list[str]:
    """Incoming columns the target lacks; a technical ``id`` is never added."""
    have = {c.lower() for c in target}
    return [c for c in incoming if c.lower() not in have and c.lower() != "id"]


def restrict_to(df: DataFrame, target: list[str]) -> DataFrame:
    """Only the columns the target knows (names compared without case)."""
    have = {c.lower() for c in target}
    return df.select(*[c for c in df.columns if c.lower() in have])


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail when a key occurs twice. Only one boolean reaches the driver."""
    if not duplicate_counts(df, key).isEmpty():
        raise DuplicateKeys(f"{key} is not unique")
    return df


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """The rows that share their key with another row, with the number of copies."""
    return df.join(duplicate_counts(df, key), key)


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    return duplicate_counts(df, key).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"), F.count("*").alias("duplicate_keys")
    )


def null_key_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.dropna(subset=[key])


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyInput(f"{name} holds no rows")
    return df


def random_ids(df: DataFrame, key: str) -> DataFrame:
    """New random ids. Write the result before using it twice: ids differ per evaluation."""
    return df.withColumn(key, F.uuid())


def hashed_ids(df: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """New ids that can be recomputed: the hash of ``parts``, which must identify a row."""
    return df.withColumn(key, F.sha2(F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]), 256))


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, type and number of distinct values per column, in one pass.

    Exact counts shuffle each column's distinct values; ``approximate`` shuffles sketches only.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    one_row = df.agg(F.count("*").alias("n_rows"), *[distinct(F.col(c)).alias(c) for c in df.columns])
    return (
        one_row.unpivot(["n_rows"], df.columns, "column_name", "distinct_values")
        .join(
            F.broadcast(df.sparkSession.createDataFrame(df.dtypes, "column_name string, data_type string")),
            "column_name",
        )
        .select("column_name", "data_type", "n_rows", "distinct_values")
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as a side effect of the job that writes ``df`` (no extra action)."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen
