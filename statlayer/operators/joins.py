"""Join helpers: broadcast of fixed tables, membership (semi/anti), orphan counts, key reconciliation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_ROWS = 100_000          # rows of a caller's table that are broadcast


def fixed_dim(df: DataFrame) -> DataFrame:
    """Broadcast a table whose size is fixed by definition (config literal, code list, 25 nations)."""
    return F.broadcast(df)


def counted_dim(df: DataFrame) -> DataFrame:
    """A table that the caller supplies (mapping, code list): broadcast once its rows are counted to be few, otherwise
    left to the shuffle join."""
    return F.broadcast(df) if df.limit(DIM_ROWS + 1).count() <= DIM_ROWS else df


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with a match (EXISTS)."""
    return df.join(other, on, "left_semi")


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Rows of ``df`` without a match (NOT EXISTS). A null key never matches, so it counts as
    unmatched (the membership-test semantics; never NOT IN)."""
    return df.join(other, on, "left_anti")


def orphan_count(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, name: str) -> DataFrame:
    """One row (relation, orphans): fact rows whose key is missing from the dimension. Facts are counted by
    key before the join, so a key that many rows share travels once a task; a null key is an orphan."""
    counted = facts.groupBy(F.col(fact_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    missing = counted.join(dim.select(F.col(dim_key).alias("__k")).distinct(), "__k", "left_anti")
    return missing.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("orphans")).select(F.lit(name).alias("relation"), "orphans")


def align(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Key-aligned join of two keyed aggregates (inner: keys in both; full: report alignment)."""
    return left.join(right, keys, how)
