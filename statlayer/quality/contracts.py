"""Table contracts (V16): primary key, not-null, foreign keys, range checks and accepted values that a
file format does not enforce, evaluated as violation counts.

Column constraints (not-null, ranges, enums) share ONE aggregation pass; the primary key is one
grouped count; each foreign key is one anti-join against the distinct dimension keys.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlayer.operators.joins import orphan_count
from statlayer.schemas import Contract


def constraint_violations(df: DataFrame, contract: Contract, dims: dict[str, DataFrame] | None = None) -> DataFrame:
    """(constraint, violations) for every constraint of the contract."""
    dims = dims or {}
    spark = df.sparkSession
    names, aggs = [], []
    for c in contract.required:
        names.append(f"not null: {c}")
        aggs.append(F.count_if(F.col(c).isNull()))
    for c, (lo, hi) in contract.ranges.items():
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(c) < F.lit(lo))
        if hi is not None:
            cond = cond | (F.col(c) > F.lit(hi))
        names.append(f"check: {c} in [{lo}, {hi}]")
        aggs.append(F.count_if(cond))
    for c in contract.positive:
        names.append(f"check: {c} > 0")
        aggs.append(F.count_if(F.col(c) <= 0))
    for c, allowed in contract.accepted.items():
        names.append(f"check: {c} in accepted values")
        aggs.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed))))
    parts = []
    if aggs:
        row = df.agg(*[a.alias(f"__v{i}") for i, a in enumerate(aggs)])
        arr = F.array(*[F.struct(F.lit(n).alias("constraint"), F.col(f"__v{i}").cast("long").alias("violations"))
                        for i, n in enumerate(names)])
        parts.append(row.select(F.inline(arr)))
    pk = contract.primary_key
    parts.append(df.groupBy(*pk).agg(F.count(F.lit(1)).alias("__n"))
                 .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("violations"))
                 .select(F.lit(f"primary key: ({', '.join(pk)})").alias("constraint"), "violations"))
    for c, (dim_name, dim_col) in contract.foreign_keys.items():
        if dim_name not in dims:
            continue
        orphans = orphan_count(df.where(F.col(c).isNotNull()), dims[dim_name], c, dim_col, f"foreign key: {c} -> {dim_name}.{dim_col}")
        parts.append(orphans.select(F.col("relation").alias("constraint"), F.col("orphans").alias("violations")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out if parts else spark.createDataFrame([], "constraint string, violations long")
