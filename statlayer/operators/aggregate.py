"""Aggregation operators. Each is one groupBy with map-side partial aggregation, so a hot key is
combined before the shuffle and never lands in one task as raw rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlayer.quality.dropped import Dropped, watched


def sorted_text_join(col: str, sep: str = ";") -> Column:
    """Grouped sorted text join ('SSD','SDN' -> 'SDN;SSD'). Collects one group's values: use on
    dimension-sized groups only (parts of a merged code, nations of a region)."""
    return F.array_join(F.array_sort(F.collect_list(F.col(col))), sep)


def complete_group_sums(members: DataFrame, facts: DataFrame, group_col: str, member_col: str,
                        fact_member_col: str, by: list[str], value_col: str, out: str, dropped: Dropped | None = None) -> DataFrame:
    """Sum facts over the members of each group, keeping only (group, by) cells where EVERY member
    of the group has data (a merged code gets a value only when all its parts report).

    ``members`` = (group_col, member_col) expected parts; ``facts`` has fact_member_col, by, value;
    ``dropped`` counts the cells left out.
    """
    m = members.select(group_col, member_col).where(F.col(member_col).isNotNull()).distinct()
    expected = m.groupBy(group_col).agg(F.count(F.lit(1)).alias("__expected"))
    # facts are summed by (member, by) before they meet the members, with map-side partial sums: the join
    # then has one row a cell, however many rows a member holds, and a member counts once a cell
    cells = facts.groupBy(F.col(fact_member_col).alias(member_col), *by).agg(F.sum(value_col).alias("__v"))
    found = cells.join(m, member_col).groupBy(group_col, *by).agg(F.sum("__v").alias(out), F.count(F.lit(1)).alias("__found"))
    complete = F.col("__found") == F.col("__expected")
    cells = watched(dropped, found.join(expected, group_col, "inner"), cells_with_missing_parts=~complete)
    return cells.where(complete).select(group_col, *by, out)


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows that repeat an earlier key (all occurrences after the first); null keys compare equal.
    One row: ``duplicate_rows``."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
            .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicate_rows")))


def value_counts(df: DataFrame, cols: list[str], out: str = "count") -> DataFrame:
    """Frequency table of one or more columns, most frequent first (ties by the key)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), *cols)


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: non-null, null, zero and negative counts, in ONE pass over the data."""
    aggs = []
    for c in cols:
        col = F.col(c)
        number = col.try_cast("double")          # text that is no number is neither zero nor negative
        aggs += [F.count(col).alias(f"{c}__non_null"), F.count_if(col.isNull()).alias(f"{c}__null"),
                 F.count_if(number == 0).alias(f"{c}__zero"), F.count_if(number < 0).alias(f"{c}__negative")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__non_null").alias("non_null"),
                              F.col(f"{c}__null").alias("missing"), F.col(f"{c}__zero").alias("zeros"),
                              F.col(f"{c}__negative").alias("negatives")) for c in cols])
    return wide.select(F.inline(rows))


def coverage_pct(value_col: str, covered: Column) -> Column:
    """Expression: 100 * sum(value where covered) / sum(value)."""
    return F.try_divide(F.lit(100.0) * F.sum(F.when(covered, F.col(value_col))).cast("double"),
                        F.sum(F.col(value_col)).cast("double"))
