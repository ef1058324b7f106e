"""Window-style operators, written so that no single task ever holds an unbounded partition.

* share of a group total: on an aggregated product (one row per entity and period) a window over the
  period - a partition holds one period's entities; on raw rows, partial sums per group joined back
  (the totals side is as small as the number of groups; AQE broadcasts it once measured small).
* share of the whole result: the total is a scalar subquery (one value), not ``OVER ()`` (which
  would move every row into one partition).
* change from the previous row: ``lag`` over (entity ORDER BY period) - one entity's periods per
  window partition, bounded by the number of periods after the product is aggregated.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlayer.functions.numeric import pct_change, ratio_pct


def with_group_total(df: DataFrame, value_col: str, by: list[str], out: str) -> DataFrame:
    totals = df.groupBy(*by).agg(F.sum(value_col).alias(out))
    return df.join(totals, by, "left")


def share_of_group(df: DataFrame, value_col: str, by: list[str], out: str, method: str = "window") -> DataFrame:
    """100 * value / sum(value) within ``by`` (e.g. share of the world total in the same year).

    ``window`` (default) is for aggregated products - one row per entity and period - where a window
    partition holds one period's entities: one pass, no second evaluation of the input. ``join`` is for
    raw rows with a low-cardinality ``by``: partial sums per group, joined back (AQE broadcasts the
    measured-small totals); materialise ``df`` first so it is not computed twice."""
    if method == "join":
        tmp = f"__total_{out}"
        return with_group_total(df, value_col, by, tmp) \
            .withColumn(out, ratio_pct(F.col(value_col), F.col(tmp))).drop(tmp)
    total = F.sum(value_col).over(Window.partitionBy(*by))
    return df.withColumn(out, ratio_pct(F.col(value_col), total))


def share_of_whole(df: DataFrame, value_col: str, out: str) -> DataFrame:
    """100 * value / sum(value) over the whole DataFrame; the total is one scalar subquery."""
    total = df.select(F.sum(value_col)).scalar()
    return df.withColumn(out, ratio_pct(F.col(value_col), total))


def change_from_previous(df: DataFrame, value_col: str, entity: list[str], order: str, out: str) -> DataFrame:
    """Percent change from the previous row of the same entity in ``order`` (not order-1: gaps are
    not checked); null on the first row, a missing neighbour, or a zero previous value."""
    w = Window.partitionBy(*entity).orderBy(order)
    return df.withColumn(out, pct_change(F.col(value_col), F.lag(value_col).over(w)))
