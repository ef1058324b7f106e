"""Reshape operators: wide -> long (single and paired measures), long -> wide, explode, flatten.

All are single projections / one aggregation: no per-column loops of jobs, no driver work beyond
reading ``df.columns``.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlayer.functions.numeric import nan_to_null, to_double_lenient
from statlayer.functions.text import is_number_name


def q(name: str):
    """Column reference for any header (spaces, dots, digits)."""
    return F.col("`" + name.replace("`", "``") + "`")


def year_columns(df: DataFrame, pattern: str | None = None) -> list[str]:
    """Columns whose name is a number (or matches ``pattern`` fully)."""
    if pattern:
        return [c for c in df.columns if re.fullmatch(pattern, c)]
    return [c for c in df.columns if is_number_name(c)]


def one_type(df: DataFrame, id_cols: list, value_cols: list[str], numeric: bool = True) -> DataFrame:
    """``id_cols`` (names or columns) and the value columns in one type: all numeric -> double; otherwise text, then a
    lenient parse (bad text becomes null, as a coercing parse does). NaN is missing."""
    types = {type(df.schema[c].dataType) for c in value_cols}
    all_numeric = all(issubclass(t, T.NumericType) for t in types)
    if not numeric:
        typed = lambda c: q(c).cast("string")
    elif all_numeric:
        typed = lambda c: nan_to_null(q(c).cast("double"))
    else:
        typed = lambda c: to_double_lenient(q(c))
    return df.select(*[q(c) if isinstance(c, str) else c for c in id_cols], *[typed(c).alias(c) for c in value_cols])


def unpivot_measure(df: DataFrame, id_cols: list[str], value_cols: list[str], var_name: str = "year",
                    value_name: str = "value", numeric: bool = True) -> DataFrame:
    """Wide -> long with one measure; missing cells are kept (drop them with ``where`` after).

    Mixed value-column types cannot be unpivoted directly, so they are unified first (``one_type``).
    """
    wide = one_type(df, id_cols, value_cols, numeric)
    return wide.unpivot([q(c) for c in id_cols], [q(c) for c in value_cols], var_name, value_name)


def year_from_header(col) -> F.Column:
    """'1970', ' 1970 ', '1970.0' -> 1970 (strict: a bad header is an error)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(F.trim(c), r"\.").getItem(0).cast("int")


def year_of_header(col: str, headers: list[str]) -> F.Column:
    """``year_from_header`` of a column that holds some of the headers: each is parsed once, not once a row."""
    return F.try_element_at(F.create_map(*[x for h in headers for x in (F.lit(h), year_from_header(F.lit(h)))]), F.col(col))


def unpivot_pairs(df: DataFrame, id_cols: list[str], pairs: list[tuple], var_name: str = "year",
                  value_name: str = "value", flag_name: str = "flag") -> DataFrame:
    """Wide -> long for paired (value, flag) columns, e.g. Y2023 / Y2023F.

    ``pairs`` = [(label, value_column, flag_column_or_None), ...]. Each flag travels with its value.
    Rows with a missing value are kept (the caller drops them), so a set flag on an empty value
    never breaks the reshape. One ``inline`` of a literal-shaped array: a single Generate node.
    """
    rows = F.array(*[
        F.struct(F.lit(label).alias(var_name),
                 q(v).cast("double").alias(value_name),
                 (q(f).cast("string") if f else F.lit(None).cast("string")).alias(flag_name))
        for label, v, f in pairs])
    return df.select(*[q(c) for c in id_cols], F.inline(rows))


def pivot_fixed(df: DataFrame, keys: list[str], pivot_col: str, value_col: str, outputs: dict,
                agg: str = "sum") -> DataFrame:
    """Long -> wide with a fixed list of pivot values -> output column names.

    A value with no rows still gets its (null) column. Rows with a null key are dropped first, as a
    grouped pivot drops them. One hash aggregation with map-side partial sums; no distinct-values job.
    """
    fn = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg}[agg]
    present = F.lit(True)
    for k in keys + [pivot_col]:
        present = present & F.col(k).isNotNull()
    return df.where(present).groupBy(*keys).agg(*[
        fn(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(name) for v, name in outputs.items()])


def pivot_years(df: DataFrame, keys: list[str], year_col: str, years: range, measures: dict) -> DataFrame:
    """Long -> wide by declared years: ``measures`` = {"Y{year}": function of a year's column maker -> aggregate}, e.g.
    ``{"Y{year}": lambda of: F.sum(of("v"))}``. Rows without a year are left out; a row of an undeclared year stops the
    query, so nothing is lost in silence and no job has to look the years up before the plan is built."""
    year = F.col(year_col)
    outside = F.raise_error(F.concat(F.lit(f"{year_col}: not in {years.start}..{years.stop - 1}: "), year.cast("string"))).cast("int")
    rows = df.where(year.isNotNull()).withColumn(year_col, F.when(year.between(years.start, years.stop - 1), year.cast("int")).otherwise(outside))
    aggs = [make(lambda c, y=y: F.when(year == y, F.col(c))).alias(name.format(year=y)) for y in years for name, make in measures.items()]
    return rows.groupBy(*keys).agg(*aggs)


def explode_delimited(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    """'SDN;SSD' -> two rows (SDN), (SSD)."""
    return df.withColumn(out, F.explode(F.split(F.col(col), re.escape(sep))))


def flatten(df: DataFrame, fields: dict) -> DataFrame:
    """Nested record -> flat columns: {'out_name': 'path.to.field', ...}."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def stacked_values(df: DataFrame, cols: list[str], value_name: str = "value") -> DataFrame:
    """All cells of ``cols`` as one column of present values (a matrix stacked into one series)."""
    long = unpivot_measure(df.select(*[q(c) for c in cols]), [], cols, "__col", value_name)
    return long.where(F.col(value_name).isNotNull()).select(value_name)
