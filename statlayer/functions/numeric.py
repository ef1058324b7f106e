"""Numeric expressions with missing-value semantics of the source (NaN and inf are 'missing')."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN is missing: turn it into null so sums and comparisons skip it."""
    c = _c(col)
    return F.nanvl(c, F.lit(None).cast("double"))


def to_double_lenient(col) -> Column:
    """Lenient numeric parse: bad text -> null (``try_cast``), and 'NaN' -> null too."""
    return nan_to_null(_c(col).cast("string").try_cast("double"))


def safe_div(num, den) -> Column:
    """Division where x/0 and 0/0 are missing (null), never an error or +-inf."""
    return F.try_divide(_c(num), _c(den))


def ratio_pct(num, den) -> Column:
    """100 * num / den as double; null when the denominator is 0 or missing."""
    return F.try_divide(F.lit(100.0) * _c(num).cast("double"), _c(den).cast("double"))


def pct_change(current, previous) -> Column:
    """Percent change (current / previous - 1) * 100; null on a missing or zero previous value."""
    return (F.try_divide(_c(current).cast("double"), _c(previous).cast("double")) - F.lit(1.0)) * F.lit(100.0)


def gap_ratio(parts, total) -> Column:
    """|parts - total| / |total| where total == 0 with parts != 0 is +inf (fails a check) and 0/0 is
    missing (skipped), as a float series division would give."""
    p, t = _c(parts).cast("double"), _c(total).cast("double")
    diff = F.abs(p - t)
    return (F.when(t.isNull() | p.isNull(), F.lit(None).cast("double"))
            .when((t == 0) & (diff != 0), F.lit(float("inf")))
            .when((t == 0) & (diff == 0), F.lit(None).cast("double"))
            .otherwise(diff / F.abs(t)))


def round_half_even(col, scale: int = 0) -> Column:
    """Banker's rounding (``bround``) as float ``.round()`` does."""
    return F.bround(_c(col), scale)


def sql_round(col, scale: int) -> Column:
    """ROUND(x::numeric, n): decimal half-away-from-zero rounding, returned as double."""
    return F.round(_c(col).cast("decimal(38,10)"), scale).cast("double")


def int_div(col, divisor: int) -> Column:
    """Integer division truncating toward zero (``year / 10`` on integers in SQL), as int."""
    return F.call_function("div", _c(col).cast("long"), F.lit(int(divisor))).cast("int")


def null_skipping_sum(*cols) -> Column:
    """Row-wise sum that skips nulls and is null only if every input is null (min_count=1)."""
    cs = [_c(c) for c in cols]
    total = cs[0]
    for c in cs[1:]:
        total = F.coalesce(total, F.lit(0)) + F.coalesce(c, F.lit(0))
    return F.when(F.coalesce(*cs).isNull(), F.lit(None)).otherwise(total) if len(cs) > 1 else cs[0]
