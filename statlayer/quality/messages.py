"""Names and detail texts of the data-quality checks.

``fill(template, name=value, ...)`` turns a template into a Spark string expression: literal pieces
plus the values (Columns or plain values), so details are built inside the one aggregation pass.
"""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------------
# FIXED VALUES: check names and detail formats, as the published validation reports read them.
# ---------------------------------------------------------------------------------------------------
COLUMNS = "schema: required columns present"
COLUMNS_MISSING = "missing: {missing}"
COLUMNS_OK = "all {n} columns present"
NOT_NULL = "not null: {columns}"
NOT_NULL_BAD = "null counts: {counts}"
NOT_NULL_OK = "no nulls"
UNIQUE = "unique key: ({key})"
UNIQUE_DETAILS = "{n} duplicate rows"
VALUES_IN = "accepted values: {column}"
VALUES_IN_BAD = "unexpected: [{values}]"
VALUES_IN_OK = "{n} known values"
BETWEEN = "range: {column} in [{low}, {high}]"
BETWEEN_DETAILS = "{below} below, {above} above (min={min}, max={max})"
ROW_COUNT = "row count >= {minimum}"
ROW_COUNT_DETAILS = "{n} rows"
WORLD_TOTAL = "business rule: GLOBAL TOTAL = sum of countries"
WORLD_TOTAL_DETAILS = "largest relative gap {gap} over {n} sector-gas-years"
WORLD_POPULATION = "business rule: World population = sum of countries (within 0.5%)"
WORLD_POPULATION_DETAILS = "largest relative gap {gap}% over {n} years"
STATS_WORLD = "business rule: World = sum of countries (8 activities)"
STATS_COMPOSITE = "business rule: 'China' = mainland + Hong Kong + Macao + Taiwan"
YEARS_GAP_DETAILS = "largest relative gap {gap} over {n} years"
SUBTOTALS = "business rule: 8 activities = FAOSTAT crops + livestock subtotals (within {tolerance} kt)"
SUBTOTALS_DETAILS = "largest gap {gap} kt over {n} area-years"
FUTURE_PROJECTIONS = "future years are only projections (flag F)"
FUTURE_PROJECTIONS_DETAILS = "{n} future rows without the projection flag"
REFERENTIAL = "referential integrity: every country is in dim_country"
REFERENTIAL_DETAILS = "unknown codes: [{codes}]"
POPULATION_COVERAGE = "population coverage >= {minimum}% of emissions"
COVERAGE_DETAILS = "coverage {pct}%"
SHARES = "shares of world emissions add up to 100% each year"
SHARES_DETAILS = "largest gap {gap} percentage points"
MATCH_COVERAGE = "FAOSTAT coverage >= {minimum}% of emissions (latest year)"
SOURCES_AGREE = "EDGAR and FAOSTAT world totals agree within {max_gap}%"
SOURCES_AGREE_DETAILS = "largest gap {gap}% over {n} years"
PUBLISHED_COUNT = "row count {table} = curated file"
PUBLISHED_COUNT_DETAILS = "database {published} vs file {expected}"
PUBLISHED_CONTENT = "content of {table} = curated file"
PUBLISHED_CONTENT_DETAILS = "number of rows and sums of their hashes"
PUBLISHED_TOTAL = "world total latest year in database = curated file"
PUBLISHED_TOTAL_DETAILS = "database {published} Mt vs file {expected} Mt"
ORPHANS = "referential integrity: no emissions without a country"
ORPHANS_DETAILS = "{n} orphan rows"

_FIELD = re.compile(r"\{(\w+)\}")


def text(template: str, **values) -> str:
    """Fill a template with plain values (names known on the driver)."""
    return template.format(**values)


def fill(template: str, **values) -> Column:
    """Fill a template with Columns or plain values -> one string expression (null parts read 'nan')."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        v = values[m.group(1)]
        col = v if isinstance(v, Column) else F.lit(str(v))
        parts.append(F.coalesce(col.cast("string"), F.lit("nan")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")
