"""Raw-source profiles (M2-M4): everything a source profile reports, as DataFrames (one per section),
each an aggregate over the whole source - no rows are collected."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlayer import settings
from statlayer.operators.aggregate import duplicate_rows, value_counts
from statlayer.operators.conform import aggregate_area_flag, with_looks_merged
from statlayer.operators.reshape import q, unpivot_measure, year_columns
from statlayer.profile.stats import column_profile, summary
from statlayer.settings import Settings


def yearly_cells(data: DataFrame, years: list[str]) -> DataFrame:
    """year, cells, missing, zeros, negatives of a wide matrix: its cells as rows, summed up by year in the task that
    reads them, so one row a year and task is moved, however wide the matrix is."""
    v = F.col("value")
    return unpivot_measure(data.select(*[q(c) for c in years]), [], years, "year", "value").groupBy("year").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(v.isNull()).alias("missing"), F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"))


def whole_cells(yearly: DataFrame) -> DataFrame:
    """One row: cells, missing (also in % and at least and at most a year), zeros, negatives of all years."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("cells", "missing", "zeros", "negatives")]
    return yearly.agg(*sums, F.min("missing").alias("min_missing"), F.max("missing").alias("max_missing")) \
        .withColumn("missing_pct", F.round(F.try_divide(F.lit(100.0) * F.col("missing"), F.col("cells")), 2))


def profile_matrix(raw: DataFrame, iso: DataFrame, id_cols=settings.MATRIX_ID_COLUMNS,
                   focus_sector: str = settings.FOCUS_SECTOR,
                   not_countries=tuple(settings.AGGREGATE_CODES + settings.INTERNATIONAL_CODES)) -> dict:
    """M2: wide matrix as read - blank rows, id columns, cells / missing / zeros / negatives, missing per
    year (min, max), value summary, focus-sector summary per substance, duplicate keys, non-ISO and
    merged codes, missing cells per substance."""
    substance, sector, code, name = id_cols
    years = year_columns(raw)
    blank = F.lit(True)
    for c in id_cols:
        blank = blank & q(c).isNull()
    data = raw.where(q(substance).isNotNull() & q(sector).isNotNull() & q(code).isNotNull())
    # the raw sheet's own cells, blank rows included, as the report counts them; values are parsed leniently
    yearly = yearly_cells(raw, years)
    long = unpivot_measure(data, id_cols, years, "year", "value")
    cells = unpivot_measure(raw, list(id_cols), years, "year", "value").where("value is not null").select("value")
    codes = data.select(q(code).alias("code"), q(name).alias("name")).distinct()
    iso_codes = iso.select(F.col("alpha_3").alias("code"))
    focus = long.where((q(sector) == focus_sector) & ~q(code).isin(list(not_countries)) & F.col("value").isNotNull())
    return {
        "shape": raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(blank).alias("blank_rows"))
                    .withColumn("columns", F.lit(len(raw.columns))).withColumn("year_columns", F.lit(len(years))),
        "id_columns": column_profile(raw, list(id_cols)),
        "cells": whole_cells(yearly),
        "cells_per_year": yearly,
        "value_summary": summary(cells, "value"),
        "focus_by_substance": summary(focus, "value", [substance]),
        "duplicate_keys": duplicate_rows(data, [substance, sector, code]),
        "non_iso_codes": codes.join(iso_codes, "code", "left_anti"),
        "merged_codes": with_looks_merged(codes, "code", "name", iso).where("looks_merged").drop("looks_merged"),
        "rows_per_sector": value_counts(data, [sector], "rows"),
        # Rows and missing cells per substance, aligned with a full outer join for the report
        "substances": data.groupBy(substance).agg(F.count(F.lit(1)).alias("rows")).join(
            long.groupBy(substance).agg(F.count_if(F.col("value").isNull()).alias("missing_cells")),
            substance, "full"),
    }


def profile_population(records: DataFrame, known_codes: DataFrame, latest: int = 5) -> dict:
    """M3 on the raw records: shape, year span, codes split into countries and regions (codes neither
    in ISO nor in the extra list), the region list, value summary, values in the latest years, missing
    values, duplicate (code, date) records."""
    flat = records.select(F.col("countryiso3code").alias("code"), F.col("country.value").alias("country_name"),
                          "date", "value", F.col("date").cast("int").alias("year"))
    codes = flat.where(F.col("code").isNotNull()).select("code").distinct()
    regions = codes.join(known_codes, "code", "left_anti")
    per_year = flat.groupBy("year").agg(F.count("value").alias("values"))
    return {
        "shape": flat.agg(F.count(F.lit(1)).alias("rows"), F.min("year").alias("first_year"),
                          F.max("year").alias("last_year")),
        "codes": codes.agg(F.count(F.lit(1)).alias("codes")).select(
            "codes", regions.select(F.count(F.lit(1))).scalar().alias("regions")),
        "regions": regions.orderBy("code"),
        "columns": column_profile(flat, ["code", "country_name", "date", "value"]),
        "value_summary": summary(flat, "value"),
        "latest_years": per_year.orderBy(F.desc("year")).limit(latest),
        "missing_values": flat.agg(F.count_if(F.col("value").isNull()).alias("missing")),
        "duplicate_keys": duplicate_rows(flat, ["code", "date"]),
    }


def profile_stats(tidy: DataFrame, layout: str, raw: DataFrame | None = None, cfg: Settings = Settings(),
                  activities=tuple(settings.ACTIVITIES)) -> dict:
    """M4: layout and shape, columns of the raw file, areas by kind, source x element counts, flags, value summary and
    per-item summary, the part in use (its summary per activity and its years), areas without an ISO code with their
    last year, negatives by area and item, projections by year, duplicate keys."""
    used = tidy.where((F.col("source") == settings.STATS_SOURCE) & (F.col("element") == settings.STATS_ELEMENT) & F.col("item_code").isin(list(activities)))
    scope = used.where((F.col("year") >= cfg.stats_first_year) & ~F.col("is_projection") & ~F.col("is_aggregate"))
    # every distinct combination once, then counted: one shuffled row a combination, not one a row and column
    kinds = tidy.groupBy("area_code", "item_code", "element", "source").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("first"), F.max("year").alias("last"))
    return {
        "shape": kinds.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_distinct("area_code").alias("areas"),
                           F.count_distinct("item_code").alias("items"), F.count_distinct("element").alias("elements"),
                           F.count_distinct("source").alias("sources"), F.min("first").alias("first_year"),
                           F.max("last").alias("last_year")).withColumn("layout", F.lit(layout)),
        "columns": column_profile(raw if raw is not None else tidy),
        "area_kinds": area_kinds(tidy),
        "in_scope": scope.agg(F.count(F.lit(1)).alias("values"), F.min("year").alias("first_year"), F.max("year").alias("last_year")),
        "in_scope_by_item": summary(scope, "value", ["item"]),
        "negatives_by_area": used.where(F.col("value") < 0).groupBy("area", "item").agg(F.count(F.lit(1)).alias("values")),
        "projections_by_year": tidy.where("is_projection").groupBy("year").agg(F.count(F.lit(1)).alias("values")),
        "duplicate_keys": duplicate_rows(tidy, ["area_code", "item_code", "element", "source", "year"]),
        "source_element": value_counts(tidy, ["source", "element"]),
        "flags": value_counts(tidy, ["flag"]),
        "value_summary": summary(tidy, "value"),
        "by_item": summary(tidy, "value", ["item_code"]),
        "areas_without_iso": tidy.where(F.col("iso3").isNull() & ~F.col("is_aggregate"))
                                 .groupBy("area_code", "area").agg(F.max("year").alias("last_year")),
        "negatives": tidy.agg(F.count_if(F.col("value") < 0).alias("negative_values"),
                              F.count_if("is_projection").alias("projection_rows")),
    }


def area_kinds(tidy: DataFrame) -> DataFrame:
    """One row: areas that are countries, that sum up others, and of these the regions."""
    areas = tidy.groupBy("area_code").agg(F.lit(1)).select("area_code", aggregate_area_flag("area_code").alias("above"))
    return areas.agg(F.count_if(~F.col("above")).alias("countries"), F.count_if("above").alias("aggregates"),
                     F.count_if(F.col("area_code") >= settings.WORLD_AREA_CODE).alias("regions"))


def sections(profile: dict, *names: str) -> DataFrame:
    """Sections of a profile as rows (section, row, name, value as text): one frame to write or to compare."""
    out = None
    for name in names:
        df = profile[name]
        key = [c for c, kind in df.dtypes if kind == "string"]
        cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in df.columns if c not in key])
        rows = df.select(F.lit(name).alias("section"), F.concat_ws("/", *key).alias("row"), F.inline(cells))
        out = rows if out is None else out.unionByName(rows)
    return out
