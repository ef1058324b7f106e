"""Counts of dropped rows: taken once, in the pass that writes."""
import pytest
from pyspark.sql import functions as F

from statlayer.operators.reshape import pivot_years, year_from_header, year_of_header
from statlayer.plans import layers as PL
from statlayer.plans import products as P
from statlayer.quality.dropped import Dropped, report, watched

from test_layers import CFG, write_raw


def test_counts_come_with_the_action(spark, tmp_dir):
    lost = Dropped("step")
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 3 > 0, F.col("id")))
    kept = lost.watch(df, empty=F.col("v").isNull(), even=F.col("id") % 2 == 0).where("v is not null")
    kept = lost.watch(kept, large=F.col("v") > 50)
    kept.write.parquet(f"{tmp_dir}/out")
    assert lost.rows() == [("step", "empty", 34), ("step", "even", 50), ("step", "large", 32)]
    assert [tuple(r) for r in report(spark, lost).collect()] == lost.rows()


def test_nobody_counts_without_being_asked(spark):
    df = spark.range(3)
    assert watched(None, df, all=F.lit(True)) is df


def test_empty_plans_count_nothing(spark):
    lost = Dropped("none")
    lost.watch(spark.createDataFrame([], "a int"), empty=F.col("a").isNull()).collect()
    assert lost.rows() == [("none", "empty", 0)]


def test_the_run_reports_what_it_drops(spark, tmp_dir):
    paths = PL.run(spark, write_raw(tmp_dir), f"{tmp_dir}/out", steps=["stage", "curate"], cfg=CFG, run_id="r1", today_year=2026)
    got = {}
    for step in ("matrix", "population", "stats", "curate"):
        for r in spark.read.option("header", True).csv(paths.report(f"dropped_{step}")).collect():
            got[r.step, r.what] = int(r.rows)
    assert got == {("matrix", "rows_without_key"): 1, ("matrix", "empty_cells"): 1, ("population", "records_without_value"): 1,
                   ("stats", "empty_values"): 0, ("curate", "cells_with_missing_parts"): 0}


def test_declared_years(spark):
    df = spark.createDataFrame([("a", 2001, 1.0), ("a", 2003, 2.0), ("a", 2003, 3.0), ("b", None, 9.0), ("b", 2002, 4.0)], "k string, y int, v double")
    wide = pivot_years(df, ["k"], "y", range(2001, 2004), {"Y{year}": lambda of: F.sum(of("v")), "N{year}": lambda of: F.count(of("v"))})
    assert wide.columns == ["k", "Y2001", "N2001", "Y2002", "N2002", "Y2003", "N2003"]
    assert {r.k: (r.Y2001, r.Y2002, r.Y2003, r.N2003) for r in wide.collect()} == {"a": (1.0, None, 5.0, 2), "b": (None, 4.0, None, 0)}
    with pytest.raises(Exception, match="y: not in 2001..2002: 2003"):
        pivot_years(df, ["k"], "y", range(2001, 2003), {"Y{year}": lambda of: F.sum(of("v"))}).collect()


def test_the_matrix_is_cleaned_and_counted_by_row(spark):
    """Texts are cleaned, and empty cells counted, before a matrix row becomes a row a year."""
    schema = "Substance string, Sector string, `EDGAR Country Code` string, Country string, `1990` string, ` 1991 ` string, `1992.0` string"
    raw = spark.createDataFrame([(" CO2\t", "Fuel Use", "\u00a0AIR ", "Air", "1.5", "n/a", None), (None, "Fuel Use", "USA", "States", "1", None, None),
                                 ("CH4", "Waste", "USA", None, "NaN", None, ""), ("CH4", "Waste", "EU27", "Union", "7", "8", "9")], schema)
    lost = Dropped("matrix")
    tidy = P.tidy_matrix(raw, 3, dropped=lost)
    got = sorted((r.country_code, r.country_type, r.sector_key, r.substance, r.year, r.emissions_mt_co2eq) for r in tidy.collect())
    assert got == [("AIR", "international", "fuel_use", "CO2", 1990, 1.5)] + [("EU27", "aggregate", "waste", "CH4", y, v) for y, v in ((1990, 7.0), (1991, 8.0), (1992, 9.0))]
    assert lost.rows() == [("matrix", "rows_without_key", 1), ("matrix", "empty_cells", 5)]
    plan = tidy._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Expand", 1)
    assert "CollectMetrics" in below and "CollectMetrics" not in above
    assert "trim" not in above and "split" not in above


def test_headers_are_parsed_once(spark):
    headers = ["1970", " 1971 ", "1972.0"]
    df = spark.createDataFrame([(h,) for h in headers * 2], "h string").select(year_from_header("h").alias("a"), year_of_header("h", headers).alias("b"))
    assert [tuple(r) for r in df.collect()] == [(y, y) for y in (1970, 1971, 1972)] * 2
