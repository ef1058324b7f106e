"""Semantic traps between float-frame / SQL-server semantics and Spark, one case each."""
import math

import pytest
from pyspark.sql import functions as F

from statlayer.functions import numeric as N
from statlayer.functions import text as X
from statlayer.operators import conform
from statlayer.operators.aggregate import duplicate_rows
from statlayer.operators.dedup import keep_first
from statlayer.operators.joins import anti
from statlayer.operators.reshape import pivot_fixed, unpivot_pairs


def one(spark, expr, schema="x double", row=(None,)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first().r


def test_t1_division_by_zero_is_missing(spark):
    assert one(spark, N.safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, N.ratio_pct(F.lit(0.0), F.lit(0.0))) is None
    assert one(spark, N.pct_change(F.lit(5.0), F.lit(0.0))) is None


def test_t2_t3_lenient_parse_and_nan(spark):
    assert one(spark, N.to_double_lenient(F.lit("abc"))) is None
    assert one(spark, N.to_double_lenient(F.lit("NaN"))) is None
    assert one(spark, N.to_double_lenient(F.lit(" 2.5"))) == 2.5
    assert one(spark, N.nan_to_null(F.lit(float("nan")))) is None


def test_t5_null_skipping_row_sum(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (None, None, None)], "a double, b double, c double")
    assert [r.s for r in df.select(N.null_skipping_sum("a", "b", "c").alias("s")).collect()] == [3.0, None]


def test_t6_previous_row_not_previous_year(spark):
    from statlayer.operators.windows import change_from_previous
    df = spark.createDataFrame([("A", 2000, 10.0), ("A", 2005, 15.0)], "k string, y int, v double")
    assert [r.c for r in change_from_previous(df, "v", ["k"], "y", "c").orderBy("y").collect()] == [None, 50.0]


def test_t7_t8_t9_text(spark):
    assert one(spark, X.strip_all(F.lit("\t a b  \n"))) == "a b"
    assert one(spark, X.strip_all(F.lit("\x1c x 　"))) == "x"          # Python strips these too
    assert one(spark, X.zero_pad(F.lit("7"), 3)) == "007"
    assert one(spark, X.zero_pad(F.lit("12345"), 3)) == "12345"            # never truncated
    assert one(spark, X.strip_leading(F.lit("''608"), "'")) == "608"
    assert one(spark, X.slug(F.lit("Fuel Production"))) == "fuel_production"


def test_t10_t11_t12_rounding_and_integer_division(spark):
    assert one(spark, N.round_half_even(F.lit(2.5))) == 2.0 and one(spark, N.round_half_even(F.lit(3.5))) == 4.0
    assert one(spark, N.sql_round(F.lit(2.25), 1)) == 2.3 and one(spark, N.sql_round(F.lit(-2.25), 1)) == -2.3
    assert one(spark, N.int_div(F.lit(1987), 10) * 10) == 1980
    assert one(spark, N.int_div(F.lit(-7), 2)) == -3                      # truncates toward zero


def test_t4_null_keys_dropped_before_pivot(spark):
    df = spark.createDataFrame([("A", "CH4", 1.0), (None, "CH4", 2.0), ("A", None, 3.0)], "k string, g string, v double")
    rows = pivot_fixed(df, ["k"], "g", "v", {"CH4": "ch4", "CO2": "co2"}).collect()
    assert [(r.k, r.ch4, r.co2) for r in rows] == [("A", 1.0, None)]


def test_t13_recode_unknown_is_null(spark):
    m = {"CO2": "CO2", "GWP_100_AR5_CH4": "CH4"}
    assert one(spark, conform.recode(F.lit("GWP_100_AR5_CH4"), m)) == "CH4"
    assert one(spark, conform.recode(F.lit("other"), m)) is None
    assert one(spark, conform.recode(F.lit(None).cast("string"), m)) is None


def test_t14_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("A", 2, "late"), ("A", 1, "early"), ("B", 5, "only")], "k string, o int, name string")
    assert sorted(tuple(r) for r in keep_first(df, ["k"], ["o"]).collect()) == [("A", 1, "early"), ("B", 5, "only")]


def test_t16_desc_puts_nulls_first(spark):
    from statlayer.plans.published import q4_listed_per_head
    cy = spark.createDataFrame([("A", 2020, 1.0, None, 5), ("B", 2020, 2.0, 0.5, 5)],
                               "country_code string, year int, total_mt double, t_per_person double, population long")
    dim = spark.createDataFrame([("A", "a"), ("B", "b")], "country_code string, country_name string")
    assert [r.country_name for r in q4_listed_per_head(cy, dim, ["A", "B"]).collect()] == ["a", "b"]


def test_t17_filtered_sum_without_rows_is_null(spark):
    df = spark.createDataFrame([(1, "N2O", 1.0)], "b int, g string, v double")
    assert df.groupBy("b").agg(F.sum(F.when(F.col("g") == "CH4", F.col("v"))).alias("s")).first().s is None


def test_t18_null_key_counts_as_unmatched(spark):
    df = spark.createDataFrame([("A",), (None,)], "k string")
    dim = spark.createDataFrame([("A",)], "k string")
    assert anti(df, dim, "k").count() == 1


def test_t19_gap_ratio(spark):
    assert one(spark, N.gap_ratio(F.lit(5.0), F.lit(0.0))) == math.inf
    assert one(spark, N.gap_ratio(F.lit(0.0), F.lit(0.0))) is None
    assert one(spark, N.gap_ratio(F.lit(11.0), F.lit(-10.0))) == pytest.approx(2.1)


def test_t20_flag_on_missing_value_does_not_break_reshape(spark):
    df = spark.createDataFrame([(1, None, "F", 2.0, "E")], "id int, Y2022 double, Y2022F string, Y2023 double, Y2023F string")
    rows = unpivot_pairs(df, ["id"], [(2022, "Y2022", "Y2022F"), (2023, "Y2023", "Y2023F")]).collect()
    assert [(r.year, r.value, r.flag) for r in rows] == [(2022, None, "F"), (2023, 2.0, "E")]


def test_t23_empty_code_falls_back(spark):
    df = spark.createDataFrame([("", "ZZ"), (None, "YY"), ("PHL", "PH")], "a string, b string")
    assert [r.c for r in df.select(X.first_present("a", F.col("b")).alias("c")).collect()] == ["ZZ", "YY", "PHL"]


def test_t24_mapping_last_duplicate_wins(spark):
    scope = spark.createDataFrame([(1, "SSD")], "area_code int, iso3 string")
    area = spark.createDataFrame([], "fao_area_code int, edgar_code string")
    cmap = spark.createDataFrame([("SSD", "AAA"), ("SSD", "SDN")], "wb_code string, edgar_code string")
    rows = conform.conform_codes(scope, "area_code", "iso3", area, cmap).collect()
    assert [r.country_code for r in rows] == ["SDN"]                      # no fan-out, last wins


def test_duplicate_rows_null_keys_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert duplicate_rows(df, ["a", "b"]).first().duplicate_rows == 1


def test_iso_lookup(spark):
    df = spark.createDataFrame([("'608",), ("'001",), ("736",), ("'12345",)], "m49 string")
    got = [r.iso3 for r in conform.with_iso3_from_numeric(df, "m49", conform.iso_table(spark)).collect()]
    assert sorted(got, key=str) == sorted(["PHL", None, None, None], key=str)
