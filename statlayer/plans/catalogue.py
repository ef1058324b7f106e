"""Query catalogue on the driver tables: one named query per operator family, each with a DuckDB SQL
twin stating the same result (the correctness oracle). Every query reads whole tables.

Parity rules used throughout: money is summed as exact ``decimal(18,2)`` and returned as double;
ratios are rounded to 6 places; years are ``int``; every top-k has a unique tie-break.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlayer.operators import conform
from statlayer.operators.aggregate import complete_group_sums, sorted_text_join
from statlayer.operators.joins import anti, fixed_dim, orphan_count, semi
from statlayer.operators.reshape import pivot_fixed, pivot_years, unpivot_measure, unpivot_pairs, year_columns, year_of_header
from statlayer.plans import analog as A
from statlayer.plans import products as P
from statlayer.plans import published as Q
from statlayer.sources.tables import read_table

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
MONEY = "decimal(18,2)"


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read_table(spark, d, name)


def dbl(*cols: str) -> list:
    return [F.col(c).cast("double").alias(c) for c in cols]


def r6(col: str):
    return F.round(F.col(col), 6).alias(col)


# ------------------------------------------------------------------------ flagship product
@register("country_year_product", f"""WITH {A.SQL_COUNTRY_YEAR}
SELECT country_code, year, CAST(co2_mt AS DOUBLE) AS co2_mt, CAST(ch4_mt AS DOUBLE) AS ch4_mt,
  CAST(n2o_mt AS DOUBLE) AS n2o_mt, CAST(total_mt AS DOUBLE) AS total_mt,
  ROUND(share_of_world_pct, 6) AS share_of_world_pct, ROUND(yoy_change_pct, 6) AS yoy_change_pct,
  population, ROUND(t_per_person, 6) AS t_per_person, is_estimate, edgar_edition
FROM country_year""")
def country_year_product(spark, d):
    """D6 + W1 + W2 + A11 + R4 + J2 + P18 on lineitem/orders/customer/nation."""
    cy = A.country_year(spark, d)
    return cy.select("country_code", "year", *dbl("co2_mt", "ch4_mt", "n2o_mt", "total_mt"),
                     r6("share_of_world_pct"), r6("yoy_change_pct"), "population", r6("t_per_person"),
                     "is_estimate", "edgar_edition")


# ------------------------------------------------------------------------------ reshape
@register("unpivot_measures", """SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS year, SUM(l_quantity) AS quantity
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1, 2""")
def unpivot_measures(spark, d):
    """R1 + P2: a wide part x year matrix (one column per year, null = no data) back to long rows."""
    li = t(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"), "l_quantity")
    wide = pivot_years(li, ["l_partkey"], "y", A.YEARS, {"{year}": lambda of: F.sum(of("l_quantity"))})
    long = unpivot_measure(wide, ["l_partkey"], year_columns(wide), "__y", "quantity")
    return long.where(F.col("quantity").isNotNull()).select("l_partkey", year_of_header("__y", year_columns(wide)).alias("year"),
                                                             "quantity")


@register("unpivot_value_flag", """SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, MAX(o_orderstatus) AS flag
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2""")
def unpivot_value_flag(spark, d):
    """R2: paired value/flag columns per year (Y1995, Y1995F, ...) back to (year, value, flag)."""
    o = t(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y"),
                                     F.col("o_totalprice").cast(MONEY).alias("v"), "o_orderstatus")
    wide = pivot_years(o, ["o_custkey"], "y", A.YEARS, {"Y{year}": lambda of: F.sum(of("v")),
                                                       "Y{year}F": lambda of: F.max(of("o_orderstatus"))})
    long = unpivot_pairs(wide, ["o_custkey"], [(y, f"Y{y}", f"Y{y}F") for y in A.YEARS], "year", "value", "flag")
    return long.where(F.col("value").isNotNull())


@register("pivot_fixed", """SELECT year,
  SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a_qty,
  SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS n_qty,
  SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r_qty,
  SUM(CASE WHEN l_returnflag = 'X' THEN l_quantity END) AS x_qty
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, l_quantity FROM lineitem)
WHERE year IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY year""")
def pivot_fixed_query(spark, d):
    """R4 + P21: fixed pivot values; 'X' has no rows and still gets its (null) column."""
    li = t(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), "l_returnflag", "l_quantity")
    return pivot_fixed(li, ["year"], "l_returnflag", "l_quantity",
                       {"A": "a_qty", "N": "n_qty", "R": "r_qty", "X": "x_qty"})


@register("explode_codes", """WITH p AS (
  SELECT r_name, string_agg(n_name, ';' ORDER BY n_name) AS nations
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
SELECT r_name, nations, unnest(string_split(nations, ';')) AS n_name FROM p""")
def explode_codes(spark, d):
    """A4 + R5: sorted text join of the parts per group, then split back to one row per part."""
    n, r = t(spark, d, "nation"), fixed_dim(t(spark, d, "region"))
    parts = n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name") \
        .agg(sorted_text_join("n_name", ";").alias("nations"))
    return parts.select("r_name", "nations", F.explode(F.split("nations", ";")).alias("n_name"))


# -------------------------------------------------------------------------- conforming
@register("complete_groups", """WITH m AS (SELECT DISTINCT r_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey),
e AS (SELECT r_name, COUNT(*) AS expected FROM m GROUP BY r_name),
f AS (SELECT c.c_nationkey, CAST(date_trunc('week', o.o_orderdate) AS DATE) AS week,
             CAST(o.o_totalprice AS DECIMAL(18,2)) AS v
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
g AS (SELECT m.r_name, f.week, SUM(f.v) AS total, COUNT(DISTINCT m.n_nationkey) AS found
      FROM m JOIN f ON m.n_nationkey = f.c_nationkey GROUP BY 1, 2)
SELECT g.r_name, g.week, CAST(g.total AS DOUBLE) AS total FROM g JOIN e USING (r_name) WHERE g.found = e.expected""")
def complete_groups(spark, d):
    """A2 + A3: region-week order totals, kept only when every nation of the region has orders."""
    n, r = t(spark, d, "nation"), fixed_dim(t(spark, d, "region"))
    members = n.join(r, n.n_regionkey == r.r_regionkey).select("r_name", "n_nationkey")
    facts = A.orders_with_nation(spark, d, "o_orderdate", "o_totalprice").select(
        "c_nationkey", F.to_date(F.date_trunc("week", "o_orderdate")).alias("week"),
        F.col("o_totalprice").cast(MONEY).alias("v"))
    out = complete_group_sums(members, facts, "r_name", "n_nationkey", "c_nationkey", ["week"], "v", "total")
    return out.select("r_name", "week", F.col("total").cast("double").alias("total"))


@register("dim_with_parts", """WITH e AS (
  SELECT r.r_name AS code, c.c_name AS name, c.c_custkey AS ord FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT n.n_name, s.s_name, s.s_suppkey FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
f AS (SELECT code, arg_min(name, ord) AS name FROM e GROUP BY code),
p AS (SELECT r_name AS code, string_agg(n_name, ';' ORDER BY n_name) AS parts
      FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
SELECT f.code AS country_code, f.name AS country_name, COALESCE(p.parts, f.code) AS wb_codes,
  contains(COALESCE(p.parts, f.code), ';') AS is_merged
FROM f LEFT JOIN p USING (code)""")
def dim_with_parts(spark, d):
    """Codes from two fact tables (region codes from customers, nation codes from suppliers), first
    name in key order, part codes from the nation->region mapping, merged flag."""
    n, r = t(spark, d, "nation"), fixed_dim(t(spark, d, "region"))
    nr = fixed_dim(n.join(r, n.n_regionkey == r.r_regionkey))
    c, s = t(spark, d, "customer"), t(spark, d, "supplier")
    from_customers = c.join(nr, c.c_nationkey == nr.n_nationkey).select(
        F.col("r_name").alias("country_code"), F.col("c_name").alias("country_name"), F.col("c_custkey").alias("ord"))
    from_suppliers = s.join(fixed_dim(n), s.s_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("country_code"), F.col("s_name").alias("country_name"), F.col("s_suppkey").alias("ord"))
    mapping = nr.select(F.col("n_name").alias("wb_code"), F.col("r_name").alias("edgar_code"))
    return P.build_dim_country(from_customers.unionByName(from_suppliers), mapping, order=["ord"])


DIM_WITH_PARTS_SQL = """WITH e AS (
  SELECT r.r_name AS code, c.c_name AS name, c.c_custkey AS ord FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  UNION ALL
  SELECT n.n_name, s.s_name, s.s_suppkey FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
f AS (SELECT code, arg_min(name, ord) AS name FROM e GROUP BY code),
p AS (SELECT r_name AS code, string_agg(n_name, ';' ORDER BY n_name) AS parts
      FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
SELECT f.code AS country_code, f.name AS country_name, COALESCE(p.parts, f.code) AS wb_codes,
  contains(COALESCE(p.parts, f.code), ';') AS is_merged
FROM f LEFT JOIN p USING (code)"""


@register("merged_population", f"""WITH dim AS ({DIM_WITH_PARTS_SQL}),
parts AS (SELECT country_code, unnest(string_split(wb_codes, ';')) AS wb_code FROM dim),
pop AS (SELECT n.n_name AS iso3, CAST(year(o.o_orderdate) AS INTEGER) AS year, COUNT(DISTINCT o.o_custkey) AS population
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY 1, 2),
expected AS (SELECT country_code, COUNT(DISTINCT wb_code) AS n FROM parts GROUP BY 1),
found AS (SELECT p.country_code, pop.year, SUM(pop.population) AS population, COUNT(DISTINCT p.wb_code) AS n
          FROM parts p JOIN pop ON p.wb_code = pop.iso3 GROUP BY 1, 2)
SELECT f.country_code, f.year, CAST(f.population AS BIGINT) AS population
FROM found f JOIN expected e USING (country_code) WHERE f.n = e.n""")
def merged_population(spark, d):
    """D5 + R5 + J1 + A2: population of merged codes (a region = its nations) only in years where EVERY
    part has a value; single codes keep their own value."""
    dim = dim_with_parts(spark, d)
    pop = A.population(spark, d).select(F.col("country_code").alias("iso3"), "year", "population",
                                        F.lit(True).alias("is_country"))
    return P.population_for_countries(pop, dim)


@register("conform_codes", """WITH s AS (
  SELECT s.s_suppkey, s.s_nationkey AS area_code, CASE WHEN s.s_acctbal >= 0 THEN n.n_name END AS iso3
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
sp AS (SELECT r_regionkey AS area, r_name AS special FROM region),
mg AS (SELECT n_name AS iso, r_name AS merged FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE')
SELECT s.s_suppkey, COALESCE(sp.special, CASE WHEN s.iso3 IS NOT NULL THEN COALESCE(mg.merged, s.iso3) END) AS country_code
FROM s LEFT JOIN sp ON s.area_code = sp.area LEFT JOIN mg ON s.iso3 = mg.iso""")
def conform_codes_query(spark, d):
    """J7 + P16: special area map first, then merged-code map, then the own code (null code stays null)."""
    s, n, r = t(spark, d, "supplier"), t(spark, d, "nation"), t(spark, d, "region")
    scope = s.join(fixed_dim(n), s.s_nationkey == n.n_nationkey).select(
        "s_suppkey", F.col("s_nationkey").alias("area_code"),
        F.when(F.col("s_acctbal") >= 0, F.col("n_name")).alias("iso3"))
    area_map = r.select(F.col("r_regionkey").alias("fao_area_code"), F.col("r_name").alias("edgar_code"))
    nr = n.join(fixed_dim(r), n.n_regionkey == r.r_regionkey).where(F.col("r_name") == "EUROPE")
    country_map = nr.select(F.col("n_name").alias("wb_code"), F.col("r_name").alias("edgar_code"))
    return conform.conform_codes(scope, "area_code", "iso3", area_map, country_map).select("s_suppkey", "country_code")


@register("split_routes", """WITH dimc AS (
  SELECT DISTINCT n.n_name AS code FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE s.s_acctbal > 5000),
sc AS (SELECT c.c_nationkey AS area_code, n.n_name AS iso3, CAST(c.c_acctbal AS DECIMAL(18,2)) AS value
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
routed AS (SELECT sc.*, CASE WHEN d.code IS NULL THEN 'unmatched' WHEN sc.value < 0 THEN 'rejected' ELSE 'good' END AS route
           FROM sc LEFT JOIN dimc d ON sc.iso3 = d.code)
SELECT route, COUNT(*) AS rows, CAST(SUM(value) AS DOUBLE) AS total_value, COUNT(DISTINCT area_code) AS areas
FROM routed GROUP BY route""")
def split_routes(spark, d):
    """P24 + D9 + A6: one routed pass (unmatched before rejected before good), counts and sums per route."""
    c, n, s = t(spark, d, "customer"), t(spark, d, "nation"), t(spark, d, "supplier")
    scope = c.join(fixed_dim(n), c.c_nationkey == n.n_nationkey).select(
        F.col("c_nationkey").alias("area_code"), F.col("n_name").alias("iso3"),
        F.col("c_acctbal").cast(MONEY).alias("value"))
    dim = s.where(F.col("s_acctbal") > 5000).join(fixed_dim(n), s.s_nationkey == n.n_nationkey) \
        .select(F.col("n_name").alias("country_code"))
    empty_area = spark.createDataFrame([], "fao_area_code int, edgar_code string")
    empty_country = spark.createDataFrame([], "wb_code string, edgar_code string")
    routed = P.route_scope(scope, dim, empty_area, empty_country)
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("rows"),
                                       F.sum("value").cast("double").alias("total_value"),
                                       F.count_distinct("area_code").alias("areas"))


@register("by_activity_product", f"""WITH {A.SQL_BY_ACTIVITY}, {A.SQL_DIM_ACTIVITY}
SELECT f.country_code, f.activity_code, a.activity_name AS activity, a.activity_group, f.year,
  CAST(f.emissions_mt_co2eq AS DOUBLE) AS emissions_mt_co2eq
FROM by_activity f LEFT JOIN dim_activity a USING (activity_code)""")
def by_activity_product(spark, d):
    """J3 + A1: country x activity x year, enriched from the activity dimension."""
    f = A.by_activity(spark, d)
    dim = A.dim_activity(spark, d)
    return f.join(dim, "activity_code", "left").select(
        "country_code", "activity_code", F.col("activity_name").alias("activity"), "activity_group", "year",
        F.col("emissions_mt_co2eq").cast("double").alias("emissions_mt_co2eq"))


@register("two_source_comparison", f"""WITH {A.SQL_COMPARISON}
SELECT country_code, year, CAST(edgar_total_mt AS DOUBLE) AS edgar_total_mt,
  CAST(faostat_total_mt AS DOUBLE) AS faostat_total_mt, CAST(difference_mt AS DOUBLE) AS difference_mt,
  ROUND(difference_pct, 6) AS difference_pct
FROM comparison""")
def two_source_comparison(spark, d):
    """D10 + J4: line totals vs order totals per nation-year, keys in both, difference and %."""
    cmp = A.comparison(spark, d)
    return cmp.select("country_code", "year", *dbl("edgar_total_mt", "faostat_total_mt", "difference_mt"),
                      r6("difference_pct"))


# ------------------------------------------------------------------------------- joins
@register("semi_rows", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def semi_rows(spark, d):
    """Orders that have lines."""
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return semi(o, li, "o_orderkey")


@register("anti_rows", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def anti_rows(spark, d):
    """Orders without lines."""
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return anti(o, li, "o_orderkey")


@register("orphan_count", """SELECT 'lineitem->orders' AS relation, COUNT(*) AS orphans FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderkey IS NULL
UNION ALL
SELECT 'orders->customer', COUNT(*) FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_custkey IS NULL
UNION ALL
SELECT 'orders->lineitem', COUNT(*) FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l
  ON o.o_orderkey = l.l_orderkey WHERE l.l_orderkey IS NULL""")
def orphan_count_query(spark, d):
    """Rows whose key is missing on the other side, per relation."""
    li, o, c = t(spark, d, "lineitem"), t(spark, d, "orders"), t(spark, d, "customer")
    return (orphan_count(li, o, "l_orderkey", "o_orderkey", "lineitem->orders")
            .unionByName(orphan_count(o, c, "o_custkey", "c_custkey", "orders->customer"))
            .unionByName(orphan_count(o, li, "o_orderkey", "l_orderkey", "orders->lineitem")))


# -------------------------------------------------------------------- published queries
GASES_ANALOG = {"A": "co2_pct", "N": "ch4_pct", "R": "n2o_pct"}
LISTED = ["NATION_1", "NATION_3", "NATION_5", "NATION_7", "NATION_9", "NATION_11"]
FLOOR = 10_000_000


@register("latest_top10", f"WITH {A.SQL_COUNTRY_YEAR}, {A.SQL_DIM_COUNTRY}\n{Q.sql_q1(10)}")
def latest_top10(spark, d):
    """Q1: top 10 by total in the latest year (scalar subquery + top-k)."""
    return Q.q1_top_emitters(A.published(spark, d, 'country_year'), A.published(spark, d, 'dim_country'), 10)


@register("one_country_series", f"WITH {A.SQL_COUNTRY_YEAR}\n{Q.sql_q2('NATION_1', 1996)}")
def one_country_series(spark, d):
    """Q2: one country since a year, with one measure's share and the per-head value."""
    return Q.q2_country_series(A.published(spark, d, 'country_year'), "NATION_1", 1996)


@register("gas_share_by_bucket", f"WITH {A.SQL_FACT}\n{Q.sql_q3(GASES_ANALOG, 5, 'bucket')}")
def gas_share_by_bucket(spark, d):
    """Q3: FILTER shares per 5-year bucket (integer division)."""
    return Q.q3_gas_share_by_bucket(A.published(spark, d, 'fact_emissions'), GASES_ANALOG, 5, bucket_name="bucket")


@register("listed_per_head", f"WITH {A.SQL_COUNTRY_YEAR}, {A.SQL_DIM_COUNTRY}\n{Q.sql_q4(LISTED)}")
def listed_per_head(spark, d):
    """Q4: listed countries per head in the latest year having population."""
    return Q.q4_listed_per_head(A.published(spark, d, 'country_year'), A.published(spark, d, 'dim_country'), LISTED)


@register("self_join_growth", f"WITH {A.SQL_COUNTRY_YEAR}, {A.SQL_DIM_COUNTRY}\n{Q.sql_q5(1996, FLOOR)}")
def self_join_growth(spark, d):
    """Base year vs latest year self-join, growth, top 10."""
    return Q.q5_fastest_growing(A.published(spark, d, 'country_year'), A.published(spark, d, 'dim_country'), 1996, FLOOR)


@register("freshness", Q.sql_q6("events", "event_type", "ts"))
def freshness(spark, d):
    """Q6 / A10: latest time and number of rows per type."""
    return Q.q6_freshness(t(spark, d, "events"), "event_type", "ts")


@register("yearly_total", f"WITH {A.SQL_FACT}\n{Q.sql_q7(1997)}")
def yearly_total(spark, d):
    """Q7: total per year from a year on."""
    return Q.q7_yearly_total(A.published(spark, d, 'fact_emissions'), 1997)


@register("breakdown_share", f"WITH {A.SQL_BY_ACTIVITY}, {A.SQL_DIM_ACTIVITY}\n{Q.sql_q8('NATION_1')}")
def breakdown_share(spark, d):
    """One country's activities in the latest year, share of the whole result."""
    return Q.q8_breakdown_share(A.published(spark, d, 'by_activity'), A.published(spark, d, 'dim_activity'), "NATION_1")


@register("group_every_n_years", f"WITH {A.SQL_BY_ACTIVITY}, {A.SQL_DIM_ACTIVITY}\n{Q.sql_q9(5)}")
def group_every_n_years(spark, d):
    """Activity groups every 5th year and the latest year."""
    return Q.q9_groups_every_n_years(A.published(spark, d, 'by_activity'), A.published(spark, d, 'dim_activity'), 5)


@register("largest_differences", f"WITH {A.SQL_COMPARISON}, {A.SQL_DIM_COUNTRY}\n{Q.sql_q10(FLOOR)}")
def largest_differences(spark, d):
    """Q10: largest relative source differences in the latest common year, ordered by ABS."""
    return Q.q10_largest_differences(A.published(spark, d, 'comparison'), A.published(spark, d, 'dim_country'), FLOOR)


# second half of the catalogue registers itself on import
from statlayer.plans import catalogue_more, catalogue_rules  # noqa: E402,F401
