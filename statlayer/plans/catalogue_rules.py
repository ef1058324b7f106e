"""Catalogue, part three: the business rules, suites and product builders themselves on the driver tables, with
inputs that make them fail: real gaps, zero totals, missing parts, unmatched and negative rows, bad cells."""
from __future__ import annotations

from pyspark.sql import functions as F

from statlayer import settings
from statlayer.operators import conform
from statlayer.plans import analog as A
from statlayer.plans import products as P
from statlayer.plans.catalogue import MONEY, register, t
from statlayer.operators.reshape import pivot_years
from statlayer.profile.sources import profile_matrix, profile_stats, sections, yearly_cells
from statlayer.quality import checks as C
from statlayer.quality import rules as R
from statlayer.session import scratch_path
from statlayer.settings import Settings
from statlayer.sources import files as src

CFG = Settings(stats_first_year=1996)
LEFT_OUT = "NATION_3"          # a nation that some inputs lack, so that the rules find gaps
PARTS = settings.CHINA_PART_CODES
ITEMS = list(settings.ACTIVITIES)


# ------------------------------------------------------------------------ reconciliations
def matrix_frame(spark, d):
    """Nation rows, and world rows that leave out the lines of number 7; a sector whose totals are all 0."""
    parts = A.published(spark, d, "fact_emissions").select(
        F.lit("lines").alias("sector"), F.col("gas_code").alias("gas"), "year", F.lit("country").alias("country_type"), "country_code",
        F.col("emissions_mt_co2eq").cast("double").alias("emissions_mt_co2eq"))
    world = t(spark, d, "lineitem").where("l_linenumber < 7").groupBy(F.col("l_returnflag").alias("gas"), F.year("l_shipdate").alias("year")) \
        .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("emissions_mt_co2eq")) \
        .withColumns({"sector": F.lit("lines"), "country_type": F.lit("aggregate"), "country_code": F.lit(settings.WORLD_CODE)})
    rows = parts.unionByName(world)
    return rows.unionByName(rows.withColumn("sector", F.lit("nothing")).withColumn("emissions_mt_co2eq", F.lit(0.0)))


def population_frame(spark, d):
    """Nations, and a world row of the customers with an order above 50,000."""
    nations = A.population(spark, d).select(F.col("country_code").alias("iso3"), "year", "population", F.lit(True).alias("is_country"))
    world = t(spark, d, "orders").where("o_totalprice > 50000").groupBy(F.year("o_orderdate").alias("year")) \
        .agg(F.count_distinct("o_custkey").cast("long").alias("population")) \
        .withColumns({"iso3": F.lit(settings.WORLD_POPULATION_CODE), "is_country": F.lit(False)})
    return nations.unionByName(world)


def stats_frame(spark, d):
    """Orders as activity statistics: area = nation (the first four are the composite's parts), item = priority, with a
    world row without urgent orders, a composite row of the first three parts, and rounded subtotals."""
    rows = A.orders_with_nation(spark, d, "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus").select(
        "c_nationkey", F.year("o_orderdate").alias("year"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_totalprice").cast(MONEY).alias("v"), "o_orderstatus")
    nation = F.col("c_nationkey")
    area = F.when(nation < 4, F.element_at(F.array(*map(F.lit, PARTS)), nation + 1)).otherwise(1000 + nation)
    item = F.element_at(F.array(*map(F.lit, ITEMS)), F.col("priority"))
    cells = rows.groupBy(area.alias("area_code"), item.alias("item_code"), "year", "c_nationkey", "priority", (F.col("o_orderstatus") == "P").alias("is_projection")) \
        .agg(F.sum("v").alias("v"))
    plain = cells.select("area_code", "item_code", "year", "v", "is_projection", F.lit(False).alias("is_aggregate"))
    above = lambda code, which: cells.where(which).groupBy("item_code", "year", "is_projection").agg(F.sum("v").alias("v")) \
        .select(F.lit(code).alias("area_code"), "item_code", "year", "v", "is_projection", F.lit(True).alias("is_aggregate"))
    world = above(settings.WORLD_AREA_CODE, F.col("priority") != 1)
    composite = above(settings.CHINA_AREA_CODE, F.col("c_nationkey") < 3)
    subtotal = cells.groupBy("area_code", "year", F.when(F.col("priority") <= 3, settings.SUBTOTAL_ITEMS[0]).otherwise(settings.SUBTOTAL_ITEMS[1]).alias("item_code"),
                             "is_projection").agg(F.round(F.sum("v"), -1).cast("decimal(28,2)").alias("v")) \
        .select("area_code", "item_code", "year", "v", "is_projection", F.lit(False).alias("is_aggregate"))
    everything = plain.unionByName(world).unionByName(composite).unionByName(subtotal)
    return everything.select("area_code", "item_code", "year", F.col("v").cast("double").alias("value"), "is_projection", "is_aggregate",
                             F.lit(settings.STATS_SOURCE).alias("source"), F.lit(settings.STATS_ELEMENT).alias("element"))


SQL_STATS = f"""cells AS (
  SELECT CASE c.c_nationkey {" ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(PARTS))} ELSE 1000 + c.c_nationkey END AS area, c.c_nationkey AS nation,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS priority,
         o.o_orderstatus = 'P' AS projection, SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY ALL),
used AS (SELECT * FROM cells WHERE year >= {CFG.stats_first_year} AND NOT projection)"""


def gap_text(parts: str, total: str) -> str:
    """Relative gap of two numbers as the rules take it: x/0 is infinite, 0/0 is skipped."""
    return f"CASE WHEN {total} <> 0 THEN ABS({parts} - {total}) / ABS({total}) WHEN {parts} <> 0 THEN 'inf'::DOUBLE END"


@register("rule_reconciliations", f"""WITH {A.SQL_FACT}, {SQL_STATS},
matrix_parts AS (SELECT gas_code, year, CAST(SUM(emissions_mt_co2eq) AS DOUBLE) AS p FROM fact_emissions GROUP BY 1, 2),
matrix_world AS (SELECT l_returnflag AS gas_code, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS w
  FROM lineitem WHERE l_linenumber < 7 GROUP BY 1, 2),
v9 AS (SELECT MAX(ABS(p - w) / CASE WHEN w > 0 THEN w END) AS g, 2 * COUNT(*) AS n FROM matrix_parts JOIN matrix_world USING (gas_code, year)),
heads AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(DISTINCT o_custkey) AS p, COUNT(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 50000) AS t
  FROM orders GROUP BY 1),
v10 AS (SELECT MAX({gap_text('p', 't')}) AS g, COUNT(*) AS n FROM heads WHERE t > 0),
world AS (SELECT year, CAST(SUM(v) AS DOUBLE) AS p, CAST(SUM(v) FILTER (WHERE priority <> 1) AS DOUBLE) AS t FROM used GROUP BY 1),
v12 AS (SELECT MAX({gap_text('p', 't')}) AS g, COUNT(*) AS n FROM world WHERE t IS NOT NULL),
composite AS (SELECT year, CAST(SUM(v) AS DOUBLE) AS p, CAST(SUM(v) FILTER (WHERE nation < 3) AS DOUBLE) AS t FROM used WHERE nation < 4 GROUP BY 1),
v13 AS (SELECT MAX({gap_text('p', 't')}) AS g, COUNT(*) AS n FROM composite WHERE t IS NOT NULL),
items AS (SELECT area, year, SUM(v) AS p FROM used GROUP BY 1, 2),
halves AS (SELECT area, year, priority <= 3 AS half, ROUND(SUM(v), -1) AS t FROM used GROUP BY 1, 2, 3),
subtotals AS (SELECT area, year, SUM(t) AS t FROM halves GROUP BY 1, 2),
v14 AS (SELECT MAX(ABS(CAST(p AS DOUBLE) - CAST(t AS DOUBLE))) AS g, COUNT(*) AS n FROM items JOIN subtotals USING (area, year)),
kinds AS (
  SELECT area AS a, priority AS i, year, projection FROM cells GROUP BY ALL
  UNION ALL SELECT 5000, priority, year, projection FROM cells WHERE priority <> 1 GROUP BY ALL
  UNION ALL SELECT 351, priority, year, projection FROM cells WHERE nation < 3 GROUP BY ALL
  UNION ALL SELECT area, CASE WHEN priority <= 3 THEN 10 ELSE 11 END, year, projection FROM cells GROUP BY ALL),
v15 AS (SELECT COUNT(*) FILTER (WHERE NOT projection) AS n FROM kinds WHERE year > 2000)
SELECT 'business rule: GLOBAL TOTAL = sum of countries' AS "check", g < 1e-6 AS passed,
  'largest relative gap ' || format('{{:.2e}}', g) || ' over ' || format('{{:,}}', n) || ' sector-gas-years' AS details, 'error' AS severity FROM v9
UNION ALL SELECT 'business rule: World population = sum of countries (within 0.5%)', g <= 0.005,
  'largest relative gap ' || format('{{:.4f}}', g * 100) || '% over ' || n || ' years', 'warning' FROM v10
UNION ALL SELECT 'business rule: World = sum of countries (8 activities)', g < 0.001, 'largest relative gap ' || format('{{:.2e}}', g) || ' over ' || n || ' years', 'error' FROM v12
UNION ALL SELECT 'business rule: ''China'' = mainland + Hong Kong + Macao + Taiwan', g < 0.001,
  'largest relative gap ' || format('{{:.2e}}', g) || ' over ' || n || ' years', 'error' FROM v13
UNION ALL SELECT 'business rule: 8 activities = FAOSTAT crops + livestock subtotals (within 9.0 kt)', g <= 9,
  'largest gap ' || format('{{:.3f}}', g) || ' kt over ' || format('{{:,}}', n) || ' area-years', 'error' FROM v14
UNION ALL SELECT 'future years are only projections (flag F)', n = 0, n || ' future rows without the projection flag', 'error' FROM v15""")
def rule_reconciliations(spark, d):
    """V9-V15 + V24: the reconciliation rules themselves, on inputs with real gaps, zero totals and rows out of scope."""
    stats = stats_frame(spark, d)
    activities = R.activity_rows(stats, CFG)
    return C.evaluate(spark.range(1), [
        R.world_total_matches_parts(matrix_frame(spark, d)), R.world_population_matches_countries(population_frame(spark, d)),
        R.stats_world_matches_countries(activities), R.stats_composite_matches_parts(activities),
        R.stats_activities_match_subtotals(stats, 9.0, CFG), R.future_only_projections(stats, 2000)])


@register("rule_gap", f"""WITH l AS (SELECT l_suppkey % 50 AS k, CAST(year(l_shipdate) AS INTEGER) AS year, CASE WHEN l_suppkey % 50 < 2 THEN 0 ELSE l_quantity END AS q FROM lineitem),
parts AS (SELECT k, year, SUM(q) FILTER (WHERE k <> 9) AS p, SUM(CASE WHEN k IN (1, 5) THEN 0 WHEN k = 7 THEN q * 1.5 ELSE q END) AS t FROM l GROUP BY 1, 2),
pairs AS (SELECT {gap_text('p', 't')} AS g, ABS(p - t) AS a, k FROM parts WHERE p IS NOT NULL AND t IS NOT NULL)
SELECT 'all' AS keys, MAX(g) AS relative_gap, COUNT(*) AS compared, MAX(a) AS absolute_gap FROM pairs
UNION ALL SELECT 'no zero totals', MAX(g) FILTER (WHERE k <> 5), COUNT(*) FILTER (WHERE k <> 5), MAX(a) FILTER (WHERE k <> 5) FROM pairs
UNION ALL SELECT 'no common key', 1.0, 0, 'inf'::DOUBLE""")
def rule_gap(spark, d):
    """The largest gap between two keyed aggregates: x/0 is infinite, 0/0 and missing sides are skipped, no
    common key is a gap of 1 (relative) or infinite (absolute)."""
    k = F.col("l_suppkey") % 50
    rows = t(spark, d, "lineitem").select(k.alias("k"), F.year("l_shipdate").alias("year"), F.when(k < 2, 0.0).otherwise(F.col("l_quantity")).alias("value"))
    total = rows.withColumn("value", F.when(F.col("k").isin(1, 5), 0.0).when(F.col("k") == 7, F.col("value") * 1.5).otherwise(F.col("value")))
    parts = rows.where("k <> 9")
    out = None
    for name, p in (("all", parts), ("no zero totals", parts.where("k <> 5")), ("no common key", parts.withColumn("k", F.col("k") + 100))):
        (gap, n), (absolute, _) = R.keyed_gap(p, total, ["k", "year"]), R.keyed_gap(p, total, ["k", "year"], relative=False)
        row = spark.range(1).select(F.lit(name).alias("keys"), gap.alias("relative_gap"), n.alias("compared"), absolute.alias("absolute_gap"))
        out = row if out is None else out.unionByName(row)
    return out


@register("rule_coverage", f"""WITH {A.SQL_COMPARISON}, {A.SQL_BY_ACTIVITY.split(A.SQL_ORDER_NATION + ",")[1]},
seen AS (SELECT * FROM country_year WHERE country_code <> '{LEFT_OUT}'),
v18 AS (SELECT 100.0 * CAST(SUM(total_mt) FILTER (WHERE population IS NOT NULL AND country_code <> '{LEFT_OUT}') AS DOUBLE) / CAST(SUM(total_mt) AS DOUBLE) AS c
  FROM country_year WHERE year IN (SELECT year FROM country_year WHERE population IS NOT NULL AND country_code <> '{LEFT_OUT}')),
v19 AS (SELECT MAX(ABS(s - 100)) AS g FROM (SELECT SUM(share_of_world_pct) AS s FROM seen GROUP BY year)),
latest AS (SELECT MAX(year(l_shipdate)) AS y FROM lineitem),
v20 AS (SELECT 100.0 * (SELECT CAST(SUM(emissions_mt_co2eq) AS DOUBLE) FROM by_activity WHERE country_code <> '{LEFT_OUT}' AND year = (SELECT y FROM latest))
    / (SELECT CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem WHERE year(l_shipdate) = (SELECT y FROM latest)) AS c),
v21 AS (SELECT MAX(100.0 * ABS(f - e) / NULLIF(e, 0)) AS g, COUNT(*) AS n FROM (
  SELECT CAST(SUM(edgar_total_mt) AS DOUBLE) AS e, CAST(SUM(faostat_total_mt) AS DOUBLE) AS f FROM comparison GROUP BY year)),
v17 AS (SELECT COUNT(*) AS n, COALESCE(string_agg('''' || k || '''', ', ' ORDER BY k), '') AS codes FROM (SELECT DISTINCT country_code AS k FROM country_year WHERE country_code = '{LEFT_OUT}'))
SELECT 'population coverage >= 99.0% of emissions' AS "check", c >= 99 AS passed, 'coverage ' || format('{{:.2f}}', c) || '%' AS details, 'error' AS severity FROM v18
UNION ALL SELECT 'shares of world emissions add up to 100% each year', g < 1e-6, 'largest gap ' || format('{{:.2e}}', g) || ' percentage points', 'error' FROM v19
UNION ALL SELECT 'FAOSTAT coverage >= 99.5% of emissions (latest year)', c >= 99.5, 'coverage ' || format('{{:.3f}}', c) || '%', 'error' FROM v20
UNION ALL SELECT 'EDGAR and FAOSTAT world totals agree within 15.0%', g <= 15, 'largest gap ' || format('{{:.1f}}', g) || '% over ' || n || ' years', 'error' FROM v21
UNION ALL SELECT 'referential integrity: every country is in dim_country', n = 0, 'unknown codes: [' || codes || ']', 'error' FROM v17""")
def rule_coverage(spark, d):
    """Coverage, share and agreement rules on products that lack a nation."""
    cy = A.published(spark, d, "country_year")
    known = F.col("country_code") != LEFT_OUT
    unknown_heads = cy.withColumn("population", F.when(known, F.col("population")))
    scope = t(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), (F.col("l_extendedprice").cast(MONEY) * 1000).alias("value"))
    by_activity = A.published(spark, d, "by_activity").where(known)
    dim = A.published(spark, d, "dim_country")
    return C.evaluate(spark.range(1), [
        R.population_coverage(unknown_heads, 99.0), R.shares_add_up(cy.where(known)), R.match_coverage_latest(by_activity, scope, 99.5),
        R.sources_agree(A.published(spark, d, "comparison"), 15.0), R.referential_integrity(cy, dim.where(known), "country_code")])


@register("suite_results", f"""WITH {A.SQL_COMPARISON},
v21 AS (SELECT MAX(100.0 * ABS(f - e) / NULLIF(e, 0)) AS g, COUNT(*) AS n FROM (
  SELECT CAST(SUM(edgar_total_mt) AS DOUBLE) AS e, CAST(SUM(faostat_total_mt) AS DOUBLE) AS f FROM comparison GROUP BY year)),
twice AS (SELECT COUNT(*) FILTER (WHERE year = 1997) AS n FROM comparison)
SELECT 'unique key: (country_code, year)' AS "check", n = 0 AS passed, n || ' duplicate rows' AS details, 'error' AS severity FROM twice
UNION ALL SELECT 'EDGAR and FAOSTAT world totals agree within 15.0%', g <= 15, 'largest gap ' || format('{{:.1f}}', g) || '% over ' || n || ' years', 'error' FROM v21""")
def suite_results(spark, d):
    """A dataset's declared suite, run by ``judge``, on a comparison whose rows of one year stand twice."""
    both = A.published(spark, d, "comparison")
    return R.judge({"comparison": both.unionByName(both.where("year = 1997"))}, CFG)


# ------------------------------------------------------------------------ D9
def activity_scope(spark, d):
    """Order lines as activity statistics (kt): area = customer nation; nations 20 and up have no code, 0 and 1 are special
    areas, 2 is merged into 3, returned lines of small quantity are negative."""
    lines = A.lines_with_nation(spark, d, "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    n = F.split("n_name", "_").getItem(1).cast("int")
    value = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") < 5), -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return lines.select(n.alias("area_code"), F.when((n > 1) & (n < 20), F.concat(F.lit("C"), n.cast("string"))).alias("iso3"), F.col("n_name").alias("area"),
                        F.element_at(F.array(*map(F.lit, ITEMS)), (F.col("l_suppkey") % 8 + 1).cast("int")).alias("item_code"),
                        F.year("l_shipdate").alias("year"), value.alias("value"))


def activity_products(spark, d):
    dim = t(spark, d, "nation").where("n_nationkey <> 5").select(F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("country_code"))
    areas = conform.area_mapping(spark, rows=[(0, "zero", "C9", "gone"), (1, "one", "C3", ""), (0, "zero", "C4", "listed last")])
    countries = conform.country_mapping(spark, rows=[("C2", "C3", "merged")])
    return P.build_by_activity(activity_scope(spark, d), dim, P.build_dim_activity(spark), areas, countries)


SQL_ROUTED = f"""{A.SQL_ORDER_NATION},
scope AS (
  SELECT CAST(split_part(x.n_name, '_', 2) AS INTEGER) AS area_code, x.n_name AS area, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         CASE CAST(l.l_suppkey % 8 AS INTEGER) {" ".join(f"WHEN {i} THEN {item}" for i, item in enumerate(ITEMS))} END AS item_code,
         CASE WHEN l.l_returnflag = 'R' AND l.l_quantity < 5 THEN -l.l_quantity ELSE l.l_quantity END AS value
  FROM lineitem l JOIN order_nation x ON l.l_orderkey = x.o_orderkey),
coded AS (
  SELECT *, CASE WHEN area_code > 1 AND area_code < 20 THEN 'C' || area_code END AS iso3,
         CASE WHEN area_code = 0 THEN 'C4' WHEN area_code IN (1, 2) THEN 'C3' WHEN area_code < 20 THEN 'C' || area_code END AS country_code FROM scope),
routed AS (
  SELECT c.*, CASE WHEN n.n_nationkey IS NULL THEN 'unmatched' WHEN c.value < 0 THEN 'rejected' ELSE 'good' END AS route
  FROM coded c LEFT JOIN nation n ON c.country_code = 'C' || n.n_nationkey AND n.n_nationkey <> 5)"""
SQL_ACTIVITIES = "(VALUES " + ", ".join(f"({k}, '{name}', '{group}')" for k, (name, group) in settings.ACTIVITIES.items()) + ") AS a(code, activity, activity_group)"


@register("activity_facts", f"""WITH {SQL_ROUTED}
SELECT country_code, item_code AS activity_code, a.activity, a.activity_group, year, SUM(value) / 1000.0 AS emissions_mt_co2eq
FROM routed JOIN {SQL_ACTIVITIES} ON a.code = item_code WHERE route = 'good' GROUP BY ALL""")
def activity_facts(spark, d):
    """D9 (+ D8, J7, G4): by-activity facts of the product builder: special areas first (the last listed entry wins), merged
    codes next, own codes last; unmatched and negative rows take other routes."""
    return activity_products(spark, d)[0]


@register("activity_unmatched", f"""WITH {SQL_ROUTED}
SELECT area_code, area, MIN(iso3) AS iso3, COUNT(*) AS rows, SUM(value) AS kt_all_years FROM routed WHERE route = 'unmatched' GROUP BY 1, 2""")
def activity_unmatched(spark, d):
    """Areas without a known country, with what they hold."""
    return activity_products(spark, d)[1]


@register("activity_rejected", f"""WITH {SQL_ROUTED}
SELECT area_code, area, country_code, item_code, year, value, '{P.REJECT_REASON}' AS reason FROM routed WHERE route = 'rejected'""")
def activity_rejected(spark, d):
    """Matched rows with a negative value, each with its reason."""
    return activity_products(spark, d)[2]


# ------------------------------------------------------------------------ S2, D2
@register("population_pages", """WITH heads AS (
  SELECT c.c_nationkey AS k, n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS year, COUNT(DISTINCT o.o_custkey) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2, 3),
codes(k, iso3) AS (VALUES (0, 'ARG'), (1, 'BRA'), (2, 'CHL'), (3, 'XKX'), (4, 'WLD'))
SELECT COALESCE(codes.iso3, 'Z' || (h.k % 10)) AS iso3, h.n_name AS wb_name, h.year, CAST(round_even(h.v + 0.5, 0) AS BIGINT) AS population,
  h.k < 4 AS is_country, 'heads' AS indicator
FROM heads h LEFT JOIN codes ON codes.k = h.k WHERE h.k % 7 <> 6""")
def population_pages(spark, d):
    """S2 + D2 (+ G2, P2, P16, U3): order counts written as JSON page documents, one a year, read back strictly and tidied:
    values without a number are dropped, halves are rounded to even, empty codes fall back to the two-letter one."""
    heads = A.orders_with_nation(spark, d, "o_orderdate").groupBy("c_nationkey", "n_name", F.year("o_orderdate").alias("year")) \
        .agg(F.count_distinct("c_custkey").alias("v"))
    k = F.col("c_nationkey")
    code = F.coalesce(conform.recode("c_nationkey", dict(enumerate(["ARG", "BRA", "CHL", "XKX", "WLD"]))), F.lit(""))
    short = F.concat(F.lit("Z"), (k % 10).cast("string"))
    record = F.struct(F.struct(F.lit("heads").alias("id"), F.lit("Heads").alias("value")).alias("indicator"),
                      F.struct(short.alias("id"), F.col("n_name").alias("value")).alias("country"), code.alias("countryiso3code"),
                      F.col("year").cast("string").alias("date"), F.when(k % 7 != 6, F.col("v") + 0.5).alias("value"))
    pages = heads.groupBy("year").agg(F.to_json(F.collect_list(record)).alias("records"), F.count(F.lit(1)).alias("n"))   # a page holds a year's nations
    info = F.to_json(F.struct(F.col("year").alias("page"), F.lit(1).alias("pages"), F.col("n").alias("per_page"), F.col("n").alias("total")))
    folder = scratch_path(spark, "pages")
    pages.select(F.concat(F.lit("["), info, F.lit(", "), F.col("records"), F.lit("]")).alias("value"), "year") \
        .repartition("year").write.partitionBy("year").text(folder)
    records = src.read_pages(spark, f"{folder}/year=*", "*.txt")
    return P.tidy_population(records, conform.known_codes(spark, conform.iso_table(spark)))


# ------------------------------------------------------------------------ M2, M4
def wide_lines(spark, d):
    """Line quantities less 60 as a wide matrix (flag, status, supplier x year)."""
    li = t(spark, d, "lineitem").select(F.col("l_returnflag").alias("Substance"), F.col("l_linestatus").alias("Sector"),
                                        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("EDGAR Country Code"),
                                        F.concat_ws(" and ", F.lit("Supplier"), F.col("l_suppkey").cast("string")).alias("Country"),
                                        F.year("l_shipdate").alias("y"), (F.col("l_quantity") - 60).alias("v"))
    return pivot_years(li, ["Substance", "Sector", "EDGAR Country Code", "Country"], "y", A.YEARS,
                       {"{year}": lambda of: F.sum(F.when(of("v") % 7 != 0, of("v")))})


SQL_WIDE = f"""rows AS (SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem WHERE l_shipdate IS NOT NULL),
years AS (SELECT unnest(range({A.YEARS.start}, {A.YEARS.stop})) AS year),
sums AS (SELECT l_returnflag, l_linestatus, l_suppkey, year(l_shipdate) AS year, SUM(l_quantity - 60) FILTER (WHERE (l_quantity - 60) % 7 <> 0) AS v
  FROM lineitem GROUP BY ALL),
cells AS (SELECT r.l_returnflag, y.year, s.v FROM rows r CROSS JOIN years y
  LEFT JOIN sums s ON s.l_returnflag = r.l_returnflag AND s.l_linestatus = r.l_linestatus AND s.l_suppkey = r.l_suppkey AND s.year = y.year)"""


@register("matrix_cells_per_year", f"""WITH {SQL_WIDE}
SELECT CAST(year AS VARCHAR) AS year, COUNT(*) AS cells, COUNT(*) FILTER (WHERE v IS NULL) AS missing, COUNT(*) FILTER (WHERE v = 0) AS zeros,
  COUNT(*) FILTER (WHERE v < 0) AS negatives FROM cells GROUP BY 1""")
def matrix_cells_per_year(spark, d):
    """M2: cells, missing, zeros and negatives of a wide matrix per year, in one pass whatever its width."""
    wide = wide_lines(spark, d)
    return yearly_cells(wide, [str(y) for y in A.YEARS])


@register("matrix_profile", f"""WITH {SQL_WIDE},
yearly AS (SELECT year, COUNT(*) AS cells, COUNT(*) FILTER (WHERE v IS NULL) AS missing, COUNT(*) FILTER (WHERE v = 0) AS zeros,
  COUNT(*) FILTER (WHERE v < 0) AS negatives FROM cells GROUP BY 1),
whole AS (SELECT CAST(SUM(cells) AS BIGINT) AS cells, CAST(SUM(missing) AS BIGINT) AS missing, CAST(SUM(zeros) AS BIGINT) AS zeros,
  CAST(SUM(negatives) AS BIGINT) AS negatives, MIN(missing) AS least, MAX(missing) AS most FROM yearly),
by_substance AS (SELECT l_returnflag AS s, COUNT(*) FILTER (WHERE v IS NULL) AS missing FROM cells GROUP BY 1),
by_sector AS (SELECT l_linestatus AS s, COUNT(*) AS n FROM rows GROUP BY 1)
SELECT 'shape' AS section, '' AS row, 'rows' AS name, CAST(COUNT(*) AS VARCHAR) AS value FROM rows
UNION ALL SELECT 'shape', '', 'blank_rows', '0' UNION ALL SELECT 'shape', '', 'columns', '{len(A.YEARS) + 4}' UNION ALL SELECT 'shape', '', 'year_columns', '{len(A.YEARS)}'
UNION ALL SELECT 'cells', '', 'cells', CAST(cells AS VARCHAR) FROM whole UNION ALL SELECT 'cells', '', 'missing', CAST(missing AS VARCHAR) FROM whole
UNION ALL SELECT 'cells', '', 'zeros', CAST(zeros AS VARCHAR) FROM whole UNION ALL SELECT 'cells', '', 'negatives', CAST(negatives AS VARCHAR) FROM whole
UNION ALL SELECT 'cells', '', 'min_missing', CAST(least AS VARCHAR) FROM whole UNION ALL SELECT 'cells', '', 'max_missing', CAST(most AS VARCHAR) FROM whole
UNION ALL SELECT 'cells', '', 'missing_pct', CAST(ROUND(100.0 * missing / cells, 2) AS VARCHAR) FROM whole
UNION ALL SELECT 'duplicate_keys', '', 'duplicate_rows', '0'
UNION ALL SELECT 'rows_per_sector', s, 'rows', CAST(n AS VARCHAR) FROM by_sector
UNION ALL SELECT 'substances', s, 'rows', CAST(COUNT(*) AS VARCHAR) FROM rows JOIN by_substance ON l_returnflag = s GROUP BY s
UNION ALL SELECT 'substances', s, 'missing_cells', CAST(missing AS VARCHAR) FROM by_substance""")
def matrix_profile(spark, d):
    """M2 (+ J12, R7, A19): sections of the wide matrix's profile."""
    profile = profile_matrix(wide_lines(spark, d), conform.iso_table(spark), focus_sector="O")
    return sections(profile, "shape", "cells", "duplicate_keys", "rows_per_sector", "substances")


@register("stats_profile", f"""WITH {SQL_STATS},
kinds AS (SELECT area, priority, year, projection, CAST(SUM(v) AS DOUBLE) AS v FROM cells GROUP BY ALL),
scope AS (SELECT * FROM kinds WHERE year >= {CFG.stats_first_year} AND NOT projection)
SELECT 'shape' AS section, 'wide' AS row, 'rows' AS name, CAST(COUNT(*) AS VARCHAR) AS value FROM kinds
UNION ALL SELECT 'shape', 'wide', 'areas', CAST(COUNT(DISTINCT area) AS VARCHAR) FROM kinds UNION ALL SELECT 'shape', 'wide', 'items', CAST(COUNT(DISTINCT priority) AS VARCHAR) FROM kinds
UNION ALL SELECT 'shape', 'wide', 'elements', '1' UNION ALL SELECT 'shape', 'wide', 'sources', '1'
UNION ALL SELECT 'shape', 'wide', 'first_year', CAST(MIN(year) AS VARCHAR) FROM kinds UNION ALL SELECT 'shape', 'wide', 'last_year', CAST(MAX(year) AS VARCHAR) FROM kinds
UNION ALL SELECT 'area_kinds', '', 'countries', CAST(COUNT(DISTINCT area) AS VARCHAR) FROM kinds UNION ALL SELECT 'area_kinds', '', 'aggregates', '0' UNION ALL SELECT 'area_kinds', '', 'regions', '0'
UNION ALL SELECT 'in_scope', '', 'values', CAST(COUNT(*) AS VARCHAR) FROM scope UNION ALL SELECT 'in_scope', '', 'first_year', CAST(MIN(year) AS VARCHAR) FROM scope
UNION ALL SELECT 'in_scope', '', 'last_year', CAST(MAX(year) AS VARCHAR) FROM scope
UNION ALL SELECT 'negatives_by_area', 'area ' || area || '/item ' || priority, 'values', CAST(COUNT(*) AS VARCHAR) FROM kinds WHERE v < 1000000 GROUP BY area, priority
UNION ALL SELECT 'projections_by_year', '', 'year', CAST(year AS VARCHAR) FROM kinds WHERE projection GROUP BY year
UNION ALL SELECT 'projections_by_year', '', 'values', CAST(COUNT(*) AS VARCHAR) FROM kinds WHERE projection GROUP BY year
UNION ALL SELECT 'duplicate_keys', '', 'duplicate_rows', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)::VARCHAR FROM (SELECT COUNT(*) AS n FROM kinds GROUP BY area, priority, year)""")
def stats_profile(spark, d):
    """M4: sections of the statistics profile: shape, kinds of areas, the part in use, negatives, projections, repeated keys."""
    plain = stats_frame(spark, d).where(~F.col("is_aggregate") & F.col("item_code").isin(ITEMS))
    number = F.array_position(F.array(*map(F.lit, ITEMS)), F.col("item_code")).cast("string")
    tidy = plain.withColumns({"value": F.col("value") - 1_000_000, "area": F.concat(F.lit("area "), F.col("area_code").cast("string")),
                              "item": F.concat(F.lit("item "), number), "iso3": F.lit(None).cast("string"), "flag": F.lit(None).cast("string")})
    profile = profile_stats(tidy, "wide", cfg=CFG)
    return sections(profile, "shape", "area_kinds", "in_scope", "negatives_by_area", "projections_by_year", "duplicate_keys")
