"""Catalogue, part two: column expressions, dedup, profiles, reconciliations, data-quality suites,
contracts, publishing and file-format operators on the driver tables (each with its DuckDB twin)."""
from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlayer.functions.numeric import gap_ratio
from statlayer.functions.text import STRIP_PATTERN, plain_letters, slug, strip_all, strip_leading, zero_pad
from statlayer.operators.aggregate import complete_group_sums, duplicate_rows, value_counts
from statlayer.operators.conform import equals_flag, last_listed, recode
from statlayer.operators.dedup import keep_first
from statlayer.operators.joins import fixed_dim
from statlayer.operators.reshape import pivot_years
from statlayer.plans import analog as A
from statlayer.plans import products as P
from statlayer.plans.catalogue import MONEY, r6, register, t
from statlayer.profile.files import compare_formats, partition_read_share
from statlayer.profile.stats import column_profile, summary
from statlayer.publish.warehouse import TableLoad, check_published, load_warehouse, read_audit, read_current
from statlayer.quality import checks as C
from statlayer.quality.contracts import constraint_violations
from statlayer.quality.dropped import Dropped, report as dropped_rows
from statlayer.quality.drift import schema_drift
from statlayer.schemas import Contract, struct
from statlayer.session import scratch_path
from statlayer.sources.tables import table_path

SQL_WS = STRIP_PATTERN.replace("'", "''")


# ------------------------------------------------------------------------ expressions
@register("json_flatten", """SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, COUNT(*) AS events,
  COUNT(DISTINCT user_id) AS users, MIN(value) AS min_value, MAX(value) AS max_value
FROM events GROUP BY 1""")
def json_flatten(spark, d):
    """R6 + F8: JSON text -> typed nested record -> flat column, grouped."""
    e = t(spark, d, "events").select("user_id", "value", F.from_json("props", "struct<k:int>").alias("p"))
    return e.groupBy(F.col("p.k").alias("k")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"))


@register("recode_flags", """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_name,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'expedite' WHEN o_orderpriority = '5-LOW' THEN 'deferred'
       ELSE 'standard' END AS priority_class,
  o_totalprice >= 300000 AS is_large, COALESCE(o_orderstatus = 'O', false) AS is_open,
  (o_totalprice >= 400000) OR (o_orderpriority = '1-URGENT') AS big_or_urgent,
  CASE WHEN o_totalprice >= 300000 THEN o_totalprice END AS large_total
FROM orders""")
def recode_flags(spark, d):
    """Dictionary recode, ordered class, threshold / equality / disjunctive flags, conditional null."""
    o = t(spark, d, "orders")
    pr = F.col("o_orderpriority")
    is_large = F.col("o_totalprice") >= 300000
    return o.select(
        "o_orderkey", recode("o_orderstatus", {"F": "finished", "O": "open", "P": "partial"}).alias("status_name"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), "expedite").when(pr == "5-LOW", "deferred").otherwise("standard")
        .alias("priority_class"),
        is_large.alias("is_large"), equals_flag("o_orderstatus", "O").alias("is_open"),
        ((F.col("o_totalprice") >= 400000) | (pr == "1-URGENT")).alias("big_or_urgent"),
        F.when(is_large, F.col("o_totalprice")).alias("large_total"))


@register("text_clean", f"""SELECT p_partkey, regexp_replace(p_name, '{SQL_WS}', '', 'g') AS name_clean,
  replace(lower(p_name), ' ', '_') AS name_key, replace(lower(p_type), ' ', '_') AS type_key,
  CASE WHEN length(CAST(p_size AS VARCHAR)) < 3 THEN lpad(CAST(p_size AS VARCHAR), 3, '0')
       ELSE CAST(p_size AS VARCHAR) END AS size_code,
  ltrim(p_brand, 'Brand#') AS brand_code
FROM part""")
def text_clean(spark, d):
    """F1 + F2 + P10: full strip, slug keys, zero pad without truncation, strip of a leading char set."""
    p = t(spark, d, "part")
    return p.select("p_partkey", strip_all("p_name").alias("name_clean"), slug("p_name").alias("name_key"),
                    slug("p_type").alias("type_key"), zero_pad(F.col("p_size").cast("string"), 3).alias("size_code"),
                    strip_leading("p_brand", "Brand#").alias("brand_code"))


@register("document_clean", f"""SELECT doc_id, length(regexp_replace(text, '{SQL_WS}', '', 'g')) AS stripped_chars,
  len(string_split(text, chr(10))) AS lines, replace(lower(source), ' ', '_') AS source_key, lang
FROM documents""")
def document_clean(spark, d):
    """F1 / F2 on whole document texts: stripped length, line count, source key."""
    docs = t(spark, d, "documents")
    return docs.select("doc_id", F.length(strip_all("text")).cast("long").alias("stripped_chars"),
                       # segments between newlines = newlines + 1, without building an array of lines
                       (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")
                       .alias("lines"), slug("source").alias("source_key"),
                       "lang")


@register("lenient_cast", """SELECT page_id, regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) AS segment,
  TRY_CAST(regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) AS BIGINT) AS segment_number
FROM pages""")
def lenient_cast(spark, d):
    """Text -> number where bad text becomes null (``try_cast``), never an error."""
    seg = F.regexp_extract("url", r"/([^/?#]*)(?:[?#].*)?$", 1)
    return t(spark, d, "pages").select("page_id", seg.alias("segment"), seg.try_cast("bigint").alias("segment_number"))


MATRIX_CODES = {0: "GLOBAL TOTAL", 1: "EU27", 2: "AIR", 3: "SEA"}
SQL_MATRIX_CODE = "CASE l_suppkey " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in MATRIX_CODES.items()) + " ELSE CAST(l_suppkey AS VARCHAR) END"


@register("matrix_tidy", f"""SELECT {SQL_MATRIX_CODE} AS country_code, 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS country_name,
  CASE WHEN l_suppkey IN (0, 1) THEN 'aggregate' WHEN l_suppkey IN (2, 3) THEN 'international' ELSE 'country' END AS country_type,
  'Line ' || l_linestatus AS sector, 'line_' || lower(l_linestatus) AS sector_key, l_returnflag AS substance,
  CASE l_returnflag WHEN 'A' THEN 'CO2' WHEN 'N' THEN 'CH4' END AS gas,
  CAST(year(l_shipdate) AS INTEGER) AS year, SUM(l_quantity) AS emissions_mt_co2eq,
  CAST(year(l_shipdate) AS INTEGER) >= 2000 AS is_estimate, 1 AS edgar_edition
FROM lineitem WHERE l_shipdate IS NOT NULL AND NOT (l_returnflag = 'R' AND l_suppkey % 7 = 0)
GROUP BY l_suppkey, l_linestatus, l_returnflag, year(l_shipdate) HAVING CAST(SUM(l_quantity) AS BIGINT) % 5 <> 0""")
def matrix_tidy(spark, d):
    """D1 (R1, P1, P2, P4-P6, P8-P11, P15, F1) on the driver tables: a wide text matrix - one row per (flag as substance,
    line status as sector, supplier as country), one column per ship year - tidied back to typed long rows. Some rows
    lack a key, every fifth sum is no number, codes carry spaces, four suppliers are totals or international."""
    from statlayer.settings import Settings
    key = F.col("l_suppkey")
    code = F.coalesce(recode("l_suppkey", MATRIX_CODES), key.cast("string"))
    li = t(spark, d, "lineitem").select(
        F.when(~((F.col("l_returnflag") == "R") & (key % 7 == 0)), F.concat(F.lit("\t"), F.col("l_returnflag"))).alias("Substance"),
        F.concat(F.lit("Line "), F.col("l_linestatus")).alias("Sector"), F.concat(F.lit(" "), code, F.lit("\u00a0")).alias("EDGAR Country Code"),
        F.concat(F.lit("Supplier "), key.cast("string")).alias("Country"), F.year("l_shipdate").alias("y"), "l_quantity")
    wide = pivot_years(li, ["Substance", "Sector", "EDGAR Country Code", "Country"], "y", A.YEARS, {"{year}": lambda of: F.sum(of("l_quantity"))})
    texts = {str(y): F.when(F.col(str(y)).cast("bigint") % 5 == 0, "n/a").otherwise(F.col(str(y)).cast("string")) for y in A.YEARS}
    return P.tidy_matrix(wide.withColumns(texts), 1, Settings(estimate_from_year=2000), substances={"A": "CO2", "N": "CH4"})


ISO_BY_FOURS = dict(zip(range(4, 104, 4), ["AFG", "ALB", "DZA", "ASM", "AND", "AGO", "ATG", "ARG", "AUS", "AUT", "BHS", "BHR", "BRB", "BEL", "BMU",
                                           "BTN", "BOL", "BWA", "BRA", None, "BLZ", None, "VGB", "BRN", "BGR"]))
SQL_ISO = "CASE c.c_nationkey * 4 + 4 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in ISO_BY_FOURS.items() if v) + " END"


@register("stats_tidy", f"""SELECT c.c_nationkey * 250 AS area_code, CAST(c.c_nationkey * 4 + 4 AS VARCHAR) AS m49_code,
  CASE WHEN c.c_nationkey * 250 < 5000 THEN {SQL_ISO} END AS iso3, n.n_name AS area, (c.c_nationkey * 250 >= 5000 OR c.c_nationkey * 250 = 351) AS is_aggregate,
  CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS item_code, o.o_orderpriority AS item, 'orders' AS element,
  c.c_mktsegment AS source, 'usd' AS unit, CAST(year(o.o_orderdate) AS INTEGER) AS year,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value, MAX(o.o_orderstatus) AS flag,
  COALESCE(MAX(o.o_orderstatus) = 'F', false) AS is_projection
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderdate IS NOT NULL
GROUP BY c.c_nationkey, n.n_name, o.o_orderpriority, c.c_mktsegment, year(o.o_orderdate)""")
def stats_tidy(spark, d):
    """D3 (R2, R3, F1, G1, P12-P14) on the driver tables: orders as a WIDE statistics file - one row per
    (area = customer nation, item = priority, source = segment), paired value/flag columns per year - tidied
    by the same code as the real file (layout detection, paired unpivot, code clean-up, ISO lookup of numeric codes, which
    aggregates lose again, flags)."""
    from statlayer.operators import conform
    rows = A.orders_with_nation(spark, d, "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority",
                                customer_cols=("c_mktsegment",)).select(
        (F.col("c_nationkey") * 250).alias("Area Code"),
        F.concat(F.lit("'"), (F.col("c_nationkey") * 4 + 4).cast("string")).alias("Area Code (M49)"),
        F.col("n_name").alias("Area"), F.substring("o_orderpriority", 1, 1).cast("int").alias("Item Code"),
        F.col("o_orderpriority").alias("Item"), F.lit("orders").alias("Element"), F.col("c_mktsegment").alias("Source"),
        F.lit("usd").alias("Unit"), F.year("o_orderdate").alias("y"), F.col("o_totalprice").cast(MONEY).alias("v"),
        "o_orderstatus")
    wide = pivot_years(rows, ["Area Code", "Area Code (M49)", "Area", "Item Code", "Item", "Element", "Source", "Unit"], "y", A.YEARS,
                       {"Y{year}": lambda of: F.sum(of("v")), "Y{year}F": lambda of: F.max(of("o_orderstatus"))})
    return P.tidy_stats(wide, conform.iso_table(spark))


@register("dropped_rows", f"""WITH cells AS (
  SELECT l_suppkey, l_partkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS substance,
         COUNT(DISTINCT year(l_shipdate)) AS filled
  FROM lineitem GROUP BY 1, 2, 3),
parts AS (SELECT r_name, COUNT(*) AS expected FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
days AS (
  SELECT r.r_name, CAST(o.o_orderdate AS DATE) AS day, COUNT(DISTINCT c.c_nationkey) AS found
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2)
SELECT 'matrix' AS step, 'rows_without_key' AS what, COUNT(*) FILTER (WHERE substance IS NULL) AS rows FROM cells
UNION ALL SELECT 'matrix', 'empty_cells', CAST(COALESCE(SUM({len(A.YEARS)} - filled) FILTER (WHERE substance IS NOT NULL), 0) AS BIGINT) FROM cells
UNION ALL SELECT 'merged', 'cells_with_missing_parts', COUNT(*) FROM days JOIN parts USING (r_name) WHERE found <> expected""")
def dropped_rows_query(spark, d):
    """What the matrix tidy (a sparse supplier-part x year matrix, a third of it without a key) and the all-parts
    rule (region-day totals) leave out, counted in the passes that write what they keep."""
    li = t(spark, d, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Substance"), F.lit("lines").alias("Sector"),
        F.concat_ws("-", "l_suppkey", "l_partkey").alias("EDGAR Country Code"), F.lit("pair").alias("Country"),
        F.year("l_shipdate").alias("y"), "l_quantity")
    wide = pivot_years(li, ["Substance", "Sector", "EDGAR Country Code", "Country"], "y", A.YEARS, {"{year}": lambda of: F.sum(of("l_quantity"))})
    matrix, merged = Dropped("matrix"), Dropped("merged")
    P.tidy_matrix(wide, 1, dropped=matrix).write.parquet(scratch_path(spark, "dropped"))
    n, r = t(spark, d, "nation"), fixed_dim(t(spark, d, "region"))
    members = n.join(r, n.n_regionkey == r.r_regionkey).select("r_name", "n_nationkey")
    facts = A.orders_with_nation(spark, d, "o_orderdate", "o_totalprice") \
        .select("c_nationkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast(MONEY).alias("v"))
    complete_group_sums(members, facts, "r_name", "n_nationkey", "c_nationkey", ["day"], "v", "total", merged) \
        .write.parquet(scratch_path(spark, "dropped"))
    return dropped_rows(spark, matrix, merged)


# ------------------------------------------------------------------- dedup and profiles
@register("dedup_keep_first", """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def dedup_keep_first(spark, d):
    """First order per customer by (date, key) - a min_by aggregate, not a row-number window."""
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    first = keep_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice")


@register("duplicate_count", """SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_count(spark, d):
    """Rows repeating an earlier (order, line number) key."""
    return duplicate_rows(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _profile_sql(col: str, typ: str) -> str:
    return f"""SELECT '{col}' AS "column", '{typ}' AS type, COUNT({col}) AS non_null,
  COUNT(*) FILTER (WHERE {col} IS NULL) AS missing,
  ROUND(100.0 * COUNT(*) FILTER (WHERE {col} IS NULL) / COUNT(*), 2) AS missing_pct,
  COUNT(DISTINCT {col}) AS "unique", COALESCE(CAST(MIN({col}) AS VARCHAR), '') AS example FROM customer"""


CUSTOMER_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                  ("c_mktsegment", "string")]


@register("column_profile", "\nUNION ALL\n".join(_profile_sql(c, ty) for c, ty in CUSTOMER_TYPES))
def column_profile_query(spark, d):
    """M1 + A19: one row per column (type, non-null, missing, %, unique, example) in one pass."""
    return column_profile(t(spark, d, "customer"))


@register("distribution", """SELECT c_mktsegment, COUNT(c_acctbal) AS count, ROUND(AVG(c_acctbal), 4) AS mean,
  ROUND(STDDEV_SAMP(c_acctbal), 4) AS std, MIN(c_acctbal) AS min,
  ROUND(quantile_cont(c_acctbal, 0.25), 4) AS p25, ROUND(quantile_cont(c_acctbal, 0.5), 4) AS p50,
  ROUND(quantile_cont(c_acctbal, 0.75), 4) AS p75, MAX(c_acctbal) AS max
FROM customer GROUP BY c_mktsegment""")
def distribution(spark, d):
    """Count, mean, std, min, exact quartiles (distributed ranking), max per segment."""
    s = summary(t(spark, d, "customer"), "c_acctbal", ["c_mktsegment"])
    return s.select("c_mktsegment", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("line_distribution", """SELECT l_returnflag, COUNT(l_extendedprice) AS count,
  ROUND(AVG(l_extendedprice), 4) AS mean, ROUND(STDDEV_SAMP(l_extendedprice), 4) AS std, MIN(l_extendedprice) AS min,
  ROUND(quantile_cont(l_extendedprice, 0.25), 4) AS p25, ROUND(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  ROUND(quantile_cont(l_extendedprice, 0.75), 4) AS p75, MAX(l_extendedprice) AS max
FROM lineitem GROUP BY l_returnflag""")
def line_distribution(spark, d):
    """A13 on the largest table with hot groups: each of the 3 flags holds a third of all lines; the exact
    quartiles come from the range-partitioned ranking, so no flag is ranked inside one task."""
    s = summary(t(spark, d, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return s.select("l_returnflag", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("value_counts", """SELECT o_orderstatus, o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1, 2""")
def value_counts_query(spark, d):
    """A14 + A15: two-key frequency table, most frequent first."""
    return value_counts(t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


DECLARED_LINES = struct(("l_orderkey", T.LongType()), ("l_partkey", T.LongType()), ("l_suppkey", T.LongType()), ("l_linenumber", T.LongType()),
                        ("l_quantity", T.DoubleType()), ("l_extendedprice", T.DecimalType(18, 2)), ("l_discount", T.DoubleType()),
                        ("l_returnflag", T.StringType()), ("l_linestatus", T.StringType()), ("l_shipdate", T.TimestampType()),
                        ("l_comment", T.StringType()))


@register("schema_drift", f"""WITH held AS (
  SELECT column_name AS name, CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS found
  FROM (DESCRIBE lineitem)),
declared(name, declared) AS (VALUES {", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in DECLARED_LINES)})
SELECT 'lineitem' AS table_name, COALESCE(d.name, h.name) AS "column", d.declared, h.found, CAST(1 AS BIGINT) AS files
FROM declared d FULL JOIN held h ON d.name = h.name WHERE d.declared IS DISTINCT FROM h.found""")
def schema_drift_query(spark, d):
    """The footers of a table's files against a declared schema: a missing and an undeclared column, two other types."""
    return schema_drift(spark, "lineitem", table_path(d, "lineitem"), DECLARED_LINES)


@register("last_listed_mapping", """WITH mapping AS (SELECT c_nationkey, arg_max(c_mktsegment, c_custkey) AS target FROM customer GROUP BY c_nationkey)
SELECT s.s_suppkey, s.s_nationkey, m.target FROM supplier s LEFT JOIN mapping m ON m.c_nationkey = s.s_nationkey""")
def last_listed_mapping(spark, d):
    """A mapping whose keys repeat (nation -> segment, one entry a customer): the last listed entry wins, also
    after the entries were shuffled."""
    entries = t(spark, d, "customer").select("c_nationkey", "c_mktsegment", F.col("c_custkey").alias("position")).repartition("c_mktsegment")
    mapping = last_listed(entries, "c_nationkey", "c_mktsegment").withColumnRenamed("c_mktsegment", "target")
    s = t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return s.join(mapping, s.s_nationkey == mapping.c_nationkey, "left").drop("c_nationkey")


LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"


@register("plain_letter_words", f"""WITH words AS (SELECT lang, unnest(regexp_extract_all(text, '{LETTERS}')) AS word FROM documents)
SELECT lang, COUNT(*) AS words, COUNT(DISTINCT word) AS spellings,
  COUNT(DISTINCT replace(strip_accents(lower(word)), 'ß', 'ss')) AS plain_words
FROM words GROUP BY lang""")
def plain_letter_words(spark, d):
    """spellings that differ only in accents or case are one word (a collation, inside the JVM)."""
    words = t(spark, d, "documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("word"))
    # exact spellings are counted first, so a word said a million times is one row before it is compared
    spelled = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    plain = spelled.groupBy("lang", plain_letters("word").alias("plain")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("spellings"))
    return plain.groupBy("lang").agg(F.sum("n").alias("words"), F.sum("spellings").alias("spellings"), F.count(F.lit(1)).alias("plain_words"))


# -------------------------------------------------------------------- reconciliations
SQL_ORDER_REGION = """ordr AS (
  SELECT r.r_name, n.n_name, CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(o.o_totalprice AS DECIMAL(18,2)) AS v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@register("reconcile_parts", f"""WITH {SQL_ORDER_REGION},
nt AS (SELECT r_name, n_name, year, SUM(v) AS v FROM ordr GROUP BY 1, 2, 3),
parts AS (SELECT r_name, year, SUM(v) AS parts FROM nt GROUP BY 1, 2),
total AS (SELECT r_name, year, SUM(v) AS total FROM ordr GROUP BY 1, 2)
SELECT p.r_name, p.year, CAST(p.parts AS DOUBLE) AS parts, CAST(t.total AS DOUBLE) AS total,
  CASE WHEN t.total = 0 AND p.parts <> 0 THEN 'inf'::DOUBLE WHEN t.total = 0 THEN NULL
       ELSE ABS(CAST(p.parts AS DOUBLE) - CAST(t.total AS DOUBLE)) / ABS(CAST(t.total AS DOUBLE)) END AS gap
FROM parts p JOIN total t ON p.r_name = t.r_name AND p.year = t.year""")
def reconcile_parts(spark, d):
    """Group total vs the sum of its parts per (group, year), relative gap with
    x/0 = inf and 0/0 skipped."""
    n, r = fixed_dim(t(spark, d, "nation")), fixed_dim(t(spark, d, "region"))
    nr = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    rows = (A.orders_with_nation(spark, d, "o_orderdate", "o_totalprice").join(fixed_dim(nr), "c_nationkey")
            .select("r_name", "n_name", F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast(MONEY).alias("v")))
    parts = rows.groupBy("r_name", "n_name", "year").agg(F.sum("v").alias("v")) \
        .groupBy("r_name", "year").agg(F.sum("v").alias("parts"))
    total = rows.groupBy("r_name", "year").agg(F.sum("v").alias("total"))
    both = parts.join(total, ["r_name", "year"])
    return both.select("r_name", "year", F.col("parts").cast("double").alias("parts"),
                       F.col("total").cast("double").alias("total"), gap_ratio("parts", "total").alias("gap"))


@register("world_total_check", f"""WITH {A.SQL_FACT},
world AS (SELECT l_returnflag AS gas_code, CAST(year(l_shipdate) AS INTEGER) AS year,
                 SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS world FROM lineitem GROUP BY 1, 2),
parts AS (SELECT gas_code, year, SUM(emissions_mt_co2eq) AS parts FROM fact_emissions GROUP BY 1, 2)
SELECT w.gas_code, w.year, CAST(p.parts AS DOUBLE) AS parts, CAST(w.world AS DOUBLE) AS world,
  ABS(CAST(p.parts AS DOUBLE) - CAST(w.world AS DOUBLE)) / CASE WHEN w.world > 0 THEN CAST(w.world AS DOUBLE) END AS gap
FROM world w JOIN parts p ON w.gas_code = p.gas_code AND w.year = p.year""")
def world_total_check(spark, d):
    """V9: world row per (gas, year) - computed from lines without any nation join - against the sum of
    the nation parts; zero totals are masked."""
    li = t(spark, d, "lineitem")
    world = li.groupBy(F.col("l_returnflag").alias("gas_code"), F.year("l_shipdate").alias("year")) \
        .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("world"))
    parts = A.published(spark, d, "fact_emissions").groupBy("gas_code", "year").agg(F.sum("emissions_mt_co2eq").alias("parts"))
    both = world.join(parts, ["gas_code", "year"])
    w, p = F.col("world").cast("double"), F.col("parts").cast("double")
    return both.select("gas_code", "year", p.alias("parts"), w.alias("world"),
                       (F.abs(p - w) / F.when(w > 0, w)).alias("gap"))


@register("subtotal_tolerance", """WITH p AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS parts
  FROM lineitem GROUP BY 1)
SELECT o.o_orderstatus, COUNT(*) AS orders_compared,
  CAST(MAX(ABS(p.parts - CAST(o.o_totalprice AS DECIMAL(18,2)))) AS DOUBLE) AS max_gap,
  COUNT(*) FILTER (WHERE ABS(p.parts - CAST(o.o_totalprice AS DECIMAL(18,2))) > 1.0) AS over_tolerance
FROM p JOIN orders o ON p.l_orderkey = o.o_orderkey GROUP BY 1""")
def subtotal_tolerance(spark, d):
    """Parts (line sums) vs the stored subtotal (order total) per key, absolute tolerance."""
    parts = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("parts"))
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast(MONEY).alias("sub"))
    gap = F.abs(F.col("parts") - F.col("sub"))
    return parts.join(o, parts.l_orderkey == o.o_orderkey).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders_compared"), F.max(gap).cast("double").alias("max_gap"),
        F.count_if(gap > 1.0).alias("over_tolerance"))


@register("coverage", """WITH k AS (SELECT DISTINCT l_orderkey FROM lineitem),
o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS v,
             k.l_orderkey IS NOT NULL AS covered
      FROM orders LEFT JOIN k ON o_orderkey = k.l_orderkey)
SELECT year, ROUND(100.0 * CAST(SUM(v) FILTER (WHERE covered) AS DOUBLE) / CAST(SUM(v) AS DOUBLE), 6) AS coverage_pct
FROM o GROUP BY year HAVING COUNT(*) FILTER (WHERE covered) > 0""")
def coverage(spark, d):
    """Share of the order amount that has lines, per year with any covered data."""
    keys = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("__k")).distinct()
    o = t(spark, d, "orders")
    rows = o.join(keys, o.o_orderkey == keys.__k, "left").select(
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast(MONEY).alias("v"),
        F.col("__k").isNotNull().alias("covered"))
    agg = rows.groupBy("year").agg(
        F.try_divide(F.lit(100.0) * F.sum(F.when(F.col("covered"), F.col("v"))).cast("double"),
                     F.sum("v").cast("double")).alias("coverage_pct"),
        F.count_if("covered").alias("__n"))
    return agg.where(F.col("__n") > 0).select("year", r6("coverage_pct"))


@register("shares_sum", f"""WITH {A.SQL_COUNTRY_YEAR}
SELECT year, ROUND(SUM(share_of_world_pct), 6) AS share_sum, ROUND(ABS(SUM(share_of_world_pct) - 100), 6) AS gap
FROM country_year GROUP BY year""")
def shares_sum(spark, d):
    """The shares of the year total add up to 100 each year."""
    cy = A.published(spark, d, "country_year")
    s = cy.groupBy("year").agg(F.sum("share_of_world_pct").alias("s"))
    return s.select("year", F.round("s", 6).alias("share_sum"), F.round(F.abs(F.col("s") - 100), 6).alias("gap"))


@register("source_agreement", """WITH e AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS lines_total FROM lineitem GROUP BY 1),
f AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS orders_total
  FROM orders GROUP BY 1)
SELECT e.year, CAST(lines_total AS DOUBLE) AS lines_total, CAST(orders_total AS DOUBLE) AS orders_total,
  ROUND(100.0 * ABS(CAST(orders_total AS DOUBLE) - CAST(lines_total AS DOUBLE)) / NULLIF(CAST(lines_total AS DOUBLE), 0), 6)
    AS gap_pct
FROM e JOIN f ON e.year = f.year""")
def source_agreement(spark, d):
    """Yearly totals of two sources and their gap in %."""
    e = t(spark, d, "lineitem").groupBy(F.year("l_shipdate").alias("year")) \
        .agg(F.sum(F.col("l_extendedprice").cast(MONEY)).alias("lines_total"))
    f = t(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")) \
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("orders_total"))
    b = e.join(f, "year")
    lt, ot = F.col("lines_total").cast("double"), F.col("orders_total").cast("double")
    return b.select("year", lt.alias("lines_total"), ot.alias("orders_total"),
                    F.round(F.try_divide(F.lit(100.0) * F.abs(ot - lt), lt), 6).alias("gap_pct"))


# -------------------------------------------------------------------- check suites
SEGMENTS_OK = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]


@register("check_suite", """SELECT 'schema: required columns present' AS "check", true AS passed,
  'all 5 columns present' AS details, 'error' AS severity FROM (SELECT COUNT(*) FROM customer)
UNION ALL
SELECT 'not null: c_custkey, c_name, c_acctbal', (a + b + c) = 0,
  CASE WHEN a + b + c = 0 THEN 'no nulls' ELSE 'null counts: {' || concat_ws(', ',
    CASE WHEN a > 0 THEN '''c_custkey'': ' || a END, CASE WHEN b > 0 THEN '''c_name'': ' || b END,
    CASE WHEN c > 0 THEN '''c_acctbal'': ' || c END) || '}' END, 'error'
FROM (SELECT COUNT(*) FILTER (WHERE c_custkey IS NULL) a, COUNT(*) FILTER (WHERE c_name IS NULL) b,
             COUNT(*) FILTER (WHERE c_acctbal IS NULL) c FROM customer)
UNION ALL
SELECT 'unique key: (c_custkey)', d = 0, CAST(d AS VARCHAR) || ' duplicate rows', 'error'
FROM (SELECT COALESCE(SUM(n - 1), 0) AS d FROM (SELECT COUNT(*) n FROM customer GROUP BY c_custkey))
UNION ALL
SELECT 'unique key: (c_nationkey)', d = 0, CAST(d AS VARCHAR) || ' duplicate rows', 'error'
FROM (SELECT COALESCE(SUM(n - 1), 0) AS d FROM (SELECT COUNT(*) n FROM customer GROUP BY c_nationkey))
UNION ALL
SELECT 'accepted values: c_mktsegment', u = 0,
  CASE WHEN u > 0 THEN 'unexpected: [' || l || ']' ELSE CAST(k AS VARCHAR) || ' known values' END, 'error'
FROM (SELECT COUNT(DISTINCT c_mktsegment) FILTER (WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')) u,
             COUNT(DISTINCT c_mktsegment) k FROM customer),
     (SELECT string_agg('''' || v || '''', ', ' ORDER BY v) l FROM (SELECT DISTINCT c_mktsegment v FROM customer
        WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') ORDER BY v LIMIT 10))
UNION ALL
SELECT 'range: c_acctbal in [0, None]', lo = 0,
  CAST(lo AS VARCHAR) || ' below, 0 above (min=' || CAST(mn AS VARCHAR) || ', max=' || CAST(mx AS VARCHAR) || ')', 'error'
FROM (SELECT COUNT(*) FILTER (WHERE c_acctbal < 0) lo, MIN(c_acctbal) mn, MAX(c_acctbal) mx FROM customer)
UNION ALL
SELECT 'row count >= 1,000', n >= 1000, format('{:,}', n) || ' rows', 'error' FROM (SELECT COUNT(*) n FROM customer)""")
def check_suite(spark, d):
    """V1-V8: a suite of checks over one table, all scalar checks in one aggregation pass."""
    c = t(spark, d, "customer")
    return C.evaluate(c, [
        C.expect_columns(c, ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
        C.expect_not_null(c, ["c_custkey", "c_name", "c_acctbal"]),
        C.expect_unique(c, ["c_custkey"]),
        C.expect_unique(c, ["c_nationkey"]),
        C.expect_values_in(c, "c_mktsegment", SEGMENTS_OK),
        C.expect_between(c, "c_acctbal", min_value=0),
        C.expect_row_count_at_least(c, 1000),
    ])


ORDERS_CONTRACT = Contract("orders", ["o_orderkey"], ["o_custkey", "o_orderdate", "o_totalprice"],
                           {"o_custkey": ("customer", "c_custkey")}, {"o_totalprice": (0, None)},
                           {"o_orderstatus": ["F", "O"]}, ["o_custkey", "o_totalprice"])


@register("constraint_scan", """SELECT 'not null: o_orderkey' AS "constraint", COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'check: o_custkey > 0', COUNT(*) FILTER (WHERE o_custkey <= 0) FROM orders
UNION ALL SELECT 'check: o_totalprice > 0', COUNT(*) FILTER (WHERE o_totalprice <= 0) FROM orders
UNION ALL SELECT 'not null: o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'not null: o_orderdate', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'not null: o_totalprice', COUNT(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'check: o_totalprice in [0, None]', COUNT(*) FILTER (WHERE o_totalprice < 0) FROM orders
UNION ALL SELECT 'check: o_orderstatus in accepted values',
  COUNT(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'primary key: (o_orderkey)', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
  FROM (SELECT COUNT(*) n FROM orders GROUP BY o_orderkey)
UNION ALL SELECT 'foreign key: o_custkey -> customer.c_custkey', COUNT(*) FROM orders o
  WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def constraint_scan(spark, d):
    """V16 + V17: PK, NOT NULL, FK, CHECK and enum constraints as violation counts."""
    return constraint_violations(t(spark, d, "orders"), ORDERS_CONTRACT, {"customer": t(spark, d, "customer")})


# ------------------------------------------------------------------------ publishing
OLD_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
NEW_SEGMENTS = ["FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


@register("upsert_result", f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment IN ({_in(NEW_SEGMENTS)})
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_mktsegment IN ({_in(OLD_SEGMENTS)})
  AND c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ({_in(NEW_SEGMENTS)}))""")
def upsert_result(spark, d):
    """K7 + K11: a dimension published twice through ``load_warehouse`` and read back: incoming rows win on
    their key, other rows stay."""
    c = t(spark, d, "customer")
    base = scratch_path(spark, "upsert")
    incoming = c.where(F.col("c_mktsegment").isin(NEW_SEGMENTS)).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    for batch, rows in (("old", c.where(F.col("c_mktsegment").isin(OLD_SEGMENTS))), ("new", incoming)):
        load_warehouse(spark, base, [TableLoad("customer", rows, ["c_custkey"], "dimension")], batch_id=batch)
    return read_current(spark, base, "customer").select(*c.columns)


@register("load_audit_rows", f"""SELECT 'customer' AS table_name,
  (SELECT COUNT(*) FROM customer WHERE c_mktsegment IN ({_in(NEW_SEGMENTS)})) AS rows_upserted,
  (SELECT COUNT(*) FROM customer WHERE c_mktsegment IN ({_in(OLD_SEGMENTS)}) AND c_custkey NOT IN
     (SELECT c_custkey FROM customer WHERE c_mktsegment IN ({_in(NEW_SEGMENTS)}))) AS rows_deleted
UNION ALL
SELECT 'supplier', (SELECT COUNT(*) FROM supplier WHERE s_acctbal >= 0),
  (SELECT COUNT(*) FROM supplier WHERE s_acctbal < 5000 AND s_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0))""")
def load_audit_rows(spark, d):
    """K8 + K10 + K11: two facts published twice through ``load_warehouse``; the audit rows of the second
    batch: rows upserted and stale rows removed."""
    c, s = t(spark, d, "customer"), t(spark, d, "supplier")
    base = scratch_path(spark, "audit")
    old = [TableLoad("customer", c.where(F.col("c_mktsegment").isin(OLD_SEGMENTS)), ["c_custkey"]),
           TableLoad("supplier", s.where(F.col("s_acctbal") < 5000), ["s_suppkey"])]
    new = [TableLoad("customer", c.where(F.col("c_mktsegment").isin(NEW_SEGMENTS)), ["c_custkey"]),
           TableLoad("supplier", s.where(F.col("s_acctbal") >= 0), ["s_suppkey"])]
    load_warehouse(spark, base, old, batch_id="second")        # batch names need not sort by time
    load_warehouse(spark, base, new, batch_id="first")
    return read_audit(spark, base).where("batch_id = 'first'").select("table_name", "rows_upserted", "rows_deleted")


@register("published_equals_files", """SELECT 'customer' AS table_name, COUNT(*) AS published, COUNT(*) AS expected, true AS same_content FROM customer
UNION ALL SELECT 'orders', COUNT(*), COUNT(*), COUNT(*) = COUNT(*) FILTER (WHERE o_totalprice < 100000) FROM orders""")
def published_equals_files(spark, d):
    """Two published tables against the rows they should hold, by number and by content; one was published with
    some prices changed, which only the content shows."""
    c, o = t(spark, d, "customer"), t(spark, d, "orders")
    base = scratch_path(spark, "content")
    changed = o.withColumn("o_totalprice", F.least("o_totalprice", F.lit(99999.99)))
    load_warehouse(spark, base, [TableLoad("customer", c.repartition(5), ["c_custkey"]), TableLoad("orders", changed, ["o_orderkey"])], batch_id="b")
    return check_published(spark, base, {"customer": c, "orders": o})


@register("partition_prune", """SELECT COUNT(*) AS rows_all, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS rows_read,
  COUNT(DISTINCT o_orderstatus) AS folders,
  ROUND(100.0 * CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE), 6) AS share_pct
FROM orders""")
def partition_prune(spark, d):
    """S5 + M7: write orders partitioned by status (shared scratch folder), read one folder (pruned)."""
    return partition_read_share(t(spark, d, "orders"), "o_orderstatus", "F")


@register("format_roundtrip", """SELECT 'csv' AS format, COUNT(*) AS rows_read_back, false AS types_preserved,
  'c_custkey' AS columns_with_changed_type FROM customer
UNION ALL SELECT 'json', COUNT(*), false, 'c_nationkey' FROM customer
UNION ALL SELECT 'parquet', COUNT(*), true, '-' FROM customer""")
def format_roundtrip(spark, d):
    """M6 + K5: CSV / JSON lines / Parquet round trip: rows read back and column types preserved."""
    out = compare_formats(t(spark, d, "customer"))
    return out.select("format", "rows_read_back", "types_preserved", "columns_with_changed_type")
