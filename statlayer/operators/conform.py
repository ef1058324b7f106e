"""Conforming operators: recodes, ordered classes, flags and code translation between sources.

Code translation is a join with reference tables (ISO list, mapping files) rather than a Python
function per row: the lookup runs once per row inside the JVM and the reference side is a
broadcast of a table with a fixed, known size.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlayer import schemas, settings
from statlayer.functions.text import plain_letters, strip_leading, zero_pad
from statlayer.operators.joins import counted_dim
from statlayer.sources.tables import read_csv_table


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def recode(col, mapping: dict) -> Column:
    """Dictionary recode; unknown (or null) keys give null."""
    if not mapping:
        return F.lit(None)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.try_element_at(m, c))


def classify(col, aggregate_codes=settings.AGGREGATE_CODES,
             international_codes=settings.INTERNATIONAL_CODES) -> Column:
    """Ordered class: 'country' by default, 'aggregate' for totals, 'international' wins last."""
    c = _c(col)
    country, aggregate, international = settings.COUNTRY_TYPES
    return (F.when(c.isin(list(international_codes)), F.lit(international))
            .when(c.isin(list(aggregate_codes)), F.lit(aggregate))
            .otherwise(F.lit(country)))


def aggregate_area_flag(col, world_code: int = settings.WORLD_AREA_CODE,
                        composite_code: int = settings.CHINA_AREA_CODE) -> Column:
    """Regions (code >= world code) and the composite area are sums of other rows."""
    c = _c(col)
    return (c >= F.lit(world_code)) | (c == F.lit(composite_code))


def equals_flag(col, value: str) -> Column:
    """col == value, where a missing col is False (not null)."""
    return F.coalesce(_c(col) == F.lit(value), F.lit(False))


# ------------------------------------------------------------------ reference tables
def iso_table(spark: SparkSession, path: str = settings.Settings().iso_table) -> DataFrame:
    """ISO 3166-1 list (numeric, alpha_3, alpha_2, names). Fixed size (the standard): broadcastable."""
    return spark.read.schema(schemas.ISO_TABLE).option("header", True).csv(path)


def mapping_table(spark: SparkSession, rows, schema, path: str | None = None) -> DataFrame:
    """A mapping (S8) from a CSV file if a path is given, else from listed rows; ``position`` is an entry's place."""
    if path:
        return read_csv_table(spark, path, schema)
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], T.StructType([*schema, T.StructField(*schemas.POSITION)]))


def country_mapping(spark: SparkSession, rows=settings.COUNTRY_MAPPING, path: str | None = None) -> DataFrame:
    return mapping_table(spark, rows, schemas.COUNTRY_MAPPING, path)


def area_mapping(spark: SparkSession, rows=settings.AREA_MAPPING, path: str | None = None) -> DataFrame:
    return mapping_table(spark, rows, schemas.AREA_MAPPING, path)


def known_codes(spark: SparkSession, iso: DataFrame, extra_codes=settings.EXTRA_COUNTRY_CODES) -> DataFrame:
    """Real-country codes: ISO alpha-3 plus the extra list (e.g. XKX, CHI)."""
    extra = spark.createDataFrame([(c,) for c in extra_codes], "code string")
    return iso.select(F.col("alpha_3").alias("code")).unionByName(extra).distinct()


def with_is_country(df: DataFrame, code_col: str, known: DataFrame, out: str = "is_country") -> DataFrame:
    """True when the code is a real country (broadcast left join with the fixed code list)."""
    k = counted_dim(known.select(F.col("code").alias("__code"), F.lit(True).alias("__known")))
    return (df.join(k, df[code_col] == k["__code"], "left")
            .withColumn(out, F.coalesce(F.col("__known"), F.lit(False))).drop("__code", "__known"))


def with_iso3_from_numeric(df: DataFrame, numeric_col: str, iso: DataFrame, out: str = "iso3") -> DataFrame:
    """G1: UN M49 / ISO numeric code -> alpha-3 (null for regions and former states). The code is
    cleaned first: leading apostrophes removed, zero-padded to 3 without truncation."""
    ref = counted_dim(iso.select(F.col("numeric").alias("__num"), F.col("alpha_3").alias("__a3")))
    key = zero_pad(strip_leading(F.col(numeric_col).cast("string"), "'"), 3)
    return (df.withColumn("__key", key).join(ref, F.col("__key") == F.col("__num"), "left")
            .withColumn(out, F.col("__a3")).drop("__key", "__num", "__a3"))


def conform_codes(df: DataFrame, area_col: str, iso_col: str, area_map: DataFrame, country_map: DataFrame,
                  out: str = "country_code") -> DataFrame:
    """Target code by precedence
    1. special area -> code (areas without an ISO code, e.g. a former state),
    2. otherwise the ISO code translated for merged targets (SSD -> SDN), else the ISO code itself.
    Mapping tables are deduplicated with the last listed entry (``position``) winning, so the join never fans out."""
    special = counted_dim(last_listed(area_map, "fao_area_code", "edgar_code").toDF("__area", "__special"))
    merged = counted_dim(last_listed(country_map, "wb_code", "edgar_code").toDF("__iso", "__merged"))
    joined = (df.join(special, df[area_col] == special["__area"], "left")
              .join(merged, df[iso_col] == merged["__iso"], "left"))
    from_iso = F.when(F.col(iso_col).isNotNull(), F.coalesce(F.col("__merged"), F.col(iso_col)))
    return joined.withColumn(out, F.coalesce(F.col("__special"), from_iso)) \
        .drop("__area", "__special", "__iso", "__merged")


def last_listed(mapping: DataFrame, key: str, value: str, position: str = "position") -> DataFrame:
    """(key, value) of a mapping whose keys may repeat: the last listed entry wins. A mapping without positions must
    not repeat a key in different ways; then the largest value is taken, whatever the order of its rows."""
    order = F.struct(F.col(position), F.col(value)) if position in mapping.columns else F.col(value)
    return mapping.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias(value))


def with_looks_merged(df: DataFrame, code_col: str, name_col: str, iso: DataFrame,
                      out: str = "looks_merged") -> DataFrame:
    """Does a name join several countries under one code ('Sudan and South Sudan')? True when the
    name contains ' and ' and, accents and case aside, is none of the ISO names of that code (so
    'Trinidad and Tobago' is not merged); an unknown code with ' and ' counts as merged."""
    names = iso.select(F.col("alpha_3").alias("__code"), F.explode(F.array("name", "official_name", "common_name"))
                       .alias("__n")).where(F.col("__n").isNotNull() & (F.col("__n") != ""))
    names = counted_dim(names.select("__code", plain_letters("__n").alias("__plain")).distinct())
    known = counted_dim(iso.select(F.col("alpha_3").alias("__known")))
    flagged = (df.withColumn("__name", plain_letters(F.col(name_col).cast("string")))
               .join(known, F.col(code_col) == F.col("__known"), "left")
               .join(names, (F.col(code_col) == F.col("__code")) & (F.col("__name") == F.col("__plain")), "left"))
    merged = F.col(name_col).contains(" and ") & (F.col("__known").isNull() | F.col("__plain").isNull())
    return flagged.withColumn(out, F.coalesce(merged, F.lit(False))).drop("__name", "__known", "__code", "__plain")
