"""Declared schemas of every layer table, plus the warehouse contracts (keys, references, checks)."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampType()


def struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, *rest in fields
                         for nullable in [rest[0] if rest else True]])


STG_MATRIX = struct(("country_code", S), ("country_name", S), ("country_type", S), ("sector", S),
                    ("sector_key", S), ("substance", S), ("gas", S), ("year", I),
                    ("emissions_mt_co2eq", D), ("is_estimate", B), ("edgar_edition", I))
STG_POPULATION = struct(("iso3", S), ("wb_name", S), ("year", I), ("population", L), ("is_country", B),
                        ("indicator", S))
STG_STATS = struct(("area_code", I), ("m49_code", S), ("iso3", S), ("area", S), ("is_aggregate", B),
                   ("item_code", I), ("item", S), ("element", S), ("source", S), ("unit", S), ("year", I),
                   ("value", D), ("flag", S), ("is_projection", B))
DIM_COUNTRY = struct(("country_code", S), ("country_name", S), ("wb_codes", S), ("is_merged", B))
DIM_GAS = struct(("gas_code", S), ("gas_name", S), ("gwp100_ar5", T.DecimalType(6, 1)))
DIM_ACTIVITY = struct(("activity_code", I), ("activity_name", S), ("activity_group", S))
BY_GAS = struct(("country_code", S), ("gas", S), ("year", I), ("emissions_mt_co2eq", D), ("is_estimate", B),
                ("edgar_edition", I))
POPULATION = struct(("country_code", S), ("year", I), ("population", L))
COUNTRY_YEAR = struct(("country_code", S), ("year", I), ("co2_mt", D), ("ch4_mt", D), ("n2o_mt", D),
                      ("total_mt", D), ("share_of_world_pct", D), ("yoy_change_pct", D), ("population", L),
                      ("t_per_person", D), ("is_estimate", B), ("edgar_edition", I))
BY_ACTIVITY = struct(("country_code", S), ("activity_code", I), ("activity", S), ("activity_group", S),
                     ("year", I), ("emissions_mt_co2eq", D))
COMPARISON = struct(("country_code", S), ("year", I), ("edgar_total_mt", D), ("faostat_total_mt", D),
                    ("difference_mt", D), ("difference_pct", D))
LOAD_AUDIT = struct(("audit_id", L), ("batch_id", S), ("table_name", S), ("rows_upserted", L),
                    ("rows_deleted", L), ("loaded_at", TS))
CHECK_RESULT = struct(("check", S), ("passed", B), ("details", S), ("severity", S))
COUNTRY_MAPPING = struct(("wb_code", S), ("edgar_code", S), ("reason", S))
AREA_MAPPING = struct(("fao_area_code", I), ("fao_area", S), ("edgar_code", S), ("reason", S))
POSITION = ("position", L)                                # of an entry in its mapping; the last listed one wins
ISO_TABLE = struct(("numeric", S), ("alpha_3", S), ("alpha_2", S), ("name", S), ("official_name", S),
                   ("common_name", S))


@dataclass(frozen=True)
class Contract:
    """Table constraints a file format does not enforce; evaluated by ``quality.contracts``."""
    table: str
    primary_key: list
    not_null: list = field(default_factory=list)
    foreign_keys: dict = field(default_factory=dict)          # column -> (dimension table, column)
    ranges: dict = field(default_factory=dict)                # column -> (min, max); None = open
    accepted: dict = field(default_factory=dict)              # column -> allowed values
    positive: list = field(default_factory=list)              # columns that must be greater than 0

    @property
    def required(self) -> list:
        """Columns that must be filled: the key and the others declared so."""
        return [*self.primary_key, *(c for c in self.not_null if c not in self.primary_key)]


STAMPS = ["batch_id", "loaded_at"]
COUNTRY = {"country_code": ("dim_country", "country_code")}
# Year ranges and lists below: fixed values of the warehouse's table definitions.
CONTRACTS = {c.table: c for c in (
    Contract("dim_gas", ["gas_code"], ["gas_name", "gwp100_ar5"], positive=["gwp100_ar5"]),
    Contract("dim_activity", ["activity_code"], ["activity_name", "activity_group"], accepted={"activity_group": ["Livestock", "Crops"]}),
    Contract("dim_country", ["country_code"], ["country_name", "wb_codes", "is_merged"]),
    Contract("fact_emissions", ["country_code", "gas_code", "year"], ["emissions_mt_co2eq", "is_estimate", "edgar_edition", *STAMPS],
             COUNTRY | {"gas_code": ("dim_gas", "gas_code")}, {"year": (1970, 2100), "emissions_mt_co2eq": (0, None)}),
    Contract("fact_population", ["country_code", "year"], ["population", *STAMPS], COUNTRY, {"year": (1960, 2100)},
             positive=["population"]),
    Contract("agri_country_year", ["country_code", "year"],
             ["total_mt", "share_of_world_pct", "is_estimate", "edgar_edition", *STAMPS], COUNTRY,
             {"year": (1970, 2100), "total_mt": (0, None), "t_per_person": (0, None)}),
    Contract("fact_emissions_by_activity", ["country_code", "activity_code", "year"], ["emissions_mt_co2eq", *STAMPS],
             COUNTRY | {"activity_code": ("dim_activity", "activity_code")}, {"year": (1961, 2100), "emissions_mt_co2eq": (0, None)}),
    Contract("edgar_vs_faostat", ["country_code", "year"], ["edgar_total_mt", "faostat_total_mt", "difference_mt", *STAMPS],
             COUNTRY, {"year": (1961, 2100)}),
)}


def published(schema: T.StructType, drop: tuple = (), **renamed: str) -> T.StructType:
    """A curated table's schema as a fact in the warehouse: some columns left out or renamed, and the load time."""
    kept = [T.StructField(renamed.get(f.name, f.name), f.dataType) for f in schema if f.name not in drop]
    return T.StructType([*kept, T.StructField("loaded_at", TS)])


#: The layers' tables as their steps write them.
STAGED = {"matrix": STG_MATRIX, "population": STG_POPULATION, "stats": STG_STATS}
CURATED = {"dim_country": DIM_COUNTRY, "agri_emissions_by_gas": BY_GAS, "population": POPULATION, "agri_country_year": COUNTRY_YEAR,
           "dim_activity": DIM_ACTIVITY, "agri_emissions_by_activity": BY_ACTIVITY, "edgar_vs_faostat": COMPARISON}
#: The nine tables of the warehouse as their files hold them (a batch stands in a path, not in a column).
TABLES = {"dim_gas": DIM_GAS, "dim_activity": DIM_ACTIVITY, "dim_country": DIM_COUNTRY, "load_audit": LOAD_AUDIT,
          "fact_emissions": published(BY_GAS, gas="gas_code"), "fact_population": published(POPULATION),
          "agri_country_year": published(COUNTRY_YEAR), "fact_emissions_by_activity": published(BY_ACTIVITY, drop=("activity", "activity_group")),
          "edgar_vs_faostat": published(COMPARISON)}


def ddl(name: str, schema: T.StructType, location: str) -> str:
    """Idempotent table definition (K12): CREATE TABLE IF NOT EXISTS ... USING parquet LOCATION ...
    The constraints a file table cannot enforce are evaluated by ``quality.contracts``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet LOCATION '{location}'"
