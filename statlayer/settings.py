"""Parameters of the statistical model.

Every operator takes these as arguments (with these values as defaults), so the same operators run on
the emissions tables and on any other long/wide table.
"""
from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path

RESOURCES = Path(__file__).resolve().parent / "resources"

# ---------------------------------------------------------------------------------------------------
# FIXED VALUES. They must equal the published source definitions for results to match; they are
# listed plainly, in their natural order.
# ---------------------------------------------------------------------------------------------------

# Wide emissions matrix
MATRIX_SHEET = "GHG_by_sector_and_country"
MATRIX_EDITION = 2026
MATRIX_FIRST_YEAR = 1970
ESTIMATE_FROM_YEAR = 2023
MATRIX_ID_COLUMNS = ["Substance", "Sector", "EDGAR Country Code", "Country"]
SECTORS = ["Agriculture", "Buildings", "Fuel Production", "Industrial Combustion", "Power Industry",
           "Processes", "Transport", "Waste"]
SUBSTANCE_TO_GAS = {
    "CO2": "CO2",
    "GWP_100_AR5_CH4": "CH4",
    "GWP_100_AR5_N2O": "N2O",
    "GWP_100_AR5_F-gases": "F-gases",
}
AGGREGATE_CODES = ["GLOBAL TOTAL", "EU27"]
INTERNATIONAL_CODES = ["AIR", "SEA"]
WORLD_CODE = "GLOBAL TOTAL"
COUNTRY_TYPES = ("country", "aggregate", "international")
REJECT_REASON = "negative emissions are impossible for this activity"

# Population pages
POPULATION_INDICATOR = "SP.POP.TOTL"
POPULATION_FIRST_YEAR = 1960
EXTRA_COUNTRY_CODES = {"XKX": "Kosovo", "CHI": "Channel Islands"}
WORLD_POPULATION_CODE = "WLD"

# Activity statistics file
STATS_ID_COLUMNS = ["Area Code", "Area Code (M49)", "Area", "Item Code", "Item", "Element", "Source", "Unit"]
STATS_SOURCE = "FAO TIER 1"
STATS_ELEMENT = "Emissions (CO2eq) (AR5)"
STATS_UNIT = "kt"
STATS_FIRST_YEAR = 2000
WORLD_AREA_CODE = 5000
CHINA_AREA_CODE = 351
CHINA_PART_CODES = [41, 96, 128, 214]
PROJECTION_FLAG = "F"
ACTIVITIES = {
    5058: ("Enteric fermentation", "Livestock"),
    5059: ("Manure management", "Livestock"),
    5062: ("Manure applied to soils", "Livestock"),
    5063: ("Manure left on pasture", "Livestock"),
    5060: ("Rice cultivation", "Crops"),
    5061: ("Synthetic fertilizers", "Crops"),
    5064: ("Crop residues", "Crops"),
    5066: ("Burning crop residues", "Crops"),
}
SUBTOTAL_ITEMS = [5084, 5085]

# Curated layer
FOCUS_SECTOR = "Agriculture"
FOCUS_GASES = ["CO2", "CH4", "N2O"]
GAS_COLUMNS = {"CO2": "co2_mt", "CH4": "ch4_mt", "N2O": "n2o_mt"}
GASES = [
    ("CO2", "Carbon dioxide", 1.0),
    ("CH4", "Methane", 28.0),
    ("N2O", "Nitrous oxide", 265.0),
]

# Conforming tables: population code -> matrix code, and special statistics areas -> matrix code
COUNTRY_MAPPING = [
    ("SDN", "SDN", "EDGAR combines Sudan and South Sudan"),
    ("SSD", "SDN", "EDGAR combines Sudan and South Sudan"),
    ("SRB", "SCG", "EDGAR still uses one code for Serbia and Montenegro"),
    ("MNE", "SCG", "EDGAR still uses one code for Serbia and Montenegro"),
    ("CUW", "ANT", "EDGAR labels Curacao with the old Netherlands Antilles code ANT"),
    ("FRA", "FRA", "EDGAR combines France and Monaco"),
    ("MCO", "FRA", "EDGAR combines France and Monaco"),
    ("ITA", "ITA", "EDGAR combines Italy and San Marino (and the Holy See)"),
    ("SMR", "ITA", "EDGAR combines Italy and San Marino (and the Holy See)"),
    ("ESP", "ESP", "EDGAR combines Spain and Andorra"),
    ("AND", "ESP", "EDGAR combines Spain and Andorra"),
    ("CHE", "CHE", "EDGAR combines Switzerland and Liechtenstein"),
    ("LIE", "CHE", "EDGAR combines Switzerland and Liechtenstein"),
    ("ISR", "ISR", "EDGAR combines Israel and Palestine"),
    ("PSE", "ISR", "EDGAR combines Israel and Palestine"),
]
AREA_MAPPING = [
    (206, "Sudan (former)", "SDN",
     "Sudan before the 2011 split has no ISO code; EDGAR's SDN covers Sudan and South Sudan"),
    (186, "Serbia and Montenegro", "SCG",
     "The former union (until 2006) has no ISO code; EDGAR's SCG covers Serbia and Montenegro"),
]


@dataclass(frozen=True)
class Thresholds:
    """Data-quality thresholds (arguments of the suites)."""
    min_matrix_rows: int = 250_000
    min_population_rows: int = 15_000
    min_stats_rows: int = 2_000_000
    min_population_coverage_pct: float = 99.0
    max_t_per_person: float = 100.0
    min_stats_coverage_pct: float = 99.5
    max_source_gap_pct: float = 15.0
    stats_tolerance_kt: float = 1.0
    world_gap: float = 1e-6
    world_population_gap: float = 0.005
    stats_world_gap: float = 0.001
    share_gap: float = 1e-6


@dataclass(frozen=True)
class Settings:
    """Everything a run is parameterised by (one object, passed explicitly)."""
    edition: int = MATRIX_EDITION
    estimate_from_year: int = ESTIMATE_FROM_YEAR
    matrix_first_year: int = MATRIX_FIRST_YEAR
    population_first_year: int = POPULATION_FIRST_YEAR
    stats_first_year: int = STATS_FIRST_YEAR
    focus_sector: str = FOCUS_SECTOR
    focus_gases: tuple = tuple(FOCUS_GASES)
    thresholds: Thresholds = field(default_factory=Thresholds)
    iso_table: str = str(RESOURCES / "iso3166_1.csv")
    country_mapping: str | None = None          # CSV files in place of the listed mappings
    area_mapping: str | None = None

    @classmethod
    def with_thresholds(cls, pairs=(), **values) -> Settings:
        """Settings with some thresholds given as ``name=value`` texts; an unknown name or a bad number is an error."""
        kinds = {f.name: type(getattr(Thresholds(), f.name)) for f in fields(Thresholds)}
        changed = {}
        for pair in pairs:
            name, _, value = pair.partition("=")
            if name not in kinds:
                raise ValueError(f"unknown threshold {name!r}; known: {', '.join(kinds)}")
            changed[name] = kinds[name](value)
        return cls(thresholds=Thresholds(**changed), **values)
