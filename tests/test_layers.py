"""End to end on micro raw files: stage -> validate -> curate -> validate -> publish -> check -> formats,
a rerun (idempotent publish, two audit batches) and a crash in the middle of a publish."""
import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from statlayer.plans import layers as PL
from statlayer.publish import warehouse as W
from statlayer.settings import Settings, Thresholds
from statlayer.sources import files as src

CFG = Settings(edition=2024, thresholds=Thresholds(min_matrix_rows=1, min_population_rows=1, min_stats_rows=1))

MATRIX = [
    ("GWP_100_AR5_CH4", "Agriculture", "PHL", "Philippines", "40", "41"),
    ("GWP_100_AR5_N2O", "Agriculture", "PHL", "Philippines", "10", "10"),
    ("CO2", "Agriculture", "PHL", "Philippines", "1", ""),
    ("GWP_100_AR5_CH4", "Agriculture", "SDN", "Sudan and South Sudan", "60", "62"),
    ("GWP_100_AR5_N2O", "Agriculture", "SDN", "Sudan and South Sudan", "30", "31"),
    ("CO2", "Agriculture", "AIR", "International Aviation", "5", "5"),
    ("GWP_100_AR5_CH4", "Agriculture", "GLOBAL TOTAL", "GLOBAL TOTAL", "100", "103"),
    ("GWP_100_AR5_N2O", "Agriculture", "GLOBAL TOTAL", "GLOBAL TOTAL", "40", "41"),
    ("CO2", "Agriculture", "GLOBAL TOTAL", "GLOBAL TOTAL", "6", "5"),
    ("GWP_100_AR5_CH4", "Agriculture", "EU27", "EU27", "7", "7"),
    ("CO2", "Buildings", "PHL", "Philippines", "3", "3"),
    ("CO2", "Buildings", "GLOBAL TOTAL", "GLOBAL TOTAL", "3", "3"),
    ("", "", "", "", "", ""),
]

AREAS = {171: ("'608", "Philippines"), 276: ("'729", "Sudan"), 277: ("'728", "South Sudan"), 41: ("'156", "China, mainland"),
         96: ("'344", "Hong Kong"), 128: ("'446", "Macao"), 214: ("'158", "Taiwan"), 351: ("'159", "China"),
         5000: ("'001", "World"), 227: ("'798", "Tuvalu")}
# (area, item, year, value, flag)
STATS = [(171, 5060, 2022, 20000.0, "E"), (171, 5060, 2023, 21000.0, "E"), (171, 5058, 2022, 25000.0, "E"),
         (171, 5058, 2023, 26000.0, "E"), (171, 5061, 2023, -0.5, "E"), (171, 5060, 2030, 23000.0, "F"),
         (276, 5058, 2022, 50000.0, "E"), (276, 5058, 2023, 51000.0, "E"),
         (277, 5058, 2022, 30000.0, "E"), (277, 5058, 2023, 31000.0, "E"), (227, 5058, 2023, 1.0, "E")]
for part in (41, 96, 128, 214):
    STATS += [(part, 5060, 2022, 1.0, "E"), (part, 5060, 2023, 1.0, "E")]
STATS += [(351, 5060, 2022, 4.0, "E"), (351, 5060, 2023, 4.0, "E"),
          (5000, 5060, 2022, 20004.0, "E"), (5000, 5060, 2023, 21004.0, "E"),
          (5000, 5058, 2022, 105000.0, "E"), (5000, 5058, 2023, 108001.0, "E")]


def subtotals():
    crops, livestock = {}, {}
    for a, item, y, v, _f in STATS:
        if y == 2030 or item == 5061:
            continue
        target = crops if item == 5060 else livestock
        target[(a, y)] = target.get((a, y), 0.0) + v
    rows = [(a, 5084, y, v, "E") for (a, y), v in crops.items()]
    return rows + [(a, 5085, y, v, "E") for (a, y), v in livestock.items()]


def record(code, name, year, value):
    return {"indicator": {"id": "SP.POP.TOTL", "value": "Population, total"}, "country": {"id": code[:2], "value": name},
            "countryiso3code": code, "date": str(year), "value": value, "unit": "", "obs_status": "", "decimal": 0}


def write_raw(root):
    os.makedirs(f"{root}/matrix")
    with open(f"{root}/matrix/sheet.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["Substance", "Sector", "EDGAR Country Code", "Country", "2022", "2023"])
        w.writerows(MATRIX)
    pulled = f"{root}/pages/pulled=2026-01-01"
    os.makedirs(pulled)
    page1 = [record("PHL", "Philippines", 2022, 115e6), record("PHL", "Philippines", 2023, 117e6),
             record("SDN", "Sudan", 2022, 47e6), record("SDN", "Sudan", 2023, 48e6)]
    page2 = [record("SSD", "South Sudan", 2022, 11e6), record("SSD", "South Sudan", 2023, 11.2e6),
             record("WLD", "World", 2022, 173e6), record("WLD", "World", 2023, 176.2e6), record("PHL", "Philippines", 2024, None)]
    for i, recs in enumerate([page1, page2], start=1):
        with open(f"{pulled}/page_{i}.json", "w") as f:
            json.dump([{"page": i, "pages": 2, "per_page": 5, "total": 9}, recs], f)
    with open(f"{pulled}/_manifest.json", "w") as f:
        json.dump({"pages": 2}, f)
    os.makedirs(f"{root}/stats")
    with open(f"{root}/stats/Emissions_Totals_E_All_Data_(Normalized).csv", "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["Area Code", "Area Code (M49)", "Area", "Item Code", "Item", "Element", "Source", "Unit", "Year",
                    "Value", "Flag"])
        for a, item, y, v, flag in STATS + subtotals():
            w.writerow([a, AREAS[a][0], AREAS[a][1], item, f"item {item}", "Emissions (CO2eq) (AR5)", "FAO TIER 1", "kt",
                        y, v, flag])
    return PL.RawInputs(matrix=f"{root}/matrix/sheet.csv", pages=pulled,
                        stats=f"{root}/stats/Emissions_Totals_E_All_Data_(Normalized).csv")


@pytest.fixture(scope="module")
def run_once(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    raw = write_raw(root)
    base = f"{root}/out"
    first = PL.run(spark, raw, base, cfg=CFG, run_id="20260101T000000Z", today_year=2026)
    return spark, raw, base, first


def test_pipeline_products(run_once):
    spark, _raw, base, paths = run_once
    cy = {(r.country_code, r.year): r for r in W.read_current(spark, paths.warehouse, "agri_country_year").collect()}
    assert cy[("PHL", 2022)].total_mt == 51.0 and cy[("SDN", 2023)].total_mt == 93.0
    assert cy[("SDN", 2022)].population == 58_000_000          # SDN + SSD
    assert cy[("PHL", 2023)].co2_mt is None and cy[("PHL", 2023)].is_estimate
    act = W.read_current(spark, paths.warehouse, "fact_emissions_by_activity")
    assert "activity" not in act.columns and act.where("emissions_mt_co2eq < 0").count() == 0
    sdn = {r.year: r.emissions_mt_co2eq for r in act.where("country_code = 'SDN'").collect()}
    assert sdn == {2022: 80.0, 2023: 82.0}
    unmatched = spark.read.option("header", True).csv(paths.report("unmatched_areas"))
    assert {r.area for r in unmatched.collect()} == {"Tuvalu", "China, mainland", "Hong Kong", "Macao", "Taiwan"}
    assert spark.read.option("header", True).csv(paths.report("rejected_rows")).count() == 1
    staged = spark.read.parquet(paths.staging("matrix"))
    assert {r.sector_key for r in staged.select("sector_key").distinct().collect()} == {"agriculture", "buildings"}


def test_rerun_is_idempotent(run_once):
    spark, raw, base, first = run_once
    before = sorted(tuple(r) for r in W.read_current(spark, first.warehouse, "agri_country_year").drop("loaded_at", "batch_id").collect())
    second = PL.run(spark, raw, base, cfg=CFG, run_id="20260201T000000Z", today_year=2026)
    after = sorted(tuple(r) for r in W.read_current(spark, second.warehouse, "agri_country_year").drop("loaded_at", "batch_id").collect())
    assert before == after
    audit = W.read_audit(spark, second.warehouse)
    assert audit.count() == 16 and audit.select("batch_id").distinct().count() == 2
    assert audit.where("rows_deleted > 0").count() == 0
    assert sorted(r.audit_id for r in audit.collect()) == list(range(1, 17))


def test_crash_during_publish_leaves_previous_batch(run_once):
    spark, _raw, base, first = run_once
    wh = first.warehouse
    current = W.current_batch(spark, wh)
    bad = spark.range(3).select(F.col("id").alias("k"), F.raise_error(F.lit("disk gone")).alias("v"))
    with pytest.raises(Exception):
        W.load_warehouse(spark, wh, [W.TableLoad("dim_gas", spark.createDataFrame([("X", "x", None)],
                                                                                   "gas_code string, gas_name string, gwp100_ar5 decimal(6,1)"),
                                                  ["gas_code"], "dimension"),
                                     W.TableLoad("broken", bad, ["k"])], batch_id="20260301T000000Z")
    assert W.current_batch(spark, wh) == current
    assert W.read_current(spark, wh, "dim_gas").count() == 3


def test_quality_gate_stops_the_run(spark, tmp_path):
    raw = write_raw(str(tmp_path / "raw"))
    strict = Settings(edition=2024)          # real row-count thresholds: the micro files are far too small
    with pytest.raises(Exception, match="row count"):
        PL.run(spark, raw, str(tmp_path / "out"), steps=["stage", "validate_staging"], cfg=strict, today_year=2026)


def test_page_sources(spark, tmp_path):
    raw = write_raw(str(tmp_path))
    comp = src.page_completeness(spark, raw.pages).first()
    assert comp.pages_found == 2 and comp.records_received == 9 and comp.complete
    with open(f"{raw.pages}/page_3.json", "w") as f:
        json.dump([{"message": [{"id": "120", "value": "Invalid value"}]}], f)
    assert not src.page_completeness(spark, raw.pages).first().complete
    null_page = tmp_path / "nullpage"
    null_page.mkdir()
    (null_page / "page_1.json").write_text(json.dumps([{"page": 1, "pages": 1, "per_page": 5, "total": 0}, None]))
    assert src.read_pages(spark, str(null_page)).count() == 0
    assert src.latest_complete_snapshot(spark, str(tmp_path / "pages")).endswith("pulled=2026-01-01")


def test_stats_file_sources(spark, tmp_path):
    raw = write_raw(str(tmp_path))
    folder = os.path.dirname(raw.stats)
    (tmp_path / "stats" / "Emissions_Totals_E_AreaCodes.csv").write_text("Area Code,Area\n171,Philippines\n")
    assert src.pick_data_member(spark, folder).endswith("All_Data_(Normalized).csv")
    latin = tmp_path / "latin.csv"
    latin.write_bytes("Area\nCura\xe7ao\n".encode("latin-1"))
    assert src.detect_encoding(spark, str(latin)) == "ISO-8859-1"
    assert src.detect_encoding(spark, raw.stats) == "UTF-8"
    assert spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(str(latin)).first().Area == "Curaçao"
    man = src.file_manifest(spark, raw.stats, source="statistics").first()
    assert len(man.sha256) == 64 and man.size_bytes > 0 and man.source == "statistics"


def test_source_profiles(spark, tmp_path):
    from statlayer.operators import conform
    from statlayer.plans import products as P
    from statlayer.profile import sources as PS
    raw = write_raw(str(tmp_path))
    iso = conform.iso_table(spark)
    m = PS.profile_matrix(src.read_matrix(spark, raw.matrix), iso)
    shape = m["shape"].first()
    assert (shape.rows, shape.blank_rows, shape.year_columns) == (13, 1, 2)
    cells = m["cells"].first()
    assert (cells.cells, cells.missing, cells.zeros, cells.negatives) == (26, 3, 0, 0)      # the blank row's cells too
    assert (cells.min_missing, cells.max_missing, cells.missing_pct) == (1, 2, 11.54)
    assert m["duplicate_keys"].first().duplicate_rows == 0          # (substance, sector, code) is unique
    assert {r.code for r in m["non_iso_codes"].collect()} == {"AIR", "GLOBAL TOTAL", "EU27"}
    assert [r.code for r in m["merged_codes"].collect()] == ["SDN"]
    assert m["value_summary"].first()["count"] == 23
    known = conform.known_codes(spark, iso)
    pop = PS.profile_population(src.read_pages(spark, raw.pages), known)
    shape, codes = pop["shape"].first(), pop["codes"].first()
    assert (shape.rows, shape.first_year, shape.last_year, codes.codes, codes.regions) == (9, 2022, 2024, 4, 1)
    assert [r.code for r in pop["regions"].collect()] == ["WLD"]
    assert pop["missing_values"].first().missing == 1 and pop["duplicate_keys"].first().duplicate_rows == 0
    assert [r.year for r in pop["latest_years"].collect()] == [2024, 2023, 2022]
    subs = {r.Substance: (r.rows, r.missing_cells) for r in m["substances"].collect()}
    assert subs["CO2"] == (5, 1) and m["rows_per_sector"].first().Sector == "Agriculture"
    stats = P.tidy_stats(src.read_stats_csv(spark, raw.stats), iso)
    sp = PS.profile_stats(stats, "normalized")
    assert sp["negatives"].first().negative_values == 1 and sp["negatives"].first().projection_rows == 1
    assert {r.area for r in sp["areas_without_iso"].collect()} == set()
    assert tuple(sp["area_kinds"].first()) == (8, 2, 1) and sp["duplicate_keys"].first().duplicate_rows == 0
    assert [(r.area, r["values"]) for r in sp["negatives_by_area"].collect()] == [("Philippines", 1)]
    assert [(r.year, r["values"]) for r in sp["projections_by_year"].collect()] == [(2030, 1)]
    assert sp["in_scope"].first()["values"] == 18 and sp["shape"].first().sources == 1


def test_looks_merged_keeps_real_and_names(spark):
    from statlayer.operators import conform
    df = spark.createDataFrame([("TTO", "Trinidad and Tobago"), ("SDN", "Sudan and South Sudan"), ("BIH", "Bosnia and Herzegovina"),
                                ("SCG", "Serbia and Montenegro"), ("PHL", "Philippines")], "code string, name string")
    flags = {r.code: r.looks_merged for r in conform.with_looks_merged(df, "code", "name", conform.iso_table(spark)).collect()}
    assert flags == {"TTO": False, "SDN": True, "BIH": False, "SCG": True, "PHL": False}


def test_published_sql_on_registered_warehouse(run_once):
    from statlayer.plans import published as Q
    spark, _raw, _base, paths = run_once
    names = W.register_tables(spark, paths.warehouse, "wh_test")
    assert "agri_country_year" in names and len(names) == 8
    spark.sql("USE wh_test")
    try:
        top = spark.sql(Q.sql_q1()).collect()
        assert [r.country_name for r in top] == ["Sudan and South Sudan", "Philippines"] and top[0].total_mt == 93.0
        assert len(spark.sql(Q.sql_q2("PHL", 2000)).collect()) == 2
        assert spark.sql(Q.sql_q3({"CH4": "ch4_pct", "N2O": "n2o_pct", "CO2": "co2_pct"}, 10, dialect="spark")).count() == 1
        assert [r.country_name for r in spark.sql(Q.sql_q4(["PHL", "SDN"])).collect()] == ["Sudan and South Sudan", "Philippines"]
        assert spark.sql(Q.sql_q5(2022, 10)).count() == 2
        audit = spark.sql(Q.sql_q6(dialect="spark")).collect()
        assert len(audit) == 8 and all(r.number_of_loads >= 1 for r in audit)
        assert [r.world_total_mt for r in spark.sql(Q.sql_q7(2022)).collect()] == [141.0, 144.0]
        assert spark.sql(Q.sql_q8("PHL")).count() == 2
        assert spark.sql(Q.sql_q9(5)).count() == 2
        assert spark.sql(Q.sql_q10(20)).count() == 2
    finally:
        spark.sql("USE default")
