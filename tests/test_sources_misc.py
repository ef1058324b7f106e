"""Small sources and sinks: provenance lines, pull manifest, mapping CSV, DDL, single value, pruned and
projected scans."""
import json

from pyspark.sql import functions as F

from statlayer import schemas
from statlayer.profile.files import provenance, pruned_scan_plan
from statlayer.sources import files as src
from statlayer.sources import tables as T


def test_provenance_marks_copies_placed_by_hand(spark):
    man = spark.createDataFrame(
        [("a.xlsx", "2026-01-01T00:00:00+00:00", None, None, None),
         ("b.zip", None, "2026-02-01T00:00:00+00:00", "manual copy", "copied from a colleague"),
         ("c.zip", None, "2026-02-01T00:00:00+00:00", "scripted download", None)],
        "file string, recorded_at string, retrieved_at string, retrieval_method string, note string")
    rows = {r.file: tuple(r)[1:] for r in provenance(man).collect()}
    assert rows["a.xlsx"] == ("2026-01-01T00:00:00+00:00", "scripted API calls", False, None)
    assert rows["b.zip"] == ("2026-02-01T00:00:00+00:00", "manual copy", True, "copied from a colleague")
    assert rows["c.zip"][2] is False
    assert provenance(man.select("file", "recorded_at")).where("by_hand").count() == 0


def test_pull_manifest_and_json_sink(spark, tmp_path):
    folder = tmp_path / "pull"
    folder.mkdir()
    (folder / "page_1.json").write_text(json.dumps([{"page": 1, "pages": 1, "per_page": 2, "total": 2},
                                                    [{"date": "2024"}, {"date": "2023"}]]))
    manifest = src.pull_manifest(src.page_completeness(spark, str(folder)), "SP.POP.TOTL")
    assert manifest["pages"] == 1 and manifest["records"] == 2 and manifest["complete"]
    src.write_json_text(spark, manifest, str(tmp_path / "manifest"))
    assert json.loads(spark.read.text(str(tmp_path / "manifest")).first()[0])["records"] == 2


def test_mapping_csv_ddl_and_single_value(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("wb_code,edgar_code,reason\nSDN,SDN,x\nSSD,SDN,y\n")
    m = T.read_csv_table(spark, str(path), schemas.COUNTRY_MAPPING)
    assert m.count() == 2 and dict(m.dtypes)["wb_code"] == "string"
    assert T.fetch_value(m.agg(F.count_distinct("edgar_code"))) == 1
    loc = str(tmp_path / "dim_gas")
    spark.createDataFrame([("CO2", "Carbon dioxide", None)], schemas.DIM_GAS).write.parquet(loc)
    spark.sql(schemas.ddl("ddl_dim_gas", schemas.DIM_GAS, loc))
    spark.sql(schemas.ddl("ddl_dim_gas", schemas.DIM_GAS, loc))          # idempotent
    assert spark.table("ddl_dim_gas").count() == 1


def test_pruned_and_projected_scans(spark, tmp_path):
    df = spark.createDataFrame([("agriculture", 1, 2.0), ("waste", 2, 3.0)], "sector_key string, year int, v double")
    df.write.partitionBy("sector_key").parquet(str(tmp_path / "t"))
    one = T.read_partition(spark, str(tmp_path / "t"), "sector_key", "agriculture")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(sector_key" in pruned_scan_plan(one)
    proj = T.read_projected(spark, str(tmp_path / "t"), ["year"], F.col("year") >= 2)
    plan = pruned_scan_plan(proj)
    assert proj.count() == 1 and "GreaterThanOrEqual(year,2)" in plan and "ReadSchema: struct<year:int>" in plan
