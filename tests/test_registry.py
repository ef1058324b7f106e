"""Declared schemas against files, manifests of raw files, mapping files, thresholds, content digests."""
import pytest
from pyspark.sql import functions as F

from statlayer import schemas
from statlayer.errors import DataQualityError, ExtractionError
from statlayer.operators import conform
from statlayer.plans import layers as PL
from statlayer.publish import warehouse as W
from statlayer.quality.drift import schema_drift
from statlayer.settings import Settings, Thresholds
from statlayer.sources import files as src

from test_layers import CFG, write_raw


def test_nine_tables_are_declared():
    assert len(schemas.TABLES) == 9 and set(schemas.CONTRACTS) | {"load_audit"} == set(schemas.TABLES)
    assert schemas.TABLES["fact_emissions"].fieldNames()[1] == "gas_code" and "activity" not in schemas.TABLES["fact_emissions_by_activity"].fieldNames()


def test_drift_is_found_in_one_odd_file(spark, tmp_dir):
    declared = schemas.struct(("k", schemas.L), ("v", schemas.S), ("at", schemas.TS), ("part", schemas.S))
    good = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"), F.current_timestamp().alias("at"), F.lit("p").alias("part"))
    good.repartition(3).write.partitionBy("part").parquet(f"{tmp_dir}/t")
    assert schema_drift(spark, "t", f"{tmp_dir}/t", declared, ("part",)).count() == 0
    good.coalesce(1).select(F.col("k").cast("int"), "at", F.lit(1.5).alias("more"), "part").write.mode("append").partitionBy("part").parquet(f"{tmp_dir}/t")
    got = {(r.column, r.declared, r.found, r.files) for r in schema_drift(spark, "t", f"{tmp_dir}/t", declared, ("part",)).collect()}
    assert got == {("k", "bigint", "int", 1), ("more", None, "double", 1), ("v", "string", None, 1)}


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("registry"))
    raw = write_raw(root)
    return raw, PL.run(spark, raw, f"{root}/out", steps=["stage", "curate"], cfg=CFG, run_id="r1", today_year=2026)


def test_the_run_writes_and_verifies_its_manifest(spark, staged):
    raw, paths = staged
    known = {(r.source, r.file): r for r in spark.read.parquet(paths.report("raw_files")).collect()}
    assert {s for s, _ in known} == {"matrix", "population", "stats"} and all(len(r.sha256) == 64 for r in known.values())
    shown = spark.read.option("header", True).csv(paths.report("provenance"))
    assert shown.count() == len(known) and shown.where("by_hand = 'true'").count() == 0
    assert spark.read.json(paths.report("pull_manifest")).first().complete
    PL.run(spark, raw, paths.base, steps=["curate"], cfg=CFG, run_id="r1", today_year=2026)          # nothing changed
    page = f"{raw.pages}/page_1.json"
    before = open(page, "rb").read()
    open(page, "wb").write(before.replace(b"Sudan", b"Sudam"))
    with pytest.raises(ExtractionError, match=r"population/page_1.json \(changed\)"):
        PL.run(spark, raw, paths.base, steps=["curate"], cfg=CFG, run_id="r1", today_year=2026)
    open(page, "wb").write(before)
    open(f"{raw.pages}/page_9.json", "w").write("[]")
    with pytest.raises(ExtractionError, match=r"population/page_9.json \(new\)"):
        PL.run(spark, raw, paths.base, steps=["stage"], cfg=CFG, run_id="r1", today_year=2026)


def test_a_table_of_another_schema_stops_the_run(spark, staged):
    _raw, paths = staged
    PL.validate(spark, paths, "curated_stats", CFG)
    rows = PL.read_curated(spark, paths, "edgar_vs_faostat")
    rows.withColumn("year", F.col("year").cast("long")).write.mode("append").parquet(paths.curated("edgar_vs_faostat"))
    with pytest.raises(DataQualityError, match="year: declared int, 1 file.s. hold bigint"):
        PL.validate(spark, paths, "curated_stats", CFG)


def test_changed_files(spark):
    make = lambda *rows: spark.createDataFrame([("s", f, h) for f, h in rows], "source string, file string, sha256 string")
    got = src.changed_files(make(("a", "1"), ("b", "2"), ("c", "3")), make(("a", "1"), ("b", "9"), ("d", "4"))).collect()
    assert {(r.file, r.change) for r in got} == {("b", "changed"), ("c", "missing"), ("d", "new")}


def test_mapping_files(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text("wb_code,edgar_code,reason\nSSD,AAA,first\nSRB,SCG,x\nSSD,SDN,last\n")
    mapping = conform.country_mapping(spark, path=str(path))
    assert {tuple(r) for r in conform.last_listed(mapping.repartition(7), "wb_code", "edgar_code").collect()} == {("SSD", "SDN"), ("SRB", "SCG")}
    listed = conform.area_mapping(spark, rows=[(1, "a", "X", ""), (1, "a", "B", ""), (2, "b", "C", "")])
    assert {tuple(r) for r in conform.last_listed(listed, "fao_area_code", "edgar_code").collect()} == {(1, "B"), (2, "C")}
    path.write_text("wb_code,edgar_code,reason\nSSD\n")
    with pytest.raises(Exception):
        conform.country_mapping(spark, path=str(path)).collect()


def test_thresholds_as_input():
    cfg = Settings.with_thresholds(["min_matrix_rows=5", "world_gap=0.5"], edition=2020)
    assert (cfg.thresholds.min_matrix_rows, cfg.thresholds.world_gap, cfg.edition) == (5, 0.5, 2020)
    assert cfg.thresholds.share_gap == Thresholds().share_gap
    with pytest.raises(ValueError, match="unknown threshold 'nothing'"):
        Settings.with_thresholds(["nothing=1"])
    with pytest.raises(ValueError):
        Settings.with_thresholds(["min_matrix_rows=many"])


def test_content_digest(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 1.5), (2, None, 1.5)], "k int, v string, w double")
    same = lambda a, b: W.content_digest(a).collect() == W.content_digest(b).collect()
    assert same(df, df.repartition(5).select("w", "v", "k"))
    assert not same(df, df.distinct()) and not same(df, df.withColumn("w", F.coalesce("w", F.lit(0.0))))
    swapped = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert not same(swapped, swapped.limit(1).unionByName(swapped.limit(1)))
    assert tuple(W.content_digest(df.limit(0)).first()) == (0, 0, 0)


def test_newest_complete_statistics_file(spark, tmp_path):
    for day, name, marked in (("2026-01-01", "old.csv", True), ("2026-02-01", "new.csv", True), ("2026-03-01", "cut.csv", False)):
        folder = tmp_path / f"pulled={day}"
        folder.mkdir()
        (folder / name).write_text("a\n1\n")
        if marked:
            (folder / f"{name}.meta.json").write_text("{}")
    assert src.complete_file(spark, str(tmp_path)).endswith("pulled=2026-02-01/new.csv")
    assert src.complete_file(spark, str(tmp_path / "pulled=2026-01-01")).endswith("old.csv")
    with pytest.raises(ExtractionError):
        src.complete_file(spark, str(tmp_path / "pulled=2026-03-01"))


def test_scratch_copies_of_reports_go(spark):
    import os

    from statlayer.profile.files import compare_formats, partition_read_share
    from statlayer.session import ensure_checkpoint_dir
    count = lambda: sum(len(f) for _, _, f in os.walk(ensure_checkpoint_dir(spark).removeprefix("file:")))
    df, before = spark.range(10).withColumn("p", F.col("id") % 2), count()
    assert compare_formats(df).count() == 3 and partition_read_share(df, "p", 1).first().rows_read == 5
    assert count() == before
