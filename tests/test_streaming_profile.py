"""Streaming refresh (new files only, keyed upsert, replay safe), exact distributed quantiles against
numpy, column profile, format round trip and partition pruning in the plan."""
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from statlayer.operators import conform
from statlayer.profile import files as PF
from statlayer.profile import stats as PS
from statlayer.publish import warehouse as W
from statlayer.streaming.refresh import population_refresh


def page(path, records, n=1):
    path.write_text(json.dumps([{"page": n, "pages": n, "per_page": 10, "total": len(records)}, records]))


def rec(code, year, value):
    return {"indicator": {"id": "SP.POP.TOTL", "value": "Population"}, "country": {"id": code[:2], "value": code},
            "countryiso3code": code, "date": str(year), "value": value, "unit": "", "obs_status": "", "decimal": 0}


def test_population_refresh_stream(spark, tmp_path):
    landing, wh, ckpt = tmp_path / "landing", str(tmp_path / "wh"), str(tmp_path / "ckpt")
    landing.mkdir()
    known = conform.known_codes(spark, conform.iso_table(spark))
    page(landing / "page_1.json", [rec("PHL", 2023, 117e6), rec("IND", 2023, 1400e6)])
    population_refresh(spark, str(landing), wh, ckpt, known).awaitTermination()
    first = {(r.iso3, r.year): r.population for r in W.read_current(spark, wh, "population").collect()}
    assert first == {("PHL", 2023): 117_000_000, ("IND", 2023): 1_400_000_000}
    page(landing / "page_2.json", [rec("PHL", 2023, 118e6), rec("PHL", 2024, 119e6)], 2)   # a revision + a new year
    population_refresh(spark, str(landing), wh, ckpt, known).awaitTermination()
    second = {(r.iso3, r.year): r.population for r in W.read_current(spark, wh, "population").collect()}
    assert second == {("PHL", 2023): 118_000_000, ("IND", 2023): 1_400_000_000, ("PHL", 2024): 119_000_000}
    batches = W.commits(spark, wh).count()
    population_refresh(spark, str(landing), wh, ckpt, known).awaitTermination()        # nothing new
    assert W.commits(spark, wh).count() == batches


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal(100, 30, 3000)          # one group holds most of the rows
    cold = rng.normal(5, 1, 7)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold] + [("cold", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    q = {r.g: r for r in PS.exact_quantiles(df, "v", ["g"]).collect()}
    for name, vals in (("hot", hot), ("cold", cold), ("one", np.array([4.0]))):
        for col, p in (("p25", 25), ("p50", 50), ("p75", 75)):
            assert getattr(q[name], col) == pytest.approx(float(np.percentile(vals, p)), rel=1e-12, abs=1e-12)
    whole = PS.summary(df, "v").first()
    assert whole["count"] == 3008 and whole.p50 == pytest.approx(float(np.percentile(np.r_[hot, cold, 4.0], 50)))


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 2.5), (2, "b", -1.0)], "k int, s string, x double")
    p = {r.column: r for r in PS.column_profile(df).collect()}
    assert p["k"].unique == 2 and p["k"].example == "1" and p["k"].type == "int"
    assert p["s"].missing == 1 and p["s"].missing_pct == pytest.approx(33.33)
    assert p["x"].example == "-1.0" and p["x"].non_null == 2
    signs = PS.sign_profile(df, ["x"]).first()
    assert (signs.cells, signs.missing, signs.zeros, signs.negatives) == (3, 1, 0, 1)


def test_formats_and_pruning(spark, tmp_path):
    df = spark.createDataFrame([(1, 10_000_000_000, "a", 1.5), (2, 3, "b", None)], "i int, big long, s string, x double")
    res = {r.format: r for r in PF.compare_formats(df, str(tmp_path / "fmt")).collect()}
    assert res["parquet"].types_preserved and res["parquet"].rows_read_back == 2
    assert not res["json"].types_preserved and "i" in res["json"].columns_with_changed_type
    assert res["csv"].size_bytes > 0
    share = PF.partition_read_share(df, "s", "a", str(tmp_path / "parts")).first()
    assert (share.rows_all, share.rows_read, share.folders) == (2, 1, 2)
    plan = PF.pruned_scan_plan(spark.read.parquet(str(tmp_path / "parts")).where(F.col("s") == "a").select("x"))
    assert "PartitionFilters: [isnotnull(s" in plan and "ReadSchema: struct<x:double>" in plan


def test_bucketed_fact_join_has_no_shuffle(spark, tmp_path):
    from statlayer.sources.bucketed import write_bucketed
    from statlayer.sources.tables import read_table
    from statlayer.session import size_parallelism
    d = "/root/testdata/sf0.001"
    li = write_bucketed(read_table(spark, d, "lineitem"), "li_bucketed", "l_orderkey", 8, str(tmp_path / "li"))
    o = write_bucketed(read_table(spark, d, "orders"), "o_bucketed", "o_orderkey", 8, str(tmp_path / "o"))
    joined = li.join(o, li.l_orderkey == o.o_orderkey).groupBy("o_orderstatus").count()
    plan = PF.pruned_scan_plan(joined)
    tree = plan[:plan.index("(1)")]
    assert "SortMergeJoin" in tree and tree.count("Exchange") == 1       # only the final aggregation
    plain = read_table(spark, d, "lineitem").join(read_table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert joined.agg(F.sum("count")).first()[0] == plain.count()
    assert size_parallelism(spark, 10 << 30) >= 40
    spark.conf.set("spark.sql.shuffle.partitions", "8")
