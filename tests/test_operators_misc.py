"""Operator helpers not covered elsewhere: share of a group by the join method, null profile, explode,
flatten, frequency order, input size."""
import os

import pytest
from pyspark.sql import functions as F

from statlayer.operators.aggregate import null_profile, value_counts
from statlayer.operators.reshape import explode_delimited, flatten
from statlayer.operators.windows import share_of_group
from statlayer.session import input_bytes


def test_share_of_group_window_and_join_agree(spark):
    df = spark.createDataFrame([("A", 2020, 30.0), ("B", 2020, 10.0), ("A", 2021, 5.0)], "c string, y int, v double")
    w = {(r.c, r.y): r.s for r in share_of_group(df, "v", ["y"], "s").collect()}
    j = {(r.c, r.y): r.s for r in share_of_group(df, "v", ["y"], "s", method="join").collect()}
    assert w == j and w[("A", 2020)] == pytest.approx(75.0) and w[("A", 2021)] == pytest.approx(100.0)


def test_null_profile_and_value_counts(spark):
    df = spark.createDataFrame([("x", None), ("y", 1), ("y", None)], "a string, b int")
    prof = {r.column: (r.non_null, r.missing) for r in null_profile(df, ["a", "b"]).collect()}
    assert prof == {"a": (3, 0), "b": (1, 2)}
    assert [(r.a, r["count"]) for r in value_counts(df, ["a"]).collect()] == [("y", 2), ("x", 1)]


def test_explode_and_flatten(spark):
    df = spark.createDataFrame([("SDN", "SDN;SSD", ("id1", "Name"))], "code string, parts string, rec struct<id:string,value:string>")
    assert sorted(r.part for r in explode_delimited(df, "parts", ";", "part").collect()) == ["SDN", "SSD"]
    flat = flatten(df, {"code": "code", "rid": "rec.id", "rname": "rec.value"}).first()
    assert (flat.code, flat.rid, flat.rname) == ("SDN", "id1", "Name")


def test_input_bytes_matches_the_files(spark):
    d = "/root/testdata/sf0.001"
    want = sum(os.path.getsize(os.path.join(d, f)) for f in os.listdir(d))
    assert input_bytes(spark, d) == want
    assert input_bytes(spark, f"{d}/nation.parquet") == os.path.getsize(f"{d}/nation.parquet")


def test_a_callers_table_is_broadcast_only_if_it_is_counted_small(spark, monkeypatch):
    from statlayer.operators import joins
    plan = lambda: spark.range(100).join(joins.counted_dim(spark.range(10).withColumnRenamed("id", "k")), F.col("id") == F.col("k")) \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr(joins, "DIM_ROWS", 5)
    assert "broadcast" not in plan()
