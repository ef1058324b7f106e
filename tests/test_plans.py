"""Physical-plan properties the scale design relies on, checked on the executed plans."""
from pyspark.sql import functions as F

from statlayer.operators.aggregate import duplicate_rows
from statlayer.operators.dedup import keep_first
from statlayer.operators.windows import share_of_whole
from statlayer.plans import analog as A
from statlayer.plans import products as P
from statlayer.profile.files import pruned_scan_plan
from statlayer.session import configure
from statlayer.sources.tables import read_table

D = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_and_duplicates_combine_before_the_shuffle(spark):
    o = read_table(spark, D, "orders")
    plan = executed(keep_first(o.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"],
                               ["o_orderdate", "o_orderkey"]))
    assert "partial_min_by" in plan and "Window" not in plan
    assert "partial_count" in executed(duplicate_rows(read_table(spark, D, "lineitem"), ["l_orderkey", "l_linenumber"]))


def test_share_of_whole_is_a_scalar_subquery_not_a_window(spark):
    plan = executed(share_of_whole(read_table(spark, D, "orders"), "o_totalprice", "share"))
    assert "Subquery" in plan and "Window" not in plan and "SinglePartition, ENSURE_REQUIREMENTS, [plan_id" in plan


def test_fact_tables_are_never_broadcast(spark):
    configure(spark)
    orders = executed(A.orders_with_nation(spark, D, "o_orderkey"))
    idx = orders.index("BroadcastExchange")                  # nation is broadcast ...
    assert "nation.parquet" in orders[idx:idx + 400]
    plan = executed(A.country_year(spark, D))
    assert "SortMergeJoin" in plan                           # ... the fact join is a shuffle join
    assert "lineitem.parquet], PartitionFilters" in plan
    for text in (orders, plan):
        for part in text.split("BroadcastExchange")[1:]:
            assert not any(f"{name}.parquet" in part[:400] for name in ("lineitem", "orders", "customer"))


def test_exact_quantiles_on_hot_groups(spark):
    """Three flags, each a third of all lines: exact quartiles equal the SQL engine's percentile_cont."""
    import duckdb
    from statlayer.profile.stats import exact_quantiles
    got = {r.l_returnflag: (r.p25, r.p50, r.p75)
           for r in exact_quantiles(read_table(spark, D, "lineitem"), "l_extendedprice", ["l_returnflag"]).collect()}
    want = {r[0]: tuple(r[1:]) for r in duckdb.sql(
        f"SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25), quantile_cont(l_extendedprice, 0.5), "
        f"quantile_cont(l_extendedprice, 0.75) FROM '{D}/lineitem.parquet' GROUP BY 1").fetchall()}
    assert got.keys() == want.keys()
    for k in got:
        assert all(abs(a - b) <= 1e-9 * max(1.0, abs(b)) for a, b in zip(got[k], want[k]))


def test_scope_scan_pushes_filters_and_prunes_columns(spark, tmp_path):
    staged = spark.createDataFrame(
        [(171, "PHL", "Philippines", False, 5060, "Emissions (CO2eq) (AR5)", "FAO TIER 1", 2023, 1.0, False, "x")],
        "area_code int, iso3 string, area string, is_aggregate boolean, item_code int, element string, source string, "
        "year int, value double, is_projection boolean, unused string")
    staged.write.parquet(str(tmp_path / "stats"))
    plan = pruned_scan_plan(P.stats_scope(spark.read.parquet(str(tmp_path / "stats"))))
    assert "PushedFilters: [IsNotNull(source), IsNotNull(element), IsNotNull(year)" in plan
    assert "EqualTo(source,FAO TIER 1)" in plan and "GreaterThanOrEqual(year,2000)" in plan
    assert "unused" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_hot_key_join_is_split_by_aqe(spark):
    """One key holds a third of the rows of a sort-merge join whose output is consumed directly: the runtime
    re-plan splits the hot partition (skew=true) and the result stays exact."""
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    try:
        configure(spark)
        for k, v in conf.items():
            spark.conf.set(k, v)
        big = spark.range(300000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                         F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dim = spark.range(300000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = big.join(dim, "k")
        rows = joined.collect()                      # run THIS plan, so its adaptive plan is final
        assert len(rows) == 300000 and sum(r.w for r in rows) == sum(2 * i for i in range(300000) if i % 3)
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        configure(spark)


def test_hot_key_join_before_an_aggregation_is_split_too(spark):
    """The join feeds a grouping on other columns: the split costs one more shuffle and is forced."""
    conf = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    try:
        configure(spark)
        for k, v in conf.items():
            spark.conf.set(k, v)
        big = spark.range(300000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                         F.sha2(F.col("id").cast("string"), 256).alias("v"))
        dim = spark.range(300000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("w"))
        grouped = big.join(dim, "k").groupBy("k").agg(F.count("v").alias("n"))
        assert sum(r.n for r in grouped.collect()) == 300000
        assert "skew=true" in grouped._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
        configure(spark)


def test_quantiles_do_not_hang_on_exchange_reuse(spark):
    """The same quartiles without exchange reuse and without AQE, grouped and ungrouped."""
    from statlayer.profile.stats import exact_quantiles
    li = read_table(spark, D, "lineitem")
    want = sorted(map(tuple, exact_quantiles(li, "l_extendedprice", ["l_returnflag"]).collect())), \
        exact_quantiles(li, "l_extendedprice").collect()
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = sorted(map(tuple, exact_quantiles(li, "l_extendedprice", ["l_returnflag"]).collect())), \
            exact_quantiles(li, "l_extendedprice").collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        configure(spark)
    assert got == want and None not in tuple(got[1][0])


def test_products_follow_changed_inputs(spark, tmp_path):
    """A published product is built anew when a file it reads has changed."""
    d = str(tmp_path)
    for name in A.INPUTS:
        read_table(spark, D, name).write.parquet(f"{d}/{name}.parquet")
    before = A.published(spark, d, "fact_emissions").agg(F.sum("emissions_mt_co2eq")).first()[0]
    read_table(spark, D, "lineitem").where("l_orderkey % 2 = 0").write.mode("overwrite").parquet(f"{d}/lineitem.parquet")
    after = A.published(spark, d, "fact_emissions").agg(F.sum("emissions_mt_co2eq")).first()[0]
    assert 0 < after < before
