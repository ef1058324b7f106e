"""Column and distribution profiles.

Exact quantiles at scale: Spark's exact ``percentile`` merges a map of every distinct value of a group
into one task, so a group holding a third of the rows (or a high-cardinality double column) becomes
one huge task. ``exact_quantiles`` instead ranks every value with a range-partitioned global sort: each
partition counts its rows per group, a tiny table of those counts gives every partition its exact
rank offset, and only the (at most 2 per quantile) rows at the wanted ranks survive: their places are
broadcast once their number is known to be small, so the values are shuffled once. The result equals
linear interpolation between closest ranks (pandas ``quantile``, SQL ``percentile_cont``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlayer.session import stored_table

SPOTS_BROADCAST = 100_000      # places of wanted ranks that are broadcast; more are joined by a shuffle of the values


def exact_quantiles(df: DataFrame, value: str, by: list[str] | None = None, qs=(0.25, 0.5, 0.75),
                    names: list[str] | None = None) -> DataFrame:
    """One row per group: exact linearly interpolated quantiles of ``value`` (nulls and NaN skipped)."""
    by = list(by or [])
    names = names or [f"p{int(round(q * 100))}" for q in qs]
    keys = by or ["__g"]
    vals = df.select(*[F.col(c) for c in by], F.nanvl(F.col(value).cast("double"),
                                                      F.lit(None).cast("double")).alias("__v"))
    if not by:
        vals = vals.withColumn("__g", F.lit(0))
    vals = vals.where(F.col("__v").isNotNull())
    # 1. global order by (group, value): range partitions split a hot group over many tasks
    # the order is written once with partition and place as data: both passes below read the same table, so
    # nothing depends on how often the range partitioning is run or whether an exchange is reused
    ranked = stored_table(vals.repartitionByRange(*keys, "__v").sortWithinPartitions(*keys, "__v")
                          .withColumn("__pid", F.spark_partition_id())
                          .withColumn("__idx", F.monotonically_increasing_id()), "ranked")
    # 2. per (partition, group): first index and row count -> exact rank offset of that slice
    slices = ranked.groupBy("__pid", *keys).agg(F.min("__idx").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__offset", F.coalesce(F.sum("__cnt").over(w), F.lit(0)))
    totals = slices.groupBy(*keys).agg(F.sum("__cnt").alias("__n"))
    # 3. wanted ranks per group (0-based): floor and ceil of q * (n - 1) for every quantile
    bounds = totals.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("qi"), (F.lit(q) * (F.col("__n") - 1)).alias("pos")) for i, q in enumerate(qs)]))
        .alias("__q")).select(*keys, "__q.qi", "__q.pos").withColumn("__lo", F.floor("pos").cast("long")) \
        .withColumn("__hi", F.ceil("pos").cast("long"))
    needed = bounds.select(*keys, F.explode(F.array("__lo", "__hi")).alias("__rank")).distinct()
    # 4. a wanted rank lies in one slice: (partition, place) names its row; interpolate between those rows
    spots = (slices.join(needed, keys).where((F.col("__rank") >= F.col("__offset")) & (F.col("__rank") < F.col("__offset") + F.col("__cnt")))
             .select(*keys, "__rank", (F.col("__first") + F.col("__rank") - F.col("__offset")).alias("__idx")))
    spots = stored_table(spots, "spots")
    if spots.count() <= SPOTS_BROADCAST:                          # two rows a quantile and group
        spots = F.broadcast(spots)
    located = ranked.select("__idx", "__v").join(spots, "__idx").select(*keys, "__rank", "__v")
    pairs = bounds.join(located, keys).where((F.col("__rank") == F.col("__lo")) | (F.col("__rank") == F.col("__hi")))
    interp = pairs.groupBy(*keys, "qi", "pos", "__lo").agg(
        F.max(F.when(F.col("__rank") == F.col("__lo"), F.col("__v"))).alias("__vlo"),
        F.max(F.when(F.col("__rank") == F.col("__hi"), F.col("__v"))).alias("__vhi"))
    interp = interp.withColumn("val", F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * (F.col("pos") - F.col("__lo")))
    out = interp.groupBy(*keys).agg(*[F.max(F.when(F.col("qi") == i, F.col("val"))).alias(n)
                                      for i, n in enumerate(names)])
    return out.drop("__g") if not by else out


def summary(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max of ``value`` per group (``describe``)."""
    by = list(by or [])
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    stats = df.groupBy(*by).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                F.min(v).alias("min"), F.max(v).alias("max"))
    q = exact_quantiles(df, value, by, names=["p25", "p50", "p75"])
    if by:
        joined = stats.join(q, by, "left")
    else:   # two one-row tables: equi-join on a constant key
        joined = stats.withColumn("__g", F.lit(0)).join(q.withColumn("__g", F.lit(0)), "__g", "left")
    return joined.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: type, non-null, missing, missing %, unique, example (smallest value as
    text, deterministic). Counts and examples are one aggregation; distinct values are counted in two steps over
    (column, 128-bit hash of the value), so the shuffle holds one row a column and distinct value of a task, and
    no row is expanded by the number of columns."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), F.count_if(col.isNull()).alias(f"m{i}"), F.min(col).cast("string").alias(f"e{i}")]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                             F.col(f"n{i}").alias("non_null"), F.col(f"m{i}").alias("missing"),
                             F.round(F.try_divide(F.lit(100.0) * F.col(f"m{i}"), F.col("__rows")), 2).alias("missing_pct"),
                             F.coalesce(F.col(f"e{i}"), F.lit("")).alias("example"))
                    for i, c in enumerate(columns)])
    return row.select(F.inline(arr)).join(distinct_counts(df, columns), "i", "left") \
        .select("column", "type", "non_null", "missing", "missing_pct", F.coalesce("unique", F.lit(0)).cast("long").alias("unique"), "example")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """i (place in ``columns``), unique: number of distinct values, missing ones left out."""
    cell = [F.when(F.col(f"`{c}`").isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(F.col(f"`{c}`")).alias("a"),
                                                         F.xxhash64(F.lit(1), F.col(f"`{c}`")).alias("b"))) for i, c in enumerate(columns)]
    cells = df.select(F.explode(F.array_compact(F.array(*cell))).alias("cell")).select("cell.*")
    return cells.groupBy("i", "a", "b").agg(F.lit(1)).groupBy("i").agg(F.count(F.lit(1)).alias("unique"))


def sign_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cells, missing, zeros and negatives over a set of numeric columns (one pass)."""
    aggs = []
    for c in columns:
        col = F.col(f"`{c}`")
        aggs += [F.count_if(col.isNull()), F.count_if(col == 0), F.count_if(col < 0)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[a.alias(f"a{i}") for i, a in enumerate(aggs)])
    k = len(columns)
    return row.select((F.col("rows") * k).alias("cells"),
                      sum((F.col(f"a{3 * i}") for i in range(k)), F.lit(0)).alias("missing"),
                      sum((F.col(f"a{3 * i + 1}") for i in range(k)), F.lit(0)).alias("zeros"),
                      sum((F.col(f"a{3 * i + 2}") for i in range(k)), F.lit(0)).alias("negatives"))
