"""Parquet table scans.

Scans are lazy: Catalyst pushes column pruning (``ReadSchema``), predicates (``PushedFilters``) and
partition filters (``PartitionFilters``) into the reader, so a 2-column query reads 2 columns and a
filter on a partition column opens only the matching folders.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Full scan of a layer table (S7); with a declared schema when given (no inference)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(table_path(base, name))


def read_projected(spark: SparkSession, path: str, columns: list[str], predicate: Column | None = None) -> DataFrame:
    """Column-projected, predicate-filtered scan (S6); both reach the Parquet reader."""
    df = spark.read.parquet(path).select(*columns)
    return df.where(predicate) if predicate is not None else df


def read_partition(spark: SparkSession, path: str, column: str, value) -> DataFrame:
    """Partition-pruned scan (S5): only ``column=value`` folders are listed and read."""
    from pyspark.sql import functions as F
    return spark.read.parquet(path).where(F.col(column) == F.lit(value))


def literal_table(spark: SparkSession, rows: list, schema) -> DataFrame:
    """Literal table from code/config."""
    return spark.createDataFrame(rows, schema)


def fetch_value(df: DataFrame):
    """Single-value query (S13): the first column of the first row of a one-row aggregate."""
    row = df.first()
    return None if row is None else row[0]


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Mapping-table CSV with a declared schema (S8) and each entry's place in the file as column ``position``: the
    place is data from the scan on, so that "the last listed entry wins" holds after any shuffle. A row with too few
    or too many fields, or a value of another type, fails the read."""
    from pyspark.sql import functions as F
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path) \
        .withColumn("position", F.monotonically_increasing_id())
