"""Schema drift (K12, S7): declared columns against what the data files hold.

The footers of all files of a table are read by tasks (a listing is the only table that moves), so one odd file
among many is found; reading a folder with a declared schema alone would show its missing column as nulls.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_columns(spark: SparkSession, path: str) -> DataFrame:
    """file, column, type (Spark's name): one row a column of every Parquet file under a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path).select("path")

    def footers(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_type

        for batch in batches:
            found = {"file": [], "column": [], "type": []}
            for uri in batch.column("path").to_pylist():
                system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
                with system.open_input_file(name) as f:
                    for field in pq.read_schema(f):
                        kind = "timestamp" if pa.types.is_timestamp(field.type) else from_arrow_type(field.type).simpleString()
                        for values, v in zip(found.values(), (uri, field.name, kind)):
                            values.append(v)
            yield pa.RecordBatch.from_pydict(found, schema=pa.schema([(k, pa.string()) for k in found]))

    return files.mapInArrow(footers, "file string, column string, type string")


def schema_drift(spark: SparkSession, table: str, path: str, declared: T.StructType, partitions: tuple = ()) -> DataFrame:
    """table_name, column, declared, found, files: columns that are declared and missing in files, held by files and not
    declared, or of another type. Partition columns stand in folder names, not in files. No row: no drift."""
    held = file_columns(spark, path)
    files = held.select(F.count_distinct("file")).scalar()
    wanted = spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in declared if f.name not in partitions], "name string, declared string")
    found = held.groupBy("column", "type").agg(F.count_distinct("file").alias("files"))
    both = wanted.join(found, F.col("name") == F.col("column"), "full")
    differs = F.coalesce(F.col("declared") != F.col("type"), F.lit(True))
    other = both.where(differs).select(F.coalesce("name", "column").alias("column"), "declared", F.col("type").alias("found"), F.coalesce("files", files).alias("files"))
    # a column that some files hold and others lack
    partly = found.groupBy("column").agg(F.sum("files").alias("n")).where(F.col("n") < files) \
        .join(wanted, F.col("name") == F.col("column")).select("column", "declared", F.lit(None).cast("string").alias("found"), (files - F.col("n")).alias("files"))
    return other.unionByName(partly).select(F.lit(table).alias("table_name"), "column", "declared", "found", "files")
