"""Co-located fact tables: write the large tables of a star once, bucketed and sorted by their join key,
so every later join between tables bucketed the same way reads matching buckets side by side - no
shuffle of either side (the dominant cost of a fact-to-fact join at scale). One-time write cost,
paid back by every query that joins on the key."""
from __future__ import annotations

from pyspark.sql import DataFrame


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Save ``df`` as catalog table ``table`` with ``buckets`` hash buckets on ``key`` (sorted inside each
    bucket); ``path`` puts the files in shared storage. Returns the table."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
