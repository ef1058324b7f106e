"""Incremental refresh of a published table from newly landed raw files (Structured Streaming).

The batch pipeline re-stages a whole new pull each month. Here the same tidy step runs as a file
stream: every new page file in the landing folder is parsed, flattened and typed by the product code,
then each micro-batch is upserted (keyed) into the published table through the commit-record publish.
``trigger(availableNow=True)`` processes what has landed and stops, so a scheduler can run it like a
batch job; the checkpoint remembers which files were done. A replayed epoch commits its batch id again: the
upsert gives the same rows, and the audit keeps the last row of a batch, so the effect on the table is that of
one load. Pages are read as strictly as in the batch run: a file that is no page of records stops the stream.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statlayer.plans import products as P
from statlayer.publish.warehouse import TableLoad, load_warehouse
from statlayer.sources.files import page_parts, page_records


def page_records_stream(spark: SparkSession, landing: str, glob: str = "page_*.json") -> DataFrame:
    """Streaming DataFrame of the records of every new page file (a null records page gives none)."""
    raw = (spark.readStream.schema("value string").option("wholetext", True).option("pathGlobFilter", glob)
           .text(landing))
    return page_records(page_parts(raw.withColumn("file", F.input_file_name())))


def population_refresh(spark: SparkSession, landing: str, warehouse: str, checkpoint: str,
                       known_codes: DataFrame, table: str = "population") -> StreamingQuery:
    """Start the refresh; returns the query (call ``awaitTermination()``; it stops when caught up)."""
    tidy = P.tidy_population(page_records_stream(spark, landing), known_codes)   # stream-static join

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select("iso3", "wb_name", "year", "population", "is_country", "indicator")
        load_warehouse(batch.sparkSession, warehouse, [TableLoad(table, rows, ["iso3", "year"], "dimension")],
                       batch_id=f"stream{epoch_id:010d}")

    return (tidy.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
