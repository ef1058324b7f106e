"""Helpers shared by the training-data operators."""
from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from statlayer.session import scratch_path

# ASCII white space of the word definition shared by the operators: fixed values.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 4 << 20      # text handled at once inside a task; bounds a worker's memory


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table of a data folder, only the columns asked for."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def fold_of(doc_id, parts: int):
    """crc32 of the id written as text, modulo ``parts`` (Python side)."""
    return zlib.crc32(str(doc_id).encode()) % parts


def fold(col: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts`` (Spark side)."""
    return F.crc32(col.cast("string").cast("binary")) % parts


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table written to the shared scratch folder: read often, computed once, and safe
    from the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished writes now: its cleaner does so when the driver's collector
    finds that nobody holds their plans, which on an idle driver may take long."""
    spark.sparkContext._jvm.System.gc()


def release_executors(spark: SparkSession) -> None:
    """Let the executors' JVMs collect their garbage between two steps, with a task a core. A step leaves large dead
    buffers (sort and hash pages, and direct ones, which go only when their owners are collected); until its collector
    happens to run, an executor holds them beside what the next step and its Python workers take."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc")).alias("done")) \
        .write.format("noop").mode("overwrite").save()


def discard(*tables: DataFrame) -> None:
    """Remove ``stored`` tables that nothing reads any more, and the shuffle files of finished writes."""
    release_shuffles(tables[0].sparkSession)
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_memory() -> None:
    """Give memory that a task no longer needs back to the system: Python workers outlive their tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                  # another C library
        pass


def share(spark: SparkSession, value):
    """Broadcast an object of bounded size; returns a function that gives a task its own copy."""
    from pyspark import cloudpickle

    shipped = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(shipped.value)


def strings(column) -> list:
    """An Arrow string column as Python strings; null stays None, broken UTF-8 is replaced."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        import pyarrow as pa
        raw = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
        return [None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()]


def slices(batch, column: str, target: int = SLICE_BYTES):
    """Row slices of an Arrow batch whose text column holds about ``target`` bytes (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    block = np.cumsum(sizes) // target
    starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [batch.num_rows]])
    for a, b in zip(starts[:-1], starts[1:]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def keep_rows(docs: DataFrame, make_judge, *columns: str) -> DataFrame:
    """Rows for which the judge says True, all columns as they are (so names cannot clash).

    ``make_judge()`` runs once a task and returns a function of Arrow columns -> list of booleans.
    """
    names = [docs.columns.index(c) for c in columns]
    text = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        judge = make_judge()
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=[str(i) for i in range(batch.num_columns)])
            for part in slices(batch, str(text)):
                out = part.filter(pa.array(judge(*[part.column(i) for i in names]), type=pa.bool_()))
                if out.num_rows:
                    yield pa.RecordBatch.from_arrays(out.columns, names=docs_names)
        del judge
        release_memory()

    docs_names = docs.columns
    return docs.mapInArrow(run, docs.schema)


def map_rows(df: DataFrame, make_worker, schema: str) -> DataFrame:
    """mapInArrow in bounded slices: ``make_worker()`` runs once a task and returns batch -> batch."""
    def run(batches):
        work = make_worker()
        for batch in batches:
            for part in slices(batch, "text"):
                yield work(part)
        del work
        release_memory()

    return df.mapInArrow(run, schema)
