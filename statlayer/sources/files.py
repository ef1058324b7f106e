"""Raw-file sources: wide matrix files (S1), paged JSON pulls (S2, S11, U3), delimited statistics files
with encoding detection and member choice (S3, S4), latest complete snapshot (S9) and raw-file
manifests (S12).

All of them are Spark reads: files are listed and read by executors; the driver only sees counts,
column names and the chosen snapshot name.
"""
from __future__ import annotations

import json
import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlayer import settings
from statlayer.errors import ExtractionError


# ----------------------------------------------------------------------------- S1
def read_matrix(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The wide yearly matrix exactly as stored (header row, every column as text for CSV so mixed
    year-column types never break the reshape). Parquet keeps its own types."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


# ----------------------------------------------------------------------------- S2 / S11
RECORD = T.StructType([
    T.StructField("indicator", T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])),
    T.StructField("country", T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])),
    T.StructField("countryiso3code", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("obs_status", T.StringType()),
    T.StructField("decimal", T.IntegerType()),
])
PAGE_INFO = "struct<page:bigint,pages:bigint,per_page:bigint,total:bigint>"


def read_page_files(spark: SparkSession, folder: str, glob: str = "page_*.json") -> DataFrame:
    """Each page file is one JSON document ``[page_info, [records] | null]`` -> one row per file with the
    parsed page info and the raw records text. Files are read whole, in parallel."""
    return page_parts(spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(folder).withColumn("file", F.input_file_name()))


def page_parts(raw: DataFrame) -> DataFrame:
    """file, elements, info, records_json of whole page documents (value, file), batch or stream."""
    parts = raw.select("file", F.from_json("value", "array<string>").alias("a"))
    return parts.select("file", F.size("a").alias("elements"),
                        F.from_json(F.get(F.col("a"), 0), PAGE_INFO).alias("info"),
                        F.get(F.col("a"), 1).alias("records_json"))


def read_pages(spark: SparkSession, folder: str, glob: str = "page_*.json") -> DataFrame:
    """All records of all page files (a page whose records are null gives no rows). A file that is not
    ``[info, records]``, or whose records cannot be read, stops the read: a page is never lost in silence."""
    return page_records(read_page_files(spark, folder, glob))


def page_records(pages: DataFrame) -> DataFrame:
    """The records of parsed page documents (``page_parts``)."""
    parsed = F.from_json("records_json", T.ArrayType(RECORD))
    nothing = F.col("records_json").isNull() | (F.trim("records_json") == "null")
    sound = (F.coalesce(F.col("elements"), F.lit(-1)) == 2) & F.col("info.pages").isNotNull() & (nothing | parsed.isNotNull())
    bad = F.raise_error(F.concat(F.lit("not a page of [info, records]: "), F.col("file"))).cast(T.ArrayType(RECORD))
    records = pages.select(F.explode(F.when(~sound, bad).otherwise(parsed)).alias("r"))
    return records.select("r.*")


def page_completeness(spark: SparkSession, folder: str, glob: str = "page_*.json") -> DataFrame:
    """One row: pages found, pages announced, records received, records announced, error pages
    (documents that are not a 2-element [info, records] array), and ``complete``."""
    pages = read_page_files(spark, folder, glob).withColumn(
        "n_records", F.coalesce(F.size(F.from_json("records_json", "array<string>")), F.lit(0)))
    return pages.agg(
        F.count(F.lit(1)).alias("pages_found"), F.max("info.pages").alias("pages_announced"),
        F.sum("n_records").alias("records_received"), F.max("info.total").alias("records_announced"),
        F.count_if(F.col("elements") != 2).alias("error_pages"),
    ).withColumn("complete", (F.col("error_pages") == 0) & (F.col("pages_found") == F.col("pages_announced"))
                 & (F.col("records_received") == F.col("records_announced")))


# ----------------------------------------------------------------------------- S3 / S4 / T21
def is_utf8(spark: SparkSession, path: str) -> bool:
    """True when every line under ``path`` is valid UTF-8. The text source keeps each line's raw bytes
    (no decoding), so this is a splittable, line-parallel aggregate - no file is loaded as one row."""
    ok = spark.read.text(path).agg(F.coalesce(F.bool_and(F.is_valid_utf8("value")), F.lit(True))).first()[0]
    return bool(ok)


def detect_encoding(spark: SparkSession, path: str, encodings=("UTF-8", "ISO-8859-1")) -> str:
    """First encoding that decodes the file: UTF-8 when valid, else Latin-1 (which decodes any bytes)."""
    return encodings[0] if is_utf8(spark, path) else encodings[-1]


def pick_data_member(spark: SparkSession, folder: str) -> str:
    """Choose the data CSV among unpacked members by name (``.csv`` and ``all_data``, any case)."""
    names = spark.read.format("binaryFile").load(folder).select("path").where(
        F.lower(F.col("path")).endswith(".csv") & F.lower(F.col("path")).contains("all_data"))
    row = names.orderBy("path").first()
    if row is None:
        raise ExtractionError(f"no data CSV in {folder}")
    return row.path


YEAR_VALUE, YEAR_FLAG = re.compile(r"Y\d{4}"), re.compile(r"Y\d{4}F")
STATS_INTEGERS = ("Area Code", "Item Code", "Year")


def stats_column(name: str):
    """Type of a column of the statistics file, None for a column that the layer does not use."""
    if name in STATS_INTEGERS:
        return "int"
    if name == "Value" or YEAR_VALUE.fullmatch(name):
        return "double"
    return "string" if name == "Flag" or YEAR_FLAG.fullmatch(name) or name in settings.STATS_ID_COLUMNS else None


def read_stats_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """The statistics file with the columns the layer uses, typed (encoding detected when not given).

    Strict: a row with too few or too many fields fails the read, and so does a cell of a numeric column
    that holds anything but a number or white space."""
    encoding = encoding or detect_encoding(spark, path)
    raw = (spark.read.option("header", True).option("encoding", encoding).option("inferSchema", False)
           .option("mode", "FAILFAST").option("columnPruning", False).csv(path))
    typed = []
    for name in raw.columns:
        kind, col = stats_column(name), F.col(f"`{name}`")
        if kind in ("int", "double"):
            text = F.trim(col)
            number = text.try_cast(kind)
            wrong = F.raise_error(F.concat(F.lit(f"{name}: not a number: "), text)).cast(kind)
            typed.append(F.when(text == "", None).when(text.isNotNull() & number.isNull(), wrong).otherwise(number).alias(name))
        elif kind:
            typed.append(col.alias(name))
    return raw.select(*typed)


# ----------------------------------------------------------------------------- S9
def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob on the cluster file system (metadata listing only). Used for completeness
    markers, whose leading underscore hides them from Spark's data-file listing."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return sorted(str(st.getPath().toString()) for st in (found or []))


def latest_complete_snapshot(spark: SparkSession, base: str, marker: str = "_manifest.json") -> str:
    """Newest ``pulled=<date>`` folder that has its completeness marker (written last by a pull)."""
    pulled = [re.search(r"pulled=([^/]+)/", p) for p in glob_paths(spark, f"{base.rstrip('/')}/pulled=*/{marker}")]
    pulled = sorted(m.group(1) for m in pulled if m)
    if not pulled:
        raise ExtractionError(f"No complete pull under {base}")
    return f"{base.rstrip('/')}/pulled={pulled[-1]}"


def complete_pull(spark: SparkSession, path: str, marker: str = "_manifest.json") -> str:
    """The folder to read for a page source: the path itself if it is a marked pull, else its newest marked
    ``pulled=<date>`` folder. A pull without a marker is refused."""
    if glob_paths(spark, f"{path.rstrip('/')}/{marker}"):
        return path
    return latest_complete_snapshot(spark, path, marker)


def complete_file(spark: SparkSession, path: str, pattern: str = "*.csv", suffix: str = ".meta.json") -> str:
    """The file to read: the path itself, or in a folder (its newest ``pulled=<date>`` folder with a complete file, if
    there are such folders) the last file by name; always only with its ``<file>.meta.json`` beside it, which a
    download writes last."""
    folder = path.rstrip("/")
    marked = next((found for place in (f"{folder}{suffix}", f"{folder}/pulled=*/{pattern}{suffix}", f"{folder}/{pattern}{suffix}")
                   if (found := [p.removesuffix(suffix) for p in glob_paths(spark, place)])), [])
    if not marked:
        raise ExtractionError(f"no complete file at {path} (its {suffix} is missing)")
    return sorted(marked)[-1]


def require_complete_pages(spark: SparkSession, folder: str) -> dict:
    """Stop unless all announced pages and records are there; returns the counts."""
    row = page_completeness(spark, folder).first().asDict()
    if not row["complete"]:
        raise ExtractionError(f"incomplete pull in {folder}: {row}")
    return row


# ----------------------------------------------------------------------------- S12
CHUNK = 8 << 20
MANIFEST = "file string, size_bytes bigint, sha256 string, recorded_at string, source string"


def changed_files(known: DataFrame, found: DataFrame) -> DataFrame:
    """source, file, change: files that differ between two manifests ('changed', 'missing' or 'new')."""
    k = known.select("source", "file", F.col("sha256").alias("was"))
    f = found.select("source", "file", F.col("sha256").alias("now"))
    change = F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "new").when(F.col("was") != F.col("now"), "changed")
    return k.join(f, ["source", "file"], "full").select("source", "file", change.alias("change")).where("change is not null")


def file_manifest(spark: SparkSession, path: str, **info) -> DataFrame:
    """Name, size, SHA-256 and record time of every raw file, plus source facts (url, license, ...). Only
    the file list is a table; a task streams each of its files through the hash in chunks, from the cluster
    file system (Arrow's reader of it, or the local one), so a file of any size needs
    ``CHUNK`` bytes. Empty files are not listed."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")

    def digest(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            sums = []
            for uri in batch.column("path").to_pylist():
                system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
                h = hashlib.sha256()
                with system.open_input_stream(name) as stream:
                    while block := stream.read(CHUNK):
                        h.update(block)
                sums.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(sums, type=pa.string())],
                                             names=["path", "size_bytes", "sha256"])

    out = files.mapInArrow(digest, "path string, size_bytes bigint, sha256 string").select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "size_bytes", "sha256",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("recorded_at"))
    for k, v in info.items():
        out = out.withColumn(k, F.lit(v))
    return out


def pull_manifest(pages: DataFrame, indicator: str) -> dict:
    """The JSON manifest of a page pull (pages, records), built from ``page_completeness``."""
    row = pages.first().asDict()
    return {"indicator": indicator, "pages": row["pages_found"], "records": row["records_received"],
            "complete": row["complete"], "recorded_at": datetime.now(timezone.utc).isoformat(timespec="seconds")}


def write_json_text(spark: SparkSession, data: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(data, ensure_ascii=False, default=str),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)
