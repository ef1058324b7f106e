"""Idempotent publishing (K7-K13, V22) on plain files.

* upsert: incoming rows win on their key, other target rows stay (anti-join + union; a keyed MERGE is
  not available on plain Parquet). Tables with key columns only keep one row per key (DO NOTHING).
* facts end up equal to the incoming batch (upsert, then rows of other batches are removed and
  counted); dimensions are upsert-only and keep old rows.
* every write goes to a new path, so nothing that is being read is overwritten; a publish ends with ONE
  commit record, the file ``<base>/_commits/<number>.json``: the batch id, the path of EVERY table (tables that
  this batch did not load carried forward) and the audit rows. The record of the highest number is current,
  whatever its batch is called, so a partial load, a stream's batch or an old run published again all become
  visible, and a run that fails midway changes nothing.
* compare and set: the record of number n is a finished file renamed to its name without overwriting. Of two
  publishers that read record n - 1 one gets the number; the other rereads, merges again what the winner
  changed, and tries the next number. Nothing of either is lost. The rename is as atomic as the file system's
  (HDFS: atomic; the local one checks, then renames).
* ``remove_unnamed`` clears what crashed or losing publishers left behind.
"""
from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlayer import schemas
from statlayer.errors import PublishError


def new_batch_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def upsert(target: DataFrame | None, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert new keys, replace existing ones; other target rows stay."""
    if target is None:
        return incoming
    others = target.join(incoming.select(*keys).distinct(), keys, "left_anti")
    return incoming.unionByName(others.select(*incoming.columns))


def stale_rows(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a fact table whose key the batch does not bring: they go."""
    return target.join(incoming.select(*keys).distinct(), keys, "left_anti")


def repeated_keys(incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a batch brings more than once."""
    return incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


@dataclass
class TableLoad:
    name: str
    incoming: DataFrame
    keys: list
    kind: str = "fact"          # "fact": equals the batch after the load; "dimension": upsert-only


AUDIT = "audit_id bigint, table_name string, rows_upserted bigint, rows_deleted bigint, loaded_at timestamp"
COMMIT = f"seq bigint, batch_id string, tables map<string,string>, audit array<struct<{AUDIT}>>"
ATTEMPTS = 50               # times that a publisher lets others go first


@dataclass
class Commit:
    """A commit record; number 0 stands for nothing published yet."""
    seq: int = 0
    batch_id: str | None = None
    tables: dict = field(default_factory=dict)          # table -> path under the base
    audit: list = field(default_factory=list)           # the batch's audit rows
    last_audit_id: int = 0


class _Files:
    """Small-file access to the cluster file system of a base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.hadoop, self.conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
        self.io, self.base = spark.sparkContext._jvm.org.apache.commons.io.IOUtils, base.rstrip("/")
        self.options = spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[tuple[str, bool, int]]:
        """(name, is a folder, time of change in ms) of what lies in a folder; nothing if it is not there."""
        path = self.path(folder)
        return [(st.getPath().getName(), st.isDirectory(), st.getModificationTime()) for st in self.fs.listStatus(path)] \
            if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A new file that appears whole under its name; False if the name is taken."""
        folder, _, last = name.rpartition("/")
        unfinished = self.path(f"{folder}/.{last}.{uuid.uuid4().hex}")
        stream = self.fs.create(unfinished, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self.hadoop.FileContext.getFileContext(unfinished.toUri(), self.conf).rename(unfinished, self.path(name), self.options)
            return True
        except Py4JJavaError as e:
            self.fs.delete(unfinished, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _record_name(seq: int) -> str:
    return f"_commits/{seq:012d}.json"


def _commit_names(files: _Files) -> list[str]:
    return sorted(n for n, folder, _ in files.names("_commits") if n.endswith(".json") and not folder and not n.startswith("."))


def commits(spark: SparkSession, base: str) -> DataFrame:
    """All commit records; none before the first publish."""
    if not _commit_names(_Files(spark, base)):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(f"{base}/_commits")


def current_commit(spark: SparkSession, base: str) -> Commit:
    """The record of the highest number: one listing and one small file, no job."""
    files = _Files(spark, base)
    names = _commit_names(files)
    return Commit(**json.loads(files.read(f"_commits/{names[-1]}"))) if names else Commit()


def current_batch(spark: SparkSession, base: str) -> str | None:
    return current_commit(spark, base).batch_id


def read_current(spark: SparkSession, base: str, name: str, commit: Commit | None = None) -> DataFrame | None:
    """The table as of the latest (or the given) commit, with the batch that wrote it; None if it was never loaded."""
    path = (commit or current_commit(spark, base)).tables.get(name)
    if path is None:
        return None
    return spark.read.parquet(f"{base}/{path}").withColumn("batch_id", F.lit(path.rsplit("batch=", 1)[1]))


@dataclass
class _Written:
    """What a publisher wrote for a table, and the path it was merged with."""
    path: str
    counts: tuple
    previous: str | None


def _write(spark: SparkSession, base: str, t: TableLoad, before: Commit, batch_id: str, loaded_at: datetime) -> _Written:
    previous = read_current(spark, base, t.name, before)
    rows = t.incoming.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp")) if t.kind == "fact" else t.incoming
    path = f"{t.name}/{uuid.uuid4().hex}-batch={batch_id}"
    replaces = t.kind == "fact" or previous is None
    (rows if replaces else upsert(previous.drop("batch_id"), rows, t.keys)).write.parquet(f"{base}/{path}")
    written = spark.read.schema(rows.schema).parquet(f"{base}/{path}") if replaces else t.incoming
    per_key = written.groupBy(*t.keys).agg(F.count(F.lit(1)).alias("rows"))
    total, most = per_key.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.max("rows")).first()
    if (most or 0) > 1:
        twice = repeated_keys(written, t.keys).limit(3).collect()
        raise PublishError(f"{t.name}: the batch repeats keys, such as {[tuple(r)[:-1] for r in twice]}")
    deleted = stale_rows(previous, written, t.keys).count() if t.kind == "fact" and previous is not None else 0
    return _Written(path, (total, deleted), before.tables.get(t.name))


def load_warehouse(spark: SparkSession, base: str, tables: list[TableLoad], batch_id: str | None = None,
                   loaded_at: datetime | None = None) -> dict:
    """Publish the tables as one batch; returns {table: (rows_upserted, rows_deleted)}. A batch that
    repeats a key is refused before anything is committed."""
    batch_id = batch_id or new_batch_id()
    loaded_at = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    files, done = _Files(spark, base), {}
    for _ in range(ATTEMPTS):
        before = current_commit(spark, base)
        for t in tables:
            # of a lost attempt only what another publisher changed meanwhile is merged again
            if t.name not in done or done[t.name].previous != before.tables.get(t.name):
                done[t.name] = _write(spark, base, t, before, batch_id, loaded_at)
        # audit ids go on from the record before (a serial id)
        audit = [{"audit_id": before.last_audit_id + i + 1, "table_name": name, "rows_upserted": int(w.counts[0]), "rows_deleted": int(w.counts[1]),
                  "loaded_at": loaded_at.isoformat(timespec="microseconds")} for i, (name, w) in enumerate(done.items())]
        record = {"seq": before.seq + 1, "batch_id": batch_id, "tables": before.tables | {n: w.path for n, w in done.items()}, "audit": audit,
                  "last_audit_id": before.last_audit_id + len(audit)}
        if files.create(_record_name(before.seq + 1), json.dumps(record)):
            return {name: w.counts for name, w in done.items()}
    raise PublishError(f"batch {batch_id}: other publishers came first {ATTEMPTS} times")


def remove_unnamed(spark: SparkSession, base: str, keep: int = 10, least_age_s: float = 86_400) -> list[str]:
    """Delete table paths that none of the last ``keep`` commits names, and unfinished records, both unchanged for
    ``least_age_s`` seconds (a publisher may still be at work on younger ones). Returns what was deleted."""
    files = _Files(spark, base)
    named = {p for n in _commit_names(files)[-keep:] for p in json.loads(files.read(f"_commits/{n}"))["tables"].values()}
    before = (time.time() - least_age_s) * 1000
    gone = [f"_commits/{n}" for n, folder, changed in files.names("_commits") if n.startswith(".") and not n.endswith(".crc") and changed <= before]
    for table, folder, _ in files.names(""):
        if folder and not table.startswith(("_", ".")):
            gone += [f"{table}/{n}" for n, _, changed in files.names(table) if "-batch=" in n and f"{table}/{n}" not in named and changed <= before]
    for name in gone:
        files.delete(name)
    return sorted(gone)


def read_audit(spark: SparkSession, base: str) -> DataFrame:
    """Audit rows of all commits (a failed run has none); of a table that a batch published again, the last row."""
    rows = commits(spark, base).select("seq", "batch_id", F.inline("audit"))
    last = rows.groupBy("batch_id", "table_name").agg(F.max_by(F.struct("audit_id", "rows_upserted", "rows_deleted", "loaded_at"), "seq").alias("last"))
    return last.select("batch_id", "table_name", "last.*").select(*schemas.LOAD_AUDIT.fieldNames())


def check_published(spark: SparkSession, base: str, expected: dict[str, DataFrame]) -> DataFrame:
    """What is published equals the incoming rows: (table_name, published, expected, same_content), by number of
    rows and by content. Load stamps are no content."""
    out = None
    for name, df in expected.items():
        pub = content_digest(read_current(spark, base, name).select(*df.columns)).select(F.lit(name).alias("table_name"), F.struct("*").alias("p"))
        own = content_digest(df).select(F.lit(name).alias("table_name"), F.struct("*").alias("e"))
        row = pub.join(own, "table_name").select("table_name", F.col("p.rows").alias("published"), F.col("e.rows").alias("expected"),
                                                 (F.col("p") == F.col("e")).alias("same_content"))
        out = row if out is None else out.unionByName(row)
    return out


def content_digest(df: DataFrame) -> DataFrame:
    """One row (rows, sum_a, sum_b): number of rows and sums of two 64-bit hashes of whole rows. Equal for equal rows in
    any order and partitioning; nulls and the place of a value count. One partial aggregation, no shuffle of rows."""
    cells = [c for name in sorted(df.columns) for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    sums = [F.coalesce(F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias(n) for seed, n in ((1, "sum_a"), (2, "sum_b"))]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums)


# Logical names used by the published query texts -> published table names.
QUERY_NAMES = {"country_year": "agri_country_year", "by_activity": "fact_emissions_by_activity",
               "comparison": "edgar_vs_faostat"}


def register_tables(spark: SparkSession, base: str, database: str = "warehouse") -> list[str]:
    """K12 + the analyst path: catalog tables over the current committed batch.

    ``CREATE TABLE IF NOT EXISTS ... USING parquet`` once per table, then ``ALTER TABLE ... SET LOCATION``
    to the path of the current commit (a metastore switch). The commit records are a table too, and the audit
    view reads them, so it needs no list of batches; views with the logical names of the published query texts
    let those texts run unchanged."""
    commit = current_commit(spark, base)
    names = sorted(commit.tables)
    if not names:
        return []
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        location = f"{base}/{commit.tables[name]}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} USING parquet LOCATION '{location}'")
        spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(f"{database}.{name}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.load_commits ({COMMIT}) USING json LOCATION '{base}/_commits'")
    spark.catalog.refreshTable(f"{database}.load_commits")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.load_audit AS "
              f"SELECT last.audit_id, batch_id, table_name, last.rows_upserted, last.rows_deleted, last.loaded_at "
              f"FROM (SELECT batch_id, load.table_name, max_by(load, seq) AS last "
              f"FROM {database}.load_commits LATERAL VIEW explode(audit) loads AS load GROUP BY batch_id, load.table_name)")
    for logical, physical in QUERY_NAMES.items():
        if physical in names:
            spark.sql(f"CREATE OR REPLACE VIEW {database}.{logical} AS SELECT * FROM {database}.{physical}")
    return names
