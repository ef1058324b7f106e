"""The layered run (E1-E5, D11, D12): stage -> validate -> curate -> validate -> publish -> check -> formats.

One driver function over one SparkSession; each step is a lazy DataFrame chain ended by a layer write,
a check suite (an error-severity failure raises and stops everything downstream) or the publish.
Every run writes its layers under its own run folder, so a rerun never overwrites a path it reads.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlayer import schemas
from statlayer.errors import DataQualityError, ExtractionError
from statlayer.operators import conform
from statlayer.plans import products as P
from statlayer.profile.files import compare_formats, provenance
from statlayer.publish.warehouse import (
    TableLoad, check_published, current_commit, load_warehouse, new_batch_id, read_current, register_tables,
)
from statlayer.quality import rules
from statlayer.quality.checks import run_checks
from statlayer.quality.dropped import Dropped, report as dropped_rows
from statlayer.quality.drift import schema_drift
from statlayer.session import stored_table
from statlayer.settings import POPULATION_INDICATOR, Settings
from statlayer.sources import files as src


@dataclass
class RunPaths:
    base: str
    run_id: str = field(default_factory=new_batch_id)

    def staging(self, name: str) -> str:
        return f"{self.base}/staging/{name}/run={self.run_id}"

    def curated(self, name: str) -> str:
        return f"{self.base}/curated/run={self.run_id}/{name}"

    def report(self, name: str) -> str:
        return f"{self.base}/reports/run={self.run_id}/{name}"

    @property
    def warehouse(self) -> str:
        return f"{self.base}/warehouse"


def read_staged(spark: SparkSession, paths: RunPaths, name: str) -> DataFrame:
    """A staged table with its declared schema: no file is opened to infer one."""
    return spark.read.schema(schemas.STAGED[name]).parquet(paths.staging(name))


def read_curated(spark: SparkSession, paths: RunPaths, name: str) -> DataFrame:
    """A curated table with its declared schema."""
    return spark.read.schema(schemas.CURATED[name]).parquet(paths.curated(name))


def require_declared(spark: SparkSession, table: str, path: str, declared, partitions: tuple = ()) -> None:
    """Stop if the files of a table hold anything but its declared columns."""
    drift = schema_drift(spark, table, path, declared, partitions).orderBy("column", "found").limit(20).collect()
    if drift:
        raise DataQualityError("\n".join([f"{table}: files differ from the declared schema"] + [
            f"  {r['column']}: declared {r.declared or 'not at all'}, {r.files} file(s) hold {r.found or 'no such column'}" for r in drift]))


# -------------------------------------------------------------------------- raw files
def record_raw_files(spark: SparkSession, raw: RawInputs, paths: RunPaths) -> DataFrame:
    """The manifest of the run's raw files (name, size, SHA-256), written before anything is read from them. A
    run that goes on later verifies it instead: a file that changed, vanished or came in between stops the run."""
    found = None
    for source, path in (("matrix", raw.matrix), ("population", raw.pages), ("stats", raw.stats)):
        files = src.file_manifest(spark, path, source=source)
        found = files if found is None else found.unionByName(files)
    where = paths.report("raw_files")
    if src.glob_paths(spark, f"{where}/_SUCCESS"):
        known = spark.read.schema(src.MANIFEST).parquet(where)
        changed = src.changed_files(known, found).orderBy("source", "file").limit(20).collect()
        if changed:
            raise ExtractionError("raw files changed since the run began: " + ", ".join(f"{r.source}/{r.file} ({r.change})" for r in changed))
        return known
    found.coalesce(1).write.parquet(where)
    known = spark.read.schema(src.MANIFEST).parquet(where)
    provenance(known).coalesce(1).write.mode("overwrite").option("header", True).csv(paths.report("provenance"))
    src.write_json_text(spark, src.pull_manifest(src.page_completeness(spark, raw.pages), POPULATION_INDICATOR), paths.report("pull_manifest"))
    return known


# -------------------------------------------------------------------------- D11 stage
def stage_matrix(spark: SparkSession, raw_path: str, paths: RunPaths, cfg: Settings = Settings(),
                 fmt: str = "csv") -> str:
    lost = Dropped("matrix")
    # written once before it is ordered: the range partitioning samples what it partitions, and a sample of the raw
    # file would read and reshape the whole file a second time (and count what is dropped twice)
    tidy = stored_table(P.tidy_matrix(src.read_matrix(spark, raw_path, fmt), cfg.edition, cfg, dropped=lost), "matrix")
    out = paths.staging("matrix")
    # one folder per sector. Range partitioning on (sector, country, gas, year) spreads every sector over
    # many tasks (a sector holding a third of the rows is never written by one task) and leaves each file
    # sorted, so row-group statistics prune by country and year.
    keys = ["sector_key", "country_code", "gas", "year"]
    tidy.repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .write.mode("overwrite").partitionBy("sector_key").parquet(out)
    report_dropped(spark, paths, lost)
    return out


def stage_population(spark: SparkSession, pages_folder: str, paths: RunPaths) -> str:
    src.require_complete_pages(spark, pages_folder)
    known, lost = conform.known_codes(spark, conform.iso_table(spark, Settings().iso_table)), Dropped("population")
    tidy = P.tidy_population(src.read_pages(spark, pages_folder), known, lost)
    out = paths.staging("population")
    tidy.write.mode("overwrite").parquet(out)
    report_dropped(spark, paths, lost)
    return out


def stage_stats(spark: SparkSession, csv_path: str, paths: RunPaths) -> str:
    lost = Dropped("stats")
    tidy = P.tidy_stats(src.read_stats_csv(spark, csv_path), conform.iso_table(spark, Settings().iso_table), dropped=lost)
    out = paths.staging("stats")
    tidy.write.mode("overwrite").parquet(out)
    report_dropped(spark, paths, lost)
    return out


def report_dropped(spark: SparkSession, paths: RunPaths, lost: Dropped) -> None:
    """The step's counts of dropped rows as a report (a row a condition)."""
    dropped_rows(spark, lost).coalesce(1).write.mode("overwrite").option("header", True).csv(paths.report(f"dropped_{lost.step}"))


# ------------------------------------------------------------------------- D12 curate
def curate(spark: SparkSession, paths: RunPaths, cfg: Settings = Settings()) -> dict:
    """Matrix + population -> dim_country, by-gas facts, population, country-year product."""
    staged = read_staged(spark, paths, "matrix").where(
        F.col("sector_key") == cfg.focus_sector.lower().replace(" ", "_"))        # partition pruning (S5)
    by_gas = P.build_by_gas(staged, cfg.focus_gases)
    edition = staged.select(F.max("edgar_edition")).first()[0]
    mapping = conform.country_mapping(spark, path=cfg.country_mapping)
    dim_country = P.build_dim_country(staged.where((F.col("country_type") == "country")
                                                   & F.col("gas").isin(list(cfg.focus_gases))), mapping)
    lost = Dropped("curate")
    population = P.population_for_countries(read_staged(spark, paths, "population"), dim_country, lost)
    tables = {"dim_country": dim_country, "agri_emissions_by_gas": by_gas, "population": population}
    out = {}
    for name, df in tables.items():
        out[name] = paths.curated(name)
        df.write.mode("overwrite").parquet(out[name])
    report_dropped(spark, paths, lost)
    cy = P.build_country_year(read_curated(spark, paths, "agri_emissions_by_gas"), read_curated(spark, paths, "population"), edition)
    out["agri_country_year"] = paths.curated("agri_country_year")
    cy.write.mode("overwrite").parquet(out["agri_country_year"])
    return out


def curate_stats(spark: SparkSession, paths: RunPaths, cfg: Settings = Settings()) -> dict:
    """Statistics -> dim_activity, by-activity facts (+ unmatched / rejected reports), comparison."""
    scope = P.stats_scope(read_staged(spark, paths, "stats"), cfg)
    dim_country = read_curated(spark, paths, "dim_country")
    dim_activity = P.build_dim_activity(spark)
    table, unmatched, rejected = P.build_by_activity(scope, dim_country, dim_activity, conform.area_mapping(spark, path=cfg.area_mapping),
                                                     conform.country_mapping(spark, path=cfg.country_mapping), materialize=True)
    out = {"dim_activity": paths.curated("dim_activity"), "agri_emissions_by_activity":
           paths.curated("agri_emissions_by_activity")}
    dim_activity.write.mode("overwrite").parquet(out["dim_activity"])
    table.write.mode("overwrite").parquet(out["agri_emissions_by_activity"])
    # unmatched areas: one row per area (bounded) -> one file; rejected rows grow with the data -> parallel
    unmatched.write.mode("overwrite").option("header", True).csv(paths.report("unmatched_areas"))
    rejected.write.mode("overwrite").option("header", True).csv(paths.report("rejected_rows"))
    cmp = P.build_comparison(read_curated(spark, paths, "agri_emissions_by_activity"), read_curated(spark, paths, "agri_country_year"))
    out["edgar_vs_faostat"] = paths.curated("edgar_vs_faostat")
    cmp.write.mode("overwrite").parquet(out["edgar_vs_faostat"])
    return out


# ------------------------------------------------------------------------ E2 gates
def validate(spark: SparkSession, paths: RunPaths, step: str, cfg: Settings = Settings(),
             today_year: int | None = None) -> dict:
    staged, curated = lambda n: read_staged(spark, paths, n), lambda n: read_curated(spark, paths, n)
    checked = {"curated": ["dim_country", "agri_emissions_by_gas", "population", "agri_country_year"],
               "curated_stats": ["dim_activity", "agri_emissions_by_activity", "edgar_vs_faostat"]}
    for name in checked.get(step, []):
        require_declared(spark, name, paths.curated(name), schemas.CURATED[name])
    if step in schemas.STAGED:
        require_declared(spark, step, paths.staging(step), schemas.STAGED[step], ("sector_key",) if step == "matrix" else ())
    if step == "curated":
        res = rules.judge({"country_year": curated("agri_country_year"), "by_gas": curated("agri_emissions_by_gas")}, cfg,
                          dim_country=curated("dim_country"))
    elif step == "curated_stats":
        res = rules.judge({"by_activity": curated("agri_emissions_by_activity"), "comparison": curated("edgar_vs_faostat")}, cfg,
                          dim_country=curated("dim_country"), scope=P.stats_scope(staged("stats"), cfg))
    else:
        res = rules.judge({step: staged(step)}, cfg, today_year)
    return run_checks(step, res, report_path=paths.report(f"validation_{step}"))


# ------------------------------------------------------------------------- load
def load(spark: SparkSession, paths: RunPaths, database: str = "warehouse") -> dict:
    read = lambda n: read_curated(spark, paths, n)
    tables = [
        TableLoad("dim_gas", P.build_dim_gas(spark), ["gas_code"], "dimension"),
        TableLoad("dim_country", read("dim_country"), ["country_code"], "dimension"),
        TableLoad("dim_activity", read("dim_activity"), ["activity_code"], "dimension"),
        TableLoad("fact_emissions", read("agri_emissions_by_gas").withColumnRenamed("gas", "gas_code"),
                  ["country_code", "gas_code", "year"]),
        TableLoad("fact_population", read("population"), ["country_code", "year"]),
        TableLoad("agri_country_year", read("agri_country_year"), ["country_code", "year"]),
        TableLoad("fact_emissions_by_activity", read("agri_emissions_by_activity").drop("activity", "activity_group"),
                  ["country_code", "activity_code", "year"]),
        TableLoad("edgar_vs_faostat", read("edgar_vs_faostat"), ["country_code", "year"]),
    ]
    counts = load_warehouse(spark, paths.warehouse, tables, batch_id=paths.run_id)
    register_tables(spark, paths.warehouse, database)      # catalog tables switch to the new batch
    return counts


def check_warehouse(spark: SparkSession, paths: RunPaths) -> dict:
    """Published counts = curated file counts, latest-year total equal, no orphans."""
    from statlayer.quality import messages as M
    from statlayer.quality.checks import evaluate, expect_true
    files = {"fact_emissions": "agri_emissions_by_gas", "fact_population": "population",
             "agri_country_year": "agri_country_year", "fact_emissions_by_activity": "agri_emissions_by_activity",
             "edgar_vs_faostat": "edgar_vs_faostat"}
    as_published = {t: schemas.TABLES[t].fieldNames() for t in files}
    curated = {t: read_curated(spark, paths, f).withColumnsRenamed({"gas": "gas_code"} if t == "fact_emissions" else {})
               for t, f in files.items()}
    counts = check_published(spark, paths.warehouse, {t: df.select(*[c for c in as_published[t] if c != "loaded_at"]) for t, df in curated.items()}).collect()
    checks = [expect_true(M.text(M.PUBLISHED_COUNT, table=r.table_name), F.lit(r.published == r.expected),
                          F.lit(M.text(M.PUBLISHED_COUNT_DETAILS, published=f"{r.published:,}",
                                       expected=f"{r.expected:,}"))) for r in counts]
    checks += [expect_true(M.text(M.PUBLISHED_CONTENT, table=r.table_name), F.lit(r.same_content), F.lit(M.PUBLISHED_CONTENT_DETAILS))
               for r in counts]
    for name, path in current_commit(spark, paths.warehouse).tables.items():
        require_declared(spark, name, f"{paths.warehouse}/{path}", schemas.TABLES[name])
    facts = read_current(spark, paths.warehouse, "fact_emissions")
    by_gas = read_curated(spark, paths, "agri_emissions_by_gas")
    latest = read_curated(spark, paths, "agri_country_year").select(F.max("year")).scalar()
    db = facts.where(F.col("year") == latest).select(F.sum("emissions_mt_co2eq")).scalar()
    fl = by_gas.where(F.col("year") == latest).select(F.sum("emissions_mt_co2eq")).scalar()
    checks.append(expect_true(M.PUBLISHED_TOTAL, F.abs(db - fl) < F.lit(1e-6) * F.greatest(fl, F.lit(1.0)),
                              M.fill(M.PUBLISHED_TOTAL_DETAILS, published=F.format_number(db, 3),
                                     expected=F.format_number(fl, 3))))
    dim = read_current(spark, paths.warehouse, "dim_country")
    orphans = facts.join(dim, "country_code", "left_anti").select(F.count(F.lit(1))).scalar()
    checks.append(expect_true(M.ORPHANS, orphans == 0, M.fill(M.ORPHANS_DETAILS, n=orphans)))
    results = evaluate(spark.range(1), checks).unionByName(contract_checks(spark, paths.warehouse))
    return run_checks("warehouse", results, report_path=paths.report("validation_warehouse"))


def contract_checks(spark: SparkSession, warehouse: str) -> DataFrame:
    """V16 on the published tables: every PK / NOT NULL / FK / CHECK constraint as a check row."""
    from statlayer.quality.contracts import constraint_violations
    from statlayer.schemas import CONTRACTS
    tables = {name: read_current(spark, warehouse, name) for name in CONTRACTS}
    out = None
    for name, contract in CONTRACTS.items():
        v = constraint_violations(tables[name], contract, tables).select(
            F.concat(F.lit(f"constraint {name}: "), F.col("constraint")).alias("check"),
            (F.col("violations") == 0).alias("passed"),
            F.concat(F.col("violations").cast("string"), F.lit(" violating rows")).alias("details"),
            F.lit("error").alias("severity"))
        out = v if out is None else out.unionByName(v)
    return out


def formats(spark: SparkSession, paths: RunPaths) -> DataFrame:
    out = compare_formats(read_curated(spark, paths, "agri_country_year"), paths.report("exports"))
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(paths.report("format_comparison"))
    return out


# ------------------------------------------------------------------------- E1
def _concurrently(tasks: list) -> list:
    """Run independent Spark actions from driver threads (Spark schedules their jobs side by side);
    the first failure is raised after all have finished."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
    return [f.result() for f in futures]


@dataclass
class RawInputs:
    matrix: str
    pages: str
    stats: str
    matrix_format: str = "csv"


STEPS = ["stage", "validate_staging", "curate", "validate_curated", "load", "check", "formats"]


def run(spark: SparkSession, raw: RawInputs, base: str, steps: list[str] | None = None, cfg: Settings = Settings(),
        run_id: str | None = None, today_year: int | None = None) -> RunPaths:
    """Run the steps in order (all by default, or the listed ones on an earlier run's folders)."""
    paths = RunPaths(base, run_id or new_batch_id())
    todo = steps or STEPS
    if "stage" in todo or src.glob_paths(spark, f"{paths.report('raw_files')}/_SUCCESS"):
        record_raw_files(spark, raw, paths)
    if "stage" in todo:          # E3: three independent source branches, submitted as concurrent jobs
        _concurrently([lambda: stage_matrix(spark, raw.matrix, paths, cfg, raw.matrix_format),
                       lambda: stage_population(spark, raw.pages, paths),
                       lambda: stage_stats(spark, raw.stats, paths)])
    if "validate_staging" in todo:
        _concurrently([lambda step=step: validate(spark, paths, step, cfg, today_year)
                       for step in ("matrix", "population", "stats")])
    if "curate" in todo:
        curate(spark, paths, cfg)
        curate_stats(spark, paths, cfg)
    if "validate_curated" in todo:
        validate(spark, paths, "curated", cfg)
        validate(spark, paths, "curated_stats", cfg)
    if "load" in todo:
        load(spark, paths)
    if "check" in todo:
        check_warehouse(spark, paths)
    if "formats" in todo:
        formats(spark, paths)
    return paths

