"""End-to-end batch job: ingest → load → transform, as chained Spark jobs.

1. **ingest** — the acquired responses (here derived from the test tables)
   are landed as response documents, parsed back (``read_api_responses``),
   written as timestamped CSV snapshots, which are counted and profiled as they
   are written, and recorded in a run manifest; broken documents go to a
   reject table;
2. **load** — the snapshot that the newest manifest names is read for each
   dataset with an explicit schema, stamped ``loaded_at`` and full-refreshed into
   the raw tables of the catalog, unless its rows are not those of the manifest;
   row counts, schema and the check suite are written beside them;
3. **transform** — staging views, both marts as replaced tables, sorted CSV
   exports and the previews, all in their namespaces of the catalog.

Every intermediate lives in the shared folder under ``root``; each step
reads what the previous step wrote, so a lost executor replays one step.  Finished
steps are in a ledger under ``root``: a job run again goes on where it failed.
A dataset, mart, export or report that fails is tried again, then left as a row of
the outcomes, with those that need it; the others go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from ..operators.quality import Profiled, check_suite, describe, reason, run_checks, table_row_counts
from ..session import fresh_dir, run_concurrently
from ..sinks import catalog
from ..sinks.landing import (as_recorded, export_csv, land_api_responses, land_csv, load_full_refresh,
                             newest_recorded, snapshot_path, write_known_manifest)
from ..sources.households import (COUNT_COLUMNS, DEFAULT_INGESTED_AT, DEFAULT_LOADED_AT,
                                  LEVEL_COUNTY, LEVEL_STATE, raw_county, raw_state, written_counts)
from ..sources.landing import (empty_files, latest_snapshot, read_api_responses, read_landed_csv,
                               read_open_csv, read_rejects)
from ..sources.tables import row_count, table_path
from . import analytics, models
from .ledger import Ledger

DEFAULT_RUN_ID = "20240101_000000"

# ── fixed values: dataset names and manifest sources ──────────────────────────
STATE_DATASET = "census_state"
COUNTY_DATASET = "census_county"
STATE_SOURCE = "Census ACS 5-Year 2022 - State Level"
COUNTY_SOURCE = "Census ACS 5-Year 2022 - County Level"
# export file per mart
EXPORT_FILES = {"mart_state_broadband_summary": "state_broadband_summary.csv",
                "mart_underserved_counties": "underserved_counties.csv"}
OPEN_DATASET = "fcc_477"
OPEN_SOURCE = "FCC Form 477 Open Data Portal"


def landed_schema(geo_keys: list[str]) -> T.StructType:
    fields = [T.StructField(c, T.DoubleType()) for c in COUNT_COLUMNS]
    fields += [T.StructField("geography_name", T.StringType())]
    fields += [T.StructField(k, T.StringType()) for k in geo_keys]
    fields += [T.StructField(c, T.StringType())
               for c in ("data_source", "geography_level", "ingested_at")]
    fields += [T.StructField("broadband_penetration_pct", T.DoubleType())]
    return T.StructType(fields)


STATE_KEYS = ["state"]
COUNTY_KEYS = ["state", "county"]


# retries and seconds between them, by kind of step
RETRIES = {"ingest": (2, 30.0), "load": (1, 10.0), "transform": (1, 10.0)}
MART_STATE, MART_COUNTY = EXPORT_FILES


@dataclass
class BatchRun:
    spark: SparkSession
    root: str
    run_id: str
    namespaces: tuple[str, str, str] = ("raw", "staging", "marts")
    retries: dict[str, tuple[int, float]] = field(default_factory=lambda: dict(RETRIES))
    raw_tables: dict[str, str] = field(default_factory=dict)
    raw_rows: dict[str, int] = field(default_factory=dict)
    mart_tables: dict[str, str] = field(default_factory=dict)
    export_paths: dict[str, str] = field(default_factory=dict)
    check_paths: dict[str, str] = field(default_factory=dict)
    preview_paths: dict[str, str] = field(default_factory=dict)
    reject_paths: dict[str, str] = field(default_factory=dict)
    manifest_path: str = ""
    told: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __post_init__(self):
        self.ledger = Ledger(self.spark, f"{self.root}/ledger_{self.run_id}")

    def raw(self, name: str) -> DataFrame:
        return self.spark.table(self.raw_tables[name])

    def mart(self, name: str) -> DataFrame:
        return self.spark.table(self.mart_tables[name])

    def step(self, name: str, do: Callable[[], dict[str, Any]], inputs: dict[str, Any] | None = None, outputs: Iterable[str] = (),
             after: Iterable[dict[str, Any] | None] = (), kind: str = "transform") -> dict[str, Any] | None:
        """The result of a step of the job, None if it failed or needs one that did; either way it is told in the outcomes."""
        after = list(after)
        if any(a is None for a in after):
            self.told[name] = "not run", "a step before it failed"
            return None
        retries, delay = self.retries[kind]
        try:
            result = self.ledger.run(name, do, inputs or {}, outputs, after, retries, delay)
        except Exception as e:  # noqa: BLE001 - the others go on
            self.told[name] = "failed", reason(e)
            return None
        self.told[name] = ("done" if name in self.ledger.ran else "kept"), ""
        return result

    @property
    def failed(self) -> list[str]:
        return sorted(name for name, (status, _) in self.told.items() if status in ("failed", "not run"))

    def outcomes(self) -> DataFrame:
        """(step, status, detail): done, kept (from an earlier run), absent, failed or not run."""
        return self.spark.createDataFrame([(n, *self.told[n]) for n in sorted(self.told)], "step string, status string, detail string")


def fingerprint(spark: SparkSession, sf_dir: str, *tables: str) -> list[str]:
    """Names, sizes and times of the files of input tables."""
    paths = [table_path(sf_dir, t) for t in tables]
    return [f"{e.path} {e.size} {e.modified}" for p in paths for e in (files.entries(spark, p) or [])]


def _land(run: BatchRun, df: DataFrame, schema: T.StructType, name: str, source: str) -> dict[str, Any]:
    """Writes a snapshot; its rows and nulls are counted while it is written."""
    profiled = Profiled(df)
    snapshot = land_csv(profiled.rows, f"{run.root}/landing", name, run.run_id)
    path = f"{run.root}/quality/{name}_{run.run_id}"
    profiled.profile().coalesce(1).write.mode("overwrite").parquet(path)
    return {"name": name, "source": source, "rows": profiled.n_rows, "columns": df.columns, "file": snapshot}


def land_responses(run: BatchRun, responses: str, name: str, level: str, keys: list[str], source: str,
                   ingested_at: str = DEFAULT_INGESTED_AT, whole_files: bool = False) -> dict[str, Any]:
    """Parses response documents into a dataset's snapshot.  Broken ones are counted by the job that writes the snapshot;
    if there are any, a second one names them in the run's reject table of the dataset."""
    rejected = Observation()
    parsed = read_api_responses(run.spark, responses, level, keys, ingested_at, whole_files=whole_files, rejected=rejected)
    record = _land(run, parsed, landed_schema(keys), name, source)
    n = int(rejected.get.get("documents", 0)) + (len(empty_files(run.spark, responses)) if whole_files else 0)
    path = f"{run.root}/rejects/{name}_{run.run_id}"
    if n:
        read_rejects(run.spark, responses, whole_files).write.mode("overwrite").parquet(path)
    return {**record, "rejects": path if n else None}


def ingest_steps(run: BatchRun, sf_dir: str, ingested_at: str = DEFAULT_INGESTED_AT,
                 open_data_path: str | None = None) -> dict[str, dict[str, Any]]:
    """Land responses, parse, snapshot as CSV, write the manifest; the manifest's entries by dataset.

    ``open_data_path`` names the optional open-data CSV download; when it is
    absent or cannot be read the run continues without it (it is landed and
    recorded, never loaded into the raw tables).
    """
    spark, root, run_id = run.spark, run.root, run.run_id
    counts_path = f"{root}/acquired/customer_counts"

    def acquire() -> dict[str, Any]:
        return {"rows": written_counts(spark, sf_dir, counts_path).count()}   # from the written files' footers

    source = {"tables": fingerprint(spark, sf_dir, "lineitem", "orders", "customer", "nation"), "at": ingested_at, "run": run_id}
    counts = run.step("acquire", acquire, source, [counts_path], kind="ingest")

    def land(name, level, keys, label, derive, bound):
        responses = f"{root}/responses/{name}_{run_id}"
        made = run.step(f"responses {name}", lambda: {"path": land_api_responses(
            derive(spark.read.parquet(counts_path), ingested_at=ingested_at), responses, keys, n_rows=bound())},
            {}, [responses], [counts], kind="ingest")
        return run.step(f"land {name}", lambda: land_responses(run, responses, name, level, keys, label, ingested_at), {"at": ingested_at},
                        [snapshot_path(f"{root}/landing", name, run_id), f"{root}/quality/{name}_{run_id}"], [made], kind="ingest")

    def land_open_data():
        step = f"land {OPEN_DATASET}"
        found = files.matching(spark, open_data_path) if open_data_path else []
        if not found:
            run.told[step] = "absent", str(open_data_path or "")
            return None

        def do() -> dict[str, Any]:
            df = read_open_csv(spark, open_data_path, ingested_at)
            return _land(run, df, df.schema, OPEN_DATASET, OPEN_SOURCE)

        return run.step(step, do, {"at": ingested_at, "files": [f"{e.path} {e.size} {e.modified}" for e in found]},
                        [snapshot_path(f"{root}/landing", OPEN_DATASET, run_id), f"{root}/quality/{OPEN_DATASET}_{run_id}"], kind="ingest")

    # document sizing bounds: regions ≤ nations, one sub-region per customer row
    done = run_concurrently(
        lambda: land(STATE_DATASET, LEVEL_STATE, STATE_KEYS, STATE_SOURCE, raw_state, lambda: row_count(spark, sf_dir, "nation")),
        lambda: land(COUNTY_DATASET, LEVEL_COUNTY, COUNTY_KEYS, COUNTY_SOURCE, raw_county, lambda: counts["rows"]),
        land_open_data)
    landed = {d["name"]: d for d in done if d is not None}
    run.reject_paths = {name: d["rejects"] for name, d in landed.items() if d.get("rejects")}
    if not landed:
        return {}
    path = f"{root}/landing/manifest_{run_id}.json"
    fields = ("name", "source", "rows", "columns", "file")
    manifest = run.step("manifest", lambda: {"path": write_known_manifest(
        spark, f"{root}/landing", run_id, [tuple(d[f] for f in fields) for d in landed.values()])},
        {}, [path], landed.values(), kind="ingest")
    run.manifest_path = manifest["path"] if manifest else ""
    return landed if manifest else {}


def ingest(spark: SparkSession, sf_dir: str, root: str, run_id: str = DEFAULT_RUN_ID,
           ingested_at: str = DEFAULT_INGESTED_AT,
           open_data_path: str | None = None) -> tuple[dict[str, str], str]:
    """The ingest alone: snapshot by dataset, and the manifest's path."""
    run = BatchRun(spark, root, run_id)
    landed = ingest_steps(run, sf_dir, ingested_at, open_data_path)
    return {name: d["file"] for name, d in landed.items()}, run.manifest_path


def load_dataset(run: BatchRun, name: str, keys: list[str], loaded_at: str = DEFAULT_LOADED_AT) -> dict[str, Any]:
    """Full refresh of one raw table from the snapshot that the newest manifest names; its rows must be those of the manifest.

    Without any manifest it is the newest complete snapshot by name.
    """
    spark, ns = run.spark, run.namespaces[0]
    table, path, landing = f"{ns}.{name}", f"{run.root}/{ns}.db/{name}", f"{run.root}/landing"
    recorded = newest_recorded(spark, landing, name)
    snapshot = recorded[0] if recorded else latest_snapshot(spark, landing, name)
    if snapshot is None:
        raise FileNotFoundError(f"no snapshot of {name} in {landing}")
    counted = {}

    def accept(rows: int) -> None:
        if recorded:
            as_recorded(name, snapshot, recorded[1])(rows)
        counted["rows"] = rows

    load_full_refresh(read_landed_csv(spark, snapshot, landed_schema(keys)), table, path, loaded_at, accept)
    version = catalog.current_version(spark, table)
    return {"table": table, "rows": counted["rows"], "version": version, "made": [version]}


def load(run: BatchRun, loaded_at: str = DEFAULT_LOADED_AT, landed: dict[str, dict[str, Any]] | None = None) -> dict[str, dict[str, Any]]:
    """Full-refresh the raw tables; the finished steps by dataset.  One that fails leaves its table as it was."""
    spark, ns = run.spark, run.namespaces[0]
    catalog.create_namespace(spark, ns, f"{run.root}/{ns}.db")

    def load_one(name, keys):
        after = [(landed or {}).get(name)] if landed is not None else []
        done = run.step(f"load {name}", lambda: load_dataset(run, name, keys, loaded_at), {"at": loaded_at}, (), after, kind="load")
        if done:
            catalog.name_version(spark, done["table"], done["version"])   # a catalog of a later session may not know it
        return done

    done = run_concurrently(lambda: load_one(STATE_DATASET, STATE_KEYS), lambda: load_one(COUNTY_DATASET, COUNTY_KEYS))
    loaded = {name: d for name, d in zip((STATE_DATASET, COUNTY_DATASET), done) if d}
    run.raw_tables = {name: d["table"] for name, d in loaded.items()}
    run.raw_rows = {name: d["rows"] for name, d in loaded.items()}
    return loaded


def post_load_checks(run: BatchRun) -> dict[str, DataFrame]:
    """Row counts (those of the load, if it was this run's), schema and check suite of the raw tables."""
    tables = {n: run.raw(n) for n in run.raw_tables}
    counted = [(n, run.raw_rows[n]) for n in tables if n in run.raw_rows]
    return {
        "row_counts": run.spark.createDataFrame(counted, "table_name string, row_count long")
        if len(counted) == len(tables) else table_row_counts(tables),
        "schema": describe(run.spark, tables),
        "checks": check_suite(_raw_or_none(run, STATE_DATASET), _raw_or_none(run, COUNTY_DATASET)),
    }


def _raw_or_none(run: BatchRun, name: str) -> DataFrame:
    """A raw table, or in its place rows that cannot be had, so that each of its checks fails."""
    if name in run.raw_tables:
        return run.raw(name)
    return run.spark.range(1).where(F.raise_error(F.lit(f"{name} is not loaded")).cast("boolean"))


def _report_step(run: BatchRun, folder: str, name: str, write: Callable[[str], Any], after: Iterable[dict[str, Any] | None]) -> None:
    """A small result table of the run, under its name."""
    path = f"{run.root}/{folder}/{name}_{run.run_id}"

    def do() -> dict[str, Any]:
        write(path)
        return {"path": path}

    done = run.step(f"{folder} {name}", do, {}, [path], after)
    if done:
        (run.preview_paths if folder == "previews" else run.check_paths)[name] = done["path"]


def _write_report(make: Callable[[], DataFrame]) -> Callable[[str], None]:
    return lambda path: make().coalesce(1).write.parquet(path)


def check_steps(run: BatchRun, loaded: dict[str, dict[str, Any]]) -> None:
    after = list(loaded.values())
    if not after:
        return
    tables = {n: run.raw(n) for n in loaded}
    run_concurrently(
        lambda: _report_step(run, "quality", "row_counts", _write_report(lambda: run.spark.createDataFrame(
            [(n, d["rows"]) for n, d in loaded.items()], "table_name string, row_count long")), after),
        lambda: _report_step(run, "quality", "schema", _write_report(lambda: describe(run.spark, tables)), after),
        lambda: _report_step(run, "quality", "checks", lambda path: run_checks(
            _raw_or_none(run, STATE_DATASET), _raw_or_none(run, COUNTY_DATASET), path), after))


def transform(run: BatchRun, loaded: dict[str, dict[str, Any]], export: bool = True) -> None:
    """Staging views, marts and exports of what was loaded."""
    spark, root = run.spark, run.root
    raw_ns, stg_ns, mart_ns = run.namespaces
    for ns in (stg_ns, mart_ns):
        catalog.create_namespace(spark, ns, f"{root}/{ns}.db")
    columns = {STATE_DATASET: models.STAGE_STATE, COUNTY_DATASET: models.STAGE_COUNTY}
    staged = {name: catalog.replace_view(spark, f"{stg_ns}.stg_{name}", models.staging_query(columns[name], f"{raw_ns}.{name}"))
              for name in loaded}
    state, county = loaded.get(STATE_DATASET), loaded.get(COUNTY_DATASET)
    # both marts read the region staging relation: written once
    regions = f"{root}/staged/regions_{run.run_id}"

    def stage() -> dict[str, Any]:
        staged[STATE_DATASET].write.parquet(regions)
        return {"rows": spark.read.parquet(regions).count()}

    bounded = run.step("stage regions", stage, {}, [regions], [state])

    def build(name: str, make: Callable[[], DataFrame], after: list[dict[str, Any] | None]) -> dict[str, Any] | None:
        table, path = f"{mart_ns}.{name}", f"{root}/{mart_ns}.db/{name}"

        def do() -> dict[str, Any]:
            catalog.replace_table(make(), table, path)
            version = catalog.current_version(spark, table)
            return {"table": table, "version": version, "made": [version]}

        done = run.step(f"mart {name}", do, {}, (), after)
        if done:
            catalog.name_version(spark, table, done["version"])
            run.mart_tables[name] = table
        return done

    marts = run_concurrently(  # planned inside the threads: the region rank runs jobs as it plans
        lambda: build(MART_STATE, lambda: models.mart_state(spark.read.parquet(regions), bounded["rows"]), [bounded]),
        lambda: build(MART_COUNTY, lambda: models.mart_underserved(staged[COUNTY_DATASET], spark.read.parquet(regions), bounded["rows"]),
                      [bounded, county]))
    made = dict(zip((MART_STATE, MART_COUNTY), marts))
    orders = {MART_STATE: [F.col("broadband_rank"), F.col("state_name")],
              MART_COUNTY: [F.col("county_broadband_pct").asc_nulls_last(), F.col("county_name")]}

    def export_one(name: str) -> None:
        path = f"{root}/output/{EXPORT_FILES[name]}"
        # the region mart is bounded by the nation count: one file is safe;
        # the sub-region mart grows with the data: sorted part files

        def do() -> dict[str, Any]:
            export_csv(run.mart(name), path, orders[name], single_file=name == MART_STATE)
            return {"path": path, "made": [path]}

        done = run.step(f"export {name}", do, {}, (), [made[name]])
        if done:
            run.export_paths[name] = done["path"]

    def preview(name: str, mart: str, make: Callable[[DataFrame], DataFrame]) -> Callable[[], None]:
        return lambda: _report_step(run, "previews", name, _write_report(lambda: make(run.mart(mart))), [made[mart]])

    run_concurrently(*([lambda n=n: export_one(n) for n in EXPORT_FILES] if export else []),
                     preview("states", MART_STATE, analytics.preview_states), preview("counties", MART_COUNTY, analytics.preview_counties),
                     preview("severity", MART_COUNTY, analytics.severity_counts))


def previews(run: BatchRun) -> dict[str, DataFrame]:
    ms, mu = run.mart(MART_STATE), run.mart(MART_COUNTY)
    return {"states": analytics.preview_states(ms),
            "counties": analytics.preview_counties(mu),
            "severity": analytics.severity_counts(mu)}


def open_data_stand_in(spark: SparkSession, sf_dir: str, root: str) -> str:
    """Stand-in for the open-data download: the ``events`` table as a CSV file set."""
    from ..sources.tables import read_table
    return land_csv(read_table(spark, sf_dir, "events"), f"{root}/downloads", "open_data", "0")


def run_batch_job(spark: SparkSession, sf_dir: str, root: str | None = None,
                  run_id: str = DEFAULT_RUN_ID, namespaces: tuple[str, str, str] | None = None,
                  export: bool = True, open_data_path: str | None = None,
                  retries: dict[str, tuple[int, float]] | None = None) -> BatchRun:
    """The whole job.  ``namespaces`` are those of raw, staging and marts (default:
    these names with the run folder's tag, so that runs do not meet).

    With the ``root`` and ``run_id`` of an earlier run, steps that it finished on the
    same inputs are kept.  ``retries`` (times and seconds by kind of step) replaces
    ``RETRIES``.  Steps that failed are in ``failed`` and ``outcomes()``, which
    are also written under ``root``.
    """
    root = root or fresh_dir(spark, "batch")
    tag = root.rstrip("/").rsplit("-", 1)[-1]
    run = BatchRun(spark, root, run_id, namespaces or (f"raw_{tag}", f"staging_{tag}", f"marts_{tag}"), {**RETRIES, **(retries or {})})
    landed = ingest_steps(run, sf_dir, open_data_path=open_data_path)
    loaded = load(run, landed=landed)
    run_concurrently(lambda: check_steps(run, loaded), lambda: transform(run, loaded, export))
    run.outcomes().coalesce(1).write.mode("overwrite").parquet(f"{root}/outcomes_{run_id}")
    return run
