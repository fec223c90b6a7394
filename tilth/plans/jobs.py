"""Running datasets as jobs: read, conform, validate, quarantine, write, log."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.contracts import CONTRACTS, MARTS, Contract, contract, widened
from tilth.operators import quality
from tilth.plans.catalog import FarmData
from tilth.plans.conformed import SPECS
from tilth.session import use_utc
from tilth.sources.lake import ControlTables, Lake, append_batch, exists, in_weather_window, remove

SNAPSHOTS = ("farm", "field", "sensor", "region", "soil_type", "crop", "crop_variety", "machine", "planting")
INCREMENTS = ("sensor_reading", "irrigation_event", "input_application", "harvest", "field_cost", "machine_operation",
              "machine_telemetry", "machine_fault", "field_index_observation")
WEATHER = ("weather_archive", "weather_forecast")
BACKFILL_START = dt.date(2019, 1, 1)
DIMENSIONS = tuple(n for n in SPECS if n.startswith("dim_"))
FACTS = tuple(n for n in SPECS if n.startswith("fact_"))
# The order rows are stored in by the warehouse load.
FACT_LOADS = {
    "fact_sensor_reading": "reading_ts", "fact_irrigation": "event_ts", "fact_input_application": "applied_on",
    "fact_harvest": "harvested_on", "fact_field_cost": "cost_date", "fact_machine_operation": "started_at",
    "fact_machine_telemetry": "reading_ts", "fact_machine_fault": "occurred_at", "fact_field_index": "observed_on",
    "fact_weather_daily": "weather_date",
}
WEATHER_MARTS = ("dim_date", "field_weather_daily")


def _stages(raw, conformed=(), gold=(), load=()):
    pairs = (("raw", raw), ("conformed", conformed), ("mart", gold), ("load", load))
    return tuple(tuple(f"{zone}.{n}" for n in names) for zone, names in pairs if names)


DOMAINS = {
    "soil_sensor": _stages(("farm", "field", "sensor", "sensor_reading"),
                           ("dim_farm", "dim_field", "dim_sensor", "fact_sensor_reading"), ("field_soil_daily",),
                           ("dim_farm", "dim_field", "dim_sensor", "fact_sensor_reading", "field_soil_daily")),
    "weather": _stages(("farm", "field", *WEATHER), ("dim_farm", "dim_field", "fact_weather_daily"), WEATHER_MARTS,
                       ("dim_date", "fact_weather_daily", "field_weather_daily")),
    "reference": _stages(("region", "soil_type", "crop", "crop_variety"),
                         ("dim_region", "dim_soil_type", "dim_crop", "dim_crop_variety")),
    "operations": _stages(("farm", "field", "planting", "irrigation_event", "input_application", "harvest", "field_cost"),
                          ("dim_farm", "dim_field", "dim_planting", "fact_irrigation", "fact_input_application",
                           "fact_harvest", "fact_field_cost")),
    "machinery": _stages(("farm", "field", "machine", "machine_operation", "machine_telemetry", "machine_fault"),
                         ("dim_machine", "fact_machine_operation", "fact_machine_telemetry", "fact_machine_fault")),
    "imagery": _stages(("farm", "field", "field_index_observation"), ("dim_field", "fact_field_index")),
    "analytics": tuple(
        tuple(f"{zone}.{n}" for n in names) for zone, names in (
            ("mart", ("field_crop_health_daily", "field_irrigation_daily", "machine_daily", "planting_economics")),
            ("load", ("dim_region", "dim_soil_type", "dim_crop", "dim_crop_variety", "dim_planting", "dim_machine",
                      "fact_irrigation", "fact_input_application", "fact_harvest", "fact_field_cost",
                      "fact_machine_operation", "fact_machine_telemetry", "fact_machine_fault", "fact_field_index",
                      "field_crop_health_daily", "field_irrigation_daily", "machine_daily", "planting_economics")))),
}


def list_pipelines() -> list[str]:
    raw = [*SNAPSHOTS, *INCREMENTS, *WEATHER]
    conformed = [*SPECS, "fact_weather_daily"]
    return sorted([*(f"raw.{n}" for n in raw), *(f"conformed.{n}" for n in conformed), *(f"mart.{n}" for n in MARTS),
                   *(f"load.{n}" for n in [*conformed, *MARTS])])


def list_domains() -> list[str]:
    return sorted(DOMAINS)


def accepted(lake: Lake, staged: DataFrame, rules: Contract, dataset: str, day: str, pipeline: str,
             batch: str | None = None) -> tuple[DataFrame, int]:
    """The valid rows of a staged table and how many were quarantined; raises
    before anything is written if they are too many. Quarantine and report are
    filed under the day and, for one of its batches, under the batch, and hold
    what the last run of these rejected: after a clean run, nothing."""
    flagged = quality.flag_failures(staged, rules)
    total = quality.rejection_counts(flagged).first()
    zone = "quarantine" if not pipeline.startswith("raw.") else "quarantine_raw"
    parts = ((zone, quality.invalid_rows), (f"{zone}_report", lambda f: quality.quarantine_report(f, pipeline, day)))
    if total["rows_rejected"]:
        quality.check_rate(pipeline, total["rows_in"], total["rows_rejected"])
    for place, rows in parts:
        name = dataset if batch is None else f"{dataset}/logical_date={day}"
        key, value = ("logical_date", day) if batch is None else ("batch", batch)
        if total["rows_rejected"]:
            lake.write_partition(rows(flagged).drop("logical_date"), place, name, key, value)
        else:
            lake.drop_partition(place, name, key, value)
    return quality.valid_rows(flagged), total["rows_rejected"]


def publish(lake: Lake, df: DataFrame, dataset: str, logical_date: str, write, pipeline: str, rules: Contract | None = None) -> dict[str, int]:
    """Validate and write. The rows are computed once, to a staging table below
    the lake; uniqueness, counts, accepted and rejected rows all read that.
    Nothing reaches its place before the rejection rate is known."""
    rules = rules or contract(dataset)
    quality.require_structure(df, rules)
    staging = f"{lake.root}/staging/{dataset}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(staging)
        staged = lake.spark.read.schema(df.schema).parquet(staging)
        valid, rejected = accepted(lake, staged, rules, dataset, logical_date, pipeline)
        total = staged.count()
        write(valid)
    finally:
        remove(lake.spark, staging)
    return {"rows_read": total, "rows_written": total - rejected, "rows_quarantined": rejected}


class Runner:
    """Runs pipelines of one lake by name. ``source(name)`` gives a source
    table; conformed tables and marts read what earlier jobs wrote."""

    def __init__(self, spark: SparkSession, root: str, source):
        self.spark = use_utc(spark)
        self.lake = Lake(spark, root)
        self.control = ControlTables(self.lake)
        self.source = source

    def run(self, name: str, logical_date: dt.date) -> dict[str, int]:
        """Run one pipeline; the outcome is logged, a failure also re-raised."""
        if name not in list_pipelines():
            raise KeyError(f"unknown pipeline {name!r}; registered: {', '.join(list_pipelines())}")
        zone, dataset = name.split(".", 1)
        started = dt.datetime.now(dt.timezone.utc)
        entry = {"pipeline": name, "logical_date": logical_date, "started_at": started}
        try:
            stats = getattr(self, f"_run_{zone}")(dataset, logical_date.isoformat())
        except Exception as exc:
            self.control.log_run(**entry, finished_at=dt.datetime.now(dt.timezone.utc), status="failed", error=str(exc))
            raise
        self.control.log_run(**entry, finished_at=dt.datetime.now(dt.timezone.utc), status="success", **stats)
        return stats

    def run_domain(self, domain: str, logical_date: dt.date) -> dict[str, dict[str, int]]:
        if domain not in DOMAINS:
            raise KeyError(f"unknown domain {domain!r}; valid: {', '.join(list_domains())}")
        return {name: self.run(name, logical_date) for stage in DOMAINS[domain] for name in stage}

    # -- zones ----------------------------------------------------------------
    def _counted(self, df: DataFrame, write) -> dict[str, int]:
        from pyspark.sql import Observation

        watch = Observation()
        write(df.observe(watch, F.count("*").alias("n")))
        n = watch.get["n"]
        return {"rows_read": n, "rows_written": n, "rows_quarantined": 0}

    def _run_raw(self, dataset: str, day: str) -> dict[str, int]:
        """Extracts are held to their raw contract before they land: columns and
        types as a whole, rows by quarantine and the rejection limit."""
        df, pipeline = self.source(dataset), f"raw.{dataset}"
        rules = contract("raw_weather" if dataset in WEATHER else f"raw_{dataset}")
        df = widened(df, rules)
        if dataset in INCREMENTS:
            return append_batch(self.lake, self.control, df, dataset=dataset, source_table=dataset, column="updated_at", ingest_date=day,
                                accept=lambda staged, batch: accepted(self.lake, staged, rules, dataset, day, pipeline, batch))
        if dataset in WEATHER:
            df = in_weather_window(df, dt.date.fromisoformat(day), BACKFILL_START)
        key = "ingest_date" if dataset in WEATHER else "snapshot_date"
        return publish(self.lake, df, dataset, day, lambda f: self.lake.write_partition(f, "raw", dataset, key, day), pipeline, rules)

    def _raw(self, dataset: str, day: str) -> DataFrame:
        if dataset in INCREMENTS:
            # Batches of the run's own day, as conforming works partition by
            # partition; a day on which nothing arrived has no rows.
            if not exists(self.spark, f"{self.lake.path('raw', dataset)}/ingest_date={day}"):
                return self.source(dataset).limit(0)
            return self.lake.require("raw", dataset, "ingest_date", day)
        if dataset in WEATHER:
            return self.lake.read("raw", dataset, contract("raw_weather"))
        return self.lake.require("raw", dataset, "snapshot_date", day)

    def _run_conformed(self, dataset: str, day: str) -> dict[str, int]:
        from tilth.plans.conformed import conformed, fact_weather_daily

        if dataset == "fact_weather_daily":
            df = fact_weather_daily(*[self._raw(n, day) for n in (*WEATHER, "farm")])
            key = "snapshot_date"
        else:
            df = conformed(dataset, lambda n: self._raw(n, day))
            key = "ingest_date" if SPECS[dataset].incremental else "snapshot_date"
        return publish(self.lake, df, dataset, day,
                       lambda f: self.lake.write_partition(f, "conformed", dataset, key, day), f"conformed.{dataset}")

    def _conformed(self, dataset: str, day: str) -> DataFrame:
        """A dimension or the weather fact as of the run; a fact over all its
        days, the newest version of each key."""
        from tilth.operators.latest import latest_per_key

        rules = CONTRACTS[dataset]
        if dataset in SPECS and SPECS[dataset].incremental:
            path = self.lake.path("conformed", dataset)
            if not exists(self.spark, path):
                return rules.empty(self.spark)
            df = self.lake.read("conformed", dataset, rules)
            key = list(SPECS[dataset].dedupe_on)
            return latest_per_key(df, key, ["ingest_date"], rules.columns).select(*rules.columns)
        return self.lake.require("conformed", dataset, "snapshot_date", day).select(*rules.columns)

    def _run_mart(self, dataset: str, day: str) -> dict[str, int]:
        data = _LakeData(self, day)
        return publish(self.lake, data.build(dataset), dataset, day,
                       lambda f: self.lake.write_partition(f, "mart", dataset, "run_date", day), f"mart.{dataset}")

    def _run_load(self, dataset: str, day: str) -> dict[str, int]:
        """Replace the warehouse table with the current rows."""
        if dataset in MARTS:
            df = self.lake.require("mart", dataset, "run_date", day)
        else:
            df = self._conformed(dataset, day)
        sort = [FACT_LOADS[dataset]] if dataset in FACT_LOADS else None
        return self._counted(df, lambda f: self.lake.replace(f, "warehouse", dataset, sort))


class _LakeData(FarmData):
    """The same dataset plans, fed by the lake instead of the source system."""

    def __init__(self, runner: Runner, day: str):
        self.spark, self._plans, self._runner, self._day = runner.spark, {}, runner, day

    def build(self, name: str) -> DataFrame:
        return FarmData._build(self, name)

    def _build(self, name: str) -> DataFrame:
        if name in MARTS:
            return self._runner.lake.require("mart", name, "run_date", self._day)
        if name == "src_field_farms":
            return None  # facts of earlier days may have a field under another farm
        dataset, _, columns = name.partition(":")
        df = self._runner._conformed(dataset, self._day)
        return df.select(*columns.split("+")) if columns else df
