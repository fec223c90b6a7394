"""One query per operator and dataset, by name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.contracts import contract
from tilth.functions import agronomy, bands
from tilth.functions.exact import exact_avg, exact_sum, guarded_ratio, round_columns, rounded
from tilth.functions.text import hours_between, iso_weekday, start_of, strip_text
from tilth.operators import conform, latest, metrics, quality, ranges
from tilth.plans import charts, features, jobs, marts, views
from tilth.plans.catalog import FarmData
from tilth.plans.conformed import SPECS, union_relaxed
from tilth.session import scratch_dir
from tilth.sources import lake as lk
from tilth.sources import tables, weather_json
from tilth.streaming import increments

QUERIES: dict[str, object] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def ts(text: str):
    return dt.datetime.fromisoformat(text)


def _lake(d: FarmData, label: str) -> lk.Lake:
    return lk.Lake(d.spark, scratch_dir(d.spark, label))


# ---- sources and sinks ------------------------------------------------------
@query
def snapshot_scan(d):
    lake = _lake(d, "snapshot")
    lake.write_partition(d.raw("field"), "raw", "field", "snapshot_date", "2024-01-31")
    return lake.read("raw", "field")


@query
def incremental_scan(d):
    return lk.newer_than(d.raw("sensor_reading"), "updated_at", ts("2024-01-15"))


@query
def watermark_advance(d):
    old = lk.batch_mark(d.raw("sensor_reading").filter("updated_at < '2024-01-20'"), "raw.sensor_reading",
                        "sensor_reading", "updated_at")
    late = lk.batch_mark(d.raw("sensor_reading").filter("updated_at < '2024-01-10'"), "raw.sensor_reading",
                         "sensor_reading", "updated_at")
    other = lk.batch_mark(d.raw("machine_fault"), "raw.machine_fault", "machine_fault", "updated_at")
    empty = lk.batch_mark(d.raw("machine_fault").filter("updated_at < '1990-01-01'"), "raw.none", "none", "updated_at")
    control = lk.ControlTables(_lake(d, "marks"))
    for batch in (old, late, other, empty):
        control.advance(batch)
    return control.marks()


@query
def watermark_reset(d):
    control = lk.ControlTables(_lake(d, "marks"))
    for name in ("sensor_reading", "machine_fault"):
        control.advance(lk.batch_mark(d.raw(name), f"raw.{name}", name, "updated_at"))
    control.reset("raw.machine_fault")
    return control.marks()


@query
def batch_append(d):
    """Two batches; the first is then extracted again, and an empty one tried."""
    lake = _lake(d, "batches")
    control = lk.ControlTables(lake)
    source = d.raw("sensor_reading")
    how = dict(dataset="sensor_reading", source_table="sensor_reading", column="updated_at")
    lk.append_batch(lake, control, source.filter("updated_at < '2024-01-12'"), ingest_date="2024-01-12", **how)
    control.reset("raw.sensor_reading")
    lk.append_batch(lake, control, source.filter("updated_at < '2024-01-12'"), ingest_date="2024-01-12", **how)
    lk.append_batch(lake, control, source, ingest_date="2024-01-31", **how)
    lk.append_batch(lake, control, source, ingest_date="2024-02-01", **how)
    return lake.read("raw", "sensor_reading").drop("batch")


@query
def partition_overwrite(d):
    lake = _lake(d, "overwrite")
    readings = d["fact_sensor_reading"]
    lake.write_by(readings, "conformed", "reading", ["reading_date"], ["reading_id"])
    again = readings.filter("reading_date >= '2024-01-20'").withColumn("battery_pct", F.lit(50.0))
    lake.write_by(again, "conformed", "reading", ["reading_date"], ["reading_id"])
    return lake.read("conformed", "reading").select(*readings.columns)


@query
def partition_read(d):
    lake = _lake(d, "partition")
    readings = d["fact_sensor_reading"]
    lake.write_by(readings, "conformed", "reading", ["reading_date"])
    return lake.read("conformed", "reading", partition={"reading_date": "2024-01-15"}).select(*readings.columns)


@query
def all_partitions_read(d):
    """Batches that stored columns as integers, decimals or doubles, or not at
    all, read together in the contract's types."""
    lake = _lake(d, "widening")
    rules = contract("fact_sensor_reading")
    readings = d["fact_sensor_reading"]
    stored = {
        "2024-01-05": {"sensor_id": F.col("sensor_id").cast("int"), "soil_moisture_pct": F.col("soil_moisture_pct").cast("decimal(12,6)")},
        "2024-01-12": {"battery_pct": F.lit(None).cast("int"), "soil_ph": F.floor("soil_ph")},
        "2024-01-20": {"soil_ec_ds_m": F.lit(None).cast("double")},
        "2024-02-01": {"soil_temperature_c": F.col("soil_temperature_c").cast("decimal(9,4)")},
    }
    since = "1900-01-01"
    for until, types in stored.items():
        part = readings.filter(f"reading_date >= '{since}' and reading_date < '{until}'").withColumns(types)
        part = part.drop("soil_ec_ds_m") if until == "2024-01-20" else part
        lake.write_partition(part, "conformed", "reading", "ingest_date", until)
        since = until
    lake.write_partition(readings.filter(f"reading_date >= '{since}'"), "conformed", "reading", "ingest_date", "2024-12-31")
    return lake.read("conformed", "reading", rules).select(*rules.columns)


@query
def missing_ok_empty(d):
    lake = _lake(d, "missing")
    rules = contract("fact_sensor_reading")
    absent = lake.read("conformed", "fact_sensor_reading", rules)
    both = d["fact_sensor_reading"].withColumn("origin", F.lit("present")).unionByName(absent.withColumn("origin", F.lit("absent")))
    return both.groupBy("origin").agg(F.expr("count(*) AS rows"), exact_avg("soil_ph", "avg_ph"))


@query
def require_upstream(d):
    lake = _lake(d, "upstream")
    lake.write_partition(d["field_soil_daily"], "mart", "field_soil_daily", "run_date", "2024-01-31")
    return lake.require("mart", "field_soil_daily", "run_date", "2024-01-31")


def _weather_documents(d):
    """Documents of the weather fact; every fifth farm lacks one series and
    every seventh (plus three) sends one series too long."""
    names = {v: k for k, v in _RAW_WEATHER.items()}
    docs = weather_json.to_documents(d["fact_weather_daily"].withColumnsRenamed(names))
    no = F.regexp_extract("farm_code", r"(\d+)$", 1).cast("bigint")
    rain = F.when(no % 5 != 0, F.col("daily.rain_sum"))
    long = F.when(no % 7 == 3, F.array_append("daily.precipitation_sum", F.lit(0.0))).otherwise(F.col("daily.precipitation_sum"))
    return docs.withColumn("daily", F.col("daily").withField("rain_sum", rain).withField("precipitation_sum", long))


_RAW_WEATHER = {"temperature_2m_max": "temp_max_c", "temperature_2m_min": "temp_min_c", "temperature_2m_mean": "temp_mean_c",
                "precipitation_sum": "precipitation_mm", "rain_sum": "rain_mm", "et0_fao_evapotranspiration": "et0_mm",
                "shortwave_radiation_sum": "solar_radiation_mj_m2", "wind_speed_10m_max": "wind_speed_max_kmh"}


@query
def weather_json_flatten(d):
    path = scratch_dir(d.spark, "documents") + "/landing"
    _weather_documents(d).write.mode("overwrite").json(path)
    rows, _ = weather_json.flatten_documents(weather_json.read_documents(d.spark, path))
    return rows


@query
def weather_window_filter(d):
    both = union_relaxed(d.raw("weather_archive"), d.raw("weather_forecast"))
    return lk.in_weather_window(both, dt.date(2024, 1, 20), dt.date(2020, 1, 1)).select(
        "farm_code", "weather_date", "source", "precipitation_sum", "rain_sum")


@query
def table_replace_load(d):
    lake = _lake(d, "warehouse")
    lake.replace(d["fact_irrigation"].filter("field_id % 2 = 0"), "warehouse", "fact_irrigation", ["event_ts"])
    lake.replace(d["fact_irrigation"], "warehouse", "fact_irrigation", ["event_ts"])
    return lake.read("warehouse", "fact_irrigation")


@query
def table_append(d):
    lake = _lake(d, "append")
    faults = d["fact_machine_fault"]
    lake.append(faults.filter("is_open"), "warehouse", "fact_machine_fault")
    lake.append(faults.filter("fault_id < 0"), "warehouse", "fact_machine_fault")
    lake.append(faults.filter("not is_open"), "warehouse", "fact_machine_fault")
    return lake.read("warehouse", "fact_machine_fault")


@query
def partition_drop(d):
    lake = _lake(d, "drop")
    faults = d["fact_machine_fault"]
    lake.write_by(faults, "warehouse", "fault", ["occurred_date"])
    lake.drop_partition("warehouse", "fault", "occurred_date", "2024-01-10")
    return lake.read("warehouse", "fault").select(*faults.columns)


@query
def catalog_register(d):
    lake = _lake(d, "catalog")
    lake.write_partition(d["dim_field"], "conformed", "dim_field", "snapshot_date", "2024-01-31")
    lake.write_partition(d["dim_field"].filter("area_ha > 25"), "conformed", "dim_field", "snapshot_date", "2024-02-01")
    return tables.register_table(d.spark, "catalog_dim_field", contract("dim_field"), "snapshot_date",
                                 lake.path("conformed", "dim_field"))


@query
def contract_to_ddl(d):
    """The catalog columns of a table, each with how many values it holds."""
    df = d["fact_machine_telemetry"]
    ddl = tables.ddl_columns(contract("fact_machine_telemetry"), "reading_date")
    counted = df.agg(*[F.count(n).alias(n) for n, _ in ddl])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("column_type"), F.col(n).alias("values_held"))
                     for n, t in ddl])
    return counted.select(F.inline(rows))


@query
def catalog_probe(d):
    lake = _lake(d, "probe")
    out = None
    for name in ("dim_farm", "dim_machine"):
        lake.write_partition(d[name], "conformed", name, "snapshot_date", "2024-01-31")
        tables.register_table(d.spark, f"probe_{name}", contract(name), "snapshot_date", lake.path("conformed", name))
        row = tables.probe(d.spark, f"probe_{name}")
        out = row if out is None else out.unionByName(row)
    return out


@query
def numeric_normalise(d):
    part = d.raw("field").select("field_id", F.col("area_ha").cast("decimal(10,2)"), F.col("latitude").cast("decimal(9,6)"), "name")
    return lk.numeric_normalise(part)


@query
def run_metrics_log(d):
    runner = jobs.Runner(d.spark, scratch_dir(d.spark, "runs"), d.raw)
    day = dt.date(2024, 1, 31)
    for name in ("raw.farm", "raw.machine", "raw.machine_fault", "conformed.dim_machine", "conformed.fact_machine_fault"):
        runner.run(name, day)
    runner.run("raw.machine_fault", day)
    log = latest.latest_per_key(runner.control.runs(), ["pipeline"], ["started_at"])
    return log.select("pipeline", "status", "rows_read", "rows_written", "rows_quarantined", "logical_date")


# ---- conforming -------------------------------------------------------------
@query
def conform_rename(d):
    return conform.rename(d.raw("farm"), {"name": "farm_name", "no_such_column": "x"}).select("farm_id", "farm_name")


@query
def conform_trim(d):
    return conform.clean_text(d.raw("field"), trim=("field_code", "soil_type", "absent")).select("field_id", "field_code", "soil_type")


@query
def conform_case(d):
    return conform.clean_text(d.raw("farm"), lower=("region",), upper=("country_code",)).select("farm_id", "region", "country_code")


@query
def conform_cast(d):
    df = d.raw("machine").select("machine_id", F.col("year_built").cast("string"), F.col("rated_power_hp").cast("string"))
    return conform.cast_to(df, {"year_built": contract("dim_machine").rules[6].dtype, "rated_power_hp": contract("dim_machine").rules[7].dtype})


@query
def conform_derive(d):
    return conform.derive(d.raw("machine_operation"), {
        "operation_date": "to_date(started_at)",
        "fuel_per_ha": "fuel_used_litres / area_covered_ha",
    }).select("operation_id", "operation_date", "fuel_per_ha")


@query
def conform_filter(d):
    df = conform.clean_text(d.raw("sensor"), lower=("status",))
    return df.filter("status != 'decommissioned'").select("sensor_id", "status")


@query
def conform_select(d):
    return conform.select_contract(d["fact_harvest"].withColumn("created_at", F.lit(1)), contract("fact_harvest"))


@query
def clash_drop(d):
    """The harvest's own area gives way to the planting's."""
    own = d.raw("harvest").select("harvest_id", "planting_id", F.expr("area_harvested_ha AS area_ha"))
    return conform.lookup_join(own, d.raw("planting"), ("planting_id",), ("area_ha", "season"))


@query
def derive_date(d):
    return d.raw("sensor_reading").select("reading_id", F.to_date("reading_ts").alias("reading_date"))


@query
def derive_duration_hours(d):
    return d.raw("machine_operation").select("operation_id", F.expr(f"{hours_between('started_at', 'finished_at')} AS duration_hours"))


@query
def derive_is_open(d):
    return d.raw("machine_fault").select("fault_id", F.col("resolved_at").isNull().alias("is_open"))


@query
def derive_is_actual(d):
    both = union_relaxed(d.raw("weather_archive"), d.raw("weather_forecast"))
    return both.groupBy("farm_code", (F.col("source") == "archive").alias("is_actual")).agg(F.expr("count(*) AS rows"))


@query
def filter_usable(d):
    return d["fact_field_index"].filter("usable").select("observation_id", "field_id", "ndvi")


@query
def filter_attributed(d):
    return marts.attributed(d["fact_field_cost"]).select("cost_id", "planting_id", "amount_usd")


@query
def filter_actuals(d):
    return d["fact_weather_daily"].filter("is_actual").select("farm_id", "weather_date", "precipitation_mm")


_PREDICATES = {
    "canopy_stage_known": ("field_crop_health_daily", "canopy_stage != 'unknown'"),
    "area_worked": ("machine_daily", "area_covered_ha > 0"),
    "harvested": ("planting_economics:harvest+irrigation+weather", "outcome = 'harvested'"),
    "actual": ("field_irrigation_daily", "is_actual"),
    "crop_known": ("field_crop_health_daily", "crop_name is not null"),
    "yield_and_water_known": ("planting_economics:harvest+irrigation+weather", "yield_t_ha is not null and water_received_mm is not null"),
}


@query
def ad_hoc_filters(d):
    """The predicates over a mart are counted in one reading of it."""
    rules: dict[str, dict[str, str]] = {}
    for label, (name, rule) in _PREDICATES.items():
        rules.setdefault(name, {})[label] = rule
    counted = []
    for name, own in rules.items():
        rows = d[name].filter(" OR ".join(f"({rule})" for rule in own.values()))
        counts = rows.agg(*[F.expr(f"count_if({rule})").alias(label) for label, rule in own.items()])
        each = F.array(*[F.struct(F.lit(label).alias("predicate"), F.col(label).alias("rows")) for label in own])
        counted.append(counts.select(F.inline(each)))
    return union_relaxed(*counted)


@query
def dashboard_filters(d):
    df = metrics.apply_filters(d["field_soil_daily"], {"region": ["AFRICA", "ASIA"], "soil_type": ["clay", "loamy"]},
                               "reading_date", dt.date(2024, 1, 5), dt.date(2024, 1, 25))
    return metrics.metric_query(df, "field_soil_daily", ["count", "avg_moisture", "dry_field_days"], ["region", "soil_type"])


@query
def zero_fill(d):
    joined = marts.machine_day_join(d["fact_machine_telemetry"], d["fact_machine_operation"], d["fact_machine_fault"])
    filled = marts.zero_fill(joined, {"operations": 0, "area_covered_ha": 0.0, "faults": 0})
    return filled.select("machine_id", "activity_date", "operations", "area_covered_ha", "faults", "distance_km")


@query
def query_guarded_ratio(d):
    df = marts.operations_aggregate(d["fact_machine_operation"].withColumn(
        "area_covered_ha", F.when(F.col("operation_id") % 3 == 0, 0.0).otherwise(F.col("area_covered_ha"))))
    return df.select("machine_id", "activity_date",
                     guarded_ratio("fuel_used_litres", "area_covered_ha").alias("fuel_per_ha"))


QUERIES["guarded_ratio"] = QUERIES.pop("query_guarded_ratio")


@query
def round_block(d):
    df = d["fact_sensor_reading"].groupBy("field_id").agg(
        exact_avg("soil_moisture_pct", "moisture"), exact_avg("soil_ph", "ph"))
    return round_columns(df, ["moisture", "ph"], 3)


@query
def classify_moisture_stress(d):
    return d["fact_sensor_reading"].select("reading_id", bands.moisture_stress("soil_moisture_pct").alias("moisture_stress"))


@query
def classify_aridity(d):
    balance = "precipitation_mm - et0_mm"
    return d["fact_weather_daily"].select("farm_id", "weather_date", bands.aridity(balance).alias("aridity_flag"))


@query
def classify_canopy_stage(d):
    return d["field_crop_health_daily"].groupBy(bands.canopy_stage("cycle_progress_pct").alias("canopy_stage")).agg(
        F.expr("count(*) AS rows"), F.expr("min(cycle_progress_pct) AS least"), F.expr("max(cycle_progress_pct) AS most"))


@query
def classify_vigour(d):
    flag = bands.vigour("ndvi_vs_expected_pct", "canopy_stage").alias("vigour_flag")
    return d["field_crop_health_daily"].groupBy("canopy_stage", flag).agg(
        F.expr("count(*) AS rows"), F.expr("min(ndvi_vs_expected_pct) AS least"), F.expr("max(ndvi_vs_expected_pct) AS most"))


@query
def classify_supply_status(d):
    deficit = "et0_mm - precipitation_mm"
    return d["fact_weather_daily"].select("farm_id", "weather_date", bands.supply_status(deficit).alias("supply_status"))


@query
def classify_utilisation(d):
    df = d["machine_daily"]
    status = bands.utilisation("critical_faults", "running_readings", "area_covered_ha", "idle_ratio_pct")
    return df.groupBy("machine_type", status.alias("status")).agg(F.expr("count(*) AS rows"))


@query
def classify_method_mixed(d):
    df = d["fact_irrigation"].groupBy("planting_id").agg(
        F.expr("count(DISTINCT method) AS n"), F.expr("min(method) AS one"))
    return df.select("planting_id", bands.mixed_or_single("n", "one").alias("irrigation_method"))


@query
def grade_banding(d):
    return features.graded_harvests(d["fact_harvest"], _planted(d))


def _planted(d):
    return features.planting_crops(*d.many("dim_planting", "dim_crop_variety", "dim_crop"))


# ---- joins ------------------------------------------------------------------
@query
def lookup_join(d):
    costs = d.raw("field_cost").select("cost_id", "field_id", "amount_usd")
    small = d.raw("field").filter("area_ha > 10")
    return conform.lookup_join(costs, small, ("field_id",), ("farm_id",))


@query
def lookup_join_chain(d):
    df = d.raw("sensor_reading").select("reading_id", "sensor_id")
    df = conform.lookup_join(df, d.raw("sensor"), ("sensor_id",), ("field_id", "status"))
    return conform.lookup_join(df, d.raw("field"), ("field_id",), ("farm_id",))


@query
def dimension_enrich(d):
    df = marts.enrich(d["fact_sensor_reading"].select("reading_id", "field_id", "farm_id"), d["dim_field"], d["dim_farm"],
                      ["field_code", "soil_type", "area_ha"], ["farm_code", "region"])
    return df


@query
def optional_enrich(d):
    obs = d["fact_field_index"].select("observation_id", "planting_id")
    df = marts.crop_of_planting(obs, *d.many("dim_planting", "dim_crop_variety", "dim_crop"))
    return df.select("observation_id", "planting_id", "season", "variety_code", "crop_name", "cycle_days")


@query
def spine_left_join(d):
    """Planting days as the spine: the days with no irrigation stay."""
    spine = d["dim_planting"].select("field_id", F.expr("planted_on AS water_date")).distinct()
    df = spine.join(marts.irrigation_aggregate(d["fact_irrigation"]), ["field_id", "water_date"], "left")
    return marts.zero_fill(df.select("field_id", "water_date", "irrigation_events", "irrigation_mm", "irrigation_method"),
                           {"irrigation_events": 0, "irrigation_mm": 0.0, "irrigation_method": "none"})


@query
def multi_fact_left_join(d):
    df = marts.machine_day_join(d["fact_machine_telemetry"], d["fact_machine_operation"], d["fact_machine_fault"])
    return df.select("machine_id", "activity_date", "telemetry_readings", "operations", "operation_hours", "faults", "critical_faults")


@query
def star_join(d):
    df = marts.star_join(*d.many("dim_planting", "dim_field", "dim_farm", "dim_crop_variety", "dim_crop"))
    harvest = d["fact_harvest"].select("planting_id", "yield_tonnes")
    inputs = marts.inputs_per_planting(d["fact_input_application"])
    return df.join(harvest, "planting_id", "left").join(inputs, "planting_id", "left").select(
        "planting_id", "field_code", "region", "variety_name", "crop_name", "yield_tonnes", "input_applications")


@query
def window_range_join(d):
    return marts.weather_per_planting(d["fact_weather_daily"], d["dim_planting"])


@query
def farm_to_field_pushdown(d):
    """A farm's days are summed once, then copied to its fields."""
    df = d["fact_weather_daily"].filter("is_actual").groupBy("farm_id").agg(F.expr("count(*) AS days"), exact_sum("rain_mm", "rain_mm"))
    return df.join(d["dim_field"].select("farm_id", "field_id"), "farm_id").select("field_id", "days", "rain_mm")


@query
def spine_inner_view(d):
    return d["v_field_water_daily"].select("field_id", "observation_date", "precipitation_mm", "avg_soil_moisture_pct", "moisture_stress")


@query
def supply_left_view(d):
    df = d["v_field_water_supply_daily"]
    return df.groupBy("field_id").agg(F.expr("count(*) AS days"), F.expr("count(avg_soil_moisture_pct) AS days_with_soil"),
                                      F.count_if(F.col("moisture_stress").isNull()).alias("days_without_soil"))


@query
def latest_per_group_join(d):
    """Every pass on its field's latest day, ties kept."""
    return latest.latest_rows_by_join(d["fact_field_index"], "field_id", "observed_on").select("field_id", "observed_on", "observation_id", "ndvi")


@query
def orphan_anti_join(d):
    active = d["dim_sensor"].filter("status = 'active'")
    return quality.orphans(d.raw("sensor_reading"), "sensor_id", active, "sensor_id").groupBy("sensor_id").agg(F.expr("count(*) AS readings"))


@query
def active_interval_join(d):
    return d["src_field_index_observation"].select("observation_id", "field_id", "observed_on", "source", "ndvi", "planting_id")


@query
def overlap_self_join(d):
    parked = d["fact_machine_telemetry"].filter("not engine_running").select("telemetry_id", "machine_id", "reading_ts")
    return ranges.inside_any(parked, d["fact_machine_operation"], on="machine_id", point_ts="reading_ts", start="started_at", end="finished_at")


@query
def decay_window_join(d):
    df = ranges.decayed_sum(
        d["fact_sensor_reading"], d["fact_irrigation"], on="field_id", point_id="reading_id", point_ts="reading_ts",
        event_ts="event_ts", amount="depth_mm", days=5, tau_days=5.0 / 3.0, out="depth_left_mm")
    return round_columns(df, ["depth_left_mm"], 4)


# ---- aggregates -------------------------------------------------------------
@query
def agg_soil_daily(d):
    return round_columns(marts.soil_aggregate(d["fact_sensor_reading"]), ["avg_soil_moisture_pct", "avg_soil_temperature_c", "avg_soil_ph", "avg_soil_ec_ds_m"], 3)


@query
def agg_crop_health(d):
    return marts.crop_health_aggregate(d["fact_field_index"])


@query
def agg_irrigation_daily(d):
    return marts.irrigation_aggregate(d["fact_irrigation"])


@query
def agg_telemetry_daily(d):
    return marts.telemetry_aggregate(d["fact_machine_telemetry"])


@query
def agg_operations_daily(d):
    return marts.operations_aggregate(d["fact_machine_operation"])


@query
def agg_faults_daily(d):
    return marts.faults_aggregate(d["fact_machine_fault"])


@query
def cost_pivot(d):
    return marts.costs_per_planting(d["fact_field_cost"])


@query
def agg_inputs_per_planting(d):
    return marts.inputs_per_planting(d["fact_input_application"])


@query
def agg_irrigation_per_planting(d):
    return marts.irrigation_per_planting(d["fact_irrigation"])


@query
def agg_weather_window(d):
    """Rain days and heat inside each planting's cycle."""
    daily = d["fact_weather_daily"].withColumns({
        "wet": F.when(F.col("rain_mm") > 0, 1.0).otherwise(0.0), "heat": F.expr(agronomy.degree_days("temp_mean_c"))})
    return ranges.window_range_sum(
        daily, d["dim_planting"], on="farm_id", day="weather_date", window_id="planting_id", start="planted_on",
        end="expected_harvest_on", sums={"wet_days": "wet", "heat_units": "heat"})


@query
def count_if(d):
    return d["fact_machine_telemetry"].groupBy("machine_id").agg(
        F.count_if(F.col("engine_running") & ~F.col("is_idle")).alias("working"), F.expr("count_if(is_idle) AS idle"),
        F.count_if(F.col("engine_temp_c").isNull()).alias("no_temperature"))


@query
def any_value(d):
    return d["field_soil_daily"].groupBy("field_id").agg(F.expr("min(field_area_ha) AS field_area_ha"), F.expr("count(*) AS days"))


@query
def arg_max(d):
    return d["machine_daily"].groupBy("machine_id").agg(F.expr("max_by(utilisation_status, activity_date) AS current_status"))


@query
def max_if(d):
    return d["machine_daily"].groupBy("machine_id").agg(F.max(F.when(F.col("open_faults") > 0, F.col("activity_date"))).alias("last_fault_on"))


@query
def having_filter(d):
    return d["fact_machine_fault"].groupBy("machine_id").agg(F.expr("count_if(is_open) AS open_faults")).filter("open_faults > 0")


@query
def ratio_of_totals(d):
    df = d["fact_machine_operation"].groupBy("operation_type").agg(
        exact_sum("fuel_used_litres", "fuel"), exact_sum("area_covered_ha", "area"))
    return df.select("operation_type", guarded_ratio("fuel", "area").alias("fuel_per_ha"))


@query
def distinct_exact(d):
    return d["fact_sensor_reading"].groupBy("farm_id").agg(
        F.expr("count(DISTINCT field_id) AS fields"), F.expr("count(DISTINCT sensor_id) AS sensors"))


@query
def distinct_approx_state(d):
    """Mergeable distinct sketches per day, merged per field; compared with
    the exact count, since a sketch is only close to it."""
    per_day = d["fact_sensor_reading"].groupBy("field_id", "reading_date").agg(F.hll_sketch_agg("sensor_id").alias("s"))
    merged = per_day.groupBy("field_id").agg(F.hll_union_agg("s").alias("s"))
    exact = d["fact_sensor_reading"].groupBy("field_id").agg(F.expr("count(DISTINCT sensor_id) AS sensors"))
    error = F.abs(F.hll_sketch_estimate("s") - F.col("sensors"))
    return merged.join(exact, "field_id").select("field_id", "sensors", (error <= F.greatest(F.lit(1.0), F.col("sensors") * 0.05)).alias("close"))


@query
def weekly_partial_states(d):
    s = views.soil_week_states(d["field_soil_daily"])
    return s.select("week_start", "field_id", F.size("days_state").alias("days"), "moisture_units", "moisture_n", "min_state", "max_state", "dry_state")


@query
def weekly_state_merge(d):
    """States of odd and even days built apart, then merged."""
    soil = d["field_soil_daily"]
    odd, even = (views.soil_week_states(soil.filter(f"dayofmonth(reading_date) % 2 = {i}")) for i in (1, 0))
    return views.finish_soil_weeks(views.merge_soil_week_states(odd.unionByName(even)))


@query
def machinery_cost_per_planting(d):
    return features.machinery_cost_per_planting(d["fact_machine_operation"])


@query
def derived_cost_ledger(d):
    return features.derived_cost_ledger(*d.many("dim_planting", "fact_input_application", "fact_irrigation", "fact_machine_operation"))


# ---- windows ----------------------------------------------------------------
def _series(d, *columns):
    return marts.farm_weather_series(d["fact_weather_daily"]).select("farm_id", "weather_date", *columns)


@query
def gdd_cumulative(d):
    return _series(d, "gdd_base10", "gdd_cumulative")


@query
def rainfall_7d(d):
    return _series(d, "rainfall_7d_mm")


@query
def rainfall_30d(d):
    return _series(d, "rainfall_30d_mm")


@query
def et0_7d(d):
    return _series(d, "et0_7d_mm")


@query
def water_balance_7d(d):
    return _series(d, "water_balance_mm", "water_balance_7d_mm", "aridity_flag")


@query
def self_overlap_check(d):
    ops = d["fact_machine_operation"].select("operation_id", "machine_id", "started_at", "finished_at")
    df = ranges.previous_in_order(ops, "machine_id", "started_at", ["started_at", "finished_at", "operation_id"], "finished_at", "previous_end")
    return df.filter("started_at < previous_end")


@query
def wet_dry_halves(d):
    pairs = features.water_yield_pairs(_water(d, "harvest+irrigation+weather"), d["dim_crop_variety"])
    return features.wet_dry_halves(pairs, "water_ratio", "relative_yield")


def _water(d, parts="irrigation+weather"):
    return features.planting_water(d[f"planting_economics:{parts}"], d["dim_crop"])


@query
def latest_run_per_pipeline(d):
    """Events read as a run log: pipeline, start, outcome."""
    log = d.raw("machine_telemetry").select(
        F.concat(F.lit("job-"), (F.col("machine_id") % 7).cast("string")).alias("pipeline"), F.expr("reading_ts AS started_at"),
        F.expr("telemetry_id AS run_id"), F.when(F.col("engine_running"), "success").otherwise("failed").alias("status"))
    return latest.latest_per_key(log, ["pipeline"], ["started_at"])


# ---- sorts, sets, dedupe ----------------------------------------------------
@query
def sort_output(d):
    return d["dim_planting"].orderBy("planted_on", "planting_id")


@query
def top_k_table(d):
    return metrics.table_query(d["fact_harvest"], ["harvest_id", "yield_t_ha", "revenue_usd"], "revenue_usd", False, 50)


@query
def order_by_metric(d):
    df = d["fact_field_cost"].groupBy("field_id").agg(exact_sum("amount_usd", "amount_usd"))
    return metrics.ordered(df, [F.col("amount_usd").desc_nulls_last()], 100)


@query
def query_union_relaxed(d):
    narrow = d.raw("weather_archive").withColumn("wind_speed_10m_max", F.col("wind_speed_10m_max").cast("int"))
    return union_relaxed(narrow, d.raw("weather_forecast"))


QUERIES["union_relaxed"] = QUERIES.pop("query_union_relaxed")


@query
def union_all_discriminator(d):
    return d["v_farm_field_locations"].select("entity_type", "entity_id", "entity_code", "soil_type")


@query
def dedupe_keep_last(d):
    """Two ingests of the cost feed, the later one corrected."""
    first = d.raw("field_cost").withColumn("ingest_date", F.lit("2024-01-01").cast("date"))
    second = d.raw("field_cost").filter("amount_usd > 500").withColumns({
        "ingest_date": F.lit("2024-01-02").cast("date"), "amount_usd": F.col("amount_usd") + 1})
    columns = ["cost_id", "cost_date", "cost_category", "amount_usd", "field_id", "planting_id", "description"]
    df = first.unionByName(second).select(*columns, "ingest_date", "updated_at")
    return latest.latest_per_key(df, ["cost_id"], ["ingest_date", "updated_at"], columns).select(*columns, "ingest_date")


@query
def precedence_merge(d):
    return d["fact_weather_daily"].select("farm_id", "weather_date", "source", "precipitation_mm")


@query
def dedupe_keep_first(d):
    df = d.raw("field_pass").select("field_id", "observed_on", "source", "observation_id", "ndvi", "cloud_cover_pct")
    return latest.dedupe_keep_first(df, ["field_id", "observed_on", "source"], ["observation_id", "ndvi", "cloud_cover_pct"])


@query
def replacing_key_collapse(d):
    df = d["fact_irrigation"].select("field_id", "event_ts", "irrigation_id", "depth_mm")
    return latest.latest_per_key(df, ["field_id", "event_ts"], ["irrigation_id"])


@query
def catalogue_diff(d):
    """The catalogue the seed lots carry against one with two entries changed."""
    lots = _from_lots(d, "dim_crop", "crop", "src_crop_lot")
    changed = d["dim_crop"].withColumn("cycle_days", F.when(F.col("crop_code").isin("rice", "maize"), F.col("cycle_days") + 1).otherwise(F.col("cycle_days")))
    return quality.catalogue_diff(lots, changed, ("lots", "catalogue")).select("side", "crop_code", "cycle_days")


def _from_lots(d, dataset, source, adapter):
    return conform.conform(SPECS[dataset], lambda n: d[adapter] if n == source else d.raw(n))


# ---- contracts and audits ---------------------------------------------------
def _dirty(d):
    """The broken feed in the contract's columns."""
    df = d["src_dirty_reading"].withColumn("soil_moisture_pct", F.col("moisture_units").cast("double") / 100)
    return df.select(*contract("fact_sensor_reading").columns)


def _flagged(d):
    return quality.flag_failures(_dirty(d), contract("fact_sensor_reading"))


def _failing(d, like):
    return _flagged(d).select("reading_id", "reading_ts", F.explode(quality.FAILURES).alias("failure")).filter(F.col("failure").like(like))


@query
def check_structure(d):
    """What is wrong with the feed's columns, and how many rows carry it."""
    feed = d["src_dirty_reading"].withColumn("battery_pct", F.col("battery_pct").cast("string"))
    found = quality.structure_problems(feed, contract("fact_sensor_reading"))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("problem")) for c, p in found])
    return feed.agg(F.expr("count(*) AS rows")).select("rows", F.inline(rows))


@query
def check_not_null(d):
    return _failing(d, "%:not_null")


@query
def check_range(d):
    return _failing(d, "%:in_range%")


@query
def check_isin(d):
    flagged = quality.flag_failures(d["dim_machine"].withColumn(
        "status", F.when(F.col("machine_id") % 10 == 3, "scrapped").otherwise(F.col("status"))), contract("dim_machine"))
    return quality.failure_summary(flagged)


@query
def check_str_length(d):
    farms = d["dim_farm"].withColumn("country_code", F.when(F.col("farm_id") % 3 == 0, F.concat("country_code", F.lit("x"))).otherwise(F.col("country_code")))
    flagged = quality.flag_failures(farms, contract("dim_farm"))
    return quality.invalid_rows(flagged).select("farm_id", "country_code")


@query
def check_unique(d):
    return _failing(d, "reading_id:unique")


@query
def split_valid_invalid(d):
    flagged = _flagged(d)
    sides = quality.valid_rows(flagged).withColumn("side", F.lit("valid")).unionByName(
        quality.invalid_rows(flagged).withColumn("side", F.lit("invalid")))
    return sides.groupBy("side", "reading_date").agg(F.expr("count(*) AS rows"), exact_sum("soil_temperature_c", "temperature"))


@query
def failure_summary(d):
    return quality.failure_summary(_flagged(d))


@query
def rejection_gate(d):
    """Rate and verdict of each day's rows."""
    flagged = _flagged(d)
    df = flagged.groupBy("reading_date").agg(
        F.expr("count(*) AS rows_in"), F.count_if(F.size(quality.FAILURES) > 0).alias("rows_rejected"))
    rate = F.col("rows_rejected") / F.col("rows_in")
    return df.withColumns({"rejection_rate": F.round(rate, 6), "passes": rate <= quality.MAX_REJECTION_RATE})


@query
def quarantine_write(d):
    lake = _lake(d, "quarantine")
    bad = quality.invalid_rows(_flagged(d))
    lake.write_partition(bad.filter("reading_date < '2024-01-15'"), "quarantine", "reading", "logical_date", "2024-01-31")
    lake.write_partition(bad, "quarantine", "reading", "logical_date", "2024-01-31")
    return lake.read("quarantine", "reading")


@query
def quarantine_report(d):
    return quality.quarantine_report(_flagged(d), "conformed.fact_sensor_reading", "2024-01-31")


@query
def raw_validation(d):
    """Extracts held to their raw contracts: a snapshot, and two batches of one
    day. What each quarantined, by column and check, with the rows still there."""
    day = dt.date(2024, 1, 31)

    def source(until):
        def read(name):
            df = d.raw(name)
            if name == "machine":
                return df.withColumn("machine_code", F.when(F.col("machine_id") % 25 == 3, None).otherwise(F.col("machine_code")))
            bad = F.when(F.col("reading_id") % 40 == 7, F.lit("NaN").cast("double")).otherwise(F.col("soil_ph"))
            return df.withColumn("soil_ph", bad).filter(F.col("updated_at") < ts(until))
        return read

    root = scratch_dir(d.spark, "raw")
    for until, names in (("2024-01-15", ("machine", "sensor_reading")), ("2100-01-01", ("sensor_reading",))):
        runner = jobs.Runner(d.spark, root, source(until))
        for name in names:
            runner.run(f"raw.{name}", day)
    out = None
    for name in ("machine", "sensor_reading"):
        kept = runner.lake.read("quarantine_raw", name).agg(F.expr("count(*) AS rows_kept"))
        rows = runner.lake.read("quarantine_raw_report", name).groupBy("pipeline", "column", "check").agg(
            F.expr("count(*) AS runs"), F.expr("sum(failed_rows) AS failed_rows"), F.expr("sum(rows_in) AS rows_in"))
        rows = rows.select("*", kept.scalar().alias("rows_kept"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def check_cross_column(d):
    """Order of dates and times, and no index on an unusable pass."""
    parts = [
        quality.violations(d["dim_planting"], {"harvest_after_sowing": F.col("expected_harvest_on") > F.col("planted_on")},
                           [F.expr("planting_id AS id")]),
        quality.violations(d["fact_machine_operation"], {"finish_after_start": F.col("finished_at") > F.col("started_at")},
                           [F.expr("operation_id AS id")]),
        quality.violations(d["fact_machine_fault"], {"resolved_after_occurred": F.col("resolved_at") >= F.col("occurred_at")},
                           [F.expr("fault_id AS id")]),
        quality.violations(d["fact_field_index"], {"unusable_has_no_index": F.col("usable") | F.coalesce("ndvi", "ndwi", "evi").isNull()},
                           [F.expr("observation_id AS id")]),
    ]
    return union_relaxed(*parts)


@query
def check_pattern(d):
    """Codes and seasons that do not have their form."""
    code, season = r"^[A-Z]{2,4}-\d{3,4}$", r"^\d{4}-(main|second|dry)$"
    bad_codes = d["fact_machine_fault"].filter(~F.col("fault_code").rlike(code)).select(F.expr("fault_id AS id"), F.expr("fault_code AS value"))
    bad_seasons = d.raw("planting").filter(~F.col("season").rlike(season)).select(F.expr("planting_id AS id"), F.expr("season AS value"))
    return bad_codes.unionByName(bad_seasons)


REFERENCES = [
    quality.Reference("dim_field", "farm_id", "dim_farm", "farm_id"),
    quality.Reference("dim_planting", "field_id", "dim_field", "field_id"),
    quality.Reference("fact_field_cost", "planting_id", "dim_planting", "planting_id"),
    quality.Reference("fact_machine_operation", "planting_id", "fact_harvest", "planting_id"),
    quality.Reference("fact_machine_telemetry", "operation_id", "fact_machine_operation", "operation_id"),
    quality.Reference("fact_sensor_reading", "sensor_id", "dim_sensor", "sensor_id"),
]


@query
def check_referential(d):
    return quality.referential_report(d.__getitem__, REFERENCES)


@query
def check_composite_unique(d):
    """Natural keys held more than once: one look a day per source, one reading
    a moment per sensor and machine."""
    passes = quality.duplicate_keys(d.raw("field_pass"), ["field_id", "observed_on", "source"])
    found = passes.selectExpr("'field_pass' AS of", "concat_ws('/', field_id, observed_on, source) AS natural_key", "copies")
    for table, owner in (("sensor_reading", "sensor_id"), ("machine_telemetry", "machine_id")):
        twice = quality.duplicate_keys(d.raw(table), [owner, "reading_ts"])
        found = found.unionByName(twice.selectExpr(
            f"'{table}' AS of", f"concat_ws('/', {owner}, unix_micros(reading_ts)) AS natural_key", "copies"))
    return found


@query
def reconcile_amounts(d):
    """Amounts that do not follow from their factors, and plantings whose
    booked fertilizer is off what was applied by more than a hundredth."""
    revenue = quality.mismatched_rows(d["fact_harvest"], F.col("yield_tonnes") * F.col("price_usd_per_tonne"), "revenue_usd", 0.02,
                                      [F.lit("revenue").alias("kind"), F.expr("harvest_id AS id")]).withColumnRenamed("revenue_usd", "amount")
    inputs = quality.mismatched_rows(d["fact_input_application"], F.col("quantity_kg") * F.col("unit_cost_usd_per_kg"), "total_cost_usd", 0.02,
                                     [F.lit("input").alias("kind"), F.expr("application_id AS id")]).withColumnRenamed("total_cost_usd", "amount")
    applied = d["fact_input_application"].filter("input_type = 'fertilizer' and planting_id is not null").groupBy("planting_id").agg(exact_sum("total_cost_usd", "applied"))
    booked = d["fact_field_cost"].filter("cost_category = 'fertilizer' and planting_id is not null").groupBy("planting_id").agg(exact_sum("amount_usd", "booked"))
    off = applied.join(booked, "planting_id").filter("applied > 0 and booked > 0 and abs(booked - applied) > applied * 0.01D")
    ledger = off.select(F.lit("fertilizer").alias("kind"), F.expr("planting_id AS id"), F.expr("booked AS amount"))
    return union_relaxed(revenue, inputs, ledger)


@query
def check_parked_no_fuel(d):
    return quality.violations(d["fact_machine_telemetry"].filter("not engine_running"),
                              {"burns_fuel": F.col("fuel_rate_l_per_h") == 0, "turns": F.col("engine_rpm") == 0}, ["telemetry_id"])


@query
def check_retired_silent(d):
    retired = d["dim_machine"].filter("status = 'retired'").select("machine_id")
    heard = d["fact_machine_telemetry"].groupBy("machine_id").agg(F.expr("count(*) AS readings"))
    return heard.join(retired, "machine_id", "left_semi")


@query
def check_within_cycle(d):
    """Irrigation outside its planting's cycle (one day of grace)."""
    cycle = d["dim_planting"].select("planting_id", "planted_on", "expected_harvest_on")
    inside = F.col("event_date").between(F.col("planted_on"), F.date_add("expected_harvest_on", 1))
    return d["fact_irrigation"].join(cycle, "planting_id").filter(~inside).select("irrigation_id", "planting_id", "event_date")


@query
def check_label_unique(d):
    return quality.labels_used_twice(d["dim_field"], "field_name", "field_code")


MAX_OPERATION_HOURS = 12.0


@query
def check_max_duration(d):
    return d["fact_machine_operation"].filter(F.col("duration_hours") > MAX_OPERATION_HOURS + 0.01).select("operation_id", "duration_hours")


@query
def check_crop_continuity(d):
    """Fields that grow a perennial next to anything else."""
    df = _planted(d).groupBy("field_id").agg(F.expr("max(is_perennial) AS perennial"), F.expr("count(DISTINCT crop_code) AS crops"))
    return df.filter("perennial and crops > 1").select("field_id", "crops")


@query
def compare_snapshots(d):
    """The weather fact before and after the same run is repeated."""
    lake = _lake(d, "rerun")
    lake.replace(d["fact_weather_daily"], "conformed", "weather")
    before = lake.read("conformed", "weather")
    lake.replace(d["fact_weather_daily"], "conformed", "weather")
    after = lake.read("conformed", "weather")
    changed = quality.catalogue_diff(before, after).groupBy("farm_id").agg(F.expr("count(*) AS rows_changed"))
    counts = quality.compare_counts(before, after, ["farm_id"])
    return counts.join(changed, "farm_id", "left").withColumn("rows_changed", F.coalesce("rows_changed", F.lit(0)))


# ---- scalar functions -------------------------------------------------------
@query
def fn_calendar(d):
    day = "to_date(reading_ts)"
    return d.raw("sensor_reading").selectExpr(
        "reading_id", f"year({day}) AS y", f"quarter({day}) AS q", f"month({day}) AS m", f"dayofmonth({day}) AS dom",
        f"{iso_weekday(day)} AS dow", f"weekofyear({day}) AS iso_week", f"date_format({day}, 'MMMM') AS month_name",
        f"date_format({day}, 'EEEE') AS day_name")


@query
def fn_intervals(d):
    return d.raw("machine_fault").select(
        "fault_id", F.datediff(F.to_date("resolved_at"), F.to_date("occurred_at")).alias("days"),
        (F.unix_seconds("resolved_at") - F.unix_seconds("occurred_at")).alias("seconds"))


@query
def fn_time_grain(d):
    return d.raw("planting").select(
        "planting_id", *[start_of(grain, "planted_on", grain) for grain in ("week", "month", "quarter", "day")])


@query
def fn_dense_dates(d):
    """Every day of each planting's cycle, counted by month."""
    days = d.raw("planting").select(F.explode(F.sequence("planted_on", "expected_harvest_on")).alias("day"))
    return days.groupBy(start_of("month", "day", "month")).agg(F.expr("count(*) AS planting_days"))


@query
def fn_numeric(d):
    m = F.col("soil_moisture_pct")
    return d.raw("sensor_reading").select(
        "reading_id", F.least(m, F.col("battery_pct")).alias("low"), F.greatest(m, F.col("battery_pct")).alias("high"),
        rounded("exp(-soil_moisture_pct / 10)", 4, "decay"), rounded("pow(soil_ph, 1.5D)", 4, "power"),
        rounded("cos(soil_ph)", 4, "cosine"), F.expr(f"{agronomy.clamp('soil_moisture_pct', 10.0, 40.0)} AS clamped"))


@query
def fn_nulls(d):
    return d.raw("machine_fault").select(
        "fault_id", F.coalesce("repair_cost_usd", F.lit(0.0)).alias("cost"), F.nullif(F.col("downtime_hours"), F.lit(0.0)).alias("downtime"),
        F.when(F.col("resolved_at").isNull(), "open").otherwise("closed").alias("state"))


@query
def fn_text(d):
    c = strip_text("soil_type")
    return d.raw("field").select(
        "field_id", *[F.expr(e) for e in (f"{c} AS stripped", f"lower({c}) AS low", f"upper({c}) AS up", "length(soil_type) AS chars")],
        F.col("field_code").rlike(r"^FD-\d{8} $").alias("matches"))


@query
def fn_unnest_arrays(d):
    return views.unpivot_fixed(d["fact_sensor_reading"], ["reading_id"],
                               {"ph": "soil_ph", "ec": "soil_ec_ds_m", "battery": "battery_pct"}, "channel", "value")


@query
def fn_json_rows(d):
    """Each reading's channels as a JSON document, parsed back to rows."""
    channels = F.array(*[F.struct(F.lit(n).alias("channel"), F.col(c).alias("value")) for n, c in
                         (("ph", "soil_ph"), ("moisture", "soil_moisture_pct"))])
    docs = d["fact_sensor_reading"].select("reading_id", F.to_json(F.struct(channels.alias("rows"))).alias("doc"))
    parsed = F.from_json("doc", "rows array<struct<channel: string, value: double>>")
    return docs.select("reading_id", F.inline(parsed["rows"]))


# ---- composed datasets ------------------------------------------------------
def _dataset(name):
    return lambda d: d[name]


for _name in SPECS:
    QUERIES[f"silver_{_name}"] = _dataset(_name)
QUERIES["silver_fact_weather_daily"] = _dataset("fact_weather_daily")
# Reference tables as the seed lots and soil surveys deliver them.
QUERIES["silver_dim_crop"] = lambda d: _from_lots(d, "dim_crop", "crop", "src_crop_lot")
QUERIES["silver_dim_crop_variety"] = lambda d: _from_lots(d, "dim_crop_variety", "crop_variety", "src_variety_lot")
QUERIES["silver_dim_soil_type"] = lambda d: _from_lots(d, "dim_soil_type", "soil_type", "src_soil_survey")
for _name in ("field_soil_daily", "dim_date", "field_weather_daily", "field_crop_health_daily", "field_irrigation_daily",
              "machine_daily", "planting_economics"):
    QUERIES[f"gold_{_name}"] = _dataset(_name)
for _name in views.VIEWS:
    QUERIES[_name] = _dataset(_name)


# ---- streaming --------------------------------------------------------------
@query
def stream_incremental_bronze(d):
    """Two landings, the stream run after each; nothing is taken twice."""
    root = scratch_dir(d.spark, "stream")
    source = d.raw("sensor_reading")
    for rule in ("updated_at < '2024-01-15'", "updated_at >= '2024-01-15'"):
        source.filter(rule).write.mode("append").parquet(f"{root}/landing")
        increments.stream_to_raw(d.spark, f"{root}/landing", source.schema, f"{root}/raw", f"{root}/checkpoint")
    increments.stream_to_raw(d.spark, f"{root}/landing", source.schema, f"{root}/raw", f"{root}/checkpoint")
    return d.spark.read.schema(source.schema).parquet(f"{root}/raw")


@query
def stream_weekly_rollup(d):
    root = scratch_dir(d.spark, "weekly")
    soil = d["field_soil_daily"]
    for rule in ("dayofmonth(reading_date) <= 10", "dayofmonth(reading_date) > 10"):
        soil.filter(rule).write.mode("append").parquet(f"{root}/landing")
        increments.stream_weekly_states(d.spark, f"{root}/landing", soil.schema, f"{root}/states", f"{root}/checkpoint", every=1)
    return increments.weekly_from_states(d.spark, f"{root}/states")


# ---- metrics and charts -----------------------------------------------------
METRIC_QUERIES = {
    "metrics_soil": ("field_soil_daily", "region"),
    "metrics_crop_health": ("field_crop_health_daily", "crop_name"),
    "metrics_irrigation": ("field_irrigation_daily", "region"),
    "metrics_water": ("v_field_water_daily", "region"),
    "metrics_machine": ("machine_daily", "machine_type"),
    "metrics_utilisation": ("v_machine_utilisation", "machine_type"),
    "metrics_economics": ("planting_economics:harvest+costs+irrigation+weather", "crop_name"),
    "metrics_cost": ("v_planting_cost_breakdown", "category"),
    "metrics_locations": ("v_farm_field_locations", "entity_type"),
}


def _metrics(dataset, by):
    measured = dataset.partition(":")[0]
    return lambda d: metrics.metric_query(d[dataset], measured, list(metrics.METRICS[measured]), [by])


def _chart(name):
    return lambda d: charts.run_chart(name, d.__getitem__)


for _name, (_dataset_name, _by) in METRIC_QUERIES.items():
    QUERIES[_name] = _metrics(_dataset_name, _by)
for _name in charts.CHARTS:
    QUERIES[_name] = _chart(_name)


# ---- agronomy ---------------------------------------------------------------
@query
def crop_gdd_daily(d):
    return features.crop_gdd_daily(_planted(d), d["fact_weather_daily"])


@query
def crop_gdd_ratio(d):
    return features.crop_gdd_ratio(_planted(d), d["fact_weather_daily"])


@query
def growth_stage(d):
    return features.growth_stages(features.observed_canopies(d["fact_field_index"], _planted(d)))


@query
def expected_ndvi(d):
    return features.ndvi_residuals(features.observed_canopies(d["fact_field_index"], _planted(d)))


@query
def derived_ndwi_evi(d):
    return features.derived_ndwi_evi(features.observed_canopies(d["fact_field_index"], _planted(d)), _water(d))


@query
def yield_factor(d):
    return features.yield_factors(_water(d), d["dim_crop_variety"])


@query
def water_stress(d):
    return _water(d).select("planting_id", "water_received_mm", "water_demand_mm", "water_stress")


@query
def residual_irrigation(d):
    return features.residual_irrigation(d["fact_sensor_reading"], d["fact_irrigation"])


def run_query(name: str, spark, folder: str) -> DataFrame:
    return QUERIES[name](FarmData(spark, folder))
