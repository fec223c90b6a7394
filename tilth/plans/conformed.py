"""Every conformed table, declared.

Facts always carry ``farm_id``, and every timestamp is accompanied by its UTC
day, because both are what later questions group by.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from tilth.contracts import contract
from tilth.functions.text import hours_between, strip_text
from tilth.operators.conform import ConformSpec, Lookup, conform
from tilth.operators.latest import precedence_merge
from tilth.operators.ranges import owner_on

FARM_OF_FIELD = Lookup("field", ("field_id",), ("farm_id",))
FARM_OF_MACHINE = Lookup("machine", ("machine_id",), ("farm_id",))


def _day(c: str) -> str:
    return f"to_date({c})"


def _spec(dataset: str, source: str, key: str, **how) -> ConformSpec:
    return ConformSpec(dataset, source, contract(dataset), dedupe_on=(key,), **how)


SPECS = {
    s.dataset: s
    for s in (
        _spec("dim_farm", "farm", "farm_id", rename={"name": "farm_name"},
              trim=("farm_code", "farm_name", "region"), upper=("country_code",)),
        _spec("dim_field", "field", "field_id", rename={"name": "field_name"},
              lookups=(Lookup("farm", ("farm_id",), ("farm_code",)),),
              trim=("field_code", "farm_code", "field_name"), lower=("soil_type",)),
        _spec("dim_sensor", "sensor", "sensor_id",
              lookups=(Lookup("field", ("field_id",), ("field_code", "farm_id")),),
              trim=("sensor_code", "field_code", "model"), lower=("sensor_type", "status")),
        # Retired sensors are left out; those marked faulty stay in, as flagged data.
        _spec("fact_sensor_reading", "sensor_reading", "reading_id", incremental=True,
              lookups=(Lookup("sensor", ("sensor_id",), ("field_id", "status")), FARM_OF_FIELD),
              keep=(f"lower({strip_text('status')}) != 'decommissioned'",),
              derive={"reading_date": _day("reading_ts")}),
        _spec("dim_region", "region", "region_code", rename={"name": "region_name"},
              trim=("region_code", "region_name", "country_name", "macro_region"),
              upper=("country_code",), lower=("rainfall_pattern",)),
        _spec("dim_soil_type", "soil_type", "soil_code", rename={"name": "soil_name"},
              trim=("soil_name",), lower=("soil_code", "drainage")),
        _spec("dim_crop", "crop", "crop_code", rename={"name": "crop_name"},
              trim=("crop_name",), lower=("crop_code", "category")),
        _spec("dim_crop_variety", "crop_variety", "variety_id", rename={"name": "variety_name"},
              trim=("variety_code", "variety_name"), lower=("crop_code", "drought_tolerance")),
        _spec("dim_planting", "planting", "planting_id", lookups=(FARM_OF_FIELD,), trim=("season",), lower=("status",)),
        _spec("dim_machine", "machine", "machine_id",
              trim=("machine_code", "manufacturer", "model"), lower=("machine_type", "status")),
        _spec("fact_irrigation", "irrigation_event", "irrigation_id", incremental=True, lookups=(FARM_OF_FIELD,),
              lower=("method", "water_source"), derive={"event_date": _day("event_ts")}),
        _spec("fact_input_application", "input_application", "application_id", incremental=True,
              lookups=(FARM_OF_FIELD,), trim=("product_name",), lower=("input_type", "application_method")),
        _spec("fact_harvest", "harvest", "harvest_id", incremental=True, lookups=(FARM_OF_FIELD,),
              trim=("quality_grade",)),
        _spec("fact_field_cost", "field_cost", "cost_id", incremental=True, lookups=(FARM_OF_FIELD,),
              lower=("cost_category",)),
        _spec("fact_machine_operation", "machine_operation", "operation_id", incremental=True,
              lookups=(FARM_OF_MACHINE,), trim=("operator_name",), lower=("operation_type",),
              derive={"operation_date": _day("started_at"),
                      "duration_hours": hours_between("started_at", "finished_at")}),
        _spec("fact_machine_telemetry", "machine_telemetry", "telemetry_id", incremental=True,
              lookups=(FARM_OF_MACHINE,), derive={"reading_date": _day("reading_ts")}),
        _spec("fact_machine_fault", "machine_fault", "fault_id", incremental=True, lookups=(FARM_OF_MACHINE,),
              trim=("fault_code", "description"), lower=("severity",),
              derive={"occurred_date": _day("occurred_at"), "is_open": "resolved_at IS NULL"}),
        _spec("fact_field_index", "field_index_observation", "observation_id", incremental=True,
              lookups=(FARM_OF_FIELD,), trim=("platform",), lower=("source",)),
    )
}

#: The same table from passes whose planting is not attached yet: what a field
#: has, its farm and its cycles, is brought at once, so passes are dealt out by field once.
FIELD_PASSES = replace(
    SPECS["fact_field_index"], source="field_pass", lookups=(Lookup("field_cycles", ("field_id",), ("farm_id", "_cycles")),),
    derive={"planting_id": owner_on("_cycles", "observed_on")})

WEATHER_NAMES = {
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "temperature_2m_mean": "temp_mean_c",
    "precipitation_sum": "precipitation_mm",
    "rain_sum": "rain_mm",
    "et0_fao_evapotranspiration": "et0_mm",
    "shortwave_radiation_sum": "solar_radiation_mj_m2",
    "wind_speed_10m_max": "wind_speed_max_kmh",
}


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Stack frames by name; Spark widens differing numeric types."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def fact_weather_daily(archive: DataFrame, forecast: DataFrame, farms: DataFrame, columns=None) -> DataFrame:
    """One row per farm and day; what was measured beats what was predicted. With
    ``columns`` the same rows with these alone: columns that follow them all
    decide nothing between copies that are level until then."""
    rules = contract("fact_weather_daily")
    if columns:
        last = 1 + max(rules.columns.index(c) for c in (*columns, "is_actual"))
        rules = replace(rules, rules=rules.rules[:last])
    known = farms.selectExpr("farm_id", f"{strip_text('farm_code')} AS farm_code")
    typed = (
        union_relaxed(archive, forecast)
        .join(known, "farm_code", "inner")
        .withColumnsRenamed(WEATHER_NAMES)
        .selectExpr("*", "source = 'archive' AS is_actual")
        .selectExpr(*[f"cast({r.name} as {r.dtype.simpleString()}) AS {r.name}" for r in rules.rules])
    )
    return precedence_merge(typed, ["farm_id", "weather_date"], "is_actual", rules.columns).select(*(columns or rules.columns))


def conformed(dataset: str, read, columns=None) -> DataFrame:
    return conform(SPECS[dataset], read, columns)
