"""Typed contracts per dataset.

A contract fixes a dataset's columns, their types and what each value must
satisfy. The same declaration gives the read schema, the select list, the row
checks, the typed empty frame and the catalog DDL.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, INT, BYTE = T.LongType(), T.IntegerType(), T.ByteType()
DOUBLE, STRING, BOOL = T.DoubleType(), T.StringType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampType()


@dataclass(frozen=True)
class Rule:
    """One column: type, nullability, uniqueness and value checks. A check is
    ``(name, predicate over the column)`` and applies to non-null values."""

    name: str
    dtype: T.DataType
    nullable: bool = False
    unique: bool = False
    checks: tuple = ()


@dataclass(frozen=True)
class Contract:
    name: str
    strict: bool
    rules: tuple[Rule, ...]
    row_checks: tuple = field(default=())

    @property
    def columns(self) -> list[str]:
        return [r.name for r in self.rules]

    @property
    def unique_columns(self) -> list[str]:
        return [r.name for r in self.rules if r.unique]

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(r.name, r.dtype, True) for r in self.rules])

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema())


# -- value checks -------------------------------------------------------------
def between(low, high):
    return (f"in_range({low}, {high})", lambda c: c.between(low, high))


def above(low):
    return (f"greater_than({low})", lambda c: c > low)


def at_least(low):
    return (f"at_least({low})", lambda c: c >= low)


def one_of(*values):
    return (f"isin({', '.join(values)})", lambda c: c.isin(*values))


def length(n):
    return (f"str_length({n})", lambda c: F.length(c) == n)


def matches(pattern):
    return (f"matches({pattern})", lambda c: c.rlike(pattern))


# -- column shorthands --------------------------------------------------------
def col(name, dtype, *checks, null=False, unique=False) -> Rule:
    return Rule(name, dtype, null, unique, tuple(checks))


def ids(*names):
    return [col(n, LONG) for n in names]


def key(name):
    return col(name, LONG, unique=True)


def opt_id(name):
    return col(name, LONG, null=True)


def texts(*names, null=False):
    return [col(n, STRING, null=null) for n in names]


def days(*names):
    return [col(n, DATE) for n in names]


def stamps(*names, null=False):
    return [col(n, TS, null=null) for n in names]


def num(name, *checks, null=True):
    return col(name, DOUBLE, *checks, null=null)


def nums(*names):
    return [num(n) for n in names]


def money(*names, null=False):
    return [num(n, at_least(0), null=null) for n in names]


def counts(*names):
    return [col(n, LONG, at_least(0)) for n in names]


def percent(*names):
    return [num(n, between(0, 100)) for n in names]


def index(*names):
    return [num(n, between(-1, 1)) for n in names]


def flags(*names):
    return [col(n, BOOL) for n in names]


LATITUDE, LONGITUDE = between(-90, 90), between(-180, 180)


def point(null=False):
    return [num("latitude", LATITUDE, null=null), num("longitude", LONGITUDE, null=null)]


CONTRACTS: dict[str, Contract] = {}


def _add(name: str, *parts, strict=True, row_checks=()) -> None:
    rules = [r for p in parts for r in (p if isinstance(p, list) else [p])]
    CONTRACTS[name] = Contract(name, strict, tuple(rules), tuple(row_checks))


# -- raw extracts: shape only, extra columns are kept -------------------------
def _raw(name, *parts):
    _add("raw_" + name, *parts, strict=False)


_raw("farm", ids("farm_id"), texts("farm_code", "name", "country_code", "region"),
     nums("latitude", "longitude", "area_ha"))
_raw("field", ids("field_id"), texts("field_code"), ids("farm_id"), texts("name"), nums("area_ha"),
     texts("soil_type"), nums("latitude", "longitude"))
_raw("sensor", ids("sensor_id"), texts("sensor_code"), ids("field_id"), texts("sensor_type", "status"))
_raw("sensor_reading", ids("reading_id", "sensor_id"), stamps("reading_ts"),
     nums("soil_moisture_pct", "soil_temperature_c", "soil_ph", "soil_ec_ds_m", "battery_pct"), stamps("updated_at"))
_raw("weather", texts("farm_code"), num("latitude", null=False), num("longitude", null=False),
     days("weather_date"), col("source", STRING, one_of("archive", "forecast")),
     nums("temperature_2m_mean", "precipitation_sum", "et0_fao_evapotranspiration"))
_raw("region", texts("region_code", "name", "country_code", "macro_region"))
_raw("soil_type", texts("soil_code", "name"), nums("moisture_min_pct", "moisture_max_pct"))
_raw("crop", texts("crop_code", "name", "category"), col("water_demand_mm", INT, null=True))
_raw("crop_variety", ids("variety_id"), texts("variety_code", "crop_code", "name"))
_raw("planting", ids("planting_id", "field_id", "variety_id"), texts("season"), days("planted_on"), texts("status"))
_raw("irrigation_event", ids("irrigation_id", "field_id"), stamps("event_ts"), texts("method"),
     nums("water_volume_m3"), stamps("updated_at"))
_raw("input_application", ids("application_id", "field_id"), days("applied_on"), texts("input_type"), stamps("updated_at"))
_raw("harvest", ids("harvest_id", "planting_id", "field_id"), days("harvested_on"), nums("yield_tonnes"), stamps("updated_at"))
_raw("field_cost", ids("cost_id", "field_id"), days("cost_date"), texts("cost_category"), nums("amount_usd"), stamps("updated_at"))
_raw("machine", ids("machine_id"), texts("machine_code"), ids("farm_id"), texts("machine_type"))
_raw("machine_operation", ids("operation_id", "machine_id", "field_id"), texts("operation_type"),
     stamps("started_at", "finished_at", "updated_at"))
_raw("machine_telemetry", ids("telemetry_id", "machine_id"), stamps("reading_ts", "updated_at"))
_raw("machine_fault", ids("fault_id", "machine_id"), stamps("occurred_at"), texts("fault_code", "severity"), stamps("updated_at"))
_raw("field_index_observation", ids("observation_id", "field_id"), days("observed_on"), texts("source"), stamps("updated_at"))

# -- conformed tables ---------------------------------------------------------
_add("dim_farm", key("farm_id"), col("farm_code", STRING, unique=True), texts("farm_name"),
     col("country_code", STRING, length(2)), texts("region"), point(), num("area_ha", above(0), null=False))
_add("dim_field", key("field_id"), col("field_code", STRING, unique=True), ids("farm_id"),
     texts("farm_code", "field_name"), num("area_ha", above(0), null=False), texts("soil_type"), point())
_add("dim_sensor", key("sensor_id"), col("sensor_code", STRING, unique=True), ids("field_id"), texts("field_code"),
     ids("farm_id"), texts("sensor_type", "model"), col("depth_cm", INT, between(5, 200)), days("installed_on"),
     col("status", STRING, one_of("active", "faulty", "decommissioned")))
_add("fact_sensor_reading", key("reading_id"), ids("sensor_id", "field_id", "farm_id"), stamps("reading_ts"),
     days("reading_date"), percent("soil_moisture_pct"), num("soil_temperature_c", between(-20, 70)),
     num("soil_ph", between(0, 14)), num("soil_ec_ds_m", between(0, 20)), percent("battery_pct"))
_add("dim_region", col("region_code", STRING, unique=True), texts("region_name"), col("country_code", STRING, length(2)),
     texts("country_name", "macro_region", "rainfall_pattern"))
_add("dim_soil_type", col("soil_code", STRING, unique=True), texts("soil_name"),
     num("moisture_min_pct", between(0, 100), null=False), num("moisture_max_pct", between(0, 100), null=False),
     texts("drainage"),
     row_checks=[("moisture_band", lambda: F.col("moisture_min_pct") < F.col("moisture_max_pct"))])
_add("dim_crop", col("crop_code", STRING, unique=True), texts("crop_name", "category"), flags("is_perennial"),
     num("base_temp_c", between(-5, 30), null=False), col("gdd_to_maturity", INT, above(0)),
     col("cycle_days", INT, above(0)), col("water_demand_mm", INT, above(0)), num("peak_ndvi", between(0, 1), null=False))
_add("dim_crop_variety", key("variety_id"), col("variety_code", STRING, unique=True), texts("crop_code", "variety_name"),
     col("maturity_days", INT, above(0)), num("yield_potential_t_ha", above(0), null=False),
     col("drought_tolerance", STRING, one_of("low", "moderate", "high")))
_add("dim_planting", key("planting_id"), ids("field_id", "farm_id", "variety_id"), texts("season"),
     days("planted_on", "expected_harvest_on"), num("area_ha", above(0), null=False), nums("seed_rate_kg_ha"),
     col("status", STRING, one_of("growing", "harvested", "failed", "terminated")))
_add("fact_irrigation", key("irrigation_id"), ids("field_id", "farm_id"), opt_id("planting_id"), stamps("event_ts"),
     days("event_date"), col("method", STRING, one_of("drip", "sprinkler", "furrow", "flood", "pivot")),
     texts("water_source"), num("water_volume_m3", above(0), null=False), num("depth_mm", between(0, 500), null=False),
     col("duration_minutes", INT, above(0)), num("energy_kwh", at_least(0)))
_add("fact_input_application", key("application_id"), ids("field_id", "farm_id"), opt_id("planting_id"),
     days("applied_on"), col("input_type", STRING, one_of("fertilizer", "pesticide", "herbicide", "fungicide", "lime")),
     texts("product_name", "application_method"), num("rate_kg_ha", above(0), null=False),
     num("quantity_kg", above(0), null=False), money("unit_cost_usd_per_kg", "total_cost_usd", null=True))
_add("fact_harvest", key("harvest_id"), col("planting_id", LONG, unique=True), ids("field_id", "farm_id"),
     days("harvested_on"), num("area_harvested_ha", above(0), null=False), money("yield_tonnes"),
     num("yield_t_ha", between(0, 500), null=False), percent("moisture_pct"),
     col("quality_grade", STRING, one_of("A", "B", "C", "reject")), money("price_usd_per_tonne", "revenue_usd", null=True))
_add("fact_field_cost", key("cost_id"), ids("field_id", "farm_id"), opt_id("planting_id"), days("cost_date"),
     col("cost_category", STRING, one_of("seed", "fertilizer", "crop_protection", "irrigation", "fuel", "labour",
                                         "machinery", "other")),
     money("amount_usd"), texts("description", null=True))
_add("dim_machine", key("machine_id"), col("machine_code", STRING, unique=True), ids("farm_id"),
     texts("machine_type", "manufacturer", "model"), col("year_built", INT, between(1900, 2100)),
     col("rated_power_hp", INT, above(0)), days("purchase_date"), money("engine_hours_at_purchase"),
     col("status", STRING, one_of("active", "maintenance", "retired")))
_add("fact_machine_operation", key("operation_id"), ids("machine_id", "field_id", "farm_id"), opt_id("planting_id"),
     texts("operation_type"), stamps("started_at", "finished_at"), days("operation_date"),
     num("duration_hours", above(0), null=False), num("area_covered_ha", above(0), null=False),
     money("fuel_used_litres"), money("distance_km", null=True), texts("operator_name", null=True))
_add("fact_machine_telemetry", key("telemetry_id"), ids("machine_id", "farm_id"), opt_id("operation_id"),
     stamps("reading_ts"), days("reading_date"), money("engine_hours"), flags("engine_running", "is_idle"),
     percent("fuel_level_pct"), num("fuel_rate_l_per_h", between(0, 500)), num("engine_temp_c", between(-40, 200)),
     col("engine_rpm", INT, between(0, 10000), null=True), num("speed_kmh", between(0, 200)), point(null=True))
_add("fact_machine_fault", key("fault_id"), ids("machine_id", "farm_id"), stamps("occurred_at"), days("occurred_date"),
     texts("fault_code"), col("severity", STRING, one_of("info", "warning", "critical")), texts("description"),
     stamps("resolved_at", null=True), flags("is_open"), money("downtime_hours", "repair_cost_usd", null=True))
_add("fact_field_index", key("observation_id"), ids("field_id", "farm_id"), opt_id("planting_id"), days("observed_on"),
     col("source", STRING, one_of("satellite", "drone", "aerial")), texts("platform", null=True),
     index("ndvi", "ndwi", "evi"), percent("cloud_cover_pct"), num("resolution_m", above(0), null=False), flags("usable"))
_add("fact_weather_daily", ids("farm_id"), texts("farm_code"), days("weather_date"),
     col("source", STRING, one_of("archive", "forecast")), flags("is_actual"), point(),
     *[num(n, between(-90, 60)) for n in ("temp_max_c", "temp_min_c", "temp_mean_c")],
     *[num(n, between(0, 2000)) for n in ("precipitation_mm", "rain_mm")],
     num("precipitation_hours", between(0, 24)), num("et0_mm", between(0, 30)),
     num("solar_radiation_mj_m2", between(0, 60)), num("wind_speed_max_kmh", between(0, 500)),
     col("weather_code", INT, null=True))

# -- marts --------------------------------------------------------------------
_add("field_soil_daily", days("reading_date"), ids("farm_id"), texts("farm_code", "farm_name", "country_code", "region"),
     ids("field_id"), texts("field_code", "field_name", "soil_type"), num("field_area_ha", above(0), null=False),
     col("active_sensors", LONG, above(0)), col("reading_count", LONG, above(0)),
     percent("avg_soil_moisture_pct", "min_soil_moisture_pct", "max_soil_moisture_pct"),
     num("avg_soil_temperature_c", between(-20, 70)), num("avg_soil_ph", between(0, 14)),
     num("avg_soil_ec_ds_m", between(0, 20)), percent("min_battery_pct"),
     col("moisture_stress", STRING, one_of("dry", "optimal", "wet", "unknown")))
_add("dim_date", col("date_key", DATE, unique=True), col("year", INT), col("quarter", BYTE, between(1, 4)),
     col("month", BYTE, between(1, 12)), texts("month_name"), col("day_of_month", BYTE, between(1, 31)),
     col("day_of_week", BYTE, between(1, 7)), texts("day_name"), col("iso_week", BYTE, between(1, 53)), flags("is_weekend"))
_add("field_weather_daily", days("weather_date"), ids("field_id"), texts("field_code"), ids("farm_id"),
     texts("farm_code", "region", "country_code"), num("field_area_ha", above(0), null=False), flags("is_actual"),
     nums("temp_max_c", "temp_min_c", "temp_mean_c", "precipitation_mm", "et0_mm", "solar_radiation_mj_m2"),
     num("gdd_base10", between(0, 40)), nums("gdd_cumulative", "rainfall_7d_mm", "rainfall_30d_mm", "et0_7d_mm",
                                             "water_balance_mm", "water_balance_7d_mm"),
     col("aridity_flag", STRING, one_of("wet", "balanced", "dry", "unknown")))
_add("field_crop_health_daily", days("observed_on"), ids("field_id"), texts("field_code", "field_name"), ids("farm_id"),
     texts("farm_code", "region", "country_code", "soil_type"), num("field_area_ha", above(0), null=False),
     opt_id("planting_id"), texts("season", "crop_code", "crop_name", "crop_category", "variety_code", null=True),
     col("days_after_sowing", INT, null=True), num("cycle_progress_pct", between(0, 200)), counts("observation_count"),
     index("avg_ndvi", "max_ndvi", "avg_ndwi", "avg_evi"), percent("avg_cloud_cover_pct"),
     num("peak_ndvi_expected", between(0, 1)), num("ndvi_vs_expected_pct", at_least(0)),
     col("canopy_stage", STRING, one_of("bare", "developing", "peak", "senescing", "unknown")),
     col("vigour_flag", STRING, one_of("low", "normal", "high", "unknown")))
_add("field_irrigation_daily", days("water_date"), ids("field_id"), texts("field_code"), ids("farm_id"),
     texts("farm_code", "region", "country_code", "soil_type"), num("field_area_ha", above(0), null=False),
     counts("irrigation_events"), money("irrigation_mm", "water_volume_m3"), counts("irrigation_minutes"),
     nums("energy_kwh"), texts("irrigation_method"), nums("rainfall_mm", "et0_mm", "water_supplied_mm", "water_deficit_mm"),
     percent("irrigation_share_pct"), flags("is_actual"),
     col("supply_status", STRING, one_of("deficit", "balanced", "surplus", "unknown")))
_add("machine_daily", days("activity_date"), ids("machine_id"), texts("machine_code", "machine_type", "manufacturer", "model"),
     col("rated_power_hp", INT, above(0)), ids("farm_id"), texts("farm_code", "region"),
     counts("telemetry_readings", "running_readings", "idle_readings"), percent("idle_ratio_pct"),
     nums("engine_hours_end", "avg_fuel_rate_l_per_h"), percent("min_fuel_level_pct"),
     nums("max_engine_temp_c", "avg_speed_kmh"), counts("operations"),
     money("operation_hours", "area_covered_ha", "fuel_used_litres"), nums("distance_km", "fuel_per_ha"),
     counts("faults", "critical_faults", "open_faults"), money("downtime_hours", "repair_cost_usd"),
     col("utilisation_status", STRING, one_of("working", "idle", "parked", "down")))
_add("planting_economics", key("planting_id"), ids("field_id"), texts("field_code"), ids("farm_id"),
     texts("farm_code", "region", "country_code", "soil_type", "season"), days("planted_on", "expected_harvest_on"),
     texts("status", "crop_code", "crop_name", "crop_category", "variety_code", "variety_name"),
     num("area_ha", above(0), null=False), col("harvested_on", DATE, null=True),
     money("yield_tonnes", "yield_t_ha", null=True), texts("quality_grade", null=True), money("revenue_usd", null=True),
     money("cost_total_usd", "cost_seed_usd", "cost_fertilizer_usd", "cost_crop_protection_usd", "cost_irrigation_usd",
           "cost_fuel_usd", "cost_labour_usd", "cost_machinery_usd", "cost_other_usd", "cost_per_ha_usd"),
     nums("gross_margin_usd", "margin_per_ha_usd"), counts("input_applications", "irrigation_events"),
     money("irrigation_mm"), nums("rainfall_mm", "water_received_mm", "gdd_accumulated", "water_use_efficiency_t_per_100mm"),
     col("outcome", STRING, one_of("harvested", "growing", "failed", "terminated")))

MARTS = ("field_soil_daily", "dim_date", "field_weather_daily", "field_crop_health_daily",
         "field_irrigation_daily", "machine_daily", "planting_economics")


def contract(name: str) -> Contract:
    """A contract by dataset name; unknown names list the valid ones."""
    try:
        return CONTRACTS[name]
    except KeyError:
        raise KeyError(f"unknown dataset {name!r}; known: {', '.join(sorted(CONTRACTS))}") from None


def row_failures(rules: Contract) -> Column:
    """Names of the failed per-row checks, as an array per row."""
    tests = []
    for r in rules.rules:
        c = F.col(r.name)
        if not r.nullable:
            tests.append(F.when(c.isNull(), f"{r.name}:not_null"))
        if r.dtype == DOUBLE:  # fixed-point sums have no such value
            tests.append(F.when(F.isnan(c), f"{r.name}:not_nan"))
        tests += [F.when(c.isNotNull() & ~test(c), f"{r.name}:{name}") for name, test in r.checks]
    tests += [F.when(~test(), f"*:{name}") for name, test in rules.row_checks]
    if not tests:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*tests))


#: Types that may be stored where a wider one is declared.
NARROWER = {
    LONG: (T.ByteType(), T.ShortType(), INT, T.NullType()), INT: (T.ByteType(), T.ShortType(), T.NullType()),
    DOUBLE: (T.ByteType(), T.ShortType(), INT, LONG, T.FloatType(), T.NullType()), STRING: (T.NullType(),),
    DATE: (T.NullType(),), TS: (T.NullType(),), BOOL: (T.NullType(),),
}


def widened(df: DataFrame, rules: Contract) -> DataFrame:
    """Columns stored in a narrower type than declared, cast to it; a decimal
    may stand for a double, a column without any value for everything."""
    held = {f.name: f.dataType for f in df.schema.fields}

    def fits(r: Rule) -> bool:
        t = held.get(r.name)
        return t in NARROWER.get(r.dtype, ()) or (r.dtype == DOUBLE and isinstance(t, T.DecimalType))

    wider = {r.name: F.col(r.name).cast(r.dtype) for r in rules.rules if r.name in held and fits(r)}
    return df.withColumns(wider) if wider else df
