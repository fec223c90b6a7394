"""Serving views over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions.exact import (
    exact_avg,
    exact_sum,
    fixed_text,
    guarded_ratio,
    unfixed_text,
    wide_avg,
    wide_sum,
)
from tilth.functions.text import start_of
from tilth.operators.latest import latest_rows
from tilth.plans import marts
from tilth.sources.adapters import COST_CATEGORIES


# -- soil ---------------------------------------------------------------------
WEEK_KEYS = ["week_start", "field_id", "farm_id", "region", "soil_type"]


def soil_week_states(soil: DataFrame) -> DataFrame:
    """Mergeable weekly states per field: partial weeks combine as more days
    arrive. The day set holds at most seven dates."""
    return soil.groupBy(start_of("week", "reading_date", "week_start"), *WEEK_KEYS[1:]).agg(
        F.collect_set("reading_date").alias("days_state"),
        F.expr(f"sum({fixed_text('avg_soil_moisture_pct')}) AS moisture_units"),
        F.expr("count(avg_soil_moisture_pct) AS moisture_n"),
        F.expr(f"sum({fixed_text('avg_soil_temperature_c')}) AS temperature_units"),
        F.expr("count(avg_soil_temperature_c) AS temperature_n"),
        F.expr("min(min_soil_moisture_pct) AS min_state"),
        F.expr("max(max_soil_moisture_pct) AS max_state"),
        F.expr("count_if(moisture_stress = 'dry') AS dry_state"),
    )


def merge_soil_week_states(states: DataFrame) -> DataFrame:
    """Combine states of the same week and field into one state."""
    return states.groupBy(*WEEK_KEYS).agg(
        F.array_distinct(F.flatten(F.collect_set("days_state"))).alias("days_state"),
        *[F.sum(c).alias(c) for c in ("moisture_units", "moisture_n", "temperature_units", "temperature_n")],
        F.expr("min(min_state) AS min_state"),
        F.expr("max(max_state) AS max_state"),
        F.expr("sum(dry_state) AS dry_state"),
    )


def finish_soil_weeks(states: DataFrame) -> DataFrame:
    return states.select(
        *WEEK_KEYS,
        F.size("days_state").cast("bigint").alias("days_observed"),
        guarded_ratio(unfixed_text("moisture_units"), "moisture_n").alias("avg_soil_moisture_pct"),
        guarded_ratio(unfixed_text("temperature_units"), "temperature_n").alias("avg_soil_temperature_c"),
        F.expr("min_state AS min_soil_moisture_pct"),
        F.expr("max_state AS max_soil_moisture_pct"),
        F.expr("dry_state AS dry_days"),
    )


def v_field_soil_weekly(soil: DataFrame) -> DataFrame:
    return finish_soil_weeks(soil_week_states(soil))


def v_field_latest_condition(soil: DataFrame) -> DataFrame:
    return latest_rows(soil, "field_id", "reading_date").select(
        "field_id", "field_code", "field_name", "farm_code", "farm_name", "region", "soil_type", "field_area_ha",
        F.expr("reading_date AS last_reading_date"), "avg_soil_moisture_pct", "avg_soil_temperature_c",
        "avg_soil_ph", "avg_soil_ec_ds_m", "min_battery_pct", "active_sensors", "moisture_stress")


# -- water --------------------------------------------------------------------
def v_field_water_daily(weather: DataFrame, soil: DataFrame) -> DataFrame:
    """Measured rain against measured moisture; forecasts stay out."""
    measured = soil.select(
        "field_id", F.expr("reading_date AS weather_date"), "soil_type", "avg_soil_moisture_pct",
        "min_soil_moisture_pct", "max_soil_moisture_pct", "avg_soil_temperature_c", "moisture_stress",
        "active_sensors", "reading_count")
    return weather.filter("is_actual").join(measured, ["field_id", "weather_date"]).select(
        F.expr("weather_date AS observation_date"), "field_id", "field_code", "farm_code", "region",
        "country_code", "field_area_ha", "soil_type", "precipitation_mm", "rainfall_7d_mm", "et0_mm", "et0_7d_mm",
        "water_balance_mm", "water_balance_7d_mm", "gdd_base10", "gdd_cumulative", "temp_mean_c", "aridity_flag",
        "avg_soil_moisture_pct", "min_soil_moisture_pct", "max_soil_moisture_pct", "avg_soil_temperature_c",
        "moisture_stress", "active_sensors", "reading_count")


def v_field_water_monthly(water: DataFrame) -> DataFrame:
    month = start_of("month", "observation_date", "month_start")
    return water.groupBy(month, "field_id", "field_code", "farm_code", "region").agg(
        F.expr("min(field_area_ha) AS field_area_ha"),
        exact_sum("precipitation_mm", "rainfall_mm"),
        exact_sum("et0_mm", "et0_mm"),
        exact_sum("water_balance_mm", "water_balance_mm"),
        exact_avg("avg_soil_moisture_pct", "avg_soil_moisture_pct"),
        exact_avg("temp_mean_c", "avg_temp_c"),
        F.expr("max(gdd_cumulative) AS gdd_cumulative"),
        F.expr("count_if(aridity_flag = 'dry') AS dry_days"),
        F.expr("count_if(moisture_stress = 'dry') AS moisture_stressed_days"))


def v_farm_latest_weather(weather: DataFrame) -> DataFrame:
    """The latest measured day per farm. Days are unique per farm, so the day
    found among actuals is the row wanted."""
    return latest_rows(weather.filter("is_actual"), "farm_id", "weather_date").select(
        "farm_id", "farm_code", F.expr("weather_date AS last_weather_date"), "is_actual", "temp_max_c",
        "temp_min_c", "temp_mean_c", "precipitation_mm", "et0_mm", "wind_speed_max_kmh", "weather_code")


RESPONSE = ("avg_soil_moisture_pct", "min_soil_moisture_pct", "moisture_stress", "active_sensors")
SUPPLY = ("water_date", "field_id", "field_code", "farm_code", "region", "country_code", "soil_type", "field_area_ha",
          "irrigation_events", "irrigation_mm", "water_volume_m3", "energy_kwh", "irrigation_method", "rainfall_mm",
          "et0_mm", "water_supplied_mm", "water_deficit_mm", "irrigation_share_pct", "supply_status")


def v_field_water_supply_daily(weather: DataFrame, fields: DataFrame, farms: DataFrame, events: DataFrame, soil: DataFrame) -> DataFrame:
    """Water supplied with the soil's response; a day without readings has none.
    A field's days with readings stand beside its one row, as its irrigated days do."""
    read = soil.filter("field_id is not null and reading_date is not null").groupBy("field_id").agg(
        F.collect_list(F.struct("reading_date", *RESPONSE)).alias("_read"))
    spine = marts.irrigation_spine(weather.filter("is_actual"), fields, farms, events, read)
    df = marts.irrigation_figures(spine, also=("_read",)).withColumn(
        "_response", F.explode_outer(F.expr("filter(_read, x -> x.reading_date = water_date)")))
    return df.select(*SUPPLY, *[F.col(f"_response.{c}") for c in RESPONSE])


def v_field_irrigation_monthly(irrigation: DataFrame) -> DataFrame:
    month = start_of("month", "water_date", "month_start")
    sums = ["irrigation_mm", "water_volume_m3", "energy_kwh", "rainfall_mm", "et0_mm", "water_supplied_mm",
            "water_deficit_mm"]
    # The farm of a field is among the keys since the days lie by farm: they are summed where they are.
    df = irrigation.filter("is_actual").groupBy(month, "field_id", "farm_id", "field_code", "farm_code", "region").agg(
        F.expr("min(field_area_ha) AS field_area_ha"),
        F.expr("sum(irrigation_events) AS irrigation_events"),
        *[exact_sum(c, c) for c in sums],
        F.expr("count_if(supply_status = 'deficit') AS deficit_days")).drop("farm_id")
    share = guarded_ratio("irrigation_mm", "water_supplied_mm", 100.0)
    return df.withColumn("irrigation_share_pct", share)


# -- canopy -------------------------------------------------------------------
def v_field_latest_crop_health(health: DataFrame) -> DataFrame:
    return latest_rows(health, "field_id", "observed_on").select(
        "field_id", "field_code", "field_name", "farm_code", "region", "soil_type", "field_area_ha",
        F.expr("observed_on AS last_observed_on"), "crop_code", "crop_name", "season", "days_after_sowing",
        "cycle_progress_pct", "avg_ndvi", "ndvi_vs_expected_pct", "canopy_stage", "vigour_flag")


def v_planting_ndvi_curve(health: DataFrame) -> DataFrame:
    return health.filter("planting_id is not null").select(
        "planting_id", "crop_code", "crop_name", "season", "region", "field_code", "observed_on",
        "days_after_sowing", "cycle_progress_pct", "canopy_stage", "avg_ndvi", "peak_ndvi_expected",
        "ndvi_vs_expected_pct")


# -- machinery ----------------------------------------------------------------
def v_machine_utilisation(machines: DataFrame) -> DataFrame:
    df = machines.groupBy("machine_id", "machine_code", "machine_type", "manufacturer", "model", "farm_code",
                          "region").agg(
        F.expr("min(activity_date) AS first_active_on"),
        F.expr("max(activity_date) AS last_active_on"),
        F.expr("count(*) AS days_observed"),
        *[F.expr(f"count_if(utilisation_status = '{s}') AS {s}_days") for s in ("working", "idle", "parked", "down")],
        *[exact_sum(c, c) for c in ("operation_hours", "area_covered_ha", "fuel_used_litres")],
        exact_avg("idle_ratio_pct", "avg_idle_ratio_pct"),
        F.expr("sum(faults) AS faults"),
        F.expr("sum(critical_faults) AS critical_faults"),
        exact_sum("downtime_hours", "downtime_hours"),
        exact_sum("repair_cost_usd", "repair_cost_usd"))
    return df.withColumn("fuel_per_ha", guarded_ratio("fuel_used_litres", "area_covered_ha"))


def v_machine_attention(machines: DataFrame) -> DataFrame:
    """Machines whose faults are still open, whenever they were raised."""
    return machines.groupBy("machine_id", "machine_code", "machine_type", "farm_code", "region").agg(
        F.expr("sum(open_faults) AS open_faults"),
        F.expr("sum(critical_faults) AS critical_faults"),
        exact_sum("downtime_hours", "downtime_hours"),
        exact_sum("repair_cost_usd", "repair_cost_usd"),
        F.expr("max(CASE WHEN open_faults > 0 THEN activity_date END) AS last_fault_on"),
        F.expr("max(activity_date) AS last_activity_date"),
        F.expr("max_by(utilisation_status, activity_date) AS current_status"),
    ).filter("open_faults > 0")


# -- economics ----------------------------------------------------------------
def v_crop_season_economics(economics: DataFrame) -> DataFrame:
    """Per-hectare figures are ratios of totals; yield counts only the area
    that was harvested, margin the whole area."""
    harvested_area = "CASE WHEN yield_t_ha IS NULL THEN 0D ELSE area_ha END"
    df = economics.groupBy("season", "crop_code", "crop_name", "crop_category", "region", "country_code").agg(
        F.expr("count(*) AS plantings"),
        F.expr("count_if(outcome = 'harvested') AS harvested"),
        wide_sum("area_ha", "area_ha"),
        wide_sum(harvested_area, "harvested_area_ha"),
        *[wide_sum(c, c) for c in ("yield_tonnes", "revenue_usd", "cost_total_usd", "gross_margin_usd",
                                         "irrigation_mm", "rainfall_mm")],
        wide_avg("water_use_efficiency_t_per_100mm", "water_use_efficiency_t_per_100mm"),
        wide_avg("gdd_accumulated", "gdd_accumulated"))
    return df.withColumns({
        "yield_t_ha": guarded_ratio("yield_tonnes", "harvested_area_ha"),
        "margin_per_ha_usd": guarded_ratio("gross_margin_usd", "area_ha"),
    })


def unpivot_fixed(df: DataFrame, keep: list[str], columns: dict[str, str], name: str, value: str) -> DataFrame:
    """Wide columns to (name, value) rows, all labels kept."""
    pairs = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for label, c in columns.items()])
    return df.select(*keep, F.inline(pairs))


def v_planting_cost_breakdown(economics: DataFrame) -> DataFrame:
    keep = ["planting_id", "field_code", "farm_code", "region", "season", "crop_code", "area_ha"]
    long = unpivot_fixed(economics, [*keep, "cost_total_usd"], {c: f"cost_{c}_usd" for c in COST_CATEGORIES},
                         "category", "amount_usd")
    share = guarded_ratio("amount_usd", "cost_total_usd", 100.0)
    return long.select(*keep, "category", "amount_usd", share.alias("share_pct"))


def v_farm_scorecard(economics: DataFrame) -> DataFrame:
    sums = ["area_ha", "yield_tonnes", "revenue_usd", "cost_total_usd", "gross_margin_usd", "irrigation_mm", "rainfall_mm"]
    df = economics.groupBy("farm_id", "farm_code", "region", "country_code").agg(
        F.expr("count(*) AS plantings"), *[wide_sum(c, c) for c in sums])
    return df.withColumn("margin_per_ha_usd", guarded_ratio("gross_margin_usd", "area_ha"))


# -- places -------------------------------------------------------------------
def v_farm_field_locations(farms: DataFrame, fields: DataFrame) -> DataFrame:
    """Farms and fields as one list of points, told apart by ``entity_type``."""
    columns = ["entity_type", "entity_id", "entity_code", "entity_name", "farm_id", "farm_code", "farm_name",
               "soil_type", "country_code", "region", "latitude", "longitude", "area_ha"]
    farm_points = farms.withColumns({
        "entity_type": F.lit("farm"), "entity_id": F.col("farm_id"), "entity_code": F.col("farm_code"),
        "entity_name": F.col("farm_name"), "soil_type": F.lit(None).cast("string")})
    field_points = fields.join(farms.select("farm_id", "farm_name", "country_code", "region"), "farm_id").withColumns({
        "entity_type": F.lit("field"), "entity_id": F.col("field_id"), "entity_code": F.col("field_code"),
        "entity_name": F.col("field_name")})
    return farm_points.select(*columns).unionByName(field_points.select(*columns))


VIEWS = {
    "v_field_soil_weekly": (v_field_soil_weekly, ["field_soil_daily"]),
    "v_field_latest_condition": (v_field_latest_condition, ["field_soil_daily"]),
    "v_field_water_daily": (v_field_water_daily, ["field_weather_daily", "field_soil_daily"]),
    "v_field_water_monthly": (v_field_water_monthly, ["v_field_water_daily"]),
    "v_farm_latest_weather": (v_farm_latest_weather, ["fact_weather_daily"]),
    "v_field_latest_crop_health": (v_field_latest_crop_health, ["field_crop_health_daily"]),
    "v_planting_ndvi_curve": (v_planting_ndvi_curve, ["field_crop_health_daily"]),
    "v_field_water_supply_daily": (v_field_water_supply_daily,
                                   ["fact_weather_daily", "dim_field", "dim_farm", "fact_irrigation", "field_soil_daily"]),
    "v_field_irrigation_monthly": (v_field_irrigation_monthly, ["field_irrigation_daily"]),
    "v_machine_utilisation": (v_machine_utilisation, ["machine_daily"]),
    "v_machine_attention": (v_machine_attention, ["machine_daily"]),
    "v_crop_season_economics": (v_crop_season_economics, ["planting_economics:harvest+costs+irrigation+weather"]),
    "v_planting_cost_breakdown": (v_planting_cost_breakdown, ["planting_economics:costs"]),
    "v_farm_scorecard": (v_farm_scorecard, ["planting_economics:harvest+costs+irrigation+weather"]),
    "v_farm_field_locations": (v_farm_field_locations, ["dim_farm", "dim_field"]),
}
