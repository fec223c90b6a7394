"""The marts: one wide row per grain.

Facts are aggregated to their grain before attributes are joined on, so the
joins move grain rows instead of raw rows. Strategy is left to table sizes and
adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.contracts import contract
from tilth.functions import agronomy, bands
from tilth.functions.exact import (
    exact_avg,
    exact_hours,
    exact_total,
    fixed_text,
    guarded_ratio,
    guarded_ratio_text,
    round_columns,
    rounded,
    unfixed_text,
    with_exprs,
)
from tilth.functions.text import iso_weekday
from tilth.operators.joins import sparse_left_join
from tilth.operators.latest import latest_per_key
from tilth.operators.ranges import window_range_sum
from tilth.sources.adapters import COST_CATEGORIES

SOIL_ROUND = ["avg_soil_moisture_pct", "min_soil_moisture_pct", "max_soil_moisture_pct",
              "avg_soil_temperature_c", "avg_soil_ph", "avg_soil_ec_ds_m", "min_battery_pct"]


def _to_contract(df: DataFrame, name: str, partial: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """The contract's columns in order, in the contract's types; with
    ``partial``, those of them that are there. ``also`` follows as it is."""
    held = dict(df.dtypes)
    wanted = [(r.name, r.dtype.simpleString()) for r in contract(name).rules if not partial or r.name in held]
    return df.selectExpr(*[n if held[n] == t else f"cast({n} as {t}) AS {n}" for n, t in wanted], *also)


def zero_fill(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Nulls that mean "none happened"."""
    def literal(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"{v}D" if isinstance(v, float) else str(v)

    return with_exprs(df, **{c: f"coalesce({c}, {literal(v)})" for c, v in fills.items()})


# -- soil ---------------------------------------------------------------------
def soil_aggregate(readings: DataFrame) -> DataFrame:
    return readings.groupBy("reading_date", "field_id", "farm_id").agg(
        F.expr("count(DISTINCT sensor_id) AS active_sensors"),
        F.expr("count(*) AS reading_count"),
        exact_avg("soil_moisture_pct", "avg_soil_moisture_pct"),
        F.expr("min(soil_moisture_pct) AS min_soil_moisture_pct"),
        F.expr("max(soil_moisture_pct) AS max_soil_moisture_pct"),
        exact_avg("soil_temperature_c", "avg_soil_temperature_c"),
        exact_avg("soil_ph", "avg_soil_ph"),
        exact_avg("soil_ec_ds_m", "avg_soil_ec_ds_m"),
        F.expr("min(battery_pct) AS min_battery_pct"),
    )


def enrich(df: DataFrame, fields: DataFrame, farms: DataFrame, field_columns, farm_columns) -> DataFrame:
    """Field and farm attributes; rows without either drop out."""
    field_side = fields.select("field_id", *field_columns)
    if "area_ha" in field_columns:
        field_side = field_side.withColumnRenamed("area_ha", "field_area_ha")
    return df.join(field_side, "field_id").join(farms.select("farm_id", *farm_columns), "farm_id")


def field_soil_daily(readings: DataFrame, fields: DataFrame, farms: DataFrame) -> DataFrame:
    df = enrich(
        soil_aggregate(readings), fields, farms,
        ["field_code", "field_name", "soil_type", "area_ha"], ["farm_code", "farm_name", "country_code", "region"],
    )
    df = df.withColumn("moisture_stress", bands.moisture_stress("avg_soil_moisture_pct"))
    return _to_contract(round_columns(df, SOIL_ROUND, 3), "field_soil_daily")


# -- weather ------------------------------------------------------------------
def dim_date(weather: DataFrame) -> DataFrame:
    """Every day from the first to the last the series covers."""
    span = weather.agg(F.expr("min(weather_date) AS a"), F.expr("max(weather_date) AS b")).filter("a is not null")
    df = with_exprs(
        span.selectExpr("explode(sequence(a, b)) AS date_key"),
        year="year(date_key)",
        quarter="quarter(date_key)",
        month="month(date_key)",
        month_name="date_format(date_key, 'MMMM')",
        day_of_month="dayofmonth(date_key)",
        day_of_week=iso_weekday("date_key"),
        day_name="date_format(date_key, 'EEEE')",
        iso_week="weekofyear(date_key)",
        is_weekend=f"{iso_weekday('date_key')} >= 6",
    )
    return _to_contract(df, "dim_date")


def _framed_sum(column: str, entity: str, day: str, preceding: str) -> str:
    frame = f"PARTITION BY {entity} ORDER BY {day} ROWS BETWEEN {preceding} PRECEDING AND CURRENT ROW"
    return unfixed_text(f"(sum({fixed_text(column)}) OVER ({frame}))")


def trailing_sum(column: str, rows: int, entity: str, day: str) -> str:
    """Sum over the last ``rows`` rows (rows, not days) of an entity's series."""
    return _framed_sum(column, entity, day, str(rows - 1))


def running_sum(column: str, entity: str, day: str) -> str:
    """Running total; a row whose own value is null stays null."""
    return f"CASE WHEN {column} IS NOT NULL THEN {_framed_sum(column, entity, day, 'UNBOUNDED')} END"


def farm_weather_series(weather: DataFrame) -> DataFrame:
    """Degree-days, water balance and their running forms, per farm and day.

    Every field of a farm shares the farm's series, so the windows run once per
    farm and are copied to fields afterwards. A farm has one row per day, which
    bounds each window by the calendar.
    """
    df = with_exprs(
        weather,
        gdd_base10=agronomy.degree_days("temp_mean_c"),
        water_balance_mm="precipitation_mm - et0_mm",
    )
    entity, day = "farm_id", "weather_date"
    df = with_exprs(
        df,
        gdd_cumulative=running_sum("gdd_base10", entity, day),
        rainfall_7d_mm=trailing_sum("precipitation_mm", 7, entity, day),
        rainfall_30d_mm=trailing_sum("precipitation_mm", 30, entity, day),
        et0_7d_mm=trailing_sum("et0_mm", 7, entity, day),
        water_balance_7d_mm=trailing_sum("water_balance_mm", 7, entity, day),
    ).withColumn("aridity_flag", bands.aridity("water_balance_mm"))
    return round_columns(df, ["gdd_base10", "gdd_cumulative", "rainfall_7d_mm", "rainfall_30d_mm", "et0_7d_mm",
                              "water_balance_mm", "water_balance_7d_mm"], 3)


def field_weather_daily(weather: DataFrame, fields: DataFrame, farms: DataFrame) -> DataFrame:
    sites = fields.select("field_id", "field_code", "farm_id", F.expr("area_ha AS field_area_ha")).join(
        farms.select("farm_id", "region", "country_code"), "farm_id"
    )
    return _to_contract(farm_weather_series(weather).join(sites, "farm_id"), "field_weather_daily")


# -- crop health --------------------------------------------------------------
def crop_health_aggregate(observations: DataFrame) -> DataFrame:
    return observations.groupBy("observed_on", "field_id", "farm_id", "planting_id").agg(
        F.expr("count(*) AS observation_count"),
        exact_avg("ndvi", "avg_ndvi"),
        F.expr("max(ndvi) AS max_ndvi"),
        exact_avg("ndwi", "avg_ndwi"),
        exact_avg("evi", "avg_evi"),
        exact_avg("cloud_cover_pct", "avg_cloud_cover_pct"),
    )


def crop_of_planting(df: DataFrame, plantings: DataFrame, varieties: DataFrame, crops: DataFrame, by: tuple[str, ...] = ("*",)) -> DataFrame:
    """What grows there, if anything: left joins keep ground between cycles. The
    crop catalogue is broadcast: its few ids, and the null of ground between
    cycles, would make a few tasks of all rows."""
    grown = varieties.select("variety_id", "variety_code", "crop_code").join(
        F.broadcast(crops.select("crop_code", "crop_name", F.expr("category AS crop_category"), "cycle_days",
                                 F.expr("peak_ndvi AS peak_ndvi_expected"))),
        "crop_code", "left",
    )
    cycles = plantings.select("planting_id", "season", "variety_id", "planted_on").join(F.broadcast(grown), "variety_id", "left")
    return sparse_left_join(df, cycles, "planting_id", by)


def field_crop_health_daily(observations, fields, farms, plantings, varieties, crops, held=None) -> DataFrame:
    """``held`` lists the fields with the farms that observations can have them
    under: their attributes are put together first, so field days are moved once
    for both."""
    df = crop_health_aggregate(observations.filter("usable"))
    attributes = ["field_code", "field_name", "soil_type", "area_ha"], ["farm_code", "region", "country_code"]
    if held is None:
        df = enrich(df, fields, farms, *attributes)
    else:
        df = df.join(enrich(held, fields, farms, *attributes), ["field_id", "farm_id"])
    df = crop_of_planting(df, plantings, varieties, crops, by=("field_id", "observed_on"))
    df = with_exprs(
        df,
        days_after_sowing="datediff(observed_on, planted_on)",
        cycle_progress_pct="datediff(observed_on, planted_on) / cycle_days * 100",
        ndvi_vs_expected_pct="avg_ndvi / peak_ndvi_expected * 100",
    )
    df = df.withColumn("canopy_stage", bands.canopy_stage("cycle_progress_pct"))
    df = df.withColumn("vigour_flag", bands.vigour("ndvi_vs_expected_pct", "canopy_stage"))
    measures = ["avg_ndvi", "max_ndvi", "avg_ndwi", "avg_evi", "avg_cloud_cover_pct", "cycle_progress_pct",
                "ndvi_vs_expected_pct"]
    return _to_contract(round_columns(df, measures, 4), "field_crop_health_daily")


# -- irrigation ---------------------------------------------------------------
def irrigation_aggregate(events: DataFrame) -> DataFrame:
    return events.groupBy("field_id", F.expr("event_date AS water_date")).agg(
        F.expr("count(*) AS irrigation_events"),
        exact_total("depth_mm", "irrigation_mm"),
        exact_total("water_volume_m3", "water_volume_m3"),
        F.expr("coalesce(sum(duration_minutes), 0) AS irrigation_minutes"),
        exact_total("energy_kwh", "energy_kwh"),
        # More than one method exactly when the extremes differ.
        F.expr("CASE WHEN min(method) != max(method) THEN 'mixed' ELSE min(method) END AS irrigation_method"),
    )


IRRIGATION_FIGURES = ("irrigation_events", "irrigation_mm", "water_volume_m3", "irrigation_minutes", "energy_kwh", "irrigation_method")


def irrigated_days(events: DataFrame) -> DataFrame:
    """(field_id, _irrigated): the days a field was irrigated, each with its
    figures; no more entries than the calendar has days."""
    days = irrigation_aggregate(events).filter("field_id is not null and water_date is not null")
    figures = F.struct(*IRRIGATION_FIGURES)
    return days.groupBy("field_id").agg(F.map_from_entries(F.collect_list(F.struct("water_date", figures))).alias("_irrigated"))


def irrigation_figures(spine: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """The irrigation mart of field days that carry their field's irrigated days;
    columns named in ``also`` stay beside it."""
    df = spine.withColumn("_day", F.expr("try_element_at(_irrigated, water_date)"))
    df = df.withColumns({c: F.col(f"_day.{c}") for c in IRRIGATION_FIGURES}).drop("_day", "_irrigated")
    df = zero_fill(df, {"irrigation_events": 0, "irrigation_mm": 0.0, "water_volume_m3": 0.0,
                        "irrigation_minutes": 0, "irrigation_method": "none"})
    df = with_exprs(df, water_supplied_mm="irrigation_mm + rainfall_mm")
    df = df.withColumns({
        "water_deficit_mm": F.expr("et0_mm - water_supplied_mm"),
        "irrigation_share_pct": guarded_ratio("irrigation_mm", "water_supplied_mm", 100.0),
    })
    df = df.withColumn("supply_status", bands.supply_status("water_deficit_mm"))
    measures = ["irrigation_mm", "water_volume_m3", "energy_kwh", "rainfall_mm", "et0_mm", "water_supplied_mm",
                "water_deficit_mm", "irrigation_share_pct"]
    return _to_contract(round_columns(df, measures, 3), "field_irrigation_daily", also=also)


SPINE = ("field_id", "field_code", "farm_id", "farm_code", "region", "country_code", "field_area_ha", "is_actual")
SPINE_WEATHER = ("weather_date AS water_date", "precipitation_mm AS rainfall_mm", "et0_mm")


def field_irrigation_daily(weather_mart: DataFrame, fields: DataFrame, events: DataFrame) -> DataFrame:
    """Every field on every day the weather covers: the days that matter most
    are those on which nothing was applied."""
    spine = weather_mart.selectExpr(*SPINE, *SPINE_WEATHER).join(fields.select("field_id", "soil_type"), "field_id")
    return irrigation_figures(spine.join(irrigated_days(events), "field_id", "left"))


def irrigation_spine(weather: DataFrame, fields: DataFrame, farms: DataFrame, events: DataFrame, also: DataFrame | None = None) -> DataFrame:
    """Field days from the farm-day series. What a field has is put beside its
    one row before its farm's days are, so the days themselves are not moved;
    ``also`` has more to put there, a row per field."""
    sites = fields.select("field_id", "field_code", "farm_id", "soil_type", F.expr("area_ha AS field_area_ha"))
    sites = sites.join(irrigated_days(events), "field_id", "left")
    if also is not None:
        sites = sites.join(also, "field_id", "left")
    sites = sites.join(farms.select("farm_id", "region", "country_code"), "farm_id")
    return weather.selectExpr("farm_id", "farm_code", "is_actual", *SPINE_WEATHER).join(sites, "farm_id")


def farm_irrigation_daily(weather: DataFrame, fields: DataFrame, farms: DataFrame, events: DataFrame) -> DataFrame:
    """``field_irrigation_daily`` from the farm-day series."""
    return irrigation_figures(irrigation_spine(weather, fields, farms, events))


# -- machinery ----------------------------------------------------------------
def telemetry_aggregate(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("machine_id", F.expr("reading_date AS activity_date")).agg(
        F.expr("count(*) AS telemetry_readings"),
        F.expr("count_if(engine_running) AS running_readings"),
        F.expr("count_if(is_idle) AS idle_readings"),
        F.expr("max(engine_hours) AS engine_hours_end"),
        exact_avg("fuel_rate_l_per_h", "avg_fuel_rate_l_per_h"),
        F.expr("min(fuel_level_pct) AS min_fuel_level_pct"),
        F.expr("max(engine_temp_c) AS max_engine_temp_c"),
        exact_avg("speed_kmh", "avg_speed_kmh"),
    )


def operations_aggregate(operations: DataFrame) -> DataFrame:
    return operations.groupBy("machine_id", F.expr("operation_date AS activity_date")).agg(
        F.expr("count(*) AS operations"),
        exact_hours("duration_hours", "operation_hours"),
        exact_total("area_covered_ha", "area_covered_ha"),
        exact_total("fuel_used_litres", "fuel_used_litres"),
        exact_total("distance_km", "distance_km"),
    )


def faults_aggregate(faults: DataFrame) -> DataFrame:
    return faults.groupBy("machine_id", F.expr("occurred_date AS activity_date")).agg(
        F.expr("count(*) AS faults"),
        F.expr("count_if(severity = 'critical') AS critical_faults"),
        F.expr("count_if(is_open) AS open_faults"),
        exact_total("downtime_hours", "downtime_hours"),
        exact_total("repair_cost_usd", "repair_cost_usd"),
    )


def machine_day_join(telemetry, operations, faults) -> DataFrame:
    """Telemetry days with that day's operations and faults, if any. All three
    arrive distributed by (machine, day), so the joins move nothing."""
    grain = ["machine_id", "activity_date"]
    return (
        telemetry_aggregate(telemetry)
        .join(operations_aggregate(operations), grain, "left")
        .join(faults_aggregate(faults), grain, "left")
    )


def machine_daily(telemetry, operations, faults, machines, farms) -> DataFrame:
    df = machine_day_join(telemetry, operations, faults)
    df = zero_fill(df, {"operations": 0, "operation_hours": 0.0, "area_covered_ha": 0.0, "fuel_used_litres": 0.0,
                        "faults": 0, "critical_faults": 0, "open_faults": 0, "downtime_hours": 0.0,
                        "repair_cost_usd": 0.0})
    df = df.withColumns({
        "idle_ratio_pct": guarded_ratio("idle_readings", "running_readings", 100.0),
        "fuel_per_ha": guarded_ratio("fuel_used_litres", "area_covered_ha"),
    })
    df = df.withColumn("utilisation_status", bands.utilisation("critical_faults", "running_readings", "area_covered_ha", "idle_ratio_pct"))
    owned = machines.select("machine_id", "machine_code", "farm_id", "machine_type", "manufacturer", "model",
                            "rated_power_hp").join(farms.select("farm_id", "farm_code", "region"), "farm_id")
    measures = ["idle_ratio_pct", "engine_hours_end", "avg_fuel_rate_l_per_h", "min_fuel_level_pct",
                "max_engine_temp_c", "avg_speed_kmh", "operation_hours", "area_covered_ha", "fuel_used_litres",
                "distance_km", "fuel_per_ha", "downtime_hours", "repair_cost_usd"]
    return _to_contract(round_columns(df.join(owned, "machine_id"), measures, 3), "machine_daily")


# -- economics ----------------------------------------------------------------
def pivot_fixed(df: DataFrame, by: str, category: str, amount: str, values, total: str, pattern: str) -> DataFrame:
    """One column per listed category (zero where absent) plus the total, in a
    single aggregation: the list is fixed, so no pass is spent finding it."""
    return df.groupBy(by).agg(
        exact_total(amount, total),
        *[exact_total(f"CASE WHEN {category} = '{v}' THEN {amount} END", pattern.format(v)) for v in values],
    )


def attributed(df: DataFrame) -> DataFrame:
    return df.filter("planting_id IS NOT NULL")


def costs_per_planting(costs: DataFrame) -> DataFrame:
    return pivot_fixed(attributed(costs), "planting_id", "cost_category", "amount_usd", COST_CATEGORIES,
                       "cost_total_usd", "cost_{}_usd")


def inputs_per_planting(inputs: DataFrame) -> DataFrame:
    return attributed(inputs).groupBy("planting_id").agg(F.expr("count(*) AS input_applications"))


def irrigation_per_planting(events: DataFrame) -> DataFrame:
    return attributed(events).groupBy("planting_id").agg(
        F.expr("count(*) AS irrigation_events"), exact_total("depth_mm", "irrigation_mm"))


def weather_per_planting(weather: DataFrame, plantings: DataFrame) -> DataFrame:
    """Rain and degree-days between sowing and expected harvest."""
    windows = plantings.select(
        "planting_id", "farm_id", "planted_on",
        F.expr("coalesce(expected_harvest_on, planted_on) AS window_end"))
    daily = with_exprs(weather, gdd_base10=agronomy.degree_days("temp_mean_c")).select(
        "farm_id", "weather_date", "precipitation_mm", rounded("gdd_base10", 3, "gdd_base10"))
    return window_range_sum(
        daily, windows, on="farm_id", day="weather_date", window_id="planting_id", start="planted_on",
        end="window_end", sums={"rainfall_mm": "precipitation_mm", "gdd_accumulated": "gdd_base10"})


def star_join(plantings, fields, farms, varieties, crops) -> DataFrame:
    grown = varieties.select("variety_id", "variety_code", "variety_name", "crop_code").join(
        F.broadcast(crops.select("crop_code", "crop_name", F.expr("category AS crop_category"))), "crop_code")
    return (
        plantings.join(F.broadcast(grown), "variety_id")
        .join(fields.select("field_id", "field_code", "soil_type"), "field_id")
        .join(farms.select("farm_id", "farm_code", "region", "country_code"), "farm_id")
    )


def last_harvest(harvests: DataFrame) -> DataFrame:
    return latest_per_key(
        harvests.select("planting_id", "harvested_on", "yield_tonnes", "yield_t_ha", "quality_grade", "revenue_usd"),
        ["planting_id"], ["harvested_on"])


@dataclass(frozen=True)
class Part:
    """One source of a planting's figures: the datasets it reads, how they come
    to a row per planting, and what stands for having no row."""

    inputs: tuple[str, ...]
    make: Callable[..., DataFrame]
    without: dict[str, object] = field(default_factory=dict)


PLANTING = ("dim_planting", "dim_field", "dim_farm", "dim_crop_variety", "dim_crop")
ECONOMICS = {
    "harvest": Part(("fact_harvest:planting_id+harvested_on+yield_tonnes+yield_t_ha+quality_grade+revenue_usd",), last_harvest),
    "costs": Part(("fact_field_cost:planting_id+cost_category+amount_usd",), costs_per_planting,
                  {"cost_total_usd": 0.0, **{f"cost_{c}_usd": 0.0 for c in COST_CATEGORIES}}),
    "inputs": Part(("fact_input_application:planting_id",), inputs_per_planting, {"input_applications": 0}),
    "irrigation": Part(("fact_irrigation:planting_id+depth_mm",), irrigation_per_planting, {"irrigation_events": 0, "irrigation_mm": 0.0}),
    "weather": Part(("fact_weather_daily:farm_id+weather_date+temp_mean_c+precipitation_mm", "dim_planting"), weather_per_planting),
}
#: Figures put together from several parts, in the order in which they build on one another.
COMBINED = (
    ("cost_per_ha_usd", {"costs"}, guarded_ratio_text("cost_total_usd", "area_ha")),
    ("gross_margin_usd", {"harvest", "costs"}, "revenue_usd - cost_total_usd"),
    ("water_received_mm", {"irrigation", "weather"}, "irrigation_mm + rainfall_mm"),
    ("margin_per_ha_usd", {"harvest", "costs"}, guarded_ratio_text("gross_margin_usd", "area_ha")),
    ("water_use_efficiency_t_per_100mm", {"harvest", "irrigation", "weather"}, guarded_ratio_text("yield_t_ha", "water_received_mm", 100.0)),
)
MEASURES = ("yield_tonnes", "yield_t_ha", "revenue_usd", "cost_total_usd", *(f"cost_{c}_usd" for c in COST_CATEGORIES), "cost_per_ha_usd",
            "gross_margin_usd", "margin_per_ha_usd", "irrigation_mm", "rainfall_mm", "water_received_mm",
            "gdd_accumulated", "water_use_efficiency_t_per_100mm")


def economics_of(star: DataFrame, sides: dict[str, DataFrame]) -> DataFrame:
    """The columns of the economics mart that some of its parts determine:
    a part nobody asks for is not in the plan."""
    df = star
    for name, side in sides.items():
        df = zero_fill(df.join(side, "planting_id", "left"), ECONOMICS[name].without)
    df = df.withColumn("outcome", F.col("status"))
    for column, needs, text in COMBINED:
        if needs <= set(sides):
            df = df.withColumn(column, F.expr(text))
    held = set(df.columns)
    return _to_contract(round_columns(df, [m for m in MEASURES if m in held], 3), "planting_economics", partial=True)


def planting_economics(plantings, fields, farms, varieties, crops, harvests, costs, inputs, events, weather) -> DataFrame:
    """``weather`` is the farm-day series: fields share it."""
    return economics_of(star_join(plantings, fields, farms, varieties, crops), {
        "harvest": last_harvest(harvests), "costs": costs_per_planting(costs), "inputs": inputs_per_planting(inputs),
        "irrigation": irrigation_per_planting(events), "weather": weather_per_planting(weather, plantings)})
