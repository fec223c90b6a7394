"""Every dashboard chart, declared over its dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tilth.operators.metrics import metric_query, table_query


@dataclass(frozen=True)
class Chart:
    dataset: str
    metrics: tuple[str, ...] = ()
    dimensions: tuple[str, ...] = ()
    x: str | None = None
    grain: str | None = None
    where: str | None = None
    limit: int | None = None  # only where the chart is a top list
    columns: tuple[str, ...] = ()
    order_by: str | None = None
    ascending: bool = True
    parts: tuple[str, ...] = ()  # of the economics, where not all are read


CHARTS: dict[str, Chart] = {
    "chart_soil_moisture_trend": Chart("field_soil_daily", ("avg_moisture",), ("region",), "reading_date", "P1D"),
    "chart_moisture_stress_days": Chart("field_soil_daily", ("count",), ("moisture_stress",), "reading_date", "P1D"),
    "chart_current_conditions": Chart(
        "field_soil_daily", limit=200, order_by="avg_soil_moisture_pct",
        columns=("field_name", "farm_name", "region", "soil_type", "avg_soil_moisture_pct", "avg_soil_temperature_c",
                 "avg_soil_ph", "min_battery_pct", "moisture_stress")),
    "chart_moisture_vs_temperature": Chart("field_soil_daily", ("avg_moisture", "avg_temperature"), ("soil_type",),
                                           "reading_date", "P1D"),
    "chart_ndvi_trend": Chart("field_crop_health_daily", ("avg_ndvi_metric",), ("crop_name",), "observed_on", "P1W",
                              "crop_name is not null"),
    "chart_canopy_stage": Chart("field_crop_health_daily", ("count",), ("vigour_flag",), "canopy_stage",
                                where="canopy_stage != 'unknown'"),
    "chart_field_vigour": Chart(
        "field_crop_health_daily", limit=200, order_by="ndvi_vs_expected_pct",
        columns=("field_name", "farm_code", "region", "crop_name", "season", "days_after_sowing", "cycle_progress_pct",
                 "avg_ndvi", "ndvi_vs_expected_pct", "canopy_stage", "vigour_flag")),
    "chart_rainfall_vs_moisture": Chart("v_field_water_daily", ("total_rainfall", "avg_moisture"), (),
                                        "observation_date", "P1D"),
    "chart_water_balance": Chart("v_field_water_daily", ("net_water_balance",), ("region",), "observation_date", "P1W"),
    "chart_degree_days": Chart("v_field_water_daily", ("peak_gdd",), ("field_code",), "observation_date", "P1D"),
    "chart_supply_status": Chart("field_irrigation_daily", ("count",), ("supply_status",), "water_date", "P1W", "is_actual"),
    "chart_irrigation_vs_rain": Chart("field_irrigation_daily", ("irrigation_mm_total", "rainfall_mm_total"), (),
                                      "region", where="is_actual"),
    "chart_irrigation_dependence": Chart(
        "field_irrigation_daily",
        ("irrigation_share", "irrigation_mm_total", "rainfall_mm_total", "et0_mm_total", "deficit_days", "energy_kwh_total"),
        ("region", "country_code"), where="is_actual"),
    "chart_fleet_utilisation": Chart("machine_daily", ("count",), ("utilisation_status",), "activity_date", "P1W"),
    "chart_fuel_per_ha": Chart("machine_daily", ("fuel_per_ha_metric",), (), "machine_type", where="area_covered_ha > 0"),
    "chart_machine_ranking": Chart(
        "v_machine_utilisation", limit=100, order_by="fuel_per_ha", ascending=False,
        columns=("machine_code", "machine_type", "farm_code", "working_days", "idle_days", "parked_days", "down_days",
                 "operation_hours", "area_covered_ha", "fuel_per_ha", "avg_idle_ratio_pct", "critical_faults",
                 "downtime_hours", "repair_cost_usd")),
    "chart_idle_ratio": Chart("machine_daily", ("avg_idle_ratio",), ("machine_type",), "activity_date", "P1M"),
    "chart_margin_by_crop": Chart("planting_economics", ("margin_per_ha",), ("season",), "crop_name",
                                  where="outcome = 'harvested'", parts=("harvest", "costs")),
    "chart_cost_structure": Chart("v_planting_cost_breakdown", ("amount_total",), ("category",), "crop_code"),
    "chart_yield_vs_water": Chart("planting_economics", ("yield_per_ha",), ("crop_name",), "water_received_mm",
                                  where="yield_t_ha is not null and water_received_mm is not null",
                                  parts=("harvest", "irrigation", "weather")),
    "chart_economics_detail": Chart(
        "planting_economics", limit=500, order_by="margin_per_ha_usd", parts=("harvest", "costs", "irrigation", "weather"),
        columns=("field_code", "farm_code", "region", "season", "crop_name", "variety_name", "outcome", "area_ha",
                 "yield_t_ha", "revenue_usd", "cost_total_usd", "margin_per_ha_usd", "water_received_mm",
                 "water_use_efficiency_t_per_100mm")),
    "chart_location_map": Chart("v_farm_field_locations", where="longitude is not null and latitude is not null",
                                columns=("longitude", "latitude", "entity_type"), order_by="entity_type"),
}


def run_chart(name: str, read) -> DataFrame:
    c = CHARTS[name]
    df = read(f"{c.dataset}:{'+'.join(c.parts)}" if c.parts else c.dataset)
    if c.columns:
        df = df.filter(c.where) if c.where else df
        return table_query(df, list(c.columns), c.order_by, c.ascending, c.limit)
    return metric_query(df, c.dataset, list(c.metrics), list(c.dimensions), c.x, c.grain, c.where, c.limit)
