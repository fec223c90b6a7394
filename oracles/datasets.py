"""SQL for every source, conformed table, mart and view."""

from __future__ import annotations

from oracles.text import A, R, S, T, newest, ratio, trim
from tilth.sources.adapters import ADAPTERS, COST_CATEGORIES, adapter_sql

LIBRARY: dict[str, str] = {name: adapter_sql(name) for name in ADAPTERS}


def table(name, sql):
    LIBRARY[name] = sql.strip()


# The planting in the ground on the day of a pass: brute force over all pairs.
table("ground_cover", """
SELECT o.field_id, o.observed_on, g.planting_id
FROM (SELECT DISTINCT field_id, observed_on FROM src_field_pass) o
JOIN src_planting g ON g.field_id = o.field_id AND o.observed_on BETWEEN g.planted_on AND g.expected_harvest_on
QUALIFY row_number() OVER (PARTITION BY o.field_id, o.observed_on ORDER BY g.planted_on, g.planting_id) = 1""")
table("src_field_index_observation", """
SELECT p.*, c.planting_id FROM src_field_pass p
LEFT JOIN ground_cover c ON c.field_id = p.field_id AND c.observed_on = p.observed_on""")

# -- conformed ----------------------------------------------------------------
table("dim_farm", f"""
SELECT farm_id, {trim('farm_code')} AS farm_code, {trim('name')} AS farm_name, upper({trim('country_code')}) AS country_code,
       {trim('region')} AS region, latitude, longitude, area_ha
FROM src_farm""")
table("dim_field", f"""
SELECT f.field_id, {trim('f.field_code')} AS field_code, f.farm_id, {trim('m.farm_code')} AS farm_code,
       {trim('f.name')} AS field_name, f.area_ha, lower({trim('f.soil_type')}) AS soil_type, f.latitude, f.longitude
FROM src_field f JOIN src_farm m ON m.farm_id = f.farm_id""")
table("dim_sensor", f"""
SELECT s.sensor_id, {trim('s.sensor_code')} AS sensor_code, s.field_id, {trim('f.field_code')} AS field_code, f.farm_id,
       lower({trim('s.sensor_type')}) AS sensor_type, {trim('s.model')} AS model, s.depth_cm, s.installed_on,
       lower({trim('s.status')}) AS status
FROM src_sensor s JOIN src_field f ON f.field_id = s.field_id""")
table("fact_sensor_reading", f"""
SELECT r.reading_id, r.sensor_id, s.field_id, f.farm_id, r.reading_ts, CAST(r.reading_ts AS DATE) AS reading_date,
       r.soil_moisture_pct, r.soil_temperature_c, r.soil_ph, r.soil_ec_ds_m, r.battery_pct
FROM src_sensor_reading r JOIN src_sensor s ON s.sensor_id = r.sensor_id JOIN src_field f ON f.field_id = s.field_id
WHERE lower({trim('s.status')}) <> 'decommissioned'""")
table("dim_region", f"""
SELECT {trim('region_code')} AS region_code, {trim('name')} AS region_name, upper({trim('country_code')}) AS country_code,
       {trim('country_name')} AS country_name, {trim('macro_region')} AS macro_region,
       lower({trim('rainfall_pattern')}) AS rainfall_pattern
FROM src_region""")
for target, source in (("dim_soil_type", "src_soil_type"), ("lot_dim_soil_type", "src_soil_survey")):
    table(target, f"""
SELECT DISTINCT lower({trim('soil_code')}) AS soil_code, {trim('name')} AS soil_name, moisture_min_pct, moisture_max_pct,
       lower({trim('drainage')}) AS drainage FROM {source}""")
for target, source in (("dim_crop", "src_crop"), ("lot_dim_crop", "src_crop_lot")):
    table(target, f"""
SELECT DISTINCT lower({trim('crop_code')}) AS crop_code, {trim('name')} AS crop_name, lower({trim('category')}) AS category,
       is_perennial, base_temp_c, gdd_to_maturity, cycle_days, water_demand_mm, peak_ndvi FROM {source}""")
for target, source in (("dim_crop_variety", "src_crop_variety"), ("lot_dim_crop_variety", "src_variety_lot")):
    table(target, f"""
SELECT DISTINCT CAST(variety_id AS BIGINT) AS variety_id, {trim('variety_code')} AS variety_code,
       lower({trim('crop_code')}) AS crop_code, {trim('name')} AS variety_name, maturity_days, yield_potential_t_ha,
       lower({trim('drought_tolerance')}) AS drought_tolerance FROM {source}""")
table("dim_planting", f"""
SELECT p.planting_id, p.field_id, f.farm_id, p.variety_id, {trim('p.season')} AS season, p.planted_on,
       p.expected_harvest_on, p.area_ha, p.seed_rate_kg_ha, lower({trim('p.status')}) AS status
FROM src_planting p JOIN src_field f ON f.field_id = p.field_id""")
table("dim_machine", f"""
SELECT machine_id, {trim('machine_code')} AS machine_code, farm_id, lower({trim('machine_type')}) AS machine_type,
       {trim('manufacturer')} AS manufacturer, {trim('model')} AS model, year_built, rated_power_hp, purchase_date,
       engine_hours_at_purchase, lower({trim('status')}) AS status
FROM src_machine""")
_IRR = ["irrigation_id", "field_id", "farm_id", "planting_id", "event_ts", "event_date", "method", "water_source",
        "water_volume_m3", "depth_mm", "duration_minutes", "energy_kwh"]
table("fact_irrigation", f"""
SELECT {', '.join(_IRR)} FROM (
  SELECT e.irrigation_id, e.field_id, f.farm_id, e.planting_id, e.event_ts, CAST(e.event_ts AS DATE) AS event_date,
         lower({trim('e.method')}) AS method, lower({trim('e.water_source')}) AS water_source, e.water_volume_m3,
         e.depth_mm, e.duration_minutes, e.energy_kwh, e.updated_at
  FROM src_irrigation_event e JOIN src_field f ON f.field_id = e.field_id) t
{newest(['irrigation_id'], ['updated_at', *_IRR])}""")
_INP = ["application_id", "field_id", "farm_id", "planting_id", "applied_on", "input_type", "product_name",
        "application_method", "rate_kg_ha", "quantity_kg", "unit_cost_usd_per_kg", "total_cost_usd"]
table("fact_input_application", f"""
SELECT {', '.join(_INP)} FROM (
  SELECT e.application_id, e.field_id, f.farm_id, e.planting_id, e.applied_on, lower({trim('e.input_type')}) AS input_type,
         {trim('e.product_name')} AS product_name, lower({trim('e.application_method')}) AS application_method,
         e.rate_kg_ha, e.quantity_kg, e.unit_cost_usd_per_kg, e.total_cost_usd, e.updated_at
  FROM src_input_application e JOIN src_field f ON f.field_id = e.field_id) t
{newest(['application_id'], ['updated_at', *_INP])}""")
table("fact_harvest", f"""
SELECT h.harvest_id, h.planting_id, h.field_id, f.farm_id, h.harvested_on, h.area_harvested_ha, h.yield_tonnes,
       h.yield_t_ha, h.moisture_pct, {trim('h.quality_grade')} AS quality_grade, h.price_usd_per_tonne, h.revenue_usd
FROM src_harvest h JOIN src_field f ON f.field_id = h.field_id""")
_COST = ["cost_id", "field_id", "farm_id", "planting_id", "cost_date", "cost_category", "amount_usd", "description"]
table("fact_field_cost", f"""
SELECT {', '.join(_COST)} FROM (
  SELECT c.cost_id, c.field_id, f.farm_id, c.planting_id, c.cost_date, lower({trim('c.cost_category')}) AS cost_category,
         c.amount_usd, c.description, c.updated_at
  FROM src_field_cost c JOIN src_field f ON f.field_id = c.field_id) t
{newest(['cost_id'], ['updated_at', *_COST])}""")
table("fact_machine_operation", f"""
SELECT o.operation_id, o.machine_id, o.field_id, m.farm_id, o.planting_id, lower({trim('o.operation_type')}) AS operation_type,
       o.started_at, o.finished_at, CAST(o.started_at AS DATE) AS operation_date,
       CAST(date_diff('second', o.started_at, o.finished_at) AS DOUBLE) / 3600 AS duration_hours, o.area_covered_ha,
       o.fuel_used_litres, o.distance_km, {trim('o.operator_name')} AS operator_name
FROM src_machine_operation o JOIN src_machine m ON m.machine_id = o.machine_id""")
table("fact_machine_telemetry", """
SELECT t.telemetry_id, t.machine_id, m.farm_id, t.operation_id, t.reading_ts, CAST(t.reading_ts AS DATE) AS reading_date,
       t.engine_hours, t.engine_running, t.is_idle, t.fuel_level_pct, t.fuel_rate_l_per_h, t.engine_temp_c, t.engine_rpm,
       t.speed_kmh, t.latitude, t.longitude
FROM src_machine_telemetry t JOIN src_machine m ON m.machine_id = t.machine_id""")
table("fact_machine_fault", f"""
SELECT x.fault_id, x.machine_id, m.farm_id, x.occurred_at, CAST(x.occurred_at AS DATE) AS occurred_date,
       {trim('x.fault_code')} AS fault_code, lower({trim('x.severity')}) AS severity, {trim('x.description')} AS description,
       x.resolved_at, x.resolved_at IS NULL AS is_open, x.downtime_hours, x.repair_cost_usd
FROM src_machine_fault x JOIN src_machine m ON m.machine_id = x.machine_id""")
_IDX = ["observation_id", "field_id", "farm_id", "planting_id", "observed_on", "source", "platform", "ndvi", "ndwi", "evi",
        "cloud_cover_pct", "resolution_m", "usable"]
table("fact_field_index", f"""
SELECT {', '.join(_IDX)} FROM (
  SELECT o.observation_id, o.field_id, f.farm_id, o.planting_id, o.observed_on, lower({trim('o.source')}) AS source,
         {trim('o.platform')} AS platform, o.ndvi, o.ndwi, o.evi, o.cloud_cover_pct, o.resolution_m, o.usable, o.updated_at
  FROM src_field_index_observation o JOIN src_field f ON f.field_id = o.field_id) t
{newest(['observation_id'], ['updated_at', *_IDX])}""")
_WX = ["farm_id", "farm_code", "weather_date", "source", "is_actual", "latitude", "longitude", "temp_max_c", "temp_min_c",
       "temp_mean_c", "precipitation_mm", "rain_mm", "precipitation_hours", "et0_mm", "solar_radiation_mj_m2",
       "wind_speed_max_kmh", "weather_code"]
table("weather_union", f"""
SELECT m.farm_id, w.farm_code, w.weather_date, w.source, w.source = 'archive' AS is_actual, w.latitude, w.longitude,
       w.temperature_2m_max AS temp_max_c, w.temperature_2m_min AS temp_min_c, w.temperature_2m_mean AS temp_mean_c,
       w.precipitation_sum AS precipitation_mm, w.rain_sum AS rain_mm, w.precipitation_hours,
       w.et0_fao_evapotranspiration AS et0_mm, w.shortwave_radiation_sum AS solar_radiation_mj_m2,
       w.wind_speed_10m_max AS wind_speed_max_kmh, w.weather_code
FROM (SELECT * FROM src_weather_archive UNION ALL SELECT * FROM src_weather_forecast) w
JOIN src_farm m ON {trim('m.farm_code')} = w.farm_code""")
table("fact_weather_daily", f"""
SELECT {', '.join(_WX)} FROM weather_union {newest(['farm_id', 'weather_date'], ['is_actual', *_WX])}""")

# -- marts --------------------------------------------------------------------
table("soil_days", f"""
SELECT reading_date, field_id, farm_id, count(DISTINCT sensor_id) AS active_sensors, count(*) AS reading_count,
       {A('soil_moisture_pct')} AS m_avg, min(soil_moisture_pct) AS m_min, max(soil_moisture_pct) AS m_max,
       {A('soil_temperature_c')} AS t_avg, {A('soil_ph')} AS ph_avg, {A('soil_ec_ds_m')} AS ec_avg, min(battery_pct) AS b_min
FROM fact_sensor_reading GROUP BY ALL""")
table("field_soil_daily", f"""
SELECT d.reading_date, d.farm_id, m.farm_code, m.farm_name, m.country_code, m.region, d.field_id, f.field_code,
       f.field_name, f.soil_type, f.area_ha AS field_area_ha, d.active_sensors, d.reading_count,
       {R('m_avg', 3)} AS avg_soil_moisture_pct, {R('m_min', 3)} AS min_soil_moisture_pct,
       {R('m_max', 3)} AS max_soil_moisture_pct, {R('t_avg', 3)} AS avg_soil_temperature_c, {R('ph_avg', 3)} AS avg_soil_ph,
       {R('ec_avg', 3)} AS avg_soil_ec_ds_m, {R('b_min', 3)} AS min_battery_pct,
       CASE WHEN m_avg IS NULL THEN 'unknown' WHEN m_avg < 15 THEN 'dry' WHEN m_avg > 38 THEN 'wet' ELSE 'optimal' END AS moisture_stress
FROM soil_days d JOIN dim_field f ON f.field_id = d.field_id JOIN dim_farm m ON m.farm_id = d.farm_id""")
table("dim_date", """
SELECT date_key, CAST(year(date_key) AS INT) AS year, CAST(quarter(date_key) AS TINYINT) AS quarter,
       CAST(month(date_key) AS TINYINT) AS month, monthname(date_key) AS month_name, CAST(day(date_key) AS TINYINT) AS day_of_month,
       CAST(isodow(date_key) AS TINYINT) AS day_of_week, dayname(date_key) AS day_name, CAST(week(date_key) AS TINYINT) AS iso_week,
       isodow(date_key) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(min(weather_date), max(weather_date), INTERVAL 1 DAY)) AS DATE) AS date_key
      FROM fact_weather_daily)""")


def _rows(n):
    return f"(PARTITION BY field_id ORDER BY weather_date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def _over(c, n):
    return f"CAST(sum(CAST({c} AS DECIMAL(18,4))) OVER {_rows(n)} AS DOUBLE)"


table("field_weather_series", """
SELECT w.weather_date, f.field_id, f.field_code, w.farm_id, w.farm_code, m.region, m.country_code, f.area_ha AS field_area_ha,
       w.is_actual, w.temp_max_c, w.temp_min_c, w.temp_mean_c, w.precipitation_mm, w.et0_mm, w.solar_radiation_mj_m2,
       CASE WHEN w.temp_mean_c IS NULL THEN NULL WHEN w.temp_mean_c <= 10 THEN 0.0 WHEN w.temp_mean_c >= 30 THEN 20.0
            ELSE w.temp_mean_c - 10.0 END AS gdd, w.precipitation_mm - w.et0_mm AS balance
FROM fact_weather_daily w JOIN dim_field f ON f.farm_id = w.farm_id JOIN dim_farm m ON m.farm_id = w.farm_id""")
table("field_weather_daily", f"""
SELECT weather_date, field_id, field_code, farm_id, farm_code, region, country_code, field_area_ha, is_actual, temp_max_c,
       temp_min_c, temp_mean_c, precipitation_mm, et0_mm, solar_radiation_mj_m2, {R('gdd', 3)} AS gdd_base10,
       CASE WHEN gdd IS NOT NULL THEN {R(_over('gdd', 'UNBOUNDED'), 3)} END AS gdd_cumulative,
       {R(_over('precipitation_mm', 6), 3)} AS rainfall_7d_mm, {R(_over('precipitation_mm', 29), 3)} AS rainfall_30d_mm,
       {R(_over('et0_mm', 6), 3)} AS et0_7d_mm, {R('balance', 3)} AS water_balance_mm,
       {R(_over('balance', 6), 3)} AS water_balance_7d_mm,
       CASE WHEN balance IS NULL THEN 'unknown' WHEN balance > 2 THEN 'wet' WHEN balance < -3 THEN 'dry' ELSE 'balanced' END AS aridity_flag
FROM field_weather_series""")
table("health_rows", f"""
SELECT o.observed_on, o.field_id, f.field_code, f.field_name, o.farm_id, m.farm_code, m.region, m.country_code, f.soil_type,
       f.area_ha AS field_area_ha, o.planting_id, p.season, c.crop_code, c.crop_name, c.category AS crop_category,
       v.variety_code, p.planted_on, c.cycle_days, c.peak_ndvi, count(*) AS n, {A('o.ndvi')} AS ndvi, max(o.ndvi) AS ndvi_max,
       {A('o.ndwi')} AS ndwi, {A('o.evi')} AS evi, {A('o.cloud_cover_pct')} AS cloud
FROM fact_field_index o JOIN dim_field f ON f.field_id = o.field_id JOIN dim_farm m ON m.farm_id = o.farm_id
LEFT JOIN dim_planting p ON p.planting_id = o.planting_id LEFT JOIN dim_crop_variety v ON v.variety_id = p.variety_id
LEFT JOIN dim_crop c ON c.crop_code = v.crop_code
WHERE o.usable GROUP BY ALL""")
table("health_scaled", """
SELECT *, date_diff('day', planted_on, observed_on) AS das, date_diff('day', planted_on, observed_on) / cycle_days * 100 AS progress,
       ndvi / peak_ndvi * 100 AS vs_peak FROM health_rows""")
table("health_staged", """
SELECT *, CASE WHEN progress IS NULL THEN 'unknown' WHEN progress < 15 THEN 'bare' WHEN progress < 45 THEN 'developing'
               WHEN progress <= 75 THEN 'peak' ELSE 'senescing' END AS stage FROM health_scaled""")
table("field_crop_health_daily", f"""
SELECT observed_on, field_id, field_code, field_name, farm_id, farm_code, region, country_code, soil_type, field_area_ha,
       planting_id, season, crop_code, crop_name, crop_category, variety_code, CAST(das AS INT) AS days_after_sowing,
       {R('progress', 4)} AS cycle_progress_pct, n AS observation_count, {R('ndvi', 4)} AS avg_ndvi, {R('ndvi_max', 4)} AS max_ndvi,
       {R('ndwi', 4)} AS avg_ndwi, {R('evi', 4)} AS avg_evi, {R('cloud', 4)} AS avg_cloud_cover_pct,
       peak_ndvi AS peak_ndvi_expected, {R('vs_peak', 4)} AS ndvi_vs_expected_pct, stage AS canopy_stage,
       CASE WHEN vs_peak IS NULL OR stage IN ('unknown', 'bare') THEN 'unknown' WHEN vs_peak < 65 THEN 'low'
            WHEN vs_peak >= 95 THEN 'high' ELSE 'normal' END AS vigour_flag
FROM health_staged""")
table("irrigation_days", f"""
SELECT field_id, event_date AS water_date, count(*) AS n, {T('depth_mm')} AS mm, {T('water_volume_m3')} AS m3,
       CAST(sum(duration_minutes) AS BIGINT) AS minutes, {T('energy_kwh')} AS kwh,
       CASE WHEN count(DISTINCT method) > 1 THEN 'mixed' ELSE min(method) END AS method
FROM fact_irrigation GROUP BY ALL""")
table("irrigation_spine", """
SELECT w.weather_date AS water_date, w.field_id, w.field_code, w.farm_id, w.farm_code, w.region, w.country_code, f.soil_type,
       w.field_area_ha, coalesce(i.n, 0) AS irrigation_events, coalesce(i.mm, 0.0) AS mm, coalesce(i.m3, 0.0) AS m3,
       coalesce(i.minutes, 0) AS irrigation_minutes, i.kwh, coalesce(i.method, 'none') AS irrigation_method,
       w.precipitation_mm AS rain, w.et0_mm AS et0, w.is_actual, coalesce(i.mm, 0.0) + w.precipitation_mm AS supplied,
       w.et0_mm - (coalesce(i.mm, 0.0) + w.precipitation_mm) AS deficit
FROM field_weather_daily w JOIN dim_field f ON f.field_id = w.field_id
LEFT JOIN irrigation_days i ON i.field_id = w.field_id AND i.water_date = w.weather_date""")
table("field_irrigation_daily", f"""
SELECT water_date, field_id, field_code, farm_id, farm_code, region, country_code, soil_type, field_area_ha,
       irrigation_events, {R('mm', 3)} AS irrigation_mm, {R('m3', 3)} AS water_volume_m3, irrigation_minutes,
       {R('kwh', 3)} AS energy_kwh, irrigation_method, {R('rain', 3)} AS rainfall_mm, {R('et0', 3)} AS et0_mm,
       {R('supplied', 3)} AS water_supplied_mm, {R('deficit', 3)} AS water_deficit_mm,
       {R(ratio('mm', 'supplied', 100), 3)} AS irrigation_share_pct, is_actual,
       CASE WHEN deficit IS NULL THEN 'unknown' WHEN deficit > 2 THEN 'deficit' WHEN deficit < -2 THEN 'surplus' ELSE 'balanced' END AS supply_status
FROM irrigation_spine""")
table("telemetry_days", f"""
SELECT machine_id, reading_date AS activity_date, count(*) AS readings, CAST(sum(CASE WHEN engine_running THEN 1 ELSE 0 END) AS BIGINT) AS running,
       CAST(sum(CASE WHEN is_idle THEN 1 ELSE 0 END) AS BIGINT) AS idle, max(engine_hours) AS hours_end, {A('fuel_rate_l_per_h')} AS rate,
       min(fuel_level_pct) AS level, max(engine_temp_c) AS temp, {A('speed_kmh')} AS speed
FROM fact_machine_telemetry GROUP BY ALL""")
table("operation_days", f"""
SELECT machine_id, operation_date AS activity_date, count(*) AS n,
       coalesce(sum(date_diff('second', started_at, finished_at)), 0) / 3600.0 AS hours, {T('area_covered_ha')} AS area,
       {T('fuel_used_litres')} AS fuel, {T('distance_km')} AS km
FROM fact_machine_operation GROUP BY ALL""")
table("fault_days", f"""
SELECT machine_id, occurred_date AS activity_date, count(*) AS n, count(*) FILTER (severity = 'critical') AS critical,
       count(*) FILTER (is_open) AS still_open, {T('downtime_hours')} AS downtime, {T('repair_cost_usd')} AS cost
FROM fact_machine_fault GROUP BY ALL""")
table("machine_days", """
SELECT t.*, coalesce(o.n, 0) AS operations, coalesce(o.hours, 0.0) AS op_hours, coalesce(o.area, 0.0) AS area,
       coalesce(o.fuel, 0.0) AS fuel, o.km, coalesce(x.n, 0) AS faults, coalesce(x.critical, 0) AS critical,
       coalesce(x.still_open, 0) AS still_open, coalesce(x.downtime, 0.0) AS downtime, coalesce(x.cost, 0.0) AS cost,
       CASE WHEN t.running > 0 THEN t.idle / t.running * 100 END AS idle_pct
FROM telemetry_days t LEFT JOIN operation_days o ON o.machine_id = t.machine_id AND o.activity_date = t.activity_date
LEFT JOIN fault_days x ON x.machine_id = t.machine_id AND x.activity_date = t.activity_date""")
table("machine_daily", f"""
SELECT d.activity_date, d.machine_id, k.machine_code, k.machine_type, k.manufacturer, k.model, k.rated_power_hp, k.farm_id,
       m.farm_code, m.region, d.readings AS telemetry_readings, d.running AS running_readings, d.idle AS idle_readings,
       {R('d.idle_pct', 3)} AS idle_ratio_pct, {R('d.hours_end', 3)} AS engine_hours_end, {R('d.rate', 3)} AS avg_fuel_rate_l_per_h,
       {R('d.level', 3)} AS min_fuel_level_pct, {R('d.temp', 3)} AS max_engine_temp_c, {R('d.speed', 3)} AS avg_speed_kmh,
       d.operations, {R('d.op_hours', 3)} AS operation_hours, {R('d.area', 3)} AS area_covered_ha,
       {R('d.fuel', 3)} AS fuel_used_litres, {R('d.km', 3)} AS distance_km, {R(ratio('d.fuel', 'd.area'), 3)} AS fuel_per_ha,
       d.faults, d.critical AS critical_faults, d.still_open AS open_faults, {R('d.downtime', 3)} AS downtime_hours,
       {R('d.cost', 3)} AS repair_cost_usd,
       CASE WHEN d.critical > 0 THEN 'down' WHEN d.running = 0 THEN 'parked'
            WHEN d.area > 0 AND d.idle_pct > 60 THEN 'idle' WHEN d.area > 0 THEN 'working' ELSE 'idle' END AS utilisation_status
FROM machine_days d JOIN dim_machine k ON k.machine_id = d.machine_id JOIN dim_farm m ON m.farm_id = k.farm_id""")
table("planting_costs", f"""
SELECT planting_id, {T('amount_usd')} AS cost_total_usd, {', '.join(
    f"coalesce(CAST(sum(CAST(amount_usd AS DECIMAL(18,4))) FILTER (cost_category = '{c}') AS DOUBLE), 0.0) AS cost_{c}_usd"
    for c in COST_CATEGORIES)}
FROM fact_field_cost WHERE planting_id IS NOT NULL GROUP BY planting_id""")
table("planting_inputs", """
SELECT planting_id, count(*) AS input_applications FROM fact_input_application WHERE planting_id IS NOT NULL GROUP BY planting_id""")
table("planting_irrigation", f"""
SELECT planting_id, count(*) AS irrigation_events, {T('depth_mm')} AS irrigation_mm
FROM fact_irrigation WHERE planting_id IS NOT NULL GROUP BY planting_id""")
table("planting_weather", f"""
SELECT p.planting_id, {T('w.precipitation_mm')} AS rainfall_mm, {T('w.gdd_base10')} AS gdd_accumulated
FROM dim_planting p JOIN field_weather_daily w ON w.field_id = p.field_id
 AND w.weather_date BETWEEN p.planted_on AND coalesce(p.expected_harvest_on, p.planted_on)
GROUP BY p.planting_id""")
_ECON_COSTS = [f"cost_{c}_usd" for c in COST_CATEGORIES]
table("economics_rows", f"""
SELECT p.*, f.field_code, f.soil_type, m.farm_code, m.region, m.country_code, v.variety_code, v.variety_name, c.crop_code,
       c.crop_name, c.category AS crop_category, h.harvested_on, h.yield_tonnes, h.yield_t_ha, h.quality_grade, h.revenue_usd,
       coalesce(k.cost_total_usd, 0.0) AS cost_total_usd, {', '.join(f'coalesce(k.{c}, 0.0) AS {c}' for c in _ECON_COSTS)},
       coalesce(n.input_applications, 0) AS input_applications, coalesce(i.irrigation_events, 0) AS irrigation_events,
       coalesce(i.irrigation_mm, 0.0) AS irrigation_mm, w.rainfall_mm, w.gdd_accumulated,
       coalesce(i.irrigation_mm, 0.0) + w.rainfall_mm AS received, h.revenue_usd - coalesce(k.cost_total_usd, 0.0) AS margin
FROM dim_planting p JOIN dim_field f ON f.field_id = p.field_id JOIN dim_farm m ON m.farm_id = p.farm_id
JOIN dim_crop_variety v ON v.variety_id = p.variety_id JOIN dim_crop c ON c.crop_code = v.crop_code
LEFT JOIN fact_harvest h ON h.planting_id = p.planting_id LEFT JOIN planting_costs k ON k.planting_id = p.planting_id
LEFT JOIN planting_inputs n ON n.planting_id = p.planting_id LEFT JOIN planting_irrigation i ON i.planting_id = p.planting_id
LEFT JOIN planting_weather w ON w.planting_id = p.planting_id""")
table("planting_economics", f"""
SELECT planting_id, field_id, field_code, farm_id, farm_code, region, country_code, soil_type, season, planted_on,
       expected_harvest_on, status, crop_code, crop_name, crop_category, variety_code, variety_name, area_ha, harvested_on,
       {R('yield_tonnes', 3)} AS yield_tonnes, {R('yield_t_ha', 3)} AS yield_t_ha, quality_grade,
       {R('revenue_usd', 3)} AS revenue_usd, {R('cost_total_usd', 3)} AS cost_total_usd,
       {', '.join(f'{R(c, 3)} AS {c}' for c in _ECON_COSTS)}, {R('cost_total_usd / area_ha', 3)} AS cost_per_ha_usd,
       {R('margin', 3)} AS gross_margin_usd, {R('margin / area_ha', 3)} AS margin_per_ha_usd, input_applications,
       irrigation_events, {R('irrigation_mm', 3)} AS irrigation_mm, {R('rainfall_mm', 3)} AS rainfall_mm,
       {R('received', 3)} AS water_received_mm, {R('gdd_accumulated', 3)} AS gdd_accumulated,
       {R(ratio('yield_t_ha', 'received', 100), 3)} AS water_use_efficiency_t_per_100mm, status AS outcome
FROM economics_rows""")

# -- views --------------------------------------------------------------------
table("v_field_soil_weekly", f"""
SELECT CAST(date_trunc('week', reading_date) AS DATE) AS week_start, field_id, farm_id, region, soil_type,
       count(DISTINCT reading_date) AS days_observed, {A('avg_soil_moisture_pct')} AS avg_soil_moisture_pct,
       {A('avg_soil_temperature_c')} AS avg_soil_temperature_c, min(min_soil_moisture_pct) AS min_soil_moisture_pct,
       max(max_soil_moisture_pct) AS max_soil_moisture_pct, count(*) FILTER (moisture_stress = 'dry') AS dry_days
FROM field_soil_daily GROUP BY ALL""")
table("v_field_latest_condition", """
SELECT d.field_id, d.field_code, d.field_name, d.farm_code, d.farm_name, d.region, d.soil_type, d.field_area_ha,
       d.reading_date AS last_reading_date, d.avg_soil_moisture_pct, d.avg_soil_temperature_c, d.avg_soil_ph,
       d.avg_soil_ec_ds_m, d.min_battery_pct, d.active_sensors, d.moisture_stress
FROM field_soil_daily d JOIN (SELECT field_id, max(reading_date) AS last_day FROM field_soil_daily GROUP BY field_id) x
  ON x.field_id = d.field_id AND x.last_day = d.reading_date""")
table("v_field_water_daily", """
SELECT w.weather_date AS observation_date, w.field_id, w.field_code, w.farm_code, w.region, w.country_code, w.field_area_ha,
       s.soil_type, w.precipitation_mm, w.rainfall_7d_mm, w.et0_mm, w.et0_7d_mm, w.water_balance_mm, w.water_balance_7d_mm,
       w.gdd_base10, w.gdd_cumulative, w.temp_mean_c, w.aridity_flag, s.avg_soil_moisture_pct, s.min_soil_moisture_pct,
       s.max_soil_moisture_pct, s.avg_soil_temperature_c, s.moisture_stress, s.active_sensors, s.reading_count
FROM field_weather_daily w JOIN field_soil_daily s ON s.field_id = w.field_id AND s.reading_date = w.weather_date
WHERE w.is_actual""")
table("v_field_water_monthly", f"""
SELECT CAST(date_trunc('month', observation_date) AS DATE) AS month_start, field_id, field_code, farm_code, region,
       any_value(field_area_ha) AS field_area_ha, {S('precipitation_mm')} AS rainfall_mm, {S('et0_mm')} AS et0_mm,
       {S('water_balance_mm')} AS water_balance_mm, {A('avg_soil_moisture_pct')} AS avg_soil_moisture_pct,
       {A('temp_mean_c')} AS avg_temp_c, max(gdd_cumulative) AS gdd_cumulative,
       count(*) FILTER (aridity_flag = 'dry') AS dry_days, count(*) FILTER (moisture_stress = 'dry') AS moisture_stressed_days
FROM v_field_water_daily GROUP BY 1, 2, 3, 4, 5""")
table("v_farm_latest_weather", """
SELECT w.farm_id, w.farm_code, w.weather_date AS last_weather_date, w.is_actual, w.temp_max_c, w.temp_min_c, w.temp_mean_c,
       w.precipitation_mm, w.et0_mm, w.wind_speed_max_kmh, w.weather_code
FROM fact_weather_daily w JOIN (SELECT farm_id, max(weather_date) AS last_day FROM fact_weather_daily WHERE is_actual GROUP BY farm_id) x
  ON x.farm_id = w.farm_id AND x.last_day = w.weather_date""")
table("v_field_latest_crop_health", """
SELECT h.field_id, h.field_code, h.field_name, h.farm_code, h.region, h.soil_type, h.field_area_ha,
       h.observed_on AS last_observed_on, h.crop_code, h.crop_name, h.season, h.days_after_sowing, h.cycle_progress_pct,
       h.avg_ndvi, h.ndvi_vs_expected_pct, h.canopy_stage, h.vigour_flag
FROM field_crop_health_daily h JOIN (SELECT field_id, max(observed_on) AS last_day FROM field_crop_health_daily GROUP BY field_id) x
  ON x.field_id = h.field_id AND x.last_day = h.observed_on""")
table("v_planting_ndvi_curve", """
SELECT planting_id, crop_code, crop_name, season, region, field_code, observed_on, days_after_sowing, cycle_progress_pct,
       canopy_stage, avg_ndvi, peak_ndvi_expected, ndvi_vs_expected_pct
FROM field_crop_health_daily WHERE planting_id IS NOT NULL""")
table("v_field_water_supply_daily", """
SELECT i.water_date, i.field_id, i.field_code, i.farm_code, i.region, i.country_code, i.soil_type, i.field_area_ha,
       i.irrigation_events, i.irrigation_mm, i.water_volume_m3, i.energy_kwh, i.irrigation_method, i.rainfall_mm, i.et0_mm,
       i.water_supplied_mm, i.water_deficit_mm, i.irrigation_share_pct, i.supply_status, s.avg_soil_moisture_pct,
       s.min_soil_moisture_pct, s.moisture_stress, s.active_sensors
FROM field_irrigation_daily i LEFT JOIN field_soil_daily s ON s.field_id = i.field_id AND s.reading_date = i.water_date
WHERE i.is_actual""")
table("v_field_irrigation_monthly", f"""
SELECT *, {ratio('irrigation_mm', 'water_supplied_mm', 100)} AS irrigation_share_pct FROM (
  SELECT CAST(date_trunc('month', water_date) AS DATE) AS month_start, field_id, field_code, farm_code, region,
         any_value(field_area_ha) AS field_area_ha, CAST(sum(irrigation_events) AS BIGINT) AS irrigation_events,
         {', '.join(f'{S(c)} AS {c}' for c in ('irrigation_mm', 'water_volume_m3', 'energy_kwh', 'rainfall_mm', 'et0_mm',
                                               'water_supplied_mm', 'water_deficit_mm'))},
         count(*) FILTER (supply_status = 'deficit') AS deficit_days
  FROM field_irrigation_daily WHERE is_actual GROUP BY 1, 2, 3, 4, 5) t""")
table("v_machine_utilisation", f"""
SELECT *, {ratio('fuel_used_litres', 'area_covered_ha')} AS fuel_per_ha FROM (
  SELECT machine_id, machine_code, machine_type, manufacturer, model, farm_code, region, min(activity_date) AS first_active_on,
         max(activity_date) AS last_active_on, count(*) AS days_observed,
         {', '.join(f"count(*) FILTER (utilisation_status = '{s}') AS {s}_days" for s in ('working', 'idle', 'parked', 'down'))},
         {S('operation_hours')} AS operation_hours, {S('area_covered_ha')} AS area_covered_ha,
         {S('fuel_used_litres')} AS fuel_used_litres, {A('idle_ratio_pct')} AS avg_idle_ratio_pct,
         CAST(sum(faults) AS BIGINT) AS faults, CAST(sum(critical_faults) AS BIGINT) AS critical_faults,
         {S('downtime_hours')} AS downtime_hours, {S('repair_cost_usd')} AS repair_cost_usd
  FROM machine_daily GROUP BY 1, 2, 3, 4, 5, 6, 7) t""")
table("v_machine_attention", f"""
SELECT machine_id, machine_code, machine_type, farm_code, region, CAST(sum(open_faults) AS BIGINT) AS open_faults,
       CAST(sum(critical_faults) AS BIGINT) AS critical_faults, {S('downtime_hours')} AS downtime_hours,
       {S('repair_cost_usd')} AS repair_cost_usd, max(activity_date) FILTER (open_faults > 0) AS last_fault_on,
       max(activity_date) AS last_activity_date, arg_max(utilisation_status, activity_date) AS current_status
FROM machine_daily m GROUP BY 1, 2, 3, 4, 5 HAVING sum(m.open_faults) > 0""")
table("v_crop_season_economics", f"""
SELECT *, {ratio('yield_tonnes', 'harvested_area_ha')} AS yield_t_ha, {ratio('gross_margin_usd', 'area_ha')} AS margin_per_ha_usd
FROM (SELECT season, crop_code, crop_name, crop_category, region, country_code, count(*) AS plantings,
             count(*) FILTER (outcome = 'harvested') AS harvested, {S('p.area_ha')} AS area_ha,
             {S('CASE WHEN p.yield_t_ha IS NULL THEN 0.0 ELSE p.area_ha END')} AS harvested_area_ha,
             {', '.join(f'{S("p." + c)} AS {c}' for c in ('yield_tonnes', 'revenue_usd', 'cost_total_usd', 'gross_margin_usd',
                                                         'irrigation_mm', 'rainfall_mm'))},
             {A('p.water_use_efficiency_t_per_100mm')} AS water_use_efficiency_t_per_100mm,
             {A('p.gdd_accumulated')} AS gdd_accumulated
      FROM planting_economics p GROUP BY 1, 2, 3, 4, 5, 6) t""")
table("v_planting_cost_breakdown", " UNION ALL ".join(f"""
SELECT planting_id, field_code, farm_code, region, season, crop_code, area_ha, '{c}' AS category, cost_{c}_usd AS amount_usd,
       {ratio(f'cost_{c}_usd', 'cost_total_usd', 100)} AS share_pct FROM planting_economics""" for c in COST_CATEGORIES))
table("v_farm_scorecard", f"""
SELECT *, {ratio('gross_margin_usd', 'area_ha')} AS margin_per_ha_usd FROM (
  SELECT farm_id, farm_code, region, country_code, count(*) AS plantings, {', '.join(f'{S("p." + c)} AS {c}' for c in (
      'area_ha', 'yield_tonnes', 'revenue_usd', 'cost_total_usd', 'gross_margin_usd', 'irrigation_mm', 'rainfall_mm'))}
  FROM planting_economics p GROUP BY 1, 2, 3, 4) t""")
table("v_farm_field_locations", """
SELECT 'farm' AS entity_type, farm_id AS entity_id, farm_code AS entity_code, farm_name AS entity_name, farm_id, farm_code,
       farm_name, CAST(NULL AS VARCHAR) AS soil_type, country_code, region, latitude, longitude, area_ha FROM dim_farm
UNION ALL
SELECT 'field', f.field_id, f.field_code, f.field_name, f.farm_id, f.farm_code, m.farm_name, f.soil_type, m.country_code,
       m.region, f.latitude, f.longitude, f.area_ha
FROM dim_field f JOIN dim_farm m ON m.farm_id = f.farm_id""")
