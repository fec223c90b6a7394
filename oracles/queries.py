"""SQL per query."""

from __future__ import annotations

from oracles.datasets import LIBRARY
from oracles.text import A, R, S, T, compose, newest, ratio, trim

RAW: dict[str, str] = {}


def sql(name, text):
    RAW[name] = text.strip()


# ---- sources and sinks ------------------------------------------------------
sql("snapshot_scan", "SELECT *, DATE '2024-01-31' AS snapshot_date FROM src_field")
sql("incremental_scan", "SELECT * FROM src_sensor_reading WHERE updated_at > TIMESTAMP '2024-01-15 00:00:00'")
sql("watermark_advance", """
SELECT 'raw.sensor_reading' AS pipeline, 'sensor_reading' AS source_table, 'updated_at' AS watermark_column,
       max(updated_at) AS watermark FROM src_sensor_reading WHERE updated_at < TIMESTAMP '2024-01-20 00:00:00'
UNION ALL SELECT 'raw.machine_fault', 'machine_fault', 'updated_at', max(updated_at) FROM src_machine_fault""")
sql("watermark_reset", """
SELECT 'raw.sensor_reading' AS pipeline, 'sensor_reading' AS source_table, 'updated_at' AS watermark_column,
       max(updated_at) AS watermark FROM src_sensor_reading
UNION ALL SELECT 'raw.machine_fault', 'machine_fault', 'updated_at', NULL""")
sql("batch_append", """
SELECT *, CASE WHEN updated_at < TIMESTAMP '2024-01-12 00:00:00' THEN DATE '2024-01-12' ELSE DATE '2024-01-31' END AS ingest_date
FROM src_sensor_reading""")
sql("partition_overwrite", """
SELECT * REPLACE (CASE WHEN reading_date >= DATE '2024-01-20' THEN 50.0 ELSE battery_pct END AS battery_pct) FROM fact_sensor_reading""")
sql("partition_read", "SELECT * FROM fact_sensor_reading WHERE reading_date = DATE '2024-01-15'")
sql("all_partitions_read", """
SELECT * REPLACE (CASE WHEN reading_date >= DATE '2024-01-05' AND reading_date < DATE '2024-01-12' THEN NULL ELSE battery_pct END AS battery_pct,
                  CASE WHEN reading_date >= DATE '2024-01-05' AND reading_date < DATE '2024-01-12' THEN floor(soil_ph) ELSE soil_ph END AS soil_ph,
                  CASE WHEN reading_date >= DATE '2024-01-12' AND reading_date < DATE '2024-01-20' THEN NULL ELSE soil_ec_ds_m END AS soil_ec_ds_m)
FROM fact_sensor_reading""")
sql("missing_ok_empty", f"SELECT 'present' AS origin, count(*) AS rows, {A('soil_ph')} AS avg_ph FROM fact_sensor_reading")
sql("require_upstream", "SELECT * FROM field_soil_daily")
sql("weather_json_flatten", """
SELECT farm_code, latitude, longitude, weather_date, source, temp_max_c AS temperature_2m_max, temp_min_c AS temperature_2m_min,
       temp_mean_c AS temperature_2m_mean, precipitation_mm AS precipitation_sum,
       CASE WHEN farm_id % 5 <> 0 THEN rain_mm END AS rain_sum, precipitation_hours, et0_mm AS et0_fao_evapotranspiration,
       solar_radiation_mj_m2 AS shortwave_radiation_sum, wind_speed_max_kmh AS wind_speed_10m_max, weather_code
FROM fact_weather_daily WHERE farm_id % 7 <> 3""")
sql("weather_window_filter", """
SELECT farm_code, weather_date, source, precipitation_sum, rain_sum FROM src_weather_archive
WHERE weather_date BETWEEN DATE '2020-01-01' AND DATE '2024-01-14'
UNION ALL SELECT farm_code, weather_date, source, precipitation_sum, rain_sum FROM src_weather_forecast
WHERE weather_date BETWEEN DATE '2024-01-13' AND DATE '2024-01-27'""")
sql("table_replace_load", "SELECT * FROM fact_irrigation")
sql("table_append", "SELECT * FROM fact_machine_fault")
sql("partition_drop", "SELECT * FROM fact_machine_fault WHERE occurred_date <> DATE '2024-01-10'")
sql("catalog_register", """
SELECT *, DATE '2024-01-31' AS snapshot_date FROM dim_field
UNION ALL SELECT *, DATE '2024-02-01' FROM dim_field WHERE area_ha > 25""")
_TEL = [("telemetry_id", "BIGINT"), ("machine_id", "BIGINT"), ("farm_id", "BIGINT"), ("operation_id", "BIGINT"),
        ("reading_ts", "TIMESTAMP"), ("engine_hours", "DOUBLE"), ("engine_running", "BOOLEAN"), ("is_idle", "BOOLEAN"),
        ("fuel_level_pct", "DOUBLE"), ("fuel_rate_l_per_h", "DOUBLE"), ("engine_temp_c", "DOUBLE"), ("engine_rpm", "INT"),
        ("speed_kmh", "DOUBLE"), ("latitude", "DOUBLE"), ("longitude", "DOUBLE")]
sql("contract_to_ddl", " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, '{t}' AS column_type, count({n}) AS values_held FROM fact_machine_telemetry" for n, t in _TEL))
sql("catalog_probe", """
SELECT 'probe_dim_farm' AS table_name, true AS found, count(*) AS rows,
       'farm_id,farm_code,farm_name,country_code,region,latitude,longitude,area_ha,snapshot_date' AS columns FROM dim_farm
UNION ALL SELECT 'probe_dim_machine', true, count(*),
       'machine_id,machine_code,farm_id,machine_type,manufacturer,model,year_built,rated_power_hp,purchase_date,engine_hours_at_purchase,status,snapshot_date'
FROM dim_machine""")
sql("numeric_normalise", "SELECT field_id, area_ha, latitude, name FROM src_field")
sql("run_metrics_log", """
SELECT 'raw.farm' AS pipeline, 'success' AS status, count(*) AS rows_read, count(*) AS rows_written,
       CAST(0 AS BIGINT) AS rows_quarantined, DATE '2024-01-31' AS logical_date FROM src_farm
UNION ALL SELECT 'raw.machine', 'success', count(*), count(*), 0, DATE '2024-01-31' FROM src_machine
UNION ALL SELECT 'raw.machine_fault', 'success', 0, 0, 0, DATE '2024-01-31'
UNION ALL SELECT 'conformed.dim_machine', 'success', count(*), count(*), 0, DATE '2024-01-31' FROM dim_machine
UNION ALL SELECT 'conformed.fact_machine_fault', 'success', count(*), count(*), 0, DATE '2024-01-31' FROM fact_machine_fault""")

# ---- conforming -------------------------------------------------------------
sql("conform_rename", "SELECT farm_id, name AS farm_name FROM src_farm")
sql("conform_trim", f"SELECT field_id, {trim('field_code')} AS field_code, {trim('soil_type')} AS soil_type FROM src_field")
sql("conform_case", f"SELECT farm_id, lower({trim('region')}) AS region, upper({trim('country_code')}) AS country_code FROM src_farm")
sql("conform_cast", "SELECT machine_id, year_built, rated_power_hp FROM src_machine")
sql("conform_derive", """
SELECT operation_id, CAST(started_at AS DATE) AS operation_date, fuel_used_litres / area_covered_ha AS fuel_per_ha FROM src_machine_operation""")
sql("conform_filter", f"SELECT sensor_id, lower({trim('status')}) AS status FROM src_sensor WHERE lower({trim('status')}) <> 'decommissioned'")
sql("conform_select", "SELECT * FROM fact_harvest")
sql("clash_drop", "SELECT h.harvest_id, h.planting_id, p.area_ha, p.season FROM src_harvest h JOIN src_planting p ON p.planting_id = h.planting_id")
sql("derive_date", "SELECT reading_id, CAST(reading_ts AS DATE) AS reading_date FROM src_sensor_reading")
sql("derive_duration_hours", """
SELECT operation_id, CAST(date_diff('second', started_at, finished_at) AS DOUBLE) / 3600 AS duration_hours FROM src_machine_operation""")
sql("derive_is_open", "SELECT fault_id, resolved_at IS NULL AS is_open FROM src_machine_fault")
sql("derive_is_actual", """
SELECT farm_code, true AS is_actual, count(*) AS rows FROM src_weather_archive GROUP BY farm_code
UNION ALL SELECT farm_code, false, count(*) FROM src_weather_forecast GROUP BY farm_code""")
sql("filter_usable", "SELECT observation_id, field_id, ndvi FROM fact_field_index WHERE usable")
sql("filter_attributed", "SELECT cost_id, planting_id, amount_usd FROM fact_field_cost WHERE planting_id IS NOT NULL")
sql("filter_actuals", "SELECT farm_id, weather_date, precipitation_mm FROM fact_weather_daily WHERE is_actual")
sql("ad_hoc_filters", """
SELECT 'canopy_stage_known' AS predicate, count(*) AS rows FROM field_crop_health_daily WHERE canopy_stage <> 'unknown'
UNION ALL SELECT 'area_worked', count(*) FROM machine_daily WHERE area_covered_ha > 0
UNION ALL SELECT 'harvested', count(*) FROM planting_economics WHERE outcome = 'harvested'
UNION ALL SELECT 'actual', count(*) FROM field_irrigation_daily WHERE is_actual
UNION ALL SELECT 'crop_known', count(*) FROM field_crop_health_daily WHERE crop_name IS NOT NULL
UNION ALL SELECT 'yield_and_water_known', count(*) FROM planting_economics WHERE yield_t_ha IS NOT NULL AND water_received_mm IS NOT NULL""")
sql("dashboard_filters", f"""
SELECT region, soil_type, count(*) AS count, {A('avg_soil_moisture_pct')} AS avg_moisture,
       CAST(sum(CASE WHEN moisture_stress = 'dry' THEN 1 ELSE 0 END) AS BIGINT) AS dry_field_days
FROM field_soil_daily WHERE region IN ('AFRICA', 'ASIA') AND soil_type IN ('clay', 'loamy')
  AND reading_date >= DATE '2024-01-05' AND reading_date < DATE '2024-01-25' GROUP BY region, soil_type""")
sql("zero_fill", "SELECT machine_id, activity_date, operations, area AS area_covered_ha, faults, km AS distance_km FROM machine_days")
sql("guarded_ratio", f"""
SELECT machine_id, operation_date AS activity_date, {ratio('fuel', 'area')} AS fuel_per_ha FROM (
  SELECT machine_id, operation_date, {T('fuel_used_litres')} AS fuel,
         {T('CASE WHEN operation_id % 3 = 0 THEN 0.0 ELSE area_covered_ha END')} AS area
  FROM fact_machine_operation GROUP BY machine_id, operation_date) t""")
sql("round_block", f"""
SELECT field_id, {R(A('soil_moisture_pct'), 3)} AS moisture, {R(A('soil_ph'), 3)} AS ph FROM fact_sensor_reading GROUP BY field_id""")
sql("classify_moisture_stress", """
SELECT reading_id, CASE WHEN soil_moisture_pct IS NULL THEN 'unknown' WHEN soil_moisture_pct < 15 THEN 'dry'
       WHEN soil_moisture_pct > 38 THEN 'wet' ELSE 'optimal' END AS moisture_stress FROM fact_sensor_reading""")
sql("classify_aridity", """
SELECT farm_id, weather_date, CASE WHEN precipitation_mm - et0_mm IS NULL THEN 'unknown' WHEN precipitation_mm - et0_mm > 2 THEN 'wet'
       WHEN precipitation_mm - et0_mm < -3 THEN 'dry' ELSE 'balanced' END AS aridity_flag FROM fact_weather_daily""")
sql("classify_canopy_stage", """
SELECT CASE WHEN cycle_progress_pct IS NULL THEN 'unknown' WHEN cycle_progress_pct < 15 THEN 'bare' WHEN cycle_progress_pct < 45 THEN 'developing'
       WHEN cycle_progress_pct <= 75 THEN 'peak' ELSE 'senescing' END AS canopy_stage, count(*) AS rows,
       min(cycle_progress_pct) AS least, max(cycle_progress_pct) AS most FROM field_crop_health_daily GROUP BY 1""")
sql("classify_vigour", """
SELECT canopy_stage, CASE WHEN ndvi_vs_expected_pct IS NULL OR canopy_stage IN ('unknown', 'bare') THEN 'unknown'
       WHEN ndvi_vs_expected_pct < 65 THEN 'low' WHEN ndvi_vs_expected_pct >= 95 THEN 'high' ELSE 'normal' END AS vigour_flag,
       count(*) AS rows, min(ndvi_vs_expected_pct) AS least, max(ndvi_vs_expected_pct) AS most FROM field_crop_health_daily GROUP BY 1, 2""")
sql("classify_supply_status", """
SELECT farm_id, weather_date, CASE WHEN et0_mm - precipitation_mm IS NULL THEN 'unknown' WHEN et0_mm - precipitation_mm > 2 THEN 'deficit'
       WHEN et0_mm - precipitation_mm < -2 THEN 'surplus' ELSE 'balanced' END AS supply_status FROM fact_weather_daily""")
sql("classify_utilisation", "SELECT machine_type, utilisation_status AS status, count(*) AS rows FROM machine_daily GROUP BY 1, 2")
sql("classify_method_mixed", """
SELECT planting_id, CASE WHEN count(DISTINCT method) > 1 THEN 'mixed' ELSE min(method) END AS irrigation_method
FROM fact_irrigation GROUP BY planting_id""")
LIBRARY["planted"] = """
SELECT p.*, v.variety_code, v.crop_code, v.maturity_days, v.yield_potential_t_ha, v.drought_tolerance, c.is_perennial, c.base_temp_c,
       c.gdd_to_maturity, c.water_demand_mm, c.peak_ndvi
FROM dim_planting p JOIN dim_crop_variety v ON v.variety_id = p.variety_id JOIN dim_crop c ON c.crop_code = v.crop_code"""
sql("grade_banding", """
SELECT h.harvest_id, h.planting_id, g.variety_code, h.yield_t_ha, g.yield_potential_t_ha,
       CASE WHEN h.yield_t_ha / g.yield_potential_t_ha >= 0.80 THEN 'A' WHEN h.yield_t_ha / g.yield_potential_t_ha >= 0.55 THEN 'B'
            WHEN h.yield_t_ha / g.yield_potential_t_ha >= 0.25 THEN 'C' ELSE 'reject' END AS grade
FROM fact_harvest h JOIN planted g ON g.planting_id = h.planting_id""")

# ---- joins ------------------------------------------------------------------
sql("lookup_join", """
SELECT c.cost_id, c.field_id, c.amount_usd, f.farm_id FROM src_field_cost c JOIN src_field f ON f.field_id = c.field_id WHERE f.area_ha > 10""")
sql("lookup_join_chain", """
SELECT r.reading_id, r.sensor_id, s.field_id, s.status, f.farm_id
FROM src_sensor_reading r JOIN src_sensor s ON s.sensor_id = r.sensor_id JOIN src_field f ON f.field_id = s.field_id""")
sql("dimension_enrich", """
SELECT r.reading_id, r.field_id, r.farm_id, f.field_code, f.soil_type, f.area_ha AS field_area_ha, m.farm_code, m.region
FROM fact_sensor_reading r JOIN dim_field f ON f.field_id = r.field_id JOIN dim_farm m ON m.farm_id = r.farm_id""")
sql("optional_enrich", """
SELECT o.observation_id, o.planting_id, p.season, v.variety_code, c.crop_name, c.cycle_days
FROM fact_field_index o LEFT JOIN dim_planting p ON p.planting_id = o.planting_id
LEFT JOIN dim_crop_variety v ON v.variety_id = p.variety_id LEFT JOIN dim_crop c ON c.crop_code = v.crop_code""")
sql("spine_left_join", """
SELECT s.field_id, s.water_date, coalesce(i.n, 0) AS irrigation_events, coalesce(i.mm, 0.0) AS irrigation_mm,
       coalesce(i.method, 'none') AS irrigation_method
FROM (SELECT DISTINCT field_id, planted_on AS water_date FROM dim_planting) s
LEFT JOIN irrigation_days i ON i.field_id = s.field_id AND i.water_date = s.water_date""")
sql("multi_fact_left_join", """
SELECT t.machine_id, t.activity_date, t.readings AS telemetry_readings, o.n AS operations, o.hours AS operation_hours,
       x.n AS faults, x.critical AS critical_faults
FROM telemetry_days t LEFT JOIN operation_days o ON o.machine_id = t.machine_id AND o.activity_date = t.activity_date
LEFT JOIN fault_days x ON x.machine_id = t.machine_id AND x.activity_date = t.activity_date""")
sql("star_join", """
SELECT planting_id, field_code, region, variety_name, crop_name, yield_tonnes, nullif(input_applications, 0) AS input_applications
FROM economics_rows""")
sql("window_range_join", "SELECT * FROM planting_weather")
sql("farm_to_field_pushdown", f"""
SELECT f.field_id, count(*) AS days, {S('w.rain_mm')} AS rain_mm FROM fact_weather_daily w JOIN dim_field f ON f.farm_id = w.farm_id
WHERE w.is_actual GROUP BY f.field_id""")
sql("spine_inner_view", """
SELECT w.field_id, w.weather_date AS observation_date, w.precipitation_mm, s.avg_soil_moisture_pct, s.moisture_stress
FROM field_weather_daily w JOIN field_soil_daily s ON s.field_id = w.field_id AND s.reading_date = w.weather_date WHERE w.is_actual""")
sql("supply_left_view", """
SELECT i.field_id, count(*) AS days, count(s.avg_soil_moisture_pct) AS days_with_soil, count(*) - count(s.moisture_stress) AS days_without_soil
FROM field_irrigation_daily i LEFT JOIN field_soil_daily s ON s.field_id = i.field_id AND s.reading_date = i.water_date
WHERE i.is_actual GROUP BY i.field_id""")
sql("latest_per_group_join", """
SELECT o.field_id, o.observed_on, o.observation_id, o.ndvi FROM fact_field_index o
JOIN (SELECT field_id, max(observed_on) AS last_day FROM fact_field_index GROUP BY field_id) x
  ON x.field_id = o.field_id AND x.last_day = o.observed_on""")
sql("orphan_anti_join", """
SELECT r.sensor_id, count(*) AS readings FROM src_sensor_reading r
WHERE NOT EXISTS (SELECT 1 FROM dim_sensor s WHERE s.sensor_id = r.sensor_id AND s.status = 'active') GROUP BY r.sensor_id""")
sql("active_interval_join", "SELECT observation_id, field_id, observed_on, source, ndvi, planting_id FROM src_field_index_observation")
sql("overlap_self_join", """
SELECT t.telemetry_id, t.machine_id, t.reading_ts FROM fact_machine_telemetry t
WHERE NOT t.engine_running AND EXISTS (SELECT 1 FROM fact_machine_operation o
  WHERE o.machine_id = t.machine_id AND o.started_at <= t.reading_ts AND t.reading_ts < o.finished_at)""")
LIBRARY["depth_left"] = """
SELECT r.reading_id, coalesce(sum(i.depth_mm * exp(-(epoch_us(r.reading_ts) - epoch_us(i.event_ts)) / 86400000000.0 / (5.0 / 3.0))), 0.0) AS depth
FROM fact_sensor_reading r LEFT JOIN fact_irrigation i ON i.field_id = r.field_id
 AND i.event_ts <= r.reading_ts AND i.event_ts >= r.reading_ts - INTERVAL 5 DAY
GROUP BY r.reading_id"""
sql("decay_window_join", f"SELECT reading_id, {R('depth', 4)} AS depth_left_mm FROM depth_left")

# ---- aggregates -------------------------------------------------------------
sql("agg_soil_daily", f"""
SELECT reading_date, field_id, farm_id, active_sensors, reading_count, {R('m_avg', 3)} AS avg_soil_moisture_pct, m_min AS min_soil_moisture_pct,
       m_max AS max_soil_moisture_pct, {R('t_avg', 3)} AS avg_soil_temperature_c, {R('ph_avg', 3)} AS avg_soil_ph,
       {R('ec_avg', 3)} AS avg_soil_ec_ds_m, b_min AS min_battery_pct FROM soil_days""")
sql("agg_crop_health", f"""
SELECT observed_on, field_id, farm_id, planting_id, count(*) AS observation_count, {A('ndvi')} AS avg_ndvi, max(ndvi) AS max_ndvi,
       {A('ndwi')} AS avg_ndwi, {A('evi')} AS avg_evi, {A('cloud_cover_pct')} AS avg_cloud_cover_pct
FROM fact_field_index GROUP BY observed_on, field_id, farm_id, planting_id""")
sql("agg_irrigation_daily", """
SELECT field_id, water_date, n AS irrigation_events, mm AS irrigation_mm, m3 AS water_volume_m3, minutes AS irrigation_minutes,
       kwh AS energy_kwh, method AS irrigation_method FROM irrigation_days""")
sql("agg_telemetry_daily", """
SELECT machine_id, activity_date, readings AS telemetry_readings, running AS running_readings, idle AS idle_readings,
       hours_end AS engine_hours_end, rate AS avg_fuel_rate_l_per_h, level AS min_fuel_level_pct, temp AS max_engine_temp_c,
       speed AS avg_speed_kmh FROM telemetry_days""")
sql("agg_operations_daily", """
SELECT machine_id, activity_date, n AS operations, hours AS operation_hours, area AS area_covered_ha, fuel AS fuel_used_litres,
       km AS distance_km FROM operation_days""")
sql("agg_faults_daily", """
SELECT machine_id, activity_date, n AS faults, critical AS critical_faults, still_open AS open_faults, downtime AS downtime_hours,
       cost AS repair_cost_usd FROM fault_days""")
sql("cost_pivot", "SELECT * FROM planting_costs")
sql("agg_inputs_per_planting", "SELECT * FROM planting_inputs")
sql("agg_irrigation_per_planting", "SELECT * FROM planting_irrigation")
sql("agg_weather_window", f"""
SELECT p.planting_id, {S('CASE WHEN w.rain_mm > 0 THEN 1 ELSE 0 END')} AS wet_days,
       {T('CASE WHEN w.temp_mean_c IS NOT NULL THEN greatest(least(w.temp_mean_c, 30) - 10, 0) END')} AS heat_units
FROM dim_planting p JOIN fact_weather_daily w ON w.farm_id = p.farm_id AND w.weather_date BETWEEN p.planted_on AND p.expected_harvest_on
GROUP BY p.planting_id""")
sql("count_if", """
SELECT machine_id, count(*) FILTER (engine_running AND NOT is_idle) AS working, count(*) FILTER (is_idle) AS idle,
       count(*) - count(engine_temp_c) AS no_temperature FROM fact_machine_telemetry GROUP BY machine_id""")
sql("any_value", "SELECT field_id, any_value(field_area_ha) AS field_area_ha, count(*) AS days FROM field_soil_daily GROUP BY field_id")
sql("arg_max", "SELECT machine_id, arg_max(utilisation_status, activity_date) AS current_status FROM machine_daily GROUP BY machine_id")
sql("max_if", "SELECT machine_id, max(activity_date) FILTER (open_faults > 0) AS last_fault_on FROM machine_daily GROUP BY machine_id")
sql("having_filter", """
SELECT machine_id, count(*) AS open_faults FROM fact_machine_fault WHERE is_open GROUP BY machine_id""")
sql("ratio_of_totals", f"""
SELECT operation_type, {S('fuel_used_litres')} / {S('area_covered_ha')} AS fuel_per_ha FROM fact_machine_operation GROUP BY operation_type""")
sql("distinct_exact", """
SELECT farm_id, count(DISTINCT field_id) AS fields, count(DISTINCT sensor_id) AS sensors FROM fact_sensor_reading GROUP BY farm_id""")
sql("distinct_approx_state", "SELECT field_id, count(DISTINCT sensor_id) AS sensors, true AS close FROM fact_sensor_reading GROUP BY field_id")
sql("weekly_partial_states", """
SELECT CAST(date_trunc('week', reading_date) AS DATE) AS week_start, field_id, count(DISTINCT reading_date) AS days,
       CAST(sum(CAST(avg_soil_moisture_pct AS DECIMAL(18,4))) * 10000 AS BIGINT) AS moisture_units, count(avg_soil_moisture_pct) AS moisture_n,
       min(min_soil_moisture_pct) AS min_state, max(max_soil_moisture_pct) AS max_state,
       count(*) FILTER (moisture_stress = 'dry') AS dry_state
FROM field_soil_daily GROUP BY 1, field_id, farm_id, region, soil_type""")
sql("weekly_state_merge", "SELECT * FROM v_field_soil_weekly")
sql("machinery_cost_per_planting", f"""
SELECT planting_id, {S('fuel_used_litres')} * 1.05 AS machinery_cost_usd FROM fact_machine_operation WHERE planting_id IS NOT NULL GROUP BY planting_id""")
LIBRARY["ledger_rows"] = f"""
SELECT planting_id, 'seed' AS cost_category, seed_rate_kg_ha * area_ha * 1.8 AS amount FROM dim_planting
UNION ALL SELECT planting_id, 'fertilizer', {S('total_cost_usd')} FROM fact_input_application WHERE input_type = 'fertilizer' GROUP BY planting_id
UNION ALL SELECT planting_id, 'crop_protection', {S('total_cost_usd')} FROM fact_input_application WHERE input_type <> 'fertilizer' GROUP BY planting_id
UNION ALL SELECT planting_id, 'irrigation', {S('energy_kwh')} * 0.11 FROM fact_irrigation GROUP BY planting_id
UNION ALL SELECT planting_id, 'machinery', {S('fuel_used_litres')} * 1.05 FROM fact_machine_operation GROUP BY planting_id"""
sql("derived_cost_ledger", f"""
SELECT l.planting_id, l.cost_category, {R('l.amount', 2)} AS amount_usd FROM ledger_rows l
JOIN dim_planting p ON p.planting_id = l.planting_id WHERE l.amount > 0""")

# ---- windows ----------------------------------------------------------------


def _over(c, n):
    return (f"CAST(sum(CAST({c} AS DECIMAL(18,4))) OVER (PARTITION BY farm_id ORDER BY weather_date "
            f"ROWS BETWEEN {n} PRECEDING AND CURRENT ROW) AS DOUBLE)")


LIBRARY["farm_series"] = """
SELECT farm_id, weather_date, precipitation_mm, et0_mm, precipitation_mm - et0_mm AS balance,
       CASE WHEN temp_mean_c IS NOT NULL THEN greatest(least(temp_mean_c, 30.0) - 10.0, 0.0) END AS gdd FROM fact_weather_daily"""
sql("gdd_cumulative", f"""
SELECT farm_id, weather_date, {R('gdd', 3)} AS gdd_base10, CASE WHEN gdd IS NOT NULL THEN {R(_over('gdd', 'UNBOUNDED'), 3)} END AS gdd_cumulative
FROM farm_series""")
sql("rainfall_7d", f"SELECT farm_id, weather_date, {R(_over('precipitation_mm', 6), 3)} AS rainfall_7d_mm FROM farm_series")
sql("rainfall_30d", f"SELECT farm_id, weather_date, {R(_over('precipitation_mm', 29), 3)} AS rainfall_30d_mm FROM farm_series")
sql("et0_7d", f"SELECT farm_id, weather_date, {R(_over('et0_mm', 6), 3)} AS et0_7d_mm FROM farm_series")
sql("water_balance_7d", f"""
SELECT farm_id, weather_date, {R('balance', 3)} AS water_balance_mm, {R(_over('balance', 6), 3)} AS water_balance_7d_mm,
       CASE WHEN balance IS NULL THEN 'unknown' WHEN balance > 2 THEN 'wet' WHEN balance < -3 THEN 'dry' ELSE 'balanced' END AS aridity_flag
FROM farm_series""")
sql("self_overlap_check", """
SELECT * FROM (SELECT operation_id, machine_id, started_at, finished_at,
       lag(finished_at) OVER (PARTITION BY machine_id ORDER BY started_at, finished_at, operation_id) AS previous_end
  FROM fact_machine_operation) t WHERE started_at < previous_end""")
LIBRARY["planting_water_rows"] = f"""
SELECT e.*, c.water_demand_mm, c.gdd_to_maturity, e.water_received_mm / c.water_demand_mm AS water_ratio,
       CASE WHEN e.water_received_mm IS NOT NULL THEN {R('least(1.0, greatest(0.0, 1.0 - e.water_received_mm / c.water_demand_mm))', 4)} END AS water_stress
FROM planting_economics e JOIN dim_crop c ON c.crop_code = e.crop_code"""
LIBRARY["water_yield"] = f"""
SELECT w.planting_id, w.water_ratio, {R('w.yield_t_ha / v.yield_potential_t_ha', 6)} AS relative_yield
FROM planting_water_rows w JOIN dim_crop_variety v ON v.variety_code = w.variety_code WHERE w.yield_t_ha > 0"""
sql("wet_dry_halves", """
SELECT half, count(*) AS plantings, CAST(sum(CAST(relative_yield AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS mean_response FROM (
  SELECT relative_yield, CASE WHEN row_number() OVER (ORDER BY water_ratio, relative_yield) <= count(*) OVER () // 2 THEN 'dry' ELSE 'wet' END AS half
  FROM water_yield WHERE water_ratio IS NOT NULL AND relative_yield IS NOT NULL) t GROUP BY half""")
sql("latest_run_per_pipeline", """
SELECT 'job-' || CAST(machine_id % 7 AS VARCHAR) AS pipeline, reading_ts AS started_at, telemetry_id AS run_id,
       CASE WHEN engine_running THEN 'success' ELSE 'failed' END AS status
FROM src_machine_telemetry QUALIFY row_number() OVER (PARTITION BY machine_id % 7 ORDER BY reading_ts DESC, telemetry_id DESC) = 1""")

# ---- sorts, sets, dedupe ----------------------------------------------------
sql("sort_output", "SELECT * FROM dim_planting ORDER BY planted_on, planting_id")
sql("top_k_table", """
SELECT harvest_id, yield_t_ha, revenue_usd FROM fact_harvest ORDER BY revenue_usd DESC NULLS LAST, harvest_id, yield_t_ha LIMIT 50""")
sql("order_by_metric", f"""
SELECT field_id, {S('amount_usd')} AS amount_usd FROM fact_field_cost GROUP BY field_id ORDER BY amount_usd DESC NULLS LAST, field_id LIMIT 100""")
sql("union_relaxed", "SELECT * FROM src_weather_archive UNION ALL SELECT * FROM src_weather_forecast")
sql("union_all_discriminator", """
SELECT 'farm' AS entity_type, farm_id AS entity_id, farm_code AS entity_code, CAST(NULL AS VARCHAR) AS soil_type FROM dim_farm
UNION ALL SELECT 'field', field_id, field_code, soil_type FROM dim_field""")
_KL = ["cost_id", "cost_date", "cost_category", "amount_usd", "field_id", "planting_id", "description"]
sql("dedupe_keep_last", f"""
SELECT {', '.join(_KL)}, ingest_date FROM (
  SELECT *, DATE '2024-01-01' AS ingest_date FROM src_field_cost
  UNION ALL SELECT * REPLACE (amount_usd + 1 AS amount_usd), DATE '2024-01-02' FROM src_field_cost WHERE amount_usd > 500) t
{newest(['cost_id'], ['ingest_date', 'updated_at', *_KL])}""")
sql("precedence_merge", "SELECT farm_id, weather_date, source, precipitation_mm FROM fact_weather_daily")
sql("dedupe_keep_first", """
SELECT field_id, observed_on, source, observation_id, ndvi, cloud_cover_pct FROM src_field_pass
QUALIFY row_number() OVER (PARTITION BY field_id, observed_on, source
  ORDER BY observation_id NULLS LAST, ndvi NULLS LAST, cloud_cover_pct NULLS LAST) = 1""")
sql("replacing_key_collapse", """
SELECT field_id, event_ts, irrigation_id, depth_mm FROM fact_irrigation
QUALIFY row_number() OVER (PARTITION BY field_id, event_ts ORDER BY irrigation_id DESC, depth_mm DESC) = 1""")
sql("catalogue_diff", """
SELECT 'lots' AS side, crop_code, cycle_days FROM lot_dim_crop WHERE crop_code IN ('rice', 'maize')
UNION ALL SELECT 'catalogue', crop_code, cycle_days + 1 FROM dim_crop WHERE crop_code IN ('rice', 'maize')""")

# ---- contracts and audits ---------------------------------------------------
LIBRARY["dirty"] = """
SELECT reading_id, sensor_id, field_id, farm_id, reading_ts, reading_date, moisture_units / 100 AS soil_moisture_pct, soil_temperature_c,
       soil_ph, soil_ec_ds_m, battery_pct, count(*) OVER (PARTITION BY reading_id) AS copies FROM src_dirty_reading"""
_DIRTY = [("sensor_id", "not_null", "sensor_id IS NULL")] + [
    (c, f"in_range({lo}, {hi})", f"{c} NOT BETWEEN {lo} AND {hi}") for c, lo, hi in (
        ("soil_moisture_pct", 0, 100), ("soil_temperature_c", -20, 70), ("soil_ph", 0, 14), ("soil_ec_ds_m", 0, 20), ("battery_pct", 0, 100))
] + [("reading_id", "unique", "copies > 1")]
LIBRARY["dirty_failures"] = " UNION ALL ".join(
    f"SELECT reading_id, reading_ts, reading_date, '{c}' AS col, '{k}' AS chk FROM dirty WHERE {p}" for c, k, p in _DIRTY)
LIBRARY["dirty_flagged"] = "SELECT *, " + " OR ".join(f"coalesce({p}, false)" for _, _, p in _DIRTY) + " AS bad FROM dirty"
sql("check_structure", """
SELECT n.rows, p.column_name, p.problem FROM (SELECT count(*) AS rows FROM src_dirty_reading) n,
 (VALUES ('soil_moisture_pct', 'missing'), ('battery_pct', 'is string, not double'), ('moisture_units', 'unexpected')) AS p(column_name, problem)""")
for _name, _rule in (("check_not_null", "chk = 'not_null'"), ("check_range", "chk LIKE 'in_range%'"), ("check_unique", "col = 'reading_id' AND chk = 'unique'")):
    sql(_name, f"SELECT reading_id, reading_ts, col || ':' || chk AS failure FROM dirty_failures WHERE {_rule}")
sql("check_isin", """
SELECT 'status' AS "column", 'isin(active, maintenance, retired)' AS "check", count(*) AS failed_rows FROM dim_machine
WHERE machine_id % 10 = 3 HAVING count(*) > 0""")
sql("check_str_length", "SELECT farm_id, country_code || 'x' AS country_code FROM dim_farm WHERE farm_id % 3 = 0")
sql("split_valid_invalid", f"""
SELECT CASE WHEN bad THEN 'invalid' ELSE 'valid' END AS side, reading_date, count(*) AS rows, {S('soil_temperature_c')} AS temperature
FROM dirty_flagged GROUP BY 1, 2""")
sql("failure_summary", 'SELECT col AS "column", chk AS "check", count(*) AS failed_rows FROM dirty_failures GROUP BY 1, 2')
sql("rejection_gate", f"""
SELECT reading_date, rows_in, rows_rejected, {R('rows_rejected / rows_in', 6)} AS rejection_rate, rows_rejected / rows_in <= 0.10 AS passes FROM (
  SELECT reading_date, count(*) AS rows_in, count(*) FILTER (bad) AS rows_rejected FROM dirty_flagged GROUP BY reading_date) t""")
sql("quarantine_write", "SELECT * EXCLUDE (copies, bad), DATE '2024-01-31' AS logical_date FROM dirty_flagged WHERE bad")
sql("quarantine_report", f"""
SELECT col AS "column", chk AS "check", count(*) AS failed_rows, 'conformed.fact_sensor_reading' AS pipeline, '2024-01-31' AS logical_date,
       any_value(t.rows_in) AS rows_in, any_value(t.rows_rejected) AS rows_rejected, any_value({R('t.rows_rejected / t.rows_in', 6)}) AS rejection_rate
FROM dirty_failures, (SELECT count(*) AS rows_in, count(*) FILTER (bad) AS rows_rejected FROM dirty_flagged) t GROUP BY 1, 2""")
sql("raw_validation", """
SELECT 'raw.machine' AS pipeline, 'machine_code' AS "column", 'not_null' AS "check", 1 AS runs, count(*) FILTER (machine_id % 25 = 3) AS failed_rows,
       count(*) AS rows_in, count(*) FILTER (machine_id % 25 = 3) AS rows_kept FROM src_machine HAVING count(*) FILTER (machine_id % 25 = 3) > 0
UNION ALL
SELECT 'raw.sensor_reading', 'soil_ph', 'not_nan', count(*), sum(bad), sum(n), sum(bad) FROM (
  SELECT updated_at < TIMESTAMP '2024-01-15 00:00:00' AS early, count(*) AS n, count(*) FILTER (reading_id % 40 = 7) AS bad
  FROM src_sensor_reading GROUP BY 1) t WHERE bad > 0""")
sql("check_cross_column", """
SELECT planting_id AS id, 'harvest_after_sowing' AS rule FROM dim_planting WHERE expected_harvest_on <= planted_on
UNION ALL SELECT operation_id, 'finish_after_start' FROM fact_machine_operation WHERE finished_at <= started_at
UNION ALL SELECT fault_id, 'resolved_after_occurred' FROM fact_machine_fault WHERE resolved_at < occurred_at
UNION ALL SELECT observation_id, 'unusable_has_no_index' FROM fact_field_index
WHERE NOT usable AND (ndvi IS NOT NULL OR ndwi IS NOT NULL OR evi IS NOT NULL)""")
sql("check_pattern", r"""
SELECT fault_id AS id, fault_code AS value FROM fact_machine_fault WHERE NOT regexp_matches(fault_code, '^[A-Z]{2,4}-[0-9]{3,4}$')
UNION ALL SELECT planting_id, season FROM src_planting WHERE NOT regexp_matches(season, '^[0-9]{4}-(main|second|dry)$')""")


def _ref(child, key, parent, parent_key):
    return (f"SELECT '{child}' AS child, '{parent}' AS parent, '{key}' AS key, count({key}) AS rows, "
            f"count(*) FILTER ({key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})) AS orphans FROM {child}")


sql("check_referential", " UNION ALL ".join(_ref(*r) for r in (
    ("dim_field", "farm_id", "dim_farm", "farm_id"), ("dim_planting", "field_id", "dim_field", "field_id"),
    ("fact_field_cost", "planting_id", "dim_planting", "planting_id"),
    ("fact_machine_operation", "planting_id", "fact_harvest", "planting_id"),
    ("fact_machine_telemetry", "operation_id", "fact_machine_operation", "operation_id"),
    ("fact_sensor_reading", "sensor_id", "dim_sensor", "sensor_id"))))
sql("check_composite_unique", """
SELECT 'field_pass' AS of, concat_ws('/', field_id, observed_on, source) AS natural_key, count(*) AS copies
FROM src_field_pass GROUP BY field_id, observed_on, source HAVING count(*) > 1
UNION ALL SELECT 'sensor_reading', concat_ws('/', sensor_id, epoch_us(reading_ts)), count(*)
FROM src_sensor_reading GROUP BY sensor_id, reading_ts HAVING count(*) > 1
UNION ALL SELECT 'machine_telemetry', concat_ws('/', machine_id, epoch_us(reading_ts)), count(*)
FROM src_machine_telemetry GROUP BY machine_id, reading_ts HAVING count(*) > 1""")
sql("reconcile_amounts", f"""
SELECT 'revenue' AS kind, harvest_id AS id, revenue_usd AS amount FROM fact_harvest WHERE abs(yield_tonnes * price_usd_per_tonne - revenue_usd) > 0.02
UNION ALL SELECT 'input', application_id, total_cost_usd FROM fact_input_application WHERE abs(quantity_kg * unit_cost_usd_per_kg - total_cost_usd) > 0.02
UNION ALL SELECT 'fertilizer', a.planting_id, b.booked FROM
  (SELECT planting_id, {S('total_cost_usd')} AS applied FROM fact_input_application WHERE input_type = 'fertilizer' GROUP BY planting_id) a
  JOIN (SELECT planting_id, {S('amount_usd')} AS booked FROM fact_field_cost WHERE cost_category = 'fertilizer' GROUP BY planting_id) b
    ON b.planting_id = a.planting_id
  WHERE a.applied > 0 AND b.booked > 0 AND abs(b.booked - a.applied) > a.applied * 0.01""")
sql("check_parked_no_fuel", """
SELECT telemetry_id, 'burns_fuel' AS rule FROM fact_machine_telemetry WHERE NOT engine_running AND fuel_rate_l_per_h <> 0
UNION ALL SELECT telemetry_id, 'turns' FROM fact_machine_telemetry WHERE NOT engine_running AND engine_rpm <> 0""")
sql("check_retired_silent", """
SELECT t.machine_id, count(*) AS readings FROM fact_machine_telemetry t JOIN dim_machine m ON m.machine_id = t.machine_id
WHERE m.status = 'retired' GROUP BY t.machine_id""")
sql("check_within_cycle", """
SELECT i.irrigation_id, i.planting_id, i.event_date FROM fact_irrigation i JOIN dim_planting p ON p.planting_id = i.planting_id
WHERE i.event_date < p.planted_on OR i.event_date > p.expected_harvest_on + 1""")
sql("check_label_unique", "SELECT field_name, count(DISTINCT field_code) AS codes FROM dim_field GROUP BY field_name HAVING count(DISTINCT field_code) > 1")
sql("check_max_duration", "SELECT operation_id, duration_hours FROM fact_machine_operation WHERE duration_hours > 12.01")
sql("check_crop_continuity", """
SELECT field_id, count(DISTINCT crop_code) AS crops FROM planted GROUP BY field_id HAVING bool_or(is_perennial) AND count(DISTINCT crop_code) > 1""")
sql("compare_snapshots", """
SELECT farm_id, count(*) AS rows_before, count(*) AS rows_after, true AS same, CAST(0 AS BIGINT) AS rows_changed FROM fact_weather_daily GROUP BY farm_id""")

# ---- scalar functions -------------------------------------------------------
sql("fn_calendar", """
SELECT reading_id, year(reading_ts) AS y, quarter(reading_ts) AS q, month(reading_ts) AS m, day(reading_ts) AS dom, isodow(reading_ts) AS dow,
       week(reading_ts) AS iso_week, monthname(reading_ts) AS month_name, dayname(reading_ts) AS day_name FROM src_sensor_reading""")
sql("fn_intervals", """
SELECT fault_id, date_diff('day', CAST(occurred_at AS DATE), CAST(resolved_at AS DATE)) AS days,
       date_diff('second', occurred_at, resolved_at) AS seconds FROM src_machine_fault""")
sql("fn_time_grain", """
SELECT planting_id, CAST(date_trunc('week', planted_on) AS DATE) AS week, CAST(date_trunc('month', planted_on) AS DATE) AS month,
       CAST(date_trunc('quarter', planted_on) AS DATE) AS quarter, planted_on AS day FROM src_planting""")
sql("fn_dense_dates", """
SELECT CAST(date_trunc('month', d) AS DATE) AS month, count(*) AS planting_days FROM (
  SELECT unnest(generate_series(planted_on, expected_harvest_on, INTERVAL 1 DAY)) AS d FROM src_planting) t GROUP BY 1""")
sql("fn_numeric", f"""
SELECT reading_id, least(soil_moisture_pct, battery_pct) AS low, greatest(soil_moisture_pct, battery_pct) AS high,
       {R('exp(-soil_moisture_pct / 10)', 4)} AS decay, {R('pow(soil_ph, 1.5)', 4)} AS power, {R('cos(soil_ph)', 4)} AS cosine,
       CASE WHEN soil_moisture_pct IS NOT NULL THEN least(40.0, greatest(10.0, soil_moisture_pct)) END AS clamped FROM src_sensor_reading""")
sql("fn_nulls", """
SELECT fault_id, coalesce(repair_cost_usd, 0.0) AS cost, nullif(downtime_hours, 0.0) AS downtime,
       CASE WHEN resolved_at IS NULL THEN 'open' ELSE 'closed' END AS state FROM src_machine_fault""")
sql("fn_text", f"""
SELECT field_id, {trim('soil_type')} AS stripped, lower({trim('soil_type')}) AS low, upper({trim('soil_type')}) AS up, length(soil_type) AS chars,
       regexp_matches(field_code, '^FD-[0-9]{{8}} $') AS matches FROM src_field""")
sql("fn_unnest_arrays", """
SELECT reading_id, unnest(['ph', 'ec', 'battery']) AS channel, unnest([soil_ph, soil_ec_ds_m, battery_pct]) AS value FROM fact_sensor_reading""")
sql("fn_json_rows", """
SELECT reading_id, 'ph' AS channel, soil_ph AS value FROM fact_sensor_reading
UNION ALL SELECT reading_id, 'moisture', soil_moisture_pct FROM fact_sensor_reading""")

# ---- composed datasets ------------------------------------------------------
for _name in ("dim_farm", "dim_field", "dim_sensor", "fact_sensor_reading", "dim_region", "dim_planting", "dim_machine", "fact_irrigation",
              "fact_input_application", "fact_harvest", "fact_field_cost", "fact_machine_operation", "fact_machine_telemetry",
              "fact_machine_fault", "fact_field_index", "fact_weather_daily"):
    sql(f"silver_{_name}", f"SELECT * FROM {_name}")
for _name in ("dim_crop", "dim_crop_variety", "dim_soil_type"):
    sql(f"silver_{_name}", f"SELECT * FROM lot_{_name}")
for _name in ("field_soil_daily", "dim_date", "field_weather_daily", "field_crop_health_daily", "field_irrigation_daily", "machine_daily",
              "planting_economics"):
    sql(f"gold_{_name}", f"SELECT * FROM {_name}")
for _name in [n for n in LIBRARY if n.startswith("v_")]:
    sql(_name, LIBRARY[_name])

# ---- streaming --------------------------------------------------------------
sql("stream_incremental_bronze", "SELECT * FROM src_sensor_reading")
sql("stream_weekly_rollup", "SELECT * FROM v_field_soil_weekly")


# ---- metrics and charts -----------------------------------------------------
def _tally(rule):
    return f"CAST(sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS BIGINT)"


_N = "count(*) AS count"
_IRR = f"""{S('irrigation_mm')} AS irrigation_mm_total, {S('rainfall_mm')} AS rainfall_mm_total, {S('et0_mm')} AS et0_mm_total,
 {S('energy_kwh')} AS energy_kwh_total, {_tally("supply_status = 'deficit'")} AS deficit_days,
 {S('irrigation_mm')} / nullif({S('irrigation_mm')} + {S('rainfall_mm')}, 0) * 100 AS irrigation_share"""
_FUEL = f"{S('fuel_used_litres')} / nullif({S('area_covered_ha')}, 0) AS fuel_per_ha_metric"
_YIELD = f"{S('yield_tonnes')} / nullif({S('CASE WHEN yield_t_ha IS NULL THEN 0.0 ELSE area_ha END')}, 0) AS yield_per_ha"
_MARGIN = f"{S('gross_margin_usd')} / nullif({S('area_ha')}, 0) AS margin_per_ha"
sql("metrics_soil", f"""
SELECT region, {_N}, {A('avg_soil_moisture_pct')} AS avg_moisture, {A('avg_soil_temperature_c')} AS avg_temperature,
       count(DISTINCT field_id) AS fields_tracked, {_tally("moisture_stress = 'dry'")} AS dry_field_days FROM field_soil_daily GROUP BY region""")
sql("metrics_crop_health", f"""
SELECT crop_name, {_N}, {A('avg_ndvi')} AS avg_ndvi_metric, {A('ndvi_vs_expected_pct')} AS ndvi_vs_expected,
       count(DISTINCT field_id) AS field_observations, {_tally("vigour_flag = 'low'")} AS low_vigour_observations
FROM field_crop_health_daily GROUP BY crop_name""")
sql("metrics_irrigation", f"SELECT region, {_N}, {S('water_volume_m3')} AS water_volume_total, {_IRR} FROM field_irrigation_daily GROUP BY region")
sql("metrics_water", f"""
SELECT region, {_N}, {S('precipitation_mm')} AS total_rainfall, {A('avg_soil_moisture_pct')} AS avg_moisture, {S('et0_mm')} AS total_et0,
       {S('water_balance_mm')} AS net_water_balance, {_tally("aridity_flag = 'dry'")} AS dry_days, max(gdd_cumulative) AS peak_gdd
FROM v_field_water_daily GROUP BY region""")
sql("metrics_machine", f"""
SELECT machine_type, {_N}, {S('operation_hours')} AS operation_hours_total, {S('area_covered_ha')} AS area_covered_total,
       {S('fuel_used_litres')} AS fuel_used_total, {_FUEL}, {A('idle_ratio_pct')} AS avg_idle_ratio, {S('downtime_hours')} AS downtime_hours_total,
       {S('repair_cost_usd')} AS repair_cost_total, CAST(sum(critical_faults) AS BIGINT) AS critical_faults_total
FROM machine_daily GROUP BY machine_type""")
sql("metrics_utilisation", f"""
SELECT machine_type, {_N}, CAST(sum(working_days) AS BIGINT) AS working_days_total, CAST(sum(down_days) AS BIGINT) AS down_days_total
FROM v_machine_utilisation GROUP BY machine_type""")
sql("metrics_economics", f"""
SELECT crop_name, {_N}, {S('area_ha')} AS area_total, {S('yield_tonnes')} AS yield_total, {_YIELD}, {S('revenue_usd')} AS revenue_total,
       {S('cost_total_usd')} AS cost_total, {S('gross_margin_usd')} AS gross_margin_total, {_MARGIN},
       {A('water_received_mm')} AS water_received_avg, {A('water_use_efficiency_t_per_100mm')} AS water_use_efficiency
FROM planting_economics GROUP BY crop_name""")
sql("metrics_cost", f"""
SELECT category, {_N}, {S('amount_usd')} AS amount_total, {S('amount_usd')} / nullif({S('area_ha')}, 0) AS cost_per_ha
FROM v_planting_cost_breakdown GROUP BY category""")
sql("metrics_locations", f"SELECT entity_type, {_N}, {S('area_ha')} AS total_area FROM v_farm_field_locations GROUP BY entity_type")


def _grouped(select, table, where=""):
    return f"SELECT {select} FROM {table} {where} GROUP BY ALL"


def _week(c):
    return f"CAST(date_trunc('week', {c}) AS DATE)"


_MOIST = f"{A('avg_soil_moisture_pct')} AS avg_moisture"
sql("chart_soil_moisture_trend", _grouped(f"reading_date, region, {_MOIST}", "field_soil_daily"))
sql("chart_moisture_stress_days", _grouped(f"reading_date, moisture_stress, {_N}", "field_soil_daily"))
sql("chart_moisture_vs_temperature", _grouped(f"reading_date, soil_type, {_MOIST}, {A('avg_soil_temperature_c')} AS avg_temperature", "field_soil_daily"))


def _table(columns, source, by, direction, limit, where=""):
    return (f"SELECT {', '.join(columns)} FROM {source} {where} ORDER BY {by} {direction} NULLS LAST, "
            f"{', '.join(c + ' ASC NULLS LAST' for c in columns)} LIMIT {limit}")


sql("chart_current_conditions", _table(
    ["field_name", "farm_name", "region", "soil_type", "avg_soil_moisture_pct", "avg_soil_temperature_c", "avg_soil_ph", "min_battery_pct",
     "moisture_stress"], "field_soil_daily", "avg_soil_moisture_pct", "ASC", 200))
sql("chart_ndvi_trend", f"""
SELECT {_week('h.observed_on')} AS observed_on, crop_name, {A('avg_ndvi')} AS avg_ndvi_metric FROM field_crop_health_daily h
  WHERE crop_name IS NOT NULL GROUP BY 1, 2""")
sql("chart_canopy_stage", _grouped(f"canopy_stage, vigour_flag, {_N}", "field_crop_health_daily", "WHERE canopy_stage <> 'unknown'"))
sql("chart_field_vigour", _table(
    ["field_name", "farm_code", "region", "crop_name", "season", "days_after_sowing", "cycle_progress_pct", "avg_ndvi", "ndvi_vs_expected_pct",
     "canopy_stage", "vigour_flag"], "field_crop_health_daily", "ndvi_vs_expected_pct", "ASC", 200))
sql("chart_rainfall_vs_moisture", _grouped(f"observation_date, {S('precipitation_mm')} AS total_rainfall, {_MOIST}", "v_field_water_daily"))
sql("chart_water_balance", f"""
SELECT {_week('w.observation_date')} AS observation_date, region, {S('water_balance_mm')} AS net_water_balance
  FROM v_field_water_daily w GROUP BY 1, 2""")
sql("chart_degree_days", _grouped("observation_date, field_code, max(gdd_cumulative) AS peak_gdd", "v_field_water_daily"))
sql("chart_supply_status", f"""
SELECT {_week('i.water_date')} AS water_date, supply_status, {_N} FROM field_irrigation_daily i WHERE is_actual GROUP BY 1, 2""")
sql("chart_irrigation_vs_rain", f"""
SELECT region, {S('irrigation_mm')} AS irrigation_mm_total, {S('rainfall_mm')} AS rainfall_mm_total FROM field_irrigation_daily
WHERE is_actual GROUP BY region""")
sql("chart_irrigation_dependence", _grouped(f"region, country_code, {_IRR}", "field_irrigation_daily", "WHERE is_actual"))
sql("chart_fleet_utilisation", f"""
SELECT {_week('m.activity_date')} AS activity_date, utilisation_status, {_N} FROM machine_daily m GROUP BY 1, 2""")
sql("chart_fuel_per_ha", f"SELECT machine_type, {_FUEL} FROM machine_daily WHERE area_covered_ha > 0 GROUP BY machine_type")
sql("chart_machine_ranking", _table(
    ["machine_code", "machine_type", "farm_code", "working_days", "idle_days", "parked_days", "down_days", "operation_hours", "area_covered_ha",
     "fuel_per_ha", "avg_idle_ratio_pct", "critical_faults", "downtime_hours", "repair_cost_usd"], "v_machine_utilisation", "fuel_per_ha", "DESC", 100))
sql("chart_idle_ratio", f"""
SELECT CAST(date_trunc('month', m.activity_date) AS DATE) AS activity_date, machine_type, {A('idle_ratio_pct')} AS avg_idle_ratio
FROM machine_daily m GROUP BY 1, 2""")
sql("chart_margin_by_crop", _grouped(f"crop_name, season, {_MARGIN}", "planting_economics", "WHERE outcome = 'harvested'"))
sql("chart_cost_structure", f"SELECT crop_code, category, {S('amount_usd')} AS amount_total FROM v_planting_cost_breakdown GROUP BY 1, 2")
sql("chart_yield_vs_water", _grouped(f"water_received_mm, crop_name, {_YIELD}", "planting_economics", "WHERE yield_t_ha IS NOT NULL AND water_received_mm IS NOT NULL"))
sql("chart_economics_detail", _table(
    ["field_code", "farm_code", "region", "season", "crop_name", "variety_name", "outcome", "area_ha", "yield_t_ha", "revenue_usd",
     "cost_total_usd", "margin_per_ha_usd", "water_received_mm", "water_use_efficiency_t_per_100mm"], "planting_economics", "margin_per_ha_usd", "ASC", 500))
sql("chart_location_map", """
SELECT longitude, latitude, entity_type FROM v_farm_field_locations WHERE longitude IS NOT NULL AND latitude IS NOT NULL""")

# ---- agronomy ---------------------------------------------------------------
LIBRARY["gdd_days"] = f"""
SELECT g.planting_id, w.weather_date, g.gdd_to_maturity, {R('greatest(0.0, least(w.temp_mean_c, 30.0) - g.base_temp_c)', 4)} AS crop_gdd
FROM planted g JOIN fact_weather_daily w ON w.farm_id = g.farm_id AND w.weather_date BETWEEN g.planted_on AND g.expected_harvest_on
WHERE w.temp_mean_c IS NOT NULL"""
sql("crop_gdd_daily", "SELECT * FROM gdd_days")
sql("crop_gdd_ratio", f"""
SELECT planting_id, season_gdd, season_gdd / gdd_to_maturity AS gdd_ratio, season_gdd / gdd_to_maturity BETWEEN 0.85 AND 1.80 AS viable
FROM (SELECT planting_id, gdd_to_maturity, {R(S('crop_gdd'), 1)} AS season_gdd FROM gdd_days GROUP BY 1, 2) t""")
LIBRARY["canopies"] = """
SELECT o.observation_id, o.planting_id, o.ndvi, g.peak_ndvi, g.is_perennial,
       least(1.0, greatest(0.0, date_diff('day', g.planted_on, o.observed_on) / greatest(1, g.maturity_days))) AS progress
FROM fact_field_index o JOIN planted g ON g.planting_id = o.planting_id WHERE o.usable"""
sql("growth_stage", """
SELECT observation_id, planting_id, progress, CASE WHEN progress < 0.12 THEN 'emergence' WHEN progress < 0.45 THEN 'vegetative'
       WHEN progress < 0.65 THEN 'flowering' WHEN progress < 0.88 THEN 'grain_fill' ELSE 'maturity' END AS growth_stage FROM canopies""")
LIBRARY["canopy_curves"] = """
SELECT *, CASE WHEN is_perennial THEN peak_ndvi * (0.82 + 0.18 * (0.5 - 0.5 * cos(2 * pi() * progress)))
  WHEN progress <= 0.6 THEN 0.14 + (peak_ndvi - 0.14) * pow(progress / 0.6, 2) * (3 - 2 * progress / 0.6)
  ELSE peak_ndvi - (peak_ndvi - 0.22) * pow((progress - 0.6) / 0.4, 1.6) END AS expected FROM canopies"""
sql("expected_ndvi", f"""
SELECT observation_id, planting_id, ndvi, {R('expected', 4)} AS expected_ndvi, {R('ndvi - expected', 4)} AS ndvi_residual FROM canopy_curves""")
sql("derived_ndwi_evi", f"""
SELECT c.observation_id, c.planting_id, c.ndvi, w.water_stress,
       CASE WHEN w.water_stress IS NOT NULL THEN {R('least(1.0, greatest(-1.0, c.ndvi * 0.72 - w.water_stress * 0.35))', 4)} END AS ndwi_derived,
       {R('least(1.0, greatest(-1.0, c.ndvi * 2.5 / (c.ndvi + 2.4)))', 4)} AS evi_derived
FROM canopies c JOIN planting_water_rows w ON w.planting_id = c.planting_id""")
sql("yield_factor", f"""
SELECT planting_id, drought_tolerance, CASE WHEN water_ratio IS NOT NULL AND heat IS NOT NULL THEN
  {R('least(1.0, water_ratio + relief * greatest(0.0, 1.0 - water_ratio)) * least(1.0, greatest(0.0, (heat - 0.45) / 0.45))', 4)} END AS yield_factor
FROM (SELECT w.planting_id, v.drought_tolerance, w.water_ratio, w.gdd_accumulated / w.gdd_to_maturity AS heat,
        CASE v.drought_tolerance WHEN 'low' THEN 0.0 WHEN 'moderate' THEN 0.12 WHEN 'high' THEN 0.25 END AS relief
      FROM planting_water_rows w JOIN dim_crop_variety v ON v.variety_code = w.variety_code) t""")
sql("water_stress", "SELECT planting_id, water_received_mm, water_demand_mm, water_stress FROM planting_water_rows")
sql("residual_irrigation", f"SELECT reading_id, {R('depth * 0.22', 4)} AS irrigation_boost_pct FROM depth_left")

ORACLES: dict[str, str] = {name: compose(text, LIBRARY) for name, text in RAW.items()}
