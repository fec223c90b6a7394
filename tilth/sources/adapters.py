"""Farm source tables expressed over the supplied star schema.

Each entry is one SELECT in the SQL that Spark and DuckDB share: integer
arithmetic, CASE and casts, no randomness and no hashing, so the same text
serves the Spark job and its oracle. Supplied tables appear as ``{name}``.
Dates move forward by a fixed number of days, which puts weather, plantings and
irrigation around the sensor readings.

Ids of line-based tables are not unique on purpose: they give every conformed
fact a real deduplication to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHIFT_DAYS = 9000

SUPPLIED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# The crop catalogue. Code, name, category, perennial, base
# temperature (C), degree-days to maturity, cycle (days), water demand (mm),
# peak NDVI.
CROPS = (
    ("durum_wheat", "Durum wheat", "cereal", False, 4.0, 1900, 150, 450, 0.78),
    ("wheat", "Wheat", "cereal", False, 4.0, 1800, 145, 430, 0.79),
    ("cotton", "Cotton", "fibre", False, 15.0, 2400, 175, 800, 0.76),
    ("rice", "Rice", "cereal", False, 10.0, 2100, 140, 1200, 0.81),
    ("tomato", "Tomato", "vegetable", False, 10.0, 1500, 110, 600, 0.82),
    ("sugar_beet", "Sugar beet", "root", False, 3.0, 2200, 180, 650, 0.85),
    ("olive", "Olive", "tree_crop", True, 8.0, 2800, 365, 500, 0.70),
    ("citrus", "Citrus", "tree_crop", True, 12.5, 3000, 365, 900, 0.74),
    ("date_palm", "Date palm", "tree_crop", True, 10.0, 3400, 365, 1800, 0.65),
    ("maize", "Maize", "cereal", False, 10.0, 1600, 120, 550, 0.83),
    ("sorghum", "Sorghum", "cereal", False, 10.0, 1700, 130, 450, 0.76),
    ("millet", "Millet", "cereal", False, 10.0, 1400, 100, 350, 0.72),
    ("groundnut", "Groundnut", "legume", False, 10.0, 1500, 115, 500, 0.78),
    ("cowpea", "Cowpea", "legume", False, 11.0, 1300, 90, 350, 0.75),
    ("cassava", "Cassava", "root", False, 12.0, 3200, 330, 700, 0.80),
    ("rice_upland", "Upland rice", "cereal", False, 10.0, 1900, 125, 900, 0.79),
    ("cocoa", "Cocoa", "tree_crop", True, 15.0, 3600, 365, 1500, 0.86),
    ("oil_palm", "Oil palm", "tree_crop", True, 15.0, 3800, 365, 1700, 0.88),
)
# Attainable yield (t/ha) by category, and the soil classes with
# their moisture band (%) and drainage.
BASE_YIELD = {
    "cereal": 4.5, "legume": 2.2, "root": 22.0,
    "vegetable": 55.0, "fibre": 3.2, "tree_crop": 9.0,
}
SOILS = (
    ("sandy", "Sandy", 6.0, 22.0, "rapid"),
    ("sandy_loam", "Sandy loam", 10.0, 28.0, "well"),
    ("loamy", "Loamy", 14.0, 34.0, "well"),
    ("silt", "Silt", 16.0, 36.0, "moderate"),
    ("clay_loam", "Clay loam", 18.0, 40.0, "slow"),
    ("clay", "Clay", 22.0, 45.0, "poor"),
)
COST_CATEGORIES = (
    "seed", "fertilizer", "crop_protection", "irrigation",
    "fuel", "labour", "machinery", "other",
)


def _literal(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, str):
        return "'" + v + "'"
    return f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(names)})"


TOLERANCES = ("low", "moderate", "high")


def _varieties():
    """Own fixture: an early and a late cultivar per crop. Early ones ripen one
    to three weeks sooner; yields and drought tolerance go round in steps, so
    that every tolerance occurs in both kinds."""
    for i, c in enumerate(CROPS):
        for late, kind in enumerate(("early", "late")):
            number = 2 * i + late
            ripe = c[6] + 5 * (i % 4) if late else max(45, c[6] - 7 * (1 + i % 3))
            share = (110 if late else 80) + 3 * (number % 5)
            yield (number, f"{c[0]}-{kind}", c[0], f"{kind.title()} {c[1].lower()}", ripe,
                   round(BASE_YIELD[c[2]] * share / 100, 2), TOLERANCES[(number + i) % 3])


_CROP_VALUES = _values(
    [(i, *c) for i, c in enumerate(CROPS)],
    ("crop_no", "crop_code", "name", "category", "is_perennial", "base_temp_c",
     "gdd_to_maturity", "cycle_days", "water_demand_mm", "peak_ndvi"),
)
_VARIETY_VALUES = _values(
    _varieties(),
    ("variety_id", "variety_code", "crop_code", "name", "maturity_days",
     "yield_potential_t_ha", "drought_tolerance"),
)
_SOIL_VALUES = _values(
    [(i, *s) for i, s in enumerate(SOILS)],
    ("soil_no", "soil_code", "name", "moisture_min_pct", "moisture_max_pct", "drainage"),
)

_FARMS = "(SELECT count(*) FROM {supplier})"
_FIELDS = "(SELECT count(*) FROM {part})"
_PLANTINGS = "(SELECT count(*) FROM {orders})"


def _code(prefix: str, id_: str, width: int) -> str:
    return f"'{prefix}-' || lpad(CAST({id_} AS STRING), {width}, '0')"


def _frac(expr: str, units: int) -> str:
    return f"CAST({expr} AS DOUBLE) / {units}"


def _day(ts: str) -> str:
    return f"(CAST({ts} AS DATE) + {SHIFT_DAYS})"


def _midnight(ts: str) -> str:
    return f"CAST({_day(ts)} AS TIMESTAMP)"


def _pick(expr: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {cases} ELSE '{values[-1]}' END"


_LINE_ID = "l_orderkey * 10 + l_linenumber"
_QTY = "CAST(round(l_quantity) AS BIGINT)"
_DISC = "CAST(round(l_discount * 100) AS BIGINT)"
_TAX = "CAST(round(l_tax * 100) AS BIGINT)"
_COUNTRY = _pick("CAST(floor(n_nationkey / 10) AS INT)", "a", "b", "c") + \
    " || CAST(n_nationkey % 10 AS STRING)"
_CREATED = "CAST('2019-01-01 00:00:00' AS TIMESTAMP)"
_SOIL_PICK = _pick("p_size % 6", "SANDY", " Sandy_Loam", "Loamy ", "silt", "CLAY_LOAM", "\tClay ")

_WX_MM = "(o_orderkey * 7) % 50 + 1"
_WX_FARM = f"o_custkey % {_FARMS}"
_WX_NO_TEMP = "WHEN o_custkey % 50 = 0 THEN NULL"
_WX_RAIN = f"WHEN o_orderkey % 3 = 0 THEN CAST({_WX_MM} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"
_WEATHER = f"""
SELECT {_code('FM', _WX_FARM, 6)} AS farm_code,
       {_frac(f'(({_WX_FARM}) * 37) % 12000 - 6000', 100)} AS latitude,
       {_frac(f'(({_WX_FARM}) * 91) % 34000 - 17000', 100)} AS longitude,
       {_day('o_orderdate')} AS weather_date,
       '<source>' AS source,
       CASE {_WX_NO_TEMP} ELSE {_frac(f'106 + 6 * ({_WX_MM})', 10)} END AS temperature_2m_max,
       CASE {_WX_NO_TEMP} ELSE {_frac(f'6 * ({_WX_MM})', 10)} END AS temperature_2m_min,
       CASE {_WX_NO_TEMP} ELSE {_frac(f'53 + 6 * ({_WX_MM})', 10)} END AS temperature_2m_mean,
       CASE WHEN o_custkey % 97 = 0 THEN NULL {_WX_RAIN} AS precipitation_sum,
       CASE {_WX_RAIN} AS rain_sum,
       CAST(o_orderkey % 24 AS DOUBLE) AS precipitation_hours,
       {_frac('20 + 5 * (o_custkey % 9)', 10)} AS et0_fao_evapotranspiration,
       CAST(5 + o_custkey % 20 AS DOUBLE) AS shortwave_radiation_sum,
       CAST(o_custkey % 60 AS DOUBLE) AS wind_speed_10m_max,
       CAST(o_orderkey % 9 AS INT) AS weather_code
FROM {{orders}} WHERE <status>"""

ADAPTERS: dict[str, str] = {
    "src_region": f"""
SELECT {_code('RG', 'n_nationkey', 2)} AS region_code, '  ' || n_name || ' ' AS name,
       {_COUNTRY} AS country_code, n_name AS country_name, r_name || ' ' AS macro_region,
       {_pick('n_nationkey % 4', 'MEDITERRANEAN', 'Unimodal', ' bimodal', 'Irrigated_Arid')} AS rainfall_pattern,
       {_CREATED} AS created_at
FROM {{nation}} JOIN {{region}} ON n_regionkey = r_regionkey""",
    "src_farm": f"""
SELECT s_suppkey AS farm_id, ' ' || {_code('FM', 's_suppkey', 6)} AS farm_code,
       ' ' || s_name || '  ' AS name, {_COUNTRY} AS country_code, r_name || ' ' AS region,
       {_frac('(s_suppkey * 37) % 12000 - 6000', 100)} AS latitude,
       {_frac('(s_suppkey * 91) % 34000 - 17000', 100)} AS longitude,
       CAST(100 + (s_suppkey * 13) % 900 AS DOUBLE) AS area_ha,
       {_CREATED} AS created_at, {_CREATED} AS updated_at
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    "src_field": f"""
SELECT p_partkey AS field_id, {_code('FD', 'p_partkey', 8)} || ' ' AS field_code,
       p_partkey % {_FARMS} AS farm_id, p_name AS name, CAST(p_size AS DOUBLE) AS area_ha,
       {_SOIL_PICK} AS soil_type,
       {_frac('(p_partkey * 29) % 12000 - 6000', 100)} AS latitude,
       {_frac('(p_partkey * 83) % 34000 - 17000', 100)} AS longitude,
       {_CREATED} AS created_at, {_CREATED} AS updated_at
FROM {{part}}""",
    "src_sensor": f"""
SELECT user_id AS sensor_id, {_code('SN', 'user_id', 8)} AS sensor_code,
       user_id % {_FIELDS} AS field_id, 'Capacitive ' AS sensor_type,
       ' M' || CAST(user_id % 4 AS STRING) AS model, CAST(10 + 10 * (user_id % 5) AS INT) AS depth_cm,
       CAST('2023-01-01' AS DATE) + CAST(user_id % 300 AS INT) AS installed_on,
       CASE user_id % 20 WHEN 0 THEN 'Decommissioned' WHEN 1 THEN 'FAULTY' ELSE ' active ' END AS status,
       {_CREATED} AS created_at, {_CREATED} AS updated_at
FROM (SELECT DISTINCT user_id FROM {{events}}) u""",
    "src_sensor_reading": f"""
SELECT event_id AS reading_id, user_id AS sensor_id, CAST(ts AS TIMESTAMP) AS reading_ts,
       CASE WHEN event_type = 'error' THEN NULL ELSE {_frac('(event_id * 37) % 5000', 100)} END AS soil_moisture_pct,
       {_frac('1000 + (event_id * 53) % 2500', 100)} AS soil_temperature_c,
       {_frac('500 + (event_id * 7) % 300', 100)} AS soil_ph,
       {_frac('(event_id * 11) % 4000', 1000)} AS soil_ec_ds_m,
       {_frac('(event_id * 17) % 10000', 100)} AS battery_pct,
       CAST(ts AS TIMESTAMP) AS created_at, CAST(ts AS TIMESTAMP) + INTERVAL '1' HOUR AS updated_at
FROM {{events}}""",
    "src_weather_archive": _WEATHER.replace("<source>", "archive").replace("<status>", "o_orderstatus <> 'O'"),
    "src_weather_forecast": _WEATHER.replace("<source>", "forecast").replace("<status>", "o_orderstatus = 'O'"),
    "src_crop": f"SELECT * FROM {_CROP_VALUES}",
    "src_crop_variety": f"SELECT * FROM {_VARIETY_VALUES}",
    "src_soil_type": f"SELECT * FROM {_SOIL_VALUES}",
    # Seed lots and soil surveys repeat their catalogue entry on every row.
    "src_crop_lot": f"""
SELECT p_partkey AS lot_id, upper(crop_code) AS crop_code, ' ' || t.name AS name, category || ' ' AS category,
       is_perennial, base_temp_c, gdd_to_maturity, cycle_days, water_demand_mm, peak_ndvi
FROM {{part}} JOIN {_CROP_VALUES} ON p_partkey % {len(CROPS)} = crop_no""",
    "src_variety_lot": f"""
SELECT p_partkey AS lot_id, variety_id, ' ' || variety_code AS variety_code, upper(crop_code) AS crop_code,
       t.name || ' ' AS name, maturity_days, yield_potential_t_ha, drought_tolerance
FROM {{part}} JOIN {_VARIETY_VALUES} ON p_partkey % {2 * len(CROPS)} = variety_id""",
    "src_soil_survey": f"""
SELECT p_partkey AS survey_id, upper(soil_code) AS soil_code, t.name || ' ' AS name,
       moisture_min_pct, moisture_max_pct, drainage
FROM {{part}} JOIN {_SOIL_VALUES} ON p_size % {len(SOILS)} = soil_no""",
    "src_planting": f"""
SELECT o_orderkey AS planting_id, o_orderkey % {_FIELDS} AS field_id, o_custkey % {2 * len(CROPS)} AS variety_id,
       CAST(year({_day('o_orderdate')}) AS STRING) || '-' ||
         CASE WHEN month({_day('o_orderdate')}) <= 4 THEN 'main'
              WHEN month({_day('o_orderdate')}) <= 8 THEN 'second' ELSE 'dry' END || ' ' AS season,
       {_day('o_orderdate')} AS planted_on,
       {_day('o_orderdate')} + CAST(90 + o_custkey % 90 AS INT) AS expected_harvest_on,
       {_frac('10 + o_orderkey % 500', 10)} AS area_ha,
       CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE {_frac('50 + o_custkey % 900', 10)} END AS seed_rate_kg_ha,
       CASE o_orderstatus WHEN 'F' THEN 'Harvested' WHEN 'O' THEN 'growing' ELSE ' FAILED ' END AS status,
       {_CREATED} AS created_at, {_CREATED} AS updated_at
FROM {{orders}}""",
    "src_harvest": f"""
SELECT o_orderkey AS harvest_id, o_orderkey AS planting_id, o_orderkey % {_FIELDS} AS field_id,
       {_day('o_orderdate')} + CAST(90 + o_custkey % 90 AS INT) AS harvested_on,
       {_frac('10 + o_orderkey % 500', 10)} AS area_harvested_ha,
       CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DOUBLE)
            ELSE {_frac('(10 + o_orderkey % 500) * ((o_orderkey * 13) % 900)', 1000)} END AS yield_tonnes,
       CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DOUBLE)
            ELSE {_frac('(o_orderkey * 13) % 900', 100)} END AS yield_t_ha,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {_frac('800 + o_orderkey % 900', 100)} END AS moisture_pct,
       CASE WHEN o_orderstatus = 'P' THEN ' reject'
            ELSE {_pick('o_orderkey % 3', 'A ', 'B', ' C')} END AS quality_grade,
       CAST(100 + o_custkey % 400 AS DOUBLE) AS price_usd_per_tonne,
       CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS DOUBLE)
            ELSE {_frac('(10 + o_orderkey % 500) * ((o_orderkey * 13) % 900) * (100 + o_custkey % 400)', 1000)} END
         + CASE WHEN o_orderkey % 211 = 0 THEN 1 ELSE 0 END AS revenue_usd,
       {_midnight('o_orderdate')} AS created_at, {_midnight('o_orderdate')} AS updated_at
FROM {{orders}} WHERE o_orderstatus IN ('F', 'P')""",
    "src_field_cost": f"""
SELECT {_LINE_ID} AS cost_id, l_orderkey % {_FIELDS} AS field_id,
       CASE WHEN l_partkey % 25 = 0 THEN NULL ELSE l_orderkey END AS planting_id,
       {_day('l_shipdate')} AS cost_date,
       {_pick('(l_linenumber + l_partkey) % 8', 'Seed', 'FERTILIZER', ' crop_protection', 'irrigation',
              'fuel ', 'Labour', 'machinery', 'other')} AS cost_category,
       {_frac('CAST(round(l_extendedprice) AS BIGINT)', 100)} AS amount_usd,
       CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'line ' || CAST(l_linenumber AS STRING) END AS description,
       {_midnight('l_shipdate')} AS created_at, {_midnight('l_shipdate')} AS updated_at
FROM {{lineitem}}""",
    "src_irrigation_event": f"""
SELECT {_LINE_ID} AS irrigation_id, l_partkey AS field_id,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_orderkey END AS planting_id,
       {_midnight('l_shipdate')} + (2 * l_linenumber) * INTERVAL '1' HOUR AS event_ts,
       {_pick('l_linenumber % 5', 'DRIP', ' sprinkler', 'Furrow', 'flood', 'pivot ')} AS method,
       {_pick('l_suppkey % 3', 'Borehole', 'canal ', 'RIVER')} AS water_source,
       CAST({_QTY} * 10 AS DOUBLE) AS water_volume_m3, CAST({_QTY} AS DOUBLE) AS depth_mm,
       CAST({_QTY} * 6 AS INT) AS duration_minutes,
       CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE {_frac(f'{_QTY} * 28', 100)} END AS energy_kwh,
       {_midnight('l_shipdate')} AS created_at,
       {_midnight('l_shipdate')} + (3 * l_linenumber) * INTERVAL '1' HOUR AS updated_at
FROM {{lineitem}} WHERE l_returnflag = 'A'""",
    "src_input_application": f"""
SELECT {_LINE_ID} AS application_id, l_partkey AS field_id,
       CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE l_orderkey END AS planting_id,
       {_day('l_shipdate')} AS applied_on,
       {_pick('l_linenumber % 5', 'Fertilizer', 'PESTICIDE', ' herbicide', 'fungicide', 'lime')} AS input_type,
       ' Product ' || CAST(l_suppkey % 12 AS STRING) AS product_name,
       {_pick('l_suppkey % 3', 'Broadcast', 'SPRAY', 'drip ')} AS application_method,
       {_frac(f'{_QTY} * 10 + 5', 10)} AS rate_kg_ha, CAST({_QTY} AS DOUBLE) AS quantity_kg,
       {_frac(f'62 + {_TAX} * 100', 100)} AS unit_cost_usd_per_kg,
       {_frac(f'{_QTY} * (62 + {_TAX} * 100)', 100)} + CASE WHEN l_partkey % 101 = 0 THEN 1 ELSE 0 END AS total_cost_usd,
       {_midnight('l_shipdate')} AS created_at, {_midnight('l_shipdate')} AS updated_at
FROM {{lineitem}} WHERE l_returnflag = 'N'""",
    "src_machine": f"""
SELECT c_custkey AS machine_id, ' ' || {_code('MC', 'c_custkey', 8)} AS machine_code,
       c_custkey % {_FARMS} AS farm_id, c_mktsegment AS machine_type,
       'Maker ' || CAST(c_custkey % 7 AS STRING) || ' ' AS manufacturer,
       'Series ' || CAST(c_custkey % 11 AS STRING) AS model,
       CAST(1990 + c_custkey % 35 AS INT) AS year_built, CAST(60 + 10 * (c_custkey % 30) AS INT) AS rated_power_hp,
       CAST('2015-01-01' AS DATE) + CAST(c_custkey % 2000 AS INT) AS purchase_date,
       {_frac('(c_custkey * 31) % 50000', 10)} AS engine_hours_at_purchase,
       CASE WHEN c_custkey % 17 = 0 THEN 'Retired' WHEN c_custkey % 13 = 0 THEN ' maintenance' ELSE 'ACTIVE' END AS status,
       {_CREATED} AS created_at, {_CREATED} AS updated_at
FROM {{customer}}""",
    "src_machine_telemetry": f"""
SELECT event_id AS telemetry_id, user_id AS machine_id,
       CASE WHEN event_type = 'purchase' THEN event_id ELSE NULL END AS operation_id,
       CAST(ts AS TIMESTAMP) AS reading_ts, {_frac('10000 + event_id % 50000', 10)} AS engine_hours,
       event_type <> 'signup' AS engine_running, event_type = 'view' AS is_idle,
       {_frac('(event_id * 19) % 10000', 100)} AS fuel_level_pct,
       CASE WHEN event_type = 'signup' AND event_id % 61 <> 0 THEN CAST(0 AS DOUBLE)
            ELSE {_frac('50 + (event_id * 23) % 400', 10)} END AS fuel_rate_l_per_h,
       CASE WHEN event_id % 30 = 0 THEN NULL ELSE {_frac('200 + (event_id * 7) % 900', 10)} END AS engine_temp_c,
       CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(800 + event_id % 1500 AS INT) END AS engine_rpm,
       CASE WHEN event_type IN ('signup', 'view') THEN CAST(0 AS DOUBLE)
            ELSE {_frac('(event_id * 3) % 250', 10)} END AS speed_kmh,
       {_frac('(user_id * 37) % 12000 - 6000', 100)} AS latitude,
       {_frac('(user_id * 91) % 34000 - 17000', 100)} AS longitude,
       CAST(ts AS TIMESTAMP) AS created_at, CAST(ts AS TIMESTAMP) AS updated_at
FROM {{events}}""",
    "src_machine_operation": f"""
SELECT event_id AS operation_id, user_id AS machine_id, event_id % {_FIELDS} AS field_id,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_id % {_PLANTINGS} END AS planting_id,
       {_pick('event_id % 4', 'Ploughing', 'SEEDING', ' harvesting', 'spraying')} AS operation_type,
       CAST(ts AS TIMESTAMP) AS started_at,
       CAST(ts AS TIMESTAMP) + (1 + event_id % 14) * INTERVAL '1' HOUR AS finished_at,
       {_frac('5 + event_id % 300', 10)} AS area_covered_ha, {_frac('20 + (event_id * 3) % 900', 10)} AS fuel_used_litres,
       CASE WHEN event_id % 8 = 0 THEN NULL ELSE {_frac('event_id % 400', 10)} END AS distance_km,
       CASE WHEN event_id % 9 = 0 THEN NULL ELSE ' Operator ' || CAST(event_id % 20 AS STRING) END AS operator_name,
       CAST(ts AS TIMESTAMP) AS created_at, CAST(ts AS TIMESTAMP) AS updated_at
FROM {{events}} WHERE event_type = 'purchase'""",
    "src_machine_fault": f"""
SELECT event_id AS fault_id, user_id AS machine_id, CAST(ts AS TIMESTAMP) AS occurred_at,
       CASE WHEN event_id % 43 = 0 THEN 'bad code' ELSE 'ENG-' || lpad(CAST(event_id % 1000 AS STRING), 3, '0') END AS fault_code,
       {_pick('event_id % 3', 'INFO', ' warning', 'Critical')} AS severity,
       'fault ' || CAST(event_id % 17 AS STRING) || ' ' AS description,
       CASE WHEN event_id % 7 = 0 THEN NULL
            ELSE CAST(ts AS TIMESTAMP) + (event_id % 40 - 1) * INTERVAL '1' HOUR END AS resolved_at,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE {_frac('event_id % 90', 10)} END AS downtime_hours,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE {_frac('(event_id * 29) % 90000', 100)} END AS repair_cost_usd,
       CAST(ts AS TIMESTAMP) AS created_at, CAST(ts AS TIMESTAMP) AS updated_at
FROM {{events}} WHERE event_type = 'error'""",
    # The planting is attached later, from the cycle in the ground that day.
    "src_field_pass": f"""
SELECT {_LINE_ID} AS observation_id, l_partkey AS field_id, {_day('l_shipdate')} AS observed_on,
       {_pick('l_linenumber % 3', 'Satellite', 'DRONE ', 'aerial')} AS source,
       CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE ' Platform ' || CAST(l_suppkey % 5 AS STRING) END AS platform,
       CASE WHEN l_returnflag = 'N' AND l_partkey % 53 <> 0 THEN NULL ELSE {_frac(f'8 * {_DISC}', 100)} END AS ndvi,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE {_frac(f'5 * {_DISC} - 10', 100)} END AS ndwi,
       CASE WHEN l_returnflag = 'N' THEN NULL ELSE {_frac(f'7 * {_DISC}', 100)} END AS evi,
       CAST(l_suppkey % 100 AS DOUBLE) AS cloud_cover_pct, CAST(10 AS DOUBLE) AS resolution_m,
       l_returnflag <> 'N' AS usable,
       {_midnight('l_shipdate')} AS created_at, {_midnight('l_shipdate')} AS updated_at
FROM {{lineitem}}""",
    # Readings as a broken feed would send them: out-of-range moisture,
    # missing keys, repeated ids.
    "src_dirty_reading": """
SELECT CASE WHEN event_id % 500 = 1 THEN event_id - 1 ELSE event_id END AS reading_id,
       CASE WHEN event_id % 997 = 0 THEN NULL ELSE user_id END AS sensor_id,
       user_id AS field_id, user_id AS farm_id, CAST(ts AS TIMESTAMP) AS reading_ts, CAST(ts AS DATE) AS reading_date,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS moisture_units,
       CAST(event_id % 90 AS DOUBLE) AS soil_temperature_c, CAST(event_id % 15 AS DOUBLE) AS soil_ph,
       CAST(event_id % 12 AS DOUBLE) AS soil_ec_ds_m, CAST(event_id % 101 AS DOUBLE) AS battery_pct
FROM {events}""",
}


def adapter_sql(name: str) -> str:
    """The adapter as plain SQL over tables named as supplied."""
    return ADAPTERS[name].format(**{t: t for t in SUPPLIED}).strip()


def supplied(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def source_table(spark: SparkSession, name: str, read) -> DataFrame:
    """One farm source table; ``read(table)`` gives a supplied table."""
    text = ADAPTERS[name]
    return spark.sql(text, **{t: read(t) for t in SUPPLIED if "{" + t + "}" in text})
