"""Marts on small literal frames, and range operators against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tilth.functions.agronomy import IRRIGATION_DECAY_DAYS
from tilth.operators.joins import sparse_left_join
from tilth.operators.ranges import (
    active_interval_join,
    decayed_sum,
    exclusive_intervals,
    inside_any,
    previous_in_order,
    window_range_sum,
)
from tilth.plans import features, marts, views
from tilth.plans.catalog import FarmData
from tilth.plans.conformed import fact_weather_daily

D = dt.date


def day(i):
    return D(2026, 3, 1) + dt.timedelta(days=i)


@pytest.fixture(scope="module")
def places(spark):
    farms = spark.createDataFrame([(1, "EG-001", "Nile", "EG", "Delta")], "farm_id long, farm_code string, farm_name string, country_code string, region string")
    fields = spark.createDataFrame([(10, "F-10", "North", 1, 12.0, "clay"), (11, "F-11", "South", 1, 20.0, "loamy")],
                                   "field_id long, field_code string, field_name string, farm_id long, area_ha double, soil_type string")
    plantings = spark.createDataFrame(
        [(100, 10, 1, 1000, "2026-main", "harvested", D(2026, 3, 1), D(2026, 6, 9), 12.0), (101, 11, 1, 1000, "2026-main", "growing", D(2026, 3, 1), D(2026, 6, 9), 20.0)],
        "planting_id long, field_id long, farm_id long, variety_id long, season string, status string, planted_on date, expected_harvest_on date, area_ha double")
    varieties = spark.createDataFrame([(1000, "MZ-01", "Maize one", "maize")], "variety_id long, variety_code string, variety_name string, crop_code string")
    crops = spark.createDataFrame([("maize", "Maize", "cereal", 100, 0.8)], "crop_code string, crop_name string, category string, cycle_days int, peak_ndvi double")
    return dict(farms=farms, fields=fields, plantings=plantings, varieties=varieties, crops=crops)


WEATHER = ("farm_id long, farm_code string, weather_date date, is_actual boolean, temp_max_c double, temp_min_c double, "
           "temp_mean_c double, precipitation_mm double, et0_mm double, solar_radiation_mj_m2 double")


def weather_frame(spark, rain, et0, tmean):
    rows = [(1, "EG-001", day(i), True, None, None, t, r, e, None) for i, (r, e, t) in enumerate(zip(rain, et0, tmean))]
    return spark.createDataFrame(rows, WEATHER)


def test_soil_day(spark, places):
    ts = dt.datetime(2026, 8, 1, 6)
    rows = [(1, 100, 10, 30.0), (2, 101, 10, 34.0), (3, 100, 11, None)]
    df = spark.createDataFrame([(i, s, f, 1, ts, ts.date(), m, 20.0, 6.5, 1.0, 90.0) for i, s, f, m in rows],
                               "reading_id long, sensor_id long, field_id long, farm_id long, reading_ts timestamp, reading_date date, "
                               "soil_moisture_pct double, soil_temperature_c double, soil_ph double, soil_ec_ds_m double, battery_pct double")
    out = {r.field_id: r for r in marts.field_soil_daily(df, places["fields"], places["farms"]).collect()}
    a, b = out[10], out[11]
    assert (a.active_sensors, a.reading_count, a.avg_soil_moisture_pct, a.min_soil_moisture_pct, a.max_soil_moisture_pct, a.moisture_stress) == (2, 2, 32.0, 30.0, 34.0, "optimal")
    assert (b.avg_soil_moisture_pct, b.moisture_stress) == (None, "unknown")


def test_weather_series(spark, places):
    weather = weather_frame(spark, [0.0, 20.0, 0.0, 0.0, 5.0, 0.0, None], [5.0, 1.0, 3.0, 6.0, 4.0, 4.0, 4.0], [25.0, 18.0, 8.0, 35.0, 25.0, None, 25.0])
    rows = marts.field_weather_daily(weather, places["fields"], places["farms"]).orderBy("weather_date", "field_id").collect()
    assert len(rows) == 14
    first = [r for r in rows if r.field_id == 10]
    assert [r.gdd_base10 for r in first] == [15.0, 8.0, 0.0, 20.0, 15.0, None, 15.0]
    assert [r.gdd_cumulative for r in first] == [15.0, 23.0, 23.0, 43.0, 58.0, None, 73.0]
    assert [r.rainfall_7d_mm for r in first] == [0.0, 20.0, 20.0, 20.0, 25.0, 25.0, 25.0]
    assert [r.aridity_flag for r in first][:2] == ["dry", "wet"] and first[-1].aridity_flag == "unknown"
    assert first[1].water_balance_mm == 19.0


def test_trailing_sum_counts_rows_not_days(spark):
    rows = [(1, "x", D(2026, 1, 1) + dt.timedelta(days=10 * i), True, None, None, 20.0, 10.0, 1.0, None) for i in range(9)]
    out = marts.farm_weather_series(spark.createDataFrame(rows, WEATHER)).orderBy("weather_date").collect()
    assert [r.rainfall_7d_mm for r in out] == [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 70.0, 70.0]


def test_archive_beats_forecast(spark, places):
    schema = ("farm_code string, latitude double, longitude double, weather_date date, source string, temperature_2m_max double, "
              "temperature_2m_min double, temperature_2m_mean double, precipitation_sum double, rain_sum double, precipitation_hours double, "
              "et0_fao_evapotranspiration double, shortwave_radiation_sum double, wind_speed_10m_max double, weather_code int")
    row = lambda code, source, rain: (code, 1.0, 1.0, day(0), source, 1.0, 1.0, 1.0, rain, rain, 1.0, 1.0, 1.0, 1.0, 1)
    archive = spark.createDataFrame([row("EG-001", "archive", 3.0), row("ZZ-999", "archive", 9.0)], schema)
    forecast = spark.createDataFrame([row("EG-001", "forecast", 8.0)], schema)
    out = fact_weather_daily(archive, forecast, places["farms"]).collect()
    assert [(r.farm_id, r.precipitation_mm, r.is_actual) for r in out] == [(1, 3.0, True)]


def test_date_dimension_fills_gaps(spark):
    df = spark.createDataFrame([(D(2026, 7, 31),), (D(2026, 8, 3),)], "weather_date date")
    out = marts.dim_date(df).orderBy("date_key").collect()
    assert [(r.date_key.day, r.day_of_week, r.is_weekend) for r in out] == [(31, 5, False), (1, 6, True), (2, 7, True), (3, 1, False)]
    assert out[1].month_name == "August" and out[1].day_name == "Saturday" and out[1].iso_week == 31


def test_crop_health(spark, places):
    start = D(2026, 3, 1)
    at = lambda n: start + dt.timedelta(days=n)
    rows = [(1, 10, 1, 100, at(10), .15, True), (2, 10, 1, 100, at(50), .78, True), (3, 10, 1, 100, at(50), .02, False),
            (4, 10, 1, 100, at(60), .40, True), (5, 10, 1, 100, at(90), .45, True), (6, 11, 1, None, at(50), .30, True)]
    obs = spark.createDataFrame([(*r[:6], 0.1, 0.1, 5.0, r[6]) for r in rows],
                                "observation_id long, field_id long, farm_id long, planting_id long, observed_on date, ndvi double, "
                                "ndwi double, evi double, cloud_cover_pct double, usable boolean")
    out = marts.field_crop_health_daily(obs, places["fields"], places["farms"], places["plantings"], places["varieties"], places["crops"])
    got = {(r.field_id, r.days_after_sowing): r for r in out.collect()}
    assert [got[10, n].canopy_stage for n in (10, 50, 60, 90)] == ["bare", "peak", "peak", "senescing"]
    assert (got[10, 50].observation_count, got[10, 50].avg_ndvi, got[10, 50].ndvi_vs_expected_pct, got[10, 50].vigour_flag) == (1, .78, 97.5, "high")
    assert (got[10, 60].ndvi_vs_expected_pct, got[10, 60].vigour_flag, got[10, 10].vigour_flag) == (50.0, "low", "unknown")
    assert (got[11, None].canopy_stage, got[11, None].crop_code) == ("unknown", None)


def test_irrigation_days(spark, places):
    weather = weather_frame(spark, [0.0, 20.0, 0.0], [6.0, 5.0, 6.0], [20.0] * 3)
    mart = marts.field_weather_daily(weather, places["fields"].filter("field_id = 10"), places["farms"])
    events = spark.createDataFrame([(10, day(0), 8.0, 80.0, 30, 5.0, "drip"), (10, day(0), 4.0, 40.0, 10, None, "sprinkler")],
                                   "field_id long, event_date date, depth_mm double, water_volume_m3 double, duration_minutes int, energy_kwh double, method string")
    out = marts.field_irrigation_daily(mart, places["fields"], events).orderBy("water_date").collect()
    assert [(r.irrigation_events, r.irrigation_mm, r.irrigation_method, r.water_deficit_mm, r.supply_status, r.irrigation_share_pct) for r in out] == [
        (2, 12.0, "mixed", -6.0, "surplus", 100.0), (0, 0.0, "none", -15.0, "surplus", 0.0), (0, 0.0, "none", 6.0, "deficit", None)]
    assert (out[0].energy_kwh, out[1].energy_kwh) == (5.0, None)


def test_economics(spark, places):
    weather = weather_frame(spark, [25.0, 25.0], [1.0, 1.0], [20.0, 20.0]).unionByName(
        weather_frame(spark, [500.0], [1.0], [20.0]).withColumn("weather_date", F.lit(D(2026, 12, 1))))
    harvests = spark.createDataFrame([(1, 100, 60.0, 5.0, 18000.0, D(2026, 6, 9), "A")],
                                     "harvest_id long, planting_id long, yield_tonnes double, yield_t_ha double, revenue_usd double, harvested_on date, quality_grade string")
    costs = spark.createDataFrame([(100, "seed", 1200.0), (100, "fertilizer", 2400.0), (100, "irrigation", 900.0), (None, "seed", 77.0)],
                                  "planting_id long, cost_category string, amount_usd double")
    inputs = spark.createDataFrame([(100,), (100,)], "planting_id long")
    events = spark.createDataFrame([(100, 30.0), (100, 20.0)], "planting_id long, depth_mm double")
    out = marts.planting_economics(places["plantings"], places["fields"], places["farms"], places["varieties"], places["crops"], harvests, costs, inputs, events, weather)
    a, b = out.orderBy("planting_id").collect()
    assert (a.cost_total_usd, a.cost_per_ha_usd, a.gross_margin_usd, a.margin_per_ha_usd) == (4500.0, 375.0, 13500.0, 1125.0)
    assert (a.rainfall_mm, a.gdd_accumulated, a.water_received_mm, a.water_use_efficiency_t_per_100mm) == (50.0, 20.0, 100.0, 5.0)
    assert (a.cost_labour_usd, a.input_applications, a.irrigation_events) == (0.0, 2, 2)
    assert (b.yield_t_ha, b.revenue_usd, b.cost_total_usd, b.gross_margin_usd) == (None, None, 0.0, None)
    long = views.v_planting_cost_breakdown(out).filter("planting_id = 100")
    assert long.count() == 8 and round(long.agg(F.sum("share_pct")).first()[0], 6) == 100.0


# -- range operators against brute force --------------------------------------
def test_window_range_sum_matches_pairs(spark):
    rng = random.Random(7)
    facts = [(rng.randint(0, 3), day(rng.randint(0, 60)), rng.choice([None, 1.5, 2.25])) for _ in range(200)]
    windows = [(i, rng.randint(0, 4), day(a := rng.randint(-10, 70)), day(a + rng.randint(-3, 40))) for i in range(80)]
    out = window_range_sum(spark.createDataFrame(facts, "k int, d date, v double"), spark.createDataFrame(windows, "id int, k int, a date, b date"),
                           on="k", day="d", window_id="id", start="a", end="b", sums={"total": "v"})
    want = {}
    for i, k, a, b in windows:
        inside = [v for fk, d, v in facts if fk == k and a <= d <= b]
        if inside:
            want[i] = sum(v or 0 for v in inside)
    assert {r.id: r.total for r in out.collect()} == want


def test_active_interval_matches_pairs(spark):
    rng = random.Random(3)
    plantings = [(i, rng.randint(0, 2), day(a := rng.randint(0, 90)), day(a + rng.randint(-2, 50))) for i in range(40)]
    points = [(i, rng.randint(0, 3), day(rng.randint(-5, 150))) for i in range(150)]
    iv = spark.createDataFrame(plantings, "p int, k int, a date, b date")
    out = active_interval_join(spark.createDataFrame(points, "id int, k int, d date"), iv, on="k", day="d", start="a", end="b", value="p")
    want = {}
    for i, k, d in points:
        inside = sorted((a, p) for p, pk, a, b in plantings if pk == k and a <= d <= b)
        want[i] = inside[0][1] if inside else None
    assert {r.id: r.p for r in out.collect()} == want
    owned = exclusive_intervals(iv, on="k", start="a", end="b", value="p").collect()
    by_key = {}
    for r in owned:
        by_key.setdefault(r.k, []).append((r.a, r.b))
    assert all(x[1] < y[0] for spans in by_key.values() for x, y in zip(sorted(spans), sorted(spans)[1:]))


def test_decayed_sum_matches_pairs(spark):
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    moment = lambda: base + dt.timedelta(seconds=rng.randint(0, 15 * 86400))
    events = [(rng.randint(0, 1), moment(), float(rng.randint(1, 30))) for _ in range(80)]
    points = [(i, rng.randint(0, 2), moment()) for i in range(60)]
    points.append((60, events[0][0], events[0][1]))  # the same instant counts
    points.append((61, events[1][0], events[1][1] + dt.timedelta(days=5)))  # exactly as old as allowed counts
    tau = IRRIGATION_DECAY_DAYS / 3
    out = decayed_sum(spark.createDataFrame(points, "id int, k int, t timestamp"), spark.createDataFrame(events, "k int, e timestamp, v double"),
                      on="k", point_id="id", point_ts="t", event_ts="e", amount="v", days=5, tau_days=tau, out="left_over")
    got = {r.id: r.left_over for r in out.collect()}
    assert len(got) == len(points)
    for i, k, t in points:
        ages = [((t - e).total_seconds() / 86400, v) for ek, e, v in events if ek == k]
        want = sum(v * math.exp(-a / tau) for a, v in ages if 0 <= a <= 5)
        assert got[i] == pytest.approx(want, abs=1e-8)


def test_inside_any_and_previous(spark):
    rng = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    spans = [(rng.randint(0, 2), s := base + dt.timedelta(hours=rng.randint(0, 200)), s + dt.timedelta(hours=rng.randint(0, 40)), i) for i in range(30)]
    points = [(i, rng.randint(0, 2), base + dt.timedelta(hours=rng.randint(0, 240))) for i in range(120)]
    sp = spark.createDataFrame(spans, "k int, s timestamp, e timestamp, id int")
    out = inside_any(spark.createDataFrame(points, "id int, k int, t timestamp"), sp, on="k", point_ts="t", start="s", end="e")
    assert {r.id for r in out.collect()} == {i for i, k, t in points if any(sk == k and s <= t < e for sk, s, e, _ in spans)}
    got = {r.id: r.before for r in previous_in_order(sp, "k", "s", ["s", "e", "id"], "e", "before").collect()}
    for k in range(3):
        ordered = sorted((s, e, i) for sk, s, e, i in spans if sk == k)
        assert [got[i] for _, _, i in ordered] == [None, *[e for _, e, _ in ordered]][:len(ordered)]


def test_halves_match_a_plain_sort(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0.1, 0.1005, 0.5, 0.77]) + rng.choice([0, 0.0001]), round(rng.random(), 3)) for i in range(101)]
    df = spark.createDataFrame(rows, "planting_id int, water_ratio double, relative_yield double")
    got = {r.half: (r.plantings, r.mean_response) for r in features.wet_dry_halves(df, "water_ratio", "relative_yield").collect()}
    ordered = [y for _, y in sorted((r, y) for _, r, y in rows)]
    for half, part in (("dry", ordered[:50]), ("wet", ordered[50:])):
        assert got[half][0] == len(part) and got[half][1] == pytest.approx(sum(part) / len(part))


def test_economics_from_some_parts_equal_the_whole(spark):
    """A part that is not asked for is not read; the columns of the others do not change."""
    from tilth.plans.catalog import FarmData

    data = FarmData(spark, "/root/testdata/sf0.001")
    whole = data["planting_economics"]
    for parts, columns, absent in ((("costs",), ["cost_total_usd", "cost_per_ha_usd"], "yield_t_ha"),
                                   (("irrigation", "weather"), ["water_received_mm", "gdd_accumulated"], "gross_margin_usd"),
                                   ((), ["outcome", "season"], "rainfall_mm")):
        some = data["planting_economics:" + "+".join(parts)] if parts else marts.economics_of(marts.star_join(*data.many(*marts.PLANTING)), {})
        assert absent not in some.columns and set(columns) <= set(some.columns) <= set(whole.columns)
        assert some.exceptAll(whole.select(*some.columns)).isEmpty() and some.count() == whole.count()
    plan = data["planting_economics:irrigation+weather"]._jdf.queryExecution().optimizedPlan().toString()
    assert "yield_tonnes" not in plan and "cost_category" not in plan and "input_applications" not in plan


def _exchange_keys(df):
    """What the shuffles of the plan deal out by, before it runs."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)]


def test_no_rows_are_dealt_out_by_the_few_ids_of_the_crop_catalogue(spark):
    data = FarmData(spark, "/root/testdata/sf0.001")
    for plan in (data["field_crop_health_daily"], data["planting_economics"],
                 features.crop_gdd_ratio(features.planting_crops(*data.many("dim_planting", "dim_crop_variety", "dim_crop")), data["fact_weather_daily"])):
        joined = [line for line in plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple").splitlines()
                  if re.search(r"SortMergeJoin \[(_spread#\d+L?, )?variety_id", line)]
        assert not joined


def test_field_days_of_the_water_supply_are_not_moved(spark):
    data = FarmData(spark, "/root/testdata/sf0.001")
    keys = _exchange_keys(data["field_irrigation_daily"])
    assert keys.count("field_id, water_date") <= 1  # of the irrigation itself
    assert "month_start, field_id, field_code, farm_code, region" not in [k.replace("_groupingexpression", "month_start") for k in _exchange_keys(data["v_field_irrigation_monthly"])]


def test_water_supply_has_a_day_for_every_reading_of_it_and_for_none(spark, places):
    weather = spark.sql("""SELECT 1L AS farm_id, 'F1' AS farm_code, d AS weather_date, 2D AS precipitation_mm, 5D AS et0_mm, true AS is_actual
                           FROM (SELECT explode(sequence(date'2024-01-01', date'2024-01-03')) AS d)""")
    events = spark.sql("""SELECT 10L AS field_id, date'2024-01-02' AS event_date, 4D AS depth_mm, 40D AS water_volume_m3, 24 AS duration_minutes,
                          cast(null as double) AS energy_kwh, 'drip' AS method UNION ALL SELECT 10L, null, 9D, 90D, 9, 9D, 'pivot'""")
    soil = spark.sql("""SELECT 10L AS field_id, date'2024-01-01' AS reading_date, 30D AS avg_soil_moisture_pct, 20D AS min_soil_moisture_pct,
                        'adequate' AS moisture_stress, 2L AS active_sensors""")
    fields, farms = places["fields"].filter("field_id = 10"), places["farms"]
    farm = fields.first().farm_id
    out = views.v_field_water_supply_daily(weather.withColumn("farm_id", F.lit(farm)), fields, farms, events, soil).orderBy("water_date").collect()
    assert [(r.irrigation_events, r.irrigation_mm, r.water_supplied_mm, r.irrigation_method, r.avg_soil_moisture_pct) for r in out] == [
        (0, 0.0, 2.0, "none", 30.0), (1, 4.0, 6.0, "drip", None), (0, 0.0, 2.0, "none", None)]


def test_heat_by_months_is_the_heat_by_days(spark):
    planted = spark.sql("""SELECT planting_id, 1L AS farm_id, 10D AS base_temp_c, 100 AS gdd_to_maturity, planted_on, expected_harvest_on FROM VALUES
        (1L, date'2024-01-31', date'2024-03-01'), (2L, date'2024-02-10', date'2024-02-10'), (3L, date'2024-02-10', date'2024-01-01'),
        (4L, date'2024-02-11', null), (5L, null, null) AS t(planting_id, planted_on, expected_harvest_on)""")
    weather = spark.sql("SELECT 1L AS farm_id, d AS weather_date, 12D AS temp_mean_c FROM (SELECT explode(sequence(date'2024-01-01', date'2024-04-01')) AS d)")
    out = features.crop_gdd_daily(planted, weather)
    got = {(r.planting_id, r.weather_date.isoformat()) for r in out.collect()}
    assert len([x for x in got if x[0] == 1]) == 31 and {x for x in got if x[0] > 1} == {(2, "2024-02-10"), (3, "2024-02-10"), (4, "2024-02-11")}
    assert "farm_id, weather_date" not in _exchange_keys(out)


def test_rows_without_a_planting_are_spread(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id < 0 THEN id END AS planting_id", "id AS x")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sparse_left_join(df, spark.range(5).selectExpr("id AS planting_id", "id AS y"), "planting_id")
        assert "planting_id, _spread" in _exchange_keys(out)
        assert out.filter("y is null").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
