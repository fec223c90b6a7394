"""Field passes looked up by field once."""

from __future__ import annotations

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from tilth.operators.ranges import active_interval_join, owned_by_year, owner_on
from tilth.plans import marts
from tilth.plans.catalog import FarmData
from tilth.plans.conformed import conformed


def test_owners_by_year_equal_the_interval_join(spark):
    rng, first = random.Random(8), dt.date(2023, 10, 1)
    day = lambda i: first + dt.timedelta(days=i)
    spans = [(i, rng.choice([0, 0, 1, 2, None]), day(a := rng.randint(0, 900)), day(a + rng.randint(-2, 500))) for i in range(120)]
    points = [(i, rng.choice([0, 0, 1, 2, 3, None]), rng.choice([day(rng.randint(-40, 1500)), day(rng.randint(0, 900)), None])) for i in range(600)]
    iv, at = spark.createDataFrame(spans, "p long, k int, a date, b date"), spark.createDataFrame(points, "id int, k int, d date")
    owned = owned_by_year(iv, on="k", start="a", end="b", value="p", out="_own")
    got = at.join(owned, "k", "left").select("id", F.expr(f"{owner_on('_own', 'd')} AS p"))
    due = active_interval_join(at, iv, on="k", day="d", start="a", end="b", value="p").select("id", "p")
    assert sorted(got.collect()) == sorted(due.collect()) and got.filter("p is not null").count() > 100


def test_passes_give_the_observations_of_the_interval_join(spark):
    data = FarmData(spark, "/root/testdata/sf0.001")
    got, due = data["fact_field_index"], conformed("fact_field_index", data.raw)
    assert got.schema.names == due.schema.names and got.count() == due.count() > 0
    assert got.exceptAll(due).isEmpty() and due.exceptAll(got).isEmpty()
    assert got.filter("planting_id is not null").count() > 0


def test_field_passes_and_field_days_are_dealt_out_by_field_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = FarmData(spark, "/root/testdata/sf0.001")["field_crop_health_daily"]
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*), \d+\)", text)]
    joins = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"SortMergeJoin \[([^]]*)\], ", text)]
    assert not [k for k in keys if "_month" in k]
    assert text.index("SortMergeJoin") and "field_id, farm_id" in joins  # one join of field days for both


def test_observations_under_another_farm_than_their_field_keep_theirs(spark):
    obs = spark.sql("""SELECT 1L AS observation_id, 10L AS field_id, 2L AS farm_id, cast(null as long) AS planting_id, date'2026-04-01' AS observed_on,
                       0.5D AS ndvi, 0.1D AS ndwi, 0.1D AS evi, 5D AS cloud_cover_pct, true AS usable""")
    fields = spark.sql("SELECT 10L AS field_id, 'F-10' AS field_code, 'North' AS field_name, 'clay' AS soil_type, 12D AS area_ha, 1L AS farm_id")
    farms = spark.sql("SELECT id AS farm_id, concat('EG-', id) AS farm_code, 'Delta' AS region, 'EG' AS country_code FROM range(1, 3)")
    plantings = spark.sql("SELECT 1L AS planting_id, 's' AS season, 1L AS variety_id, date'2026-03-01' AS planted_on").limit(0)
    varieties = spark.sql("SELECT 1L AS variety_id, 'v' AS variety_code, 'rice' AS crop_code")
    crops = spark.sql("SELECT 'rice' AS crop_code, 'Rice' AS crop_name, 'cereal' AS category, 140 AS cycle_days, 0.8D AS peak_ndvi")
    held = spark.sql("SELECT 10L AS field_id, 1L AS farm_id UNION ALL SELECT 10L, 2L")
    for pairs in (None, held):
        out = marts.field_crop_health_daily(obs, fields, farms, plantings, varieties, crops, pairs).collect()
        assert [(r.farm_id, r.farm_code, r.field_name) for r in out] == [(2, "EG-2", "North")]
