"""Conformed tables with few columns, and rounding and sums without decimals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tilth.functions.exact import rounded, wide_sum
from tilth.plans.catalog import FarmData
from tilth.plans.conformed import conformed
from tilth.plans.queries import QUERIES


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_economics_read_only_what_decides_their_columns(spark):
    for name in ("metrics_economics", "chart_economics_detail"):
        text = _plan(QUERIES[name](FarmData(spark, "/root/testdata/sf0.001")))
        assert "application_id" not in text and "fuel" in text  # no input applications, but costs
        assert "description" not in text and "solar_radiation" not in text


@pytest.mark.parametrize("name, columns", [
    ("fact_field_cost", ["planting_id", "cost_category", "amount_usd"]), ("fact_irrigation", ["planting_id", "depth_mm"]),
    ("fact_input_application", ["planting_id"]), ("fact_harvest", ["planting_id", "revenue_usd"]), ("fact_field_cost", ["farm_id"]),
    ("fact_field_index", ["ndvi"]), ("fact_weather_daily", ["farm_id", "weather_date", "temp_mean_c", "precipitation_mm"])])
def test_a_table_with_few_columns_has_the_rows_of_the_whole(spark, name, columns):
    data = FarmData(spark, "/root/testdata/sf0.001")
    few, whole = data[f"{name}:{'+'.join(columns)}"], data[name].select(*columns)
    assert few.columns == columns and few.count() == whole.count()
    assert few.exceptAll(whole).isEmpty() and whole.exceptAll(few).isEmpty()


def test_copies_of_a_key_are_told_apart_before_columns_are_left_out(spark):
    cost = "1L AS cost_id, {} AS field_id, {} AS planting_id, date'2024-01-0{}' AS cost_date, '{}' AS cost_category, {}D AS amount_usd, '{}' AS description, timestamp'2024-01-01' AS updated_at"
    copies = [(7, "5L", 1, "fuel", 1.0, "z"), (7, "6L", 2, "fuel", 1.0, "a"), (7, "6L", 2, " SEED", 2.0, "z"), (8, "null", 1, "fuel", 9.0, "z"), (7, "6L", 3, "fuel", 1.0, "a")]
    raw = {"field_cost": spark.sql(" UNION ALL ".join("SELECT " + cost.format(f"{c[0]}L", *c[1:]) for c in copies)),
           "field": spark.sql("SELECT 7L AS field_id, 1L AS farm_id UNION ALL SELECT 7L, 2L")}
    whole = conformed("fact_field_cost", raw.__getitem__)
    for columns in (["planting_id", "amount_usd"], ["cost_date"], ["planting_id"], ["farm_id"], ["description", "cost_category"]):
        assert conformed("fact_field_cost", raw.__getitem__, columns).collect() == whole.select(*columns).collect()


def test_rounding_and_wide_sums_equal_decimals_near_ties_and_beyond(spark):
    steps = [n / 1000 + 0.0005 for n in (-7, -1, 0, 1, 2, 999, 123456789, 10**9)]
    values = [s + e for s in steps for e in (0, 1e-13, -1e-13, 6e-13, -6e-13, 1e-7, -1e-4)] + [0.0, -0.0, -0.0001, 1e11 + 0.5, 9e12, -3.14159, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 3, 4):
        out = df.select("v", rounded("v", digits, "got"), F.expr(f"cast(round(cast(v as decimal(38,12)), {digits}) as double) AS due"))
        assert out.filter("not (cast(got as string) <=> cast(due as string))").collect() == []
    big = df.unionByName(spark.range(2000).selectExpr("9.9e12D + id / 8 AS v"))  # total far beyond 64 bits of units
    out = big.groupBy(F.expr("v > 0")).agg(wide_sum("v", "got"), F.expr("cast(sum(cast(v as decimal(18,4))) as double) AS due")).collect()
    assert len(out) == 3 and all(r.got == r.due for r in out) and max(r.due or 0 for r in out) > 9.3e14
    text = df._sc._jvm.PythonSQLUtils.explainString(df.groupBy().agg(wide_sum("v"))._jdf.queryExecution(), "simple")
    assert "sum(shiftright" in text  # whole numbers are added, not decimals


def test_predicates_over_a_mart_are_counted_in_one_reading_without_what_they_do_not_ask_for(spark):
    from tilth.plans.queries import _PREDICATES, QUERIES

    class Read(dict):
        def __getitem__(self, name):
            asked.append(name)
            return super().__getitem__(name)

    asked: list[str] = []
    frames = {
        "field_crop_health_daily": "SELECT * FROM VALUES ('peak', 'wheat'), ('unknown', 'rice'), ('bare', null), (null, null) t(canopy_stage, crop_name)",
        "machine_daily": "SELECT * FROM VALUES (0.0D), (1.5D), (null) t(area_covered_ha)",
        "planting_economics:harvest+irrigation+weather": "SELECT * FROM VALUES ('harvested', 1D, 2D), ('harvested', null, 2D), ('growing', 1D, null), (null, 3D, 4D) t(outcome, yield_t_ha, water_received_mm)",
        "field_irrigation_daily": "SELECT true AS is_actual WHERE false"}
    data = Read({name: spark.sql(text) for name, text in frames.items()})
    rows = {r.predicate: r.rows for r in QUERIES["ad_hoc_filters"](data).collect()}
    assert rows == {"canopy_stage_known": 2, "crop_known": 2, "area_worked": 1, "harvested": 2, "yield_and_water_known": 2, "actual": 0}
    assert sorted(asked) == sorted(frames) and set(rows) == set(_PREDICATES)


def test_spreading_rows_without_a_key_moves_only_what_is_asked_for(spark):
    from tilth.operators.joins import sparse_left_join

    left = spark.range(40).selectExpr("IF(id % 2 = 0, null, id) AS k", "id AS day", "concat('long ', id) AS text")
    right = spark.range(9).selectExpr("id AS k", "id * 2 AS v")
    joined = sparse_left_join(left, right, "k", ("day",))
    assert sorted(map(tuple, joined.select("day", "v").collect())) == sorted(
        (r.day, 2 * r.k if r.k is not None and r.k < 9 else None) for r in left.collect())
    assert "long" not in joined.select("day", "v")._jdf.queryExecution().optimizedPlan().toString()
