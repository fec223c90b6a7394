"""Thresholds, rounding, contracts and conforming on literal frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tilth.contracts import CONTRACTS, Contract, between, col, contract, ids, key, texts
from tilth.contracts import DOUBLE, STRING
from tilth.functions import agronomy, bands
from tilth.functions.exact import exact_avg, exact_sum, exact_total, guarded_ratio, rounded
from tilth.operators import conform, quality
from tilth.operators.latest import dedupe_keep_first, latest_per_key, latest_rows, latest_rows_by_join
from tilth.operators.metrics import metric, table_query


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def classified(spark, expression, inputs, schema):
    df = spark.createDataFrame([i if isinstance(i, tuple) else (i,) for i in inputs], schema)
    return [r[0] for r in df.select(expression).collect()]


def test_bands_at_their_edges(spark):
    one = "x double"
    assert classified(spark, bands.moisture_stress("x"), [14.0, 15.0, 16.0, 38.0, 39.0, None], one) == [
        "dry", "optimal", "optimal", "optimal", "wet", "unknown"]
    assert classified(spark, bands.aridity("x"), [2.1, 2.0, -3.0, -3.1, None], one) == ["wet", "balanced", "balanced", "dry", "unknown"]
    assert classified(spark, bands.canopy_stage("x"), [14.9, 15.0, 44.9, 45.0, 75.0, 75.1, None], one) == [
        "bare", "developing", "developing", "peak", "peak", "senescing", "unknown"]
    assert classified(spark, bands.supply_status("x"), [2.0, 2.1, -2.0, -2.1, None], one) == [
        "balanced", "deficit", "balanced", "surplus", "unknown"]
    assert classified(spark, bands.growth_stage("x"), [-1.0, 0.12, 0.45, 0.65, 0.88, 2.0], one) == [
        "emergence", "vegetative", "flowering", "grain_fill", "maturity", "maturity"]
    assert classified(spark, bands.quality_grade("x"), [0.8, 0.79, 0.55, 0.25, 0.24], one) == ["A", "B", "B", "C", "reject"]
    assert classified(spark, bands.vigour("x", "s"), [(64.0, "peak"), (95.0, "peak"), (80.0, "peak"), (97.0, "bare"), (None, "peak")],
                      "x double, s string") == ["low", "high", "normal", "unknown", "unknown"]
    assert classified(spark, bands.utilisation("c", "r", "a", "i"),
                      [(1, 5, 1.0, 10.0), (0, 0, 0.0, None), (0, 10, 12.0, 0.0), (0, 10, 5.0, 80.0), (0, 5, 0.0, 20.0)],
                      "c long, r long, a double, i double") == ["down", "parked", "working", "idle", "idle"]


def test_degree_days_and_indices(spark):
    df = spark.createDataFrame([(25.0,), (8.0,), (35.0,), (None,)], "t double")
    assert values(df, F.expr(agronomy.degree_days("t"))) == [(15.0,), (0.0,), (20.0,), (None,)]
    crop = spark.createDataFrame([(0.0, 0.8, False), (0.6, 0.8, False), (1.0, 0.8, False), (0.5, 0.7, True)], "p double, k double, e boolean")
    assert [round(v, 4) for (v,) in values(crop, F.expr(agronomy.expected_ndvi("p", "k", "e")))] == [0.14, 0.8, 0.22, 0.7]
    water = spark.createDataFrame([(500.0, 500), (250.0, 500), (900.0, 500)], "r double, d int")
    assert values(water, F.expr(agronomy.water_stress("r", "d"))) == [(0.0,), (0.5,), (0.0,)]


def test_sums_do_not_depend_on_order(spark):
    rows = [(i % 3, v) for i, v in enumerate([0.1, 1e9, -1e9, 0.2, 0.3, 1234.5678] * 50)]
    one = spark.createDataFrame(rows, "k int, v double").repartition(3)
    two = spark.createDataFrame(rows[::-1], "k int, v double").repartition(7)
    totals = [sorted(values(df.groupBy("k").agg(exact_sum("v", "s"), exact_avg("v", "a")), "k", "s", "a")) for df in (one, two)]
    assert totals[0] == totals[1]
    empty = spark.createDataFrame([(1, None)], "k int, v double").groupBy("k").agg(exact_sum("v", "s"), exact_total("v", "t"), exact_avg("v", "a"))
    assert values(empty, "s", "t", "a") == [(None, 0.0, None)]


def test_rounding_ties_and_guarded_ratio(spark):
    df = spark.createDataFrame([(32.6825, 0.0), (-0.0005, 2.0)], "v double, d double")
    assert values(df, rounded("v", 3), guarded_ratio("v", "d", 100.0)) == [(32.683, None), (-0.001, -0.025)]


# -- contracts ----------------------------------------------------------------
WIDGET = Contract("widget", True, (key("widget_id"), col("size", DOUBLE, between(0, 10), null=True), col("colour", STRING)))


def widgets(spark, rows):
    return spark.createDataFrame(rows, "widget_id long, size double, colour string")


def test_rows_are_split_by_any_failure(spark):
    df = widgets(spark, [(1, 5.0, "red"), (2, 11.0, "red"), (3, None, None), (4, None, "blue"), (5, 1.0, "red"), (5, 2.0, "red")])
    flagged = quality.flag_failures(df, WIDGET)
    assert sorted(values(quality.valid_rows(flagged), "widget_id")) == [(1,), (4,)]
    assert sorted(values(quality.invalid_rows(flagged), "widget_id")) == [(2,), (3,), (5,), (5,)]
    assert values(quality.failure_summary(flagged), "column", "check", "failed_rows") == [
        ("widget_id", "unique", 2), ("colour", "not_null", 1), ("size", "in_range(0, 10)", 1)]
    assert tuple(quality.rejection_counts(flagged).first()) == (6, 4, 4 / 6)


def test_structure_fails_before_any_row(spark):
    df = widgets(spark, [(1, 5.0, "red")])
    with pytest.raises(quality.StructureError, match="colour missing"):
        quality.flag_failures(df.drop("colour"), WIDGET)
    with pytest.raises(quality.StructureError, match="extra unexpected"):
        quality.flag_failures(df.withColumn("extra", F.lit(1)), WIDGET)
    with pytest.raises(quality.StructureError, match="not double"):
        quality.flag_failures(df.withColumn("size", F.lit("big")), WIDGET)
    open_contract = Contract("widget", False, WIDGET.rules)
    assert quality.structure_problems(df.withColumn("extra", F.lit(1)), open_contract) == []


def test_gate_passes_at_the_limit_only():
    quality.check_rate("x", 100, 10)
    quality.check_rate("x", 0, 0)
    with pytest.raises(quality.RejectionError, match="11 of 100"):
        quality.check_rate("x", 100, 11)


def test_contracts_are_consistent(spark):
    for name, rules in CONTRACTS.items():
        assert len(set(rules.columns)) == len(rules.columns), name
    assert contract("dim_farm").empty(spark).columns == contract("dim_farm").columns
    with pytest.raises(KeyError, match="dim_farm"):
        contract("nope")


# -- conforming ---------------------------------------------------------------
def test_conform_applies_every_step(spark):
    source = spark.createDataFrame(
        [(1, " W-1\t", " RED ", 10, "x", dt.datetime(2024, 1, 1)), (1, "W-1", "Blue", 10, "x", dt.datetime(2024, 1, 2)),
         (2, "W-2", "GREEN", 99, "x", dt.datetime(2024, 1, 1)), (3, "W-3", "gone", 10, "x", dt.datetime(2024, 1, 1))],
        "widget_id int, code string, colour string, box_id long, owner string, updated_at timestamp")
    boxes = spark.createDataFrame([(10, "joined")], "box_id long, owner string")
    target = Contract("w", True, (*ids("widget_id"), *texts("widget_code", "colour", "owner"), col("size", DOUBLE)))
    spec = conform.ConformSpec(
        "w", "widget", target, lookups=(conform.Lookup("box", ("box_id",), ("owner",)),), keep=("colour != 'gone'",),
        rename={"code": "widget_code", "absent": "z"}, trim=("widget_code",), lower=("colour",),
        derive={"size": "widget_id * 2.5D"}, dedupe_on=("widget_id",))
    out = conform.conform(spec, lambda n: source if n == "widget" else boxes)
    # Parent missing -> dropped; clash -> the looked-up value; newest copy kept.
    assert [tuple(r) for r in out.collect()] == [(1, "W-1", "blue", "joined", 2.5)]
    assert dict(out.dtypes)["widget_id"] == "bigint"
    with pytest.raises(KeyError, match="size"):
        conform.select_contract(source, target)
    with pytest.raises(KeyError, match="weight"):
        conform.lookup_join(source, boxes, ("box_id",), ("weight",))


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 1), ("a", 2, 9), ("b", 1, None)], "k string, d int, v int")
    assert sorted(values(latest_per_key(df, ["k"], ["d"]), "k", "d", "v")) == [("a", 2, 9), ("b", 1, None)]
    assert sorted(values(dedupe_keep_first(df, ["k"], ["d", "v"]), "k", "v")) == [("a", 5), ("b", None)]
    tied = [("a", 1), ("a", 9), ("b", None)]
    for form in (latest_rows, latest_rows_by_join):
        assert sorted(values(form(df, "k", "d"), "k", "v"), key=str) == tied
    plan = latest_per_key(df, ["k"], ["d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle


def test_metric_names_are_checked(spark):
    with pytest.raises(KeyError, match="avg_moisture"):
        metric("field_soil_daily", "nope")
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0), (4, 1.0)], "id int, v double")
    assert values(table_query(df, ["id", "v"], "v", True, 3), "id") == [(3,), (4,), (2,)]


def test_left_join_spreads_rows_without_a_key(spark):
    from tilth.operators.joins import sparse_left_join

    left = spark.createDataFrame([(1, 1), (2, None), (3, None), (4, 9)], "id int, k long")
    right = spark.createDataFrame([(1, "one"), (None, "never")], "k long, v string")
    assert sorted(values(sparse_left_join(left, right, "k"), "id", "k", "v")) == [(1, 1, "one"), (2, None, None), (3, None, None), (4, 9, None)]
