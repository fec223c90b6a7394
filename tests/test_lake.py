"""Writing, marks, jobs, streaming and the oracle on the smallest data."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from compare import compare, oracle_connection
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tilth.contracts import contract, widened
from tilth.functions.exact import exact_hours, rounded
from tilth.operators import quality
from tilth.operators.metrics import metric_query
from tilth.plans.catalog import FarmData
from tilth.plans.jobs import DOMAINS, Runner, list_domains, list_pipelines
from tilth.plans.queries import QUERIES
from tilth.sources import lake as lk
from tilth.sources import tables, weather_json
from tilth.session import scratch_dir

SMALL = "/root/testdata/sf0.001"


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, updated_at timestamp, v double")


def test_batches_append_and_marks_never_go_back(spark, folder):
    lake = lk.Lake(spark, folder)
    control = lk.ControlTables(lake)
    how = dict(dataset="t", source_table="t", column="updated_at", ingest_date="2024-01-01")
    t = lambda d: dt.datetime(2024, 1, d)
    one = batch(spark, [(1, t(1), 1.0), (2, t(2), 1.0)])
    assert lk.append_batch(lake, control, one, **how)["rows_written"] == 2
    assert lk.append_batch(lake, control, one, **how)["rows_written"] == 0
    assert lk.append_batch(lake, control, one.unionByName(batch(spark, [(3, t(3), 1.0)])), **how)["rows_written"] == 1
    control.reset("raw.t")
    assert control.get_mark("raw.t") is None
    assert lk.append_batch(lake, control, one, **how)["rows_written"] == 2  # lands on the same folder
    assert sorted(r.id for r in lake.read("raw", "t").collect()) == [1, 2, 3]
    control.advance(lk.batch_mark(batch(spark, [(0, t(1), 0.0)]), "raw.t", "t", "updated_at"))
    assert control.get_mark("raw.t") == t(2)


def test_marks_of_jobs_that_end_together(spark, folder):
    """Advances that read the same state both stand, a reset stands until the next advance, and entries stay few."""
    control, t = lk.ControlTables(lk.Lake(spark, folder)), lambda d: dt.datetime(2024, 1, d)
    mark = lambda name, d: lk.batch_mark(batch(spark, [(1, t(d), 1.0)]), name, "t", "updated_at")
    first, second = lk.ControlTables(control.lake), lk.ControlTables(control.lake)
    names = lk.children
    control.advance(mark("raw.a", 2))
    frozen = names(spark, control._folder("raw.a"))
    try:
        lk.children = lambda s, path, start="": frozen if path.endswith("of=raw.a") else names(s, path, start)  # neither sees the other's entry
        first.advance(mark("raw.a", 9))
        second.advance(mark("raw.a", 5))
    finally:
        lk.children = names
    second.advance(mark("raw.b / odd=name", 3))
    assert control.get_mark("raw.a") == t(9) and control.get_mark("raw.b / odd=name") == t(3) and control.get_mark("raw.none") is None
    control.reset("raw.a")
    control.reset("raw.none")
    assert control.get_mark("raw.a") is None and control.marks().count() == 2
    control.advance(mark("raw.a", 4))
    assert control.get_mark("raw.a") == t(4)
    control.COMPACT = 4
    for d in range(1, 20):
        control.advance(mark("raw.a", d))
        assert control.get_mark("raw.a") == t(max(4, d))
        assert len(names(spark, control._folder("raw.a"))) <= 14
    control.reset("raw.a")
    control.compact("raw.a")
    control.compact("raw.a")
    assert control.get_mark("raw.a") is None and len(names(spark, control._folder("raw.a"))) <= 2
    control.advance(mark("raw.a", 1))
    assert control.get_mark("raw.a") == t(1) and control.get_mark("raw.b / odd=name") == t(3)


def test_files_of_many_types_are_read_in_the_contract(spark, folder):
    lake, rules = lk.Lake(spark, folder), contract("raw_region")
    numbers = contract("raw_soil_type")
    stored = ["cast(1 as int)", "cast(2.5 as decimal(5,2))", "cast(3 as bigint)", "cast(null as tinyint)", "4.5D", "cast(6.25 as decimal(9,4))", "cast(7.5 as float)"]
    for i, x in enumerate(stored):
        df = spark.sql(f"SELECT 'c{i}' AS soil_code, 'n' AS name, {x} AS moisture_min_pct" + (", 9D AS moisture_max_pct" if i % 2 else "") + (", 'x' AS extra" if i == 4 else ""))
        lake.write_partition(df, "raw", "soil_type", "snapshot_date", f"2024-01-0{i + 1}")
    got = lake.read("raw", "soil_type", numbers)
    rows = {r.soil_code: r for r in got.collect()}
    assert [rows[f"c{i}"].moisture_min_pct for i in range(7)] == [1.0, 2.5, 3.0, None, 4.5, 6.25, 7.5]
    assert [rows[f"c{i}"].moisture_max_pct for i in range(7)] == [None, 9.0] * 3 + [None]
    assert rows["c4"].extra == "x" and rows["c0"].extra is None and str(rows["c2"].snapshot_date) == "2024-01-03"
    assert dict(got.dtypes)["moisture_min_pct"] == "double"
    assert lake.read("raw", "soil_type", numbers, partition={"snapshot_date": "2024-01-05"}).count() == 1
    assert lake.read("raw", "none", rules).columns == rules.columns
    lake.append(spark.sql("SELECT 1 AS a"), "z", "mixed")
    lake.append(spark.sql("SELECT 2.5D AS a"), "z", "mixed")
    path = lake.path("z", "mixed")
    assert sorted(s.simpleString() for s, _ in lk.by_stored_schema(spark, path, [path])) == ["struct<a:double>", "struct<a:int>"]


def test_every_batch_of_a_day_keeps_its_quarantine(spark, folder):
    day, t = dt.date(2024, 1, 31), lambda d: dt.datetime(2024, 1, d)
    schema = "fault_id long, machine_id long, occurred_at timestamp, fault_code string, severity string, updated_at timestamp"
    rows = [(i, 1, t(1), "E", "low", t(2)) for i in range(40)] + [(100, None, t(1), "E", "low", t(2))]
    later = [(200 + i, 1, t(1), "E", "low", t(3)) for i in range(40)] + [(300, 1, None, "E", "low", t(3))]
    Runner(spark, folder, lambda name: spark.createDataFrame(rows, schema)).run("raw.machine_fault", day)
    runner = Runner(spark, folder, lambda name: spark.createDataFrame(rows + later, schema))
    assert runner.run("raw.machine_fault", day)["rows_quarantined"] == 1
    held = runner.lake.read("quarantine_raw", "machine_fault")
    assert sorted(r.fault_id for r in held.collect()) == [100, 300]
    assert sorted(r["column"] for r in runner.lake.read("quarantine_raw_report", "machine_fault").collect()) == ["machine_id", "occurred_at"]
    clean = [(i, m or 7, o or t(1), *rest) for i, m, o, *rest in rows]
    runner = Runner(spark, folder, lambda name: spark.createDataFrame(clean, schema))
    runner.control.reset("raw.machine_fault")
    assert runner.run("raw.machine_fault", day)["rows_quarantined"] == 0  # the first batch again, mended
    assert sorted(r.fault_id for r in runner.lake.read("quarantine_raw", "machine_fault").collect()) == [300]


def test_writes_that_die_leave_the_old_rows(spark, folder):
    lake = lk.Lake(spark, folder)
    dying = spark.range(0, 4000, 1, 4).selectExpr("id", "if(id = 3999, raise_error('lost'), 'new') AS v")
    old = spark.range(5).selectExpr("id", "'old' AS v")
    lake.replace(old, "z", "whole", ["id"])
    lake.write_partition(old, "z", "parts", "day", "2024-01-01")
    for broken in (lambda: lake.replace(dying, "z", "whole"), lambda: lake.write_partition(dying, "z", "parts", "day", "2024-01-01")):
        with pytest.raises(Exception, match="lost"):
            broken()
    assert {r.v for r in lake.read("z", "whole").collect()} == {r.v for r in lake.read("z", "parts").collect()} == {"old"}
    assert len(lk.children(spark, lake.base("z", "whole"), "data-")) == 1 and not lk.children(spark, f"{folder}/staging")
    # A reader that began before a replacement can go on; versions before the last two are swept.
    begun = lake.read("z", "whole")
    lake.replace(old.withColumn("v", F.lit("newer")), "z", "whole")
    assert begun.count() == 5 and {r.v for r in lake.read("z", "whole").collect()} == {"newer"}
    for i in range(3):
        lake.replace(spark.range(i).selectExpr("id", "'last' AS v"), "z", "whole")
    assert lake.read("z", "whole").count() == 2 and len(lk.children(spark, lake.base("z", "whole"), "data-")) == 2
    # Of two replacements at once, the later one to end fails.
    names = lk.children
    seen = names(spark, f"{lake.base('z', 'whole')}/_pointers", "v")[:-1]
    try:
        lk.children = lambda s, path, start="": seen if path.endswith("_pointers") else names(s, path, start)
        with pytest.raises(FileExistsError):
            lake.replace(old, "z", "whole")
    finally:
        lk.children = names
    assert lake.read("z", "whole").count() == 2
    # Rows appended before the first replacement go with it, later ones belong to the version.
    lake.append(old, "z", "grown")
    lake.replace(old, "z", "grown")
    lake.append(old, "z", "grown")
    assert lake.read("z", "grown").count() == 10
    # A swap that died between its renames is undone by the next one.
    fs, at = lk._fs(spark, f"{lake.base('z', 'parts')}/day=2024-01-01")
    fs.rename(at, lk._fs(spark, f"{lake.base('z', 'parts')}/.old-day=2024-01-01")[1])
    with pytest.raises(Exception, match="lost"):
        lake.write_partition(dying, "z", "parts", "day", "2024-01-01")
    lake.write_partition(old.limit(2), "z", "parts", "day", "2024-01-01")
    assert lake.read("z", "parts").count() == 2 and lk.children(spark, lake.base("z", "parts")) == ["day=2024-01-01"]


def soil_days(spark, folder):
    return FarmData(spark, SMALL)["field_soil_daily"].write.parquet(f"{folder}/days")


def test_states_of_many_batches_stay_in_few_folders(spark, folder):
    from tilth.streaming.increments import WeekStates

    soil_days(spark, folder)
    days = spark.read.parquet(f"{folder}/days")
    parts = 60
    days.withColumn("part", F.pmod(F.hash("field_id", "reading_date"), F.lit(parts))).write.partitionBy("part").parquet(f"{folder}/parts")
    held = WeekStates(spark, f"{folder}/states", every=8)
    read = lambda i: spark.read.schema(days.schema).parquet(f"{folder}/parts/part={i}")
    folders = lambda: len(held.batches()) + len(lk.children(spark, f"{held.root}/generations")) + len(lk.children(spark, f"{held.root}/manifest"))
    weeks = lambda states: sorted(map(repr, states.weeks().collect()))
    whole = WeekStates(spark, f"{folder}/whole")
    seen = 0
    for i in [i for i in range(parts) if lk.exists(spark, f"{folder}/parts/part={i}")]:
        held.write(read(i), seen)
        if seen % 9 == 8:
            held.write(read(i), seen)  # replayed
        seen += 1
        assert folders() <= 12
    whole.write(days, 0)
    assert seen > 40 and weeks(held) == weeks(whole)
    # A fold that dies before its switch changes nothing, and is swept by the next.
    before = weeks(held)
    for i in range(seen, seen + 9):
        held.write(read(0).limit(0), i)
    held.switch = lambda *_: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        held.fold(seen + 9)
    assert len(lk.children(spark, f"{held.root}/generations")) == 2 and weeks(held) == before
    del held.switch
    held.fold(seen + 9)
    assert len(lk.children(spark, f"{held.root}/generations")) == 1 and weeks(held) == before and not held.batches()
    held.write(days, 3)  # long folded: not taken twice
    assert weeks(held) == before
    with pytest.raises(FileExistsError):
        held.switch("0 x", held.current()[1])


def test_append_runs_its_frame_once(spark, folder):
    lake, runs = lk.Lake(spark, folder), spark.sparkContext.accumulator(0)
    watch = F.udf(lambda x: runs.add(1) or x, "long")
    assert lake.append(spark.range(5).select(watch("id").alias("id")), "z", "t") == 5 and runs.value == 5
    assert lake.append(spark.range(0), "z", "t") == 0 and lake.append(spark.range(5), "z", "t") == 5
    assert spark.read.parquet(lake.path("z", "t")).count() == 10 and not lk.children(spark, f"{folder}/staging")


def test_partition_writes_repeat_safely(spark, folder):
    lake = lk.Lake(spark, folder)
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    for _ in range(2):
        lake.write_by(df, "z", "t", ["p"])
    lake.write_by(df.filter("p = 1").withColumn("id", F.col("id") * 100), "z", "t", ["p"])
    assert sorted(r.id for r in lake.read("z", "t").collect()) == [0, 2, 4, 6, 8, 100, 300, 500, 700, 900]
    assert lake.drop_partition("z", "t", "p", "1") and lake.read("z", "t").count() == 5
    lake.replace(df.limit(0), "z", "whole")
    assert spark.read.parquet(lake.path("z", "whole")).count() == 0
    assert lake.append(df.limit(0), "z", "log") == 0 and not lk.exists(spark, lake.path("z", "log"))
    assert lake.append(df, "z", "log") == 10


def test_missing_inputs(spark, folder):
    lake = lk.Lake(spark, folder)
    assert lake.read("conformed", "dim_farm", contract("dim_farm")).count() == 0
    with pytest.raises(lk.MissingUpstream, match="mart.field_soil_daily"):
        lake.require("mart", "field_soil_daily", "run_date", "2024-01-01")


def test_weather_documents(spark, folder):
    full = '{"farm_code":"A","source":"archive","latitude":1.0,"longitude":2.0,"daily":{"time":["2026-07-01","2026-07-02","2026-07-03"],"rain_sum":[0.0,12.4,3.2]}}'
    short = full.replace('"A"', '"B"').replace("[0.0,12.4,3.2]", "[0.0,12.4]")
    os.makedirs(f"{folder}/docs")
    with open(f"{folder}/docs/a.json", "w") as f:
        f.write(full + "\n" + short + "\n")
    rows, rejected = weather_json.flatten_documents(weather_json.read_documents(spark, f"{folder}/docs"))
    got = rows.orderBy("weather_date").collect()
    assert [(r.weather_date.day, r.rain_sum, r.weather_code) for r in got] == [(1, 0.0, None), (2, 12.4, None), (3, 3.2, None)]
    assert [r.farm_code for r in rejected.collect()] == ["B"]


def test_decimals_and_ddl(spark):
    df = spark.sql("select cast(1.5 as decimal(5,2)) a, cast(null as decimal(9,6)) b, 1 c")
    assert [t for _, t in lk.numeric_normalise(df).dtypes] == ["double", "double", "int"]
    assert tuple(lk.numeric_normalise(df).first()) == (1.5, None, 1)
    ddl = dict(tables.ddl_columns(contract("dim_date"), "date_key"))
    assert ddl["quarter"] == "TINYINT" and ddl["is_weekend"] == "BOOLEAN" and "date_key" not in ddl


def test_domains_run_and_repeat(spark, folder):
    data = FarmData(spark, SMALL)
    runner = Runner(spark, folder, data.raw)
    run_day = dt.date(2024, 1, 31)
    first = runner.run_domain("soil_sensor", run_day)
    mart = spark.read.parquet(runner.lake.path("warehouse", "field_soil_daily"))
    rows = sorted(map(str, mart.collect()))
    assert first["mart.field_soil_daily"]["rows_written"] == len(rows) > 0
    again = runner.run_domain("soil_sensor", run_day)
    assert again["raw.sensor_reading"]["rows_written"] == 0
    assert sorted(map(str, spark.read.parquet(runner.lake.path("warehouse", "field_soil_daily")).collect())) == rows
    assert runner.control.runs().filter("status = 'success'").count() == 2 * sum(map(len, DOMAINS["soil_sensor"]))
    with pytest.raises(KeyError, match="conformed.dim_farm"):
        runner.run("conformed.nope", run_day)
    with pytest.raises(KeyError, match="weather"):
        runner.run_domain("nope", run_day)
    assert "analytics" in list_domains() and all(n in list_pipelines() for d in DOMAINS.values() for s in d for n in s)


def test_bad_rows_are_quarantined_or_stop_the_run(spark, folder):
    data = FarmData(spark, SMALL)

    def source(share):
        def read(name):
            df = data.raw(name)
            if name == "machine":
                df = df.withColumn("rated_power_hp", F.when(F.col("machine_id") % 100 < share, -1).otherwise(F.col("rated_power_hp")))
            return df
        return read

    run_day = dt.date(2024, 1, 31)
    runner = Runner(spark, folder, source(4))
    runner.run("raw.machine", run_day)
    stats = runner.run("conformed.dim_machine", run_day)
    assert stats["rows_quarantined"] == 8 and stats["rows_written"] + 8 == stats["rows_read"]
    report = spark.read.parquet(runner.lake.path("quarantine_report", "dim_machine")).first()
    assert (report["column"], report["failed_rows"], report["rows_rejected"]) == ("rated_power_hp", 8, 8)
    runner = Runner(spark, folder + "/b", source(50))
    runner.run("raw.machine", run_day)
    with pytest.raises(quality.RejectionError):
        runner.run("conformed.dim_machine", run_day)
    assert not lk.exists(spark, runner.lake.path("conformed", "dim_machine"))
    assert runner.control.runs().filter("status = 'failed'").count() == 1


SAMPLE = [
    "chart_soil_moisture_trend", "gold_machine_daily", "gold_planting_economics", "active_interval_join", "weekly_state_merge",
    "quarantine_report", "batch_append", "stream_weekly_rollup", "catalogue_diff", "chart_machine_ranking", "derived_cost_ledger",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, name):
    con = oracle_connection(SMALL)
    assert compare(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) is None


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    assert scratch_dir(Session(**{"spark.master": "local[2]"}), "x").startswith("/tmp/run-x-")
    assert scratch_dir(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://n/c"}), "x").startswith("hdfs://n/c/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(**{"spark.master": "spark://host:7077"}), "x")


def test_raw_extracts_are_held_to_their_contract(spark, folder):
    day = dt.date(2024, 1, 31)
    good = [(i, f"M{i}", 1, "tractor") for i in range(30)]
    schema = "machine_id long, machine_code string, farm_id long, machine_type string"
    one_bad = spark.createDataFrame([*good, (99, None, 1, "tractor")], schema)
    runner = Runner(spark, folder, lambda name: one_bad)
    assert runner.run("raw.machine", day) == {"rows_read": 31, "rows_written": 30, "rows_quarantined": 1}
    many_bad = spark.createDataFrame([*good, *[(100 + i, None, 1, "tractor") for i in range(9)]], schema)
    with pytest.raises(quality.RejectionError):
        Runner(spark, f"{folder}/b", lambda name: many_bad).run("raw.machine", day)
    with pytest.raises(quality.StructureError):
        Runner(spark, f"{folder}/c", lambda name: one_bad.drop("farm_id")).run("raw.machine", day)


def test_narrower_types_widen_and_nan_is_rejected(spark):
    rules = contract("raw_farm")
    narrow = spark.sql("SELECT 1 AS farm_id, 'F' AS farm_code, 'n' AS name, 'EG' AS country_code, 'r' AS region, "
                       "cast(1.5 AS decimal(9,6)) AS latitude, 3 AS longitude, null AS area_ha")
    assert widened(narrow, rules).select(*rules.columns).schema.simpleString() == rules.schema().simpleString()
    odd = widened(narrow, rules).withColumn("latitude", F.lit(float("nan")))
    assert [r._failures for r in quality.flag_failures(odd, rules).collect()] == [["latitude:not_nan"]]


def test_hours_add_up_from_seconds_and_rounding_is_done_once(spark):
    df = spark.sql("SELECT 10 / 3600D AS h FROM range(1000)")
    assert df.agg(exact_hours("h", "h")).first().h == 10000 / 3600
    assert spark.sql("SELECT 0.0004999999D AS x").select(rounded("x", 3, "x")).first().x == 0.0


def test_one_call_filters_orders_and_limits(spark):
    df = spark.createDataFrame([(d, r, float(v)) for d, r, v in
                                [("2024-01-01", "a", 1), ("2024-01-02", "b", 5), ("2024-01-02", "c", 3), ("2024-01-09", "b", 9)]],
                               "reading_date string, region string, avg_soil_moisture_pct double")
    out = metric_query(df, "field_soil_daily", ["avg_moisture"], ["region"], choices={"region": ["b", "c"]}, time_column="reading_date",
                       since="2024-01-01", until="2024-01-09", order_by="avg_moisture", ascending=True, limit=1)
    assert [tuple(r) for r in out.collect()] == [("c", 3.0)]
