"""Running totals and what is built on them, against brute force, with keys that
hold most of the rows in one day, hour or instant."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tilth.operators import ranges
from tilth.operators.selection import weighted_rank
from tilth.operators.timelines import DAY_US, MINUTE_US, bucket, running
from tilth.plans import features

BASE = dt.datetime(2024, 3, 5, 9)


@pytest.fixture
def groups(monkeypatch):
    """The largest window group of every level of every run, by its partition columns."""
    seen: dict[tuple, int] = defaultdict(int)

    def watched(rows, *, on, order, buckets, values, total=F.sum, before=False):
        level, names = rows, list(buckets)
        while True:
            by = [*on, *names[:1]]
            seen[tuple(by)] = max(seen[tuple(by)], level.groupBy(*by).count().agg(F.max("count")).first()[0] or 0)
            if not names:
                break
            level, names = level.select(*on, *names).distinct(), names[1:]
        return running(rows, on=on, order=order, buckets=buckets, values=values, total=total, before=before)

    monkeypatch.setattr(ranges, "running", watched)
    return seen


@pytest.mark.parametrize("before", [False, True])
def test_running_totals_match_a_plain_scan(spark, before):
    rng = random.Random(before)
    rows = [(k, us, rng.choice([None, 1, 5, -3])) for k in (1, 2) for us in {rng.randint(-3, 3) * DAY_US + rng.randint(0, 5) * MINUTE_US + rng.randint(0, 9) for _ in range(120)}]
    df = spark.createDataFrame(rows, "k int, us long, v long").withColumns({"m": F.expr(bucket("us", MINUTE_US)), "d": F.expr(bucket("us", DAY_US))})
    for total, fold in ((F.sum, sum), (F.max, max)):
        for buckets in ([], ["d"], ["m", "d"]):
            got = running(df, on=["k"], order=["us"], buckets=buckets, values=["v"], total=total, before=before)
            for r in got.collect():
                held = [v for k, us, v in rows if k == r.k and (us < r.us or us == r.us and not before) and v is not None]
                assert (r.v_run or 0) == (fold(held) if held else 0), (r, buckets)


def test_a_bucket_has_its_floor_before_1970(spark):
    got = spark.range(1).select(*[F.expr(bucket(f"{x}L", MINUTE_US)).alias(f"c{i}") for i, x in enumerate((-1, -MINUTE_US, 0, MINUTE_US - 1))]).first()
    assert tuple(got) == (-1, -1, 0, 0)


def hot_instants(rng, many):
    """Most rows at one instant, the rest of a hot hour second by second."""
    return [BASE if rng.random() < 0.6 else BASE + dt.timedelta(seconds=rng.randint(0, 3600)) for _ in range(many)]


def test_decay_of_a_hot_day_in_minutes(spark, groups):
    rng = random.Random(11)
    events = [(1, ts, float(rng.randint(1, 9))) for ts in hot_instants(rng, 4000)]
    events += [(rng.randint(2, 4), BASE + dt.timedelta(minutes=rng.randint(-9000, 9000)), float(rng.randint(1, 9))) for _ in range(300)]
    events += [(None, BASE, 5.0), (1, None, 5.0), (1, BASE, None)]
    points = [(i, 1, ts) for i, ts in enumerate(hot_instants(rng, 1500))]
    points += [(5000 + i, rng.randint(1, 5), BASE + dt.timedelta(minutes=rng.randint(-9000, 20000))) for i in range(200)] + [(9000, None, BASE), (9001, 1, None)]
    out = ranges.decayed_sum(spark.createDataFrame(points, "id int, k int, t timestamp"), spark.createDataFrame(events, "k int, e timestamp, v double"),
                             on="k", point_id="id", point_ts="t", event_ts="e", amount="v", days=5, tau_days=5 / 3, out="left_over")
    got = {r.id: r.left_over for r in out.collect()}
    assert set(got) == {i for i, *_ in points} and got[9000] == got[9001] == 0
    held = [(k, e, v) for k, e, v in events if None not in (k, e, v)]
    for i, k, t in points[::7]:
        if k is not None and t is not None:
            ages = [((t - e).total_seconds() / 86400, v) for ek, e, v in held if ek == k]
            assert got[i] == pytest.approx(sum(v * math.exp(-a * 3 / 5) for a, v in ages if 0 <= a <= 5), abs=1e-6)
    assert groups["k", "_day", "_minute"] <= 3 * 60 and groups["k", "_day"] <= 1440


def test_overlaps_of_a_hot_hour_in_minutes(spark, groups):
    rng = random.Random(12)
    spans = [(1, s, s + dt.timedelta(seconds=rng.randint(-5, 40)), i) for i, s in enumerate(hot_instants(rng, 3000))]
    spans += [(2, BASE, BASE + dt.timedelta(days=400), 9000), (2, BASE + dt.timedelta(days=1), BASE + dt.timedelta(days=1, seconds=1), 9001)]
    points = [(i, 1, ts) for i, ts in enumerate(hot_instants(rng, 900))]
    points += [(5000 + i, rng.randint(1, 3), BASE + dt.timedelta(hours=rng.randint(-50, 11000))) for i in range(200)] + [(9000, None, BASE), (9001, 1, None)]
    sp = spark.createDataFrame(spans, "k int, s timestamp, e timestamp, id int")
    out = ranges.inside_any(spark.createDataFrame(points, "id int, k int, t timestamp"), sp, on="k", point_ts="t", start="s", end="e")
    want = {i for i, k, t in points if t is not None and any(sk == k and s <= t < e for sk, s, e, _ in spans)}
    assert {r.id for r in out.collect()} == want
    assert groups["k", "_minute"] <= 2 * 60 and groups["k", "_day"] <= 1440


def test_previous_row_of_a_hot_instant(spark, groups):
    rng = random.Random(13)
    spans = [(rng.choice([1, 1, 2]), s, rng.choice([None, s + dt.timedelta(seconds=rng.randint(0, 3))]), i) for i, s in enumerate(hot_instants(rng, 2500))]
    sp = spark.createDataFrame(spans, "k int, s timestamp, e timestamp, id int")
    got = {r.id: r.before for r in ranges.previous_in_order(sp, "k", "s", ["s", "e", "id"], "e", "before").collect()}
    assert len(got) == len(spans)
    for k in (1, 2):
        ordered = sorted((s, e is not None, e or BASE, i) for sk, s, e, i in spans if sk == k)
        ends = [e if known else None for _, known, e, _ in ordered]
        assert [got[i] for *_, i in ordered] == [None, *ends][:len(ordered)]
    assert groups["k", "_minute"] <= 5 * 60  # ends of a start, not rows
    with pytest.raises(ValueError):
        ranges.previous_in_order(sp, "k", "s", ["s", "e", "id"], "id", "before")


def test_windows_past_the_last_fact_and_between_facts(spark):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    facts = [(1, "a", day(i), 1.25 * i) for i in (0, 0, 3, 200, 200, 201)] + [(2, "a", day(5), None), (None, "a", day(5), 1.0), (1, "b", day(1), 7.0)]
    windows = [(0, 1, "a", day(-400), day(-1)), (1, 1, "a", day(-9), day(0)), (2, 1, "a", day(1), day(2)), (3, 1, "a", day(3), day(4000)), (4, 1, "a", day(202), day(9000)),
               (5, 1, "a", day(5), day(4)), (6, 2, "a", day(0), day(900)), (7, None, "a", day(0), day(9)), (8, 1, "b", day(0), day(9)), (9, 3, "a", day(0), day(9)), (10, 1, "a", day(-9), day(0))]
    out = ranges.window_range_sum(spark.createDataFrame(facts, "k int, j string, d date, v double"), spark.createDataFrame(windows, "id int, k int, j string, a date, b date"),
                                  on=["k", "j"], day="d", window_id="id", start="a", end="b", sums={"total": "v"})
    assert {r.id: r.total for r in out.collect()} == {1: 0.0, 3: 1.25 * (3 + 200 + 200 + 201), 6: 0.0, 8: 7.0, 10: 0.0}




# -- order statistics -----------------------------------------------------------
@pytest.mark.parametrize("spread", ["even", "tied", "far", "narrow"])
def test_weighted_rank_matches_a_sort(spark, spread):
    rng = random.Random(spread)
    draw = {"even": rng.random, "tied": lambda: rng.choice([0.25, 0.5, -1.0]), "far": lambda: rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 307),
            "narrow": lambda: 1.0 + rng.randint(0, 40) * 2.0 ** -52}[spread]
    rows = [(draw(), rng.randint(1, 4)) for _ in range(150)]
    df = spark.createDataFrame([*rows, (None, 9)], "v double, n int").cache()
    flat = sorted(v for v, n in rows for _ in range(n))
    for rank in (0, 1, len(flat) // 2, len(flat) - 1):
        assert weighted_rank(df, "v", "n", rank, bins=5, few=3) == (flat[rank], sum(v < flat[rank] for v in flat))
    assert weighted_rank(df, "v", "n", len(flat), bins=5, few=3)[0] is None
    assert weighted_rank(df.limit(0), "v", "n", 0) == (None, 0)


@pytest.mark.parametrize("rows", [0, 1, 2, 301])
def test_halves_of_few_and_tied_rows(spark, rows):
    rng = random.Random(rows)
    data = [(i, rng.choice([0.5, 0.5, 0.7, None, rng.random()]), rng.choice([1.0, 0.25, None])) for i in range(rows)]
    df = spark.createDataFrame(data, "planting_id int, water_ratio double, relative_yield double")
    got = {r.half: (r.plantings, round(r.mean_response, 9)) for r in features.wet_dry_halves(df, "water_ratio", "relative_yield").collect()}
    ordered = [y for _, y in sorted((r, y) for _, r, y in data if r is not None and y is not None)]
    parts = {"dry": ordered[:len(ordered) // 2], "wet": ordered[len(ordered) // 2:]}
    assert got == {k: (len(v), round(sum(v) / len(v), 9)) for k, v in parts.items() if v}
