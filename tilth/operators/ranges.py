"""Joins on a key plus a time range, in linear work.

A key that holds a third of all rows on both sides would make an ordinary range
join quadratic. Each operator here turns the range into equality or into a
running total along the key's time, in days or cut into minutes, which also
spreads a hot key over its calendar, and first folds repeated rows so that what
meets inside one bucket is bounded by the calendar, not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilth.functions.exact import exact_sum, fixed_text, named, unfixed_text
from tilth.functions.text import start_of
from tilth.operators.timelines import DAY_US, MINUTE_US, bucket, running


def window_range_sum(
    facts: DataFrame,
    windows: DataFrame,
    *,
    on: str | list[str],
    day: str,
    window_id: str,
    start: str,
    end: str,
    sums: dict[str, str],
) -> DataFrame:
    """Per window, the sums of ``facts`` of the same key dated inside
    ``[start, end]``: ``window_id`` plus one column per entry of ``sums``
    (output name -> measure). Null measures count as nothing; a window that
    meets no fact gives no row.

    A window is the difference of two running totals: up to its end, and up to
    the day before its start. Days asked for and days with facts, both folded to
    one row, share the key's timeline, which has no more rows than twice its
    days. A day asked for need not have facts and may lie past the last one.
    """
    key = [on] if isinstance(on, str) else on
    parts = ["_n", *[f"_s_{out}" for out in sums]]
    daily = facts.dropna(subset=[*key, day]).groupBy(*key, F.col(day).alias("_at")).agg(
        F.expr("count(*) AS _n"),
        *[F.expr(f"coalesce(sum({fixed_text(c)}), 0) AS _s_{out}") for out, c in sums.items()],
    )
    probes = windows.filter(F.col(end) >= F.col(start)).dropna(subset=key).select(window_id, *key, F.inline(F.array(
        F.struct(F.date_sub(start, 1).alias("_at"), F.lit(-1).alias("_sign")),
        F.struct(F.col(end).alias("_at"), F.lit(1).alias("_sign")),
    )))
    asked = probes.select(*key, "_at").distinct().withColumn("_order", F.lit(1))
    timeline = daily.withColumn("_order", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    seen = running(timeline, on=key, order=["_at", "_order"], buckets=[], values=parts)
    upto = seen.filter("_order = 1").select(*key, "_at", *[f"{p}_run" for p in parts])
    return (
        probes.join(upto, [*key, "_at"])
        .groupBy(window_id)
        .agg(*[F.sum(F.col("_sign") * F.col(f"{p}_run")).alias(p) for p in parts])
        .filter("_n > 0")
        .select(window_id, *[named(unfixed_text(f"_s_{out}"), out) for out in sums])
    )


def exclusive_intervals(intervals: DataFrame, *, on: str, start: str, end: str, value: str) -> DataFrame:
    """Cut overlapping intervals of a key into disjoint ones, each owned by the
    earliest interval still running: an interval owns the days after every
    earlier one has ended.

    Equal intervals are folded to their smallest ``value`` first, so the rows
    ordered inside one key are at most its distinct (start, end) pairs.
    """
    distinct = intervals.filter(F.col(end) >= F.col(start)).groupBy(on, start, end).agg(F.min(value).alias(value))
    earlier = Window.partitionBy(on).orderBy(start, value).rowsBetween(Window.unboundedPreceding, -1)
    free_from = F.date_add(F.max(end).over(earlier), 1)
    return (
        distinct.withColumn("_own_from", F.greatest(F.col(start), free_from))
        .filter(F.col("_own_from") <= F.col(end))
        .select(on, F.col("_own_from").alias(start), end, value)
    )


def months_of(start: str, end: str) -> Column:
    return F.explode(F.sequence(start_of("month", start), start_of("month", end), F.expr("interval 1 month")))


def active_interval_join(
    points: DataFrame, intervals: DataFrame, *, on: str, day: str, start: str, end: str, value: str
) -> DataFrame:
    """Give each point the ``value`` of the interval it falls in (the earliest
    started one), or null. Owned intervals are disjoint, so at most one matches
    and a point meets no more than the intervals of its own month."""
    owned = exclusive_intervals(intervals, on=on, start=start, end=end, value=value)
    by_month = owned.select(on, start, end, value, months_of(start, end).alias("_month"))
    lookup = by_month.withColumnsRenamed({start: "_start", end: "_end"})
    keyed = points.drop(value).withColumn("_month", start_of("month", day))
    inside = keyed[day].between(lookup["_start"], lookup["_end"])
    return keyed.join(
        lookup, (keyed[on] == lookup[on]) & (keyed["_month"] == lookup["_month"]) & inside, "left"
    ).select(*[keyed[c] for c in points.columns if c != value], lookup[value])


def owned_by_year(intervals: DataFrame, *, on: str, start: str, end: str, value: str, out: str) -> DataFrame:
    """(key, ``out``): a row per key with its owned intervals by year, for
    ``owner_on``. They are disjoint, so the calendar bounds them, and a year holds
    no more of them than days."""
    owned = exclusive_intervals(intervals, on=on, start=start, end=end, value=value)
    spans = owned.dropna(subset=[on]).select(on, F.explode(F.sequence(F.year(start), F.year(end))).alias("_year"),
                                             F.struct(F.col(start).alias("a"), F.col(end).alias("b"), F.col(value).alias("value")).alias("_span"))
    years = spans.groupBy(on, "_year").agg(F.collect_list("_span").alias("_spans"))
    return years.groupBy(on).agg(F.map_from_entries(F.collect_list(F.struct("_year", "_spans"))).alias(out))


def owner_on(owned: str, day: str) -> str:
    """The value of the interval of an ``owned_by_year`` map that holds the day, or null."""
    return f"get(filter(try_element_at({owned}, year({day})), x -> {day} BETWEEN x.a AND x.b), 0).value"


def decayed_sum(
    points: DataFrame,
    events: DataFrame,
    *,
    on: str,
    point_id: str,
    point_ts: str,
    event_ts: str,
    amount: str,
    days: int,
    tau_days: float,
    out: str,
) -> DataFrame:
    """Per point, the sum over its key's events of the last ``days`` days of
    ``amount * exp(-age / tau)``; zero when there are none. Days are UTC days.

    Exponential decay factors, so running totals of a (key, day) serve every
    point of it: the point's own day up to the point, plus the whole days between
    (carried forward decayed), minus the part of the oldest day that is already
    too old. Nothing pairs points with events. Equal instants are folded, a
    window runs inside a (key, minute), and a day's minutes, 1,440 at most, are
    carried; so a day that holds any share of the rows is no larger a task.
    """
    tau = tau_days * 86400.0
    day_fade = 86400.0 / tau
    spent = minute_amounts(events, on=on, ts=event_ts, amount=amount, tau=tau)
    # Whole-day totals, carried to the following days.
    totals = spent.groupBy(on, "_day").agg(F.expr("sum(_w) AS _w"))
    ahead = totals.select(on, "_w", "_day", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("_k"))
    carry = ahead.groupBy(on, (F.col("_day") + F.col("_k")).alias("_day")).agg(
        F.sum(F.col("_w") * F.exp(-F.col("_k") * day_fade)).alias("_carry"))
    # Two probes per point: up to its own moment, and before the horizon. Probes
    # before the horizon come before events of the same instant, the others after.
    now = F.unix_micros(point_ts)
    probes = points.select(on, point_id, F.inline(F.array(
        F.struct(now.alias("_us"), F.lit(2).alias("_order")),
        F.struct((now - days * DAY_US).alias("_us"), F.lit(0).alias("_order")),
    )))
    asked = _in_minutes(probes.select(on, "_us", "_order").dropna().distinct())
    timeline = asked.unionByName(spent.withColumn("_order", F.lit(1)), allowMissingColumns=True)
    seen = running(timeline, on=[on, "_day"], order=["_us", "_order"], buckets=["_minute"], values=["_w"])
    fade = F.exp(-F.expr(f"pmod(_us, {DAY_US}L) / 1e6D") / tau)
    known = seen.filter("_order <> 1").join(carry, [on, "_day"], "left").select(
        on, "_us", "_order",
        F.when(F.col("_order") == 2, (F.col("_w_run") + F.coalesce("_carry", F.lit(0.0))) * fade).alias("_live"),
        F.when(F.col("_order") == 0, F.col("_w_run") * fade * F.exp(F.lit(-days * day_fade))).alias("_stale"))
    left = F.coalesce(F.max("_live"), F.lit(0.0)) - F.coalesce(F.max("_stale"), F.lit(0.0))
    return probes.join(known, [on, "_us", "_order"], "left").groupBy(point_id).agg(F.greatest(left, F.lit(0.0)).alias(out))


def _in_minutes(instants: DataFrame) -> DataFrame:
    return instants.withColumns({"_minute": F.expr(bucket("_us", MINUTE_US)), "_day": F.expr(bucket("_us", DAY_US))})


def minute_amounts(events: DataFrame, *, on: str, ts: str, amount: str, tau: float) -> DataFrame:
    """(key, _us, _minute, _day, _w): one row per instant of a key, amounts
    grown by the decay since the start of the day."""
    folded = events.select(on, F.unix_micros(ts).alias("_us"), amount).dropna().groupBy(on, "_us").agg(exact_sum(amount, "_amount"))
    grown = F.col("_amount") * F.exp(F.expr(f"pmod(_us, {DAY_US}L) / 1e6D") / tau)
    return _in_minutes(folded).withColumn("_w", grown).drop("_amount")


def inside_any(
    points: DataFrame, spans: DataFrame, *, on: str, point_ts: str, start: str, end: str
) -> DataFrame:
    """The points that fall in ``[start, end)`` of some span of their key.

    A sweep along the key's time with the latest end of all spans begun so far:
    a point is inside when that lies after it. Spans of equal start and points of
    equal time are folded; the sweep runs minute by minute, and the latest ends
    of minutes and days are carried. A long span is one row, not one per hour.
    """
    begun = spans.filter(F.col(end) > F.col(start)).dropna(subset=[on]).groupBy(on, F.col(start).alias("_ts")).agg(F.max(end).alias("_until"))
    asked = points.select(on, F.col(point_ts).alias("_ts")).dropna().distinct().withColumn("_order", F.lit(1))
    timeline = asked.unionByName(begun.withColumn("_order", F.lit(0)), allowMissingColumns=True)
    rows = _in_minutes(timeline.withColumn("_us", F.unix_micros("_ts")))
    swept = running(rows, on=[on], order=["_us", "_order"], buckets=["_minute", "_day"], values=["_until"], total=F.max)
    inside = swept.filter("_order = 1 and _until_run > _ts").select(on, F.col("_ts").alias(point_ts))
    return points.join(inside, [on, point_ts], "left_semi").select(*points.columns)


def previous_in_order(df: DataFrame, on: str, ts: str, order: list[str], value: str, out: str) -> DataFrame:
    """``value`` of the row before, per key, in the given order. The order starts
    with ``ts``, ends with what tells rows apart, and has ``value`` between.

    Rows equal but for the last column are folded: all but the first of them
    follow a row of their own value. The last row of minutes and days is carried
    to the first one of the next.
    """
    same = order[:-1]
    if value not in same:
        raise ValueError(f"{value} is not one of {', '.join(same)}")
    folded = _in_minutes(df.filter(F.col(on).isNotNull() & F.col(ts).isNotNull()).groupBy(on, *same).agg(F.min(order[-1]).alias("_first"))
                         .withColumn("_us", F.unix_micros(ts))).withColumn("_row", F.struct(*same))
    before = running(folded, on=[on], order=same, buckets=["_minute", "_day"], values=["_row"], total=F.max, before=True)
    held = before.select(F.col(on).alias("_on"), *[F.col(c).alias(f"_at_{c}") for c in same], "_first", F.col("_row_run")[value].alias("_before"))
    meets = F.col(on) == F.col("_on")
    for c in same:
        meets = meets & F.col(c).eqNullSafe(F.col(f"_at_{c}"))
    found = F.when(F.col(order[-1]) == F.col("_first"), F.col("_before")).otherwise(F.col(value))
    return df.join(held, meets).select(*df.columns, found.alias(out))
