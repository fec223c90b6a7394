"""Named metrics over datasets, and the query shape charts share: filter,
group by dimensions at a time grain, aggregate, order, limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.functions.exact import exact_avg, wide_avg, wide_sum, wide_text
from tilth.functions.text import start_of

GRAINS = {"P1D": "day", "P1W": "week", "P1M": "month"}


def _tally(column: str, value: str):
    return lambda: F.expr(f"sum(CASE WHEN {column} = '{value}' THEN 1 ELSE 0 END)")


def _sum(column: str):
    return lambda: wide_sum(column)


def _avg(column: str):
    return lambda: wide_avg(column)


def _share(num: str, *dens: str, times: float = 1.0):
    """Ratio of totals; null when the denominator totals zero."""
    den = " + ".join(wide_text(d) for d in dens)
    scaled = f" * {times}D" if times != 1.0 else ""
    return lambda: F.expr(f"{wide_text(num)} / nullif({den}, 0D){scaled}")


def _count():
    return F.count("*")


METRICS: dict[str, dict[str, object]] = {
    "field_soil_daily": {
        "count": _count,
        "avg_moisture": lambda: exact_avg("avg_soil_moisture_pct"),
        "avg_temperature": lambda: exact_avg("avg_soil_temperature_c"),
        "fields_tracked": lambda: F.count_distinct("field_id"),
        "dry_field_days": _tally("moisture_stress", "dry"),
    },
    "field_crop_health_daily": {
        "count": _count,
        "avg_ndvi_metric": lambda: exact_avg("avg_ndvi"),
        "ndvi_vs_expected": lambda: exact_avg("ndvi_vs_expected_pct"),
        "field_observations": lambda: F.count_distinct("field_id"),
        "low_vigour_observations": _tally("vigour_flag", "low"),
    },
    "field_irrigation_daily": {
        "count": _count,
        "irrigation_mm_total": _sum("irrigation_mm"),
        "rainfall_mm_total": _sum("rainfall_mm"),
        "et0_mm_total": _sum("et0_mm"),
        "water_volume_total": _sum("water_volume_m3"),
        "energy_kwh_total": _sum("energy_kwh"),
        "deficit_days": _tally("supply_status", "deficit"),
        "irrigation_share": _share("irrigation_mm", "irrigation_mm", "rainfall_mm", times=100.0),
    },
    "v_field_water_daily": {
        "count": _count,
        "total_rainfall": _sum("precipitation_mm"),
        "avg_moisture": lambda: exact_avg("avg_soil_moisture_pct"),
        "total_et0": _sum("et0_mm"),
        "net_water_balance": _sum("water_balance_mm"),
        "dry_days": _tally("aridity_flag", "dry"),
        "peak_gdd": lambda: F.max("gdd_cumulative"),
    },
    "machine_daily": {
        "count": _count,
        "operation_hours_total": _sum("operation_hours"),
        "area_covered_total": _sum("area_covered_ha"),
        "fuel_used_total": _sum("fuel_used_litres"),
        "fuel_per_ha_metric": _share("fuel_used_litres", "area_covered_ha"),
        "avg_idle_ratio": lambda: exact_avg("idle_ratio_pct"),
        "downtime_hours_total": _sum("downtime_hours"),
        "repair_cost_total": _sum("repair_cost_usd"),
        "critical_faults_total": lambda: F.sum("critical_faults"),
    },
    "v_machine_utilisation": {
        "count": _count,
        "working_days_total": lambda: F.sum("working_days"),
        "down_days_total": lambda: F.sum("down_days"),
    },
    "planting_economics": {
        "count": _count,
        "area_total": _sum("area_ha"),
        "yield_total": _sum("yield_tonnes"),
        "yield_per_ha": _share("yield_tonnes", "CASE WHEN yield_t_ha IS NULL THEN 0D ELSE area_ha END"),
        "revenue_total": _sum("revenue_usd"),
        "cost_total": _sum("cost_total_usd"),
        "gross_margin_total": _sum("gross_margin_usd"),
        "margin_per_ha": _share("gross_margin_usd", "area_ha"),
        "water_received_avg": _avg("water_received_mm"),
        "water_use_efficiency": _avg("water_use_efficiency_t_per_100mm"),
    },
    "v_planting_cost_breakdown": {
        "count": _count,
        "amount_total": _sum("amount_usd"),
        "cost_per_ha": _share("amount_usd", "area_ha"),
    },
    "v_farm_field_locations": {
        "count": _count,
        "total_area": _sum("area_ha"),
    },
}


def metric(dataset: str, name: str) -> Column:
    """One metric as an aliased aggregate; unknown names list the known ones."""
    known = METRICS.get(dataset)
    if known is None:
        raise KeyError(f"no metrics for {dataset!r}; known: {', '.join(METRICS)}")
    if name not in known:
        raise KeyError(f"{dataset} has no metric {name!r}; known: {', '.join(known)}")
    return known[name]().alias(name)


def apply_filters(df: DataFrame, choices: dict[str, list] | None = None, time_column: str | None = None,
                  since=None, until=None) -> DataFrame:
    """Dashboard filters: any of the chosen values per column, and a time range
    that includes ``since`` and stops before ``until``."""
    for column, values in (choices or {}).items():
        df = df.filter(F.col(column).isin(*values))
    if since is not None:
        df = df.filter(F.col(time_column) >= F.lit(since))
    if until is not None:
        df = df.filter(F.col(time_column) < F.lit(until))
    return df


def ordered(df: DataFrame, by: list[Column], limit: int | None) -> DataFrame:
    """Order with every column as a tie-break, so a limit is deterministic."""
    df = df.orderBy(*by, *[F.col(c).asc_nulls_last() for c in df.columns])
    return df.limit(limit) if limit else df


def metric_query(
    df: DataFrame,
    dataset: str,
    metrics: list[str],
    dimensions: list[str] = (),
    x: str | None = None,
    grain: str | None = None,
    where: str | None = None,
    limit: int | None = None,
    choices: dict[str, list] | None = None,
    time_column: str | None = None,
    since=None,
    until=None,
    order_by: str | None = None,
    ascending: bool = False,
) -> DataFrame:
    """Aggregate-mode chart: metrics per x (at a grain) and dimensions, under
    dashboard filters. With a limit or an order, rows come sorted by ``order_by``
    (the first metric if not given), descending unless told otherwise."""
    df = apply_filters(df, choices, time_column, since, until)
    if where:
        df = df.filter(F.expr(where))
    keys = []
    if x:
        keys.append(start_of(GRAINS[grain], x, x) if grain else F.col(x))
    keys += [F.col(d) for d in dimensions]
    out = df.groupBy(*keys).agg(*[metric(dataset, m) for m in metrics])
    if limit is None and order_by is None:
        return out
    c = F.col(order_by or metrics[0])
    return ordered(out, [c.asc_nulls_last() if ascending else c.desc_nulls_last()], limit)


def table_query(df: DataFrame, columns: list[str], by: str | None, ascending: bool, limit: int | None) -> DataFrame:
    """Raw-mode chart: the rows, or the top ones by one column."""
    if limit is None:
        return df.select(*columns)
    c = F.col(by)
    return ordered(df.select(*columns), [c.asc_nulls_last() if ascending else c.desc_nulls_last()], limit)
