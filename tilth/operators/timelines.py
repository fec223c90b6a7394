"""Running totals along the timeline of a key, in groups the calendar bounds.

A window over a whole key, day or hour grows with the key that is busiest. Here
a timeline is cut into buckets of time, fine ones inside coarse ones. A window
runs inside a fine bucket only; what the earlier buckets come to is carried in
from the buckets' own totals, one row each, which are run the same way one
level up. Callers fold rows of equal order first, so that a fine bucket has no
more rows than it has distinct instants, however many rows the key has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MINUTE_US, DAY_US = 60_000_000, 86_400_000_000


def bucket(us: str, size: int) -> str:
    """Number of the bucket of ``size`` microseconds, also before 1970."""
    return f"(({us}) - pmod({us}, {size}L)) div {size}L"


def _both(total: Callable, a: Column, b: Column) -> Column:
    if total is F.max:
        return F.greatest(a, b)
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def running(rows: DataFrame, *, on: list[str], order: list[str], buckets: list[str], values: list[str],
            total: Callable = F.sum, before: bool = False) -> DataFrame:
    """``rows`` with ``<value>_run`` for each of ``values``: its ``total``
    (``F.sum`` or ``F.max``) over the rows of the key up to each row in ``order``,
    or, with ``before``, over the rows before it. ``buckets`` are columns from
    fine to coarse that follow the order; each lies inside the next one. Null
    values count as nothing; keys are not null and no two rows of a key are equal
    in order.

    Both readings of a bucket, its rows and its last row, take the same window
    over the same exchange, which Spark then runs once.
    """
    inside = Window.partitionBy(*on, *buckets[:1]).orderBy(*order)
    first = Window.unboundedPreceding
    runs = {f"{v}_run": total(v).over(inside.rowsBetween(first, -1 if before else 0)) for v in values}
    if not buckets:
        return rows.withColumns(runs)
    upto = {f"_to_{v}": total(v).over(inside.rowsBetween(first, 0)) for v in values}
    here = rows.withColumns({**runs, **upto, "_last": F.lead(F.lit(True)).over(inside).isNull()})
    ends = here.filter("_last").select(*on, *buckets, *[F.col(f"_to_{v}").alias(v) for v in values])
    earlier = running(ends, on=on, order=buckets[:1], buckets=buckets[1:], values=values, total=total, before=True)
    carried = earlier.select(*on, buckets[0], *[F.col(f"{v}_run").alias(f"_from_{v}") for v in values])
    return here.join(carried, [*on, buckets[0]]).select(
        *rows.columns, *[_both(total, F.col(f"{v}_run"), F.col(f"_from_{v}")).alias(f"{v}_run") for v in values])
