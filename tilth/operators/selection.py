"""Exact order statistics of a column without ordering its table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of one histogram, and distinct values that are read instead of refined.
BINS, FEW = 1024, 1024


def weighted_rank(df: DataFrame, column: str, weight: str, rank: int, bins: int = BINS, few: int = FEW) -> tuple[float | None, int]:
    """The value at 0-based ``rank`` of a double column in ascending order, a row
    counting ``weight`` times, and the weight of all lesser values; no value if
    there are not so many rows.

    A histogram of the range finds the bin the rank falls in, the bin's own least
    and greatest value are the next range, until few values are left in it. What
    reaches the driver is a histogram or those few values. ``df`` is scanned once
    a round, so it should be a written table.
    """
    before, inside = 0, df.filter(F.col(column).isNotNull())
    low, high = inside.agg(F.min(column), F.max(column)).first()
    while low is not None and low < high:
        width = high / 2 - low / 2  # halves, as a range may be wider than a double
        place = (F.col(column) / 2 - F.lit(low / 2)) / F.lit(width) * bins if width else (F.col(column) > F.lit(low)).cast("double")
        binned = inside.groupBy(F.least(F.floor(place), F.lit(bins - 1)).alias("bin")).agg(
            F.sum(weight).alias("weight"), F.count("*").alias("rows"), F.min(column).alias("low"), F.max(column).alias("high"))
        found = None
        for b in sorted(binned.collect(), key=lambda b: b["bin"]):
            if rank < before + b["weight"]:
                found = b
                break
            before += b["weight"]
        if found is None:
            return None, before
        inside, low, high = inside.filter(F.col(column).between(found["low"], found["high"])), found["low"], found["high"]
        if low < high and found["rows"] <= few:
            for value, many in sorted(tuple(r) for r in inside.groupBy(column).agg(F.sum(weight)).collect()):
                if rank < before + many:
                    return value, before
                before += many
    if low is not None and rank >= before + (inside.agg(F.sum(weight)).first()[0] or 0):
        return None, before
    return low, before
