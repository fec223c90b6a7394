"""Left joins on a key that is often null."""

from __future__ import annotations

from pyspark.sql import DataFrame

NULL_SPREAD = 4096


def sparse_left_join(df: DataFrame, other: DataFrame, key: str, by: tuple[str, ...] = ("*",)) -> DataFrame:
    """Left join on ``key``. Rows without a key match nothing, yet a plain join
    would send all of them to one task; they are spread by their contents
    instead, or by those of the columns ``by``, so that others need not come along
    for it. The other side's spread is always 0, but not written as a constant:
    Spark would drop that from the join's keys, and the spread with it. It is never
    null, so no filter for it makes the other side unlike other readings of the same."""
    spread = f"CASE WHEN {key} IS NULL THEN pmod(xxhash64({', '.join(by)}), {NULL_SPREAD}) ELSE 0 END"
    left = df.selectExpr("*", f"{spread} AS _spread")
    return left.join(other.selectExpr("*", f"coalesce(pmod(xxhash64({key}), 1L), 0L) AS _spread"), [key, "_spread"], "left").drop("_spread")
