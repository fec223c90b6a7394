"""One row per key.

Each form filters a ranking down to its first rows, which lets Spark keep only
the leading rows of every key inside each map task before the shuffle (window
group limit). A key that holds a third of all rows therefore reaches its
reducer as one candidate per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first(df: DataFrame, ranking: str, keys: list[str], order: list[str]) -> DataFrame:
    window = f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}"
    return df.selectExpr("*", f"{ranking}() OVER ({window}) AS _rank").filter("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given SQL order."""
    return _first(df, "row_number", keys, order)


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str], ties: list[str] | None = None) -> DataFrame:
    """The newest row of each key: later marks first, then every remaining
    column as a tie-break, so the outcome never depends on file order."""
    held = df.columns
    rest = [c for c in (ties if ties is not None else held) if c not in keys and c not in newest]
    order = [f"{c} DESC NULLS LAST" for c in [*[n for n in newest if n in held], *rest]]
    return first_per_key(df, keys, order)


def precedence_merge(df: DataFrame, keys: list[str], preferred: str, ties: list[str]) -> DataFrame:
    """Rows flagged ``preferred`` beat the others of their key."""
    return latest_per_key(df, keys, [preferred], ties)


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, keys, [f"{c} ASC NULLS LAST" for c in order])


def latest_rows_by_join(df: DataFrame, key: str, day: str) -> DataFrame:
    """Every row on its key's latest day, for facts whose latest day may hold
    any number of rows: the days are found by a combined maximum and joined
    back, and adaptive execution can split a day that is too large."""
    latest = df.groupBy(key).agg(F.max(day).alias(day))
    return df.join(latest, [key, day], "left_semi")


def latest_rows(df: DataFrame, key: str, day: str) -> DataFrame:
    """Every row on its key's latest day, ties kept, for marts: their grain
    bounds the ties, and only leading rows are moved."""
    return _first(df, "rank", [key], [f"{day} DESC NULLS LAST"])
