"""Contracts applied to data: structure, row checks, quarantine, audits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.contracts import Contract, row_failures
from tilth.operators.joins import sparse_left_join

FAILURES = "_failures"
MAX_REJECTION_RATE = 0.10


class StructureError(ValueError):
    """The frame cannot be checked row by row: its columns are wrong."""


class RejectionError(ValueError):
    """Too many rows failed for the rest to be trusted."""


# -- structure ----------------------------------------------------------------
def structure_problems(df: DataFrame, contract: Contract) -> list[tuple[str, str]]:
    """(column, problem) for missing, mistyped and, if strict, extra columns."""
    held = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for r in contract.rules:
        if r.name not in held:
            out.append((r.name, "missing"))
        elif held[r.name] != r.dtype:
            out.append((r.name, f"is {held[r.name].simpleString()}, not {r.dtype.simpleString()}"))
    if contract.strict:
        out += [(c, "unexpected") for c in df.columns if c not in contract.columns]
    return out


def require_structure(df: DataFrame, contract: Contract) -> DataFrame:
    problems = structure_problems(df, contract)
    if problems:
        raise StructureError(f"{contract.name}: " + "; ".join(f"{c} {p}" for c, p in problems))
    return df


# -- rows ---------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with how many. Counting combines on the
    map side, so a key repeated without end is one partial count per task."""
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.expr("count(*) AS copies")).filter("copies > 1")


def flag_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Every row with the names of all checks it fails; all copies of a
    duplicated unique value fail."""
    require_structure(df, contract)
    flagged = df.withColumn(FAILURES, row_failures(contract))
    for c in contract.unique_columns:
        repeated = duplicate_keys(df, [c]).select(c, F.lit(f"{c}:unique").alias("_repeated"))
        flagged = sparse_left_join(flagged, repeated, c).withColumn(
            FAILURES, F.when(F.col("_repeated").isNotNull(), F.array_append(FAILURES, F.col("_repeated"))).otherwise(F.col(FAILURES))
        ).drop("_repeated")
    return flagged.select(*df.columns, FAILURES)


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(FAILURES) == 0).drop(FAILURES)


def invalid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(FAILURES) > 0).drop(FAILURES)


def failure_summary(flagged: DataFrame) -> DataFrame:
    """Rows failing per column and check, most frequent first."""
    name = F.explode(FAILURES).alias("failure")
    return (
        flagged.select(name)
        .groupBy(
            F.substring_index("failure", ":", 1).alias("column"),
            F.regexp_replace("failure", "^[^:]*:", "").alias("check"),
        )
        .agg(F.expr("count(*) AS failed_rows"))
        .orderBy(F.desc("failed_rows"), "column", "check")
    )


def rejection_counts(flagged: DataFrame) -> DataFrame:
    df = flagged.agg(
        F.expr("count(*) AS rows_in"), F.count_if(F.size(FAILURES) > 0).alias("rows_rejected"))
    rate = F.when(F.col("rows_in") > 0, F.col("rows_rejected") / F.col("rows_in")).otherwise(F.lit(0.0))
    return df.withColumn("rejection_rate", rate)


def check_rate(name: str, rows_in: int, rejected: int, limit: float = MAX_REJECTION_RATE) -> None:
    """A rate equal to the limit still passes."""
    if rows_in and rejected / rows_in > limit:
        raise RejectionError(f"{name}: {rejected} of {rows_in} rows failed validation, above {limit:.0%}")


def quarantine_report(flagged: DataFrame, pipeline: str, logical_date: str) -> DataFrame:
    """The failure summary with the run it belongs to. The totals are one row."""
    totals = rejection_counts(flagged).select(F.struct("*")).scalar()
    return failure_summary(flagged).withColumns({
        "pipeline": F.lit(pipeline),
        "logical_date": F.lit(logical_date),
        "rows_in": totals["rows_in"],
        "rows_rejected": totals["rows_rejected"],
        "rejection_rate": F.round(totals["rejection_rate"], 6),
    })


# -- audits -------------------------------------------------------------------
@dataclass(frozen=True)
class Reference:
    child: str
    key: str
    parent: str
    parent_key: str


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def referential_report(read, references: list[Reference]) -> DataFrame:
    """Orphans per relation. Keys are counted first, so each distinct key meets
    its parent once however often it occurs."""
    out = None
    for r in references:
        keys = read(r.child).filter(F.col(r.key).isNotNull()).groupBy(r.key).agg(F.expr("count(*) AS n"))
        known = read(r.parent).select(F.col(r.parent_key).alias(r.key), F.lit(1).alias("_known")).distinct()
        row = keys.join(known, r.key, "left").agg(
            F.lit(r.child).alias("child"), F.lit(r.parent).alias("parent"), F.lit(r.key).alias("key"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"))
        out = row if out is None else out.unionByName(row)
    return out


def violations(df: DataFrame, rules: dict[str, Column], keep: list[str]) -> DataFrame:
    """Rows breaking row rules (a null outcome does not break one), one line
    per broken rule."""
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
    return df.select(*keep, F.explode(broken).alias("rule"))


def labels_used_twice(df: DataFrame, label: str, code: str) -> DataFrame:
    """Labels that stand for more than one code: unusable as a grouping."""
    return df.groupBy(label).agg(F.count_distinct(code).alias("codes")).filter("codes > 1")


def mismatched_rows(df: DataFrame, expected: Column, actual: str, tolerance: float, keep: list[str]) -> DataFrame:
    gap = F.abs(expected - F.col(actual))
    return df.filter(gap > tolerance).select(*keep, F.col(actual))


def compare_counts(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Row counts per group on either side; equal after an idempotent re-run."""
    left = before.groupBy(*by).agg(F.expr("count(*) AS rows_before"))
    right = after.groupBy(*by).agg(F.expr("count(*) AS rows_after"))
    df = left.join(right, by, "full")
    return df.select(*by, F.coalesce("rows_before", F.lit(0)).alias("rows_before"),
                     F.coalesce("rows_after", F.lit(0)).alias("rows_after")).withColumn(
        "same", F.col("rows_before") == F.col("rows_after"))


def catalogue_diff(left: DataFrame, right: DataFrame, names=("left_only", "right_only")) -> DataFrame:
    """Rows found on one side only, counted as a bag, tagged by side."""
    right = right.select(*left.columns)
    one = left.exceptAll(right).withColumn("side", F.lit(names[0]))
    return one.unionByName(right.exceptAll(left).withColumn("side", F.lit(names[1])))
