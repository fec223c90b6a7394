"""Classification rules: each is an ordered set of bands over a measure, given
as a column name or SQL expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds are part of the results.
MOISTURE_DRY_PCT = 15.0
MOISTURE_WET_PCT = 38.0
BALANCE_WET_MM = 2.0
BALANCE_DRY_MM = -3.0
STAGE_BARE_PCT = 15.0
STAGE_PEAK_FROM_PCT = 45.0
STAGE_PEAK_TO_PCT = 75.0
VIGOUR_LOW_PCT = 65.0
VIGOUR_HIGH_PCT = 95.0
SUPPLY_DEFICIT_MM = 2.0
SUPPLY_SURPLUS_MM = -2.0
IDLE_HEAVY_PCT = 60.0
GRADE_FLOORS = (("A", 0.80), ("B", 0.55), ("C", 0.25))
STAGE_ENDS = (
    ("emergence", 0.12),
    ("vegetative", 0.45),
    ("flowering", 0.65),
    ("grain_fill", 0.88),
)


def classify(bands: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first band whose condition holds."""
    arms = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in bands)
    return F.expr(f"CASE {arms} ELSE '{otherwise}' END")


def moisture_stress(mean: str) -> Column:
    return classify(
        [
            (f"{mean} IS NULL", "unknown"),
            (f"{mean} < {MOISTURE_DRY_PCT}D", "dry"),
            (f"{mean} > {MOISTURE_WET_PCT}D", "wet"),
        ],
        "optimal",
    )


def aridity(balance: str) -> Column:
    return classify(
        [
            (f"({balance}) IS NULL", "unknown"),
            (f"{balance} > {BALANCE_WET_MM}D", "wet"),
            (f"{balance} < {BALANCE_DRY_MM}D", "dry"),
        ],
        "balanced",
    )


def canopy_stage(progress: str) -> Column:
    return classify(
        [
            (f"{progress} IS NULL", "unknown"),
            (f"{progress} < {STAGE_BARE_PCT}D", "bare"),
            (f"{progress} < {STAGE_PEAK_FROM_PCT}D", "developing"),
            (f"{progress} <= {STAGE_PEAK_TO_PCT}D", "peak"),
        ],
        "senescing",
    )


def vigour(ratio: str, stage: str) -> Column:
    """A canopy is only judged once there is one."""
    return classify(
        [
            (f"{ratio} IS NULL OR {stage} IN ('unknown', 'bare')", "unknown"),
            (f"{ratio} < {VIGOUR_LOW_PCT}D", "low"),
            (f"{ratio} >= {VIGOUR_HIGH_PCT}D", "high"),
        ],
        "normal",
    )


def supply_status(deficit: str) -> Column:
    return classify(
        [
            (f"({deficit}) IS NULL", "unknown"),
            (f"{deficit} > {SUPPLY_DEFICIT_MM}D", "deficit"),
            (f"{deficit} < {SUPPLY_SURPLUS_MM}D", "surplus"),
        ],
        "balanced",
    )


def utilisation(critical: str, running: str, area: str, idle_pct: str) -> Column:
    """Any critical fault that day outranks what the machine was doing."""
    return classify(
        [
            (f"{critical} > 0", "down"),
            (f"{running} = 0", "parked"),
            (f"{area} > 0 AND coalesce({idle_pct} <= {IDLE_HEAVY_PCT}D, true)", "working"),
        ],
        "idle",
    )


def mixed_or_single(n_distinct: str, value: str) -> Column:
    return F.expr(f"CASE WHEN {n_distinct} > 1 THEN 'mixed' ELSE {value} END")


def quality_grade(achieved: str) -> Column:
    return classify([(f"{achieved} >= {floor}D", grade) for grade, floor in GRADE_FLOORS], "reject")


def growth_stage(progress: str) -> Column:
    p = f"least(1D, greatest(0D, {progress}))"
    return classify([(f"{p} < {end}D", stage) for stage, end in STAGE_ENDS], "maturity")
