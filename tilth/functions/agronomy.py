"""Crop-growth formulas. Arguments and results are SQL expressions, to be
composed and placed in ``F.expr`` or ``selectExpr``."""

from __future__ import annotations

# Fixed values.
GDD_BASE_C = 10.0
GDD_CAP_C = 30.0
BARE_SOIL_NDVI = 0.14
STANDING_RESIDUE_NDVI = 0.22
PEAK_AT_PROGRESS = 0.60
SENESCENCE_EXPONENT = 1.6
DROUGHT_RELIEF = {"low": 0.0, "moderate": 0.12, "high": 0.25}
GDD_RATIO_FLOOR = 0.45
GDD_RATIO_SPAN = 0.45
VIABLE_GDD_RATIO = (0.85, 1.80)
IRRIGATION_DECAY_DAYS = 5.0
IRRIGATION_GAIN_PCT_PER_MM = 0.22
DIESEL_USD_PER_LITRE = 1.05
SEED_USD_PER_KG = 1.8
ELECTRICITY_USD_PER_KWH = 0.11


def clamp(c: str, low: float, high: float) -> str:
    """Null stays null (``least`` and ``greatest`` alone would skip it)."""
    return f"CASE WHEN ({c}) IS NOT NULL THEN least({high}D, greatest({low}D, {c})) END"


def degree_days(mean_temp: str, base: str = f"{GDD_BASE_C}D", cap: float = GDD_CAP_C) -> str:
    """Heat units of one day. A day with no temperature has none to report:
    it is null, not the heat of the cap."""
    return f"CASE WHEN {mean_temp} IS NOT NULL THEN greatest(least({mean_temp}, {cap}D) - {base}, 0D) END"


def expected_ndvi(progress: str, peak: str, perennial: str) -> str:
    """Annuals rise along a smoothstep to their peak and fall to standing
    residue; perennials keep a high level with one seasonal flush. ``progress``
    runs from 0 to 1."""
    rise = f"({progress} / {PEAK_AT_PROGRESS}D)"
    fall = f"greatest(({progress} - {PEAK_AT_PROGRESS}D) / {round(1 - PEAK_AT_PROGRESS, 2)}D, 0D)"
    growing = f"{BARE_SOIL_NDVI}D + ({peak} - {BARE_SOIL_NDVI}D) * {rise} * {rise} * (3 - 2 * {rise})"
    fading = f"{peak} - ({peak} - {STANDING_RESIDUE_NDVI}D) * pow({fall}, {SENESCENCE_EXPONENT}D)"
    evergreen = f"{peak} * (0.82D + 0.18D * (0.5D - 0.5D * cos(2 * pi() * {progress})))"
    return (f"CASE WHEN {perennial} THEN {evergreen} "
            f"WHEN {progress} <= {PEAK_AT_PROGRESS}D THEN {growing} ELSE {fading} END")


def water_stress(received: str, demand: str) -> str:
    return clamp(f"1D - {received} / {demand}", 0.0, 1.0)


def ndwi(ndvi: str, stress: str) -> str:
    return clamp(f"{ndvi} * 0.72D - {stress} * 0.35D", -1.0, 1.0)


def evi(ndvi: str) -> str:
    return clamp(f"{ndvi} * 2.5D / ({ndvi} + 2.4D)", -1.0, 1.0)


def yield_factor(water_ratio: str, gdd_ratio: str, tolerance: str) -> str:
    """Share of attainable yield: water and heat both limit, and a tolerant
    variety loses less to a water deficit."""
    cases = " ".join(f"WHEN '{name}' THEN {value}D" for name, value in DROUGHT_RELIEF.items())
    relief = f"(CASE {tolerance} {cases} END)"
    water = f"least(1D, {water_ratio} + {relief} * greatest(0D, 1D - {water_ratio}))"
    heat = clamp(f"({gdd_ratio} - {GDD_RATIO_FLOOR}D) / {GDD_RATIO_SPAN}D", 0.0, 1.0)
    return clamp(f"(CASE WHEN {water_ratio} IS NOT NULL THEN {water} END) * ({heat})", 0.0, 1.0)
