"""Agronomy features and ledgers over the conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.functions import agronomy, bands
from tilth.functions.exact import exact_sum, fixed_text, named, rounded, sum_text, unfixed_text
from tilth.functions.text import start_of
from tilth.operators.ranges import decayed_sum, months_of, window_range_sum
from tilth.operators.selection import weighted_rank
from tilth.session import scratch_dir


def planting_crops(plantings: DataFrame, varieties: DataFrame, crops: DataFrame) -> DataFrame:
    """Plantings with their variety and crop attributes. The crop catalogue is
    broadcast: its few ids would make a few tasks of all plantings."""
    grown = varieties.join(F.broadcast(crops.withColumnRenamed("category", "crop_category")), "crop_code")
    return plantings.join(F.broadcast(grown), "variety_id")


# -- degree-days --------------------------------------------------------------
def crop_gdd_daily(planted: DataFrame, weather: DataFrame) -> DataFrame:
    """Each planting's heat per day of its cycle, above its crop's base. A cycle
    is spelled out by months and meets the days its farm has in them."""
    cycles = planted.select("planting_id", "farm_id", "base_temp_c", "gdd_to_maturity", "planted_on",
                            F.greatest(F.col("planted_on"), F.col("expected_harvest_on")).alias("last_on"))
    in_ground = cycles.select("*", months_of("planted_on", "last_on").alias("_month"))
    heat = weather.filter("temp_mean_c is not null").select(
        "farm_id", "weather_date", "temp_mean_c", start_of("month", "weather_date", "_month"))
    return in_ground.join(heat, ["farm_id", "_month"]).filter("weather_date between planted_on and last_on").select(
        "planting_id", "weather_date", "gdd_to_maturity",
        rounded(agronomy.degree_days("temp_mean_c", "base_temp_c"), 4, "crop_gdd"))


def crop_gdd_ratio(planted: DataFrame, weather: DataFrame) -> DataFrame:
    """Season heat against what maturity takes, and whether it suits. Heat runs
    up per farm and base temperature, as many series as a farm's crops have
    bases, and a season is the difference of two lookups in its series."""
    low, high = agronomy.VIABLE_GDD_RATIO
    bases = planted.select("farm_id", "base_temp_c").distinct()
    heat = weather.filter("temp_mean_c is not null").select("farm_id", "weather_date", "temp_mean_c").join(bases, "farm_id").select(
        "farm_id", "base_temp_c", "weather_date", rounded(agronomy.degree_days("temp_mean_c", "base_temp_c"), 4, "crop_gdd"))
    seasons = planted.select("planting_id", "farm_id", "base_temp_c", "planted_on", F.expr("greatest(planted_on, expected_harvest_on) AS last_on"))
    total = window_range_sum(heat, seasons, on=["farm_id", "base_temp_c"], day="weather_date", window_id="planting_id",
                             start="planted_on", end="last_on", sums={"total": "crop_gdd"})
    season = planted.select("planting_id", "gdd_to_maturity").join(total, "planting_id").select(
        "planting_id", "gdd_to_maturity", rounded("total", 1, "season_gdd"))
    ratio = F.col("season_gdd") / F.col("gdd_to_maturity")
    return season.select("planting_id", "season_gdd", ratio.alias("gdd_ratio"), ratio.between(low, high).alias("viable"))


# -- canopy -------------------------------------------------------------------
def observed_canopies(observations: DataFrame, planted: DataFrame) -> DataFrame:
    """Usable passes over a planting with the planting's progress, 0 to 1."""
    progress = "datediff(observed_on, planted_on) / greatest(1, maturity_days)"
    attributes = planted.select("planting_id", "planted_on", "maturity_days", "peak_ndvi", "is_perennial")
    return (
        observations.filter("usable and planting_id is not null")
        .select("observation_id", "planting_id", "observed_on", "ndvi")
        .join(attributes, "planting_id")
        .withColumn("progress", F.expr(agronomy.clamp(progress, 0.0, 1.0)))
    )


def growth_stages(canopies: DataFrame) -> DataFrame:
    return canopies.select("observation_id", "planting_id", "progress", bands.growth_stage("progress").alias("growth_stage"))


def ndvi_residuals(canopies: DataFrame) -> DataFrame:
    expected = agronomy.expected_ndvi("progress", "peak_ndvi", "is_perennial")
    return canopies.select(
        "observation_id", "planting_id", "ndvi", rounded(expected, 4, "expected_ndvi"),
        rounded(f"ndvi - {expected}", 4, "ndvi_residual"))


# -- water and yield ----------------------------------------------------------
def planting_water(economics: DataFrame, crops: DataFrame) -> DataFrame:
    """Water received against the crop's demand, and the stress left by it.
    The crop code bounds the catalogue side."""
    demand = crops.select("crop_code", "water_demand_mm", "gdd_to_maturity")
    df = economics.join(F.broadcast(demand), "crop_code")
    return df.withColumns({
        "water_ratio": F.expr("water_received_mm / water_demand_mm"),
        "water_stress": rounded(agronomy.water_stress("water_received_mm", "water_demand_mm"), 4),
    })


def derived_ndwi_evi(canopies: DataFrame, water: DataFrame) -> DataFrame:
    stress = water.select("planting_id", "water_stress")
    return canopies.select("observation_id", "planting_id", "ndvi").join(stress, "planting_id").select(
        "observation_id", "planting_id", "ndvi", "water_stress",
        rounded(agronomy.ndwi("ndvi", "water_stress"), 4, "ndwi_derived"),
        rounded(agronomy.evi("ndvi"), 4, "evi_derived"))


def yield_factors(water: DataFrame, varieties: DataFrame) -> DataFrame:
    heat = "gdd_accumulated / gdd_to_maturity"
    tolerance = varieties.select("variety_code", "drought_tolerance")
    return water.join(F.broadcast(tolerance), "variety_code").select(
        "planting_id", "drought_tolerance",
        rounded(agronomy.yield_factor("water_ratio", heat, "drought_tolerance"), 4, "yield_factor"))


def graded_harvests(harvests: DataFrame, planted: DataFrame) -> DataFrame:
    """Quality grade by the share of the variety's potential achieved."""
    potential = planted.select("planting_id", "variety_code", "yield_potential_t_ha")
    achieved = "yield_t_ha / yield_potential_t_ha"
    return harvests.join(potential, "planting_id").select(
        "harvest_id", "planting_id", "variety_code", "yield_t_ha", "yield_potential_t_ha",
        bands.quality_grade(achieved).alias("grade"))


def residual_irrigation(readings: DataFrame, events: DataFrame) -> DataFrame:
    """Moisture still in the profile from recent irrigation, per reading."""
    boost = decayed_sum(
        readings, events, on="field_id", point_id="reading_id", point_ts="reading_ts", event_ts="event_ts",
        amount="depth_mm", days=int(agronomy.IRRIGATION_DECAY_DAYS), tau_days=agronomy.IRRIGATION_DECAY_DAYS / 3.0,
        out="_depth")
    return boost.select(
        "reading_id", rounded(f"_depth * {agronomy.IRRIGATION_GAIN_PCT_PER_MM}D", 4, "irrigation_boost_pct"))


# -- ledger -------------------------------------------------------------------
def machinery_cost_per_planting(operations: DataFrame) -> DataFrame:
    return operations.filter("planting_id is not null").groupBy("planting_id").agg(
        named(f"{sum_text('fuel_used_litres')} * {agronomy.DIESEL_USD_PER_LITRE}D", "machinery_cost_usd"))


def derived_cost_ledger(plantings: DataFrame, inputs: DataFrame, events: DataFrame, operations: DataFrame) -> DataFrame:
    """Costs booked from what was used; entries that come to nothing are left
    out. Each source is summed per planting before the ledgers are stacked."""
    def book(df: DataFrame, category: str, amount) -> DataFrame:
        return df.select("planting_id", F.lit(category).alias("cost_category"), amount.alias("amount_usd"))

    spent = inputs.filter("planting_id is not null").groupBy("planting_id").agg(
        exact_sum("CASE WHEN input_type = 'fertilizer' THEN total_cost_usd END", "fertilizer"),
        exact_sum("CASE WHEN input_type != 'fertilizer' THEN total_cost_usd END", "protection"))
    pumped = events.filter("planting_id is not null").groupBy("planting_id").agg(exact_sum("energy_kwh", "kwh"))
    seed = F.col("seed_rate_kg_ha") * F.col("area_ha") * agronomy.SEED_USD_PER_KG
    ledger = (
        book(plantings, "seed", seed)
        .unionByName(book(spent, "fertilizer", F.col("fertilizer")))
        .unionByName(book(spent, "crop_protection", F.col("protection")))
        .unionByName(book(pumped, "irrigation", F.col("kwh") * agronomy.ELECTRICITY_USD_PER_KWH))
        .unionByName(book(machinery_cost_per_planting(operations), "machinery", F.col("machinery_cost_usd")))
    )
    known = plantings.select("planting_id")
    return ledger.filter("amount_usd > 0").join(known, "planting_id", "left_semi").withColumn(
        "amount_usd", rounded("amount_usd", 2))


# -- dry and wet halves -------------------------------------------------------
def wet_dry_halves(df: DataFrame, ratio: str, response: str) -> DataFrame:
    """Mean response of the drier and the wetter half, the odd row going to the
    wetter one; plantings are ordered by (ratio, response).

    The distinct pairs are written out once, and the first pair of the wetter
    half is sought in them by refined histograms (``weighted_rank``). Then each
    pair's side follows from comparing it with that one; nothing is sorted.
    """
    spark = df.sparkSession
    pairs = (df.filter(F.col(ratio).isNotNull() & F.col(response).isNotNull())
             .groupBy(F.col(ratio).alias("_r"), F.col(response).alias("_y")).agg(F.expr("count(*) AS _n")))
    path = f"{scratch_dir(spark, 'halves')}/pairs"
    pairs.write.parquet(path)
    pairs = spark.read.schema(pairs.schema).parquet(path)
    half = (pairs.agg(F.sum("_n")).first()[0] or 0) // 2
    r, before = weighted_rank(pairs, "_r", "_n", half)
    tied = F.col("_r") == F.lit(r)
    y, tied_before = weighted_rank(pairs.filter(tied), "_y", "_n", half - before)
    at_middle = tied & (F.col("_y") == F.lit(y))
    dry = (F.when(at_middle, F.lit(half - before - tied_before))
           .when((F.col("_r") < F.lit(r)) | (tied & (F.col("_y") < F.lit(y))), F.col("_n")).otherwise(F.lit(0)))
    sides = pairs.withColumn("_dry", dry).select("_y", F.inline(F.array(
        F.struct(F.lit("dry").alias("half"), F.expr("_dry AS n")),
        F.struct(F.lit("wet").alias("half"), F.expr("_n - _dry AS n")))))
    return sides.filter("n > 0").groupBy("half").agg(
        F.sum("n").cast("bigint").alias("plantings"),
        named(f"{unfixed_text('sum(' + fixed_text('_y', 6) + ' * n)', 6)} / sum(n)", "mean_response"))


def water_yield_pairs(water: DataFrame, varieties: DataFrame) -> DataFrame:
    """Water ratio and relative yield of every planting that yielded."""
    potential = varieties.select("variety_code", "yield_potential_t_ha")
    return water.filter("yield_t_ha > 0").join(potential, "variety_code").select(
        "planting_id", "water_ratio",
        rounded("yield_t_ha / yield_potential_t_ha", 6, "relative_yield"))
