"""Weather documents: one JSON object per place and period, whose ``daily``
block holds parallel arrays, one value per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAILY = {
    "temperature_2m_max": "double", "temperature_2m_min": "double", "temperature_2m_mean": "double",
    "precipitation_sum": "double", "rain_sum": "double", "precipitation_hours": "double",
    "et0_fao_evapotranspiration": "double", "shortwave_radiation_sum": "double", "wind_speed_10m_max": "double",
    "weather_code": "int",
}
DOCUMENT = (
    "farm_code string, source string, latitude double, longitude double, daily struct<time: array<date>, "
    + ", ".join(f"{n}: array<{t}>" for n, t in DAILY.items()) + ">"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).json(path)


def _series(name: str) -> Column:
    return F.col(f"daily.{name}")


def _given(name: str) -> Column:
    return F.coalesce(F.size(_series(name)) > 0, F.lit(False))


def aligned() -> Column:
    """Every given series has one value per date; a short one would shift all
    values after its gap onto wrong dates."""
    ok = F.lit(True)
    for name in DAILY:
        ok = ok & (~_given(name) | (F.size(_series(name)) == F.size("daily.time")))
    return ok


def flatten_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected documents): one row per day, nulls for series that are
    not given; misaligned documents are set aside whole."""
    blank = {n: F.array_repeat(F.lit(None).cast(t), F.size("daily.time")) for n, t in DAILY.items()}
    zipped = F.arrays_zip(
        F.col("daily.time").alias("weather_date"),
        *[F.when(_given(n), _series(n)).otherwise(blank[n]).alias(n) for n in DAILY])
    rows = documents.filter(aligned()).select(
        "farm_code", "latitude", "longitude", "source", F.explode(zipped).alias("d")
    ).select("farm_code", "latitude", "longitude", F.col("d.weather_date").alias("weather_date"), "source",
             *[F.col(f"d.{n}").alias(n) for n in DAILY])
    return rows, documents.filter(~aligned())


def to_documents(weather: DataFrame) -> DataFrame:
    """One document per place, source and month, as the service would return
    it. A place has one row per day, so a document holds at most 31."""
    month = F.trunc("weather_date", "month").alias("month")
    entry = F.struct("weather_date", *DAILY)
    grouped = weather.groupBy("farm_code", "source", "latitude", "longitude", month).agg(
        F.array_sort(F.collect_list(entry)).alias("e"))
    daily = F.struct(F.col("e.weather_date").alias("time"), *[F.col(f"e.{n}").alias(n) for n in DAILY])
    return grouped.select("farm_code", "source", "latitude", "longitude", daily.alias("daily"))
