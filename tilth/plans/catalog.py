"""All datasets by name over one folder of supplied tables, built lazily."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilth.operators.conform import conform
from tilth.operators.ranges import active_interval_join, owned_by_year
from tilth.plans import marts, views
from tilth.plans.conformed import FIELD_PASSES, SPECS, conformed, fact_weather_daily
from tilth.session import use_utc
from tilth.sources.adapters import ADAPTERS, source_table, supplied


class FarmData:
    """``data["planting_economics"]`` is the plan of that dataset, and
    ``data["planting_economics:costs+weather"]`` that of the columns which these
    parts of it determine; ``data["fact_field_cost:planting_id+amount_usd"]`` has
    the rows of a conformed table with these columns alone. Plans are kept so a dataset used twice in a query is
    the same plan, whose shuffles Spark then computes once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = use_utc(spark)
        self.folder = folder
        self._plans: dict[str, DataFrame] = {}
        self._supplied: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._plans:
            self._plans[name] = self._build(name)
        return self._plans[name]

    def many(self, *names: str) -> list[DataFrame]:
        return [self[n] for n in names]

    def supplied(self, table: str) -> DataFrame:
        if table not in self._supplied:
            self._supplied[table] = supplied(self.spark, self.folder, table)
        return self._supplied[table]

    def raw(self, name: str) -> DataFrame:
        """A raw table as the source system has it."""
        return self["src_" + name]

    def _build(self, name: str) -> DataFrame:
        if name == "src_field_index_observation":
            plantings = self.raw("planting").select("planting_id", "field_id", "planted_on", "expected_harvest_on")
            return active_interval_join(
                self.raw("field_pass"), plantings, on="field_id", day="observed_on", start="planted_on",
                end="expected_harvest_on", value="planting_id")
        if name in ADAPTERS:
            return source_table(self.spark, name, self.supplied)
        if name == "src_field_farms":
            return self.raw("field").select("field_id", "farm_id").distinct()
        if name == "src_field_cycles":
            cycles = owned_by_year(self.raw("planting"), on="field_id", start="planted_on", end="expected_harvest_on",
                                   value="planting_id", out="_cycles")
            return self.raw("field").select("field_id", "farm_id").join(cycles, "field_id", "left")
        dataset, _, columns = name.partition(":")
        if dataset == "fact_field_index":
            return conform(FIELD_PASSES, self.raw, columns.split("+") if columns else None)
        if dataset in SPECS:
            return conformed(dataset, self.raw, columns.split("+") if columns else None)
        if dataset == "fact_weather_daily" and columns:
            return fact_weather_daily(*self.many(*_MARTS[dataset][1]), columns=columns.split("+"))
        if name in _MARTS:
            make, inputs = _MARTS[name]
            return make(*self.many(*inputs))
        if name.startswith("planting_economics:"):
            return self._economics(name.partition(":")[2].split("+"))
        if name in views.VIEWS:
            make, inputs = views.VIEWS[name]
            return make(*self.many(*inputs))
        raise KeyError(f"unknown dataset {name!r}; known: {', '.join(sorted(dataset_names()))}")

    def _economics(self, parts: list[str]) -> DataFrame:
        star = marts.star_join(*self.many(*marts.PLANTING))
        return marts.economics_of(star, {p: marts.ECONOMICS[p].make(*self.many(*marts.ECONOMICS[p].inputs)) for p in parts})


_MARTS = {
    "fact_weather_daily": (fact_weather_daily, ["src_weather_archive", "src_weather_forecast", "src_farm"]),
    "field_soil_daily": (marts.field_soil_daily, ["fact_sensor_reading", "dim_field", "dim_farm"]),
    "dim_date": (marts.dim_date, ["fact_weather_daily"]),
    "field_weather_daily": (marts.field_weather_daily, ["fact_weather_daily", "dim_field", "dim_farm"]),
    "field_crop_health_daily": (marts.field_crop_health_daily,
                                ["fact_field_index", "dim_field", "dim_farm", "dim_planting", "dim_crop_variety", "dim_crop", "src_field_farms"]),
    "field_irrigation_daily": (marts.farm_irrigation_daily, ["fact_weather_daily", "dim_field", "dim_farm", "fact_irrigation"]),
    "machine_daily": (marts.machine_daily, ["fact_machine_telemetry", "fact_machine_operation", "fact_machine_fault",
                                            "dim_machine", "dim_farm"]),
    "planting_economics": (marts.planting_economics,
                           [*marts.PLANTING, *[marts.ECONOMICS[p].inputs[0] for p in ("harvest", "costs", "inputs", "irrigation", "weather")]]),
}


def dataset_names() -> list[str]:
    return [*ADAPTERS, "src_field_index_observation", *SPECS, *_MARTS, *views.VIEWS]
