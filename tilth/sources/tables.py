"""Catalog: DDL from contracts, external partitioned tables, probes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.contracts import Contract

DDL_TYPES = {
    T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT",
    T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP", T.StringType: "STRING",
}


def ddl_type(dtype: T.DataType) -> str:
    """Column type for the catalog; anything unlisted is STRING."""
    return DDL_TYPES.get(type(dtype), "STRING")


def ddl_columns(contract: Contract, partition_key: str | None = None) -> list[tuple[str, str]]:
    """(column, type) without the partition column, which is declared apart."""
    return [(r.name, ddl_type(r.dtype)) for r in contract.rules if r.name != partition_key]


def create_table_ddl(table: str, contract: Contract, partition_key: str, partition_type: str, location: str) -> str:
    columns = ", ".join(f"`{n}` {t}" for n, t in [*ddl_columns(contract, partition_key), (partition_key, partition_type)])
    return (f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{partition_key}`) "
            f"LOCATION '{location}'")


def register_table(spark: SparkSession, table: str, contract: Contract, partition_key: str, location: str,
                   partition_type: str = "DATE") -> DataFrame:
    """(Re)create the external table over its files and find its partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(create_table_ddl(table, contract, partition_key, partition_type, location))
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def probe(spark: SparkSession, table: str) -> DataFrame:
    """One row (table_name, found, rows, columns), counted by Spark."""
    if not spark.catalog.tableExists(table):
        return spark.sql("SELECT :name AS table_name, false AS found, 0L AS rows, '' AS columns", {"name": table})
    df = spark.table(table)
    return df.agg(F.lit(table).alias("table_name"), F.lit(True).alias("found"), F.count("*").alias("rows"),
                  F.lit(",".join(df.columns)).alias("columns"))
