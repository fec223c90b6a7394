"""Binary files written by Spark's own committer, so retries and lost executors
leave no partial file and any storage Spark knows will do.

The text writer puts a row's bytes down as they are, then a separator byte. A
format whose every row ends in one fixed byte can therefore be written whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.sources.lake import exists

ROWS = "kind string, seq long, value binary"
#: The same with the number of the file among those of its task and kind, and how many those can be.
FILE_ROWS, FILES = "kind string, file long, seq long, value binary", 1 << 20


def write_files(rows: DataFrame, path: str, last_byte: str) -> None:
    """``rows`` has kind, seq and value, and file if a task can have several of a kind:
    one file per task, kind and file, values in the order of seq, each followed by ``last_byte``."""
    folders = [c for c in ("kind", "file") if c in rows.columns]
    (rows.sortWithinPartitions(*folders, "seq")
     .select(*folders, F.col("value").cast("string").alias("value"))
     .write.partitionBy(*folders).option("lineSep", last_byte).text(path))


def part_number(path_column):
    """The number of the task that wrote a file, from its name; where tasks number
    their files, one that is in the order of tasks and files."""
    task = F.regexp_extract(path_column, r"part-(\d+)-[^/]*$", 1).cast("long")
    file = F.regexp_extract(path_column, r"/file=(\d+)/[^/]*$", 1)
    return F.when(file == "", task).otherwise(task * FILES + F.nullif(file, F.lit("")).cast("long"))


def read_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(part, content): one row per file. Without numbers of their own, files are as large
    as the tasks that wrote them, so a row is bounded by the partitioning of the writer."""
    if not exists(spark, f"{path}/kind={kind}"):  # no rows, no files
        return spark.createDataFrame([], "part long, content binary")
    files = spark.read.format("binaryFile").load(f"{path}/kind={kind}")
    return files.select(part_number(F.col("path")).alias("part"), "content")


def read_lines(spark: SparkSession, path: str, kind: str, last_byte: str, names: list[str]) -> DataFrame:
    """(part, names...): tab-separated long columns of the lines of a kind."""
    if not exists(spark, f"{path}/kind={kind}"):
        return spark.createDataFrame([], ", ".join(f"{n} long" for n in ["part", *names]))
    lines = (spark.read.option("lineSep", last_byte).text(f"{path}/kind={kind}")
             .select(part_number(F.col("_metadata.file_path")).alias("part"), F.split("value", "\t").alias("v")))
    return lines.select("part", *[F.expr(f"cast(nullif(v[{i}], '') as bigint)").alias(n) for i, n in enumerate(names)])
