"""The lake: partitioned Parquet datasets, batches and marks.

Layout is ``root/zone/dataset/<partition key>=<value>``. Writes replace exactly
the partitions they carry (dynamic overwrite), so repeating a run leaves the
lake as it was. Tables that are replaced whole have versions and a pointer.
"""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilth.contracts import Contract, widened

MARK_SCHEMA = "pipeline string, source_table string, watermark_column string, watermark timestamp"
ENTRY_SCHEMA = MARK_SCHEMA + ", kind string, seq long"
RUN_SCHEMA = ("pipeline string, logical_date date, started_at timestamp, finished_at timestamp, status string, "
              "rows_read long, rows_written long, rows_quarantined long, error string")


class MissingUpstream(FileNotFoundError):
    """An input partition that another job should have written."""


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def children(spark: SparkSession, path: str, start: str = "") -> list[str]:
    """Names inside a folder that begin so, in order; none if it is not there."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith(start)) if fs.exists(p) else []


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another
    name, then renamed. An existing file stays, and the call fails."""
    fs, target = _fs(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise FileExistsError(path)


def numeric_normalise(df: DataFrame) -> DataFrame:
    """Decimal columns become doubles; nothing else changes."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def read_source(spark: SparkSession, fmt: str, **options) -> DataFrame:
    """A source table through any Spark reader (``parquet``, ``jdbc``, ...),
    with decimals normalised. Filters and columns chosen later still reach it."""
    return numeric_normalise(spark.read.format(fmt).options(**options).load())


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def base(self, zone: str, dataset: str) -> str:
        return f"{self.root}/{zone}/{dataset}"

    def path(self, zone: str, dataset: str) -> str:
        """Where the rows of a dataset are: its folder, or the version that the
        newest pointer of a replaced table names."""
        base = self.base(zone, dataset)
        pointers = children(self.spark, f"{base}/_pointers", "v")
        return f"{base}/{self._pointed(base, pointers[-1])}" if pointers else base

    def _pointed(self, base: str, pointer: str) -> str:
        fs, p = _fs(self.spark, f"{base}/_pointers/{pointer}")
        source = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def sweep(self, zone: str, dataset: str) -> None:
        """Delete the versions before the last two, and rows from before the first."""
        base = self.base(zone, dataset)
        pointers = children(self.spark, f"{base}/_pointers", "v")
        held = {self._pointed(base, p) for p in pointers[-2:]}
        for p in pointers[:-2]:
            gone = self._pointed(base, p)
            if gone not in held:
                remove(self.spark, f"{base}/{gone}")
            remove(self.spark, f"{base}/_pointers/{p}")
        if pointers:
            for name in children(self.spark, base, "part-"):
                remove(self.spark, f"{base}/{name}")

    # -- writing --------------------------------------------------------------
    def write_partition(self, df: DataFrame, zone: str, dataset: str, key: str, value: str,
                        sort: list[str] | None = None) -> str:
        """Replace one partition. Without rows the partition is emptied, as a
        dynamic overwrite alone would leave the old rows in place. The rows are
        written aside and take the partition's place by renaming, so a write that
        dies leaves the old ones."""
        path = self.path(zone, dataset)
        if sort:
            df = df.sortWithinPartitions(*sort)
        target, staging = f"{path}/{key}={value}", f"{self.root}/staging/{dataset}-{uuid.uuid4().hex}"
        try:
            df.drop(key).write.option("compression", "zstd").parquet(staging)
            self._swap(staging, target)
        finally:
            remove(self.spark, staging)
        return target

    def _swap(self, new: str, target: str) -> None:
        """Put ``new`` in the place of ``target``. If a swap died between its two
        renames, the old folder is beside the target under a hidden name, where
        the next swap puts it back first."""
        fs, at = _fs(self.spark, target)
        fs.mkdirs(at.getParent())
        old = _fs(self.spark, f"{target[:target.rindex('/')]}/.old-{at.getName()}")[1]
        if fs.exists(old):
            fs.delete(old, True) if fs.exists(at) else fs.rename(old, at)
        if fs.exists(at) and not fs.rename(at, old):
            raise OSError(f"{target} could not be moved aside")
        if not fs.rename(_fs(self.spark, new)[1], at):
            fs.rename(old, at)
            raise OSError(f"{new} could not be moved to {target}")
        fs.delete(old, True)

    def write_by(self, df: DataFrame, zone: str, dataset: str, keys: list[str], sort: list[str] | None = None) -> str:
        """Replace every partition that occurs in ``df``, and only those. Rows
        gather by partition first, a large one in several tasks, so that small
        partitions get one file each."""
        path = self.path(zone, dataset)
        df = df.hint("rebalance", *keys)
        if sort:
            df = df.sortWithinPartitions(*keys, *sort)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
         .partitionBy(*keys).parquet(path))
        return path

    def replace(self, df: DataFrame, zone: str, dataset: str, sort: list[str] | None = None) -> str:
        """Replace a whole table; an empty frame empties it. The rows become a
        version folder, and a pointer file that appears in one step makes it the
        table. Until then, and if the write dies, the old version is. The version
        before stays for readers that have begun; older ones are swept. Of two
        replacements that end together one fails and changes nothing."""
        base = self.base(zone, dataset)
        pointers = children(self.spark, f"{base}/_pointers", "v")
        version = f"data-{uuid.uuid4().hex}"
        try:
            (df.sortWithinPartitions(*sort) if sort else df).write.option("compression", "zstd").parquet(f"{base}/{version}")
            write_once(self.spark, f"{base}/_pointers/v{int(pointers[-1][1:]) + 1 if pointers else 0:012d}", version)
        except BaseException:
            remove(self.spark, f"{base}/{version}")
            raise
        self.sweep(zone, dataset)
        return f"{base}/{version}"

    def append(self, df: DataFrame, zone: str, dataset: str) -> int:
        """Append rows and say how many; an empty frame adds nothing. The frame
        runs once, into a folder of its own, and its files then join the table."""
        path, staging = self.path(zone, dataset), f"{self.root}/staging/{dataset}-{uuid.uuid4().hex}"
        counted, watch = _observed(df, F.count("*").alias("n"))
        try:
            counted.write.option("compression", "zstd").parquet(staging)
            if watch.get["n"]:
                fs, target = _fs(self.spark, path)
                fs.mkdirs(target)
                for name in children(self.spark, staging, "part-"):
                    if not fs.rename(_fs(self.spark, f"{staging}/{name}")[1], _fs(self.spark, f"{path}/{name}")[1]):
                        raise OSError(f"{name} could not be moved to {path}")
        finally:
            remove(self.spark, staging)
        return watch.get["n"]

    def drop_partition(self, zone: str, dataset: str, key: str, value: str) -> bool:
        return remove(self.spark, f"{self.path(zone, dataset)}/{key}={value}")

    # -- reading --------------------------------------------------------------
    def read(self, zone: str, dataset: str, contract: Contract | None = None, partition: dict[str, str] | None = None) -> DataFrame:
        """All partitions, or those of ``partition``. With a contract, every file
        is read in the types it was stored in and then takes the contract's
        (narrower types and decimals widen, missing columns are null), and a
        dataset that is not there yet is an empty frame of that shape. Columns
        beyond the contract are kept if it is not strict."""
        path = self.path(zone, dataset)
        if contract is None:
            df = self.spark.read.option("mergeSchema", True).parquet(path)
            for k, v in (partition or {}).items():
                df = df.filter(F.col(k) == F.lit(v))
            return df
        folders = [f for f in leaf_folders(self.spark, path) if all(f"/{k}={v}" in f for k, v in (partition or {}).items())]
        if not folders:
            return contract.empty(self.spark)
        out = None
        for schema, part in by_stored_schema(self.spark, path, folders):
            df = widened(self.spark.read.option("basePath", path).schema(schema).parquet(*part), contract)
            missing = {r.name: F.lit(None).cast(r.dtype) for r in contract.rules if r.name not in df.columns}
            df = df.withColumns(missing) if missing else df
            keys = [k for k in _keys(path, part[0]) if k not in contract.columns]
            more = [c for c in df.columns if c not in contract.columns and c not in keys] if not contract.strict else []
            df = df.select(*contract.columns, *more, *keys)
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        return out

    def require(self, zone: str, dataset: str, key: str, value: str) -> DataFrame:
        """One partition that must be there; its absence names what to run."""
        path = f"{self.path(zone, dataset)}/{key}={value}"
        if not exists(self.spark, path):
            raise MissingUpstream(f"{zone}.{dataset} has no {key}={value}; run {zone}.{dataset} first")
        return self.spark.read.parquet(path)


# -- files of different times -------------------------------------------------
def leaf_folders(spark: SparkSession, path: str) -> list[str]:
    """The partition folders of a dataset, in the order of their names."""
    nested = [n for n in children(spark, path) if "=" in n]
    return [f for n in nested for f in leaf_folders(spark, f"{path}/{n}")] or ([path] if exists(spark, path) else [])


def _keys(path: str, folder: str) -> list[str]:
    below = folder[len(path):] if folder.startswith(path) else ""
    return [x.partition("=")[0] for x in below.split("/") if "=" in x]


def by_stored_schema(spark: SparkSession, path: str, folders: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """``folders`` by the schema of their files. Spark merges the footers of all
    of them in one job if it can; where the types of a column clash, the two
    halves are asked, down to single files. Types change rarely over time, so
    few jobs are needed, and parts of equal schema are one scan."""
    def ask(parts: list[str]) -> list[tuple[T.StructType, list[str]]]:
        try:
            return [(spark.read.option("basePath", path).option("mergeSchema", True).parquet(*parts).schema, parts)]
        except (PySparkException, Py4JJavaError) as clash:
            if "CANNOT_MERGE" not in str(clash):
                raise
            if len(parts) == 1:
                parts = [f"{parts[0]}/{n}" for n in children(spark, parts[0], "part-")]
            if len(parts) < 2:
                raise
        return ask(parts[:len(parts) // 2]) + ask(parts[len(parts) // 2:])

    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, parts in ask(folders):
        found.setdefault(schema.json(), (schema, []))[1].extend(parts)
    return list(found.values())


def _observed(df: DataFrame, *metrics):
    from pyspark.sql import Observation

    watch = Observation()
    return df.observe(watch, *metrics), watch


# -- marks --------------------------------------------------------------------
def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly after the mark; no mark means all rows."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def batch_mark(df: DataFrame, pipeline: str, source_table: str, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("watermark")).filter("watermark is not null").select(
        F.lit(pipeline).alias("pipeline"), F.lit(source_table).alias("source_table"),
        F.lit(column).alias("watermark_column"), "watermark")


def folded_marks(entries: DataFrame) -> DataFrame:
    """One mark per pipeline from its entries: the greatest of those it advanced
    to since its last reset, none right after a reset. The order of entries
    matters only between resets and the rest; an advance that ran beside a reset
    gives way to it, so that its batch is extracted again."""
    reset = F.max(F.when(F.col("kind") == "reset", F.col("seq")))
    rows = F.collect_list(F.struct("seq", "kind", "watermark"))  # bounded by the compaction
    held = entries.groupBy("pipeline").agg(
        F.max_by("source_table", "seq").alias("source_table"), F.max_by("watermark_column", "seq").alias("watermark_column"),
        F.coalesce(reset, F.lit(-1)).alias("_reset"), rows.alias("_rows"))
    since = F.expr("transform(filter(_rows, x -> x.kind = 'advance' and x.seq > _reset), x -> x.watermark)")
    return held.select("pipeline", "source_table", "watermark_column", F.array_max(since).alias("watermark"))


class ControlTables:
    """Marks and the run log. Every advance or reset of a pipeline's mark is a
    file of its own that is never rewritten, so jobs that end together lose
    nothing; reading folds a pipeline's entries. Once ``COMPACT`` have gathered,
    a state entry sums them up, and those an earlier state covers are deleted: a
    reader that has listed them meanwhile still finds its files."""

    COMPACT = 32

    def __init__(self, lake: Lake):
        self.lake = lake
        self.spark = lake.spark

    def _folder(self, pipeline: str | None = None) -> str:
        return self.lake.path("control", "marks") + (f"/of={quote(pipeline, safe='.-_')}" if pipeline is not None else "")

    def _entries(self, pipeline: str | None = None) -> DataFrame:
        path = self._folder(pipeline)
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], ENTRY_SCHEMA)
        names = [f.split()[0] for f in ENTRY_SCHEMA.split(", ")]
        return self.spark.read.schema(ENTRY_SCHEMA).option("recursiveFileLookup", True).parquet(path).select(*names)

    def _put(self, kind: str, pipeline: str, source_table: str | None, column: str | None, watermark, state_of: int | None = None) -> None:
        names = children(self.spark, self._folder(pipeline), "entry-")
        seq = state_of if state_of is not None else max((int(n.split("-")[1]) for n in names), default=-1) + 1
        row = self.spark.createDataFrame([(pipeline, source_table, column, watermark, kind, seq)], ENTRY_SCHEMA)
        what = "state" if state_of is not None else kind
        row.coalesce(1).write.parquet(f"{self._folder(pipeline)}/entry-{seq:012d}-{what}-{uuid.uuid4().hex}")
        if state_of is None and len(names) + 1 >= self.COMPACT and not any("-state-" in n for n in names[-self.COMPACT // 2:]):
            self.compact(pipeline)

    def compact(self, pipeline: str) -> None:
        names = children(self.spark, self._folder(pipeline), "entry-")
        covered = max((int(n.split("-")[1]) for n in names if "-state-" in n), default=-1)
        old = [n for n in names if int(n.split("-")[1]) <= covered and not ("-state-" in n and int(n.split("-")[1]) == covered)]
        mark = folded_marks(self._entries(pipeline)).first()
        kind = "reset" if mark["watermark"] is None else "advance"
        self._put(kind, *mark, state_of=max(int(n.split("-")[1]) for n in names))
        for n in old:
            remove(self.spark, f"{self._folder(pipeline)}/{n}")

    def marks(self) -> DataFrame:
        return folded_marks(self._entries())

    def get_mark(self, pipeline: str):
        row = folded_marks(self._entries(pipeline)).select("watermark").first()
        return row[0] if row else None

    def advance(self, batch: DataFrame) -> None:
        """``batch`` has one row per pipeline; a batch without rows has no mark."""
        for row in batch.filter("watermark is not null").select("pipeline", "source_table", "watermark_column", "watermark").collect():
            self._put("advance", *row)

    def reset(self, pipeline: str) -> None:
        known = folded_marks(self._entries(pipeline)).first()
        if known:
            self._put("reset", pipeline, known["source_table"], known["watermark_column"], None)

    def log_run(self, **run) -> None:
        names = [f.strip().split()[0] for f in RUN_SCHEMA.split(",")]
        row = self.spark.createDataFrame([tuple(run.get(n) for n in names)], RUN_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.lake.path("control", "runs"))

    def runs(self) -> DataFrame:
        if not exists(self.spark, self.lake.path("control", "runs")):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.lake.path("control", "runs"))


def append_batch(lake: Lake, control: ControlTables, source: DataFrame, *, dataset: str, source_table: str,
                 column: str, ingest_date: str, accept=None) -> dict[str, int]:
    """Land the rows newer than the stored mark as their own batch, named by
    the mark it reaches: extracting the same batch again overwrites the same
    folder, a newer batch lands beside it, an empty one writes nothing. The
    source is read once, into a staging table that everything else reads.
    ``accept(staged, batch)`` may reject rows, or the batch by raising; the mark,
    which counts all rows read, moves only after the write."""
    pipeline = f"raw.{dataset}"
    staging = f"{lake.root}/staging/{dataset}-{uuid.uuid4().hex}"
    seen = (F.count("*").alias("n"), F.max(column).alias("high"))
    try:
        counted, watch = _observed(newer_than(source, column, control.get_mark(pipeline)), *seen)
        counted.write.parquet(staging)
        n, high = watch.get["n"], watch.get["high"]
        if high is None:
            return {"rows_read": n, "rows_written": 0, "rows_quarantined": 0}
        staged = lake.spark.read.schema(source.schema).parquet(staging)
        batch = high.strftime("%Y%m%dT%H%M%S%f")
        kept, rejected = accept(staged, batch) if accept else (staged, 0)
        target = f"{lake.path('raw', dataset)}/ingest_date={ingest_date}/batch={batch}"
        kept.write.mode("overwrite").option("compression", "zstd").parquet(target)
    finally:
        remove(lake.spark, staging)
    control.advance(control.spark.createDataFrame([(pipeline, source_table, column, high)], MARK_SCHEMA))
    return {"rows_read": n, "rows_written": n - rejected, "rows_quarantined": rejected}


# -- weather windows ----------------------------------------------------------
ARCHIVE_LAG_DAYS, FORECAST_PAST_DAYS, FORECAST_AHEAD_DAYS = 6, 7, 7


def weather_windows(logical_date: dt.date, backfill_start: dt.date) -> dict[str, tuple[dt.date, dt.date]]:
    """The days each weather source serves for a run."""
    day = dt.timedelta(days=1)
    return {
        "archive": (backfill_start, logical_date - ARCHIVE_LAG_DAYS * day),
        "forecast": (logical_date - FORECAST_PAST_DAYS * day, logical_date + FORECAST_AHEAD_DAYS * day),
    }


def in_weather_window(df: DataFrame, logical_date: dt.date, backfill_start: dt.date) -> DataFrame:
    """Rows inside their own source's window; an empty window keeps none."""
    keep = F.lit(False)
    for source, (start, end) in weather_windows(logical_date, backfill_start).items():
        keep = keep | ((F.col("source") == source) & F.col("weather_date").between(F.lit(start), F.lit(end)))
    return df.filter(keep)
