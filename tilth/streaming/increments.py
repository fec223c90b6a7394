"""Structured Streaming over landing folders.

Both jobs run with ``availableNow``: they take whatever has landed since the
last run and stop. The checkpoint remembers which files were taken.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tilth.plans.views import finish_soil_weeks, merge_soil_week_states, soil_week_states
from tilth.sources.lake import children, remove, write_once


def stream_to_raw(spark: SparkSession, landing: str, schema, target: str, checkpoint: str) -> None:
    """Append landed files to a raw dataset, each exactly once."""
    query = (
        spark.readStream.schema(schema).parquet(landing)
        .writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


class WeekStates:
    """Weekly soil states of a stream, in a bounded number of folders.

    Every micro-batch owns the folder ``batches/batch_id=<n>``: a batch replayed
    after a failure rewrites its own states. Once ``every`` closed batches have
    gathered, they and the current generation are folded into the next one, a
    folder of its own, and a manifest, written aside and renamed into its place,
    makes that generation and the batches after it what readers see. A fold that
    dies before that changes nothing; what it or an earlier switch left behind is
    swept by the next. A closed batch is one before the running batch, as Spark
    starts a batch after the one before is committed, so no batch is replayed
    once it is folded.
    """

    def __init__(self, spark: SparkSession, root: str, every: int = 16):
        self.spark, self.root, self.every = spark, root, every

    def current(self) -> tuple[str | None, int]:
        """The generation's folder and the last batch folded into it."""
        names = children(self.spark, f"{self.root}/manifest", "v")
        if not names:
            return None, -1
        upto, folder = self.spark.read.text(f"{self.root}/manifest/{names[-1]}").first()[0].split(" ")
        return folder, int(upto)

    def batches(self, after: int = -1, before: int | None = None) -> list[str]:
        ids = sorted(int(n.partition("=")[2]) for n in children(self.spark, f"{self.root}/batches", "batch_id="))
        return [f"batch_id={i}" for i in ids if i > after and (before is None or i < before)]

    def write(self, days: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of soil days."""
        _, upto = self.current()
        if len(self.batches(upto, batch_id)) >= self.every:
            self.fold(batch_id)
        if batch_id > upto:
            soil_week_states(days).write.mode("overwrite").parquet(f"{self.root}/batches/batch_id={batch_id}")

    def fold(self, before: int) -> None:
        """Fold the batches before ``before`` into the next generation."""
        folder, upto = self.current()
        closed = self.batches(upto, before)
        if not closed:
            return
        new, last = f"generations/{uuid.uuid4().hex}", closed[-1].partition("=")[2]
        merge_soil_week_states(self._read(folder, closed)).write.parquet(f"{self.root}/{new}")
        self.switch(f"{last} {new}", int(last))
        self.sweep()

    def switch(self, text: str, version: int) -> None:
        write_once(self.spark, f"{self.root}/manifest/v{version:012d}", text)

    def sweep(self) -> None:
        """Delete what no reader of the manifest needs."""
        folder, upto = self.current()
        gone = [f"generations/{n}" for n in children(self.spark, f"{self.root}/generations") if f"generations/{n}" != folder]
        gone += [f"batches/{n}" for n in self.batches() if int(n.partition("=")[2]) <= upto]
        gone += [f"manifest/{n}" for n in children(self.spark, f"{self.root}/manifest", "v")[:-1]]
        for name in gone:
            remove(self.spark, f"{self.root}/{name}")

    def _read(self, folder: str | None, batches: list[str]) -> DataFrame:
        paths = ([f"{self.root}/{folder}"] if folder else []) + [f"{self.root}/batches/{b}" for b in batches]
        return self.spark.read.parquet(*paths)

    def read(self) -> DataFrame:
        folder, upto = self.current()
        return self._read(folder, self.batches(upto))

    def weeks(self) -> DataFrame:
        """The weekly rollup: all states combined and finished."""
        return finish_soil_weeks(merge_soil_week_states(self.read()))


def stream_weekly_states(spark: SparkSession, landing: str, schema, states: str, checkpoint: str,
                         files_per_batch: int = 100, every: int = 16) -> None:
    """Fold landed soil days into weekly states, a few files at a time."""
    held = WeekStates(spark, states, every)
    query = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
        .writeStream.foreachBatch(held.write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def weekly_from_states(spark: SparkSession, states: str) -> DataFrame:
    return WeekStates(spark, states).weeks()
