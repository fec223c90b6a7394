"""What the operators share: staged tables, connected components, ordered totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilth.session import scratch_dir
from tilth.sources.lake import remove


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Stages:
    """Tables that cut a job into parts, written below the shared scratch
    folder: a lost executor costs its own tasks only, and later parts read
    finished files."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_dir(spark, label)
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.staged_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for t in tables:
            remove(self.spark, t.staged_at)


def partitions_for(df: DataFrame) -> int:
    """As many partitions as the input has splits, and no fewer than the
    session's shuffles have: both grow with the data."""
    return max(df.rdd.getNumPartitions(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame, stages: Stages, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Each round hooks every node to its smallest neighbour, follows that parent
    twice and contracts the edges; the nodes left are local minima, so a few
    rounds empty the graph. Only aggregates by node and joins on node run; no
    group is gathered. A self-loop makes its node a component of one.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    known = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    live = stages.keep(known.select(low.alias("a"), high.alias("b")).distinct(), "edges")
    nodes = stages.keep(live.select(F.col("a").alias("node")).union(live.select("b")).distinct(), "nodes")
    hops: list[DataFrame] = []
    live_edges = live.filter("a <> b")
    old = [live]
    while not live_edges.isEmpty():
        both = live_edges.union(live_edges.select("b", "a"))
        up = stages.keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("up")), "up")
        for _ in range(2):
            over = up.select(F.col("node").alias("mid"), F.col("up").alias("top"))
            jumped = stages.keep(up.join(over, up["up"] == over["mid"], "left")
                                 .select("node", F.coalesce("top", "up").alias("up")), "jump")
            stages.drop(up)
            up = jumped
        pa = up.select(F.col("node").alias("a"), F.col("up").alias("pa"))
        pb = up.select(F.col("node").alias("b"), F.col("up").alias("pb"))
        nxt = stages.keep(live_edges.join(pa, "a").join(pb, "b").filter("pa <> pb")
                          .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        hops.append(up.filter("node <> up"))
        stages.drop(*old)
        old, live_edges = [nxt], nxt
    at = nodes.withColumn("component", F.col("node"))
    for up in hops:
        step = up.select(F.col("node").alias("component"), F.col("up").alias("_top"))
        at = at.join(step, "component", "left").select("node", F.coalesce("_top", "component").alias("component"))
    return at


def totals_before(df: DataFrame, part: str, within: list, values: list[str], parts: int = 1024) -> DataFrame:
    """Adds ``before_<v>``: the sum of each value over all rows that come
    earlier in the order (part, within). ``part`` numbers chunks of the order
    from 0; a chunk is summed on its own, chunks of ``parts`` chunks next, and
    only the sums of those meet in one window, one row per ``parts`` chunks.
    """
    inner = Window.partitionBy(part).orderBy(*within).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.select("*", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_in_{v}") for v in values])
    sums = df.groupBy(part).agg(*[F.sum(v).alias(v) for v in values]).withColumn("_hi", F.floor(F.col(part) / parts))
    mid = Window.partitionBy("_hi").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    mids = sums.select(part, "_hi", *[F.coalesce(F.sum(v).over(mid), F.lit(0)).alias(f"_mid_{v}") for v in values])
    top = Window.orderBy("_hi").rowsBetween(Window.unboundedPreceding, -1)
    tops = (sums.groupBy("_hi").agg(*[F.sum(v).alias(v) for v in values])
            .select("_hi", *[F.coalesce(F.sum(v).over(top), F.lit(0)).alias(f"_top_{v}") for v in values]))
    starts = mids.join(tops, "_hi").select(part, *[(F.col(f"_mid_{v}") + F.col(f"_top_{v}")).alias(f"_off_{v}") for v in values])
    return rows.join(starts, part).select(
        *df.columns, *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"before_{v}") for v in values])
