"""SimHash near-duplicates of documents through an index of byte positions.

Two 64-bit fingerprints that differ in two bits or fewer agree in at least six
of their eight positional bytes. The index lists fingerprints under every two
of four byte pairs (four positional bytes at once): whichever two positions
differ, one of the six sets is untouched, so every such pair meets in a list.
Pairs that meet have their shared positional bytes tallied, those with six or
more are kept, and the differing bits are counted exactly. A list that has
grown long is linked without its pairs: two members differ in two bits or
fewer exactly when they share one of the fingerprints one bit away, so each
member joins the smallest member under each of those.

The pipeline keeps one document of each group.

Cases: no words, or a null text, give fingerprint zero, which links like any
other; equal fingerprints are one node whatever their number; rows that repeat
a doc_id are rows of their own; a null doc_id is never the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import Stages, components

SEED, BITS, SHARED, LONG_LIST = 42, 2, 6, 32
_PAIRS = [0xFFFF << 16 * i for i in range(4)]
#: Two byte pairs of four: four positional bytes that two differing ones miss.
MASKS = [a | b for i, a in enumerate(_PAIRS) for b in _PAIRS[i + 1:]]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, size: int = 3) -> int:
    """The majority of the bits of a text's word shingles, as a signed integer."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64)
    ones, step = np.zeros(64, np.int64), 1 << 15
    for at in range(0, len(hashes), step):
        octets = hashes[at:at + step].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return _signed(int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big"))


def with_fingerprints(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """(doc_id, row, fp) of ``docs`` (doc_id, text); ``row`` is zero unless given."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = pa.array([fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "row", "fp"])

    told = (F.lit(0) if row is None else row).cast("long").alias("row")
    return docs.select("doc_id", told, "text").mapInArrow(read, "doc_id long, row long, fp long")


def _shared_bytes(difference):
    """How many of the eight positional bytes of two fingerprints agree."""
    same = [(difference.bitwiseAND(F.lit(_signed(0xFF << 8 * i))) == 0).cast("int") for i in range(8)]
    return sum(same[1:], same[0])


def near_links(fps: DataFrame, stages: Stages) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints of ``fps`` (fp) at
    ``BITS`` differing bits or fewer into their groups; none beyond."""
    sets = F.array(*[F.struct(F.lit(i).alias("bytes"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(MASKS)])
    postings = fps.select("fp", F.explode(sets).alias("s")).select("fp", "s.bytes", "s.key")
    lengths = postings.groupBy("bytes", "key").agg(F.count("*").alias("length")).filter("length > 1")
    lists = stages.keep(postings.join(lengths, ["bytes", "key"]), "lists")
    short = lists.filter(F.col("length") <= LONG_LIST)
    other = short.select("bytes", "key", F.col("fp").alias("b"))
    differs = F.col("fp").bitwiseXOR(F.col("b"))
    pairs = (short.join(other, ["bytes", "key"])
             .filter((F.col("fp") < F.col("b")) & (_shared_bytes(differs) >= SHARED) & (F.bit_count(differs) <= BITS))
             .select(F.col("fp").alias("a"), "b"))
    flips = F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64)])
    hubs = (lists.filter(F.col("length") > LONG_LIST).select("bytes", "key", "fp", F.explode(flips).alias("flip"))
            .select("bytes", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("hub")))
    first = hubs.groupBy("bytes", "key", "hub").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    starred = hubs.join(first, ["bytes", "key", "hub"]).filter("a <> fp").select("a", F.col("fp").alias("b"))
    return pairs.union(starred).distinct()


def simhash_groups(docs: DataFrame, stages: Stages, row: Column | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``. With ``row``, an
    expression that tells rows of one doc_id apart, also ``row`` and ``group``,
    the smallest fingerprint reachable."""
    rows = stages.keep(with_fingerprints(docs, row), "fingerprints")
    classes = stages.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    groups = components(near_links(classes.select("fp"), stages), stages)
    named = classes.join(groups, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    to_first = stages.keep(named.join(least, "component").select("fp", "component_id", F.col("component").alias("group")), "groups")
    return rows.join(to_first, "fp").select("doc_id", "fp", "component_id", *([] if row is None else ["row", "group"]))


def hexed(fp):
    """16 lowercase hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each_group(docs: DataFrame, stages: Stages) -> DataFrame:
    """``docs`` with one row of every group of fingerprints: the one with the
    smallest doc_id, null ones last, then the least hash of its text. Rows are
    decided each on its own, so one that repeats a doc_id with another text is
    in another group; of rows that agree in doc_id and text one stays."""
    named = docs.select("doc_id", "text")
    groups = stages.keep(simhash_groups(named, stages, F.xxhash64("text")), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("f")
    chosen = groups.groupBy("group").agg(first).select(F.col("f.doc_id").alias("__id"), F.col("f.row").alias("__row"))
    copies = groups.groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.count("*").alias("__n"))
    same = chosen["__id"].eqNullSafe(copies["__id"]) & (chosen["__row"] == copies["__row"])
    chosen = stages.keep(chosen.join(copies, same).select(chosen["__id"], chosen["__row"], "__n"), "chosen")
    keyed = docs.withColumn("__text", F.xxhash64("text"))
    at = keyed["doc_id"].eqNullSafe(chosen["__id"]) & (keyed["__text"] == chosen["__row"])
    single = keyed.join(chosen.filter("__n = 1"), at, "left_semi").select(*_columns(docs))
    # Only of rows that are there several times are whole rows gathered, one of a task each.
    several = keyed.join(chosen.filter("__n > 1"), at).groupBy("__id", "__row").agg(F.first(F.struct(*_columns(docs))).alias("__all"))
    return single.union(several.select(*[F.col(f"__all.`{c}`") for c in docs.columns]))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]
