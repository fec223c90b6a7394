"""Token counts of documents in flat token files that carry no index.

A file is a run of unsigned 16-bit big-endian ids; documents end with an
end-of-document id and may run on from file to file. Every block is searched
for the id with one array comparison; what a block cannot know (where its
first document began) comes from a prefix scan over block summaries.

Cases: a null or empty text is a document of the end id alone; the special
token's own spelling inside a text is ordinary text, so the end id is never
ambiguous; repeated rows are documents of their own; no rows give no
documents; tokens after the last end id form no document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilth.llm.byte_files import FILE_ROWS, read_files, read_lines, write_files
from tilth.llm.byte_tokens import byte_tokens, text_slices
from tilth.llm.common import Stages, totals_before

#: <|endoftext|>; its low byte ends every document of a big-endian file.
END_ID = 50256
LAST_BYTE = chr(END_ID & 0xFF)
#: Bytes of a file, if no single document has more: files are read whole.
FILE_BYTES = 16 << 20
#: Ids searched at once.
BLOCK = 1 << 20


def write_flat(docs: DataFrame, path: str, tokenizer: str, file_bytes: int = FILE_BYTES) -> None:
    """Flat token files of ``docs`` (doc_id, text), of bounded size however large an
    input partition is, without a shuffle; beside them the ids of the documents in file order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, file, seq, size = byte_tokens(tokenizer), 0, 0, 0
        for batch in batches:
            for at, part, _, _ in text_slices(batch.column(1)):
                ids, n = batch.column(0).slice(at, len(part)).to_pylist(), len(part)
                data = [x.astype(">u2").tobytes()[:-1] for x in tokens.encode_documents(batch.column(1).slice(at, n), END_ID)]
                places = []
                for x in data:
                    if size and size + len(x) >= file_bytes:
                        file, seq, size = file + 1, 0, 0
                    places.append((file, seq))
                    seq, size = seq + 1, size + len(x) + 1
                files, order = zip(*places)
                names = [f"{k}\t{'' if d is None else d}".encode() for k, d in zip(order, ids)]
                for kind, values in (("order", names), ("tokens", data)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * n, pa.string()), pa.array(files, pa.int64()), pa.array(order, pa.int64()), pa.array(values, pa.binary())],
                        ["kind", "file", "seq", "value"])

    write_files(docs.select("doc_id", "text").mapInArrow(encode, FILE_ROWS), path, LAST_BYTE)


def scan_flat(files: DataFrame, end_id: int, stages: Stages, size: int = BLOCK) -> DataFrame:
    """(part, ordinal, start, n_tokens) of every document in ``files`` (part,
    content), taken as one stream in the order of part; ordinal and start
    count documents and tokens of the whole stream."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, content in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(content.as_buffer(), ">u2")
                for block, at in enumerate(range(0, max(len(ids), 1), size)):
                    run = ids[at:at + size]
                    ends = np.flatnonzero(run == end_id)
                    yield pa.RecordBatch.from_pydict({
                        "part": [part.as_py()], "block": [block], "tokens": [len(run)], "ends": [len(ends)],
                        "first_end": pa.array([int(ends[0]) if len(ends) else None], pa.int64()),
                        "last_end": pa.array([int(ends[-1]) if len(ends) else None], pa.int64()),
                        "gaps": pa.array([np.diff(ends).astype(np.int32)], pa.list_(pa.int32()))})

    found = stages.keep(files.mapInArrow(
        search, "part long, block long, tokens long, ends long, first_end long, last_end long, gaps array<int>"), "blocks")
    blocks = found.drop("gaps")
    # Sums before a block give its place; the greatest end before it, its open document.
    placed = totals_before(blocks, "part", ["block"], ["tokens", "ends"])
    placed = stages.keep(placed.withColumn("stop", F.col("before_tokens") + F.col("last_end") + 1), "places")
    by_file = placed.groupBy("part").agg(F.max("stop").alias("stop")).withColumn("_hi", F.floor(F.col("part") / 1024))
    earlier = Window.unboundedPreceding, -1
    mid = by_file.select("part", "_hi", F.max("stop").over(Window.partitionBy("_hi").orderBy("part").rowsBetween(*earlier)).alias("_mid"))
    top = by_file.groupBy("_hi").agg(F.max("stop").alias("stop")).select(
        "_hi", F.max("stop").over(Window.orderBy("_hi").rowsBetween(*earlier)).alias("_top"))
    carried = mid.join(top, "_hi").select("part", F.greatest("_mid", "_top").alias("carried"))
    inner = F.max("stop").over(Window.partitionBy("part").orderBy("block").rowsBetween(*earlier))
    opened = placed.withColumn("_in", inner).join(carried, "part").withColumn(
        "open", F.coalesce(F.greatest("_in", "carried"), F.lit(0)))
    first = opened.filter("ends > 0").select(
        "part", "block", F.col("before_ends").alias("ordinal"), F.col("open").alias("start"),
        (F.col("before_tokens") + F.col("first_end") + 1 - F.col("open")).alias("n_tokens"))
    spot = opened.select("part", "block", "before_ends", (F.col("before_tokens") + F.col("first_end") + 1).alias("_at"))
    inside = (found.select("part", "block", "gaps").filter("size(gaps) > 0").mapInArrow(
        _expand, "part long, block long, i long, offset long, n_tokens long").join(spot, ["part", "block"])
        .select("part", "block", (F.col("before_ends") + F.col("i")).alias("ordinal"), (F.col("_at") + F.col("offset")).alias("start"), "n_tokens"))
    return first.unionByName(inside).drop("block")


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, block, gaps in zip(batch.column(0), batch.column(1), batch.column(2)):
            n = gaps.values.to_numpy(zero_copy_only=False).astype(np.int64)
            size = len(n)
            yield pa.RecordBatch.from_pydict({
                "part": np.full(size, part.as_py()), "block": np.full(size, block.as_py()),
                "i": np.arange(1, size + 1), "offset": np.cumsum(n) - n, "n_tokens": n})


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, n_tokens): documents are written as flat files and
    counted from them alone; start counts the tokens of the stream before."""
    stages = Stages(spark, "token-counts")
    path = stages.path("flat")
    write_flat(docs, path, tokenizer)
    counted = scan_flat(read_files(spark, path, "tokens"), END_ID, stages)
    order = read_lines(spark, path, "order", LAST_BYTE, ["seq", "doc_id"])
    # Both sides number the documents of a file from 0.
    first = counted.groupBy("part").agg(F.min("ordinal").alias("_first"))
    numbered = counted.join(first, "part").withColumn("seq", F.col("ordinal") - F.col("_first"))
    return numbered.join(order, ["part", "seq"]).select("doc_id", "start", "n_tokens")
