"""Packing of tokenized documents into windows of a fixed size.

A document longer than a window is first cut into full windows; its rest is a
piece. Pieces go, longest first, into the open window with the least room that
still takes them (best-fit decreasing). A segment tree over remaining
capacities finds that window in logarithmic time. Pieces are dealt by a hash
into shards of a bounded size, each packed on its own: a shard wastes at most
about its last windows, whatever the corpus size.

Cases: a null or empty text is one piece of the end id alone; repeated rows are
packed as documents of their own; no rows give no windows; ties in length go
by doc_id and start, null doc_ids last, which stay null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.byte_tokens import byte_tokens
from tilth.llm.common import Stages

#: Pieces of a shard, about. Larger shards waste less and take more memory.
SHARD = 100_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def encode_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text): full windows and a rest each,
    with their checksum over 32-bit ids and, if asked for, the ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_tokens(tokenizer)
        for batch in batches:
            out: dict[str, list] = {n.split()[0]: [] for n in PIECES.split(", ")}
            if with_ids:
                out["ids"] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode_documents(batch.column(1), end_id)):
                ids = ids.astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    row = (doc_id, start, len(piece), zlib.crc32(piece), len(ids), *([piece] if with_ids else []))
                    for column, value in zip(out.values(), row):
                        column.append(value)
            types = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of pieces whose lengths come in descending order."""
    leaves = 1 << capacity.bit_length()  # one for every remaining capacity 0..capacity
    tree = [False] * (2 * leaves)  # a node is true when an open window lies below
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # windows by what they still take
    window, offset, opened = [0] * len(lengths), [0] * len(lengths), 0
    for i, need in enumerate(lengths.tolist()):
        node = leaves + need
        if not tree[node]:  # climb until a right sibling has a window, then go down left first
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node > 1:
                node += 1
                while node < leaves:
                    node = 2 * node if tree[2 * node] else 2 * node + 1
        if node > 1:
            left = node - leaves
            chosen = room[left].pop()
            if not room[left]:
                while node and tree[node]:
                    tree[node] = node < leaves and (tree[2 * node] or tree[2 * node + 1])
                    if tree[node]:
                        break
                    node >>= 1
        else:
            left, chosen = capacity, opened
            opened += 1
        window[i], offset[i] = chosen, capacity - left
        left -= need
        if left:
            room[left].append(chosen)
            node = leaves + left
            while node and not tree[node]:
                tree[node] = True
                node >>= 1
    return np.array(window, np.int64), np.array(offset, np.int64)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to ``pieces``, a staged table with doc_id,
    start and length (1 to ``capacity``)."""
    shards = max(1, -(-pieces.count() // SHARD))
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}

    def place(key: tuple, shard: pa.Table) -> pa.Table:
        order = pc.sort_indices(shard, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        shard = shard.take(order).drop_columns("shard")
        window, offset = best_fit_decreasing(shard["length"].to_numpy(), capacity)
        return shard.append_column("sequence_id", pa.array((key[0].as_py() << 32) + window)).append_column("offset", pa.array(offset))

    # By row: pieces of one id, or of none, may be any share of the table.
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    out = ", ".join(f"`{n}` {t}" for n, t in kinds.items()) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInArrow(place, out)


def pack_documents(docs: DataFrame, stages: Stages, tokenizer: str, end_id: int = 0, capacity: int = 1024,
                   with_ids: bool = False) -> DataFrame:
    """Every piece of ``docs`` with the window and place it got."""
    return pack(stages.keep(encode_pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the windows themselves, from pieces with ids."""
    run = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(run, lambda p: p["ids"])).alias("ids"))
