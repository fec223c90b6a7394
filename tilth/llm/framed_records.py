"""Token ids as length-delimited binary records with checksums and an index.

A record is ``length`` (uint64), masked checksum of those 8 bytes (uint32), the
payload, masked checksum of the payload (uint32), and a line feed; all numbers
are little-endian, the payload is the ids as unsigned 16-bit integers. The
checksum is CRC-32 rotated right by 15 bits plus a constant, so that a checksum
stored inside a payload does not check itself. An index beside the data has
doc_id, offset and payload length of each record; records can be read from it
in any order, or a file through by its lengths alone.

Cases: null texts are empty, an empty text has the end id alone; documents are
ordered by doc_id (null first), rows that repeat a doc_id by text; a damaged
length or payload raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.llm.byte_files import ROWS, read_files, read_lines, write_files
from tilth.llm.byte_tokens import byte_tokens
from tilth.llm.common import Stages, partitions_for, totals_before

MASK, LAST_BYTE = 0xA282EAD8, "\n"
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")


def masked(data) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """A record without its final line feed."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, TAIL.pack(masked(length)), payload, TAIL.pack(masked(payload))))


def framed_size(payload_size):
    return HEAD.size + payload_size + TAIL.size + 1


def payload_at(data: memoryview, offset: int) -> memoryview:
    size, check = HEAD.unpack_from(data, offset)
    begin = offset + HEAD.size
    if masked(data[offset:offset + 8]) != check or begin + size + TAIL.size >= len(data):
        raise ValueError(f"damaged record length at {offset}")
    payload = data[begin:begin + size]
    if TAIL.unpack_from(data, begin + size)[0] != masked(payload):
        raise ValueError(f"damaged record at {offset}")
    return payload


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Records of ``docs`` (doc_id, text) in ascending doc_id order over the
    files by number, and their index."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seq, offset = byte_tokens(tokenizer), 0, 0
        for batch in batches:
            names, frames = [], []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode_documents(batch.column(1), end_id)):
                payload = ids.tobytes()
                names.append(f"{'' if doc_id is None else doc_id}\t{offset}\t{len(payload)}".encode())
                frames.append(frame(payload))
                offset += framed_size(len(payload))
            order = np.arange(seq, seq + len(names))
            seq += len(names)
            for kind, values in (("index", names), ("records", frames)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * len(names), pa.string()), pa.array(order), pa.array(values, pa.binary())], ["kind", "seq", "value"])

    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange(partitions_for(rows), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text")
    write_files(ordered.mapInArrow(encode, ROWS), path, LAST_BYTE)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(part, doc_id, offset, size) of every record."""
    return read_lines(spark, path, "index", LAST_BYTE, ["doc_id", "offset", "size"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(part, offset, payload) of every record, all checksums verified."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, offset, payload in _records(batches):
            yield pa.RecordBatch.from_pydict({"part": [part] * len(offset), "offset": offset, "payload": payload})

    return read_files(spark, path, "records").mapInArrow(walk, "part long, offset long, payload binary")


def _records(batches: Iterator[pa.RecordBatch], size: int = 4096):
    for batch in batches:
        for part, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            data, at = memoryview(content.as_buffer()), 0
            while at < len(data):
                offsets, payloads = [], []
                while at < len(data) and len(offsets) < size:
                    payload = payload_at(data, at)
                    offsets.append(at)
                    payloads.append(payload)
                    at += framed_size(len(payload))
                yield part, offsets, payloads


def record_digests(spark: SparkSession, path: str) -> DataFrame:
    """(part, offset, n_tokens, ids_crc32), the checksum over 32-bit ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, offset, payloads in _records(batches):
            yield pa.RecordBatch.from_pydict({
                "part": [part] * len(offset), "offset": offset, "n_tokens": [len(p) // 2 for p in payloads],
                "ids_crc32": [zlib.crc32(np.frombuffer(p, "<u2").astype("<u4")) for p in payloads]})

    return read_files(spark, path, "records").mapInArrow(digest, "part long, offset long, n_tokens long, ids_crc32 long")


def token_records(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, offset), read back from files."""
    stages = Stages(spark, "records")
    path = stages.path("files")
    write_records(docs, path, tokenizer, end_id)
    found = stages.keep(record_digests(spark, path), "digests")
    placed = totals_before(found, "part", ["offset"], ["n_tokens"])
    return placed.join(read_index(spark, path), ["part", "offset"]).select(
        "doc_id", F.col("before_n_tokens").alias("start"), "n_tokens", "ids_crc32", "part", "offset")
