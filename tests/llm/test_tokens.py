"""Tokenizers, files and packing against the libraries themselves."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.helpers import awkward, collected, documents, prose
from tilth.llm import byte_tokens, framed_records, packing, piece_bpe, token_counts
from tilth.llm.byte_files import read_files
from tilth.llm.common import Stages, totals_before

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b'", "'s", "it's", "  ", " ", "\n", "\n\n", " \n", "\t", "x1", "12", "é", "ß", "漢字", "…", "!!", "====", "\x1c", "\xa0", "²",
         "<|endoftext|>", "<s>", "<0x41>", ".", "\r\n", "_", "▁", "\x7f", "\x85", "aaaa", "😀", "     ", "the", "tion", "ing "]
texts = st.lists(st.sampled_from(PARTS), max_size=14).map("".join)


def byte_ids(text):
    t = Tokenizer.from_file(BYTE)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def bpe():
    return byte_tokens.ByteTokens(BYTE)


@settings(max_examples=60, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_byte_ids_are_the_librarys(bpe, rows):
    ids, ends = bpe.encode(pa.array(rows, pa.string()))
    want = [e.ids for e in bpe.whole.encode_batch(rows, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == want


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.PieceBpe(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=60, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_pieces_and_their_text_are_the_librarys(pieces, rows):
    own, library = pieces
    for ids, ends in own.encode(pa.array(rows, pa.string())):
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == library.encode(rows)
        assert [x.decode() for x in own.decode(ids, ends)] == [library.decode(x) for x in library.encode(rows)]


def test_long_runs_merge_in_the_librarys_order(pieces):
    own, library = pieces
    rows = [" " * n for n in range(40)] + ["=" * n for n in range(60)] + ["a" * 3000, " " * 1500, "漢字仮名交じり文" * 200, "the" * 500]
    (ids, ends), = own.encode(pa.array(rows))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == library.encode(rows)


def test_texts_encoded_whole_are_few_at_a_time(bpe, monkeypatch):
    class Counting:
        def encode_batch_fast(self, rows, add_special_tokens):
            assert sum(len(r.encode()) for r in rows) <= byte_tokens.WHOLE_BYTES or len(rows) == 1
            return bpe.whole.encode_batch_fast(rows, add_special_tokens=add_special_tokens)

    rows = ["plain", "漢字" * 30, "仮名 交じり文 " * 40, "漢" * 150_000, "also plain", None, "字"]
    want = [byte_ids(r) for r in rows] * 900
    own = byte_tokens.ByteTokens(BYTE)
    own.whole = Counting()
    ids, ends = own.encode(pa.array(rows[:3] + rows[4:] + rows[3:4], pa.string()))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == want[:3] + want[4:7] + want[3:4]
    ids, ends = own.encode(pa.array(rows[1:3] * 900, pa.string()))
    assert [len(x) for x in np.split(ids, ends[:-1])] == [len(x) for x in want[1:3] * 900]


def test_token_files_are_bounded_however_large_a_partition_is(spark):
    docs = documents(spark, [(i if i % 7 else None, prose(i, 10 + i % 40), "en", "s") for i in range(200)] + [(500, None, "en", "s"), (501, prose(9, 3000), "en", "s")])
    docs, stages = docs.coalesce(1), Stages(spark, "flat-test")
    paths = stages.path("small"), stages.path("whole")
    for path, size in zip(paths, (2000, token_counts.FILE_BYTES)):
        token_counts.write_flat(docs, path, BYTE, size)
    small, whole = (read_files(spark, path, "tokens").orderBy("part").collect() for path in paths)
    assert len(whole) == 1 and len(small) >= 10 and sum(len(r.content) > 2000 for r in small) == 1
    assert b"".join(bytes(r.content) for r in small) == bytes(whole[0].content)
    found = [token_counts.scan_flat(read_files(spark, path, "tokens"), token_counts.END_ID, stages) for path in paths]
    assert collected(found[0], "ordinal", "start", "n_tokens") == collected(found[1], "ordinal", "start", "n_tokens")
    assert found[0].count() == 202


def test_piece_query_on_awkward_rows(spark, pieces):
    _, library = pieces
    docs = awkward(spark)
    want = []
    for d, t in docs.select("doc_id", "text").collect():
        ids = library.encode(t or "")
        want.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = piece_bpe.round_trip_digests(docs, PIECE)
    assert collected(got, *got.columns) == sorted(want, key=repr)
    again = piece_bpe.decoded(piece_bpe.encoded(docs, PIECE), PIECE)
    assert collected(again, "doc_id", "text") == sorted(((d, t or "") for d, t in docs.select("doc_id", "text").collect()), key=repr)
    assert piece_bpe.round_trip_digests(docs.limit(0), PIECE).count() == 0


def test_records_come_back_in_order(spark):
    docs = awkward(spark)
    rows = sorted(((d, t) for d, t in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for d, t in rows:
        ids = byte_ids(t) + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = framed_records.token_records(spark, docs, BYTE, end_id=2)
    assert collected(got, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    assert framed_records.token_records(spark, docs.limit(0), BYTE).count() == 0


def test_index_points_at_records_and_damage_shows(spark):
    path = Stages(spark, "records-test").path("files")
    framed_records.write_records(documents(spark, [(i, prose(i, 40), "en", "s") for i in range(30)]), path, BYTE, 2)
    files = {r.part: bytes(r.content) for r in read_files(spark, path, "records").collect()}
    index = framed_records.read_index(spark, path).collect()
    random.Random(4).shuffle(index)
    for r in index:
        payload = framed_records.payload_at(memoryview(files[r.part]), r.offset)
        assert np.frombuffer(payload, "<u2").tolist() == byte_ids(prose(r.doc_id, 40)) + [2]
    data = bytearray(framed_records.frame(b"payload") + b"\n")
    assert framed_records.payload_at(memoryview(data), 0) == b"payload"
    for i in range(len(data) - 1):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            framed_records.payload_at(memoryview(broken), 0)


def test_token_counts_on_awkward_rows(spark):
    docs = awkward(spark)
    got = token_counts.token_counts(spark, docs, BYTE).collect()
    want = sorted(((d, len(byte_ids(t)) + 1) for d, t in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == want
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == np.cumsum([0] + [n for _, n in starts])[:-1].tolist()
    assert token_counts.token_counts(spark, docs.limit(0), BYTE).count() == 0


def test_documents_run_on_across_blocks_and_files(spark):
    rnd = random.Random(3)
    stream = [9 if rnd.random() < 0.02 else rnd.randint(10, 99) for _ in range(4000)] + [9, 50]
    cuts = [0, 1, 700, 700, 1900, 1901, 4002]
    files = [(k, np.array(stream[a:b], ">u2").tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    df = spark.createDataFrame([(k, bytearray(c)) for k, c in files], "part long, content binary")
    got = token_counts.scan_flat(df, 9, Stages(spark, "scan-test"), size=64)
    ends = [i for i, x in enumerate(stream) if x == 9]
    starts = [0] + [e + 1 for e in ends[:-1]]
    want = [(k, s, e + 1 - s) for k, (s, e) in enumerate(zip(starts, ends))]
    assert sorted((r.ordinal, r.start, r.n_tokens) for r in got.collect()) == want


def test_totals_before_in_chunks_of_chunks(spark):
    df = spark.createDataFrame([(p, k, p + k) for p in range(9) for k in range(3)], "part long, k long, v long")
    got = {(r.part, r.k): r.before_v for r in totals_before(df, "part", ["k"], ["v"], parts=2).collect()}
    run = 0
    for p in range(9):
        for k in range(3):
            assert got[p, k] == run
            run += p + k


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_best_fit_is_the_plain_one(lengths):
    lengths = sorted(lengths, reverse=True)
    window, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    rooms: list[int] = []
    for n, w, o in zip(lengths, window.tolist(), offset.tolist()):
        fits = [r for r in rooms if r >= n]
        if fits:
            assert rooms[w] == min(fits)
        else:
            assert w == len(rooms)
            rooms.append(64)
        assert o == 64 - rooms[w]
        rooms[w] -= n


def test_packing_on_awkward_rows(spark):
    docs = awkward(spark)
    got = packing.pack_documents(docs, Stages(spark, "packing-test"), BYTE, 0, 256, with_ids=True)
    rows = got.collect()
    by_window: dict = {}
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length <= 256
        by_window.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces_ in by_window.values():
        at = 0
        for offset, length in sorted(pieces_):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert total == sum(len(byte_ids(t)) + 1 for (t,) in docs.select("text").collect())
    assert len(by_window) <= total // 256 + 2
    whole = packing.sequences(got).collect()
    assert sum(len(r.ids) for r in whole) == total
    assert packing.pack_documents(docs.limit(0), Stages(spark, "packing-test"), BYTE).count() == 0


def test_packing_keeps_large_ids_beside_null_ones_and_splits_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    large = (1 << 60) + 1
    docs = documents(spark, [(large, "one", "en", "s"), (None, "two", "en", "s")] + [(7, "same words here", "en", "s")] * 100 + [(None, f"text {i}", "en", "s") for i in range(98)])
    rows = packing.pack_documents(docs, Stages(spark, "packing-test"), BYTE, 0, 64).collect()
    assert len(rows) == 200 and sum(r.doc_id == large for r in rows) == 1 and sum(r.doc_id is None for r in rows) == 99
    shards: dict = {}
    for r in rows:
        shards[r.sequence_id >> 32] = shards.get(r.sequence_id >> 32, 0) + 1
    assert len(shards) == 5 and max(shards.values()) < 80
