"""SentencePiece BPE, encoded by rounds of array merges, and decoded.

Text is cut where no piece of the model ever spans two neighbouring
characters, so the parts (mostly words) are encoded apart, each distinct one
once per worker. The symbols of all new words lie in one flat array. A round
takes every word's best pair (a segmented minimum of pair ranks), merges its
occurrences from the left in all words at once and compacts; words without a
pair left drop out. A word where a merge brought forth a pair at least as good
while others of its round were pending is done again, one merge a round, which
is the library's own order.

Cases: null and empty texts have no ids; characters unknown to the model become
their UTF-8 bytes; the model's normalizer must be the identity with a leading
space added, anything else raises ``ValueError``; texts of any length are
encoded whole; repeated rows give equal rows.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tilth.llm.byte_tokens import lookup, text_slices

_FAR = np.int64(1 << 40)  # the rank of no pair
_SHIFT = 21  # symbols are below 2 ** 21: piece ids, then code points of other characters
SPACE = "▁"

codecs.register_error("each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceBpe:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(self.size)]
        probe = " a  b ﬁ\n"
        if self.size > 1 << 16 or model.decode(model.encode(probe)) != probe or model.encode("a", out_type=str)[0][0] != SPACE:
            raise ValueError("this model normalizes text or has too many pieces")
        normal = {p: i for i, p in enumerate(pieces) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        if not all(map(model.is_byte, self.byte_ids.tolist())):
            raise ValueError("this model has no byte pieces")
        scores = np.array([model.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.symbol = np.arange(0x110000, dtype=np.int64) + self.size
        for p, i in normal.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.symbol[ord(" ")] = self.symbol[ord(SPACE)]
        self._pairs(normal)
        self.cut = self._cuts(normal)
        text = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else p.replace(SPACE, " ").encode()
                for i, p in enumerate(pieces)]
        for b, i in enumerate(self.byte_ids.tolist()):
            text[i] = bytes([b])
        self.text = pa.array(text, pa.large_binary())
        self.is_byte = np.isin(np.arange(self.size), self.byte_ids)
        self.decimal = pa.array([b"%d," % i for i in range(self.size)], pa.large_binary())
        self.memory: dict = {}

    def _pairs(self, normal: dict[str, int]) -> None:
        """All ways two symbols make a piece, sorted by the two."""
        def of(s):
            return normal.get(s, int(self.symbol[ord(s)]) if len(s) == 1 else None)

        found = [(of(p[:k]) << _SHIFT | of(p[k:]), i) for p, i in normal.items() for k in range(1, len(p))
                 if of(p[:k]) is not None and of(p[k:]) is not None]
        found.sort()
        self.pair_key = np.array([k for k, _ in found], np.int64)
        self.pair_to = np.array([i for _, i in found], np.int64)

    def _cuts(self, normal: dict[str, int]) -> np.ndarray:
        """By two neighbouring bytes, whether no piece has them inside."""
        cut = np.zeros((256, 256), bool)
        cut[:128, :128] = True
        for p in normal:
            p = p.replace(SPACE, " ")
            for a, b in zip(p, p[1:]):
                if ord(a) < 128 and ord(b) < 128:
                    cut[ord(a), ord(b)] = False
        return cut.ravel()

    # -- merging --------------------------------------------------------------
    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_to[at], -1)

    def merge(self, symbols: np.ndarray, word: np.ndarray, single: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word) with all merges done; ``word`` numbers, ascending,
        the word of each symbol."""
        done, again = [], []
        start_symbols, start_word = symbols.copy(), word
        makes = np.full(len(symbols), -1)
        same = word[1:] == word[:-1]
        makes[:-1][same] = self._merged(symbols[:-1][same], symbols[1:][same])
        rank = np.where(makes >= 0, self.rank[makes], _FAR)
        while len(symbols):
            firsts = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
            lengths = np.diff(firsts, append=len(word))
            best = np.minimum.reduceat(rank, firsts)
            if (best == _FAR).any():  # finished words leave
                stay = np.repeat(best < _FAR, lengths)
                done.append((symbols[~stay], word[~stay]))
                symbols, word, makes, rank = symbols[stay], word[stay], makes[stay], rank[stay]
                if not len(symbols):
                    break
                firsts = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
                lengths = np.diff(firsts, append=len(word))
                best = best[best < _FAR]
            hit = np.flatnonzero(rank == np.repeat(best, lengths))
            if single:
                chosen = hit[np.diff(word[hit], prepend=-1) != 0]
            else:  # of overlapping hits every other one, from the left
                fresh = np.diff(hit, prepend=-2) != 1
                begins = np.flatnonzero(fresh)
                place = np.arange(len(hit)) - np.repeat(begins, np.diff(begins, append=len(hit)))
                chosen = hit[place % 2 == 0]
            symbols[chosen] = makes[chosen]
            keep = np.ones(len(symbols), bool)
            keep[chosen + 1] = False
            merged_rank = rank[chosen]
            symbols, word, makes, rank = symbols[keep], word[keep], makes[keep], rank[keep]
            now = chosen - np.arange(len(chosen))  # places after compaction
            touched = np.unique(np.concatenate([now, now[now > 0] - 1]))
            right = np.minimum(touched + 1, len(symbols) - 1)
            joined = (touched + 1 < len(symbols)) & (word[touched] == word[right])
            new = np.full(len(touched), -1)
            new[joined] = self._merged(symbols[touched[joined]], symbols[right[joined]])
            makes[touched] = new
            rank[touched] = np.where(new >= 0, self.rank[new], _FAR)
            if not single and len(chosen) > 1:
                low = np.minimum(rank[now], np.where((now > 0) & (word[now - 1] == word[now]), rank[now - 1], _FAR))
                many = np.diff(word[now], prepend=-1) == 0
                many[:-1] |= many[1:]
                odd = np.unique(word[now[many & (low <= merged_rank)]])
                if len(odd):
                    again.append(odd)
                    stay = ~np.isin(word, odd)
                    symbols, word, makes, rank = symbols[stay], word[stay], makes[stay], rank[stay]
        if again:
            redo = np.isin(start_word, np.concatenate(again))
            done.append(self.merge(start_symbols[redo], start_word[redo], single=True))
        if not done:
            return symbols, word
        symbols, word = np.concatenate([s for s, _ in done]), np.concatenate([w for _, w in done])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _new(self, words: pa.Array) -> pa.Array:
        words = words.cast(pa.string())
        points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
        word = np.repeat(np.arange(len(words)), pc.utf8_length(words).to_numpy())
        symbols, word = self.merge(self.symbol[points], word)
        unknown = symbols >= self.size
        if unknown.any():
            point = symbols[unknown] - self.size
            width = 1 + (point > 0x7F).astype(np.int64) + (point > 0x7FF) + (point > 0xFFFF)
            times = np.ones(len(symbols), np.int64)
            times[unknown] = width
            octets = np.frombuffer("".join(map(chr, point.tolist())).encode(), np.uint8)
            symbols, word = np.repeat(symbols, times), np.repeat(word, times)
            symbols[symbols >= self.size] = self.byte_ids[octets]
        ends = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))]).astype(np.int32) * 2
        return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(symbols.astype("<u2"))])

    # -- texts ----------------------------------------------------------------
    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends) of bounded parts of the texts, in order."""
        none, space = pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary())
        for _, part, _, _ in text_slices(texts):
            part = pc.if_else(pc.equal(pc.binary_length(part), 0), none, pc.binary_join_element_wise(none, part, space))
            offsets = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8)
            data = np.frombuffer(part.buffers()[2] or b"", np.uint8, offsets[-1] - offsets[0], offsets[0])
            ends = offsets[1:] - offsets[0]
            if not len(data):
                yield np.empty(0, np.int64), np.zeros(len(part), np.int64)
                continue
            start = np.empty(len(data), bool)
            start[0] = True
            np.take(self.cut, data[:-1].astype(np.uint16) << 8 | data[1:], out=start[1:])
            start[ends[:-1][ends[:-1] < len(data)]] = True
            cuts = np.append(np.flatnonzero(start), len(data)).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
            index, values = lookup(words, self.memory, self._new)
            out = pc.take(values, index)
            at = np.frombuffer(out.buffers()[1], np.int32, len(out) + 1)
            ids = np.frombuffer(out.buffers()[2] or b"", "<u2", at[-1] // 2).astype(np.int64)
            yield ids, at[np.searchsorted(cuts, ends)].astype(np.int64) // 2

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        """The UTF-8 text of each run of ids."""
        spelled = pc.take(self.text, pa.array(ids))
        at = np.frombuffer(spelled.buffers()[1], np.int64, len(spelled) + 1)
        data = memoryview(spelled.buffers()[2] or b"")
        bare = np.concatenate([self.is_byte[ids], [True]])
        first = 0
        for end in ends.tolist():
            text = bytes(data[at[first]:at[end]])
            if text[:1] == b" " and first < end and not bare[first]:
                text = text[1:]
            yield text.decode(errors="each-byte").encode()
            first = end

    def listed(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[memoryview]:
        """The decimal ids of each run, joined by commas."""
        spelled = pc.take(self.decimal, pa.array(ids))
        at = np.frombuffer(spelled.buffers()[1], np.int64, len(spelled) + 1)
        data = memoryview(spelled.buffers()[2] or b"")
        first = 0
        for end in ends.tolist():
            yield data[at[first]:max(at[first], at[end] - 1)]
            first = end


_LOADED: dict[str, PieceBpe] = {}


def piece_bpe(path: str) -> PieceBpe:
    if path not in _LOADED:
        _LOADED[path] = PieceBpe(path)
    return _LOADED[path]


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids) of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(model)
        for batch in batches:
            row = 0
            for ids, ends in bpe.encode(batch.column(1)):
                lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(ends)), lists], ["doc_id", "ids"])
                row += len(ends)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids); null ids are no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(model)
        for batch in batches:
            lists = pc.fill_null(batch.column(1), [])
            ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
            texts = list(bpe.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ends))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) without moving the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(model)
        for batch in batches:
            row = 0
            for ids, ends in bpe.encode(batch.column(1)):
                sha = [[hashlib.sha256(x).hexdigest() for x in f(ids, ends)] for f in (bpe.listed, bpe.decode)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(ends)), pa.array(np.diff(ends, prepend=0)), pa.array(sha[0]), pa.array(sha[1])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                row += len(ends)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
