"""Byte-level BPE ids of whole texts, a batch at a time.

Text is cut into the pieces the tokenizer never merges across, by array
operations over the batch's bytes; each distinct piece goes through the
``tokenizers`` model once per worker and is looked up from then on. Texts with
characters outside the plain range (ASCII and Latin letters) are encoded whole
by the library.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows or bytes of one slice of a batch, and pieces remembered by one worker.
SLICE_BYTES, MEMORY = 8 << 20, 1 << 20
#: Bytes of texts that the library encodes whole at a time.
WHOLE_BYTES = 1 << 18

_SPACE, _WHITE, _DIGIT, _MARK = 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)  # 0: letters, and all bytes of Latin letters
_CLASS[:128] = _MARK
_CLASS[ord(" ")] = _SPACE
_CLASS[[9, 10, 11, 12, 13]] = _WHITE
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 0
#: Texts the array splitter may cut: no letters beyond U+024F, none of the symbols
#: among Latin-1, no separators 1C-1F, and no apostrophes (contractions).
ODD = r"[^\x00-\x1B\x20-\x26\x28-\x7EÀ-ÖØ-öø-ɏ]"


def piece_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin: ``ends`` are the byte ends of the texts in ``data``."""
    kind = _CLASS[data]
    white = (kind == _SPACE) | (kind == _WHITE)
    start = np.empty(len(data), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[1:] &= ~((kind[:-1] == _SPACE) & ~white[1:])  # one space belongs to what follows
    start[1:] &= ~(white[:-1] & white[1:])
    last = white[:-1] & ~white[1:]  # of a white run only its last goes with what follows
    last[ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(data))] - 1] = False
    start[:-1] |= last
    firsts = np.concatenate([[0], ends[:-1]])
    start[firsts[firsts < len(data)]] = True
    # A white character other than a space stands alone before a word.
    start[1:] |= (kind[:-1] == _WHITE) & ~white[1:]
    return np.flatnonzero(start)


def lookup(words: pa.Array, memory: dict, encode_new) -> tuple[pa.Array, pa.Array]:
    """(index, values): ``values[index]`` is each word's encoding. ``memory``
    keeps the distinct words seen so far and their encodings."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    if "words" not in memory or len(memory["words"]) > MEMORY:
        memory["words"], memory["values"] = distinct.slice(0, 0), None
    at = pc.index_in(distinct, value_set=memory["words"])
    fresh = distinct.filter(pc.is_null(at))
    if len(fresh):
        new = encode_new(fresh)
        memory["words"] = pa.concat_arrays([memory["words"], fresh])
        memory["values"] = new if memory["values"] is None else pa.concat_arrays([memory["values"], new])
        at = pc.index_in(distinct, value_set=memory["words"])
    return pc.take(at, coded.indices), memory["values"]


def text_slices(texts: pa.Array):
    """Parts of a string array of bounded bytes (or one long text)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, texts.slice(at, end - at), offsets[at:end + 1] - offsets[at], offsets[at]
        at = end


class ByteTokens:
    """``encode(texts)`` gives (ids, ends): all ids of the batch as unsigned
    16-bit integers and where each text's ids end. Nulls are empty texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        if self.whole.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.memory: dict = {}

    def _new(self, words: pa.Array) -> pa.Array:
        tokenize, table = self.model.tokenize, self.letters
        values = [np.array([t.id for t in tokenize(w.decode("latin-1").translate(table))], "<u2").tobytes()
                  for w in words.to_pylist()]
        return pa.array(values, pa.binary())

    def _fast(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, "<u2"), np.zeros(len(ends), np.int64)
        starts = piece_starts(data, ends)
        cuts = np.append(starts, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        index, values = lookup(words, self.memory, self._new)
        out = pc.take(values, index)
        at = np.frombuffer(out.buffers()[1], np.int32, len(out) + 1)
        ids = np.frombuffer(out.buffers()[2] or b"", "<u2", at[-1] // 2)
        return ids, at[np.searchsorted(cuts, ends)].astype(np.int64) // 2

    def _whole(self, texts: pa.Array):
        """The library's ids of each text; what it holds of a token is many times the id, so few texts at a time."""
        sizes, at = pc.binary_length(texts).to_numpy(), 0
        while at < len(texts):
            many = max(int(np.searchsorted(np.cumsum(sizes[at:at + 4096]), WHOLE_BYTES, "right")), 1)
            for e in self.whole.encode_batch_fast(texts.slice(at, many).to_pylist(), add_special_tokens=False):
                yield np.array(e.ids, "<u2")
            at += many

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        all_ids, all_ends, base = [], [], 0
        for _, part, offsets, first in text_slices(texts):
            odd = pc.match_substring_regex(part.cast(pa.large_string()), ODD).to_numpy(zero_copy_only=False)
            data = np.frombuffer(part.buffers()[2] or b"", np.uint8, offsets[-1], first)
            if not odd.any():
                ids, ends = self._fast(data, offsets[1:])
            else:
                lengths = np.diff(offsets)
                plain = data[np.repeat(~odd, lengths)]
                some, some_ends = self._fast(plain, np.cumsum(lengths[~odd]))
                runs = np.split(some, some_ends[:-1]) if len(some_ends) else []
                easy, hard = iter(runs), self._whole(part.filter(pa.array(odd)).cast(pa.large_string()))
                each = [next(hard) if o else next(easy) for o in odd]
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            all_ids.append(ids)
            all_ends.append(ends + base)
            base += len(ids)
        if not all_ids:
            return np.empty(0, "<u2"), np.empty(0, np.int64)
        return np.concatenate(all_ids), np.concatenate(all_ends)

    def encode_documents(self, texts: pa.Array, end_id: int):
        """The ids of each text followed by ``end_id``: an iterator of arrays."""
        ids, ends = self.encode(texts)
        first, last = 0, np.array([end_id], "<u2")
        for end in ends.tolist():
            yield np.concatenate([ids[first:end], last])
            first = end


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte: bytes
    that print stand for themselves, the rest take the characters from U+0100."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = (b for b in range(256) if b not in set(prints))
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LOADED: dict[str, ByteTokens] = {}


def byte_tokens(path: str) -> ByteTokens:
    """One tokenizer per worker process and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _LOADED:
        _LOADED[path] = ByteTokens(path)
    return _LOADED[path]
