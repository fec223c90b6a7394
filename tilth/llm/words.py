"""Words of whole texts as numbers, a slice of a batch at a time, by array
operations over its bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tilth.llm.byte_tokens import text_slices


class Alphabet(NamedTuple):
    """For every byte, whether words hold it and what stands for it."""

    inside: np.ndarray
    plain: np.ndarray


def _alphabet(outside: bytes, fold: bool) -> Alphabet:
    inside, plain = np.ones(256, bool), np.arange(256, dtype=np.uint8)
    inside[list(outside)] = False
    if fold:  # A-Z only
        plain[65:91] = plain[97:123]
    return Alphabet(inside, plain)


#: Words are what ASCII white space separates.
SPACED = _alphabet(b" \t\n\x0b\x0c\r", fold=False)
#: ASCII letters and all other characters beyond ASCII, A-Z in lower case; then with digits.
LETTERS = _alphabet(bytes(b for b in range(128) if not chr(b).isalpha()), fold=True)
LETTERS_DIGITS = _alphabet(bytes(b for b in range(128) if not chr(b).isalnum()), fold=True)


class Words(NamedTuple):
    """The words of some texts in their order: ``spelled[codes]``, and where
    each text's words end."""

    codes: np.ndarray
    spelled: pa.Array
    ends: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]])

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends)), self.ends - self.firsts)


def coded_words(part: pa.Array, offsets: np.ndarray, first: int, alphabet: Alphabet) -> Words:
    """Words of one slice as ``text_slices`` gives it."""
    data = np.frombuffer(part.buffers()[2] or b"", np.uint8, offsets[-1], first)
    inside = alphabet.inside[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    start[begins] = inside[begins]  # a word does not go on in the next text
    starts = np.flatnonzero(start)
    letters = alphabet.plain[data[inside]]
    cuts = np.append(np.cumsum(inside)[starts] - 1, len(letters)).astype(np.int32) if len(starts) else np.zeros(1, np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    return Words(coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.searchsorted(starts, offsets[1:]))


def word_slices(texts: pa.Array, alphabet: Alphabet):
    """(first row, words) of slices of bounded bytes; nulls are empty texts."""
    for at, part, offsets, first in text_slices(texts):
        yield at, coded_words(part, offsets, first, alphabet)


def joined(words: Words, keep: np.ndarray) -> pa.Array:
    """Per text, its words where ``keep`` is set, one space between them."""
    many = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], words.ends])].astype(np.int32)
    kept = words.spelled.take(pa.array(words.codes[keep]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(many), kept), b" ").cast(pa.string())
