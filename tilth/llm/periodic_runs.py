"""Periodic runs of words inside documents, and texts without them.

A run is a stretch of at least ``LEAST`` words and ``TIMES`` periods that
repeats itself at its smallest period and that no neighbouring word extends.

Every word of a run occurs ``TIMES`` times in it. So a word that occurs more
rarely in the segment looked at splits that segment, and the parts are counted
anew until nothing splits; most texts are gone after a round or two. What is
left is scanned by lag. The lags worth a look are found by doubling: a stretch
of 2^k words inside a run of period p, p <= 2^k, next occurs exactly p words on,
since a nearer repeat would be a smaller period. So the stretches whose next
occurrence lies (2^(k-1), 2^k] words on, side by side at one distance, are the
runs of those periods, whole and with their smallest period. A level costs a
sort of what is left; a level's stretches that occur too rarely for any longer
period drop out.

Cases: a null or empty text has no words and no runs; a text of any length is
one text; equal rows and null doc_ids are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tilth.llm.words import SPACED, joined, word_slices

TIMES, LEAST = 4, 6
#: Words looked at in rounds of splitting, for each word of a slice. Texts made so that
#: each round splits off a few words go to the scan before they are stable, which finds the same runs.
ROUNDS = 64
RUNS = "array<struct<start: long, length: long, period: long>>"


def _counts(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, at every place of it."""
    order = np.argsort(keys)
    fresh = np.flatnonzero(np.diff(keys[order], prepend=-1))
    sizes = np.diff(fresh, append=len(keys))
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(sizes, sizes)
    return out


def surviving(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of the words that frequency splitting leaves, ascending. Places
    side by side and of one text are a segment."""
    many = int(codes.max()) + 1 if len(codes) else 1
    place, segment = np.arange(len(codes)), text
    done: list[np.ndarray] = []
    room = ROUNDS * len(codes)
    while len(place):
        if room <= 0:
            done.append(place)
            break
        room -= len(place)
        often = _counts(segment * many + codes[place]) >= TIMES
        # A segment that has lost no word is stable.
        lost = np.bincount(segment, ~often, minlength=segment[-1] + 1) > 0
        done.append(place[~lost[segment]])
        place, segment = place[often & lost[segment]], segment[often & lost[segment]]
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) > 1) | (np.diff(segment) > 0)
        segment = np.cumsum(new) - 1
        if len(place):
            wide = np.bincount(segment) >= LEAST
            place, segment = place[wide[segment]], segment[wide[segment]]
            segment = np.cumsum(np.diff(segment, prepend=segment[:1]) > 0) if len(segment) else segment
    kept = np.sort(np.concatenate(done)) if done else np.empty(0, np.int64)
    # A stable segment may have been too short from the start.
    new = np.ones(len(kept), bool)
    new[1:] = (np.diff(kept) > 1) | (np.diff(text[kept]) > 0)
    return kept[np.repeat(x := np.diff(np.flatnonzero(new), append=len(kept)), x) >= LEAST] if len(kept) else kept


def scan(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, as places in ``codes``."""
    place = surviving(codes, text)
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) > 1) | (np.diff(text[place]) > 0)
    segment = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], len(place))[segment] if len(place) else place
    name, at, size = codes[place], np.arange(len(place)), 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(at):
        # Where each stretch of ``size`` words occurs next in its segment.
        key = segment[at] * (int(name.max()) + 1) + name
        order = np.argsort(key, kind="stable")
        same = np.diff(key[order]) == 0
        ahead = np.zeros(len(at), np.int64)
        ahead[order[:-1][same]] = np.diff(at[order])[same]
        fits = np.flatnonzero((2 * ahead > size) & (ahead <= size))
        if len(fits):
            new = np.ones(len(fits), bool)
            new[1:] = (np.diff(at[fits]) > 1) | (np.diff(ahead[fits]) != 0) | (np.diff(segment[at[fits]]) > 0)
            first = np.flatnonzero(new)
            period = ahead[fits[first]]
            length = np.diff(first, append=len(fits)) - 1 + period + size
            long = length >= np.maximum(LEAST, TIMES * period)
            found.append((place[at[fits[first]]][long], length[long], period[long]))
        # Names of stretches twice as long, of those that occur often enough for a longer period.
        often = _counts(key) >= TIMES - 1
        named = np.full(len(place), -1, np.int64)
        named[at[often]] = name[often]
        at = at[often]
        # A run of a period above ``size`` has more than TIMES * size words.
        at = at[at + 2 * size <= end[at]]
        pair = named[at + size] if len(at) else at
        at, pair = at[pair >= 0], pair[pair >= 0]
        name = np.unique(named[at] * (int(pair.max()) + 1) + pair, return_inverse=True)[1] if len(at) else at
        size *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def repeats(start: np.ndarray, length: np.ndarray, period: np.ndarray, words: int) -> np.ndarray:
    """Which of ``words`` words stand in some run after its first period."""
    edge = np.bincount(start + period, minlength=words + 1) - np.bincount(start + length, minlength=words + 1)
    return np.cumsum(edge[:words]) > 0


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text):
    the runs by start, then period, and the words outside repeats, one space
    between them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in word_slices(batch.column(1), SPACED):
                start, length, period = scan(words.codes, words.text)
                ends = np.searchsorted(start, words.ends).astype(np.int32)
                own = np.repeat(words.firsts, np.diff(ends, prepend=0))
                each = pa.StructArray.from_arrays([pa.array(x) for x in (start - own, length, period)], ["start", "length", "period"])
                runs = pa.ListArray.from_arrays(np.append(np.int32(0), ends), each)
                text = joined(words, ~repeats(start, length, period, len(words.codes)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ends)), pa.array(words.ends - words.firsts), runs, text],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
