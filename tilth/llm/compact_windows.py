"""Near-duplicate passages across documents, by compact windows.

The units are shingles of five words. Under a hash function, a compact window
(l, c, r) stands for all subsequences that start in [l, c] and end in [c, r]:
all have the shingle at c as their min-hash. The windows wide enough for a
passage of ``MIN_WORDS`` words come from the Cartesian tree of the hashes; the
tree is built over the runs of the sliding minimum, its only nodes that wide.
Windows of different documents that share a min-hash, and agree some words to
the right or left, are grouped; a member is tried against the first of its group,
so a shared passage gives a link for each later copy, never all pairs. Links of
two documents are joined where their intervals overlap, passages reached by
``AGREE`` hash functions are candidates, and the shingles of both sides decide.
Members that the first did not settle are then tried against every earlier
member that is no verbatim copy of it.

Cases: null, empty and short texts have no passages; case is ignored, white
space only separates; repeats inside one document are left alone; rows that
repeat a doc_id are one document, with the passages of any of them; a null
doc_id takes no part. Places and windows that need more bits than a row has
for them go beside it, whatever the length of a text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilth.llm.byte_tokens import text_slices
from tilth.llm.common import Stages
from tilth.llm.line_dedup import with_text

SHINGLE, MIN_WORDS, SIMILARITY = 5, 50, 0.8
WIDTH = MIN_WORDS - SHINGLE + 1
HASHES, AGREE, ASIDE = 4, 2, 20
PLACE_BITS = 24
#: What of a window fits a row's bits: its least shingle's place, and how far it reaches from there.
PLACE, LEFT, RIGHT = (1 << PLACE_BITS) - 1, (1 << 19) - 1, (1 << 20) - 1


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit permutation with well-spread bits (multiply and shift, twice)."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): a 64-bit hash of every shingle, and where each text's end."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts.cast(pa.large_string()))))
    coded = words.flatten().dictionary_encode()
    names = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in coded.dictionary.cast(pa.large_binary())), np.uint64, len(coded.dictionary))
    h = names[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.uint64)
    counts = np.diff(words.offsets.to_numpy())
    if len(h) < SHINGLE:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    n = len(h) - SHINGLE + 1
    rolled = h[:n].copy()
    for i in range(1, SHINGLE):
        rolled = _mixed(rolled, 0) + h[i:n + i]
    text = np.repeat(np.arange(len(counts)), counts)
    return rolled[text[:n] == text[SHINGLE - 1:]], np.cumsum(np.maximum(counts - SHINGLE + 1, 0))


def _sliding_minimum(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        v, size = np.minimum(v[:-size], v[size:]), 2 * size
    rest = width - size
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def place_mask(n: int) -> np.uint64:
    """The low bits that tell ``n`` places apart."""
    return np.uint64((1 << max(PLACE_BITS, n.bit_length())) - 1)


def compact_windows(v: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[list, list, list]:
    """(c, l, r) of the windows at least ``WIDTH`` wide. ``v`` holds distinct
    values with their own place in the low bits (``place_mask`` says how many),
    ``text`` the text of each, and ``first`` and ``last`` the places where each
    text begins and ends."""
    if len(v) < WIDTH:
        return [], [], []
    low = _sliding_minimum(v, WIDTH)
    inside = text[:len(low)] == text[WIDTH - 1:]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return [], [], []
    low = low[starts]
    owner = text[starts]
    mask = place_mask(len(v))
    height = low & ~mask  # equal heights side by side are one node, named by its first place
    change = np.ones(len(starts), bool)
    change[1:] = (height[1:] != height[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(change)
    run_first, run_last = starts[begin], starts[np.append(begin[1:], len(starts)) - 1]
    value, owner = low[begin], owner[begin]
    left, right = first[owner].tolist(), last[owner].tolist()
    # A smaller minimum to the left leaves with the place its last window began at;
    # one to the right enters with the place its first window ends at.
    stack: list[int] = []
    values, owners, begins, ends = height[begin].tolist(), owner.tolist(), run_first.tolist(), run_last.tolist()
    for i, x in enumerate(values):
        if stack and owners[stack[-1]] != owners[i]:
            stack = []
        while stack and values[stack[-1]] > x:
            right[stack.pop()] = begins[i] + WIDTH - 2
        if stack:
            left[i] = ends[stack[-1]] + 1
        stack.append(i)
    return (value & mask).astype(np.int64).tolist(), left, right


def window_rows(docs: DataFrame) -> DataFrame:
    """(key, doc_id, place, context, far) of every wide window: in few bytes, as
    most rows meet no other. ``unpacked`` says what is in them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part, _, _ in text_slices(batch.column(1)):
                base, ends = shingle_hashes(part)
                first, last = np.concatenate([[0], ends[:-1]]), ends - 1
                text = np.repeat(np.arange(len(ends)), ends - first)
                place = np.arange(len(base), dtype=np.uint64)
                mask = place_mask(len(base))
                aside = (base >> np.uint64(48)).astype(np.int64)
                for fn in range(HASHES):
                    mixed = _mixed(base, fn + 1)
                    c, l, r = (np.array(x, np.int64) for x in compact_windows(mixed & ~mask | place, text, first, last))
                    if not len(c):
                        continue
                    n = len(base) - 1
                    doc = text[c]
                    ahead = np.where(r - c >= ASIDE, aside[np.minimum(c + ASIDE, n)] + 1, 0)
                    behind = np.where(c - l >= ASIDE, aside[np.maximum(c - ASIDE, 0)] + 1, 0)
                    here, left, right = c - first[doc], c - l, r - c
                    far = (here > PLACE) | (left > LEFT) | (right > RIGHT)
                    exact = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (here, here - left, here + right)], ["c", "l", "r"])
                    yield pa.RecordBatch.from_pydict({
                        "key": mixed[c].view(np.int64), "doc_id": batch.column(0).take(pa.array(at + doc)),
                        "place": np.where(far, 0, here | left << PLACE_BITS | right << 43),
                        "context": ahead | behind << 17 | fn << 34,
                        "far": exact.take(pa.array(np.where(far, np.arange(len(c)), 0), mask=~far))})

    return docs.select("doc_id", "text").filter("doc_id is not null").mapInArrow(
        read, "key long, doc_id long, place long, context long, far struct<c:int,l:int,r:int>")


def unpacked(rows: DataFrame) -> DataFrame:
    """(key, fn, doc_id, c, l, r, ahead, behind): places count shingles of the
    text; ahead and behind are short hashes of the shingles ``ASIDE`` places off
    (0 where those lie outside the window)."""
    place = f"(place & {(1 << PLACE_BITS) - 1})"
    return rows.selectExpr(
        "key", "cast(context >> 34 as int) as fn", "doc_id", f"coalesce(far.c, cast({place} as int)) as c",
        f"coalesce(far.l, cast({place} - (place >> {PLACE_BITS} & {LEFT}) as int)) as l", f"coalesce(far.r, cast({place} + (place >> 43) as int)) as r",
        "cast(context & 131071 as int) as ahead", "cast(context >> 17 & 131071 as int) as behind")


def group_members(docs: DataFrame, stages: Stages) -> DataFrame:
    """(key, near, fn, doc_id, c, l, r): windows that share a min-hash, once for
    each side on which they can agree; members of equal key and near are a group."""
    windows = stages.keep(window_rows(docs), "windows")
    keys = windows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    shared = unpacked(windows.join(keys, "key"))
    sides = F.array(F.col("ahead"), F.when(F.col("behind") > 0, F.col("behind") + (1 << 17)))
    members = stages.keep(shared.withColumn("near", F.explode(sides)).filter("near > 0").select("key", "near", "fn", "doc_id", "c", "l", "r"), "members")
    stages.drop(windows)
    return members


_OF = ["fn", "doc_id", "l", "r", "of_doc", "of_l", "of_r"]


def links_to_first(members: DataFrame) -> DataFrame:
    """Every other member beside the first of its group."""
    lead = members.groupBy("key", "near").agg(F.min(F.struct("doc_id", "c", "l", "r")).alias("first"))
    return members.join(lead, ["key", "near"]).filter("doc_id > first.doc_id or c > first.c").select(
        "key", "near", "c", *_OF[:4], F.col("first.doc_id").alias("of_doc"), F.col("first.l").alias("of_l"), F.col("first.r").alias("of_r"))


def links_of_the_rest(links: DataFrame, found: DataFrame) -> DataFrame:
    """Members whose place no passage ``found`` with their first holds, beside every earlier member
    of their group, the first included, as hash functions count together. Members
    whose place lies in a verbatim copy of an earlier document's passage are left
    to that document."""
    spans = found.select(F.col("doc_id").alias("_doc"), F.col("of_doc_id").alias("_of"), F.col("start_word").alias("_from"), (F.col("start_word") + F.col("n_words") - SHINGLE).alias("_to"), "verbatim")
    inside = (F.col("doc_id") == F.col("_doc")) & F.col("c").between(F.col("_from"), F.col("_to"))
    failed = links.filter("doc_id > of_doc").join(spans, inside & (F.col("of_doc") == F.col("_of")), "left_anti")
    others = links.join(spans.filter("verbatim"), inside, "left_anti").select(
        "key", "near", F.col("doc_id").alias("of_doc"), F.col("l").alias("of_l"), F.col("r").alias("of_r"))
    return failed.select("key", "near", *_OF[:4]).join(others, ["key", "near"]).filter("doc_id > of_doc").select(*_OF).union(failed.select(*_OF))


def candidates(links: DataFrame) -> DataFrame:
    """(doc_id, l, r, of_doc, of_l, of_r): intervals of shingles of a document
    and of an earlier one that enough hash functions bring together."""
    # Cut the intervals of two documents into clusters of overlapping ones.
    pair = Window.partitionBy("doc_id", "of_doc").orderBy("l", "r", "of_l", "of_r", "fn")
    reach = F.max("r").over(pair.rowsBetween(Window.unboundedPreceding, -1))
    marked = links.filter("doc_id > of_doc").select(*_OF).distinct().withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("l")).cast("int"))
    return (marked.withColumn("cluster", F.sum("new").over(pair.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "of_doc", "cluster")
            .agg(F.min("l").alias("l"), F.max("r").alias("r"), F.min("of_l").alias("of_l"), F.max("of_r").alias("of_r"), F.count_distinct("fn").alias("fns"))
            .filter(F.col("fns") >= AGREE).drop("cluster", "fns"))


def interval_hashes(rows: DataFrame) -> DataFrame:
    """(doc_id, l, r, hashes) of rows (doc_id, text, want), ``want`` a list of
    (l, r): the shingles of those intervals, in order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part, _, _ in text_slices(batch.column(1)):
                base, ends = shingle_hashes(part)
                first = np.concatenate([[0], ends[:-1]])
                short = base.view(np.int64) >> 32
                wants = batch.column(2).slice(at, len(part))
                many = np.diff(wants.offsets.to_numpy())
                wants = wants.flatten()
                l, r = (wants.field(i).to_numpy() for i in (0, 1))
                doc = np.repeat(np.arange(len(part)), many)
                begin, end = first[doc] + l, np.minimum(first[doc] + r + 1, ends[doc])
                size = np.maximum(end - begin, 0)
                offsets = np.concatenate([[0], np.cumsum(size)])
                index = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at + doc)), wants.field(0), wants.field(1),
                     pa.ListArray.from_arrays(offsets.astype(np.int32), short[index].astype(np.int32))], ["doc_id", "l", "r", "hashes"])

    return rows.select("doc_id", "text", "want").mapInArrow(read, "doc_id long, l int, r int, hashes array<int>")


def shared_passages(mine: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(from, to, other from, other to), ends included: the stretches of
    ``mine`` at least ``WIDTH`` long that are similar to a stretch of ``other``."""
    order = np.argsort(other, kind="stable")
    at = np.searchsorted(other[order], mine)
    found = at < len(other)
    found[found] = other[order[at[found]]] == mine[found]
    edges = np.flatnonzero(np.diff(found.astype(np.int8), prepend=0, append=0))
    pieces = [[b, e, e - b] for b, e in zip(edges[::2].tolist(), edges[1::2].tolist())]  # from, to (excluded), found
    # With Jaccard s, a share 2 s / (1 + s) of either side is common.
    share = 2 * SIMILARITY / (1 + SIMILARITY)
    merged: list[list] = []  # from, to, found, the exact runs inside
    for begin, end, many in pieces:
        merged.append([begin, end, many, [(begin, end)]])
        while len(merged) > 1 and merged[-2][2] + merged[-1][2] >= share * (merged[-1][1] - merged[-2][0]):
            _, last, more, runs = merged.pop()
            merged[-1][1:] = [last, merged[-1][2] + more, merged[-1][3] + runs]

    def partner(begin: int, end: int) -> tuple[int, int] | None:
        """Where the other side has a stretch similar to mine[begin:end]."""
        span, hits = mine[begin:end], np.flatnonzero(found[begin:end])
        places = order[at[begin:end][hits]]
        middle = int(np.median(places - hits))
        # From the first common shingle to the last, at one offset throughout or,
        # in text that repeats itself, all places in reach.
        every = np.flatnonzero(np.isin(other, span))
        for low, high in ((int(places[0]), int(places[-1]) + 1), (max(0, middle), min(len(other), middle + len(span))),
                          (int(every[0]), int(every[-1]) + 1)):
            if high - low < SIMILARITY * WIDTH:
                continue
            both, union = (len(f(span, other[low:high])) for f in (np.intersect1d, np.union1d))
            if both >= SIMILARITY * union:
                return low, high
        return None

    def offset(run: tuple[int, int]) -> float:
        return float(np.median(order[at[run[0]:run[1]]] - np.arange(*run)))

    out = []
    for _, _, _, runs in merged:
        left = [runs]
        while left:
            runs = left.pop()
            begin, end = runs[0][0], runs[-1][1]
            if end - begin < WIDTH:
                continue
            place = partner(begin, end)
            if place:
                out.append((begin, end - 1, place[0], place[1] - 1))
            elif len(runs) > 1:
                # Apart where the other side goes on elsewhere, or else at the widest gap.
                offsets = [offset(x) for x in runs]
                cut = max(range(1, len(runs)), key=lambda k: (abs(offsets[k] - offsets[k - 1]), runs[k][0] - runs[k - 1][1]))
                left += [runs[cut:], runs[:cut]]
    return out


def verified_passages(docs: DataFrame, pairs: DataFrame, stages: Stages) -> DataFrame:
    """(doc_id, start_word, n_words, of_doc_id, of_start_word, of_n_words, verbatim)
    of candidate ``pairs``: the similar passages inside their intervals."""
    mine = pairs.select("doc_id", "l", "r")
    theirs = pairs.select(F.col("of_doc").alias("doc_id"), F.col("of_l").alias("l"), F.col("of_r").alias("r"))
    want = mine.union(theirs).distinct().groupBy("doc_id").agg(F.collect_list(F.struct("l", "r")).alias("want"))
    read = stages.keep(interval_hashes(docs.select("doc_id", "text").join(want, "doc_id")), "shingles")
    other = read.select(F.col("doc_id").alias("of_doc"), F.col("l").alias("of_l"), F.col("r").alias("of_r"), F.col("hashes").alias("theirs"))
    both = pairs.join(other, ["of_doc", "of_l", "of_r"]).join(read, ["doc_id", "l", "r"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start_word", "n_words", "of_doc_id", "of_start_word", "of_n_words", "verbatim"]
        for batch in batches:
            rows = []
            for doc_id, l, of_doc, of_l, a, b in zip(*(batch.column(i) for i in range(6))):
                mine, other = a.values.to_numpy(), b.values.to_numpy()
                for begin, end, low, high in shared_passages(mine, other):
                    rows.append((doc_id.as_py(), l.as_py() + begin, end - begin + SHINGLE, of_doc.as_py(), of_l.as_py() + low, high - low + SHINGLE,
                                 bool(np.array_equal(mine[begin:end + 1], other[low:high + 1]))))
            types = [pa.int64()] * 6 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 7, types)], names)

    return both.select("doc_id", "l", "of_doc", "of_l", "hashes", "theirs").mapInArrow(
        verify, "doc_id long, start_word long, n_words long, of_doc_id long, of_start_word long, of_n_words long, verbatim boolean").distinct()


def repeated_passages(docs: DataFrame, stages: Stages) -> DataFrame:
    """(doc_id, start_word, n_words, of_doc_id, of_start_word, of_n_words): every
    passage that an earlier document has too."""
    members = group_members(docs, stages)
    links = stages.keep(links_to_first(members), "links")
    stages.drop(members)
    tried = stages.keep(candidates(links), "candidates")
    first = stages.keep(verified_passages(docs, tried, stages), "passages")
    rest = stages.keep(candidates(links_of_the_rest(links, first)).subtract(tried.select("doc_id", "of_doc", "l", "r", "of_l", "of_r")), "candidates")
    stages.drop(links)
    return first.union(verified_passages(docs, rest, stages)).drop("verbatim").distinct()


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` (first word, words), which may overlap."""
    data = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ \t-\r]+", data)]
    out, at = [], 0
    for first, many in sorted(spans):
        begin, end = places[min(first, len(places) - 1)][0], places[min(first + many, len(places)) - 1][1]
        if end > at:
            out.append(data[at:max(at, begin)])
            at = end
    return b"".join([*out, data[at:]]).decode()


def drop_repeated_passages(docs: DataFrame, stages: Stages) -> DataFrame:
    """``docs`` without passages that an earlier document has; n_chars follows."""
    spans = repeated_passages(docs, stages).groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_set(F.struct("start_word", "n_words")).alias("__spans"))
    rows = docs.join(stages.keep(spans, "spans"), F.col("doc_id") == F.col("__id"), "left").drop("__id")
    at, many = docs.columns.index("text"), len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, found in enumerate(batch.column(many)):
                if found.is_valid and texts[i]:
                    texts[i] = without_spans(texts[i], [(s["start_word"].as_py(), s["n_words"].as_py()) for s in found])
            columns = list(batch.columns[:many])
            columns[at] = pa.array(texts, batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:many])

    return with_text(rows.mapInArrow(cut, docs.schema), docs.columns)
