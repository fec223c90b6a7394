"""Benchmark passages in a corpus, by a distributed positional inverted index.

The index is cut by documents: a segment is a bounded slice of the corpus with
its own directory (documents and where their words end) and, for every term of
it, the places of that term. A phrase lies in one segment, so no list is ever
gathered over the corpus, and a term in every document is as many lists as
there are segments.

Test items are cut into windows, and equal windows are one phrase. Corpus-wide
counts come from the index and order a phrase's terms; a phrase with a term
that never occurs is dropped. Where a segment has the rarest term, the list of
its places, less the term's offset in the phrase, is intersected with those of
the next terms, rarest first, until none is left. With some slack, a term may
stand that many places off: proximity matches.

Cases: a null or empty text has no words and no match; an item without words is
sought nowhere, one of fewer words than a window is one phrase; rows that repeat
an item_id are one item, and an item without an id marks words but is not
listed; equal rows and null doc_ids of documents are rows of their own. A text
may have 500 million words.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilth.llm.common import Stages, partitions_for
from tilth.llm.words import LETTERS_DIGITS, word_slices

WINDOW, SLACK = 10, 2
INDEX = "segment long, term string, n long, places binary, doc_ids array<long>, sizes array<long>"
_SCHEMA = pa.schema([("segment", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("places", pa.binary()),
                     ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])


class Index(NamedTuple):
    """``directory`` (segment, places: ends of its documents' words, doc_ids, sizes)
    and ``postings`` (segment, term, n, places), which hold places as first differences."""

    directory: DataFrame
    postings: DataFrame

    def documents(self) -> DataFrame:
        """(segment, place, doc_id, n_words) of every row of the corpus."""
        words = self.directory.select("segment", F.posexplode(F.arrays_zip("doc_ids", "sizes")))
        return words.select("segment", F.col("pos").alias("place"), F.col("col.doc_ids").alias("doc_id"), F.col("col.sizes").alias("n_words"))


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Runs of ascending values, cut at ``cuts``, as bytes of their differences."""
    steps = np.diff(values, prepend=0).astype("<u4")
    begins = cuts[:-1][np.diff(cuts) > 0]
    steps[begins] = values[begins]
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((4 * cuts).astype(np.int32)), pa.py_buffer(steps)])


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u4"), dtype=np.int64)


def build_index(docs: DataFrame, stages: Stages) -> Index:
    """The positional index of ``docs`` (doc_id, text), written out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for at, words in word_slices(batch.column(1), LETTERS_DIGITS):
                segment, texts = next(number), len(words.ends)
                lists = [pa.ListArray.from_arrays(pa.array([0, texts], pa.int32()), x) for x in (batch.column(0).slice(at, texts), pa.array(words.ends - words.firsts))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment]), pa.nulls(1, pa.string()), pa.array([texts]), _packed(words.ends, np.array([0, texts])), *lists], schema=_SCHEMA)
                many = np.bincount(words.codes, minlength=len(words.spelled))
                cuts = np.concatenate([[0], np.cumsum(many)])
                places = _packed(np.argsort(words.codes, kind="stable"), cuts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(many), segment)), words.spelled.cast(pa.string()), pa.array(many), places,
                     *[pa.nulls(len(many), pa.list_(pa.int64()))] * 2], schema=_SCHEMA)

    index = stages.keep(docs.select("doc_id", "text").mapInArrow(read, INDEX), "index")
    return Index(index.filter("term is null").drop("term", "n"), index.filter("term is not null").drop("doc_ids", "sizes"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, terms): every window of ``window`` words of ``items`` (item_id, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, words in word_slices(batch.column(1), LETTERS_DIGITS):
                size = np.minimum(words.ends - words.firsts, window)
                many = np.where(size > 0, words.ends - words.firsts - size + 1, 0)
                item = np.repeat(np.arange(len(many)), many)
                start = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many) + words.firsts[item]
                ends = np.cumsum(size[item])
                each = np.repeat(start - ends + size[item], size[item]) + np.arange(ends[-1] if len(ends) else 0)
                terms = words.spelled.cast(pa.string()).take(pa.array(words.codes[each]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at + item)), pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), terms)], ["item_id", "terms"])

    return items.select("item_id", "text").mapInArrow(read, "item_id long, terms array<string>")


def starts(lists, terms: list[str], offsets: list[int], slack: int = 0) -> np.ndarray:
    """Where a phrase starts: places of its first term less its offset, for which
    every other term stands in its place, give or take ``slack``."""
    at = lists(terms[0]) - offsets[0]
    for term, offset in zip(terms[1:], offsets[1:]):
        if not len(at):
            break
        places = lists(term)
        if not len(places):
            return places
        if slack:
            some = np.searchsorted(places, at + offset - slack) < np.searchsorted(places, at + offset + slack, "right")
        else:
            some = places[np.minimum(np.searchsorted(places, at + offset), len(places) - 1)] == at + offset
        at = at[some]
    return at


def search(index: Index, phrases: DataFrame, stages: Stages, slack: int = 0) -> DataFrame:
    """(segment, place, phrase, start, size, exact) of all matches of ``phrases``
    (phrase, terms): ``start`` counts words of the document. Proximity matches,
    if ``slack`` allows any, are those that are not exact."""
    terms = phrases.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    lists = index.postings.join(terms.select("term").distinct(), "term", "left_semi")
    counts = lists.groupBy("term").agg(F.sum("n").alias("often"))
    ordered = (terms.join(counts, "term").groupBy("phrase", "size")
               .agg(F.sort_array(F.collect_list(F.struct("often", "offset", "term"))).alias("order"))
               .filter(F.size("order") == F.col("size"))  # none without all of its terms
               .select("phrase", "order.term", "order.offset"))
    ordered = stages.keep(ordered.withColumnsRenamed({"term": "terms", "offset": "offsets"}).withColumn("rarest", F.col("terms")[0]), "ordered")
    where = index.postings.select("segment", F.col("term").alias("rarest"))
    asked = where.join(ordered, "rarest").select(
        "segment", F.lit(2).alias("kind"), F.lit(None).cast("string").alias("term"), F.lit(None).cast("binary").alias("places"), "phrase", "terms", "offsets")
    have = lists.select("segment", F.lit(1).alias("kind"), "term", "places")
    have = index.directory.select("segment", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("term"), "places").union(have)
    rows = have.unionByName(asked, allowMissingColumns=True)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, ends, packed, ready = None, None, {}, {}

        def places(term: str) -> np.ndarray:
            if term not in ready:
                ready[term] = _unpacked(packed.get(term, b""))  # a segment need not have every term
            return ready[term]

        for batch in batches:
            found: list[tuple[np.ndarray, ...]] = []
            kinds, here = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            for i, kind in enumerate(kinds.tolist()):
                if kind == 0:
                    segment, ends, packed, ready = int(here[i]), _unpacked(batch.column(3)[i].as_py()), {}, {}
                elif kind == 1:
                    packed[batch.column(2)[i].as_py()] = batch.column(3)[i].as_py()
                else:
                    words, offsets = batch.column(5)[i].as_py(), batch.column(6)[i].as_py()
                    exact = starts(places, words, offsets)
                    for at, sure in ((exact, True), *([(np.setdiff1d(starts(places, words, offsets, slack), exact), False)] if slack else [])):
                        at = at[at >= 0]
                        doc = np.searchsorted(ends, at, "right")
                        inside = doc < len(ends)
                        at, doc = at[inside], doc[inside]
                        inside = at + len(words) <= ends[doc]
                        at, doc = at[inside], doc[inside]
                        if len(at):
                            first = np.where(doc > 0, ends[doc - 1], 0)
                            found.append((np.full(len(at), segment), doc, np.full(len(at), batch.column(4)[i].as_py()), at - first, np.full(len(at), len(words)), np.full(len(at), sure)))
            if found:
                columns = [np.concatenate(x) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["segment", "place", "phrase", "start", "size", "exact"])

    dealt = rows.repartition(partitions_for(index.postings), "segment").sortWithinPartitions("segment", "kind")
    return dealt.mapInArrow(read, "segment long, place long, phrase long, start long, size long, exact boolean")


class Matches(NamedTuple):
    documents: DataFrame  # segment, place, doc_id, n_words
    found: DataFrame  # segment, place, item_id, start, size, exact


def benchmark_matches(docs: DataFrame, items: DataFrame, stages: Stages, window: int = WINDOW, slack: int = 0) -> Matches:
    """Every occurrence of every window of ``items`` in ``docs``."""
    index = build_index(docs, stages)
    windows = stages.keep(item_windows(items, window), "windows")
    phrases = stages.keep(windows.select("terms").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    of_items = windows.join(phrases, "terms").select("phrase", "item_id").distinct()
    found = stages.keep(search(index, phrases, stages, slack), "found")
    return Matches(index.documents(), found.join(of_items, "phrase").drop("phrase"))


def document_hits(matches: Matches) -> DataFrame:
    """(doc_id, n_words, n_hit, items, near_items) of every document: its words
    inside exact matches, the items with any, and those with proximity matches only."""
    row = ["segment", "place"]
    end = F.col("start") + F.col("size")
    spans = matches.found.filter("exact").select(*row, "start", end.alias("end")).distinct()
    before = F.max("end").over(Window.partitionBy(*row).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    hit = (spans.withColumn("from", F.greatest("start", F.coalesce(before, F.lit(0))))
           .groupBy(*row).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit")))
    listed = (matches.found.filter("item_id is not null").groupBy(*row, "item_id").agg(F.max("exact").alias("exact"))
              .groupBy(*row).agg(*[F.sort_array(F.collect_list(F.when(ok, F.col("item_id").cast("string")))).alias(name)
                                   for name, ok in (("items", F.col("exact")), ("near_items", ~F.col("exact")))]))
    none = F.array().cast("array<string>")
    return matches.documents.join(hit, row, "left").join(listed, row, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))


#: The same digests in DuckDB's SQL, window by window.
SQL = r"""
with docs as (
    select row_number() over () as row, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
cut as (select item_id, w, least(len(w), 10) as size, unnest(range(1, len(w) - least(len(w), 10) + 2)) as pos from items where len(w) > 0),
sought as (select distinct item_id, size, array_to_string(w[pos:pos + size - 1], ' ') as phrase from cut),
places as (select row, w, size, unnest(range(1, len(w) - size + 2)) as pos from docs, (select distinct size from sought) where len(w) >= size),
there as (select row, size, pos, array_to_string(w[pos:pos + size - 1], ' ') as phrase from places),
found as (select row, pos, size, item_id from there join sought using (size, phrase)),
hit as (select row, count(distinct word) as n_hit from (select row, unnest(range(pos, pos + size)) as word from found) group by row),
listed as (select row, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from found group by row)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (row) left join listed using (row)
"""
