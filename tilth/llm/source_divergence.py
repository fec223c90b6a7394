"""How far the sources of a language are apart in their vocabulary.

A slice of documents becomes exact sparse count vectors (document by term), and
these are summed per (language, source) at once, as a count vectorizer and a
summarizer of vectors would do it. The vocabulary of a language, all terms in
at least ``min_docs`` of its documents with no limit to its size, is a column of
the joined sums and never an array in one place. Each group gives a term
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), whole numbers throughout; two
distributions differ in a term by floor((p - q)^2 / (p + q)).

Pairs of sources are evaluated sparsely. Most terms are missing from most
sources and have there the same p; so the sum over all V terms is put together
from the terms of either side against the other's p of a missing term (by
histogram of counts), a correction for terms of both, and V less their union
times the difference of the missing.

Cases: null text, language and source are empty strings; a group without terms
still has its rows; a language without kept terms has pairs of value 0; repeated
rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilth.llm.common import Stages
from tilth.llm.words import LETTERS, Words, word_slices

MIN_DOCS, TOP, SCALE, PRIOR = 10, 10, 1_000_000_000, 2
GROUP = ["lang", "source"]


def count_vectors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count): the sparse count vectors of texts, one after another."""
    many = len(words.spelled)
    keys = np.sort(words.text * many + words.codes)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    text, term = np.divmod(keys[first], max(many, 1))
    return text, term, np.diff(first, append=len(keys))


def group_sums(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): vectors of ``docs`` summed per group and
    slice, and how many documents have the term."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources = (batch.column(i).dictionary_encode() for i in (1, 2))
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            for at, words in word_slices(batch.column(0), LETTERS):
                text, term, n = count_vectors(words)
                if not len(n):
                    continue
                keys = group[at + text] * len(words.spelled) + term
                order = np.argsort(keys)
                first = np.flatnonzero(np.diff(keys[order], prepend=-1))
                of, term = np.divmod(keys[order][first], len(words.spelled))
                lang, source = np.divmod(of, len(sources.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(lang)), sources.dictionary.take(pa.array(source)),
                     words.spelled.cast(pa.string()).take(pa.array(term)),
                     pa.array(np.add.reduceat(n[order], first)), pa.array(np.diff(first, append=len(order)))],
                    ["lang", "source", "term", "n", "docs"])

    cleaned = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", *GROUP)])
    return cleaned.mapInArrow(read, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, lang_n, head): counts of the terms each language
    keeps; ``head`` marks one row of each term."""
    sums = group_sums(docs).groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return (sums.withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term),
                              "head": F.row_number().over(term.orderBy("source")) == 1})
            .filter(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"))


def _share(count: str, total: str, terms: str):
    """p of a count, exactly: the product may exceed 64 bits."""
    return F.expr(f"1 + ({SCALE} * cast({count} + {PRIOR} as decimal(20,0))) div cast({total} + {PRIOR} * {terms} as decimal(20,0))")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total, vocabulary, missing) of every
    group that occurs; ``missing`` is its p of a term it has not."""
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in GROUP]).distinct()
    own = kept.groupBy(*GROUP).agg(F.sum("n").alias("total"), F.count("*").alias("terms"), F.sum(F.col("head").cast("long")).alias("heads"))
    by_lang = Window.partitionBy("lang")
    known = groups.join(own, GROUP, "left").fillna(0, ["total", "terms", "heads"])
    known = known.withColumns({"lang_total": F.sum("total").over(by_lang), "vocabulary": F.sum("heads").over(by_lang)}).drop("heads")
    return known.withColumn("missing", F.when(F.col("vocabulary") > 0, _share("0", "total", "vocabulary")).otherwise(F.lit(0)))


def term_rows(shares: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that a source uses more than its language does, by difference."""
    rank = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return (shares.filter("p > q").select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_apart("p", "q")).alias("value"))
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top))


def pair_rows(shares: DataFrame, totals: DataFrame) -> DataFrame:
    """Every other source of a source's language, by difference over all terms."""
    a = totals.select("lang", "source", "terms", "vocabulary", "missing")
    b = a.select("lang", F.col("source").alias("item"), F.col("terms").alias("item_terms"), F.col("missing").alias("item_missing"))
    pairs = a.join(b, "lang").filter("source <> item")
    # What terms of one side differ from the other side's missing ones, a count at a time.
    seen = shares.groupBy(*GROUP, "p").agg(F.count("*").alias("many"))
    other = b.withColumnRenamed("item_missing", "z").select("lang", "item", "z")
    alone = (seen.join(other, "lang").filter("source <> item")
             .groupBy(*GROUP, "item").agg(F.expr(f"sum(many * {_apart('p', 'z')})").alias("alone")))
    # Terms of both sides, less what each side has been counted for.
    right = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q2"), F.col("missing").alias("z2"))
    both = (shares.select("lang", "term", "source", F.col("p").alias("p1"), F.col("missing").alias("z1")).join(right, ["lang", "term"])
            .filter("source < item").groupBy("lang", "source", "item")
            .agg(F.count("*").alias("common"), F.expr(f"sum({_apart('p1', 'q2')} - {_apart('p1', 'z2')} - {_apart('q2', 'z1')})").alias("both")))
    both = both.union(both.select("lang", F.col("item"), F.col("source"), "common", "both"))
    turned = alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("alone").alias("back"))
    value = F.expr(f"""coalesce(alone, 0) + coalesce(back, 0) + coalesce(both, 0)
                       + if(vocabulary = 0, 0, (vocabulary - terms - item_terms + coalesce(common, 0)) * {_apart('missing', 'item_missing')})""")
    key = [*GROUP, "item"]
    rank = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return (pairs.join(alone, key, "left").join(turned, key, "left").join(both, key, "left")
            .select(*GROUP, F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", F.row_number().over(rank)))


def divergences(docs: DataFrame, stages: Stages, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): the pairs and telling terms of
    every source of ``docs`` (text, lang, source)."""
    kept = stages.keep(kept_terms(docs, min_docs), "kept")
    totals = stages.keep(group_totals(docs, kept), "totals")
    shares = kept.join(totals.select(*GROUP, "total", "vocabulary", "lang_total", "missing"), GROUP).select(
        *GROUP, "term", _share("n", "total", "vocabulary").alias("p"), _share("lang_n", "lang_total", "vocabulary").alias("q"), "missing")
    return pair_rows(shares, totals).union(term_rows(shares, top))


#: The same rows in DuckDB's SQL, term by term over whole vocabularies.
SQL = r"""
with words as (
    select doc, lang, source, unnest(terms) as term from (
        select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents)),
sums as (select lang, source, term, count(*) as n, count(distinct doc) as docs from words group by all),
vocabulary as (select lang, term, sum(n) as n from sums group by all having sum(docs) >= 10),
groups as (select distinct coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
totals as (select lang, source, coalesce((select sum(n) from sums semi join vocabulary using (lang, term) where sums.lang = groups.lang and sums.source = groups.source), 0) as total,
                  (select count(*) from vocabulary v where v.lang = groups.lang) as v from groups),
shares as (
    select g.lang, g.source, w.term, coalesce(s.n, 0) as n,
           (1 + (1000000000::hugeint * (coalesce(s.n, 0) + 2)) // (g.total + 2 * g.v))::bigint as p,
           (1 + (1000000000::hugeint * (w.n + 2)) // (sum(w.n) over (partition by g.lang, g.source) + 2 * g.v))::bigint as q
    from totals g join vocabulary w on w.lang = g.lang left join sums s on s.lang = g.lang and s.source = g.source and s.term = w.term),
pairs as (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
every as (select a.lang, a.source, b.source as item from groups a join groups b on a.lang = b.lang and a.source <> b.source),
found as (
    select lang, source, 'pair' as part, item, coalesce(value, 0)::bigint as value from every left join pairs using (lang, source, item)
    union all
    select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from shares where n > 0 and p > q)
select lang, source, part, item, value, rank from (
    select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from found)
where part = 'pair' or rank <= 10
"""
