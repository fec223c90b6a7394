"""Quality rules whose limits follow the corpus, in SQL expressions only.

Every document gets counts (words, symbols, repeated lines, repeated word
windows, loud letters). Each measure, as a whole percentage, is summed up per
language and source as a histogram: a quantile sketch of one-unit resolution
that merges by adding counts. A group with too few documents takes the merged
sketch of its language, a language with too few that of the corpus. A limit is
the median plus four times the distance from lower quartile to median (so up
to half of a group may be junk) plus a slack below which nothing is odd.

Cases: a null text has no words; no words or fewer than ten fail the base
rules; null languages and sources are groups like any other; repeated rows are
judged alike and counted each; with no rows there are no limits and no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import Stages

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LOUD = "ABCDEFGHIJKLMNOPQRSTUVWXYZ!"
WINDOW, MIN_WORDS, MAX_REPEAT = 5, 10, 20
#: Documents that a group needs for limits of its own; last bin of a histogram.
SUPPORT, LAST_BIN = 50, 2000
#: Whole-number measures: numerator, denominator, slack above the median.
MEASURES = {
    "symbols": ("100 * n_symbols", "n_words", 25),
    "repeats": ("100 * n_repeat_words", "n_words", 10),
    "dup_lines": ("100 * n_dup_lines", "n_lines", 40),
    "loud": ("100 * n_loud", "word_chars", 30),
    "word_length": ("10 * word_chars", "n_words", 60),
}


def _count_of(text, characters: str):
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame) -> DataFrame:
    """The counts of every row of ``docs`` (doc_id, text, lang, source)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("t"))
    rows = rows.select("*", F.array_remove(F.split("t", "[ \\t-\\r]+"), "").alias("w"),
                       F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"))
    rows = rows.select(
        "doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", WHITE, "")).cast("long").alias("word_chars"),
        _count_of(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"), _count_of(F.col("t"), LOUD).cast("long").alias("n_loud"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"""slice(transform(w, (x, i) -> struct(xxhash64(x, {', '.join(f'get(w, i + {k})' for k in range(1, WINDOW))}) as h, i as p)),
                         1, greatest(size(w) - {WINDOW - 1}, 0))""").alias("windows"))
    rows = rows.withColumn("windows", F.sort_array("windows"))
    rows = rows.withColumn("at", F.expr(
        "sort_array(transform(filter(transform(windows, (x, i) -> struct(x.p as p, x.h = get(windows, i - 1).h or x.h = get(windows, i + 1).h as twice)),"
        " x -> x.twice), x -> x.p))"))
    return rows.select("*", F.expr(
        f"aggregate(transform(at, (x, i) -> least({WINDOW}, coalesce(get(at, i + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x)")
        .alias("n_repeat_words")).drop("windows", "at")


def _bins():
    return {m: F.least(F.lit(LAST_BIN), F.floor(F.expr(top) / F.col(bottom))).cast("long") for m, (top, bottom, _) in MEASURES.items()}


def limits(rows: DataFrame) -> DataFrame:
    """(lang, source, <measure>_limit...) from the sketches of ``rows``, whose
    base rules passed."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), b.alias("bin")) for m, b in _bins().items()])
    fine = (rows.select("lang", "source", F.explode(pairs).alias("m")).select("lang", "source", "m.*")
            .groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n")))
    groups = fine.select("lang", "source").distinct()

    def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
        """Quartiles per group: the first bin that reaches each share."""
        within = "partition by " + ", ".join([*by, "measure"])
        run = sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n")).select(
            *by, "measure", "bin", F.expr(f"sum(n) over ({within} order by bin)").alias("upto"), F.expr(f"sum(n) over ({within})").alias("total"))
        return run.groupBy(*by, "measure").agg(
            F.max("total").alias("total"), F.expr("min(bin) filter (where 4 * upto >= total)").alias("q25"),
            F.expr("min(bin) filter (where 2 * upto >= total)").alias("q50"))

    def level(sketch: DataFrame, by: list[str], name: str) -> DataFrame:
        slack = F.create_map(*[F.lit(x) for m, (_, _, s) in MEASURES.items() for x in (m, s)])
        limit = F.col("q50") + 4 * (F.col("q50") - F.col("q25")) + slack[F.col("measure")]
        q = quartiles(sketch, by)
        if by:
            q = q.filter(F.col("total") >= SUPPORT)
        return q.groupBy(*by).agg(*[F.max(F.when(F.col("measure") == m, limit)).alias(f"{name}_{m}") for m in MEASURES])

    own = level(fine, ["lang", "source"], "own").withColumnsRenamed({"lang": "_l", "source": "_s"})
    language = level(fine, ["lang"], "lang").withColumnRenamed("lang", "_k")
    corpus = level(fine, [], "all")
    found = (groups.join(own, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
             .join(language, F.col("lang").eqNullSafe(F.col("_k")), "left"))
    everywhere = corpus.select(F.struct("*")).scalar()  # one row
    return found.select("lang", "source", *[F.coalesce(f"own_{m}", f"lang_{m}", everywhere[f"all_{m}"]).alias(f"{m}_limit") for m in MEASURES])


def judged(docs: DataFrame, stages: Stages) -> DataFrame:
    """Counts, base_failed and kept for every row of ``docs``."""
    rows = measured(docs).withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words"))
    rows = stages.keep(rows, "counts")
    found = limits(rows.filter("not base_failed")).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    fits = None
    for m, b in _bins().items():
        ok = F.coalesce(b <= F.col(f"{m}_limit"), F.lit(True))
        fits = ok if fits is None else fits & ok
    return (rows.join(found, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(True))))


#: The same rules for DuckDB, from windows of words row by row.
SQL = r"""
with t as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents),
w as (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from t),
win as (select r, unnest(range(1, greatest(len(w) - 3, 1))) as i, w from w),
win2 as (select r, i, count(*) over (partition by r, w[i:i+4]) as n from win),
cov as (select r, unnest([i, i+1, i+2, i+3, i+4]) as p from win2 where n > 1),
rep as (select r, count(distinct p) as n_repeat_words from cov group by r),
ln as (select r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
c as (select t.r, doc_id, lang, source, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
  length(t) - length(regexp_replace(t, '[A-Z!]', '', 'g')) as n_loud,
  len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from t join w using (r) join ln using (r) left join rep using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from c),
m as (select r, lang, source, 'symbols' as m, 25 as slack, least(2000, 100 * n_symbols // n_words) as bin from b where not base_failed
  union all select r, lang, source, 'repeats', 10, least(2000, 100 * n_repeat_words // n_words) from b where not base_failed
  union all select r, lang, source, 'dup_lines', 40, least(2000, 100 * n_dup_lines // n_lines) from b where not base_failed
  union all select r, lang, source, 'loud', 30, least(2000, 100 * n_loud // word_chars) from b where not base_failed
  union all select r, lang, source, 'word_length', 60, least(2000, 10 * word_chars // n_words) from b where not base_failed),
own as (select lang, source, m, count(*) as n, quantile_disc(bin, 0.5) as q50, quantile_disc(bin, 0.25) as q25 from m group by all),
byl as (select lang, m, count(*) as n, quantile_disc(bin, 0.5) as q50, quantile_disc(bin, 0.25) as q25 from m group by all),
al as (select m, quantile_disc(bin, 0.5) as q50, quantile_disc(bin, 0.25) as q25 from m group by all),
v as (select r, bool_and(bin <= slack + case when own.n >= 50 then 5 * own.q50 - 4 * own.q25
    when byl.n >= 50 then 5 * byl.q50 - 4 * byl.q25 else 5 * al.q50 - 4 * al.q25 end) as ok
  from m join own on m.m = own.m and m.lang is not distinct from own.lang and m.source is not distinct from own.source
  join byl on m.m = byl.m and m.lang is not distinct from byl.lang join al on m.m = al.m group by r)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed, not base_failed and coalesce(ok, true) as kept
from b left join v using (r)
"""
