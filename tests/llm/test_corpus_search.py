"""Periodic runs, the positional index and source divergence against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import awkward, collected, documents, prose
from tilth.llm import periodic_runs, positional_index, queries, source_divergence
from tilth.llm.common import Stages


# ---- periodic runs ------------------------------------------------------------
def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                run = w[i:j + q]
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_row(doc_id, text):
    words = plain_planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    runs = plain_runs(words)
    gone = {k for i, n, q in runs for k in range(i + q, i + n)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), start, length, period, 1000 * length // period if runs else None,
            digest("".join(f"{i},{n},{q}\n" for i, n, q in runs)), digest(" ".join(w for k, w in enumerate(words) if k not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 7), st.integers(0, 9)), max_size=5), min_size=1, max_size=4))
def test_scan_finds_the_runs_of_a_plain_search(parts):
    texts = [[x for base, times, cut in text for x in (base * times)[cut:]] for text in parts]
    codes = np.array([x for t in texts for x in t], np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    want, at = [], 0
    for t in texts:
        want += [(at + i, n, q) for i, n, q in plain_runs(t)]
        at += len(t)
    assert list(zip(*(x.tolist() for x in periodic_runs.scan(codes, owner)))) == want


def test_splitting_that_is_cut_short_changes_nothing(monkeypatch):
    rnd = random.Random(4)
    codes = np.array([x for _ in range(40) for x in ([rnd.randint(0, 30) for _ in range(rnd.randint(1, 12))] * rnd.randint(1, 6))], np.int64)
    owner = np.zeros(len(codes), np.int64)
    whole = periodic_runs.scan(codes, owner)
    monkeypatch.setattr(periodic_runs, "ROUNDS", 0)
    assert all((a == b).all() for a, b in zip(whole, periodic_runs.scan(codes, owner)))
    assert len(periodic_runs.surviving(np.arange(500), np.zeros(500, np.int64))) in (0, 500)


def test_query_of_runs_on_planted_and_awkward_texts(spark, folder):
    rows = [(i, prose(i, 90 + i), "en", "s") for i in range(60)]
    rows += [(100, "a " * 900, "en", "s"), (101, "x y " * 4 + "z " * 6, "en", "s"), (102, "x y " * 3, "en", "s"), (None, "no id " * 9, "en", "s"), (-3, "b c d " * 40, "en", "s")]
    docs = documents(spark, rows).unionByName(awkward(spark))
    docs.write.parquet(f"{folder}/documents.parquet")
    got = queries.op11_periodic_runs(spark, folder)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert got.columns == names
    assert collected(got, *names) == sorted((plain_row(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


# ---- positional index ---------------------------------------------------------
def test_matches_in_small_segments_equal_sql(spark, folder):
    items = [(i, prose(700 + i, n)) for i, n in enumerate((60, 12, 10, 9, 3, 1))] + [(20, None), (21, " .. "), (3, prose(703, 9)), (3, "repeated id"), (22, "The THE the")]
    rows = [(i, prose(i, 70), "en", "s") for i in range(40)]
    rows += [(100 + i, prose(i, 20) + " " + prose(700 + i % 6, (60, 12, 10, 9, 3, 1)[i % 6]) + "! " + prose(i + 1, 5), "en", "s") for i in range(30)]
    rows += [(300 + i, " ".join(prose(700, 60).split()[i::3]), "en", "s") for i in range(3)]  # some of the terms of many phrases
    rows += [(200, prose(700, 60)[:150], "en", "s"), (201, "the the the the", "en", "s"), (202, prose(700, 60) + " " + prose(700, 60), "en", "s")]
    docs = documents(spark, rows).unionByName(awkward(spark))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # a segment has no more rows
    got = queries.op12_positional_index(spark, folder)
    rows_got = collected(got, *got.columns)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    assert rows_got == sorted(con.sql(positional_index.SQL).project(", ".join(got.columns)).fetchall(), key=repr)
    hits = {r.doc_id: r.n_hit for r in got.collect()}
    assert hits[201] == 4 and hits[202] == 120 and hits[200] < 60


def test_proximity_matches_take_words_out_of_place(spark):
    passage = prose(900, 30).replace("\n", " ").split()
    near = passage[:5] + ["inserted"] + passage[5:]
    docs = documents(spark, [(1, " ".join(passage), "en", "s"), (2, " ".join(near[:12]), "en", "s"), (3, " ".join(passage[::-1]), "en", "s"), (4, prose(901, 40), "en", "s")])
    items = spark.createDataFrame([(7, " ".join(passage[:10])), (None, " ".join(passage[12:20]))], "item_id long, text string")
    matches = positional_index.benchmark_matches(docs, items, Stages(spark, "positions-test"), slack=positional_index.SLACK)
    got = {r.doc_id: r for r in positional_index.document_hits(matches).collect()}
    assert got[1].items == ["7"] and got[1].n_hit == 18 and got[1].near_items == []
    assert got[2].items == [] and got[2].near_items == ["7"] and got[2].n_hit == 0
    assert got[3].items == got[3].near_items == got[4].items == []
    exact = positional_index.benchmark_matches(docs, items, Stages(spark, "positions-test"))
    assert positional_index.document_hits(exact).filter("size(near_items) > 0").count() == 0
    assert positional_index.document_hits(positional_index.benchmark_matches(docs, items.limit(0), Stages(spark, "positions-test"))).filter("n_hit = 0").count() == 4
    assert positional_index.document_hits(positional_index.benchmark_matches(docs.limit(0), items, Stages(spark, "positions-test"))).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.sampled_from("abcd"), min_size=1, max_size=4), st.integers(0, 2))
def test_intersected_lists_find_phrases(words, phrase, slack):
    lists = {t: np.array([i for i, w in enumerate(words) if w == t], np.int64) for t in set(phrase)}
    order = sorted(range(len(phrase)), key=lambda k: (len(lists[phrase[k]]), k))
    got = positional_index.starts(lists.__getitem__, [phrase[k] for k in order], order, slack)
    rare = order[0]
    want = [i - rare for i, w in enumerate(words) if w == phrase[rare]
            and all(any(0 <= i - rare + k + d < len(words) and words[i - rare + k + d] == t for d in range(-slack, slack + 1)) for k, t in enumerate(phrase) if k != rare)]
    assert got.tolist() == want


# ---- source divergence --------------------------------------------------------
def test_divergences_equal_sql_on_awkward_tables(spark, folder):
    rows = [(i, " ".join(random.Random(i).choices("alder Birch cedar elm naïve 漢字 fir d3e ivy".split(), k=3 + i % 9)), ("en", "de", None)[i % 3], f"s{i % 5}") for i in range(150)]
    rows += [(900, "7 8", "en", "wordless"), (901, None, "xx", "a"), (902, "", "xx", None), (903, "rare", "xx", "b"), (904, "x " * 5000, "en", "s1"), (904, "x " * 5000, "en", "s1")]
    docs = documents(spark, rows).unionByName(awkward(spark))
    docs.write.parquet(f"{folder}/documents.parquet")
    got = queries.op13_source_divergence(spark, folder)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert collected(got, *got.columns) == sorted(con.sql(source_divergence.SQL).project(", ".join(got.columns)).fetchall(), key=repr)
    assert source_divergence.divergences(docs.limit(0), Stages(spark, "divergence-test")).count() == 0
    few = source_divergence.divergences(docs, Stages(spark, "divergence-test"), min_docs=10 ** 6)
    assert {r.value for r in few.collect()} == {0} and few.filter("part = 'term'").count() == 0


def test_count_vectors_are_exact():
    import pyarrow as pa

    from tilth.llm.words import LETTERS, word_slices

    texts = ["b a B", None, "", "é a-b9a"]
    (_, words), = word_slices(pa.array(texts), LETTERS)
    text, term, n = source_divergence.count_vectors(words)
    spelled = [x.decode() for x in words.spelled.to_pylist()]
    assert Counter({(t, spelled[k]): c for t, k, c in zip(text.tolist(), term.tolist(), n.tolist())}) == {(0, "a"): 1, (0, "b"): 2, (3, "a"): 2, (3, "b"): 1, (3, "é"): 1}
