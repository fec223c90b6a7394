"""Rules and classifier: counts against brute force, and who is kept."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import awkward, collected, documents, prose
from tilth.llm import adaptive_rules, quality_bayes
from tilth.llm.common import Stages


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), base)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_of_odd_texts(spark):
    rnd = random.Random(2)
    parts = ["a", "b", "c d", " ", "\n", "\t", "\x0b", "é", "漢字", "#*", "|", "\xa0", "\x1c", "word word", "\n\n"]
    rows = [(i, " ".join(rnd.choices(parts, k=rnd.randint(0, 40))), "en", "s") for i in range(150)]
    docs = documents(spark, rows).unionByName(awkward(spark))
    got = adaptive_rules.judged(docs, Stages(spark, "rules-test"))
    want = [(d, *plain_counts(t)) for d, t in docs.select("doc_id", "text").collect()]
    assert collected(got, "doc_id", *COUNTS) == sorted(want, key=repr)
    assert got.filter("base_failed and kept").count() == 0
    assert adaptive_rules.judged(docs.limit(0), Stages(spark, "rules-test")).count() == 0


def test_rules_agree_with_sql_and_spare_the_clean(spark):
    rows = [(i, prose(i, 60), "en" if i % 3 else None, f"s{i % 4}") for i in range(240)]
    rows += [(500 + i, " ".join(w + "###" for w in prose(i, 60).split()), "en", "s1") for i in range(40)]
    rows += [(600 + i, prose(i, 60).upper().replace(" ", "!! "), "en", "s2") for i in range(40)]
    docs = documents(spark, rows)
    got = adaptive_rules.judged(docs, Stages(spark, "rules-test"))
    kept = {r.doc_id for r in got.filter("kept").collect()}
    assert kept == set(range(240))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert {r[0] for r in con.sql(f"select doc_id from ({adaptive_rules.SQL}) where kept").fetchall()} == kept


def corpus(spark):
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = " | ".join(prose(i, 40).split()) if bad else prose(i, 60)
        rows.append((i, text, "en", f"http://host{i % 7}/p{i % 2}/x"))
        if i % 2:
            labels.append((i, int(not bad), 0))
    labels += [(5, None, 0), (None, 1, 0), (1, 1, 0)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    got = quality_bayes.document_quality(docs, labels, Stages(spark, "quality-test")).collect()
    held_out = [r for r in got if r.doc_id % 2 == 0]
    right = sum(r.kept == (r.doc_id % 5 != 0) for r in held_out)
    assert right == len(held_out)
    kept = quality_bayes.keep_good(docs, labels, Stages(spark, "quality-test"))
    assert kept.columns == docs.columns
    assert collected(kept, *docs.columns) == collected(docs.filter("doc_id % 5 <> 0"), *docs.columns)


def test_classifier_cases(spark):
    docs, labels = awkward(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_bayes.keep_good(docs, labels, Stages(spark, "quality-test"))
    assert collected(got, *docs.columns) == collected(docs, *docs.columns)
    alike = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_bayes.document_quality(docs, alike, Stages(spark, "quality-test")).filter("kept").count() == docs.count()
    assert quality_bayes.document_quality(docs.limit(0), labels, Stages(spark, "quality-test")).count() == 0


def test_sparse_sites_move_toward_the_prior(spark):
    rows = [("big", "p", 0.9)] * 300 + [("poor", "p", 0.05)] * 300 + [("tiny", "p", 0.05)] + [("big", "q", 0.05)]
    found, mean = quality_bayes.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"), Stages(spark, "quality-test"))
    at = {(r.host, r.path): r for r in found.collect()}
    assert abs(at["big", "p"].host_posterior - 0.9) < 0.01 and abs(at["poor", "p"].path_posterior - 0.05) < 0.01
    assert 0.05 < at["tiny", "p"].host_posterior < mean
    assert at["big", "q"].path_posterior > 0.3  # one bad page of a good host


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_fit_separates_what_a_feature_separates(seed):
    rnd = np.random.default_rng(seed)
    x = rnd.standard_normal((200, len(quality_bayes.FEATURES)))
    y = (x[:, 2] > 0).astype(float)
    model = quality_bayes.fit(x, y)
    assert (((x @ np.array(model.weights) + model.offset) > 0) == (y > 0)).mean() > 0.95
