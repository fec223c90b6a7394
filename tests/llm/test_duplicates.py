"""Near-duplicate operators against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.helpers import awkward, collected, documents, prose, smallest_reachable
from tilth.llm import compact_windows, embedding_lsh, line_dedup, simhash
from tilth.llm.common import Stages, components


# ---- components ---------------------------------------------------------------
def test_components_of_paths_stars_and_loops(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(900, i) for i in range(300, 360)] + [(7, 7), (None, 3), (5, None)]
    edges += [(rnd.randint(1000, 1100), rnd.randint(1000, 1100)) for _ in range(70)] + [(-5, 160), (100, -5)]
    real = [(a, b) for a, b in edges if a is not None and b is not None]
    ids = sorted({x for e in real for x in e})
    place = {x: i for i, x in enumerate(ids)}
    want = sorted(zip(ids, smallest_reachable(ids, [(place[a], place[b]) for a, b in real])), key=repr)
    got = components(spark.createDataFrame(edges, "a long, b long"), Stages(spark, "components-test"))
    assert collected(got, "node", "component") == want
    assert components(spark.createDataFrame([], "a long, b long"), Stages(spark, "components-test")).count() == 0


# ---- SimHash ------------------------------------------------------------------
def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_groups(spark):
    base = prose(1, 300)
    rows = [(i, base.replace(base.split()[5 * i], "changed", 1), "en", "s") for i in range(1, 40)]
    rows += [(100 + i, prose(i, 60), "en", "s") for i in range(20)] + [(50, base, "en", "s"), (51, base, "en", "s"), (52, "", "en", "s"), (53, None, "en", "s")]
    got = simhash.simhash_groups(documents(spark, rows), Stages(spark, "simhash-test")).select(
        "doc_id", simhash.hexed(simhash.F.col("fp")).alias("fingerprint"), "component_id").collect()
    rows.sort()
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    want = list(zip([r[0] for r in rows], [f"{p:016x}" for p in prints], smallest_reachable([r[0] for r in rows], links)))
    assert sorted(map(tuple, got)) == want


def test_links_of_short_and_long_lists(spark, monkeypatch):
    rnd = random.Random(2)
    centre = rnd.getrandbits(64)
    near = {centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(150)}
    far = {rnd.getrandbits(64) for _ in range(100)}
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in near | far})
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count() <= 2]
    want = {x: c for x, c in zip(fps, smallest_reachable(fps, links))}
    for longest in (2, 8, 1000):
        monkeypatch.setattr(simhash, "LONG_LIST", longest)
        found = simhash.near_links(table, Stages(spark, "simhash-test"))
        groups = {r.node: r.component for r in components(found, Stages(spark, "simhash-test")).collect()}
        assert {x: groups.get(x, x) for x in fps} == want


def test_two_pairs_of_bytes_escape_any_two_positions():
    for i in range(8):
        for j in range(8):
            changed = 0xFF << 8 * i | 0xFF << 8 * j
            assert any(not m & changed for m in simhash.MASKS)


def test_one_document_of_each_group(spark):
    docs = awkward(spark).unionByName(documents(spark, [(20, prose(3, 120), "en", "z"), (8, prose(3, 120), "en", "a")]))
    got = simhash.one_of_each_group(docs, Stages(spark, "simhash-test"))
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted([1, 3, 5, 7, 8, None], key=repr)
    assert simhash.one_of_each_group(docs.limit(0), Stages(spark, "simhash-test")).count() == 0


def test_rows_that_repeat_a_doc_id_are_decided_by_their_texts(spark):
    texts = {k: prose(60 + k, 90) for k in range(4)}
    docs = documents(spark, [(2, texts[0], "en", "a"), (5, texts[0], "en", "b"), (5, texts[1], "en", "c"), (7, texts[1], "en", "d"),
                             (None, texts[2], "en", "e"), (None, texts[3], "en", "f"), (9, texts[3], "en", "g"), (11, None, "en", "h"), (12, None, "en", "h")])
    docs = docs.withColumn("extra", simhash.F.create_map(simhash.F.lit("k"), simhash.F.col("doc_id"))).withColumn("group", simhash.F.lit(1))
    got = simhash.one_of_each_group(docs, Stages(spark, "simhash-test"))
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.source) for r in got.collect()), key=repr) == sorted([(2, "a"), (5, "c"), (None, "e"), (9, "g"), (11, "h")], key=repr)


# ---- embeddings -----------------------------------------------------------------
def test_embedding_links_counts_and_components(spark):
    rnd = np.random.default_rng(1)
    centres = rnd.standard_normal((12, 16))
    near = [c + 0.12 * rnd.standard_normal(16) * np.linalg.norm(c) / 4 for c in centres for _ in range(12)]
    hot = [centres[0] + 0.02 * rnd.standard_normal(16) for _ in range(700)]
    vectors = [v.astype(np.float32).tolist() for v in [*near, *hot, *rnd.standard_normal((100, 16))]]
    vectors += [vectors[0], vectors[0], [2 * x for x in vectors[1]], None, [], [0.0] * 16, [float("nan")] * 16, [1.0] * 15 + [None],
                [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e300] * 3, [2e300] * 3, [-0.0, 1.0], [0.0, 1.0]]
    ids = [3 * i + 1 for i in range(len(vectors))]
    df = spark.createDataFrame(list(zip(ids, vectors, ids)), "vec_id long, embedding array<double>, id long")
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    unit = [np.array(v) / np.abs(v).max() if u else None for v, u in zip(vectors, usable)]
    unit = [v / np.linalg.norm(v) if v is not None else None for v in unit]
    links = []
    by_size: dict = {}
    for i, v in enumerate(unit):
        if v is not None:
            by_size.setdefault(len(v), []).append(i)
    for at in by_size.values():
        m = np.stack([unit[i] for i in at])
        links += [(at[a], at[b]) for a, b in zip(*np.nonzero(np.triu(m @ m.T >= 0.95, 1)))]
    counts = np.bincount(np.array(links).ravel(), minlength=len(ids))
    groups = smallest_reachable(ids, links)
    got = embedding_lsh.near_embeddings(df, Stages(spark, "embeddings-test"), 0.95, miss=1e-6)
    want = [(i, int(n), c, i == c) for i, n, c in zip(ids, counts, groups)]
    assert collected(got, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)
    assert embedding_lsh.near_embeddings(df.limit(0), Stages(spark, "embeddings-test")).count() == 0


# ---- lines ------------------------------------------------------------------------
@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=30), st.text("abc ", max_size=30))
def test_edit_distance_is_the_textbooks(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    assert line_dedup.edit_distance(a, b) == row[-1]
    assert (line_dedup.edit_distance(a, b, 3) <= 3) == (row[-1] <= 3)
    assert line_dedup.similar(a, b) == (row[-1] <= int(0.2 * max(len(a), len(b)) + 1e-9))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab cd e fgh ij klm n op".split()), max_size=9), st.lists(st.sampled_from("ab cd e fgh ij klm n op".split()), max_size=9))
def test_anchors_never_promise_too_little(x, y):
    assert line_dedup.anchored_distance(x, y, 1000) >= line_dedup.edit_distance(" ".join(x), " ".join(y))


def test_majority_of_five():
    rnd = random.Random(1)
    five = [np.array([rnd.getrandbits(64)], np.uint64) for _ in range(5)]
    want = sum(1 << b for b in range(64) if sum(int(x[0]) >> b & 1 for x in five) >= 3)
    assert int(line_dedup._majority(*five)[0]) == want


def normal(line):
    return " ".join(re.sub(r"[^a-z0-9\x80-\U0010ffff]+", " ", line.lower()).split())


def test_lines_keep_one_of_each_group(spark):
    rnd = random.Random(8)
    lines = {k: [w for w in prose(k, 30).replace("\n", " ").replace(".", "").split()] for k in range(40)}
    rows = []
    for d in range(120):
        out = []
        for _ in range(4):
            words = list(lines[rnd.randrange(40)])
            if rnd.random() < 0.6:
                words[rnd.randrange(30)] = "changed" + str(rnd.randrange(9))
            out.append(" ".join(words).capitalize() + "!")
        rows.append((d, "\n".join([*out, "short line", ""]), "en", "s"))
    got = line_dedup.line_groups(documents(spark, rows), Stages(spark, "lines-test")).collect()
    places = [(d, n, normal(x)) for d, t, *_ in rows for n, x in enumerate(t.split("\n")) if len(normal(x).split()) >= 5]
    links = [(i, j) for i in range(len(places)) for j in range(i) if line_dedup.similar(places[i][2], places[j][2])]
    want = smallest_reachable([p[:2] for p in places], links)
    assert sorted((r.doc_id, r.line_no, (r.keeper_doc_id, r.keeper_line_no), r.kept) for r in got) == sorted(
        (d, n, k, k == (d, n)) for (d, n, _), k in zip(places, want))


def test_hot_lists_of_lines_are_compared_in_chunks(spark):
    base = prose(4, 40).replace("\n", " ").split()
    rows = []
    for d in range(line_dedup.CHUNK * 2 + 50):  # all near one another, all different
        words = list(base)
        words[20 + d % 20] = f"other{d}"
        rows.append((d, " ".join(words), "en", "s"))
    got = line_dedup.line_groups(documents(spark, rows), Stages(spark, "lines-test"))
    assert got.filter("kept").count() == 1 and got.filter("keeper_doc_id = 0").count() == len(rows)


def test_rows_to_compare_are_few_and_without_the_blocks_of_their_lines(spark):
    n = 1500
    lines = spark.range(n).selectExpr("id as line", f"array(named_struct('block', 7L, 'n', {n}), named_struct('block', 9L + id % 2, 'n', {n // 2})) as held",
                                      "concat('some words of line ', lpad(id, 5, '0')) as text")
    rows, _ = line_dedup.compared_rows(lines, Stages(spark, "lines-test"))
    assert "blocks" not in rows.columns and rows.count() == 2 * n and rows.filter("least <> 7").count() == 0


def test_products_of_matrices_lose_no_pair_in_reach(monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdé ", k=rng.randint(1, 40))) for _ in range(60)] + ["aaaa", "aaaaa", "x"]
    texts += ["".join(rng.choice("abé") if rng.random() < 0.15 else c for c in t) + "a" * rng.randint(0, 2) for t in texts]
    monkeypatch.setattr(line_dedup, "TILE", 16)
    lengths = np.array([len(t) for t in texts])
    found = [(i, j) for x, y in line_dedup._allowed_pairs(np.zeros(len(texts), np.int64), lengths, texts) for i, j in zip(x.tolist(), y.tolist())]
    near = {(i, j) for i in range(len(texts)) for j in range(i) if line_dedup.similar(texts[i], texts[j])}
    assert len(found) == len(set(found)) < len(texts) ** 2 / 3
    assert len(near) >= 40 and near <= {(max(p), min(p)) for p in found}


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark)
    got = line_dedup.drop_repeated_lines(docs, Stages(spark, "lines-test"))
    assert got.columns == docs.columns and got.count() == docs.count()
    assert {r.doc_id: r.text for r in got.filter("doc_id in (1, 2, 3, 6, 7)").collect()} == {
        r.doc_id: r.text for r in docs.filter("doc_id in (1, 2, 3, 6, 7)").collect()}
    again = documents(spark, [(1, "the very same line of words\nother", "en", "s"), (2, "The very  same line of words.", "en", "s"), (None, "the very same line of words", "en", "s")])
    assert {r.doc_id: (r.text, r.n_chars) for r in line_dedup.drop_repeated_lines(again, Stages(spark, "lines-test")).collect()} == {
        1: ("the very same line of words\nother", 33), 2: ("", 0), None: ("", 0)}
    assert line_dedup.drop_repeated_lines(docs.limit(0), Stages(spark, "lines-test")).count() == 0


def test_short_lines_group_whether_equal_or_near(spark):
    lines = ["Home", "home!", "All rights reserved", "All rights reserve", "hone", "x", "X", "?!"]
    rows = [(i, line, "en", "s") for i, line in enumerate(lines)]
    got = line_dedup.line_groups(documents(spark, rows), Stages(spark, "lines-test"), least_words=1)
    assert collected(got, "doc_id", "keeper_doc_id", "kept") == [
        (0, 0, True), (1, 0, False), (2, 2, True), (3, 2, False), (4, 4, True), (5, 5, True), (6, 5, False)]
    out = line_dedup.drop_repeated_lines(documents(spark, rows), Stages(spark, "lines-test"))
    assert {r.doc_id for r in out.filter("text = ''").collect()} == {1, 3, 6}


def test_no_near_pair_of_short_lines_is_without_a_block():
    rnd = random.Random(4)
    for _ in range(400):
        a = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(5, 50)))
        b = list(a)
        for _ in range(len(a) // 5):
            k, c = rnd.randrange(len(b)), rnd.choice("ijkl")
            b[k:k + 1] = rnd.choice(([c], [], [c, b[k]]))
        b = "".join(b)
        if line_dedup.similar(a, b):
            _, words = line_dedup.normalised_lines(pa.array([a + "\n" + b], pa.large_string()))
            row, block, _ = line_dedup.line_blocks(words)
            assert set(block[row == 0]) & set(block[row == 1]), (a, b)


def test_lines_of_few_words_meet_on_a_window_whatever_words_are_touched():
    rnd = random.Random(9)
    for n, k in ((6, 1), (7, 2), (9, 3), (10, 3), (14, 5), (16, 3), (20, 3)):
        for _ in range(25):
            a = prose(rnd.randrange(10 ** 9), n).replace("\n", " ").replace(".", "").split()
            b = list(a)
            for i in rnd.sample(range(n), k):
                b[i] = "0" + b[i][1:]
            texts = pa.array([" ".join(a) + "\n" + " ".join(b)], pa.large_string())
            row, block, _ = line_dedup.line_blocks(line_dedup.normalised_lines(texts)[1])
            assert set(block[row == 0]) & set(block[row == 1]), (a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc dé漢", max_size=30), min_size=2, max_size=6))
def test_no_bound_exceeds_the_edit_distance(texts):
    ones, twos = line_dedup.letter_counts(texts)
    bounds = line_dedup.least_distances(ones, twos, np.arange(len(texts)), 0)
    assert all(b <= line_dedup.edit_distance(t, texts[0]) for b, t in zip(bounds.tolist(), texts))


@settings(deadline=None)
@given(st.lists(st.tuples(*[st.text("ab 1é日", min_size=1, max_size=140)] * 2), min_size=1, max_size=12))
def test_distances_by_class_are_bounds_and_exact_in_ascii(pairs):
    by_words = {}
    for a, b in pairs:
        by_words.setdefault((len(a) + 63) // 64, []).append((a, b))
    for some in by_words.values():
        for (a, b), found in zip(some, line_dedup.class_distances(*map(list, zip(*some))).tolist()):
            exact = line_dedup.edit_distance(a, b)
            assert found <= exact and (found == exact or not (a + b).isascii())


def test_many_pairs_at_once_lose_none_in_reach():
    rng = random.Random(5)
    texts = ["".join(rng.choices("abcdef ", k=rng.randint(50, 64))) for _ in range(60)]
    texts += ["".join(rng.choice("abc") if rng.random() < 0.15 else c for c in t) for t in texts]
    texts += ["x" * 2000, "y" * 2000]  # too long: left to the exact check
    i, j = (np.array(x) for x in zip(*[(a, b) for a in range(len(texts)) for b in range(a)]))
    lengths = np.array([len(t) for t in texts])
    room = (0.2 * np.maximum(lengths[i], lengths[j])).astype(np.int64)
    found = line_dedup.within_reach(texts, lengths, i, j, room)
    exact = np.array([line_dedup.edit_distance(texts[a], texts[b]) for a, b in zip(i.tolist(), j.tolist())]) <= room
    short = np.maximum(lengths[i], lengths[j]) < 2000
    assert (found == exact)[short].all() and found[~short].all() and exact[short].sum() >= 30 and not found.all()


def test_pairs_of_all_lengths_are_within_their_room_or_not(monkeypatch):
    monkeypatch.setattr(line_dedup, "FEW", 1)
    monkeypatch.setattr(line_dedup, "WORDS_AT_ONCE", 300)
    rng = random.Random(21)
    letters = "abcdefgh ij klmnop é" + "".join(chr(0x4E00 + k) for k in range(150))
    texts = []
    for k in range(300):
        signs = letters if k % 3 == 0 else letters[:20]
        a = "".join(rng.choices(signs, k=int(2 ** rng.uniform(0, 10))))
        b = "".join(rng.choice((c + "a", "", "b")) if rng.random() < (k % 10) / 20 else c for c in a)
        texts += [a, b or "a"]
    lengths = np.array([len(t) for t in texts])
    i, j = np.arange(0, len(texts), 2), np.arange(1, len(texts), 2)
    room = line_dedup.rooms(lengths, i, j)
    near = abs(lengths[i] - lengths[j]) <= room
    i, j, room = i[near], j[near], room[near]
    found, sure = line_dedup.reach_and_sure(texts, lengths, i, j, room)
    exact = np.array([line_dedup.edit_distance(texts[a], texts[b]) for a, b in zip(i.tolist(), j.tolist())]) <= room
    assert (found == exact)[sure].all() and found[exact].all() and (found & ~exact).sum() < (~sure).sum()
    assert 50 <= exact.sum() <= len(exact) - 50 and sure.sum() >= 150


def test_a_pair_that_meets_on_many_blocks_is_compared_once(monkeypatch):
    calls, similar = [], line_dedup.similar
    monkeypatch.setattr(line_dedup, "similar", lambda a, b: calls.append((a, b)) or similar(a, b))
    words = [f"word{k}" for k in range(300)]
    texts = [" ".join(words), " ".join(reversed(words)), " ".join(words[:-1] + ["other"])]
    keys = np.repeat([[b, 0, 0] for b in (5, 6, 7, 8)], 3, axis=0)
    links = line_dedup.linked_lines(keys, np.zeros(12, np.int64), np.tile([1, 2, 3], 4), np.tile([1, 2, 3], 4), texts * 4)
    assert links == [(3, 1)] and 2 <= len(calls) == len(set(calls)) <= 3


def test_runs_of_rows_taken_together_stay_whole():
    batches = [pa.RecordBatch.from_arrays([pa.array([k // 3] * 5)], ["block"]) for k in range(30)]
    rows = [b.column(0).to_pylist() for b in line_dedup.gathered(line_dedup.whole_runs(iter(batches), 1))]
    assert rows == [[k // 3 for k in range(30) for _ in range(5)]]


def test_lines_with_letters_touched_in_many_words_are_linked(spark):
    rnd = random.Random(12)
    lines = ["漢字漢字仮名交文章例", "漢字漢字仮名交文章列", "to be or no to be or no", "to be or no to be or on"]
    for k in range(20):
        a = prose(700 + k, 12).replace("\n", " ").replace(".", "").split()
        b = [w if i in (2, 5, 8, 9) else "0" + w[1:] if i % 2 else w[:-1] + "1" for i, w in enumerate(a)]
        lines += [" ".join(a), " ".join(b)]
    near = [i for i in range(0, len(lines), 2) if line_dedup.similar(lines[i], lines[i + 1])]
    assert len(near) >= 20
    got = line_dedup.line_groups(documents(spark, [(i, t, "en", "s") for i, t in enumerate(lines)]), Stages(spark, "lines-test"), least_words=1)
    assert {(r.doc_id, r.keeper_doc_id) for r in got.filter("not kept").collect()} == {(i + 1, i) for i in near}


def test_rows_without_or_with_repeated_ids_lose_no_line_of_their_own(spark):
    same, near, other = "the very same line of words", "the very same lime of words", "a line that nothing else has at all"
    rows = [(1, same, "en", "a"), (None, same + "\nkept first", "en", "b"), (None, other + "\nkept second", "en", "c"),
            (5, "quite another beginning here\n" + near, "en", "d"), (5, "unlike in every respect", "en", "e"),
            (None, "only in null documents, nearly twice", "en", "f"), (None, "more\nonly in null documents, nearly twine", "en", "g")]
    out = line_dedup.drop_repeated_lines(documents(spark, rows), Stages(spark, "lines-test"))
    got = {r.source: r.text for r in out.collect()}
    assert {k: got[k] for k in "abcde"} == {"a": same, "b": "kept first", "c": other + "\nkept second", "d": "quite another beginning here", "e": "unlike in every respect"}
    assert (got["f"], got["g"]) == ("only in null documents, nearly twice", "more")


# ---- passages -----------------------------------------------------------------------
def plain_windows(values, width):
    out = []
    for c, v in enumerate(values):
        left = c
        while left > 0 and values[left - 1] > v:
            left -= 1
        right = c
        while right + 1 < len(values) and values[right + 1] > v:
            right += 1
        if right - left + 1 >= width:
            out.append((c, left, right))
    return out


def test_windows_are_the_cartesian_trees():
    rnd = random.Random(6)
    values, text = [], []
    for t, n in enumerate((200, 10, 46, 45, 500)):
        values += [rnd.getrandbits(40) << 24 for _ in range(n)]
        text += [t] * n
    v = np.array(values, np.uint64) | np.arange(len(values), dtype=np.uint64)
    text = np.array(text)
    first = np.array([int(np.flatnonzero(text == t)[0]) for t in range(5)])
    last = np.array([int(np.flatnonzero(text == t)[-1]) for t in range(5)])
    want = [(c + f, left + f, right + f) for f, l in zip(first.tolist(), last.tolist())
            for c, left, right in plain_windows(values[f:l + 1], compact_windows.WIDTH)]
    assert sorted(zip(*compact_windows.compact_windows(v, text, first, last))) == sorted(want)


def shingle_set(words):
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def test_planted_passages_are_found_and_nothing_else(spark):
    shared = [prose(1000 + k, 60 + 7 * k).split() for k in range(6)]
    rnd = random.Random(3)
    rows, planted = [], []
    for d in range(60):
        words = prose(d, 90).split()
        if d % 2:
            k = rnd.randrange(6)
            passage = list(shared[k])
            if d % 3 == 0:
                passage[len(passage) // 2] = "altered"
            at = rnd.randrange(0, 90)
            words[at:at] = passage
            planted.append((d, k, at, len(passage), d % 3 == 0))
        rows.append((d, " ".join(words), "en", "s"))
    got = compact_windows.repeated_passages(documents(spark, rows), Stages(spark, "passages-test")).collect()
    text = {d: t.lower().split() for d, t, *_ in rows}
    for r in got:
        a = shingle_set(text[r.doc_id][r.start_word:r.start_word + r.n_words])
        b = shingle_set(text[r.of_doc_id][r.of_start_word:r.of_start_word + r.of_n_words])
        assert r.of_doc_id < r.doc_id and r.n_words >= 50 and len(a & b) >= 0.8 * len(a | b)
    covered: dict = {}
    for r in got:
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    first: dict = {}
    for d, k, at, n, altered in planted:
        if k in first and not altered:
            assert set(range(at, at + n)) <= covered.get(d, set())
        if not altered:
            first.setdefault(k, d)
    assert set(covered) <= {d for d, *_ in planted}


def test_passages_of_awkward_rows_and_cutting(spark):
    docs = awkward(spark)
    got = compact_windows.drop_repeated_passages(docs, Stages(spark, "passages-test"))
    assert got.columns == docs.columns
    assert collected(got, "doc_id", "text") == collected(docs, "doc_id", "text")
    p = prose(77, 70)
    pair = documents(spark, [(1, "before this. " + p + " after", "en", "s"), (2, "another start\n" + p.upper() + "\nand end", "en", "s"), (3, "x " * 400, "en", "s")])
    out = {r.doc_id: (r.text, r.n_chars) for r in compact_windows.drop_repeated_passages(pair, Stages(spark, "passages-test")).collect()}
    assert out[1][0].startswith("before this. ") and out[2] == ("another start\n\nand end", 22) and out[3][1] == 800
    assert compact_windows.repeated_passages(docs.limit(0), Stages(spark, "passages-test")).count() == 0
    assert compact_windows.without_spans(" a bé  c d ", [(1, 2), (2, 1)]) == " a  d "


def test_shared_passages_tolerate_an_edit():
    rnd = np.random.default_rng(0)
    a = rnd.integers(0, 1 << 30, 300).astype(np.int32)
    b = np.concatenate([rnd.integers(0, 1 << 30, 50).astype(np.int32), a[100:220]])
    b[110:115] = 5
    assert compact_windows.shared_passages(b, a) == [(50, 169, 100, 219)]
    assert compact_windows.shared_passages(a[:46], a[:46]) == [(0, 45, 0, 45)] and compact_windows.shared_passages(a[:45], a[:45]) == []


def test_passages_side_by_side_here_and_apart_there_are_both_found():
    rnd = np.random.default_rng(1)
    a, b, x = (rnd.integers(0, 1 << 30, n).astype(np.int32) for n in (95, 95, 60))
    mine = np.concatenate([a, [-1, -2, -3, -4], b]).astype(np.int32)  # four shingles reach over the border
    for k in (45, 144):
        mine[k:k + 5] = -k - np.arange(5)
    other = np.concatenate([a, x, b])
    assert compact_windows.shared_passages(mine, other) == [(0, 94, 0, 94), (99, 193, 155, 249)]


def test_verbatim_passages_behind_a_looser_variant_are_found(spark):
    passages = [prose(3000 + k, 60).split() for k in range(150)]
    rows = []
    for k, p in enumerate(passages):
        loose = [f"other{k}x{i}" if i % 20 == 10 else w for i, w in enumerate(p)]
        for at, words in enumerate((loose, p, p)):
            aside = [f"d{at}k{k}n{j}" for j in range(60)]
            rows.append((3 * k + at, " ".join([*aside[:30], *words, *aside[30:]]), "en", "s"))
    got = compact_windows.repeated_passages(documents(spark, rows), Stages(spark, "passages-test")).filter("of_doc_id = doc_id - 1").collect()
    found = {r.doc_id for r in got if r.doc_id % 3 == 2 and r.start_word <= 30 and r.start_word + r.n_words >= 90}
    assert len(found) >= 149


def test_windows_that_reach_far_are_not_cut(spark, monkeypatch):
    shared = prose(4000, 900)
    docs = documents(spark, [(d, prose(4001 + d, 100) + " " + shared + " " + prose(4011 + d, 100), "en", "s") for d in (1, 2)])
    want = {(r.key, r.fn, r.doc_id, r.c, r.l, r.r) for r in compact_windows.unpacked(compact_windows.window_rows(docs)).collect()}
    monkeypatch.setattr(compact_windows, "LEFT", 15)
    monkeypatch.setattr(compact_windows, "RIGHT", 15)
    rows = compact_windows.unpacked(compact_windows.window_rows(docs))
    assert {(r.key, r.fn, r.doc_id, r.c, r.l, r.r) for r in rows.collect()} == want
    assert max(r - l for *_, l, r in want) > 100


def test_windows_of_many_places_keep_hash_and_place_apart(monkeypatch):
    monkeypatch.setattr(compact_windows, "PLACE_BITS", 4)
    assert [int(compact_windows.place_mask(n)) for n in (3, 15, 16, 300)] == [15, 15, 31, 511]
