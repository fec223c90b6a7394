"""Small corpora and brute-force versions for the operators' tests."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, node long"
WORDS = ["alder", "birch", "cedar", "dogwood", "elm", "fir", "ginkgo", "hazel", "ivy", "juniper", "kapok", "larch",
         "maple", "nutmeg", "oak", "pine", "quince", "rowan", "spruce", "teak", "ulmo", "viburnum", "willow", "yew"]


def prose(seed: int, words: int, syllables: int = 2) -> str:
    """Distinct-looking prose: sentences over a few lines."""
    rnd = random.Random(seed)
    out = ["".join(rnd.choice(WORDS)[:rnd.randint(2, 5)] for _ in range(syllables)) for _ in range(words)]
    return "".join(w + (".\n" if i % 23 == 22 else " ") for i, w in enumerate(out)).strip()


def documents(spark, rows):
    """A documents table with columns whose names clash with the operators' own."""
    full = [(d, t, lang, source, None if t is None else len(t), "mine", 7) for d, t, lang, source in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def awkward(spark):
    """Nulls, empty and very long texts, ties and repeated rows."""
    return documents(spark, [
        (1, "", "en", "a"), (2, None, None, None), (3, "one two", "en", "a"), (3, "one two", "en", "a"), (None, prose(1, 80), "en", None),
        (5, prose(2, 4000), None, "a/b"), (6, " \n\t ", "fr", "a"), (7, "naïve “quoted” 漢字 it's <|endoftext|>", "de", "http://x.y/z"), (8, prose(3, 120), "en", "a")])


def smallest_reachable(ids, linked):
    """The least id reachable from each of ``ids`` by pairs (i, j) of places."""
    at = list(range(len(ids)))

    def top(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in linked:
        a, b = top(i), top(j)
        if a != b:
            low, high = (a, b) if ids[a] < ids[b] else (b, a)
            at[high] = low
    return [ids[top(i)] for i in range(len(ids))]


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
