"""Document quality by a text classifier and hierarchical site posteriors.

A logistic classifier over counts of a text's characters, words and lines is
fitted on a bounded sample of labelled rows (``max_labelled``, chosen by hash).
The probabilities it gives all documents are then summed per host and per path
of a host. A host's posterior is its mean drawn toward the corpus mean, a
path's posterior its mean drawn toward its host's, the more the fewer documents
it has; the strength of either pull is a moment estimate of how much sites
really differ. A document's log-odds move by what its path's posterior says
beyond the corpus mean, and it is kept at even odds or better.

``source`` names the host, up to the first slash (a scheme is passed over);
the next segment and the language make the path.

Cases: null texts count as empty; null sources and languages are sites of their
own; repeated rows are judged alike and counted each; repeated or null labels
are used as they come or not at all; without labels, or of one kind only, the
evidence is their smoothed share and a document without evidence is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tilth.llm.common import Stages

FEATURES = ("log_words", "upper", "digits", "symbols", "bars", "bangs", "marks", "high", "word_length", "distinct_words", "repeated_lines")
_GROUPS = np.zeros((256, 7), np.float64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*@^~", b"|<>{}[]\\", b"!", b".,;:?'\"()-_/+=`")):
    _GROUPS[list(_chars), _i] = 1
_GROUPS[128:, 6] = 1


def features(text: bytes) -> list[float]:
    """The measures of one text, named by ``FEATURES``."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _GROUPS
    size = sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return [float(np.log(len(words))), *(counts / size).tolist(), min(size / len(words), 50.0),
            len(set(words)) / len(words), 1 - len(set(lines)) / len(lines)]


def with_features(docs: DataFrame, name: str) -> DataFrame:
    """All columns of ``docs`` and the measures of its text as array ``name``."""
    at = docs.columns.index("text")
    out = StructType([*docs.schema.fields, StructField(name, ArrayType(DoubleType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "").cast(pa.large_binary())
            flat = np.array([features(t.as_buffer().to_pybytes()) for t in texts]).ravel()
            offsets = np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)], [*batch.schema.names, name])

    return docs.mapInArrow(measure, out)


@dataclass
class Classifier:
    """log-odds = offset + weights . features"""

    offset: float
    weights: tuple[float, ...]

    def log_odds(self, array: Column) -> Column:
        terms = [F.lit(w) * array[i] for i, w in enumerate(self.weights)]
        return F.greatest(F.lit(-8.0), F.least(F.lit(8.0), sum(terms, F.lit(self.offset))))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Classifier:
    """Ridge logistic regression by Newton steps, on standardized features."""
    good = float(y.sum())
    prior = float(np.log((good + 1) / (len(y) - good + 1)))
    if not 0 < good < len(y):
        return Classifier(prior, (0.0,) * len(FEATURES))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    w[0] = prior
    pull = np.full(len(w), ridge)
    pull[0] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull + 1e-9), z.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[1:] / scale
    return Classifier(float(w[0] - weights @ mean), tuple(weights.tolist()))


def train(measured: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> Classifier:
    """A classifier from labelled rows of ``measured`` (doc_id, f)."""
    known = labels.filter("quality is not null").select("doc_id", "quality")
    rows = (measured.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled)
            .select("quality", "f").toPandas())
    if rows.empty:
        return Classifier(0.0, (0.0,) * len(FEATURES))
    return fit(np.stack(rows["f"]), rows["quality"].to_numpy(float))


def host_of(source: str) -> Column:
    return F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[A-Za-z]+://)?([^/?#]*)", 1)


def path_of(source: str, lang: str) -> Column:
    segment = F.regexp_extract(F.coalesce(source, F.lit("")), r"^(?:[A-Za-z]+://)?[^/?#]*/([^/?#]*)", 1)
    return F.concat_ws("/", segment, F.coalesce(lang, F.lit("")))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _pull(sums: DataFrame, prior: Column, mean: float) -> float:
    """How many documents the prior is worth: from the spread of the group
    means of ``sums`` (n, good) around ``prior`` beyond chance."""
    row = sums.agg(F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count("*"), F.sum(F.col("n") * (F.col("good") / F.col("n") - prior) ** 2)).first()
    if not row[0]:
        return 1.0
    n, squares, groups, spread = map(float, row)
    noise = max(mean * (1 - mean), 1e-6)
    room = n - squares / n - (groups - 1)
    share = (spread / noise - (groups - 1)) / room if room > 0 else 0.01
    share = min(max(share, 1e-4), 0.5)
    return 1 / share - 1


def site_posteriors(scored: DataFrame, stages: Stages) -> tuple[DataFrame, float]:
    """(host, path, host_posterior, path_posterior) from rows (host, path, p),
    and the corpus mean."""
    paths = stages.keep(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths")
    hosts = stages.keep(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "hosts")
    total = hosts.agg(F.sum("n"), F.sum("good")).first()
    mean = (float(total[1] or 0) + 1) / (float(total[0] or 0) + 2)
    pull = _pull(hosts, F.lit(mean), mean)
    hosts = hosts.select("host", ((F.col("good") + pull * mean) / (F.col("n") + pull)).alias("host_posterior"))
    below = paths.join(hosts, "host")
    pull = _pull(below, F.col("host_posterior"), mean)
    posterior = (F.col("good") + pull * F.col("host_posterior")) / (F.col("n") + pull)
    return stages.keep(below.select("host", "path", "host_posterior", posterior.alias("path_posterior")), "posteriors"), mean


@dataclass
class QualityModel:
    classifier: Classifier
    sites: DataFrame
    mean: float

    def judge(self, rows: DataFrame, f: str, host: str = "_host", path: str = "_path") -> DataFrame:
        """Adds text_score, host_posterior, path_posterior, score and kept to
        rows with the measures ``f`` and columns source and lang."""
        sites = self.sites.select(F.col("host").alias(host), F.col("path").alias(path), "host_posterior", "path_posterior")
        rows = rows.withColumns({host: host_of("source"), path: path_of("source", "lang"), "text_score": self.classifier.log_odds(F.col(f))})
        shift = F.coalesce(_odds(F.col("path_posterior")) - _odds(F.lit(self.mean)), F.lit(0.0))
        return (rows.join(sites, [host, path], "left").withColumn("score", F.col("text_score") + shift)
                .withColumn("kept", F.col("score") >= 0).drop(host, path))


def learn(docs: DataFrame, labels: DataFrame, stages: Stages) -> tuple[QualityModel, DataFrame]:
    """The model of a corpus and its staged measures (doc_id, lang, source, f)."""
    rows = stages.keep(with_features(docs.select("doc_id", "text", "lang", "source"), "f").drop("text"), "measures")
    classifier = train(rows, labels)
    p = 1 / (1 + F.exp(-classifier.log_odds(F.col("f"))))
    sites, mean = site_posteriors(rows.select(host_of("source").alias("host"), path_of("source", "lang").alias("path"), p.alias("p")), stages)
    return QualityModel(classifier, sites, mean), rows


def document_quality(docs: DataFrame, labels: DataFrame, stages: Stages) -> DataFrame:
    """(doc_id, text_score, host_posterior, path_posterior, score, kept)."""
    model, rows = learn(docs, labels, stages)
    return model.judge(rows, "f").select("doc_id", "text_score", "host_posterior", "path_posterior", "score", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stages: Stages) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with their own columns only.
    Texts are measured twice and never shuffled."""
    model, _ = learn(docs, labels, stages)
    slots = [f"c{i}" for i in range(len(docs.columns))]  # own columns cannot clash with the model's
    named = dict(zip(docs.columns, slots))
    rows = with_features(docs, "__measures")
    plain = rows.select(*[F.col(f"`{c}`").alias(s) for c, s in named.items()], "source", "lang", "__measures")
    return model.judge(plain, "__measures").filter("kept").select(*[F.col(s).alias(c) for c, s in named.items()])
