"""Quality scores by regularised quadratic discriminant analysis.

Statistics of a whole text, transformed towards normal shape, are the features.
Each class has a mean and a covariance, shrunk towards the pooled covariance and
towards the identity. The score is the posterior of label 1: the difference of
the two log densities, whose Mahalanobis terms come from cached Cholesky factors,
plus that of the log priors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import as_bytes, bounded_batches, crc_mod, free_names

FOLDS = 5
THRESHOLD = 0.3
#: Labelled rows outside the held-out fold that the discriminant is fitted on, about: those whose ids have the smallest hashes.
FIT_ROWS = 20_000

#: Words at which a text's features count half: fewer say little about the text.
HALF_WEIGHT_WORDS = 8

FEATURES = (
    "vocabulary growth", "mean word length", "word length spread", "short words", "repeated neighbours",
    "upper case", "digits", "sentence marks", "exclamation marks", "pipes", "other symbols", "beyond ASCII",
    "repeated lines", "words a line",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".,;:"]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = True
_BEYOND = np.zeros(256, bool)
_BEYOND[128:] = True


def statistics_of(text: bytes) -> list[float]:
    """The number of words and then the features of one text; an empty one has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * (1 + len(FEATURES))
    octets = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    letters = max(1, int(octets[_LETTER].sum()))
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = sum(map(bytes.__eq__, words[1:], words[:-1])) / n

    def share(kind: np.ndarray, of: int = size) -> float:
        return math.sqrt(float(octets[kind].sum()) / of)

    return [
        float(n),
        math.log1p(len(set(words))) / math.log1p(n),
        math.log(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        float((lengths <= 3).mean()),
        math.sqrt(repeated),
        share(_UPPER, letters),
        share(_DIGIT),
        share(_SENTENCE),
        math.sqrt(int(octets[33]) / size),
        math.sqrt(int(octets[124]) / size),
        share(_SYMBOL),
        share(_BEYOND),
        math.sqrt(1 - len(set(lines)) / len(lines)),
        math.log1p(n / len(lines)),
    ]


@arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(texts: pa.Array) -> pa.Array:
    """The features of each whole text; null counts as empty."""
    return pa.array([statistics_of(t) for t in as_bytes(texts)], pa.list_(pa.float64()))


@dataclass
class Discriminant:
    """What scoring needs. ``bias`` is the log prior odds less half the difference of the log determinants."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    whiten: np.ndarray  # inverses of the Cholesky factors
    bias: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Posteriors of label 1. Features are drawn to the centre where there are few words to count."""
        weight = rows[:, :1] / (rows[:, :1] + HALF_WEIGHT_WORDS)
        z = (rows[:, 1:] - self.centre) / self.scale * weight
        far = [np.square((z - m) @ w.T).sum(axis=1) for m, w in zip(self.means, self.whiten, strict=True)]
        odds = self.bias + 0.5 * (far[0] - far[1])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label: rows, sum and sum of outer products of the features.

    Each task reduces its batches to one row a label; those are added up by
    position in a shuffle, and a fixed number of sums reaches the driver.
    """

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            y = np.asarray(batch.column(0).to_pylist())
            x = np.asarray(batch.column(1).to_pylist(), float)[:, 1:]
            one = np.hstack([np.ones((len(x), 1)), x])
            for k in np.unique(y):
                part = one[y == k]
                sums[int(k)] = sums.get(int(k), 0) + (part.T @ part).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["label", "sums"],
        )

    rows = (
        labelled.mapInArrow(partial, "label int, sums array<double>")
        .select("label", F.posexplode("sums").alias("at", "v"))
        .groupBy("label", "at")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    d = len(FEATURES) + 1
    out = {}
    for label in {r.label for r in rows}:
        m = np.zeros(d * d)
        for r in rows:
            if r.label == label:
                m[r["at"]] = r.v
        m = m.reshape(d, d)
        out[label] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return out


def fit(labelled: DataFrame, to_pooled: float = 0.3, to_identity: float = 0.05) -> Discriminant:
    """A discriminant from (label 0 or 1, features) rows, null labels left out.

    With rows of one label only, or none, all scores equal that label's share
    (a half without any).
    """
    sums = _moments(labelled.where("label in (0, 1) and features is not null"))
    d = len(FEATURES)
    n = np.array([sums[k][0] if k in sums else 0.0 for k in (0, 1)])
    if n.min() == 0:
        odds = 0.0 if n.max() == 0 else 500.0 * (1 if n[1] else -1)
        return Discriminant(np.zeros(d), np.ones(d), np.zeros((2, d)), np.zeros((2, d, d)), odds)
    total = n.sum()
    centre = sum(sums[k][1] for k in (0, 1)) / total
    raw = sum(sums[k][2] for k in (0, 1)) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(raw), 1e-12))
    means, covs = [], []
    for k in (0, 1):
        mean = sums[k][1] / n[k]
        means.append((mean - centre) / scale)
        covs.append((sums[k][2] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / total
    whiten, logdet = [], []
    for cov in covs:
        mixed = (1 - to_pooled) * cov + to_pooled * pooled
        mixed = (1 - to_identity) * mixed + to_identity * max(np.trace(mixed) / d, 1e-6) * np.eye(d)
        root = np.linalg.cholesky(mixed)
        whiten.append(np.linalg.inv(root))
        logdet.append(2 * np.log(np.diag(root)).sum())
    bias = math.log(n[1] / n[0]) - 0.5 * (logdet[1] - logdet[0])
    return Discriminant(centre, scale, np.array(means), np.array(whiten), bias)


def score_of_features(model: Discriminant, features: Column) -> Column:
    """The score of each row's features (see statistics()); those of an empty text are drawn to the centre. No rows give no scores."""

    @arrow_udf(T.DoubleType())
    def score(rows: pa.Array) -> pa.Array:
        x = np.asarray(rows.to_pylist(), float).reshape(len(rows), 1 + len(FEATURES))
        return pa.array(model.scores(x))

    return score(features)


def score_of_text(model: Discriminant, text: Column) -> Column:
    """The score of each whole text; null counts as empty, and all empty texts have one score."""

    @arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        x = np.array([statistics_of(t) for t in as_bytes(texts)], float).reshape(len(texts), 1 + len(FEATURES))
        return pa.array(model.scores(x))

    return score(text)


def features_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, features) of every row; null and empty texts have zeros, repeated rows a row each. An empty table gives no rows."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).alias("doc_id"), statistics(F.col(text)).alias("features"))


def lessons(labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, label) of at most about ``rows`` labelled rows outside the held-out fold (crc32 of the id mod 5 is 0).

    Of more, the share with the smallest hashes of their ids is taken. Rows with a
    null id or a label other than 0 and 1 teach nothing.
    """
    known = labels.where((crc_mod("doc_id", FOLDS) != 0) & F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    n = known.count()
    return known if n <= rows else known.where(F.xxhash64("doc_id") / float(1 << 64) + 0.5 < rows / n)


def fit_on(features: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Discriminant:
    """Fits on the features of the rows that lessons() takes, in one broadcast join, as those are bounded.

    Repeated ids or labels count once for each matching pair; null ids match none.
    """
    return fit(features.join(F.broadcast(lessons(labels, label, rows)), "doc_id").select("label", "features"))


def fit_on_texts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Discriminant:
    """As fit_on(), but only the texts that are learned from become features."""
    bounded_batches(docs.sparkSession)
    known = F.broadcast(lessons(labels, label, rows))
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(known, "doc_id")
    return fit(chosen.select("label", statistics(F.col("text")).alias("features")))


def accepted(docs: DataFrame, model: Discriminant, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``. Columns stay as they are, whatever their names.

    Null and empty texts share one score and so one fate; repeated rows too.
    """
    bounded_batches(docs.sparkSession)
    (name,) = free_names(docs.columns, "score")
    return docs.withColumn(name, score_of_text(model, F.col(f"`{text}`"))).where(F.col(name) >= threshold).drop(name)
