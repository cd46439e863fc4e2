"""Toxicity: cumulative-link ordinal regression over sparse text features.

P(grade >= k) = logistic(w . x - t_k) with one weight vector for all grades and
ordered thresholds t_1 < t_2 < ...; a document's score is its expected grade.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import labelled_sample, map_texts, numbered

#: Labelled documents of each class that a model is fitted on, at most.
PER_CLASS = 4000
CACHE = 100_000
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: bytes | None) -> list[str]:
    """Lower-cased words of a whole text without punctuation at their ends."""
    return [w for x in (text or b"").decode().lower().split() if (w := x.strip(EDGE))]


def features(word: str) -> tuple[int, ...]:
    """Sparse binary features of a word, as 32-bit hashes: the word, and its beginnings of three to five letters."""
    return tuple(xxhash.xxh32_intdigest(x) for x in (word, *(f"{word[:n]}*" for n in (3, 4, 5) if len(word) > n)))


@dataclass
class OrdinalModel:
    """Weights by feature and ordered thresholds."""

    weights: dict[int, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [math.inf])
    known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False, compare=False)

    def at_least(self, words: set[str]) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        w, known, found = self.weights, self.known, set()
        for x in words:
            if (own := known.get(x)) is None:
                if len(known) >= CACHE:
                    known.clear()
                known[x] = own = tuple(f for f in features(x) if f in w)
            if own:
                found.update(own)
        z = sum(w[f] for f in sorted(found))
        return [1 / (1 + math.exp(min(700.0, max(-700.0, t - z)))) for t in self.thresholds]


def select_features(docs: list[np.ndarray], positive: np.ndarray, weight: np.ndarray, least_docs: int = 3, lift: float = 4.0, most: int = 4096) -> np.ndarray:
    """Features in ``least_docs`` positive documents or more whose rate among those is ``lift`` times that of others; the most significant ones."""
    names, cols = np.unique(np.concatenate(docs), return_inverse=True)
    cols = cols.astype(np.int32)
    share = np.repeat(weight.astype(np.float32), [len(d) for d in docs])
    of = np.repeat(positive, [len(d) for d in docs])
    n1, n0 = max(1.0, float((weight * positive).sum())), max(1.0, float((weight * ~positive).sum()))
    a, b = np.bincount(cols[of], share[of], len(names)), np.bincount(cols[~of], share[~of], len(names))
    times = np.bincount(cols[of], minlength=len(names))
    odds = np.log((a + 0.5) / np.maximum(n1 - a, 0.5)) - np.log((b + 0.5) / np.maximum(n0 - b, 0.5))
    z = odds / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    good = np.flatnonzero((times >= least_docs) & ((a + 0.5) / n1 >= lift * (b + 0.5) / n0) & (z > 2))
    return names[good[np.lexsort((names[good], -z[good]))][:most]]


def fit_ordinal(docs: list[np.ndarray], grades: np.ndarray, weight: np.ndarray, ridge: float = 1e-4, steps: int = 600) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model by full-batch Adam. With fewer than two grades nothing is ever graded."""
    k = int(grades.max()) if len(grades) else 0
    names = np.sort(select_features(docs, grades > 0, weight)) if k else np.zeros(0, np.uint32)
    if not len(names):
        return OrdinalModel()
    flat, rows = np.concatenate(docs), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    cols = np.minimum(np.searchsorted(names, flat), len(names) - 1)
    known = names[cols] == flat
    rows, cols = rows[known], cols[known]
    w, share = np.zeros(len(names)), weight / weight.sum()
    p = np.concatenate([w, [2.0], np.full(k - 1, 0.5)])  # weights, first threshold, logs of the steps between thresholds
    m, v = np.zeros_like(p), np.zeros_like(p)
    own = np.arange(len(docs))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    for step in range(1, steps + 1):
        w, gaps = p[: len(names)], np.exp(p[len(names) + 1 :])
        t = p[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(rows, w[cols], len(docs))
        s = np.column_stack([np.ones(len(docs)), sigmoid(z[:, None] - t), np.zeros(len(docs))])
        d = s * (1 - s)
        prob = np.maximum(s[own, grades] - s[own, grades + 1], 1e-9)
        scale = -share / prob
        gz = scale * (d[own, grades] - d[own, grades + 1])
        gt = np.array([-(scale * (d[:, j] * (grades == j) - d[:, j] * (grades + 1 == j))).sum() for j in range(1, k + 1)])
        gw = np.bincount(cols, gz[rows], len(names)) + ridge * w
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.concatenate([gw, [tail[0]], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w, gaps = p[: len(names)], np.exp(p[len(names) + 1 :])
    t = p[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])
    return OrdinalModel({int(f): float(x) for f, x in zip(names, w, strict=True)}, [float(x) for x in t])


def severity(words: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, cuts: tuple[int, ...] = (2, 5)) -> np.ndarray:
    """Grades from a yes/no label: 0 for no; for yes 1, 2, 3 by how many different words a document has that the label marks.

    words: hashes of each document's distinct words.
    """
    marked = select_features(words, toxic, weight, lift=20.0)
    found = np.array([np.isin(w, marked).sum() for w in words])
    return np.where(toxic, 1 + np.searchsorted(np.array(cuts), found), 0)


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = PER_CLASS) -> OrdinalModel:
    """Fit on up to ``per_class`` labelled documents of each class; yes/no labels become grades, larger ones are grades already."""
    chosen = labelled_sample(labels, label, key, per_class)
    rows = documents.select(key, text).join(F.broadcast(chosen), key)  # per_class rows of three numbers for each class

    def count(texts: list) -> dict[str, pa.Array]:
        found, words = [], []
        for t in texts:
            each = [features(w) for w in sorted(set(words_of(t)))]
            found.append(np.unique(np.array([f for fs in each for f in fs], np.uint32)).view(np.int32))
            words.append(np.array([fs[0] for fs in each], np.uint32).view(np.int32))
        return {n: pa.array(x, pa.list_(pa.int32())) for n, x in (("found", found), ("words", words))}

    got = map_texts(rows, key, text, count, "found array<int>, words array<int>", ["label", "weight"]).toArrow()
    keys = np.array(got[key].to_pylist())
    order = pa.array(np.lexsort((np.array(got["words"].combine_chunks().value_lengths()), keys)) if len(keys) else np.zeros(0, int))
    got = got.take(order)
    arrays = lambda c, kind: [x.values.to_numpy().view(kind) for x in got[c]]
    grade, weight = np.array(got["label"].to_pylist(), int), np.array(got["weight"].to_pylist(), float)
    if len(grade) and grade.max() == 1:
        grade = severity(arrays("words", np.uint32), grade > 0, weight)
    return fit_ordinal(arrays("found", np.uint32), grade, weight)


def score(documents: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text", extra: list[str] = ()) -> DataFrame:
    """(key, *extra, expected_severity, p_toxic, grade) of every whole text.

    expected_severity is the mean grade, p_toxic the probability of any grade
    over 0, grade the most extreme one that is at least as likely as not. Null
    and empty texts have no feature and score as a text of unknown words;
    repeated rows give repeated rows; other columns are ignored.
    """

    def run(texts: list) -> dict[str, pa.Array]:
        p = [model.at_least(set(words_of(t))) for t in texts]
        return {
            "expected_severity": pa.array([sum(x) for x in p], pa.float64()),
            "p_toxic": pa.array([x[0] for x in p], pa.float64()),
            "grade": pa.array([sum(y >= 0.5 for y in x) for x in p], pa.int32()),
        }

    return map_texts(documents, key, text, run, "expected_severity double, p_toxic double, grade int", list(extra))


def keep_clean(documents: DataFrame, model: OrdinalModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` of which no grade over 0 is at least as likely as not.

    All columns stay, whatever their names; null and empty texts, null keys and
    repeated rows are rows like any other; an empty table stays empty.
    """
    d = numbered(documents)
    at = d.columns[documents.columns.index(key)], d.columns[documents.columns.index(text)]
    scored = score(d.withColumn("whole", F.col(at[1])), model, at[0], "whole", [c for c in d.columns if c != at[0]])
    return scored.where("p_toxic < 0.5").select(*d.columns).toDF(*documents.columns)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(documents, model).withColumn("toxic", F.col("p_toxic") >= 0.5)
