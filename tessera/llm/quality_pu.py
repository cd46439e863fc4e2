"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text, an estimated share of positives, and
the non-negative unbiased risk: the risk of unlabelled text as negative less
what its hidden positives add, never allowed to fall below zero.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import labelled_sample, map_texts

#: Positives and unlabelled documents that a model is fitted on, at most (of each).
PER_CLASS = 12000
FOLDS, CUT = 5, 0.3
UPPER = bytes(range(65, 91))
NOT_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())
STATISTICS = ["symbols", "bars", "exclamations", "digits", "stops", "upper", "word_length", "repeats", "variety", "lines", "words"]


def statistics(text: bytes | None) -> list[float]:
    """Language-free measures of a whole text, in the order of STATISTICS; each is a log or a rate and finite for any text."""
    t = text or b""
    words = t.split()
    n, size = len(words), len(t)
    letters = len(t.translate(None, NOT_LETTERS))
    per = lambda k: math.log1p(100 * k / (n + 5))
    symbols = sum(t.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"<", b">"))
    # of short texts, the variety of words and repeats say little: both are drawn to what is usual
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    ascii_upper = letters - len(t.translate(None, NOT_LETTERS + UPPER))
    return [
        per(symbols), per(t.count(b"|")), per(t.count(b"!")), per(sum(t.count(b"%d" % d) for d in range(10))), per(t.count(b".") + t.count(b",")),
        math.log1p(100 * ascii_upper / (letters + 50)), math.log((size - n + 50) / (n + 10)), per(repeats), math.log((len(set(words)) + 5) / (n + 5) ** 0.9), per(t.count(b"\n")), math.log1p(n),
    ]


@dataclass
class PUModel:
    """A logistic model of standardised statistics."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - np.array(self.mean)) / np.array(self.scale), -8, 8) @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, ridge: float = 1e-4, rate: float = 0.03) -> PUModel:
    """Minimise the non-negative risk of the logistic loss by full-batch Adam.

    Where the negative part of the risk falls below zero, the step goes up that
    part instead of down the whole. Without positives or unlabelled rows the
    model scores every text by the prior.
    """
    k = len(STATISTICS)
    prior = min(0.99, max(0.01, prior))
    if not len(positive) or not len(unlabelled):
        return PUModel([0.0] * k, [1.0] * k, [0.0] * k, math.log(prior / (1 - prior)))
    mean, scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
    p, u = (np.column_stack([np.clip((x - mean) / scale, -8, 8), np.ones(len(x))]) for x in (positive, unlabelled))
    w, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    w[-1] = math.log(prior / (1 - prior))
    best, lowest = w, math.inf
    for step in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        plus = np.logaddexp(0, -zp).mean()
        minus = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_minus = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        g_plus = prior * (p.T @ (sp - 1)) / len(p)
        penalty = ridge * np.append(w[:-1], 0)
        risk = prior * plus + max(0.0, minus) + 0.5 * ridge * (w[:-1] ** 2).sum()
        if minus >= 0 and risk < lowest:
            best, lowest = w.copy(), risk
        g = (g_plus + g_minus if minus >= 0 else -g_minus) + penalty
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return PUModel(mean.tolist(), scale.tolist(), best[:-1].tolist(), float(best[-1]))


def held_out(key: str) -> Column:
    """Whether a row's labels are held out: crc32 of its key as text is a multiple of FOLDS."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _measure(documents: DataFrame, key: str, text: str, extra: list[str]) -> DataFrame:
    def run(texts: list) -> dict[str, pa.Array]:
        return {"x": pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))}

    return map_texts(documents, key, text, run, "x array<double>", extra)


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> PUModel:
    """Fit on labels of rows that aren't held out.

    Positives: up to ``per_class`` documents labelled 1. Unlabelled: as many
    documents drawn from all that aren't held out, whatever their label, which
    isn't looked at. Both are those with the least hash of their key. The share
    of positives is estimated by that among the labelled rows.
    """
    known = labels.where(~held_out(key))
    once = known.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias(label))
    prior = once.agg(F.avg((F.col(label) == 1).cast("double"))).first()[0]
    chosen = labelled_sample(known.where(F.col(label) == 1), label, key, per_class).select(key, F.lit(1).alias("side"))
    web = documents.where(F.col(key).isNotNull() & ~held_out(key)).select(key).orderBy(F.xxhash64(F.col(key), F.lit(1)), key).limit(per_class)
    chosen = chosen.union(web.select(key, F.lit(0).alias("side")))
    rows = documents.select(key, text).join(F.broadcast(chosen), key)  # 2 * per_class rows of two numbers
    got = _measure(rows, key, text, ["side"]).toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(STATISTICS))
    side, order = np.array(got["side"].to_pylist(), int), np.array(got[key].to_pylist()).argsort(kind="stable")
    x, side = x[order], side[order]
    return fit_nnpu(x[side == 1], x[side == 0], 0.5 if prior is None else prior)


def score(documents: DataFrame, model: PUModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every whole text; null and empty texts are scored too.

    Repeated rows give repeated rows, an empty table none; a null key isn't
    held out; other columns are ignored.
    """

    def run(texts: list) -> dict[str, pa.Array]:
        x = np.array([statistics(t) for t in texts], float).reshape(-1, len(STATISTICS))
        return {"score": pa.array(model.score(x), pa.float64())}

    rows = map_texts(documents, key, text, run, "score double")
    return rows.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(documents, fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")))
