"""Quality rules: plain limits, and robust multivariate outliers.

Statistic vectors are rejected by their Mahalanobis distance from a minimum-
covariance-determinant estimate of their language and source. The estimate is
found by concentration steps over all rows: each step bins the distances of a
group, keeps the nearest share of its rows and takes their mean and covariance,
so a step is one aggregation with map-side sums and no group meets in a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import map_texts
from .shared import materialise

SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Statistics of a vector and the least standard deviation that each is given.
VECTOR = {"x_length": 0.06, "x_symbols": 0.5, "x_lines": 0.6, "x_repeats": 0.6}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that are found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = dict.fromkeys(words)
    for i, w in enumerate(ids):
        ids[w] = i
    one = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    code, base = one[:n], len(ids)
    for k in range(1, window):
        if code.size and int(code.max()) + 1 > (1 << 62) // base:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
        code = code * base + one[k : n + k]
    order = np.sort(code)
    twice = order[1:][order[1:] == order[:-1]]
    if not twice.size:
        return 0
    hit = np.isin(code, twice)
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : n + k] |= hit
    return int(covered.sum())


def base_statistics(text: bytes | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text; words are runs of anything but \\x20 and \\x09-\\x0D."""
    raw = text or b""
    words, chars = raw.split(), raw.decode()
    seen, dup = set(), 0
    for line in raw.split(b"\n"):
        if line.strip():
            dup += line in seen
            seen.add(line)
    return len(words), len(chars) - sum(chars.count(s) for s in SPACES), sum(chars.count(s) for s in SYMBOLS), dup, repeated_words(words)


def measure(df: DataFrame, key: str = "doc_id", text: str = "text", extra: list[str] = ()) -> DataFrame:
    """Base statistics and the transformed vector of each row."""

    def run(texts: list) -> dict[str, pa.Array]:
        rows = [base_statistics(t) for t in texts]
        return {n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))}

    rows = map_texts(df, key, text, run, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long", list(extra))
    rate = lambda c: F.log1p(100 * F.col(c) / (F.col("n_words") + 20))
    # of short texts, rates are drawn to those of a text of twenty usual words
    return rows.withColumns({"x_length": F.log((F.col("word_chars") + 100) / (F.col("n_words") + 20)), "x_symbols": rate("n_symbols"), "x_lines": rate("n_dup_lines"), "x_repeats": rate("n_repeat_words")})


def chi2_below(x: float, p: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    h, term, total = x / 2, 1.0, 0.0
    for k in range(p // 2):
        total += term
        term *= h / (k + 1)
    return 1 - math.exp(-h) * total


def chi2_quantile(q: float, p: int) -> float:
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_below(mid, p) < q else (lo, mid)
    return hi


def _distance(names: list[str]) -> str:
    """Squared Mahalanobis distance of columns ``names`` by arrays ``mu`` and ``prec``."""
    p = len(names)
    d = [f"({n} - mu[{i}])" for i, n in enumerate(names)]
    return " + ".join(f"prec[{i * p + j}] * {d[i]} * {d[j]}{' * 2' if i < j else ''}" for i in range(p) for j in range(i, p))


def mcd(rows: DataFrame, group: str, vector: dict[str, float], share: float = 0.75, steps: int = 5) -> DataFrame:
    """(group, n, mu, prec): location and inverse scatter of the nearest ``share`` of each group's rows.

    Starts from medians and median absolute deviations. Distances are binned to
    an eighth of a power of e, so of each group at most a few hundred sums are
    gathered. A scatter never falls below the least deviations in ``vector``,
    so constant statistics don't make other values infinitely far.
    """
    names, p = list(vector), len(vector)
    floor = np.array([vector[n] ** 2 for n in names])
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    middle = rows.groupBy(group).agg(F.count("*").alias("n"), *(F.percentile_approx(n, 0.5, 2000).alias(f"m_{n}") for n in names))
    spread = rows.join(middle, group).groupBy(group).agg(F.first("n").alias("n"), *(F.first(f"m_{n}").alias(f"m_{n}") for n in names), *(F.percentile_approx(F.abs(F.col(n) - F.col(f"m_{n}")), 0.5, 2000).alias(f"s_{n}") for n in names))
    variance = lambda i, n: f"pow(1.4826 * s_{n}, 2) + {float(floor[i])!r}D"
    prec = ", ".join(f"1 / ({variance(i, n)})" if i == j else "0D" for i, n in enumerate(names) for j in range(p))
    params = materialise(spread.select(group, "n", F.array(*(F.col(f"m_{n}") for n in names)).alias("mu"), F.expr(f"array({prec})").alias("prec")), "mcd")
    kind = rows.schema[group].dataType.simpleString()

    def concentrate(key, bins: pd.DataFrame) -> pd.DataFrame:
        bins = bins.sort_values("bin")
        reach = int(np.searchsorted(np.cumsum(bins["k"].to_numpy()), math.ceil(share * bins["k"].sum()))) + 1
        near = bins.iloc[:reach]
        k = near["k"].sum()
        mu = np.array([near[f"s_{i}"].sum() / k for i in range(p)])
        cov = np.zeros((p, p))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = near[f"c_{i}_{j}"].sum() / k - mu[i] * mu[j]
        part = k / bins["k"].sum()
        cov = cov * (part / chi2_below(chi2_quantile(part, p), p + 2) if part < 1 else 1) + np.diag(floor)
        return pd.DataFrame({group: [key[0]], "n": [int(bins["k"].sum())], "mu": [mu.tolist()], "prec": [np.linalg.inv(cov).ravel().tolist()]})

    for _ in range(steps):
        far = rows.join(params.select(group, "mu", "prec"), group).withColumn("bin", F.expr(f"cast(floor(8 * ln(greatest({_distance(names)}, 1e-4D))) as int)"))
        sums = far.groupBy(group, "bin").agg(F.count("*").alias("k"), *(F.sum(n).alias(f"s_{i}") for i, n in enumerate(names)), *(F.sum(F.col(names[i]) * F.col(names[j])).alias(f"c_{i}_{j}") for i, j in pairs))
        params = materialise(sums.groupBy(group).applyInPandas(concentrate, f"{group} {kind}, n long, mu array<double>, prec array<double>"), "mcd")
    return params


def quality_rules(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", least_rows: int = 50, tail: float = 1e-7) -> DataFrame:
    """One row per row of ``df``: (key, base statistics, base_failed, distance, kept).

    base_failed: under 10 words, or over a fifth of the words in repeated
    windows. kept: neither that nor farther from its group's estimate than all
    but ``tail`` of a normal population. A group is a language and source; the
    rows of groups under ``least_rows`` (of rows that pass the base rules)
    share one group per language, and those too few again one group; of a last
    group that is still too small nothing is rejected. Null languages and
    sources are values of their own; null texts have no words; repeated rows
    count as often as they occur; an empty table gives no rows; other columns
    are ignored.
    """
    rows = measure(df.select(F.col(key), F.col(text), F.col(lang).alias("lang"), F.col(source).alias("source")), key, text, ["lang", "source"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    name = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    rows = rows.withColumns({"base_failed": failed, "lang": name(F.col("lang")), "source": name(F.col("source"))})
    rows = materialise(rows, "statistics")
    sizes = rows.where("not base_failed").groupBy("lang", "source").count()
    rest = sizes.where(F.col("count") < least_rows).groupBy("lang").agg(F.sum("count").alias("count"))
    tongues = materialise(rest.where(F.col("count") >= least_rows).select("lang", F.lit(True).alias("by_lang")), "languages")
    groups = sizes.join(tongues, "lang", "left").withColumn("grp", F.when(F.col("count") >= least_rows, F.concat("lang", F.lit("\t"), "source")).when(F.col("by_lang"), F.col("lang")).otherwise(""))
    groups = materialise(groups.select("lang", "source", "grp"), "groups")
    vector = list(VECTOR)
    placed = rows.where("not base_failed").join(groups, ["lang", "source"]).select("grp", *vector)
    params = mcd(placed, "grp", VECTOR).where(F.col("n") >= least_rows)
    limit = chi2_quantile(1 - tail, len(vector))
    out = rows.join(groups, ["lang", "source"], "left").join(params.select("grp", "mu", "prec"), "grp", "left")
    out = out.withColumn("distance", F.when(~F.col("base_failed"), F.expr(_distance(vector))))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    return out.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
