"""Similarity of road and place names, and the gates that accept a match."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CONTAINED_NAME, CONTAINED_ROAD, MIN_MARGIN, MIN_SCORE
from .text import compact_text, normalize_road, words


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of (query, candidate). It isn't symmetric; pairs that repeat in a batch are compared once."""
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b, strict=True):
        if None in pair:
            out.append(None)
            continue
        if pair not in known:
            known[pair] = SequenceMatcher(None, *pair).ratio()
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def token_overlap(a: Column, b: Column) -> Column:
    """Shared distinct words over the larger number of distinct words; 0 if either has none."""
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    most = F.greatest(F.size(x), F.size(y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / most)


def containment_score(a: Column, b: Column) -> Column:
    """Score of normalised names where letters alone decide: empty 0, equal 1, one within the other 0.98; null where they don't."""
    x, y = compact_text(a), compact_text(b)
    return F.when((a == "") | (b == ""), F.lit(0.0)).when((a == b) | (x == y), F.lit(1.0)).when(F.contains(x, y) | F.contains(y, x), F.lit(CONTAINED_ROAD))


def scored(df: DataFrame, query: str, name: str, out: str, normalized: bool = True) -> DataFrame:
    """Add the road similarity of two columns. Only pairs that their letters don't decide reach Python."""
    a, b = (F.col(query), F.col(name)) if normalized else (normalize_road(F.col(query)), normalize_road(F.col(name)))
    df = df.withColumns({"_a": a, "_b": b}).withColumn("_sure", containment_score(F.col("_a"), F.col("_b")))
    sure = df.where("_sure is not null").withColumn(out, F.col("_sure"))
    open_ = df.where("_sure is null")
    ratios = open_.select("_a", "_b").distinct().withColumn("_ratio", sequence_ratio("_a", "_b"))
    open_ = open_.join(ratios, ["_a", "_b"]).withColumn(out, F.greatest("_ratio", token_overlap(F.col("_a"), F.col("_b")))).drop("_ratio")
    return sure.unionByName(open_).drop("_a", "_b", "_sure")


def name_score(a: Column, b: Column) -> Column:
    """Similarity of place names: the sequence ratio, at least 0.99 where one holds the other without spaces."""
    x, y = compact_text(a), compact_text(b)
    return F.when((x != "") & (y != "") & (F.contains(x, y) | F.contains(y, x)), F.greatest(F.lit(CONTAINED_NAME), sequence_ratio(a, b))).otherwise(sequence_ratio(a, b))


def best_with_margin(df: DataFrame, by: list[str], score: str = "score", overlap: str = "overlap", name: str = "road_name", min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN) -> DataFrame:
    """The best candidate of each group with ``runner_up`` (0 if alone) and ``accepted``: score and lead over the next are large enough."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.desc(overlap), F.asc(name))
    ranked = df.withColumns({"_rank": F.row_number().over(order), "runner_up": F.lead(score, 1, 0.0).over(order)})
    return ranked.where("_rank = 1").drop("_rank").withColumn("accepted", (F.col(score) >= min_score) & ~((F.col(score) - F.col("runner_up")) < min_margin))


def top_candidates(df: DataFrame, by: list[str], count: str, name: str, n: int) -> DataFrame:
    """The ``n`` candidates of each group with the largest count, ties by name."""
    order = Window.partitionBy(*by).orderBy(F.desc(count), F.asc(name))
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")
