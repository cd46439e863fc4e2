"""Road layers, and matching of address phrases to roads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import best_with_margin, scored, top_candidates
from ..functions.text import candidate_phrases, index_tokens, normalize_road
from ..schema import EXACT_OVERLAP, MIN_MARGIN, MIN_SCORE, OVERFLOW_CANDIDATES


def road_layer(roads: DataFrame, by: list[str]) -> DataFrame:
    """(by, road_name, parts, n_roads): named roads, all parts of a name together and each part once."""
    named = roads.withColumn("road_name", normalize_road(F.col("name"))).where("road_name <> ''")
    return named.groupBy(*by, "road_name").agg(F.array_distinct(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("road_id", "parts"))), lambda s: s["parts"]))).alias("parts"), F.count("*").alias("n_roads"))


def token_index(names: DataFrame, by: list[str], name: str = "road_name") -> DataFrame:
    """(by, token, name): each distinct token of each name."""
    return names.select(*by, name).distinct().withColumn("token", F.explode(F.array_distinct(index_tokens(F.col(name))))).select(*by, "token", name)


def exploded_phrases(rows: DataFrame, id_: str, address: str, keep: list[str] = ()) -> DataFrame:
    """(id, keep, rank, phrase, query): candidate phrases as rows, and the road name that each asks for."""
    out = rows.select(id_, *keep, F.explode(candidate_phrases(F.col(address))).alias("_p")).select(id_, *keep, "_p.rank", "_p.phrase")
    return out.withColumn("query", normalize_road(F.col("phrase"))).where("query <> ''")


def token_overlap_join(phrases: DataFrame, index: DataFrame, by: list[str], phrase: str = "query", name: str = "road_name") -> DataFrame:
    """(by, phrase, name, overlap): tokens that a phrase, repeats included, shares with a name."""
    asked = phrases.select(*by, phrase).distinct().withColumn("token", F.explode(index_tokens(F.col(phrase))))
    return asked.join(index, [*by, "token"]).groupBy(*by, phrase, name).agg(F.count("*").alias("overlap"))


def overlap_gate(overlaps: DataFrame, by: list[str], phrase: str = "query", name: str = "road_name", most: int = OVERFLOW_CANDIDATES) -> DataFrame:
    """Names with enough shared tokens: one for a phrase of one token, else two. Where none has, the ``most`` best.

    The number is part of what the operator means, not a guard: it is how many
    names the phrase's runner-up is sought among.
    """
    enough = F.col("overlap") >= F.when(F.size(index_tokens(F.col(phrase))) <= 1, 1).otherwise(2)
    flagged = overlaps.withColumn("_ok", enough).withColumn("_any", F.max("_ok").over(Window.partitionBy(*by, phrase)))
    good = flagged.where("_ok").drop("_ok", "_any")
    rest = top_candidates(flagged.where("not _any").drop("_ok", "_any"), [*by, phrase], "overlap", name, most)
    return good.unionByName(rest)


def road_candidates(phrases: DataFrame, layer: DataFrame, by: list[str]) -> DataFrame:
    """(by, query, road_name, overlap, score) of each distinct query. An equal name is the only candidate of its query."""
    asked = phrases.select(*by, "query").distinct()
    names = layer.select(*by, "road_name").distinct()
    exact = asked.join(names.withColumn("query", F.col("road_name")), [*by, "query"]).select(*by, "query", "road_name", F.lit(EXACT_OVERLAP).cast("bigint").alias("overlap"), F.lit(1.0).alias("score"))
    open_ = asked.join(exact, [*by, "query"], "left_anti")
    near = overlap_gate(token_overlap_join(open_, token_index(names, by), by), by)
    return exact.unionByName(scored(near, "query", "road_name", "score").where("score > 0").select(*exact.columns))


def street_match(phrases: DataFrame, layer: DataFrame, id_: str, by: list[str], min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN, count_overlap: bool = True, usable: DataFrame | None = None) -> DataFrame:
    """The first acceptable phrase of each row, one row per row that has phrases.

    (id, matched, rank, candidate_phrase, road_name, score, candidate_count).
    usable: (id, road_name) of roads that have something left inside the row's
    area; an accepted road that isn't there makes the next phrase be tried.
    candidate_count sums the candidates of the phrases tried; with
    ``count_overlap`` the accepted overlap is added. Without a match it sums
    all phrases and the other columns are null.
    """
    found = road_candidates(phrases, layer, by)
    best = best_with_margin(found, [*by, "query"]) if (min_score, min_margin) == (MIN_SCORE, MIN_MARGIN) else best_with_margin(found, [*by, "query"], min_score=min_score, min_margin=min_margin)
    best = best.join(found.groupBy(*by, "query").agg(F.count("*").alias("n")), [*by, "query"])
    tried = phrases.join(best, [*by, "query"], "left").withColumns({"n": F.coalesce("n", F.lit(0)), "accepted": F.coalesce("accepted", F.lit(False))})
    if usable is not None:
        tried = tried.join(usable.select(id_, "road_name").distinct().withColumn("_usable", F.lit(True)), [id_, "road_name"], "left").withColumn("accepted", F.col("accepted") & F.coalesce("_usable", F.lit(False))).drop("_usable")
    return first_acceptable(tried, id_, count_overlap)


def first_acceptable(tried: DataFrame, id_: str, count_overlap: bool = True) -> DataFrame:
    """Of phrases by rank, the first accepted one of each row, and the candidates counted up to it."""
    upto = Window.partitionBy(id_).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = tried.withColumn("_sum", F.sum("n").over(upto))
    pick = F.when(F.col("accepted"), F.struct("rank", "phrase", "road_name", "score", "_sum", "overlap"))
    out = rows.groupBy(id_).agg(F.min(pick).alias("_hit"), F.sum("n").alias("_all"))
    count = F.col("_hit._sum") + (F.col("_hit.overlap") if count_overlap else F.lit(0))
    return out.select(id_, F.col("_hit").isNotNull().alias("matched"), F.col("_hit.rank").alias("rank"), F.col("_hit.phrase").alias("candidate_phrase"), F.col("_hit.road_name").alias("road_name"), F.col("_hit.score").alias("score"), F.coalesce(count, F.col("_all")).alias("candidate_count"))
