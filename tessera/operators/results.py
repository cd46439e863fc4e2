"""Results: main and review tables, resuming, retrying, regional outputs made national."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import INPUT_COLUMNS, SHORT_COLUMNS

MAIN = [*SHORT_COLUMNS, "latitude", "longitude", "match_by"]
REVIEW = ["source_row", *SHORT_COLUMNS, "latitude", "longitude", "match_by", "status", "reason", "candidate_phrase", "matched_road_name", "match_score", "candidate_count"]
MAIN_V1 = ["no", "province", "kabkota", "kecamatan", "kelurahan", "latitude", "longitude", "address", "name"]
REVIEW_V1 = ["source_row", *SHORT_COLUMNS, "status", "reason", "admin_level_used", "candidate_phrase", "matched_road_name", "match_score", "candidate_count"]


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """``df``, or an error that lists the columns it lacks."""
    if missing := [c for c in needed if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def shorten(df: DataFrame) -> DataFrame:
    """Workbook column names made short."""
    return df.withColumnsRenamed(dict(zip(INPUT_COLUMNS, SHORT_COLUMNS, strict=True)))


def lengthen(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(dict(zip(SHORT_COLUMNS, INPUT_COLUMNS, strict=True)) | {"latitude": "Latitude", "longitude": "Longitude", "match_by": "Match_By"})


def unresolved(lat: str = "latitude", lon: str = "longitude"):
    return F.col(lat).isNull() | F.col(lon).isNull()


def split_results(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Main rows with all inputs, and review rows of those that aren't matched."""
    return results.select(*[c for c in MAIN if c in results.columns]), results.where(F.col("status") != "matched").select(*[c for c in REVIEW if c in results.columns])


def write_back(rows: DataFrame, results: DataFrame, key: str = "source_row") -> DataFrame:
    """Rows with their results. A key with two results is an error."""
    counted = results.groupBy(key).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in results.columns if c != key))
    checked = counted.withColumn("_n", F.when(F.col("_n") == 1, F.col("_n")).otherwise(F.raise_error(F.concat(F.lit("more than one result for row "), F.col(key).cast("string"))).cast("bigint")))
    return rows.join(checked, key, "left").where(F.coalesce("_n", F.lit(1)) == 1).drop("_n")


def processed(main: DataFrame, review: DataFrame, key: str = "source_row") -> DataFrame:
    """Keys that are done: with coordinates in the main table, or listed for review with a whole number."""
    have = main.where(~unresolved())
    if "match_by" in main.columns:
        have = have.where("match_by is not null")
    return have.select(key).union(review.select(F.col(key).cast("string").try_cast("bigint")).where(F.col(key).isNotNull())).distinct()


def resume(rows: DataFrame, done: DataFrame, key: str = "source_row") -> DataFrame:
    """Rows that aren't done."""
    return rows.join(done.select(key), key, "left_anti")


def progress(results: DataFrame, by: list[str] = ()) -> DataFrame:
    return results.groupBy(*by).agg(F.count_if(F.col("status") == "matched").alias("matched"), F.count_if(F.col("status") != "matched").alias("unresolved"))


def combine(regions: list[tuple[str, DataFrame]]) -> DataFrame:
    """Regional tables one below the other, by name; missing columns are null. Adds source_workbook last, and source_rank."""
    parts = [df.withColumns({"source_workbook": F.lit(name), "source_rank": F.lit(rank)}) for rank, (name, df) in enumerate(regions)]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*[c for c in out.columns if c not in ("source_workbook", "source_rank")], "source_rank", "source_workbook")


def apply_retry(rows: DataFrame, retried: DataFrame, key: list[str]) -> DataFrame:
    """National rows after a second pass over those without coordinates.

    retried: key, latitude, longitude, status, reason, candidate_phrase,
    matched_road_name, match_score of the rows tried; those found get their
    coordinates, the others the reason they have none.
    """
    names = ["latitude", "longitude", "status", "reason", "candidate_phrase", "matched_road_name", "match_score"]
    new = retried.select(*key, *(F.col(c).alias(f"_{c}") for c in names))
    out = rows.join(new, key, "left")
    open_ = unresolved()
    found = open_ & (F.col("_status") == "matched")
    status = F.when(~open_, "already_matched").when(found, "fuzzy_matched").when(F.col("_reason") == "kabkota_boundary_not_found", "unresolved").otherwise("still_unresolved")
    out = out.withColumns({"retry_status": status, "retry_reason": F.when(~open_, "existing_output").otherwise(F.col("_reason")), "_found": found})
    out = out.withColumns({f"retry_{c}": F.when(~F.col("retry_status").eqNullSafe("already_matched"), F.col(f"_{c}")) for c in names[4:]})
    out = out.withColumns({c: F.when(F.col("_found"), F.col(f"_{c}")).otherwise(F.col(c)) for c in names[:2]})
    return out.drop("_found", *(f"_{c}" for c in names))


def numbers(c):
    """Text as a whole number, or null; '1.0' is 1."""
    whole = F.trim(c.cast("string"))
    return F.coalesce(whole.try_cast("bigint"), F.when(whole.try_cast("double") == F.floor(whole.try_cast("double")), whole.try_cast("double").cast("bigint")))
