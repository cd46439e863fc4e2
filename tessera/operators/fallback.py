"""Points for rows without a street match: a length-weighted draw from the roads of ever larger areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fractions import hash_fraction, mersenne_fraction, payload
from ..functions.geometry import bbox_join, clip_to_polygon, point_at_fraction, segments
from ..schema import DEFAULT_SEED


def weighted_sample(segs: DataFrame, by: list[str], order: list[str], fraction: Column) -> DataFrame:
    """(by, x, y, total): a point that every stretch of a group's lines is as likely to hold as it is long."""
    return point_at_fraction(segs, by, order, fraction)


def roads_in_areas(areas: DataFrame, roads: DataFrame, key: str, cell: float = 0.25) -> DataFrame:
    """(key, road_id, part, seg, x1, y1, x2, y2, length) of roads, named or not, clipped to polygons.

    areas: key, rings, box; roads: road_id, parts, box. Boxes meet through a
    grid join; only roads whose box meets an area's reach the clip.
    """
    pairs = bbox_join(areas.select(key, "rings", "minx", "miny", "maxx", "maxy"), roads.select("road_id", "parts", "minx", "miny", "maxx", "maxy"), cell)
    clipped = pairs.withColumn("parts", clip_to_polygon("parts", "rings")).select(key, "road_id", "parts")
    return segments(clipped, "parts", [key, "road_id"])


def row_fraction(level: Column | str, seed: int = DEFAULT_SEED, exact: bool = False) -> Column:
    """The fraction of a facility row at a level of the chain."""
    text = payload(seed, level, F.col("source_row"), F.col("no"), F.col("province"), F.col("kabkota"), F.col("kecamatan"), F.col("kelurahan"), F.col("name"))
    return mersenne_fraction(text) if exact else hash_fraction(text)


def fallback_chain(candidates: DataFrame, id_: str, level: str, value: str) -> DataFrame:
    """The value of the first level of each row that has one; levels are numbers, 1 first."""
    order = Window.partitionBy(id_).orderBy(level)
    return candidates.where(F.col(value).isNotNull()).withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
