"""Facilities to coordinates: one distributed plan over all provinces and cities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import bbox_join, boxes_meet, clip_segments_to_box, clip_to_polygon, point_at_fraction, representative_point, segments
from ..functions.text import candidate_phrases
from ..operators.admin import BOX, KEYS, bbox_rollup, build_catalog, key_cascade, resolve_hierarchy, resolve_names, with_keys
from ..operators.lineage import cut
from ..operators.fallback import row_fraction, roads_in_areas, weighted_sample
from ..operators.results import apply_retry, unresolved
from ..operators.roads import exploded_phrases, road_layer, street_match
from ..schema import DEFAULT_SEED, LEVELS, MIN_MARGIN, MIN_SCORE, RELAXED_MARGIN, RELAXED_SCORE

JOB = ["r_province", "r_kabkota"]


def job_roads(areas: DataFrame, roads: DataFrame, job: list[str], cell: float = 0.25) -> DataFrame:
    """Roads whose box meets a job's box, once for each job."""
    return bbox_join(areas.select(*job, *BOX), roads.select("road_id", "name", "parts", *BOX), cell).drop(*BOX)


def _usable(hits: DataFrame, areas: DataFrame, layer: DataFrame, job: list[str]) -> DataFrame:
    """(job, road_name, clipped) of the named roads that have a stretch inside their job's polygon."""
    pairs = hits.select(*job, "road_name").distinct().join(layer, [*job, "road_name"]).join(areas.select(*job, "rings"), job)
    return pairs.withColumn("clipped", clip_to_polygon("parts", "rings")).where(F.size("clipped") > 0).select(*job, "road_name", "clipped")


def geocode_levels(rows: DataFrame, admin: DataFrame, roads: DataFrame, seed: int = DEFAULT_SEED, exact_fractions: bool = False, min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN, cell: float = 0.25) -> DataFrame:
    """Each facility with coordinates, how they were found, or why not.

    A street of the resolved city that the address names, clipped to the city
    and halved; else a point drawn from the roads of the village, the district
    or the city. Streets compete among all roads of the city's box; a street
    with nothing inside the city makes the next phrase be tried.
    """
    catalog = {level: cut(area) for level, area in build_catalog(admin).items()}
    rows = resolve_hierarchy(rows, catalog)
    cities = catalog["kabkota"].withColumnsRenamed({"province_key": "r_province", "kabkota_key": "r_kabkota"})
    known = rows.where("r_province is not null and r_kabkota is not null")
    wanted = cities.join(known.select(*JOB).distinct(), JOB, "left_semi")
    near = job_roads(wanted, roads, JOB, cell)
    layer = cut(road_layer(near, JOB))
    phrases = cut(exploded_phrases(known, "source_row", "address", JOB))
    clipped = cut(_usable(layer.join(phrases.select(*JOB).distinct(), JOB, "left_semi"), wanted, layer, JOB))
    usable = phrases.select("source_row", *JOB).distinct().join(clipped, JOB).select("source_row", "road_name")
    street = cut(street_match(phrases, layer, "source_row", JOB, min_score, min_margin, True, usable))
    halves = segments(clipped.withColumnRenamed("clipped", "_c"), "_c", [*JOB, "road_name"])
    middle = point_at_fraction(halves, [*JOB, "road_name"], ["part", "seg"], F.lit(0.5)).drop("total")
    matched = known.select("source_row", *JOB).join(street, "source_row").where("matched").join(middle, [*JOB, "road_name"], "left")
    matched = cut(matched)
    rest = known.join(matched.select("source_row"), "source_row", "left_anti")
    areas = []
    for n, (level, depth, keys) in enumerate(((LEVELS[0], "kelurahan", ["r_province", "r_kabkota", "r_kecamatan_of", "r_kelurahan"]), (LEVELS[1], "kecamatan", ["r_province", "r_kabkota", "r_kecamatan"]), (LEVELS[2], "kabkota", JOB)), 1):
        area = catalog[depth].withColumnsRenamed(dict(zip(KEYS, keys))).withColumn("area_key", F.concat_ws("\t", F.lit(level), *keys))
        areas.append(rest.join(area.select(*keys, "area_key", "rings", *BOX), keys).select(*rest.columns, F.lit(n).alias("level_rank"), F.lit(level).alias("level"), "area_key", "rings", *BOX))
    tries = cut(areas[0].unionByName(areas[1]).unionByName(areas[2]))
    pieces = cut(roads_in_areas(tries.select("area_key", "rings", *BOX).dropDuplicates(["area_key"]), roads, "area_key", cell))
    have = pieces.select("area_key").distinct()
    order = Window.partitionBy("source_row").orderBy("level_rank")
    chosen = tries.join(have, "area_key", "left_semi").withColumn("_r", F.row_number().over(order)).where("_r = 1").withColumn("fraction", row_fraction(F.col("level"), seed, exact_fractions))
    chosen = cut(chosen)
    drawn = pieces.join(chosen.select("source_row", "area_key", "fraction"), "area_key")
    points = weighted_sample(drawn, ["source_row"], ["road_id", "part", "seg"], F.col("fraction")).drop("total")
    sampled = chosen.select("source_row", "level").join(points, "source_row")
    out = rows.join(matched.select("source_row", F.col("x").alias("_mx"), F.col("y").alias("_my")), "source_row", "left")
    out = out.join(street, "source_row", "left").join(sampled.withColumnsRenamed({"x": "_sx", "y": "_sy"}), "source_row", "left")
    by_street, by_area = F.coalesce(F.col("matched"), F.lit(False)), F.col("level").isNotNull()
    no_city = F.col("r_province").isNull() | F.col("r_kabkota").isNull()
    reason = (
        F.when(no_city, "kabupaten_kota_boundary_not_found").when(by_street, "matched_by_jalan").when(by_area, F.concat(F.lit("matched_by_"), "level"))
        .when(F.col("r_kelurahan").isNull() & F.col("r_kecamatan").isNull(), "kelurahan_dan_kecamatan_boundary_not_found").when(F.col("r_kelurahan").isNull(), "kelurahan_boundary_not_found")
        .when(F.col("r_kecamatan").isNull(), "kecamatan_boundary_not_found").otherwise("no_road_found_in_boundaries")
    )
    return out.select(
        "source_row", "no", "province", "kabkota", "kecamatan", "kelurahan", "address", "name",
        F.coalesce("_my", "_sy").alias("latitude"), F.coalesce("_mx", "_sx").alias("longitude"), F.when(by_street, "jalan").otherwise(F.col("level")).alias("match_by"),
        F.when(~no_city & (by_street | by_area), "matched").otherwise("unresolved").alias("status"), reason.alias("reason"),
        F.when(by_street, F.col("candidate_phrase")).alias("candidate_phrase"), F.when(by_street, F.col("road_name")).alias("matched_road_name"), F.when(by_street, F.col("score")).alias("match_score"),
        F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"),
    )


def city_boxes(admin: DataFrame) -> DataFrame:
    """(kabkota_key, box) of cities of all provinces, those of one name together."""
    rows = with_keys(admin.where("rings is not null"), "province_name", "kabkota_name", "kecamatan_name", "kelurahan_name").where("kabkota_key <> ''")
    return rows.groupBy("kabkota_key").agg(*(F.min(b).alias(b) for b in BOX[:2]), *(F.max(b).alias(b) for b in BOX[2:]))


def geocode_boxes(rows: DataFrame, boxes: DataFrame, roads: DataFrame, min_score: float = MIN_SCORE, min_margin: float = MIN_MARGIN, strict: bool = False, cell: float = 0.25) -> DataFrame:
    """Each facility with a point on a street of its city's box, or why it has none.

    boxes: (kabkota_key, box). With ``strict`` a row without a city is an error.
    Roads are clipped to the box; one that only touches it counts.
    """
    keyed = with_keys(rows)
    resolved = resolve_names(keyed, boxes.select(F.col("kabkota_key").alias("c")), [], "kabkota_key", "c", "r_kabkota", unique_stages=False).drop("stage")
    if strict:
        resolved = resolved.withColumn("r_kabkota", F.coalesce("r_kabkota", F.raise_error(F.concat(F.lit("no boundary for "), F.coalesce("kabkota", F.lit("null"))))))
    job = ["r_kabkota"]
    resolved = cut(resolved)
    known = resolved.where("r_kabkota is not null")
    areas = boxes.withColumnRenamed("kabkota_key", "r_kabkota").join(known.select(*job).distinct(), job, "left_semi")
    layer = cut(road_layer(job_roads(areas, roads, job, cell), job))
    phrases = cut(exploded_phrases(known, "source_row", "address", job))
    parts = layer.join(areas, job)
    inside = clip_segments_to_box(segments(parts, "parts", [*job, "road_name", *BOX])).groupBy(*job, "road_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "seg", "x1", "y1", "x2", "y2"))), lambda s: F.array(F.struct(s["x1"].alias("x"), s["y1"].alias("y")), F.struct(s["x2"].alias("x"), s["y2"].alias("y")))).alias("pieces"))
    inside = cut(inside)
    usable = phrases.select("source_row", *job).distinct().join(inside.select(*job, "road_name"), job).select("source_row", "road_name")
    street = cut(street_match(phrases, layer, "source_row", job, min_score, min_margin, False, usable))
    points = inside.withColumn("_p", representative_point(F.col("pieces"))).select(*job, "road_name", "_p")
    out = resolved.join(street, "source_row", "left").join(points, [*job, "road_name"], "left")
    ok, no_phrase = F.coalesce(F.col("matched"), F.lit(False)), F.size(candidate_phrases(F.col("address"))) == 0
    reason = F.when(F.col("r_kabkota").isNull(), "kabkota_boundary_not_found").when(ok, "matched").when(no_phrase, "no_address_candidate").otherwise("road_candidate_not_matched")
    return out.select(
        "source_row", "no", "province", "kabkota", "kecamatan", "kelurahan", F.when(ok, F.col("_p.y")).alias("latitude"), F.when(ok, F.col("_p.x")).alias("longitude"), "address", "name",
        F.when(ok, "matched").otherwise("unresolved").alias("status"), reason.alias("reason"), F.when(F.col("r_kabkota").isNotNull(), "kabkota").alias("admin_level_used"),
        F.when(ok, F.col("candidate_phrase")).alias("candidate_phrase"), F.when(ok, F.col("road_name")).alias("matched_road_name"), F.when(ok, F.col("score")).alias("match_score"), F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"),
    )


def district_boxes(rows: DataFrame, admin: DataFrame) -> DataFrame:
    """Rows with the box of their district, else their city, else their province, and how many keys it took."""
    keyed = with_keys(admin.where("rings is not null"), "province_name", "kabkota_name", "kecamatan_name", "kelurahan_name").where("province_key <> '' and kabkota_key <> '' and kecamatan_key <> ''")
    rolled = bbox_rollup(keyed, KEYS[:3]).withColumn("box", F.struct(*BOX))
    return key_cascade(with_keys(rows), [(KEYS[:n], rolled.where(F.col("level") == n)) for n in (3, 2, 1)], "box")


def retry_national(national: DataFrame, boxes: DataFrame, roads: DataFrame, key: list[str] = ("source_rank", "source_row")) -> tuple[DataFrame, DataFrame]:
    """All national rows after a second, looser pass over those without coordinates, and those that still have none."""
    key = list(key)
    named = national.withColumn("_id", F.xxhash64(*key))
    asked = named.where(unresolved()).select(F.col("_id").alias("source_row"), "no", "province", "kabkota", "kecamatan", "kelurahan", "address", "name")
    found = geocode_boxes(asked, boxes, roads, RELAXED_SCORE, RELAXED_MARGIN).withColumnRenamed("source_row", "_id")
    back = named.select("_id", *key).join(found, "_id").drop("_id")
    out = apply_retry(national, back, key)
    return out.orderBy(*key), out.where(unresolved()).orderBy(*key)


def meeting_children(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Pairs of boundaries whose boxes meet; the exact test follows on these only."""
    return parents.alias("a").join(children.alias("b"), boxes_meet("a", "b"))
