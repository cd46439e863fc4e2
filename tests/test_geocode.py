"""A hand-made gazetteer: every status, reason and rule whose result can be worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as g
from tessera.operators import results
from tessera.operators.fallback import row_fraction
from tessera.plans.geocode import city_boxes, district_boxes, geocode_boxes, geocode_levels, retry_national
from tessera.schema import AREAS, FACILITY, PARTS, ROADS


def ring(x0, y0, x1, y1):
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def area(province, city, district, village, *box):
    return (province, city, district, village, ring(*box), *map(float, box))


def road(i, name, *points):
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return (i, name, [[(float(x), float(y)) for x, y in points]], float(min(xs)), float(min(ys)), float(max(xs)), float(max(ys)))


@pytest.fixture(scope="module")
def world(spark):
    areas = [
        area("PROV SATU", "Kota C", "Kec. D", "V A", 0.0, 0.0, 5.0, 5.0), area("PROV SATU", "Kota C", "Kec. D", "V B", 0.0, 5.0, 5.0, 10.0), area("PROV SATU", "Kota C", "Kec. E", "V C", 5.0, 0.0, 10.0, 5.0), area("PROV SATU", "Kota C", "Kec. E", "V D", 5.0, 5.0, 10.0, 10.0),
        area("PROV DUA", "Kota C", "Kec. F", "V A", 100.0, 0.0, 110.0, 10.0), area("PROV DUA", "Kab. Sepi", "Kec. G", "V X", 200.0, 0.0, 210.0, 10.0),
    ]
    roads = [
        road(1, "Jl. Mawar", (0, 2), (10, 2)), road(2, "JL MAWAR", (0, 8), (4, 8)), road(3, "Melati Indah", (1, 1), (1, 4)), road(4, "Melati Indah Dua", (2, 1), (2, 4)),
        road(5, "Jl Anggrek Putih", (-5, 6), (5, 6)), road(6, None, (6, 1), (9, 1)), road(7, "Unnamed Road", (6, 7), (9, 7)), road(8, "Jl. Kenanga", (120, 50), (130, 50)),
    ]
    rows = [
        (2, "Prov Satu", "Kota C", "D", "V A", "Jl. Mawar No. 5, RT 1"), (3, "Prov Satu", "Kota C", "D", "V A", "Jl. Anggrek Putih"), (4, "Prov Satu", "Kota C", "E", "V C", "Depan pasar"), (5, "Prov Satu", "Kota C", "E", "V D", None),
        (6, "Prov Satu", "Kota C", "X Y Z", "Q", "zzzz"), (7, "Nowhere At All", "Kota C", "D", "V A", "Jl. Mawar"), (8, "Prov Dua", "Sepi", "G", "V X", "Jl. Mawar"), (9, "Prov Dua", "Sepi", "Qqqq", "Wwww", "x"), (10, "Prov Satu", "Kota C", "D", "V A", "Melati Indah"),
        (11, "Prov Dua", "Sepi", "G", "Zzzzzz", "x"),
    ]
    facilities = spark.createDataFrame([(r[0], r[0] - 1, *r[1:], "N") for r in rows], FACILITY)
    return facilities, spark.createDataFrame(areas, AREAS), spark.createDataFrame(roads, ROADS)


@pytest.fixture(scope="module")
def geocoded(world):
    return geocode_levels(*world).persist()


def test_levels(geocoded):
    got = {r.source_row: r for r in geocoded.collect()}
    assert len(got) == 10
    assert (got[2].latitude, got[2].longitude, got[2].match_by, got[2].reason, got[2].matched_road_name) == (2.0, 7.0, "jalan", "matched_by_jalan", "MAWAR")
    assert (got[3].latitude, got[3].longitude, got[3].matched_road_name) == (6.0, 2.5, "ANGGREK PUTIH")
    assert got[4].match_by == "kelurahan/desa" and 5 <= got[4].longitude <= 10 and got[4].latitude in (1.0, 2.0)
    assert got[5].match_by == "kelurahan/desa" and got[5].latitude == 7.0 and got[5].reason == "matched_by_kelurahan/desa"
    assert got[6].match_by == "kabupaten/kota" and got[6].status == "matched"
    assert got[7].reason == "kabupaten_kota_boundary_not_found" and got[7].latitude is None and got[7].candidate_count == 0
    assert (got[8].status, got[8].reason) == ("unresolved", "no_road_found_in_boundaries")
    assert got[9].reason == "kelurahan_dan_kecamatan_boundary_not_found" and got[11].reason == "kelurahan_boundary_not_found"
    assert (got[10].matched_road_name, got[10].match_score, got[10].longitude, got[10].latitude) == ("MELATI INDAH", 1.0, 1.0, 2.5)
    assert got[10].candidate_count == 10_001


def test_same_seed_same_point(world):
    draw = lambda seed: [r.f for r in world[0].orderBy("source_row").select(row_fraction("kecamatan", seed).alias("f")).collect()]
    assert draw(1) == draw(1) != draw(2) and all(0 <= f < 1 for f in draw(1))


def test_city_boxes_and_retry(world):
    rows, areas, roads = world
    boxes = city_boxes(areas)
    assert {r.kabkota_key: (r.minx, r.maxx) for r in boxes.collect()} == {"C": (0.0, 110.0), "SEPI": (200.0, 210.0)}
    got = {r.source_row: r for r in geocode_boxes(rows, boxes, roads).collect()}
    assert got[2].status == "matched" and got[2].reason == "matched" and got[7].status == "matched"
    assert got[5].reason == "no_address_candidate" and got[6].reason == "road_candidate_not_matched" and got[8].status == "unresolved"
    national = results.combine([("a.xlsx", geocode_boxes(rows.where("source_row < 6"), boxes, roads)), ("b.xlsx", geocode_boxes(rows.where("source_row >= 6"), boxes, roads))])
    out, open_ = retry_national(national, boxes, roads)
    kinds = {r.source_row: r.retry_status for r in out.collect()}
    assert kinds[2] == "already_matched" and kinds[6] == "still_unresolved" and {r.source_row for r in open_.collect()} == {k for k, v in kinds.items() if v in ("still_unresolved", "unresolved")}


def test_district_cascade(world):
    got = {r.source_row: (r.level_used, r.box.minx if r.box else None) for r in district_boxes(world[0], world[1]).collect()}
    assert got[2] == (3, 0.0) and got[6] == (2, 0.0) and got[7] == (None, None) and got[9] == (2, 200.0)


def test_polygon_clip(spark):
    line = [[(-1.0, 1.0), (5.0, 1.0)]]
    rows = spark.createDataFrame([(line, ring(0.0, 0.0, 2.0, 2.0) + ring(3.0, 0.0, 4.0, 2.0))], f"parts {PARTS}, rings {PARTS}")
    got = rows.select(g.clip_to_polygon("parts", "rings").alias("c"), g.line_length(F.col("parts")).alias("n"), g.ring_area(F.col("rings")[0]).alias("a"), *g.box_of(F.col("parts"))).first()
    assert [[(p.x, p.y) for p in part] for part in got.c] == [[(0.0, 1.0), (2.0, 1.0)], [(3.0, 1.0), (4.0, 1.0)]] and got.n == 6.0 and got.a == 4.0 and got.minx == -1.0
    meet = spark.createDataFrame([(ring(0.0, 0.0, 2.0, 2.0), ring(1.0, 1.0, 3.0, 3.0)), (ring(0.0, 0.0, 1.0, 1.0), ring(5.0, 5.0, 6.0, 6.0))], f"a {PARTS}, b {PARTS}")
    assert [r.m for r in meet.select(g.rings_meet("a", "b").alias("m")).collect()] == [True, False]


def test_resume_and_write_back(world, geocoded):
    rows = world[0]
    res = geocoded.select("source_row", "latitude", "longitude", "match_by", "status")
    main, review = results.write_back(rows, res), res.where("status <> 'matched'")
    assert results.resume(rows, results.processed(main, review)).count() == 0
    assert results.resume(rows, results.processed(main.where("source_row < 5"), review.limit(0))).count() == 7
    with pytest.raises(Exception, match="more than one result"):
        results.write_back(rows, res.union(res)).collect()
    with pytest.raises(ValueError, match="missing"):
        results.require_columns(rows, ["nope"])
