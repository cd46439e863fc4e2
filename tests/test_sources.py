"""Sources and the stream of arriving rows."""

import struct

import pytest
from pyspark.sql import functions as F

from tessera.schema import FACILITY, INPUT_COLUMNS
from tessera.sources import html, shapefile, tables, xlsx
from tessera.streaming.geocode import facilities, geocode_stream

PAGE = """<p><a href="?page=3">3</a> <A HREF='list?x=1&page=12'>12</A> <a href="?page=x">x</a></p>
<table><tr><th>No</th><th>b</th><th>c</th><th>d</th><th>e</th><th>f</th><th>g</th></tr><tr><td> 1 </td><td>A <b>B</b>\nC</td><td>c</td><td>d</td><td>e</td><td>f &amp; g</td><td></td></tr><tr><td>short</td></tr></table>
<table><tr><td>2</td><td>b</td><td>c</td><td>d</td><td>e</td><td>f</td><td>g</td></tr></table>"""


def test_html(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>nothing")], "page_id long, html string")
    assert html.last_page(pages).first().last_page == 12 and {r.page_id: r.last_page for r in html.last_page(pages, by=["page_id"]).collect()} == {1: 12, 2: 1, 3: 1}
    rows = html.listing(pages).collect()
    assert len(rows) == 1 and rows[0]["No"] == 1 and rows[0]["Provinsi SPPG"] == "A B C" and rows[0]["Alamat SPPG"] == "f & g" and rows[0]["Nama SPPG"] == ""


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, *(f"{c} & <{i}>\n" for c in INPUT_COLUMNS[1:-1]), None) for i in range(1, 40)], ", ".join(f"`{c}` {'long' if i == 0 else 'string'}" for i, c in enumerate(INPUT_COLUMNS)))
    path = str(tmp_path / "a.xlsx")
    xlsx.write_xlsx({"Sheet1": df.coalesce(1), "unresolved_rows": df.limit(1)}, path)
    back = xlsx.read_xlsx(spark, path)
    assert back.count() == 39 and back.columns == ["source_workbook", "source_row", *INPUT_COLUMNS]
    first = back.orderBy("source_row").first()
    assert first.source_row == 2 and first["No"] == "1" and first["Provinsi SPPG"] == "Provinsi SPPG & <1>\n" and first["Nama SPPG"] is None and first.source_workbook == "a.xlsx"
    assert xlsx.read_xlsx(spark, path, "unresolved_rows").count() == 1
    with pytest.raises(ValueError):
        xlsx.read_xlsx(spark, path, "nope")


def shape(kind, parts):
    points = [p for part in parts for p in part]
    starts, n = [], 0
    for part in parts:
        starts.append(n)
        n += len(part)
    body = struct.pack("<i4d2i", kind, 0, 0, 0, 0, len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
    return body


def test_shapefile(spark, tmp_path):
    records = [shape(3, [[(0, 0), (1, 1)], [(2, 2), (3, 5)]]), struct.pack("<i", 0), shape(3, [[(50, 50), (60, 60)]])]
    data = bytes(100) + b"".join(struct.pack(">2i", i + 1, len(r) // 2) + r for i, r in enumerate(records))
    (tmp_path / "roads.shp").write_bytes(data)
    names = [b"Jl. Mawar ", b"          ", b"X         "]
    head = struct.pack("<B3BIHH20x", 3, 0, 0, 0, 3, 32 + 32 + 1, 11) + b"name".ljust(11, b"\0") + b"C" + bytes(4) + bytes([10, 0]) + bytes(14) + b"\r"
    (tmp_path / "roads.dbf").write_bytes(head + b"".join(b" " + n for n in names))
    rows = shapefile.read_shapefile(spark, str(tmp_path), ["name", "other"]).orderBy("shape_id").collect()
    assert [(r.shape_id, r.name, r.other, len(r.parts), r.maxy) for r in rows] == [(0, "Jl. Mawar", None, 2, 5.0), (2, "X", None, 1, 60.0)]
    assert shapefile.read_shapefile(spark, str(tmp_path), ["name"], bbox=(0, 0, 10, 10)).count() == 1


def test_cache_batches_and_pushdown(spark, tmp_path):
    made = []
    build = lambda: made.append(1) or spark.range(5)
    for _ in range(2):
        assert tables.cached_or_build(spark, f"{tmp_path}/c", build).count() == 5
    assert len(made) == 1 and tables.cached_or_build(spark, f"{tmp_path}/c", build, rebuild=True).count() == 5 and len(made) == 2
    for v in ("a", "b", "a"):
        tables.write_batch(spark.range(3).withColumn("job_key", F.lit(v)), f"{tmp_path}/d")
    assert spark.read.parquet(f"{tmp_path}/d").count() == 6
    spark.range(3).selectExpr("cast(id as double) minx", "cast(id as double) miny", "cast(id as double) maxx", "cast(id as double) maxy").write.parquet(f"{tmp_path}/e")
    near = tables.roads_in_box(spark.read.parquet(f"{tmp_path}/e"), 0.5, 0.5, 1.5, 1.5)
    assert near.count() == 1 and "PushedFilters: [IsNotNull" in near._jdf.queryExecution().toString()


def test_stream_counts_each_row_once(spark, tmp_path):
    rows = spark.createDataFrame([(i, i, "p", "k", "c", "l", "a", "n") for i in range(2, 8)], FACILITY)
    geocode = lambda df: df.select("source_row", F.lit(1.0).alias("latitude"))
    for part in (rows.where("source_row < 5"), rows.where("source_row >= 4")):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        geocode_stream(facilities(spark, f"{tmp_path}/in"), geocode, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sorted(r.source_row for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(2, 8))
