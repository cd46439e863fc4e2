"""Shapefiles: lines and polygons with their attributes, read with the standard library.

A shapefile is a pair of files that is read whole by one task; many are read in
parallel. For repeated use convert them to Parquet once: the four box columns
then let row groups be skipped.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PARTS

LINES, POLYGONS = (3, 13, 23), (5, 15, 25)


def shapes(data: bytes) -> Iterator[tuple[int, list[list[tuple[float, float]]] | None]]:
    """(type, parts) of each record; null shapes have no parts."""
    at = 100
    while at + 12 <= len(data):
        (words,) = struct.unpack_from(">i", data, at + 4)
        at += 8
        (kind,) = struct.unpack_from("<i", data, at)
        if kind in LINES + POLYGONS:
            n_parts, n_points = struct.unpack_from("<2i", data, at + 36)
            starts = [*struct.unpack_from(f"<{n_parts}i", data, at + 44), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", data, at + 44 + 4 * n_parts)
            points = list(zip(flat[::2], flat[1::2], strict=True))
            yield kind, [points[a:b] for a, b in zip(starts, starts[1:])]
        else:
            yield kind, None
        at += 2 * words


def attributes(data: bytes, encoding: str = "utf-8") -> Iterator[dict[str, str | None]]:
    """Attribute rows of a dBASE table as text; empty values are null."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 13:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("ascii"), data[at + 16]))
        at += 32
    for i in range(n):
        at, row = head + i * size + 1, {}
        for name, width in fields:
            row[name] = data[at : at + width].decode(encoding, "replace").strip(" \0") or None
            at += width
        yield row


def read_shapefile(spark: SparkSession, path: str, columns: list[str], geometry: str = "parts", encoding: str = "utf-8", bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """(shape_id, columns, geometry, box) of the shapefiles under ``path``; only shapes that meet ``bbox`` where it is given.

    An attribute that a file lacks is null; shapes without geometry are left out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{shp,dbf}").load(path)
    files = files.select(F.regexp_replace("path", r"\.(shp|dbf)$", "").alias("stem"), F.when(F.col("path").endswith(".shp"), F.col("content")).alias("shp"), F.when(F.col("path").endswith(".dbf"), F.col("content")).alias("dbf"))
    pairs = files.groupBy("stem").agg(F.max("shp").alias("shp"), F.max("dbf").alias("dbf")).where("shp is not null")
    points = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shp, dbf in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                rows = attributes(dbf, encoding) if dbf else iter(())
                out = []
                for i, (_, parts) in enumerate(shapes(shp)):
                    row = next(rows, {})
                    if not parts:
                        continue
                    xs, ys = [x for p in parts for x, _ in p], [y for p in parts for _, y in p]
                    box = min(xs), min(ys), max(xs), max(ys)
                    if bbox is None or box[0] <= bbox[2] and box[2] >= bbox[0] and box[1] <= bbox[3] and box[3] >= bbox[1]:
                        out.append((i, row, parts, box))
                yield pa.RecordBatch.from_arrays([
                    pa.array([o[0] for o in out], pa.int64()), *(pa.array([o[1].get(c) for o in out], pa.string()) for c in columns),
                    pa.array([[[{"x": x, "y": y} for x, y in p] for p in o[2]] for o in out], points), *(pa.array([o[3][k] for o in out], pa.float64()) for k in range(4)),
                ], ["shape_id", *columns, geometry, "minx", "miny", "maxx", "maxy"])

    schema = f"shape_id bigint, {', '.join(f'`{c}` string' for c in columns)}, {geometry} {PARTS}, minx double, miny double, maxx double, maxy double"
    return pairs.mapInArrow(run, schema)
