"""Coverage vectors: the first feature's geometry of GeoJSON, GeoPackage and shapefile contents, as GeoJSON text.

Files come as a table (path, content), as Spark's `binaryFile` gives it.  Formats are told by the content, not by the name.
"""

from __future__ import annotations

import json
import sqlite3
import struct

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from soundgrid.ship import ship

# fixed values: geometry types of the well-known binary form, and the envelopes' sizes of a GeoPackage blob
KINDS = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
ENVELOPES = (0, 32, 48, 48, 64)


def _from_wkb(data: bytes, at: int = 0) -> tuple[dict, int]:
    """(geometry, position after it) of well-known binary, with or without further coordinates and an embedded reference system."""
    order = "<" if data[at] else ">"
    word = struct.unpack_from(f"{order}I", data, at + 1)[0]
    at += 5
    plain = word & 0x0FFFFFFF
    dims = 2 + (bool(word & 0x80000000) or plain // 1000 in (1, 3)) + (bool(word & 0x40000000) or plain // 1000 in (2, 3))
    if word & 0x20000000:
        at += 4
    kind = KINDS[plain % 1000]

    def points(n):
        nonlocal at
        made = [list(struct.unpack_from(f"{order}{dims}d", data, at + 8 * dims * k)) for k in range(n)]
        at += 8 * dims * n
        return made

    def number():
        nonlocal at
        at += 4
        return struct.unpack_from(f"{order}I", data, at - 4)[0]

    if kind == "Point":
        return {"type": kind, "coordinates": points(1)[0]}, at
    if kind == "LineString":
        return {"type": kind, "coordinates": points(number())}, at
    if kind == "Polygon":
        return {"type": kind, "coordinates": [points(number()) for _ in range(number())]}, at
    parts = []
    for _ in range(number()):
        part, at = _from_wkb(data, at)
        parts.append(part)
    return ({"type": kind, "geometries": parts} if kind == "GeometryCollection" else {"type": kind, "coordinates": [p["coordinates"] for p in parts]}), at


def _geopackage(content: bytes) -> dict | None:
    db = sqlite3.connect(":memory:")
    try:
        db.deserialize(content)
        found = db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY table_name").fetchone()
        if not found:
            return None
        quoted = ['"' + x.replace('"', '""') + '"' for x in found]
        row = db.execute(f"SELECT {quoted[1]} FROM {quoted[0]} ORDER BY rowid LIMIT 1").fetchone()
    finally:
        db.close()
    if not row or row[0] is None or row[0][3] & 0x10:  # no feature, or an empty geometry
        return None
    return _from_wkb(row[0], 8 + ENVELOPES[row[0][3] >> 1 & 7])[0]


def _signed_area(ring: list) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def _inside(p, ring: list) -> bool:
    return sum(1 for a, b in zip(ring, ring[1:], strict=False) if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]) % 2 == 1


def _shapefile(content: bytes) -> dict | None:
    """Of a polygon the clockwise rings are outer ones; another ring is a hole of the first outer one around it."""
    if len(content) < 112:
        return None
    kind = struct.unpack_from("<i", content, 108)[0]
    if kind in (1, 11, 21):
        return {"type": "Point", "coordinates": list(struct.unpack_from("<2d", content, 112))}
    if kind not in (3, 5, 13, 15, 23, 25):
        return None
    n_parts, n_points = struct.unpack_from("<2i", content, 144)
    starts = [*struct.unpack_from(f"<{n_parts}i", content, 152), n_points]
    at = 152 + 4 * n_parts
    points = [list(struct.unpack_from("<2d", content, at + 16 * k)) for k in range(n_points)]
    rings = [points[a:b] for a, b in zip(starts, starts[1:], strict=False)]
    if kind in (3, 13, 23):
        return {"type": "LineString", "coordinates": rings[0]} if len(rings) == 1 else {"type": "MultiLineString", "coordinates": rings}
    polygons = [[r] for r in rings if _signed_area(r) <= 0]
    for hole in (r for r in rings if _signed_area(r) > 0):
        around = next((p for p in polygons if _inside(hole[0], p[0])), None)
        polygons.append([hole]) if around is None else around.append(hole)
    return {"type": "Polygon", "coordinates": polygons[0]} if len(polygons) == 1 else {"type": "MultiPolygon", "coordinates": polygons}


def first_geometry(content: bytes) -> str | None:
    """GeoJSON text of a file's first geometry, None if it has none; an unknown format is an error."""
    if content[:16] == b"SQLite format 3\0":
        made = _geopackage(content)
    elif content[:4] == struct.pack(">i", 9994):
        made = _shapefile(content)
    else:
        read = json.loads(content.decode("utf-8-sig"))
        features = read.get("features")
        made = (features[0]["geometry"] if features else None) if features is not None else read.get("geometry", read if "coordinates" in read else None)
    return None if made is None else json.dumps(made)


def geometries_of(files: DataFrame) -> DataFrame:
    """path, geometry of each file (path, content); a task holds the files of its rows one at a time."""
    ship(files.sparkSession)

    def run(frames):
        for pdf in frames:
            yield pd.DataFrame({"path": pdf["path"], "geometry": [first_geometry(bytes(c)) for c in pdf["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, geometry string")


def geometries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return geometries_of(spark.read.format("binaryFile").load(path))
