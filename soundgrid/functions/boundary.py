"""Cell boundaries as column expressions: planar vertices, their order on the ellipsoid, positions, boxes and text forms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dggs
from .let import let

PI = math.pi
# Series of the geodetic latitude over the authalic one, in powers of the squared eccentricity (published map projection formulas)
_S2 = dggs.E2 / 3 + 31 * dggs.E2**2 / 180 + 517 * dggs.E2**3 / 5040
_S4 = 23 * dggs.E2**2 / 360 + 251 * dggs.E2**3 / 3780
_S6 = 761 * dggs.E2**3 / 45360


def _fold(code: Column, part) -> Column:
    """Sum of part(digit) * 3**-level over the levels, in faces."""
    digits = F.split(F.substring(code, 2, 99), "")
    start = F.struct(F.lit(0.0).alias("at"), F.lit(1.0).alias("w"))
    return F.aggregate(F.filter(digits, lambda d: d != ""), start, lambda s, d: F.struct((s["at"] + part(d.cast("int")) * s["w"] / 3).alias("at"), (s["w"] / 3).alias("w")))["at"]


def width(code: Column) -> Column:
    return F.lit(dggs.RADIUS * PI / 2) * F.pow(F.lit(3.0), 1 - F.length(code))


def planar_corner(code: Column) -> tuple[Column, Column]:
    """Upper left corner in metres."""
    face = F.substring(code, 1, 1)
    x0 = F.create_map(*(F.lit(v) for f, (x, _) in dggs.CORNERS.items() for v in (f, x * PI / 4)))[face]
    y0 = F.create_map(*(F.lit(v) for f, (_, y) in dggs.CORNERS.items() for v in (f, y * PI / 4)))[face]
    x = (x0 + _fold(code, lambda d: d % 3) * (PI / 2)) * dggs.RADIUS
    y = (y0 - _fold(code, lambda d: F.floor(d / 3)) * (PI / 2)) * dggs.RADIUS
    return x, y


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def planar_boundary(code: Column) -> Column:
    """Upper left, upper right, lower right, lower left in metres."""
    x, y = planar_corner(code)
    return let(lambda c: F.array(_point(c["x"], c["y"]), _point(c["x"] + c["w"], c["y"]), _point(c["x"] + c["w"], c["y"] - c["w"]), _point(c["x"], c["y"] - c["w"])), x=x, y=y, w=width(code))


def geographic(x: Column, y: Column) -> Column:
    """(lon, lat) in degrees of a planar position in metres."""

    def cap(c: Column) -> Column:  # the south is read as its mirror image
        u, v = c["u"], c["v"]
        turn = F.when((v <= 0) & (F.abs(u) <= -v), 0).when((u > 0) & (F.abs(v) <= u), 1).when((v > 0) & (F.abs(u) <= v), 2).otherwise(3)
        return let(lambda t: place(c, t), turn=turn, sg=F.greatest(F.abs(u), F.abs(v)) * (4 / PI))

    def place(c: Column, t: Column) -> Column:
        a = F.when(t["turn"] == 0, c["u"]).when(t["turn"] == 1, c["v"]).when(t["turn"] == 2, -c["u"]).otherwise(-c["v"])
        polar = F.abs(c["y"]) > PI / 4 + 1e-13
        lon = F.when(polar, F.when(t["sg"] > 0, a / t["sg"]).otherwise(0.0) - 3 * PI / 4 + t["turn"] * (PI / 2)).otherwise(c["x"])
        sb = F.when(polar, F.signum(c["y"]) * (1 - t["sg"] * t["sg"] / 3)).otherwise(c["y"] * (8 / (3 * PI)))
        lat = lambda b: b["beta"] + _S2 * F.sin(2 * b["beta"]) + _S4 * F.sin(4 * b["beta"]) + _S6 * F.sin(6 * b["beta"])
        return let(lambda b: _point(F.degrees(b["lon"]), F.degrees(lat(b))), lon=lon, beta=F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sb))))

    x, y = x / dggs.RADIUS, y / dggs.RADIUS
    return let(cap, x=x, y=y, u=x + 3 * PI / 4, v=F.abs(y) - PI / 2)


def _order(code: Column, corners: Column) -> Column:
    """How far the corners are turned so that the first is the north-west one on the ellipsoid.

    Around a pole the map turns by a quarter from each cap triangle to the next.  A skew quad lies in one of them, off its diagonals: the one its
    centre's angle about the pole falls in, counted from the triangle below the pole in the map of the north.  A dart's first corner is fixed by its cap.
    """
    face, shape = F.substring(code, 1, 1), dggs.rhealpix_shape(code)
    right = (corners[0]["x"] + corners[2]["x"]) / (2 * dggs.RADIUS) + 3 * PI / 4
    below = PI / 2 - F.abs((corners[0]["y"] + corners[2]["y"]) / (2 * dggs.RADIUS))
    turns = F.floor(F.atan2(right, below) / (PI / 2) + 0.5)
    skew = F.pmod(F.when(face == "N", -turns).otherwise(turns), F.lit(4))
    return F.when(shape <= 1, 0).when(shape == 2, F.when(face == "S", 3).otherwise(0)).otherwise(skew).cast("int")


def cell_boundary(code: Column, planar: bool = False, trim_dart: bool = True, decimals: int | None = 11) -> Column:
    """Vertices of a cell, of any resolution, first the north-west one; a dart loses the vertex that is none on the ellipsoid if `trim_dart`."""

    def turned(c: Column) -> Column:
        ring = F.concat(F.slice(c["corners"], c["k"] + 1, F.lit(4)), F.slice(c["corners"], F.lit(1), c["k"]))
        if trim_dart:
            out = F.when(F.substring(code, 1, 1) == "N", 2).otherwise(1)
            ring = let(lambda r: F.when(dggs.rhealpix_shape(code) == 2, F.filter(r["ring"], lambda v, i: i != out)).otherwise(r["ring"]), ring=ring)
        if not planar:
            ring = F.transform(ring, lambda v: geographic(v["x"], v["y"]))
            if decimals is not None:
                ring = F.transform(ring, lambda v: _point(F.round(v["x"], decimals), F.round(v["y"], decimals)))
        return F.filter(ring, lambda v: ~F.isnan(v["x"]) & ~F.isnan(v["y"]))

    ring = let(lambda p: let(turned, corners=p["corners"], k=_order(code, p["corners"])), corners=planar_boundary(code))
    return F.when(code.rlike("^[NOPQRS][0-8]{0,15}$"), ring)


def ring_bbox(ring: Column) -> Column:
    def box(c: Column) -> Column:
        xs, ys = F.transform(c["ring"], lambda v: v["x"]), F.transform(c["ring"], lambda v: v["y"])
        return F.struct(F.array_min(xs).alias("min_x"), F.array_max(xs).alias("max_x"), F.array_min(ys).alias("min_y"), F.array_max(ys).alias("max_y"))

    return let(box, ring=ring)  # a ring is costly: it is computed once


def cell_bbox(code: Column) -> Column:
    """Box in degrees that holds the whole cell: of all its corners (the trimmed ring of a dart may lack one of its tips).

    A corner at longitude 180 counts to the cell's side; a cell on both sides of it spans all longitudes, one around a pole reaches it.
    """

    def box(c: Column) -> Column:
        b, inner = c["b"], F.filter(F.transform(c["ring"], lambda v: v["x"]), lambda x: F.abs(x) < 180 - 1e-9)
        pole, wide = dggs.rhealpix_shape(code) == 1, b["max_x"] - b["min_x"] > 180
        east, west = F.array_min(inner) > 0, F.array_max(inner) < 0
        min_x = F.when(pole, -180.0).when(wide & east, F.array_min(inner)).when(wide, -180.0).otherwise(b["min_x"])
        max_x = F.when(pole, 180.0).when(wide & west, F.array_max(inner)).when(wide, 180.0).otherwise(b["max_x"])
        face = F.substring(code, 1, 1)
        min_y, max_y = F.when(pole & (face == "S"), -90.0).otherwise(b["min_y"]), F.when(pole & (face == "N"), 90.0).otherwise(b["max_y"])
        return F.struct(min_x.alias("min_x"), max_x.alias("max_x"), min_y.alias("min_y"), max_y.alias("max_y"))

    return let(lambda r: let(box, ring=r["ring"], b=ring_bbox(r["ring"])), ring=cell_boundary(code, trim_dart=False))


def _ring_text(ring: Column, form) -> Column:
    return let(lambda c: F.array_join(F.transform(F.concat(c["ring"], F.slice(c["ring"], 1, 1)), form), ", "), ring=ring)


def ring_wkt(ring: Column) -> Column:
    return F.concat(F.lit("POLYGON (("), _ring_text(ring, lambda v: F.concat_ws(" ", v["x"], v["y"])), F.lit("))"))


def ring_geojson(ring: Column) -> Column:
    return F.concat(F.lit('{"type": "Polygon", "coordinates": [['), _ring_text(ring, lambda v: F.concat(F.lit("["), v["x"], F.lit(", "), v["y"], F.lit("]"))), F.lit("]]}"))
