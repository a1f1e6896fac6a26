"""Footprints: dissolved outlines of cells, and hexagon bins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.functions.boundary import geographic
from soundgrid.functions.dggs import CORNERS, RADIUS
from soundgrid.shared import cut

EDGE = 0.000139  # degrees, default edge of a hexagon


def lattice(code: Column) -> tuple[Column, Column]:
    """(column, row) of a cell in its face at its own resolution, from the top left."""
    digits = F.filter(F.split(F.substring(code, 2, 99), ""), lambda d: d != "")
    fold = lambda part: F.aggregate(digits, F.lit(0).cast("long"), lambda s, d: s * 3 + part(d.cast("long")))
    return fold(lambda d: d % 3), fold(lambda d: F.floor(d / 3))


def boundary_edges(cells: DataFrame) -> DataFrame:
    """face, x1, y1, x2, y2: unit edges of the outline of cells of one resolution, in lattice units with the interior at the right hand.

    An edge that two cells share cancels.  Equatorial faces lie side by side on one lattice, so their shared sides cancel too (but not at
    longitude 180).  Edges are integers: no tolerance is needed.
    """
    code = F.col("region_code")
    col, row = lattice(code)
    n = F.pow(F.lit(3), F.length(code) - 1).cast("long")
    face = F.substring(code, 1, 1)
    shift = F.instr(F.lit("OPQR"), face) - 1
    placed = cells.select("region_code").distinct().select(F.when(shift >= 0, "E").otherwise(face).alias("face"), (col + F.greatest(shift, F.lit(0)) * n).alias("c"), row.alias("r"))
    edge = lambda *p: F.struct(*(e.cast("long").alias(k) for k, e in zip(("x1", "y1", "x2", "y2"), p, strict=True)))
    c, r = F.col("c"), F.col("r")
    edges = placed.select("face", F.explode(F.array(edge(c, r, c + 1, r), edge(c + 1, r, c + 1, r + 1), edge(c + 1, r + 1, c, r + 1), edge(c, r + 1, c, r))).alias("e")).select("face", "e.*")
    swap = (F.col("x1") > F.col("x2")) | (F.col("y1") > F.col("y2"))
    keyed = edges.select("face", *(F.when(swap, F.col(b)).otherwise(F.col(a)).alias(k) for k, a, b in (("ax", "x1", "x2"), ("ay", "y1", "y2"), ("bx", "x2", "x1"), ("by", "y2", "y1"))), swap.alias("back"))
    alone = keyed.groupBy("face", "ax", "ay", "bx", "by").agg(F.count("*").alias("n"), F.max("back").alias("back")).where("n = 1")
    pick = lambda a, b: F.when(F.col("back"), F.col(b)).otherwise(F.col(a))
    return alone.select("face", pick("ax", "bx").alias("x1"), pick("ay", "by").alias("y1"), pick("bx", "ax").alias("x2"), pick("by", "ay").alias("y2"))


_STEPS = ((1, 0), (0, 1), (-1, 0), (0, -1))  # right, down, left, up


def _followed(edges: DataFrame, span: int) -> DataFrame:
    """face, x, y, way, id, next of unit edges (x1 ... y2): `next` is the edge that follows in its ring.

    Where two rings touch in a point two edges begin; the one that turns right is taken, so rings do not cross and cells that touch in a point stay apart.
    """
    way = F.coalesce(*(F.when((F.col("x2") - F.col("x1") == dx) & (F.col("y2") - F.col("y1") == dy), k) for k, (dx, dy) in enumerate(_STEPS)))
    drawn = edges.select("face", "x1", "y1", "x2", "y2", way.alias("way"))
    begin = drawn.groupBy(F.col("face").alias("f"), F.col("x1").alias("bx"), F.col("y1").alias("by")).agg(F.collect_set("way").alias("ways"))
    both = drawn.join(begin, (F.col("face") == F.col("f")) & (F.col("x2") == F.col("bx")) & (F.col("y2") == F.col("by")))
    turn = F.coalesce(*(F.when(F.array_contains("ways", (F.col("way") + k) % 4), (F.col("way") + k) % 4) for k in (1, 0, 3)))
    place = lambda x, y, w: ((((F.instr(F.lit("ENS"), F.col("face")) - 1).cast("long") * span + F.col(x)) * span + F.col(y)) * 4 + w).cast("long")
    return both.select("face", F.col("x1").alias("x"), F.col("y1").alias("y"), "way", place("x1", "y1", F.col("way")).alias("id"), place("x2", "y2", turn).alias("next"))


def ring_edges(edges: DataFrame, span: int, rounds: int = 60) -> DataFrame:
    """face, x, y, way, ring (least edge id of the ring), at (its place from there): pointer doubling, so a ring may lie anywhere and rounds grow with the logarithm of its length."""
    drawn = cut(_followed(edges, span))
    state = drawn.select("id", F.col("next").alias("jump"), F.col("id").alias("low"), F.lit(0).cast("long").alias("off"))
    step, before = 1, None
    for _ in range(rounds):
        ahead = state.select(F.col("id").alias("jump"), F.col("jump").alias("far"), F.col("low").alias("low_ahead"), F.col("off").alias("off_ahead"))
        nearer = F.col("low_ahead") < F.col("low")
        state = cut(state.join(ahead, "jump").select("id", F.col("far").alias("jump"), F.least("low", "low_ahead").alias("low"), F.when(nearer, F.col("off_ahead") + step).otherwise(F.col("off")).alias("off")))
        now = state.agg(F.sum(F.col("low").cast("decimal(38,0)"))).first()
        if now == before:
            break
        step, before = 2 * step, now
    else:
        raise RuntimeError("rings did not close")
    return drawn.drop("next").join(state.select("id", F.col("low").alias("ring"), (-F.col("off")).alias("at")), "id").drop("id")


def rings(edges: DataFrame, span: int) -> DataFrame:
    """face, ring, corners (lattice points where the ring turns, in order), area (positive around cells, negative around a hole), parent (for a hole: the ring
    left of its upper left corner).  A ring is one row of the result, so a task holds a ring, not a face."""
    marked = cut(ring_edges(edges, span))
    turned = marked.withColumn("before", F.lag("way").over(Window.partitionBy("ring").orderBy("at")))
    point = F.struct("at", "x", "y", "way")
    whole = turned.groupBy("face", "ring").agg(F.sort_array(F.collect_list(F.when(F.col("before").isNull() | (F.col("before") != F.col("way")), point))).alias("p"), F.max_by("way", "at").alias("last"), F.sum(F.when(F.col("way") == 1, -F.col("x")).when(F.col("way") == 3, F.col("x")).otherwise(0)).alias("minus_area"))
    corners = F.transform(F.filter("p", lambda v, i: ~((i == 0) & (v["way"] == F.col("last")))), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y")))
    # an up edge has a cell at its right hand, a down edge one at its left: the edge before a hole's first up or down edge in its row is of the same polygon
    upright = marked.where("way % 2 = 1").withColumn("row", F.when(F.col("way") == 1, F.col("y")).otherwise(F.col("y") - 1))
    beside = upright.withColumn("left", F.lag("ring").over(Window.partitionBy("face", "row").orderBy("x")))
    parent = beside.groupBy(F.col("ring").alias("of")).agg(F.min_by("left", F.struct("row", "x")).alias("left"))
    return whole.select("face", "ring", corners.alias("corners"), (-F.col("minus_area")).alias("area")).join(parent, F.col("ring") == F.col("of")).select("face", "ring", "corners", "area", F.when(F.col("area") < 0, F.col("left")).alias("parent"))


def polygons(cells: DataFrame, resolution: int, rounds: int = 60) -> DataFrame:
    """face, polygon, area (cells), outer (lattice corners), holes (arrays of corners) of the cells of one resolution, dissolved.

    Outlines run over all tiles; the four equatorial faces are one lattice E.  What remains apart are the belt and the caps, and the two sides of longitude 180.
    """
    span = 4 * 3**resolution + 1
    drawn = cut(rings(boundary_edges(cells), span))
    up = drawn.where("parent is not null").select("ring", "parent")
    for _ in range(rounds):  # a hole beside a hole: on to the ring that is none
        further = up.join(drawn.where("parent is not null").select(F.col("ring").alias("parent"), F.col("parent").alias("next")), "parent", "left")
        if not further.where("next is not null").limit(1).count():
            break
        up = cut(further.select("ring", F.coalesce("next", "parent").alias("parent")))
    else:
        raise RuntimeError("holes in too long a row")
    inner = drawn.where("area < 0").drop("parent").join(up, "ring").groupBy("parent").agg(F.sort_array(F.collect_list(F.struct("ring", "corners"))).alias("h"), F.sum("area").alias("lost"))
    outer = drawn.where("area > 0").join(inner, F.col("ring") == inner["parent"], "left")
    holes = F.coalesce(F.transform("h", lambda x: x["corners"]), F.array().cast("array<array<struct<x:bigint,y:bigint>>>"))
    return outer.select("face", F.col("ring").alias("polygon"), (F.col("area") + F.coalesce("lost", F.lit(0))).cast("long").alias("area"), F.col("corners").alias("outer"), holes.alias("holes"))


def dissolve(cells: DataFrame, resolution: int) -> DataFrame:
    """face, polygon, area (cells), outer, holes: outlines of the cells with positions in degrees."""
    side = math.pi / 2 / 3**resolution
    left = F.when(F.col("face") == "E", CORNERS["O"][0]).otherwise(CORNERS["N"][0]) * (math.pi / 4)
    top = F.create_map(*(F.lit(v) for f, c in (("E", "O"), ("N", "N"), ("S", "S")) for v in (f, CORNERS[c][1] * math.pi / 4)))[F.col("face")]
    placed = lambda ring: F.transform(ring, lambda v: geographic((left + v["x"] * side) * RADIUS, (top - v["y"] * side) * RADIUS))
    return polygons(cells, resolution).select("face", "polygon", "area", placed(F.col("outer")).alias("outer"), F.transform("holes", placed).alias("holes"))


def multipolygon(dissolved: DataFrame) -> DataFrame:
    """One row: the whole footprint as the GeoJSON text of one MultiPolygon."""
    point = lambda v: F.array(v["x"], v["y"])
    ring = lambda r: F.transform(F.concat(r, F.slice(r, 1, 1)), point)
    shape = F.concat(F.array(ring(F.col("outer"))), F.transform("holes", ring))
    all_ = dissolved.select("face", "polygon", shape.alias("shape")).agg(F.sort_array(F.collect_list(F.struct("face", "polygon", "shape"))).alias("all"))
    return all_.select(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.transform("all", lambda x: x["shape"]).alias("coordinates"))).alias("geometry"))


def hex_id(x: Column, y: Column, edge: float = EDGE) -> tuple[Column, Column]:
    """Axial coordinates (q, r) of the pointy-top hexagon that holds a point: rounded cube coordinates."""
    q, r = (x * (math.sqrt(3) / 3) - y / 3) / edge, y * (2 / 3) / edge
    s = -q - r
    rq, rr, rs = F.round(q), F.round(r), F.round(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    return F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq).cast("long"), F.when((dq > dr) & (dq > ds), rr).when(dr > ds, -rq - rs).otherwise(rr).cast("long")


def hexbin(df: DataFrame, edge: float = EDGE, x: str = "X", y: str = "Y") -> DataFrame:
    """q, r, count of the hexagons that hold points; points without a position are left out."""
    known = lambda c: F.abs(F.col(c).cast("double")) < 1e9  # noqa: E731  (neither null nor NaN)
    placed = df.where(known(x) & known(y))
    q, r = hex_id(F.col(x).cast("double"), F.col(y).cast("double"), edge)
    return placed.select(q.alias("q"), r.alias("r")).groupBy("q", "r").agg(F.count("*").alias("count"))


#: Neighbours of a hexagon in the order of its sides, and its corners in edges from its centre, so that side k runs from corner k to corner k + 1 and has neighbour k.
_BESIDE = ((0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1), (1, 0))


def hexbin_outline(bins: DataFrame, edge: float = EDGE, least: int = 1) -> DataFrame:
    """x1, y1, x2, y2: sides of the outline of the hexagons with at least `least` points: those whose neighbour is none of them.

    A side's neighbour is found by an equi-join on (q, r).  Ends are worked out from integers, so sides that meet have equal ends.
    """
    dense = bins.where(F.col("count") >= least).select("q", "r")
    sides = dense.select("q", "r", F.posexplode(F.array(*(F.struct((F.col("q") + dq).alias("nq"), (F.col("r") + dr).alias("nr")) for dq, dr in _BESIDE))).alias("k", "n")).select("q", "r", "k", "n.*")
    alone = sides.join(dense.select(F.col("q").alias("nq"), F.col("r").alias("nr")), ["nq", "nr"], "left_anti")
    # corner k lies between neighbours k - 1 and k; in thirds of lattice steps it is the sum of the centre and both neighbours
    third = lambda axis, k: 3 * F.col("qr"[axis]) + F.get(F.array(*(F.lit(_BESIDE[(j - 1) % 6][axis] + _BESIDE[j][axis]) for j in range(6))), (F.col("k") + k) % 6)
    x = lambda k: (F.lit(math.sqrt(3) / 3) * (third(0, k) + third(1, k) / 2)) * edge
    y = lambda k: third(1, k) * (edge / 2)
    return alone.select(x(0).alias("x1"), y(0).alias("y1"), x(1).alias("x2"), y(1).alias("y2"))
