"""All queries of the engine over the driver's tables, and the SQL they are checked against."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.functions import boundary, dggs, text
from soundgrid.operators import aggregate, coverage, navigation, planning, stats
from soundgrid.plans import metadata, workflows
from soundgrid.schema import coerce_soundings

#: A sounding table made of lineitem, by the same text in Spark and in the oracle.
SOUNDINGS = """
SELECT l_suppkey % 8 AS file_id, l_orderkey AS ping_number, l_linenumber - 1 AS beam_number,
  -180e0 + 360e0 * CAST((l_orderkey*7919 + l_partkey*104729) % 1000003 AS DOUBLE) / 1000003e0 AS X,
  -90e0 + 180e0 * CAST((l_orderkey*15485863 + l_suppkey*32452843 + l_linenumber*49979687) % 1000003 AS DOUBLE) / 1000003e0 AS Y,
  l_extendedprice / 100e0 AS Z, l_quantity - 25e0 AS across_track, l_discount * 100e0 AS along_track,
  CAST(l_partkey % 360 AS DOUBLE) AS heading,
  CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS beam_flags, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS ping_flags,
  l_shipdate AS timestamp, l_partkey, l_suppkey, l_returnflag
FROM lineitem
"""
RES = 6
Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None):
    def keep(f: Query) -> Query:
        _FOUND[f.__name__] = (f, sql)
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def soundings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SOUNDINGS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def cells(spark: SparkSession, sf_dir: str, resolution: int = RES) -> DataFrame:
    return dggs.with_cell(soundings(spark, sf_dir), resolution=resolution)


def cell_ctes(resolution: int) -> str:
    """CTEs up to `coded`: soundings with their region_code, in plain SQL arithmetic."""
    e, q, n = dggs.E1, dggs.QP, 3**resolution
    digits = " || ".join(f"CAST(3 * ((m // {3 ** (resolution - k)}) % 3) + (n // {3 ** (resolution - k)}) % 3 AS VARCHAR)" for k in range(1, resolution + 1))
    return f"""
s AS ({SOUNDINGS}),
p1 AS (SELECT *, radians(CASE WHEN X = 180 THEN -180e0 ELSE X END) * {2 / math.pi!r} + 2 AS t, sin(radians(Y)) AS sl FROM s),
p2 AS (SELECT *, least(1e0, greatest(-1e0, {(1 - dggs.E2) / q!r} * (sl / (1 - {dggs.E2!r} * sl * sl) - ln((1 - {e!r} * sl) / (1 + {e!r} * sl)) / {2 * e!r}))) AS sb, least(3, greatest(0, floor(t))) AS cn FROM p1),
p3 AS (SELECT *, sqrt(greatest(0, 3 * (1 - abs(sb)))) AS sg, abs(sb) <= 2e0 / 3e0 AS flat FROM p2),
p4 AS (SELECT *, (t - cn - 0.5e0) * sg AS along, sg / 2 AS o FROM p3),
p5 AS (SELECT *, CASE cn WHEN 0 THEN along WHEN 1 THEN o WHEN 2 THEN -along ELSE -o END AS sx, CASE cn WHEN 0 THEN -o WHEN 1 THEN along WHEN 2 THEN o ELSE -along END AS sy FROM p4),
p6 AS (SELECT *, CASE WHEN flat THEN t - cn ELSE 0.5e0 + sx END AS fx, CASE WHEN flat THEN 0.5e0 - 0.75e0 * sb WHEN sb > 0 THEN 0.5e0 - sy ELSE 0.5e0 + sy END AS fy,
  CASE WHEN flat THEN substring('OPQR', CAST(cn AS INTEGER) + 1, 1) WHEN sb > 0 THEN 'N' ELSE 'S' END AS face FROM p5),
p7 AS (SELECT *, greatest(0, least({n - 1}, CAST(floor(fx * {n}) AS BIGINT))) AS n, greatest(0, least({n - 1}, CAST(floor(fy * {n}) AS BIGINT))) AS m FROM p6),
coded AS (SELECT *, face || {digits} AS region_code FROM p7)
"""


CODED = cell_ctes(RES)


# cell frequencies


@query(f"WITH {CODED} SELECT region_code, count(*) AS count FROM coded GROUP BY region_code")
def cell_frequency(spark, d):
    return aggregate.cell_frequency(cells(spark, d))


@query("SELECT l_returnflag, count(*) AS count FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag")
def cell_id_count(spark, d):
    return aggregate.value_count(table(spark, d, "lineitem"), "l_returnflag")


@query(f"WITH {CODED} SELECT region_code, count(*) AS count FROM coded GROUP BY region_code")
def reduce_region_codes(spark, d):
    c = cells(spark, d)
    return aggregate.merge_cell_counts(*(aggregate.cell_frequency(c.where(F.col("l_returnflag") == f)) for f in ("A", "N", "R")))


@query(f"WITH {CODED} SELECT substring(region_code, 1, 4) AS region_code, count(*) AS count FROM coded GROUP BY 1")
def reduce_resolution(spark, d):
    return aggregate.reduce_resolution(aggregate.cell_frequency(cells(spark, d)), 3)


@query(f"WITH {CODED}, l AS (SELECT unnest([0, 2, 4, 6]) AS resolution) SELECT CAST(resolution AS INTEGER) AS resolution, substring(region_code, 1, resolution + 1) AS region_code, count(*) AS count FROM coded, l GROUP BY 1, 2")
def resolution_rollup(spark, d):
    return aggregate.resolution_rollup(aggregate.cell_frequency(cells(spark, d)), [0, 2, 4, 6])


@query("SELECT min(l_shipdate) AS start_datetime, max(l_shipdate) AS end_datetime FROM lineitem")
def start_end_timestamps(spark, d):
    return aggregate.time_bounds(soundings(spark, d))


@query("SELECT min(l_shipdate) AS start_datetime, max(l_shipdate) AS end_datetime FROM lineitem")
def reduce_timestamps(spark, d):
    return aggregate.merge_time_bounds(aggregate.time_bounds(soundings(spark, d), by=["file_id"]))


# statistics

_MOMENTS = "count(v) AS c, sum(v) AS s1, sum(v*v) AS s2, sum(v*v*v) AS s3, sum(v*v*v*v) AS s4, min(v) AS lo, max(v) AS hi"
_LONG = f"SELECT attribute, {_MOMENTS} FROM (SELECT 'Z' AS attribute, Z AS v FROM s UNION ALL SELECT 'across_track', across_track FROM s UNION ALL SELECT 'along_track', along_track FROM s) GROUP BY attribute"
_CENTRAL = "SELECT *, s2/c - (s1/c)*(s1/c) AS m2, s3/c - 3*(s1/c)*s2/c + 2*pow(s1/c, 3) AS m3, s4/c - 4*(s1/c)*s3/c + 6*pow(s1/c, 2)*s2/c - 3*pow(s1/c, 4) AS m4 FROM a"
_FINAL = "attribute, round(lo, 6) AS minimum, round(hi, 6) AS maximum, c AS count, round(s1, 3) AS total, round(s1/c, 6) AS mean, round(m2*c/(c-1), 4) AS variance, round(sqrt(m2*c/(c-1)), 6) AS stddev, round(m3/pow(m2, 1.5), 6) AS skewness, round(m4/(m2*m2) - 3, 6) AS kurtosis"
_STATS = f"WITH s AS ({SOUNDINGS}), a AS ({_LONG}), b AS ({_CENTRAL}) SELECT {_FINAL} FROM b"
MEASURED = ["Z", "across_track", "along_track"]


def rounded(df: DataFrame) -> DataFrame:
    places = {"minimum": 6, "maximum": 6, "total": 3, "mean": 6, "variance": 4, "stddev": 6, "skewness": 6, "kurtosis": 6, "mu2_prime": 2, "mu3_prime": 1, "mu4_prime": 0}
    return df.withColumns({c: F.round(c, p) for c, p in places.items() if c in df.columns})


@query(_STATS)
def basic_statistics(spark, d):
    return rounded(stats.basic_statistics(soundings(spark, d), MEASURED)).drop("n_total")


@query(f"WITH s AS ({SOUNDINGS}) SELECT file_id, 'across_track' AS attribute, min(across_track) AS minimum, max(across_track) AS maximum, count(across_track) AS count, sum(across_track) AS total, sum(across_track*across_track) AS mu2_prime, sum(across_track*across_track*across_track) AS mu3_prime, sum(across_track*across_track*across_track*across_track) AS mu4_prime FROM s GROUP BY file_id")
def stats_incremental(spark, d):
    return stats.partial_statistics(soundings(spark, d), ["across_track"], by=["file_id"])


@query(_STATS)
def stats_reduce(spark, d):
    return rounded(stats.reduce_statistics(stats.partial_statistics(soundings(spark, d), MEASURED, by=["file_id"])))


@query(_STATS + " WHERE attribute <> 'Z'")
def gather_stats(spark, d):
    s = soundings(spark, d)
    return stats.gather_statistics(*(rounded(stats.reduce_statistics(stats.partial_statistics(s, [c]))) for c in MEASURED[1:]))


@query(f"WITH {CODED}, w AS (SELECT * FROM coded WHERE region_code LIKE 'P4%' OR region_code LIKE 'R12%'), a AS (SELECT 'Z' AS attribute, count(v) AS c, sum(v) AS s1, sum(v*v) AS s2, sum(v*v*v) AS s3, sum(v*v*v*v) AS s4, min(v) AS lo, max(v) AS hi FROM (SELECT Z AS v FROM w)), b AS ({_CENTRAL}) SELECT {_FINAL} FROM b")
def dataset_statistics(spark, d):
    c = cells(spark, d)
    wanted = aggregate.cell_frequency(c).where("region_code like 'P4%' or region_code like 'R12%'")
    return rounded(workflows.dataset_statistics(c, wanted, ["Z"]))


_BOXES = "SELECT n_nationkey AS box_id, CAST(n_nationkey * 10 - 130 AS DOUBLE) AS min_x, CAST(n_nationkey * 10 - 110 AS DOUBLE) AS max_x, -35e0 AS min_y, CAST(n_nationkey * 2 AS DOUBLE) AS max_y FROM nation"


@query(f"WITH s AS ({SOUNDINGS}), b AS ({_BOXES}) SELECT box_id, count(*) AS count, round(sum(Z), 2) AS total FROM s JOIN b ON X BETWEEN min_x AND max_x AND Y BETWEEN min_y AND max_y GROUP BY box_id")
def bbox_range_join(spark, d):
    boxes = spark.sql(_BOXES.replace("FROM nation", "FROM {nation}"), nation=table(spark, d, "nation"))
    return stats.bbox_join(soundings(spark, d), boxes).groupBy("box_id").agg(F.count("*").alias("count"), F.round(F.sum("Z"), 2).alias("total"))


# cells


@query(f"WITH {cell_ctes(8)} SELECT ping_number, beam_number, l_partkey, l_suppkey, region_code FROM coded")
def rhealpix_code(spark, d):
    return cells(spark, d, 8).select("ping_number", "beam_number", "l_partkey", "l_suppkey", "region_code")


_R = repr(dggs.RADIUS)
_WEST = f"CASE face WHEN 'P' THEN {-math.pi / 2!r} WHEN 'Q' THEN 0e0 WHEN 'R' THEN {math.pi / 2!r} ELSE {-math.pi!r} END"
_NORTH = f"CASE face WHEN 'N' THEN {3 * math.pi / 4!r} WHEN 'S' THEN {-math.pi / 4!r} ELSE {math.pi / 4!r} END"
_CORNER = f"round({_R} * ({_WEST} + {math.pi / 2!r} * n / {3**RES}e0), 4) AS ul_x, round({_R} * ({_NORTH} - {math.pi / 2!r} * m / {3**RES}e0), 4) AS ul_y"


@query(f"WITH {CODED}, c AS (SELECT DISTINCT region_code, face, n, m FROM coded) SELECT region_code, {_CORNER}, round(CAST({dggs.cell_width(RES)!r} AS DOUBLE), 4) AS width FROM c")
def rhealpix_boundary_planar(spark, d):
    c = aggregate.cell_frequency(cells(spark, d)).select("region_code", boundary.planar_boundary(F.col("region_code")).alias("ring"))
    return c.select("region_code", F.round(F.col("ring")[0]["x"], 4).alias("ul_x"), F.round(F.col("ring")[0]["y"], 4).alias("ul_y"), F.round(F.col("ring")[1]["x"] - F.col("ring")[0]["x"], 4).alias("width"))


# A cell's corners in longitude and latitude, by the inverse of the map in plain SQL: latitude by the authalic series.  On a cap a corner's quarter is
# that of its angle about the pole; at the pole and at longitude 180 a box is closed as `cell_bbox` says.
_SPAN = f"{3**RES}e0"
_LAT = f"(beta + {boundary._S2!r}*sin(2*beta) + {boundary._S4!r}*sin(4*beta) + {boundary._S6!r}*sin(6*beta))"
_CORNERS = f"""
k AS (SELECT DISTINCT region_code, face, n, m FROM coded),
g AS (SELECT k.*, (n + i) / {_SPAN} AS px, (m + j) / {_SPAN} AS py FROM k, (VALUES (0, 0), (1, 0), (1, 1), (0, 1)) t(i, j)),
h AS (SELECT *, 2 * px - 1 AS u, CASE face WHEN 'N' THEN 1 - 2 * py ELSE 2 * py - 1 END AS v FROM g),
i AS (SELECT *, greatest(abs(u), abs(v)) AS far, CASE WHEN face IN ('N', 'S') THEN (CASE WHEN -v >= abs(u) - 1e-12 THEN 0 WHEN u >= abs(v) - 1e-12 THEN 1 WHEN v >= abs(u) - 1e-12 THEN 2 ELSE 3 END) END AS quarter FROM h),
c AS (SELECT *, CASE WHEN quarter IS NULL THEN {_WEST} + {math.pi / 2!r} * px WHEN far < 1e-12 THEN {-math.pi!r} + {math.pi / 4!r} ELSE {-3 * math.pi / 4!r} + quarter * {math.pi / 2!r} + {math.pi / 4!r} * (CASE quarter WHEN 0 THEN u WHEN 1 THEN v WHEN 2 THEN -u ELSE -v END) / far END AS lon,
  asin(greatest(-1e0, least(1e0, CASE WHEN quarter IS NULL THEN (0.5e0 - py) / 0.75e0 WHEN face = 'N' THEN 1 - far * far / 3 ELSE far * far / 3 - 1 END))) AS beta FROM i),
d AS (SELECT region_code, face, regexp_full_match(region_code, '[NS]4*') AS pole, degrees(lon) AS x, degrees({_LAT}) AS y FROM c),
e AS (SELECT region_code, face, pole, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(x) FILTER (abs(x) < 180 - 1e-9) AS i0, max(x) FILTER (abs(x) < 180 - 1e-9) AS i1 FROM d GROUP BY 1, 2, 3)
"""


@query(f"""WITH {CODED}, {_CORNERS} SELECT region_code, 0e0 + round(CASE WHEN pole THEN -180e0 WHEN x1 - x0 > 180 AND i0 > 0 THEN i0 WHEN x1 - x0 > 180 THEN -180e0 ELSE x0 END, 6) AS min_x,
  0e0 + round(CASE WHEN pole THEN 180e0 WHEN x1 - x0 > 180 AND i1 < 0 THEN i1 WHEN x1 - x0 > 180 THEN 180e0 ELSE x1 END, 6) AS max_x,
  0e0 + round(CASE WHEN pole AND face = 'S' THEN -90e0 ELSE y0 END, 6) AS min_y, 0e0 + round(CASE WHEN pole AND face = 'N' THEN 90e0 ELSE y1 END, 6) AS max_y FROM e""")
def geometry_slices(spark, d):
    c = aggregate.cell_frequency(cells(spark, d))
    b = c.select("region_code", boundary.cell_bbox(F.col("region_code")).alias("b"))
    return b.select("region_code", *((F.lit(0.0) + F.round(F.col(f"b.{k}"), 6)).alias(k) for k in ("min_x", "max_x", "min_y", "max_y")))  # 0.0 for -0.0


@query(f"WITH {CODED}, {_CORNERS} SELECT region_code, CAST(4 AS BIGINT) AS corners, round(sum(y), 5) AS sum_y, round(sum(sin(radians(x)) + 1), 6) AS round_x FROM d GROUP BY region_code, pole")
def cell_corners(spark, d):
    """All four corners of each cell's ring, whichever is first; longitudes by their sine, so that 180 is -180."""
    ring = boundary.cell_boundary(F.col("region_code"), trim_dart=False, decimals=None)
    b = aggregate.cell_frequency(cells(spark, d)).select("region_code", ring.alias("r"))
    total = lambda f: F.aggregate("r", F.lit(0.0), lambda a, v: a + f(v))
    return b.select("region_code", F.size("r").cast("long").alias("corners"), F.round(total(lambda v: v["y"]), 5).alias("sum_y"), F.round(total(lambda v: F.sin(F.radians(v["x"])) + 1), 6).alias("round_x"))


# Which corner is first: on a cap a skew quad's is the western one of the two nearest the north, its longitudes counted in the quarter of its centre;
# a dart's is the upper left one of the map in the north, the lower left one in the south; any other cell's is the upper left one.
_FIRST = f"""
k AS (SELECT DISTINCT region_code, face, n, m, CASE WHEN regexp_full_match(region_code, '[NS][0-8]*[1357][0-8]*') THEN 'skew' WHEN face = 'S' AND NOT regexp_full_match(region_code, 'S4*') THEN 'south' ELSE 'other' END AS kind FROM coded),
q AS (SELECT *, 2 * (n + 0.5e0) / {_SPAN} - 1 AS u0, (2 * (m + 0.5e0) / {_SPAN} - 1) * CASE face WHEN 'N' THEN -1 ELSE 1 END AS v0 FROM k),
g AS (SELECT q.*, i, j, 2 * (n + i) / {_SPAN} - 1 AS u, (2 * (m + j) / {_SPAN} - 1) * CASE face WHEN 'N' THEN -1 ELSE 1 END AS v, (m + j) / {_SPAN} AS py, (n + i) / {_SPAN} AS px FROM q, (VALUES (0, 0), (1, 0), (1, 1), (0, 1)) t(i, j)),
h AS (SELECT *, greatest(abs(u), abs(v)) AS far, CASE WHEN kind = 'skew' THEN (CASE WHEN -v0 > abs(u0) THEN 0 WHEN u0 > abs(v0) THEN 1 WHEN v0 > abs(u0) THEN 2 ELSE 3 END)
  ELSE (CASE WHEN -v >= abs(u) - 1e-12 THEN 0 WHEN u >= abs(v) - 1e-12 THEN 1 WHEN v >= abs(u) - 1e-12 THEN 2 ELSE 3 END) END AS quarter FROM g),
c AS (SELECT *, CASE WHEN face NOT IN ('N', 'S') THEN {_WEST} + {math.pi / 2!r} * px ELSE {-3 * math.pi / 4!r} + quarter * {math.pi / 2!r} + {math.pi / 4!r} * (CASE quarter WHEN 0 THEN u WHEN 1 THEN v WHEN 2 THEN -u ELSE -v END) / greatest(far, 1e-300) END AS lon,
  asin(greatest(-1e0, least(1e0, CASE WHEN face NOT IN ('N', 'S') THEN (0.5e0 - py) / 0.75e0 WHEN face = 'N' THEN 1 - far * far / 3 ELSE far * far / 3 - 1 END))) AS beta FROM h),
o AS (SELECT *, {_LAT} AS lat, row_number() OVER (PARTITION BY region_code ORDER BY CASE kind WHEN 'skew' THEN 0 WHEN 'south' THEN abs(i) + abs(j - 1) ELSE i + j END, round(beta, 9) DESC, lon) AS place FROM c)
"""


@query(f"WITH {CODED}, {_FIRST} SELECT region_code, round(degrees(lat), 6) AS y, 0e0 + round(sin(lon), 6) AS sin_x, 0e0 + round(cos(lon), 6) AS cos_x FROM o WHERE place = 1")
def cell_first_vertex(spark, d):
    ring = boundary.cell_boundary(F.col("region_code"), trim_dart=False, decimals=None)
    b = aggregate.cell_frequency(cells(spark, d)).select("region_code", ring[0].alias("v"))
    x = F.radians("v.x")
    return b.select("region_code", F.round("v.y", 6).alias("y"), (F.lit(0.0) + F.round(F.sin(x), 6)).alias("sin_x"), (F.lit(0.0) + F.round(F.cos(x), 6)).alias("cos_x"))


@query()
def cell_outlines(spark, d):
    return workflows.density_map(cells(spark, d), 3)


@query(f"WITH {CODED} SELECT region_code, CASE WHEN region_code[1] IN ('O','P','Q','R') THEN 0 WHEN regexp_full_match(region_code, '[NS]4*') THEN 1 WHEN regexp_full_match(region_code, '[NS][02468]*') THEN 2 ELSE 3 END AS shape FROM (SELECT DISTINCT region_code FROM coded)")
def cell_shape(spark, d):
    return aggregate.cell_frequency(cells(spark, d)).select("region_code", dggs.rhealpix_shape(F.col("region_code")).alias("shape"))


_DIGITS = ", ".join(f"CAST(coalesce(try_cast(substring(region_code, {k + 1}, 1) AS SMALLINT), 0) AS SMALLINT) AS R{k}" for k in range(1, 16))


@query(f"WITH {CODED} SELECT region_code, count(*) AS count, substring(region_code, 1, 1) AS R0, {_DIGITS} FROM coded GROUP BY region_code")
def unpack_code(spark, d):
    return aggregate.cell_frequency(cells(spark, d)).withColumns(dggs.unpack_code(F.col("region_code")))


# footprints


@query(f"WITH {cell_ctes(3)}, c AS (SELECT DISTINCT CASE WHEN face IN ('N','S') THEN face ELSE 'E' END AS face, n + CASE face WHEN 'P' THEN 27 WHEN 'Q' THEN 54 WHEN 'R' THEN 81 ELSE 0 END AS n, m FROM coded), e AS (SELECT face, n AS x1, m AS y1, n + 1 AS x2, m AS y2 FROM c UNION ALL SELECT face, n + 1, m, n + 1, m + 1 FROM c UNION ALL SELECT face, n + 1, m + 1, n, m + 1 FROM c UNION ALL SELECT face, n, m + 1, n, m FROM c) SELECT * FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.face = a.face AND b.x1 = a.x2 AND b.y1 = a.y2 AND b.x2 = a.x1 AND b.y2 = a.y1)")
def dissolve_boundary_edges(spark, d):
    return coverage.boundary_edges(aggregate.cell_frequency(cells(spark, d, 3)))


@query()
def dissolve(spark, d):
    return coverage.dissolve(aggregate.cell_frequency(cells(spark, d, 4)), 4)


_HEX = 1.5


@query(f"WITH s AS ({SOUNDINGS}), a AS (SELECT (X * {math.sqrt(3) / 3!r} - Y / 3) / {_HEX}e0 AS q, Y * {2 / 3!r} / {_HEX}e0 AS r FROM s), b AS (SELECT q, r, -q - r AS s, round(q) AS rq, round(r) AS rr, round(-q - r) AS rs FROM a), c AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM b) SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS q, CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS r, count(*) AS count FROM c GROUP BY 1, 2")
def hexbin_counts(spark, d):
    return coverage.hexbin(soundings(spark, d), _HEX)


# navigation


@query(f"WITH s AS ({SOUNDINGS}), m AS (SELECT *, radians(Y) AS p, sin(radians(heading)) AS e, cos(radians(heading)) AS h FROM s), k AS (SELECT *, 111412.84e0*cos(p) - 93.5e0*cos(3*p) + 0.118e0*cos(5*p) AS lx, 111132.92e0 - 559.82e0*cos(2*p) + 1.175e0*cos(4*p) - 0.0023e0*cos(6*p) AS ly FROM m) SELECT ping_number, beam_number, l_partkey, l_suppkey, round(X + h/lx*across_track + e/lx*along_track, 6) AS beam_x, round(Y - e/ly*across_track + h/ly*along_track, 6) AS beam_y FROM k")
def beam_lon_lat(spark, d):
    made = navigation.beam_positions(soundings(spark, d), "X", "Y")
    return made.select("ping_number", "beam_number", "l_partkey", "l_suppkey", F.round("X", 6).alias("beam_x"), F.round("Y", 6).alias("beam_y"))


@query(f"WITH s AS ({SOUNDINGS}), r AS (SELECT *, row_number() OVER (PARTITION BY ping_number ORDER BY CASE WHEN ping_flags = 0 AND beam_flags = 0 THEN 0 ELSE 1 END, abs(across_track), beam_number, l_partkey, l_suppkey) AS k FROM s) SELECT ping_number, beam_number, l_partkey, l_suppkey, CAST(CASE WHEN k = 1 AND ping_flags = 0 AND beam_flags = 0 THEN 1 ELSE 0 END AS SMALLINT) AS centre_beam FROM r")
def centre_beam(spark, d):
    made = navigation.mark_centre_beam(soundings(spark, d), ["ping_number"], ["beam_number", "l_partkey", "l_suppkey"])
    return made.select("ping_number", "beam_number", "l_partkey", "l_suppkey", "centre_beam")


@query(f"WITH s AS ({SOUNDINGS}) SELECT ping_number, beam_number, l_partkey, l_suppkey FROM s WHERE ping_flags = 0 AND beam_flags = 0")
def good_beams(spark, d):
    return navigation.good_beams(soundings(spark, d)).select("ping_number", "beam_number", "l_partkey", "l_suppkey")


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events")
def scale_factor_carry_forward(spark, d):
    e = table(spark, d, "events").withColumn("carried", F.when(F.col("event_type") == "click", F.col("value")))
    return navigation.carry_forward(e, "carried", ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "carried")


_PINGS = "SELECT l_suppkey % 8 AS file_id, l_orderkey AS ping_number, count(*) AS num_beams FROM lineitem GROUP BY 1, 2"


@query(f"WITH p AS ({_PINGS}), o AS (SELECT *, CAST(sum(num_beams) OVER (PARTITION BY file_id ORDER BY ping_number) AS BIGINT) AS stop FROM p) SELECT file_id, ping_number, num_beams, stop - num_beams AS start, stop FROM o")
def beam_offsets(spark, d):
    p = soundings(spark, d).groupBy("file_id", "ping_number").agg(F.count("*").alias("num_beams"))
    return navigation.beam_offsets(p, ["file_id"], ["ping_number"])


@query(f"WITH s AS ({SOUNDINGS}) SELECT X, Y, CAST(CAST(Z AS FLOAT) AS DOUBLE) AS Z, CAST(beam_flags AS SMALLINT) AS beam_flags, ping_number, CAST(beam_number AS INTEGER) AS beam_number, CAST(0 AS SMALLINT) AS centre_beam, CAST(0 AS SMALLINT) AS sector_number, isnan('nan'::FLOAT) AS no_pitch FROM s")
def schema_coercion(spark, d):
    c = coerce_soundings(soundings(spark, d).drop("l_partkey", "l_suppkey"))
    return c.select("X", "Y", F.col("Z").cast("double").alias("Z"), "beam_flags", "ping_number", "beam_number", "centre_beam", "sector_number", F.isnan("pitch").alias("no_pitch"))


# planning


@query("SELECT c_custkey, CAST(ntile(14) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS block FROM customer")
def scatter_ntile(spark, d):
    return planning.scatter(table(spark, d, "customer"), 14, ["c_custkey"], ["c_nationkey"]).select("c_custkey", "block")


@query("SELECT CAST(floor(l_orderkey / 2000) AS BIGINT) AS slice, CAST(floor(floor(l_orderkey / 2000) / 3) AS BIGINT) AS task, count(*) AS beams FROM lineitem GROUP BY 1, 2")
def ping_slices(spark, d):
    return planning.ping_slices(soundings(spark, d)).groupBy("slice", "task").agg(F.count("*").alias("beams"))


@query("SELECT c_custkey, CAST((row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) % 40 AS INTEGER) AS lane FROM customer")
def lanes(spark, d):
    return planning.lanes(table(spark, d, "customer"), ["c_custkey"], 40, ["c_nationkey"]).select("c_custkey", "lane")


@query("SELECT s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS row_id FROM supplier")
def row_offsets(spark, d):
    return planning.row_offsets(table(spark, d, "supplier"), ["s_suppkey"], ["s_nationkey"]).select("s_suppkey", "row_id")


def manifest(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("file_id"), (F.col("o_totalprice") * 1000).alias("size"), (F.col("o_orderkey") % 5).alias("record_count"))


@query("SELECT o_orderkey AS file_id, CASE WHEN o_orderkey % 5 = 0 THEN 'empty' ELSE 'kept' END AS state FROM orders")
def filter_empty(spark, d):
    kept, empty = planning.split_empty(manifest(spark, d))
    return kept.select("file_id", F.lit("kept").alias("state")).unionByName(empty.select("file_id", F.lit("empty").alias("state")))


@query("SELECT o_orderkey AS file_id, CASE WHEN o_totalprice * 1000 / 1048576 > 200 THEN 'large' ELSE 'kept' END AS state FROM orders")
def filter_large(spark, d):
    kept, large = planning.split_large(manifest(spark, d), 200)
    return kept.select("file_id", F.lit("kept").alias("state")).unionByName(large.select("file_id", F.lit("large").alias("state")))


@query("WITH b AS (SELECT 0 AS age, * FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT 1, * FROM lineitem WHERE l_returnflag = 'R'), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY age DESC, l_partkey DESC, l_suppkey DESC) AS k FROM b) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM r WHERE k = 1")
def dense_upsert(spark, d):
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return planning.upsert(t.where("l_returnflag <> 'R'"), t.where("l_returnflag = 'R'"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query("SELECT l_returnflag, count(*) AS count FROM (SELECT * FROM lineitem WHERE l_linestatus = 'F' UNION ALL SELECT * FROM lineitem WHERE l_linestatus = 'O' UNION ALL SELECT * FROM lineitem WHERE l_linestatus = 'F') GROUP BY 1")
def combine_arrays(spark, d):
    t = table(spark, d, "lineitem")
    f, o = t.where("l_linestatus = 'F'"), t.where("l_linestatus = 'O'")
    return aggregate.value_count(f.unionByName(o).unionByName(f), "l_returnflag")


@query("WITH f AS (SELECT list(o_orderkey ORDER BY o_orderkey) AS a, list(o_custkey ORDER BY o_orderkey) AS b FROM orders) SELECT unnest(a) AS a, unnest(b) AS b, unnest(range(len(a))) AS position FROM f")
def positional_zip(spark, d):
    o = table(spark, d, "orders")
    left, right = (o.select(F.col("o_orderkey").alias("key"), F.col(c).alias(n)) for c, n in (("o_orderkey", "a"), ("o_custkey", "b")))
    return planning.positional_zip(left, right, "key").select("a", "b", "position")


# text and metadata


_STANDARD = lambda c: f"regexp_replace(regexp_replace(replace(replace(replace(lower({c}), ' ', '_'), '(', ''), ')', ''), '^_', ''), '_$', '')"


@query(f"SELECT s_suppkey, {_STANDARD("' ' || s_name || ' (General)'")} AS name FROM supplier")
def standardise_name(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", text.standardise_name(F.concat(F.lit(" "), "s_name", F.lit(" (General)"))).alias("name"))


_FORM = "SELECT p_partkey AS position, 'Survey (General)' AS sheet, CASE p_size % 4 WHEN 0 THEN 'Inherited' WHEN 1 THEN 'Mandatory' WHEN 2 THEN NULL ELSE 'Optional' END AS requirement, CASE WHEN p_size % 3 = 0 THEN 'Keywords (' || p_brand || ')' ELSE p_brand || ' Name' END AS field, CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name || ',' || p_type END AS value FROM part"


def form(spark, d):
    return spark.sql(_FORM.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))


@query(f"SELECT position, sheet, field, value FROM ({_FORM}) WHERE requirement IS DISTINCT FROM 'Inherited' AND value IS NOT NULL")
def harvest_filter(spark, d):
    return metadata.entered_rows(form(spark, d)).drop("requirement")


@query(f"WITH f AS (SELECT * FROM ({_FORM}) WHERE requirement IS DISTINCT FROM 'Inherited' AND value IS NOT NULL), n AS (SELECT position, CASE WHEN contains({_STANDARD('field')}, 'keyword') THEN 'keywords' ELSE {_STANDARD('field')} END AS field, CASE WHEN contains({_STANDARD('field')}, 'keyword') THEN value ELSE replace(value, ',', ';') END AS value, contains({_STANDARD('field')}, 'keyword') AS k FROM f), u AS (SELECT field, position, unnest(string_split(value, ',')) AS v, unnest(range(len(string_split(value, ',')))) AS i FROM n) SELECT 'survey_general' AS sheet, field, string_agg(v, '|' ORDER BY position, i) AS \"values\" FROM u GROUP BY field")
def clean_metadata(spark, d):
    keyword = F.contains(text.standardise_name(F.col("field")), F.lit("keyword"))
    rows = form(spark, d).withColumn("value", F.when(keyword, F.col("value")).otherwise(F.replace("value", F.lit(","), F.lit(";"))))
    return metadata.harvest(rows).select("sheet", "field", F.array_join("values", "|").alias("values"))


_VALUES = "SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN p_name WHEN 1 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN p_size || '.5,' || p_size || '.25' WHEN 3 THEN 'Yes' WHEN 4 THEN 'a,b' ELSE 'UNKNWN' END AS v FROM part"


@query(f"WITH v AS ({_VALUES}) SELECT p_partkey, CASE WHEN contains(v, ',') AND contains(v, '.') THEN 'numbers' WHEN contains(v, ',') THEN 'unknowns' WHEN v = 'Yes' THEN 'flag' WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN 'number' ELSE 'text' END AS kind, CASE WHEN contains(v, ',') AND contains(v, '.') THEN NULL WHEN contains(v, ',') THEN 'unknown,unknown' WHEN v = 'Yes' THEN 'true' WHEN try_cast(v AS DOUBLE) IS NOT NULL THEN NULL WHEN v = 'UNKNWN' THEN 'unknown' ELSE lower(v) END AS text, CASE WHEN NOT contains(v, ',') THEN try_cast(v AS DOUBLE) END AS number, CASE WHEN contains(v, ',') AND contains(v, '.') THEN list_sum(list_transform(string_split(v, ','), lambda x: CAST(x AS DOUBLE))) END AS sum FROM v")
def proc_param_parse(spark, d):
    v = spark.sql(_VALUES.replace("VARCHAR", "STRING").replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    made = v.select("p_partkey", text.parameter_value(F.col("v")).alias("x"))
    return made.select("p_partkey", "x.kind", "x.text", "x.number", F.aggregate("x.numbers", F.lit(0.0), lambda a, b: a + b).alias("sum"))


@query(f"WITH s AS ({SOUNDINGS}) SELECT round(min(X), 6) AS min_x, round(min(Y), 6) AS min_y, round(min(Z), 6) AS min_z, round(max(X), 6) AS max_x, round(max(Y), 6) AS max_y, round(max(Z), 6) AS max_z FROM s")
def stac_bbox(spark, d):
    b = metadata.stac_bbox(stats.partial_statistics(soundings(spark, d), ["X", "Y", "Z"]))
    return b.select(*(F.round(F.col("bbox")[k], 6).alias(n) for k, n in enumerate(("min_x", "min_y", "min_z", "max_x", "max_y", "max_z"))))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def props_json(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


def queries() -> dict[str, Query]:
    from soundgrid import catalog_io  # noqa: F401  (adds the queries of sources, sinks and jobs)

    return {k: f for k, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    from soundgrid import catalog_io  # noqa: F401

    return {k: s for k, (_, s) in _FOUND.items() if s}
