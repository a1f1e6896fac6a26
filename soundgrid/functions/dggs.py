"""rHEALPIX cell codes as column expressions.

A code is a face N, O, P, Q, R or S and one digit 0..8 per level, 3 * row + column in the 3 x 3 children, rows from the top; a parent is a
prefix.  The ellipsoid is WGS84 and both polar squares are at position 0.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundgrid.shared import unclashing

# fixed values: WGS84
A = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
E1 = math.sqrt(E2)
QP = (1 - E2) * (1 / (1 - E2) - math.log((1 - E1) / (1 + E1)) / (2 * E1))
RADIUS = A * math.sqrt(QP / 2)
MAX_RESOLUTION = 15
FACES = ("N", "O", "P", "Q", "R", "S")
#: Upper left corner of each face, in quarter turns of the authalic radius.
CORNERS = {"N": (-4, 3), "O": (-4, 1), "P": (-2, 1), "Q": (0, 1), "R": (2, 1), "S": (-4, -1)}


def cell_width(resolution: int) -> float:
    """Metres across a planar cell."""
    return RADIUS * math.pi / 2 * 3.0**-resolution


def _sine_authalic(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (s / (1 - E2 * s * s) - F.ln((1 - E1 * s) / (1 + E1 * s)) / (2 * E1)) * ((1 - E2) / QP)))


def rhealpix_encode(lon: Column, lat: Column, resolution: int = MAX_RESOLUTION) -> Column:
    """Cell code of a WGS84 position; null for null, NaN or out-of-range input.  Longitude 180 is -180.

    One built-in expression, so it runs in generated code and its repeated parts are computed once.  A face's own coordinates
    run from 0 to 1, right and down.  Equatorial faces are the quarter turns of longitude; a polar face is four triangles, one
    for each quarter, whose distance from the pole is `far` (0 to 1) and which are turned to the cap's sides.  Row and column are
    written in base 3, read in base 9, and 3 * row + column in base 9 holds the digits.
    """
    if not 0 <= resolution <= MAX_RESOLUTION:
        raise ValueError(f"resolution is 0 to {MAX_RESOLUTION}")
    lon, lat = lon.cast("double"), lat.cast("double")
    lon, lat = F.when((lon >= -180) & (lon < 180), lon).when(lon == 180, -180.0), F.when((lat >= -90) & (lat <= 90), lat)  # NaN fails these too
    known = (lon * 0 + lat * 0).cast("long")  # 0, or null
    turn = F.radians(lon) * (2 / math.pi) + 2
    quarter = F.greatest(F.lit(0), F.least(F.lit(3), F.floor(turn))).cast("int")
    sine = _sine_authalic(lat)
    # whole expressions are selected by factors 0 and 1, not by branches, so that their common parts are computed once
    flat = (F.abs(sine) <= 2 / 3).cast("double")
    far = F.sqrt(F.greatest(F.lit(0.0), 3 * (1 - F.abs(sine))))
    along, out = (turn - quarter - 0.5) * far, far / 2
    cos = F.get(F.array(*map(F.lit, (1.0, 0.0, -1.0, 0.0))), quarter)
    sin = F.get(F.array(*map(F.lit, (0.0, 1.0, 0.0, -1.0))), quarter)
    right = flat * (turn - quarter) + (1 - flat) * (0.5 + along * cos + out * sin)
    down = 0.5 - flat * 0.75 * sine - (1 - flat) * F.signum(sine) * (along * sin - out * cos)
    face = F.substring(F.lit("SSSSOPQRNNNN"), (flat * 4 + (1 - flat) * (4 + 4 * F.signum(sine)) + quarter + 1).cast("int"), F.lit(1))
    if not resolution:
        return F.when(known == 0, face)
    place = lambda d: F.greatest(F.lit(0), F.least(F.lit(3**resolution - 1), F.floor(d * 3**resolution)))
    in_nine = lambda d: F.conv(F.conv(place(d).cast("string"), 10, 3), 9, 10).cast("long")
    digits = F.conv((3 * in_nine(down) + in_nine(right) + known).cast("string"), 10, 9)
    return F.concat(face, F.lpad(digits, resolution, "0"))


def with_cell(df: DataFrame, lon: str = "X", lat: str = "Y", resolution: int = MAX_RESOLUTION, name: str = "region_code") -> DataFrame:
    """`df` with a cell code column.

    The code is computed in a projection of its own under a one-element explode: later filters on the code (and those that
    joins infer) stay above it and do not compute it again, while filters on other columns still reach the scan.
    """
    unclashing(df, "sg_code")
    names = [c for c in df.columns if c != name]
    made = df.withColumn("sg_code", rhealpix_encode(F.col(lon), F.col(lat), resolution))
    return made.select(*(f"`{c}`" for c in names), F.explode_outer(F.array("sg_code")).alias(name))


def rhealpix_parent(code: Column, resolution: int) -> Column:
    return F.substring(code, 1, resolution + 1)


def unpack_code(code: Column) -> dict[str, Column]:
    """R0 (face) and R1..R15 (digits, 0 where the code is shorter)."""
    return {"R0": F.substring(code, 1, 1), **{f"R{k}": F.coalesce(F.substring(code, k + 1, 1).try_cast("smallint"), F.lit(0).cast("smallint")) for k in range(1, MAX_RESOLUTION + 1)}}


def code_filter(prefix: str) -> Column:
    """Rows under a cell, with predicates on R0 and R1 too so that partitions are pruned."""
    found = F.col("region_code").startswith(prefix)
    for k, c in enumerate(prefix[:2]):
        found &= F.col(f"R{k}") == (c if k == 0 else int(c))
    return found


def rhealpix_shape(code: Column) -> Column:
    """0 equatorial quad, 1 polar cap, 2 dart, 3 skew quad."""
    return F.when(code.rlike("^[OPQR]"), 0).when(code.rlike("^[NS]4*$"), 1).when(code.rlike("^[NS][02468]*$"), 2).otherwise(3)
