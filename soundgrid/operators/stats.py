"""Statistics of numeric attributes: one scan for all attributes, mergeable partials, and the two forms of the result.

NaN and null are left out everywhere; `n_total` counts all rows.  Variance is the sample's; skewness and excess kurtosis are the population's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soundgrid.shared import unclashing

PARTIAL = ["minimum", "maximum", "count", "total", "mu2_prime", "mu3_prime", "mu4_prime"]
FINAL = ["minimum", "maximum", "count", "total", "mean", "variance", "stddev", "skewness", "kurtosis"]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _value(name: str, df: DataFrame) -> Column:
    kind = df.schema[name].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{name} is {kind.simpleString()}: statistics need a numeric attribute")
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _long(wide: DataFrame, columns: list[str], names: list[str], by: list[str]) -> DataFrame:
    """One row per attribute from columns <index>_<measure>."""
    rows = F.array(*(F.struct(F.lit(c).alias("attribute"), *(F.col(f"{k}_{n}").alias(n) for n in names)) for k, c in enumerate(columns)))
    return wide.select(*by, F.inline(rows))


def basic_statistics(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """attribute, n_total and FINAL, by Spark's central-moment aggregates (stable for large means)."""
    columns, by = columns or numeric_columns(df), by or []
    aggs = []
    for k, c in enumerate(columns):
        v = _value(c, df)
        made = {"n_total": F.count(F.lit(1)), "minimum": F.min(v), "maximum": F.max(v), "count": F.count(v), "total": F.sum(v), "mean": F.avg(v), "variance": F.var_samp(v), "stddev": F.stddev_samp(v), "skewness": F.skewness(v), "kurtosis": F.kurtosis(v)}
        aggs += [e.alias(f"{k}_{n}") for n, e in made.items()]
    return _long(df.groupBy(*by).agg(*aggs), columns, ["n_total", *FINAL], by)


def partial_statistics(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """attribute and PARTIAL (raw power sums), one row per attribute and group; these merge by addition."""
    columns, by = columns or numeric_columns(df), by or []
    aggs = []
    for k, c in enumerate(columns):
        v = _value(c, df)
        made = {"minimum": F.min(v), "maximum": F.max(v), "count": F.count(v), "total": F.sum(v), "mu2_prime": F.sum(v * v), "mu3_prime": F.sum(v * v * v), "mu4_prime": F.sum(v * v * v * v)}
        aggs += [e.alias(f"{k}_{n}") for n, e in made.items()]
    return _long(df.groupBy(*by).agg(*aggs), columns, PARTIAL, by)


def finish(partial: DataFrame, by: list[str] | None = None) -> DataFrame:
    """FINAL from power sums."""
    by = by or ["attribute"]
    n = F.nullif(F.col("count").cast("double"), F.lit(0.0))
    mean = F.col("total") / n
    raw = {k: F.col(f"mu{k}_prime") / n for k in (2, 3, 4)}
    step = partial.select(*by, "minimum", "maximum", "count", "total", mean.alias("mean"), *(v.alias(f"r{k}") for k, v in raw.items()))
    m = F.col("mean")
    step = step.withColumns({"c2": F.col("r2") - m * m, "c3": F.col("r3") - 3 * m * F.col("r2") + 2 * m * m * m, "c4": F.col("r4") - 4 * m * F.col("r3") + 6 * m * m * F.col("r2") - 3 * m * m * m * m})
    variance = F.when(F.col("count") > 1, F.col("c2") * F.col("count") / (F.col("count") - 1))
    spread = F.col("c2") > 0
    return step.select(*by, "minimum", "maximum", "count", "total", "mean", variance.alias("variance"), F.sqrt(variance).alias("stddev"), F.when(spread, F.col("c3") / F.sqrt(F.col("c2") * F.col("c2") * F.col("c2"))).alias("skewness"), F.when(spread, F.col("c4") / (F.col("c2") * F.col("c2")) - 3).alias("kurtosis"))


def merge_partials(partials: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or ["attribute"]
    return partials.groupBy(*by).agg(F.min("minimum").alias("minimum"), F.max("maximum").alias("maximum"), F.sum("count").cast("long").alias("count"), *(F.sum(c).alias(c) for c in PARTIAL[3:]))


def reduce_statistics(partials: DataFrame, by: list[str] | None = None) -> DataFrame:
    return finish(merge_partials(partials, by), by)


def gather_statistics(*tables: DataFrame) -> DataFrame:
    """Rows of several results; of an attribute that several have, that of the last."""
    out = None
    for k, t in enumerate(tables):
        unclashing(t, "sg_place")
        t = t.withColumn("sg_place", F.lit(k))
        out = t if out is None else out.unionByName(t)
    names = [c for c in out.columns if c not in ("attribute", "sg_place")]
    return out.groupBy("attribute").agg(F.max_by(F.struct(*names), "sg_place").alias("sg_row")).select("attribute", "sg_row.*")


#: Cells sent to all executors; above it the join is left to a shuffle on the code.
BROADCAST_CELLS = 100_000


def _small(df: DataFrame) -> DataFrame:
    """Broadcast up to BROADCAST_CELLS rows, counted."""
    return F.broadcast(df) if df.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS else df


def cell_statistics(points: DataFrame, cells: DataFrame, columns: list[str], mode: str = "exact") -> DataFrame:
    """Partials of the points in some cells.

    exact: points whose code is one of `cells.region_code` (all of one resolution); each once.  bbox: points in the longitude and latitude boxes of the
    cells (columns min_x..max_y); a point in k boxes counts k times.  The boxes are then joined by squares of about their size, not as a nested loop.
    """
    if mode == "exact":
        return partial_statistics(points.join(_small(cells.select("region_code").distinct()), "region_code", "left_semi"), columns)
    return partial_statistics(bbox_join(points, cells), columns)


LEVELS = (-24, 9)  # squares of 2**-24 to 2**9 degrees


def bbox_candidates(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points with each box that covers part of their square: squares are as large as the box (the next power of two), so a box covers at most three by three of them,
    however small or clustered boxes are.  A point is looked up once for each size that occurs, at most LEVELS."""
    unclashing(points, "sg_level", "sg_x", "sg_y")
    unclashing(boxes, "sg_level", "sg_x", "sg_y")
    proper = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in ("min_x", "max_x", "min_y", "max_y")]
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(2.0 ** LEVELS[0]))
    grid = lambda c: F.floor(c / F.pow(F.lit(2.0), F.col("sg_level")))
    sized = boxes.where(proper[0] & proper[1] & proper[2] & proper[3]).where("min_x <= max_x and min_y <= max_y").withColumn("sg_level", F.least(F.lit(LEVELS[1]), F.ceil(F.log2(extent))).cast("int"))
    levels = sorted(r[0] for r in sized.select("sg_level").distinct().collect())
    covered = sized.withColumn("sg_x", F.explode(F.sequence(grid(F.col("min_x")), grid(F.col("max_x"))))).withColumn("sg_y", F.explode(F.sequence(grid(F.col("min_y")), grid(F.col("max_y")))))
    known = lambda c: F.abs(F.col(c).cast("double")) < 1e6  # noqa: E731  (neither null nor NaN)
    level = F.explode(F.array(*map(F.lit, levels))) if len(levels) > 1 else F.lit(levels[0] if levels else 0)
    placed = points.where(known("X") & known("Y")).withColumn("sg_level", level).withColumns({"sg_x": grid(F.col("X")), "sg_y": grid(F.col("Y"))})
    return placed.join(_small(covered), ["sg_level", "sg_x", "sg_y"]).drop("sg_level", "sg_x", "sg_y")


def bbox_join(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points with each box that holds them, edges included (box columns min_x, max_x, min_y, max_y): an equi-join on squares, then the exact test.

    Points without a position, and boxes without bounds or with bounds in the wrong order, meet nothing."""
    inside = F.col("X").between(F.col("min_x"), F.col("max_x")) & F.col("Y").between(F.col("min_y"), F.col("max_y"))
    return bbox_candidates(points, boxes).where(inside)
