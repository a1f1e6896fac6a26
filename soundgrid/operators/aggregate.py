"""Cell frequencies, their merges and roll-ups, and time bounds.  All are partial and final hash aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid.functions.dggs import MAX_RESOLUTION, rhealpix_parent


def value_count(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value of a column; null values are not counted.

    A filter on the value would be pushed below the aggregate and compute a derived value twice; the null group counts 0 instead.
    """
    return df.groupBy(column).agg(F.count(column).alias(name)).where(F.col(name) > 0)


def cell_frequency(df: DataFrame, column: str = "region_code") -> DataFrame:
    return value_count(df, column)


def merge_cell_counts(*tables: DataFrame, column: str = "region_code") -> DataFrame:
    """Counts of several tables added up by cell."""
    both = reduce(DataFrame.unionByName, tables)
    return both.groupBy(column).agg(F.sum("count").cast("long").alias("count"))


def load_and_merge(spark, paths: list[str], column: str = "region_code") -> DataFrame:
    return merge_cell_counts(*(spark.read.parquet(p).select(column, "count") for p in paths), column=column)


def reduce_resolution(cells: DataFrame, resolution: int = 12) -> DataFrame:
    """Counts at a coarser resolution; coarser codes than it stay as they are."""
    return cells.groupBy(rhealpix_parent(F.col("region_code"), resolution).alias("region_code")).agg(F.sum("count").cast("long").alias("count"))


def resolution_rollup(cells: DataFrame, resolutions: list[int]) -> DataFrame:
    """(resolution, region_code, count) at several resolutions.  Cells are first reduced to the finest one wanted, so the expansion is of cells and not of soundings."""
    finest = reduce_resolution(cells, max(resolutions))
    levels = finest.select("count", F.explode(F.array(*(F.struct(F.lit(r).alias("resolution"), rhealpix_parent(F.col("region_code"), r).alias("region_code")) for r in sorted(resolutions)))).alias("l"))
    return levels.groupBy("l.resolution", "l.region_code").agg(F.sum("count").cast("long").alias("count"))


def density_levels(cells: DataFrame, top: int = 0, bottom: int = MAX_RESOLUTION) -> DataFrame:
    return resolution_rollup(cells, list(range(top, bottom + 1)))


def time_bounds(df: DataFrame, column: str = "timestamp", by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(F.min(column).alias("start_datetime"), F.max(column).alias("end_datetime"))


def merge_time_bounds(bounds: DataFrame, by: list[str] | None = None) -> DataFrame:
    return bounds.groupBy(*(by or [])).agg(F.min("start_datetime").alias("start_datetime"), F.max("end_datetime").alias("end_datetime"))
