"""Splitting files, pings and cells into parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from soundgrid.shared import cut, unclashing


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` with sg_position (from 0) and sg_rows (all rows) in a global order, without a window over the whole table.

    Rows are sorted by ranges and written with their place in their partition; only the partitions' counts, one row each, meet in one task, and are broadcast.
    """
    unclashing(df, "sg_part", "sg_place", "sg_before", "sg_rows", "sg_position")
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut(df.orderBy(*order).select("*", F.spark_partition_id().alias("sg_part"), inside.alias("sg_place")))
    counts = placed.groupBy("sg_part").agg(F.count("*").alias("n"))
    first = Window.orderBy("sg_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("sg_part", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("sg_before"), F.sum("n").over(Window.partitionBy()).alias("sg_rows"))
    return placed.join(F.broadcast(base), "sg_part").withColumn("sg_position", F.col("sg_before") + F.col("sg_place")).drop("sg_part", "sg_place", "sg_before")


def scatter(df: DataFrame, n: int, order: list[str], by: list[str] | None = None) -> DataFrame:
    """`block` 1..n of near-equal contiguous blocks, the first ones longer by one; over the whole table, or by groups."""
    if by:
        return df.withColumn("block", F.ntile(n).over(Window.partitionBy(*by).orderBy(*order)))
    size, longer = F.floor(F.col("sg_rows") / n), F.col("sg_rows") % n
    head = longer * (size + 1)
    block = F.when(F.col("sg_position") < head, F.floor(F.col("sg_position") / (size + 1))).otherwise(longer + F.floor((F.col("sg_position") - head) / F.greatest(size, F.lit(1))))
    return ranked(df, order).withColumn("block", (block + 1).cast("int")).drop("sg_position", "sg_rows")


def ping_slices(df: DataFrame, step: int = 2000, per_task: int = 3) -> DataFrame:
    return df.withColumn("slice", F.floor(F.col("ping_number") / step).cast("long")).withColumn("task", F.floor(F.col("slice") / per_task).cast("long"))


def lanes(df: DataFrame, order: list[str], n: int = 40, by: list[str] | None = None) -> DataFrame:
    """`lane` 0..n-1, dealt in turn over the whole table, or by groups."""
    if by:
        return df.withColumn("lane", ((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) % n).cast("int"))
    return ranked(df, order).withColumn("lane", (F.col("sg_position") % n).cast("int")).drop("sg_position", "sg_rows")


def row_offsets(df: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """`row_id` from 0 over the whole table, or by groups."""
    if by:
        return df.withColumn("row_id", (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))
    return ranked(df, order).withColumnRenamed("sg_position", "row_id").drop("sg_rows")


def split_empty(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with pings, files without); a file of unknown count is kept."""
    empty = F.col("record_count").eqNullSafe(0)
    return files.where(~empty), files.where(empty)


def split_large(files: DataFrame, megabytes: float) -> tuple[DataFrame, DataFrame]:
    """(files up to the limit, larger ones); a file of unknown size is kept."""
    large = F.coalesce(F.col("size") / 1048576 > megabytes, F.lit(False))
    return files.where(~large), files.where(large)


def ping_bounds(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """min_ping, max_ping of the whole table or of groups, such as blocks."""
    return df.groupBy(*(by or [])).agg(F.min("ping_number").alias("min_ping"), F.max("ping_number").alias("max_ping"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows of `new` replace those of `old` with equal keys; of equal keys in one table the last in `order` stays.  Columns that only one table has are kept, null in
    the other's rows.  A row with a null in its key equals no other and stays."""
    names = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    unclashing(old.select(*names[: len(old.columns)]), "sg_age", "sg_row")
    unclashing(new, "sg_age", "sg_row")
    both = old.withColumn("sg_age", F.lit(0)).unionByName(new.withColumn("sg_age", F.lit(1)), allowMissingColumns=True)
    known = sum((F.col(k).isNull().cast("int") for k in keys), F.lit(0)) == 0
    rank = F.struct("sg_age", *(order or []))
    rest = [c for c in names if c not in keys]
    kept = both.where(known).groupBy(*keys).agg(F.max_by(F.struct(F.lit(0).alias("sg_age"), *rest), rank).alias("sg_row")).select(*keys, "sg_row.*").drop("sg_age")
    return kept.select(*names).unionByName(both.where(~known).select(*names))


def positions(df: DataFrame, key: str, width: int = 65536) -> DataFrame:
    """`position` of each row from 0 in order of an integer key (nulls first), by groups of `width` keys: only the groups' counts meet in one task."""
    grouped = df.withColumn("group_of_keys", F.floor(F.col(key) / width).cast("long"))
    counts = grouped.groupBy(F.col("group_of_keys").alias("of")).agg(F.count("*").alias("n"))
    before = Window.orderBy(F.col("of").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("of", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("group_of_keys").orderBy(key))
    placed = grouped.withColumn("rank_in_group", rank).join(base, F.col("group_of_keys").eqNullSafe(F.col("of")))
    return placed.withColumn("position", (F.col("base") + F.col("rank_in_group") - 1).cast("long")).drop("group_of_keys", "rank_in_group", "of", "base")


def positional_zip(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of two tables paired by their position in order of `key`, which is dropped; the shorter one is filled with nulls."""
    return positions(left, key).drop(key).join(positions(right, key).drop(key), "position", "full")
