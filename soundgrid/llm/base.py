"""Shared pieces: Arrow batch settings, sieves, lookups of hot keys, grouped streaming, components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.shared import cut, release, scratch, shared_dir
from soundgrid.ship import ship

__all__ = ["Forest", "components", "cut", "gathered", "lookup", "release", "runs", "scratch", "shared_dir", "sieve", "text_or_empty", "tune"]

#: Rows in one Arrow batch: whole texts travel in them, so batches stay a few MB.
BATCH_ROWS = 1000


def tune(spark: SparkSession) -> None:
    """Small Arrow batches, so that a Python worker's memory is bounded by a few MB of text; the package goes to workers that lack it."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def sieve(ids: DataFrame, bits: int = 23) -> Callable[..., DataFrame]:
    """A filter keep(rows, key, among=True) for the rows whose id may be among `ids` (a column `id`; no false negative), or with
    among=False for those that surely are not.

    A bitmap of 2**bits hashed ids, made by aggregation and broadcast: 1 MB at 23 bits whatever the number of ids.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    map_ = ids.select(place(F.col("id")).alias("b")).groupBy(F.bitmap_bucket_number("b").alias("bucket_of_sieve")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits_of_sieve"))
    sent = F.broadcast(cut(map_))

    def keep(rows: DataFrame, key: str, among: bool = True) -> DataFrame:
        at = F.bitmap_bit_position(place(F.col(key)))
        byte = F.conv(F.hex(F.substring("bits_of_sieve", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        set_ = F.expr("(shiftright(byte_of_sieve, bit_of_sieve) & 1) = 1")
        found = rows.join(sent, F.bitmap_bucket_number(place(F.col(key))) == F.col("bucket_of_sieve"), "inner" if among else "left")
        found = found.withColumn("byte_of_sieve", F.coalesce(byte, F.lit(0))).withColumn("bit_of_sieve", (at % 8).cast("int")).where(set_ if among else ~set_)
        return found.select(*(f"`{c}`" for c in rows.columns))

    return keep


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal keys, from batches sorted by them."""
    pending: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            col = batch.column(k)
            if len(col) > 1:
                change[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        first = tuple(batch.column(k)[0].as_py() for k in keys)
        if pending and first != last:
            yield pa.concat_tables(pending)
            pending = []
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            piece = table.slice(a, b - a)
            if a:
                yield pa.concat_tables(pending)
                pending = []
            pending.append(piece)
        last = tuple(batch.column(k)[batch.num_rows - 1].as_py() for k in keys)
    if pending:
        yield pa.concat_tables(pending)


class Forest:
    """Union-find over 0..n-1; the smaller root wins."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


LEAN = 100_000  # lean rows of a table that one task reads at least


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """A table of `rows` lean rows in no more tasks than it needs: iterations over small tables would else fill the driver with the records of empty tasks."""
    return df.coalesce(max(1, -(-rows // LEAN)))


HOT = 1000  # rows of a key from which on it counts as hot
HOTS = 100_000  # rows of a table that is broadcast, and hot keys, at most


def lookup(left: DataFrame, right: DataFrame, key: str, n: str = "n", how: str = "inner", counted: tuple[int, int, int] | None = None) -> DataFrame:
    """Join (inner or left) of `left` with the columns of `right`, which has one row per key and in `n` how many rows of `left` have it.

    Up to HOTS rows, counted, `right` is broadcast.  Beyond it, its keys of over HOT rows are (of more rows, if there are over HOTS such keys), so at most HOTS are; the
    other keys are joined by a shuffle in which rows of hot keys are spread evenly.  `right` is read several times: cut it before.
    `counted`: its rows, and the sum and the greatest of `n`, if known.
    """
    names = [c for c in right.columns if c not in (key, n)]
    rows, total, most = counted or right.agg(F.count("*"), F.coalesce(F.sum(n), F.lit(0)), F.coalesce(F.max(n), F.lit(0))).first()
    least = max(HOT, -(-total // HOTS))
    if rows <= HOTS or most <= least:
        other = right.select(key, *names)
        return left.join(F.broadcast(other) if rows <= HOTS else other, key, how).select(*left.columns, *names)
    hot = F.broadcast(right.where(F.col(n) > least).select(F.col(key).alias("key_of_hot"), *(F.col(c).alias(f"{c}_of_hot") for c in names)))
    cold = right.where(F.col(n) <= least).select(F.col(key).alias("key_of_cold"), F.lit(0).cast("long").alias("spread_of_cold"), *(F.col(c).alias(f"{c}_of_cold") for c in names))
    met = F.col("key_of_hot").isNotNull()
    placed = left.join(hot, F.col(key) == F.col("key_of_hot"), "left").withColumn("spread_of_left", F.when(met, F.xxhash64(*left.columns).bitwiseOR(F.lit(1).cast("long"))).otherwise(F.lit(0).cast("long")))
    both = placed.join(cold, (F.col(key) == F.col("key_of_cold")) & (F.col("spread_of_left") == F.col("spread_of_cold")), "left")
    both = both if how == "left" else both.where(met | F.col("key_of_cold").isNotNull())
    return both.select(*left.columns, *(F.when(met, F.col(f"{c}_of_hot")).otherwise(F.col(f"{c}_of_cold")).alias(c) for c in names))


ALONE = 4_000_000  # different edges that one task holds at most, with what is sorted a few hundred MB


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, least node of each one's component) of the edges u, v."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(nodes))
    while (up[a] != up[b]).any():
        x, y = up[a], up[b]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))  # roots go below smaller neighbouring roots
        while (up[up] != up).any():
            up = up[up]
    return nodes, nodes[up]


def _alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if held := [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]:
        nodes, least = least_reachable(*map(np.concatenate, zip(*held, strict=True)))
        for k in range(0, len(nodes), LEAN):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[k : k + LEAN]), pa.array(least[k : k + LEAN])], names=["node", "component"])


def components(edges: DataFrame, rounds: int = 60, alone: int = ALONE) -> DataFrame:
    """(node, component) of the undirected graph `edges` (u, v): component is the least node.

    Up to `alone` different edges, counted, are taken by one task: rounds over a small graph are dozens of jobs, whose records and threads fill the driver.
    More go through alternating large-star and small-star rounds; each is an aggregate and a lookup on the node, which broadcasts what
    belongs to a hub.  Nodes without edges are absent.  Self-loops are ignored.

    The graph is done when it is a forest of stars: when every node that has a smaller neighbour has no other (that neighbour then has none smaller).
    """
    now, rows = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), None
    for _ in range(rounds):
        now = cut(now)
        if rows is None:
            rows = 2 * now.count()
            if rows <= 2 * alone:
                return cut(now.select(F.col("u").cast("long"), F.col("v").cast("long")).coalesce(1).mapInArrow(_alone, "node long, component long"))
        both = gathered(now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), rows)  # a small graph is one task, and no shuffle
        least = gathered(cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "u"))), rows)
        open_, *counted = least.agg(F.sum(((F.col("m") < F.col("u")) & (F.col("n") > 1)).cast("long")), F.count("*"), F.sum("n"), F.max("n")).first()
        if not open_:
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        rows = counted[1]
        large = lookup(both.where("v > u"), least, "u", counted=counted).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large if rows <= LEAN else large.repartition("u")  # one exchange for the aggregate and the join
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        now = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("s")).select("s.u", "s.v").where("u <> v").distinct()
    raise RuntimeError(f"components did not settle in {rounds} rounds")
