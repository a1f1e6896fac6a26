"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

1. Equal vectors are one class with a count; copies are never paired.
2. Each unit vector is dealt to the nearest of at most PIVOTS pivots (a bounded hash-chosen sample of the vectors) and, in a
   pivot's cell, to blocks of about BLOCK; cells smaller than a block share one.  A cell's radius is the largest angle to its pivot.  Two cells whose pivots'
   angle exceeds both radii plus the threshold's angle hold no link, by the triangle inequality; areas without a pair of cells that may, make no tile.
3. A unit vector is quantised once, to int8 with a scale of its own; u = s q + r with |r| = e known, so |u.v - (s q).(t p)| <= e_u + e_v + e_u e_v.
   A tile is two blocks of quantised vectors; the vectors themselves do not travel to it.  The integer products run as float32 matrix products, exact
   below 2**24 (DIMENSIONS bounds them).  Most pairs need only a product of their heads: the first quarter of the components and the norm of the
   rest, which bounds u.v by Cauchy-Schwarz.  Pairs surely above the threshold count as links; vectors with a pair that is possibly above
   are fetched in full precision, to the tiles that ask for them, and only such pairs are recomputed there in double precision.
   The SIZES most common lengths of vectors get pivots; all other lengths together are dealt to blocks of their own length in one pass.
4. A tile returns, per class, its number of linked vectors and a parent in the tile's spanning forest: no pairs.  Components
   of these forests give the groups.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
lengths link with nothing of another length; equal vectors link with each other; labels and other columns play no part; a null vec_id is kept and unlinked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Forest, components, cut, lookup, runs, tune

PIVOTS = 192
BLOCK = 8192
STRIP = 256  # rows multiplied at once
SIZES = 8  # lengths of vectors, the most common ones, that get pivots; vectors of other lengths are compared block by block
DIMENSIONS = 1024  # 1024 * 127 * 127 < 2**24
HEAD = 256  # components of a head at most
MANY = 64  # a strip is multiplied whole if over one pair in so many may be linked by its heads


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32), scales, and the norm of what is lost."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None])
    return q.astype(np.float32), scale, np.linalg.norm(u - q * scale[:, None], axis=1) + 1e-12


def head_of(d: int) -> int:
    return min(HEAD, d // 4)


class Block:
    """Quantised vectors: values (as float32), scales, errors, and the norms of what follows the heads."""

    def __init__(self, q: np.ndarray, scale: np.ndarray, error: np.ndarray, rest: np.ndarray):
        self.q, self.scale, self.error = q, scale, error
        self.parts = -(-q.shape[1] // DIMENSIONS)
        # a product of two heads bounds the vectors' own, but for the quantisation errors
        self.heads = np.hstack([q[:, : head_of(q.shape[1])] * scale[:, None], rest[:, None]]).astype(np.float32)

    def __len__(self):
        return len(self.q)

    @classmethod
    def of(cls, u: np.ndarray) -> Block:
        return cls(*quantise(u), np.linalg.norm(u[:, head_of(u.shape[1]) :], axis=1))

    def take(self, at) -> Block:
        made = object.__new__(Block)
        made.q, made.scale, made.error, made.heads, made.parts = self.q[at], self.scale[at], self.error[at], self.heads[at], self.parts
        return made


def candidates(a: Block, b: Block | None, threshold: float):
    """Yields (i, j, sure): pairs surely above the threshold, and those possibly above it, strip by strip; b None: the pairs i < j of a.

    A product of heads rules most pairs out.  The others' whole int8 products are taken, in one product of the strip where they are many.
    """
    right = a if b is None else b
    exact = np.float64 if a.parts > 1 else np.float32
    for x in range(0, len(a), STRIP):
        y = slice(x, x + STRIP)
        lo = x if b is None else 0
        ea, eb = a.error[y], right.error[lo:]
        # single precision picks what may reach the threshold, with slack for its rounding
        worst = ea.max() + eb.max() * (1 + ea.max())
        i, j = np.divmod(np.flatnonzero(a.heads[y] @ right.heads[lo:].T >= np.float32(threshold - 1e-4 - worst)), len(right) - lo)
        if not len(i):
            continue
        if len(i) * MANY > len(ea) * (len(right) - lo):
            least = ((threshold - 1e-4 - eb - ea.max() * (1 + eb)) / right.scale[lo:]).astype(np.float32)
            dot = sum((a.q[y, k :: a.parts] @ right.q[lo:, k :: a.parts].T).astype(exact) for k in range(a.parts))
            i, j = np.nonzero(dot * a.scale[y, None].astype(np.float32) >= least)
            dot = dot[i, j].astype(np.float64)
        else:
            dot = np.empty(len(i))
            for c in range(0, len(i), 65536):
                k = slice(c, c + 65536)
                dot[k] = np.einsum("ij,ij->i", a.q[i[k] + x], right.q[j[k] + lo], dtype=exact)
        i, j = i + x, j + lo
        if b is None:
            up = i < j
            i, j, dot = i[up], j[up], dot[up]
        close = dot * a.scale[i] * right.scale[j]
        error = a.error[i] + right.error[j] + a.error[i] * right.error[j]
        sure = close - error >= threshold + 1e-9
        some = sure | (close + error >= threshold - 1e-9)
        yield i[some], j[some], sure[some]


def exact_links(i: np.ndarray, j: np.ndarray, u: np.ndarray, v: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of unit vectors reach the threshold in double precision."""
    out = np.empty(len(i), bool)
    for c in range(0, len(i), 65536):
        k = slice(c, c + 65536)
        out[k] = np.einsum("ij,ij->i", u[i[k]], v[j[k]]) >= threshold
    return out


def tile(a: np.ndarray, b: np.ndarray | None, threshold: float):
    """Yields (i, j) index arrays of linked pairs of unit vectors: the whole of what a tile does, where both forms are at hand."""
    for i, j, sure in candidates(Block.of(a), None if b is None else Block.of(b), threshold):
        sure[~sure] = exact_links(i[~sure], j[~sure], a, a if b is None else b, threshold)
        yield i[sure], j[sure]


QUANTISED = "rep long, n long, q binary, scale double, error double, rest double"


def _quantised(batch, u: np.ndarray) -> list:
    q, scale, error = quantise(u) if len(u) else (np.zeros((0, 1)), *(np.zeros(0),) * 2)
    rest = np.linalg.norm(u[:, head_of(u.shape[1]) :], axis=1) if len(u) else np.zeros(0)
    return [batch.column("rep"), batch.column("n"), pa.array([x.tobytes() for x in q.astype(np.int8)], pa.binary()), pa.array(scale), pa.array(error), pa.array(rest)]


def _cells(pivots: np.ndarray):
    def run(batches):
        for batch in batches:
            u = unit(matrix(batch.column("embedding"))) if batch.num_rows else np.zeros((0, pivots.shape[1]))
            cos = np.clip(u @ pivots.T, -1, 1)
            cell = cos.argmax(axis=1)
            angle = np.arccos(cos[np.arange(len(u)), cell])
            yield pa.RecordBatch.from_arrays([*_quantised(batch, u), pa.array(cell.astype(np.int32)), pa.array(angle)], names=["rep", "n", "q", "scale", "error", "rest", "cell", "angle"])

    return run


def _each_length(batches):
    """Quantised vectors of any lengths."""
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        for size in np.unique(sizes):
            own = batch.filter(pa.array(sizes == size))
            yield pa.RecordBatch.from_arrays([*_quantised(own, unit(matrix(own.column("embedding")))), own.column("size")], names=["rep", "n", "q", "scale", "error", "rest", "size"])


KEYS = ["c1", "b1", "c2", "b2"]
FOUND = "rep long, links long, parent long, c1 int, b1 int, c2 int, b2 int, side int"


def _block(t: pa.Table) -> Block:
    q = np.frombuffer(b"".join(t["q"].to_pylist()), np.int8).reshape(t.num_rows, -1).astype(np.float32)
    return Block(q, *(t[c].to_numpy() for c in ("scale", "error", "rest")))


def _tiles(threshold: float, recompute: bool):
    """Of each tile, its classes' links and a parent in their spanning forest.  First pass: of the sure pairs, and the classes of pairs that are not sure.
    `recompute`: those come again with their vectors, and of the unsure pairs it returns the links."""

    def run(batches):
        for t in runs(batches, KEYS):
            side, ids, n = t["side"].to_numpy(), t["rep"].to_numpy(), t["n"].to_numpy()
            key = [t[k][0].as_py() for k in KEYS]
            same = key[:2] == key[2:]
            cut_at = len(ids) if same else int((side == 0).sum())
            if not same and cut_at in (0, len(ids)):
                continue
            whole = _block(t)
            a, b = (whole, None) if same else (whole.take(slice(0, cut_at)), whole.take(slice(cut_at, None)))
            u = unit(matrix(t["embedding"])) if recompute else None
            links, forest, unsure = np.zeros(len(ids), np.int64), Forest(len(ids)), np.zeros(len(ids), bool)
            for i, j, sure in candidates(a, b, threshold):
                j = j + (0 if same else cut_at)
                if recompute:
                    i, j = i[~sure], j[~sure]
                    linked = exact_links(i, j, u, u, threshold)
                    i, j = i[linked], j[linked]
                else:
                    unsure[i[~sure]] = unsure[j[~sure]] = True
                    i, j = i[sure], j[sure]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                for x, y in _few(i, j, len(ids)):
                    forest.join(x, y)
            some, ask = np.flatnonzero(links), np.flatnonzero(unsure)
            nothing = lambda k, kind: pa.nulls(k, kind)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some]), pa.array(ids[[forest.root(int(x)) for x in some]]), *(nothing(len(some), pa.int32()) for _ in range(5))], names=[x.split()[0] for x in FOUND.split(", ")])
            if len(ask):
                yield pa.RecordBatch.from_arrays([pa.array(ids[ask]), nothing(len(ask), pa.int64()), nothing(len(ask), pa.int64()), *(pa.array(np.full(len(ask), k, np.int32)) for k in key), pa.array(side[ask].astype(np.int32))], names=[x.split()[0] for x in FOUND.split(", ")])

    return run


def _few(i: np.ndarray, j: np.ndarray, n: int):
    """Pairs that connect what all given pairs connect: rounds of least-neighbour labels, vectorised."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    k = np.flatnonzero(label != np.arange(n))
    return zip(k.tolist(), label[k].tolist(), strict=True)


def near_vectors(vectors: DataFrame, threshold: float = 0.95, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    spark = vectors.sparkSession
    tune(spark)
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    fine = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = rows.where(fine & F.col("vec_id").isNotNull())
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = cut(classes.withColumn("size", F.size("embedding")))
    sums, edges = [], []
    carried = ["rep", "n", "q", "scale", "error", "rest"]

    def compare(both: DataFrame, quantised: DataFrame) -> None:
        dealt = lambda rows, again: cut(rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "side", "rep").mapInArrow(_tiles(threshold, again), FOUND))
        first = dealt(both, False)
        asked = first.where("links is null").select("rep", *KEYS, "side")
        for made in (first.where("links is not null"), dealt(asked.join(quantised.select(*carried), "rep").join(classes.select("rep", "embedding"), "rep"), True) if asked.limit(1).count() else None):
            if made is not None:
                sums.append(made.groupBy("rep").agg(F.sum("links").alias("links")))
                edges.append(made.where("rep <> parent").select(F.col("rep").alias("u"), F.col("parent").alias("v")))

    by_size = cut(classes.groupBy("size").agg(F.count("*").alias("n_of_size")))
    common = [r["size"] for r in by_size.orderBy(F.desc("n_of_size"), "size").limit(SIZES).collect()]
    rest = by_size.where(~F.col("size").isin(common))
    if rest.limit(1).count():
        quantised = cut(classes.join(rest.select("size"), "size", "left_semi").select("rep", "n", "embedding", "size").mapInArrow(_each_length, f"{QUANTISED}, size int"))
        blocked = quantised.join(rest, "size").withColumn("blocks", F.ceil(F.col("n_of_size") / block).cast("int")).withColumn("b", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        place = (-F.col("size") - 1).cast("int")
        lists = lambda c: F.when(F.col("b") > 0, F.sequence(F.lit(0), F.col("b") - 1)).otherwise(F.array().cast("array<int>")) if c else F.sequence(F.col("b"), F.col("blocks") - 1)
        left = blocked.select(*carried, place.alias("c1"), F.col("b").alias("b1"), place.alias("c2"), F.explode(lists(0)).alias("b2"), F.lit(0).alias("side"))
        right = blocked.select(*carried, place.alias("c1"), F.explode(lists(1)).alias("b1"), place.alias("c2"), F.col("b").alias("b2"), F.lit(1).alias("side"))
        compare(left.unionByName(right), quantised)
    for size in sorted(common):
        own = classes.where(F.col("size") == size)
        few = own.orderBy(F.xxhash64("rep"), "rep").limit(pivots).select("embedding").collect()
        centre = unit(np.array([r[0] for r in few], dtype=np.float64))
        cells = cut(own.mapInArrow(_cells(centre), f"{QUANTISED}, cell int, angle double"))
        stats = {r["cell"]: r for r in cells.groupBy("cell").agg(F.count("*").alias("m"), F.max("angle").alias("radius")).collect()}  # at most `pivots` rows
        between = np.arccos(np.clip(centre @ centre.T, -1, 1))
        reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6
        area, size_of = {}, []  # areas: cells packed up to a block, nearest to the first pivot first
        for c in sorted(stats, key=lambda c: between[0, c]):
            if not size_of or size_of[-1] + stats[c]["m"] > block:
                size_of.append(0)
            size_of[-1] += stats[c]["m"]
            area[c] = len(size_of) - 1
        blocks = [-(-m // block) for m in size_of]
        touch = {(area[p], area[q]) for p in stats for q in stats if area[p] <= area[q] and between[p, q] <= stats[p]["radius"] + stats[q]["radius"] + reach}
        near = [(p, q, blocks[p], blocks[q]) for p, q in sorted(touch)]
        pairs = F.broadcast(spark.createDataFrame(near, "c1 int, c2 int, n1 int, n2 int"))  # at most pivots squared rows
        dealt = cells.withColumn("area", F.create_map(*(F.lit(x) for item in area.items() for x in item))[F.col("cell")])
        left = dealt.join(pairs, F.col("area") == F.col("c1")).withColumn("b1", F.pmod(F.xxhash64("rep"), F.col("n1")).cast("int"))
        left = left.select(*carried, "c1", "b1", "c2", F.explode(F.when(F.col("c1") == F.col("c2"), F.sequence(F.col("b1"), F.col("n2") - 1)).otherwise(F.sequence(F.lit(0), F.col("n2") - 1))).alias("b2"), F.lit(0).alias("side"))
        right = dealt.join(pairs, F.col("area") == F.col("c2")).withColumn("b2", F.pmod(F.xxhash64("rep"), F.col("n2")).cast("int"))
        right = right.select(*carried, "c1", F.explode(F.when(F.col("c1") == F.col("c2"), F.when(F.col("b2") > 0, F.sequence(F.lit(0), F.col("b2") - 1)).otherwise(F.array().cast("array<int>"))).otherwise(F.sequence(F.lit(0), F.col("n1") - 1))).alias("b1"), "c2", "b2", F.lit(1).alias("side"))
        compare(left.unionByName(right), cells)
    if not sums:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    total, links = sums[0], edges[0]
    for a, b in zip(sums[1:], edges[1:], strict=True):
        total, links = total.unionByName(a), links.unionByName(b)
    total = total.groupBy("rep").agg(F.sum("links").alias("links"))  # of both passes
    group = components(links).select(F.col("node").alias("rep"), "component")
    per_class = classes.join(total, "rep", "left").join(group, "rep", "left").select("embedding", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    found = lookup(good, cut(per_class), "embedding").select("vec_id", "n_links", "component_id")
    found = found.unionByName(rows.where(~fine | F.col("vec_id").isNull()).select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id")))
    return found.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
