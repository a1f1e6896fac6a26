"""Near-duplicate documents with HyperMinHash sketches.

A document's set holds the distinct shingles of WIDTH words (words are runs of bytes other than space and \\t..\\r, A-Z in lower
case); a document with fewer words has its whole word sequence as the one shingle; one without words has an empty set.
Two documents are linked if 100 * |A and B| >= percent * |A or B|.

1. Sketch.  Shingles get 64-bit hashes.  The top bits choose one of REGISTERS buckets; a bucket stores, of the least
   remaining hash, the number of leading zeros (6 bits) and the MANTISSA bits after the first one.  Empty buckets are
   filled from other buckets by fixed probing (densification) for banding only.  BANDS keys of ROWS registers each result.
2. Equal sets (a 128-bit digest) are one class, stood for by its least doc_id; copies are never paired.
3. Classes that share a band key with others are put in one candidate cluster: each is linked to its bucket's least class
   and components are taken.  No pairs are made, and each class's text then travels once.
4. In a cluster pairs are taken in falling order of the collision-corrected Jaccard estimate of their registers, down to MARGIN
   standard errors below the threshold; a pair that verified links already connect is skipped, any other is verified on
   the full sets.  Only links of a spanning forest leave the task.
5. Clusters of over BLOCK classes, or SHINGLES shingles, are dealt into blocks, several times anew; then each class outside its cluster's largest
   component is held against the whole cluster, block by block: first by sketches alone, then texts are fetched for the classes that have a
   pair down to the margin, to the blocks that ask for them.  So every pair down to the margin is verified or connected, at any size.
6. Components of the verified links give the result.

Edge cases: null, empty or blank texts have no shingles, link with nothing and are kept; rows that repeat a doc_id with
different texts are distinct rows that share a node (ids are expected to be unique); a null doc_id is returned unlinked and kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Forest, components, cut, lookup, runs, sieve, text_or_empty, tune

REGISTERS, MANTISSA = 128, 10
BANDS, ROWS = 40, 6
MARGIN = 4.0
BLOCK = 1024
SHINGLES = 1 << 23  # of a block: their hashes take 64 MB
PASSES = 2
_SHIFT = np.uint64(57)
_REST = np.uint64((1 << 57) - 1)
_STARTS = np.arange(REGISTERS, dtype=np.uint64) << _SHIFT
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_rng = np.random.default_rng(20)
#: Buckets that an empty bucket is filled from, in order.
_PROBES = np.stack([_rng.permutation(REGISTERS) for _ in range(REGISTERS)])
#: The registers of each band; registers serve in several bands, never twice in one.
_BANDED = np.concatenate([_rng.permutation(REGISTERS)[: REGISTERS // ROWS * ROWS].reshape(-1, ROWS) for _ in range(-(-BANDS * ROWS // REGISTERS))])[:BANDS]
_SALT = (np.arange(1, BANDS * ROWS + 1, dtype=np.uint64).reshape(BANDS, ROWS) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Words:
    """64-bit word hashes with a bounded memory of recent words."""

    def __init__(self, most: int = 200_000):
        self.seen, self.most = {}, most

    def hashes(self, words: list[bytes]) -> np.ndarray:
        seen = self.seen
        if len(seen) > self.most:
            seen.clear()
        out = []
        for w in words:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int, words: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the document's set."""
    own = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and the six white-space bytes
    if not own:
        return np.zeros(0, np.uint64)
    h = words.hashes(own)
    n = min(width, len(own))
    made = np.full(len(own) - n + 1, n, np.uint64)
    for k in range(n):
        made = _scramble(made * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(made)


def registers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(registers, which buckets hold anything) of a sorted non-empty set."""
    at = np.searchsorted(hashes, _STARTS)
    first = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & ((first >> _SHIFT) == np.arange(REGISTERS, dtype=np.uint64))
    rest = (first & _REST) >> np.uint64(4)  # 53 bits: exact as a double
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.minimum(53 - exponent, 63)
    mantissa = ((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64).clip(0)
    return np.where(full, (zeros << MANTISSA) | mantissa, 0).astype(np.uint16), full


def band_keys(reg: np.ndarray, full: np.ndarray) -> np.ndarray:
    dense = reg
    if not full.all():
        source = _PROBES[np.arange(REGISTERS), full[_PROBES].argmax(axis=1)]
        source = np.where(full, np.arange(REGISTERS), source)
        dense = reg[source].astype(np.uint64) | (source.astype(np.uint64) << np.uint64(16))
    else:
        dense = reg.astype(np.uint64) | (np.arange(REGISTERS, dtype=np.uint64) << np.uint64(16))
    return _scramble((_scramble(dense)[_BANDED] * _SALT).sum(axis=1)).astype(np.int64)


def estimates(reg: np.ndarray, full: np.ndarray, size: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of row i against the rows after it, corrected for chance collisions, and their standard errors."""
    r, f, n = reg[i + 1 :], full[i + 1 :], size[i + 1 :]
    used = (f | full[i]).sum(axis=1)
    same = ((r == reg[i]) & f & full[i]).sum(axis=1)
    big, small = np.maximum(n, size[i]), np.minimum(n, size[i])
    d = small / big
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * d / (1 + d) ** 2
    j = np.clip((same / used - chance) / (1 - chance), 0, 1)
    return j, np.sqrt(0.16 / used)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified_forest(sets: list[np.ndarray], start: list[int], side: list[int] | None, percent: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect what verified pairs connect beyond `start` (component of each).  With `side`, only pairs across sides are looked at."""
    n = len(sets)
    forest = Forest(n)
    first: dict[int, int] = {}
    for i, c in enumerate(start):
        forest.join(i, first.setdefault(c, i))
    sketches = [registers(s) for s in sets]
    reg, full = np.stack([x[0] for x in sketches]), np.stack([x[1] for x in sketches])
    size = np.array([len(s) for s in sets])
    which = np.array(side) if side is not None else None
    found_i, found_j, found_e = [], [], []
    for i in range(n - 1):
        e, error = estimates(reg, full, size, i)
        ok = (e >= percent / 100 - MARGIN * error) & (100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i]))
        if which is not None:
            ok &= which[i + 1 :] != which[i]
        j = np.flatnonzero(ok)
        found_i.append(np.full(len(j), i, np.int32))
        found_j.append((j + i + 1).astype(np.int32))
        found_e.append(e[j].astype(np.float32))
    if not found_i:
        return []
    i, j, e = map(np.concatenate, (found_i, found_j, found_e))
    links = []
    for k in np.argsort(-e, kind="stable").tolist():
        a, b = int(i[k]), int(j[k])
        if forest.root(a) != forest.root(b) and alike(sets[a], sets[b], percent):
            forest.join(a, b)
            links.append((a, b))
    return links


def _sketch(width: int):
    def run(batches):
        words = Words()
        for batch in batches:
            n, digests, bands = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, width, words)
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(band_keys(*registers(s)) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "digest", "bands"])

    return run


SKETCHED = "rep long, reg binary, full binary, size long"


def _registers(width: int):
    """Sketches of (rep, text)."""

    def run(batches):
        words = Words()
        for batch in batches:
            sets = [shingles(t, width, words) for t in batch.column("text").to_pylist()]
            made = [registers(s) if len(s) else (np.zeros(REGISTERS, np.uint16), np.zeros(REGISTERS, bool)) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([r.tobytes() for r, _ in made], pa.binary()), pa.array([np.packbits(f).tobytes() for _, f in made], pa.binary()), pa.array([len(s) for s in sets], pa.int64())], names=["rep", "reg", "full", "size"])

    return run


def asked(reg: np.ndarray, full: np.ndarray, size: np.ndarray, component: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """Which rows have, on the other side, one of another component whose estimate reaches the margin."""
    out = np.zeros(len(size), bool)
    others = np.flatnonzero(side == 1)
    for i in np.flatnonzero(side == 0).tolist():
        at = np.concatenate([[i], others])
        e, error = estimates(reg[at], full[at], size[at], 0)
        n = size[others]
        ok = (e >= percent / 100 - MARGIN * error) & (100 * np.minimum(n, size[i]) >= percent * np.maximum(n, size[i])) & (component[others] != component[i])
        if ok.any():
            out[i] = True
            out[others[ok]] = True
    return out


def _ask(percent: int, keys: list[str]):
    def run(batches):
        for t in runs(batches, keys):
            if t.num_rows < 2:
                continue
            reg = np.frombuffer(b"".join(t["reg"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            full = np.unpackbits(np.frombuffer(b"".join(t["full"].to_pylist()), np.uint8)).astype(bool).reshape(-1, REGISTERS)
            found = asked(reg, full, t["size"].to_numpy(), t["component"].to_numpy(), t["side"].to_numpy(), percent)
            yield from t.select(["rep", "component", *keys, "side"]).filter(pa.array(found)).to_batches()

    return run


def _links(width: int, percent: int, keys: list[str]):
    def run(batches):
        words = Words()
        u, v = [], []
        for table in runs(batches, keys):
            if table.num_rows < 2:
                continue
            ids, start = table["rep"].to_pylist(), table["component"].to_pylist()
            if len(set(start)) < 2:
                continue
            sets = [shingles(t or "", width, words) for t in table["text"].to_pylist()]
            side = table["side"].to_pylist() if "side" in table.column_names else None
            for a, b in verified_forest(sets, start, side, percent):
                u.append(ids[a])
                v.append(ids[b])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _verified(members: DataFrame, keys: list[str], width: int, percent: int) -> DataFrame:
    dealt = members.repartition(*keys).sortWithinPartitions(*keys, "rep")
    return cut(dealt.mapInArrow(_links(width, percent, keys), "u long, v long"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable over links, itself included), kept (doc_id = component_id)."""
    spark = docs.sparkSession
    tune(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    sketch = cut(texts.mapInArrow(_sketch(width), "doc_id long, n_shingles long, digest binary, bands array<long>"))
    held = sketch.where("n_shingles > 0 and doc_id is not null")
    reps = held.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"), F.any_value("n_shingles").alias("shingles"))
    keyed = reps.select("rep", F.explode("bands").alias("key")).repartition("key")  # one exchange serves the aggregate and the join
    least = keyed.groupBy("key").agg(F.min("rep").alias("u"), F.max("rep").alias("last"), F.count("*").alias("n")).where("u < last").drop("last")
    stars = lookup(keyed, cut(least), "key").where("rep <> u").select(F.col("rep").alias("v"), "u")
    clusters = components(stars).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    clusters = cut(clusters.join(reps.groupBy("rep").agg(F.max("shingles").alias("shingles")), "rep"))
    # a block holds at most about `block` classes and SHINGLES shingles, so a few long texts fill one too
    sized = cut(clusters.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("shingles").alias("shingles")).select("cluster", "n", F.ceil(F.greatest(F.col("n") / block, F.col("shingles") / SHINGLES)).alias("blocks")))
    lean = cut(lookup(clusters.select("rep", "cluster"), sized, "cluster"))
    whole = sieve(clusters.select(F.col("rep").alias("id")))(texts.withColumnRenamed("doc_id", "rep"), "rep")  # other texts are not shuffled
    links = _verified(lean.select("rep", "cluster", F.pmod(F.xxhash64("rep", F.lit(0)), F.col("blocks")).alias("part"), F.col("rep").alias("component")).join(whole, "rep"), ["cluster", "part"], width, percent)
    if sized.where("blocks > 1").limit(1).count():
        lean = lean.where("blocks > 1")
        whole = cut(lean.select("rep").join(whole, "rep").select("rep", "text"))
        for k in range(1, PASSES + 1):
            state = lean.join(components(links).withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
            if k < PASSES:
                more = _verified(state.select("rep", "cluster", F.pmod(F.xxhash64("rep", F.lit(k)), F.col("blocks")).alias("part"), "component").join(whole, "rep"), ["cluster", "part"], width, percent)
            else:
                state = cut(state)
                sizes = state.groupBy("cluster", "component").agg(F.count("*").alias("m"))
                main = sizes.groupBy("cluster").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.max("m").alias("of_main"), F.sum("m").alias("of_cluster"), F.sum("m").alias("n"))
                state = lookup(state, cut(main), "cluster")  # the texts come later: a hot cluster's rows are lean here
                parts = (F.col("blocks") * 2).cast("int")
                rest = F.col("of_cluster") - F.col("of_main")
                state = state.withColumn("part", F.pmod(F.xxhash64("rep", F.lit(k)), parts).cast("int")).withColumn("parts", parts).withColumn("pieces", F.greatest(F.lit(1), F.ceil(parts * rest / F.col("of_cluster"))).cast("int"))
                sketches = cut(whole.mapInArrow(_registers(width), SKETCHED))
                own = state.where("of_main < of_cluster").select("rep", "cluster", "component", "part", "parts", "pieces", (F.col("component") != F.col("main")).alias("loose_one")).join(sketches, "rep")
                kept = ["rep", "cluster", "component", "reg", "full", "size"]
                one = own.where("loose_one").withColumn("loose", F.pmod(F.xxhash64("rep", F.lit(k + 1)), F.col("pieces")).cast("int")).select(*kept, "loose", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("side"))
                other = own.select(*kept, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("loose"), "part", F.lit(1).alias("side"))
                keys = ["cluster", "part", "loose"]
                dealt = one.unionByName(other).repartition(*keys).sortWithinPartitions(*keys, "rep")
                few = cut(dealt.mapInArrow(_ask(percent, keys), "rep long, component long, cluster long, part int, loose int, side int"))
                more = _verified(few.join(whole, "rep"), keys, width, percent)
            links = cut(links.unionByName(more))
    joined = components(links).select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
    classes = held.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).join(joined, "rep", "left").select("digest", "n", F.coalesce("component_id", "rep").alias("component_id"))
    # documents without words, or without an id, are their own component and take no part in the join
    found = lookup(held.select("doc_id", "n_shingles", "digest"), cut(classes), "digest").select("doc_id", "n_shingles", "component_id")
    found = found.unionByName(sketch.where("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates (that with the least doc_id), with the columns of `docs`; of rows that repeat an id, one."""
    names = [f"`{c}`" for c in docs.columns]
    found = cut(near_duplicates(docs, width, percent).where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"), F.max("kept").alias("kept")))
    # rows whose id is dropped or repeated are joined; the others, most of them, pass without a shuffle of their texts
    keep = sieve(found.where("not kept or rows > 1").select(F.col("doc_id").alias("id")))
    here = docs.where("doc_id is not null")
    alone = keep(here, "doc_id", among=False).select(*names)
    ids = found.where("kept").select(F.col("doc_id").alias("doc_id_of_kept"))  # unique; a semi-join would be pushed below the sieve, and shuffle all texts
    checked = keep(here, "doc_id").join(ids, F.col("doc_id") == F.col("doc_id_of_kept")).dropDuplicates(["doc_id"]).select(*names)
    return alone.unionByName(checked).unionByName(docs.where("doc_id is null").select(*names))
