"""Bounded-space online packing of documents' token ids into sequences of at most WINDOW ids.

Each partition keeps at most OPEN windows.  A document's whole windows are emitted at once and its rest is placed best-fit (the
window that it leaves least room in).  When none fits and OPEN are open, the fullest is topped up with the head of the piece,
emitted full, and the rest is placed anew.  At a partition's end the open windows are left over; the leftovers of GROUP
partitions are merged end to end into full windows, and what remains of a group is cut into sequences whose lengths are powers of two
(not padded).  So no sequence holds padding.

Edge cases: a null or empty text is the end id alone; very long texts are cut into whole windows as they come; an empty table gives
no pieces; repeated rows are packed each; offsets in a sequence are gapless from 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import cut, text_or_empty, tune
from .tokens import VOCABULARY, encoder, ids_of

WINDOW = 2048
OPEN = 16
GROUP = 64
END = 1
FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64()), ("left", pa.binary())]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, left binary"


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, FIELDS, strict=True)], names=[n for n, _ in FIELDS])


class Packer:
    """Pieces are (doc_id, start, ids, doc_tokens); a window is [pieces, length]."""

    def __init__(self, window: int = WINDOW, most: int = OPEN):
        self.window, self.most, self.open, self.full = window, most, [], []

    def add(self, doc_id, ids, total, start=0) -> None:
        while len(ids) - start >= self.window:
            self.full.append([(doc_id, start, ids[start : start + self.window], total)])
            start += self.window
        while start < len(ids):
            need = len(ids) - start
            fits = [w for w in self.open if w[1] + need <= self.window]
            if fits:
                best = max(fits, key=lambda w: w[1])
            elif len(self.open) < self.most:
                best = [[], 0]
                self.open.append(best)
            else:
                best = max(self.open, key=lambda w: w[1])
                need = self.window - best[1]
            best[0].append((doc_id, start, ids[start : start + need], total))
            best[1] += need
            start += need
            if best[1] == self.window:
                self.open = [w for w in self.open if w is not best]
                self.full.append(best[0])


def _rows(pieces, sequence, part, keep):
    at = 0
    for doc_id, start, ids, total in pieces:
        data = ids.astype("<u4").tobytes()
        yield doc_id, start, len(ids), zlib.crc32(data), total, sequence, at, part, data if keep else None
        at += len(ids)


def _pack(path: str, window: int, most: int, end: int | None):
    def run(batches):
        enc, packer = encoder(path), Packer(window, most)
        part = TaskContext.get().partitionId()
        sequence = part << 32
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = ids_of(text, enc, end)
                packer.add(doc_id, ids, len(ids))
                for pieces in packer.full:
                    rows += _rows(pieces, sequence, part, False)
                    sequence += 1
                packer.full = []
            yield batch_of(rows)
        rows = []
        for pieces, _ in packer.open:
            rows += _rows(pieces, sequence, part, True)
            sequence += 1
        yield batch_of(rows)

    return run


def _merge(window: int):
    def run(batches):
        group, packer, sequence = None, None, 0

        def close():
            nonlocal sequence
            for pieces, size in packer.open:  # at most one: cut to powers of two
                sizes = [1 << b for b in range(window.bit_length(), -1, -1) if size >> b & 1]
                small = Packer(window)
                pieces = list(pieces)
                for n in sizes:
                    own, room = [], n
                    while room:
                        doc_id, start, ids, total = pieces.pop(0)
                        if len(ids) > room:
                            pieces.insert(0, (doc_id, start + room, ids[room:], total))
                            ids = ids[:room]
                        own.append((doc_id, start, ids, total))
                        room -= len(ids)
                    small.full.append(own)
                packer.full += small.full
            rows = []
            for pieces in packer.full:
                rows += _rows(pieces, sequence, group, False)
                sequence += 1
            return batch_of(rows)

        for batch in batches:
            for r in batch.to_pylist():
                if r["group"] != group:
                    if group is not None:
                        yield close()
                    group, packer, sequence = r["group"], Packer(window, 1), (1 << 62) + (r["group"] << 32)
                ids = np.frombuffer(r["left"], "<u4")
                start = 0
                while start < len(ids):  # end to end: the one open window is topped up, then the rest follows
                    room = window - packer.open[0][1] if packer.open else window
                    piece = ids[start : start + room]
                    for_packer = (r["doc_id"], r["start"] + start, piece, r["doc_tokens"])
                    if not packer.open:
                        packer.open = [[[], 0]]
                    packer.open[0][0].append(for_packer)
                    packer.open[0][1] += len(piece)
                    if packer.open[0][1] == window:
                        packer.full.append(packer.open.pop()[0])
                    start += len(piece)
        if group is not None:
            yield close()

    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, most: int = OPEN, end: int | None = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if window & (window - 1):
        raise ValueError("the window is a power of two")
    tune(docs.sparkSession)
    lean = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    placed = cut(lean.mapInArrow(_pack(path or public_tokenizers.path(VOCABULARY), window, most, end), SCHEMA))
    left = placed.where("left is not null").withColumn("group", F.floor(F.col("part") / GROUP).cast("long"))
    dealt = left.repartition("group").sortWithinPartitions("group", "sequence_id", "offset")
    merged = dealt.mapInArrow(_merge(window), SCHEMA)
    return placed.where("left is null").unionByName(merged).drop("part", "left")
