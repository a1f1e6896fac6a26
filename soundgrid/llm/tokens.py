"""Byte-level BPE ids from a public vocabulary file, and token counts that follow edits.

Ids come from the vocabulary of a `tokenizers` JSON file (a parameter, read where a task runs and never copied).  Its merges are
in rank order, so the faster encoder over the same ranks gives the same ids; texts that hold a special token's string, or a run of
white space that the faster encoder's pattern fails on, go through `tokenizers` itself.

EditedText keeps a document's pre-tokens in leaves of about LEAF and a segment tree of (characters, tokens) over them.  An
edit re-encodes the leaves it touches with boundary context (the leaves before, as long as a special token; the leaves after, likewise), goes on
until a new pre-token ends where an old leaf ended (from there on the text is encoded as before), and updates the sums on the leaves'
paths.  A leaf of over twice LEAF pre-tokens is split, so what a later edit encodes is bounded by a few leaves and the pre-tokens it touches, after any history.

The tree is a column: arrays of the leaves' characters, tokens and pre-tokens (the sums over them follow).  `count_trees` makes it from a text,
`edit_trees` starts from a text and its tree, encodes only around its edits and returns both as they are after them, so edits may come in any number of batches.

Edge cases: a null or empty text has 0 tokens and one empty leaf; edits outside the text are clipped to it; null edits are none;
an edit's `start` after its `stop` inserts at `start`; a row whose tree is null or does not fit its text gets a new one.  Strings of special tokens are the one
token that `tokenizers` and the packing operator take them for, also where an edit makes or breaks one.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .base import text_or_empty, tune

VOCABULARY = "byte_bpe_50k.json"
LEAF = 64
BLANK = 100_000  # white space in a row that is left to `tokenizers`; the faster encoder fails on about a million
_BLANKS = regex.compile(rf"\s{{{BLANK}}}")


def byte_of_letter() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes as: printable ones stand for themselves, the rest are numbered from 256."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.special = [x["content"] for x in made.get("added_tokens", [])]
        letters = byte_of_letter()
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in made["model"]["vocab"].items() if t not in self.special}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.exact = path, None
        self.split = regex.compile(public_tokenizers.PATTERN)
        self.reach = max(map(len, self.special), default=0)
        self.specials = regex.compile("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.sizes: dict[str, int] = {}

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or (len(text) >= BLANK and _BLANKS.search(text)):
            self.exact = self.exact or Tokenizer.from_file(self.path)
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def pieces(self, text: str) -> Iterator[str]:
        """Pre-tokens; a special token's string is one of its own, and what it parts is split by itself."""
        at = 0
        for m in self.specials.finditer(text) if self.specials and any(x in text for x in self.special) else ():
            yield from (x[0] for x in self.split.finditer(text, at, m.start()))
            yield m[0]
            at = m.end()
        yield from (x[0] for x in self.split.finditer(text, at))

    def sizes_of(self, pieces: list[str]) -> list[int]:
        known, out = self.sizes, []
        if len(known) > 300_000:
            known.clear()
        for p in pieces:
            n = known.get(p)
            if n is None:
                n = 1 if p in self.special else len(self.ids(p) if len(p) >= BLANK else self.fast.encode_ordinary(p))
                if len(p) <= 64:
                    known[p] = n
            out.append(n)
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class EditedText:
    """A text, its token count and the segment tree that keeps it current.  `tree`: (characters, tokens, pre-tokens) by leaf, as `leaf_sums` gives them."""

    def __init__(self, text: str, enc: Encoder, tree: tuple[list[int], list[int], list[int]] | None = None):
        self.enc = enc
        self.encoded = 0  # characters encoded again by edits
        if tree is None or sum(tree[0]) != len(text):
            pieces = list(enc.pieces(text))
            sizes = enc.sizes_of(pieces)
            self.leaves, tokens, self.n_pieces = self._cut(pieces, sizes) or ([""], [0], [0])
        else:
            ends = list(itertools.accumulate(tree[0]))
            self.leaves = [text[b - n : b] for n, b in zip(tree[0], ends, strict=True)] or [""]
            tokens, self.n_pieces = list(tree[1]) or [0], list(tree[2]) or [0]
        self._build(tokens)

    @staticmethod
    def _cut(pieces: list[str], sizes: list[int]) -> tuple[list[str], list[int], list[int]] | None:
        """Leaves of LEAF pre-tokens, their tokens and their pre-tokens."""
        starts = range(0, len(pieces), LEAF)
        return (["".join(pieces[a : a + LEAF]) for a in starts], [sum(sizes[a : a + LEAF]) for a in starts], [len(pieces[a : a + LEAF]) for a in starts]) if pieces else None

    def _build(self, tokens: list[int]) -> None:
        self.width = w = 1 << (len(self.leaves) - 1).bit_length()
        fill = [0] * (w - len(self.leaves))
        self.chars, self.tokens = [0] * w + [len(x) for x in self.leaves] + fill, [0] * w + tokens + fill
        for k in range(w - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def count(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    @property
    def leaf_sums(self) -> tuple[list[int], list[int], list[int]]:
        n = len(self.leaves)
        return self.chars[self.width : self.width + n], self.tokens[self.width : self.width + n], self.n_pieces

    def _leaf(self, at: int) -> tuple[int, int]:
        """(leaf, its first character) that holds the character `at`, or the last leaf."""
        k, before = 1, 0
        while k < self.width:
            k *= 2
            if at >= before + self.chars[k] and self.chars[k + 1]:
                before += self.chars[k]
                k += 1
        return min(k - self.width, len(self.leaves) - 1), before

    def _ahead(self, leaf: int) -> tuple[int, str]:
        """(last leaf, text) of what follows a leaf, as long as a special token at least."""
        parts, size = [], 0
        while leaf + 1 < len(self.leaves) and size <= self.enc.reach:
            leaf += 1
            parts.append(self.leaves[leaf])
            size += len(self.leaves[leaf])
        return leaf, "".join(parts)

    def edit(self, start: int, stop: int, put: str) -> int:
        """Replace characters start..stop by `put`; the new token count."""
        start = max(0, min(start, self.chars[1]))
        stop = max(start, min(stop, self.chars[1]))
        a, first = self._leaf(start)
        while a and start - first < max(LEAF // 2, self.enc.reach):  # boundary context before the edit: leaves may have become short
            a -= 1
            first -= len(self.leaves[a])
        b, last = self._leaf(max(start, stop - 1))
        last += len(self.leaves[b])
        region = "".join(self.leaves[a : b + 1])
        region = region[: start - first] + put + region[stop - first :]
        while True:
            ahead, look = self._ahead(b)
            pieces, size = [], 0
            for p in self.enc.pieces(region + look):
                if size >= len(region):
                    break
                pieces.append(p)
                size += len(p)
            self.encoded += size
            if size == len(region) or not look:
                break
            b, region = ahead, region + look
        sizes = self.enc.sizes_of(pieces)
        slots = b - a + 1
        if len(pieces) > 2 * LEAF * slots:  # leaves are split: the tree gets more of them
            tokens = self.leaf_sums[1]
            leaves, own, n = self._cut(pieces, sizes)
            self.leaves[a : b + 1], tokens[a : b + 1], self.n_pieces[a : b + 1] = leaves, own, n
            self._build(tokens)
            return self.count
        per = max(1, -(-len(pieces) // slots))
        for k in range(slots):
            at = slice(k * per, (k + 1) * per)
            self.leaves[a + k] = "".join(pieces[at])
            self.n_pieces[a + k] = len(pieces[at])
            self.chars[self.width + a + k] = len(self.leaves[a + k])
            self.tokens[self.width + a + k] = sum(sizes[at])
        dirty = {(self.width + k) // 2 for k in range(a, b + 1)}
        while dirty and max(dirty) >= 1:
            for k in dirty:
                self._sum(k)
            dirty = {k // 2 for k in dirty if k > 1}
        return self.count


EDITS = "array<struct<start:int,stop:int,put:string>>"
TREE = "leaf_chars array<int>, leaf_tokens array<int>, leaf_pieces array<int>"
COUNTED = f"doc_id long, text string, edits {EDITS}, n_tokens long, {TREE}"
EDITED = f"doc_id long, text string, n_tokens long, n_edits int, n_tokens_after long, n_chars_after long, n_chars_encoded_again long, crc32_after long, {TREE}"
_INTS, _LONG = pa.list_(pa.int32()), pa.int64()
_EDITS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("put", pa.string())]))
_COUNTED = pa.schema([("doc_id", _LONG), ("text", pa.string()), ("edits", _EDITS), ("n_tokens", _LONG), ("leaf_chars", _INTS), ("leaf_tokens", _INTS), ("leaf_pieces", _INTS)])
_EDITED = pa.schema([("doc_id", _LONG), ("text", pa.string()), ("n_tokens", _LONG), ("n_edits", pa.int32()), *((n, _LONG) for n in ("n_tokens_after", "n_chars_after", "n_chars_encoded_again", "crc32_after")), ("leaf_chars", _INTS), ("leaf_tokens", _INTS), ("leaf_pieces", _INTS)])


def _each(row, schema: pa.Schema, path: str):
    def run(batches):
        enc = encoder(path)
        for batch in batches:
            rows = [row(enc, *r) for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _count(enc, doc_id, text, edits):
    t = EditedText(text, enc)
    return doc_id, text, edits, t.count, *t.leaf_sums


def _edit(keep_text: bool):
    def row(enc, doc_id, text, edits, n_tokens, *tree):
        t = EditedText(text, enc, None if None in tree else tree)
        before = t.count
        for e in edits or []:
            t.edit(e["start"] or 0, e["stop"] or 0, e["put"] or "")
        after = t.text
        return doc_id, after if keep_text else None, before, len(edits or []), t.count, len(after), t.encoded, zlib.crc32(after.encode("utf-8", "surrogatepass")), *t.leaf_sums

    return row


def _lean(rows: DataFrame, edits: str | None):
    tune(rows.sparkSession)
    return F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"), (F.col(edits) if edits else F.lit(None)).cast(EDITS).alias("edits")


def count_trees(docs: DataFrame, edits: str | None = None, path: str | None = None) -> DataFrame:
    """doc_id, text, edits, n_tokens and the tree's columns of every text, encoded whole."""
    return docs.select(*_lean(docs, edits)).mapInArrow(_each(_count, _COUNTED, path or public_tokenizers.path(VOCABULARY)), COUNTED)


def edit_trees(counted: DataFrame, edits: str = "edits", path: str | None = None, keep_text: bool = True) -> DataFrame:
    """Rows of `count_trees` or of this function after their edits (applied in order; each position is in the text as edited so far): text, counts before and after, tree."""
    rows = counted.select(*_lean(counted, edits), F.col("n_tokens"), *(F.col(c.split()[0]) for c in TREE.split(", ")))
    return rows.mapInArrow(_each(_edit(keep_text), _EDITED, path or public_tokenizers.path(VOCABULARY)), EDITED)


def edited_counts(docs: DataFrame, edits: str = "edits", path: str | None = None) -> DataFrame:
    """Token counts of every text before and after its edits, and the tree after them."""
    return edit_trees(count_trees(docs, edits, path), "edits", path, keep_text=False).drop("text")


def ids_of(text: str, enc: Encoder, end: int | None) -> np.ndarray:
    ids = enc.ids(text) if text else []
    return np.array(ids if end is None else [*ids, end], dtype="<u4")
