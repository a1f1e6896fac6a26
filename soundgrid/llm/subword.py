"""Averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent in numpy.

A text's features are the byte 3-, 4- and 5-grams of its whole normalised UTF-8 form, hashed into BUCKETS.  Its vector is the
mean of the features' embeddings.  The softmax is linear, so the trained embeddings and weights fold into one table of a
score per bucket and class, and a prediction is the mean of the table's rows.

Confidence says nothing of a text that is like no training text, so rejection has a signal of its own: the share of a text's 4-grams
that at least `SEEN_IN` training texts hold.  Its bound lies halfway between what held-out texts of the learned classes reach (all but
`false_rejections` of them) and what nine in ten texts stay below whose class was left out.  A short text is rejected only if its share is surely below it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
PART = 1 << 18  # bytes of a text taken at once
SCALE = 64.0  # of the averaged vector, so that its coordinates are near 1
KNOWN_BITS = 20  # a bitmap of 2**20 hashed 4-grams, 128 KiB
SEEN_IN = 3  # texts that hold a 4-gram before it counts as known
SURE = 2.0  # standard errors; neighbouring 4-grams overlap, so four count as one
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[:128] = [ord(chr(i).lower()) if chr(i).isalpha() else 48 if chr(i).isdigit() else 32 for i in range(128)]
_GOLD = 0x9E3779B97F4A7C15


def folded(text: str) -> np.ndarray:
    """Bytes with letters in lower case, digits alike and every stretch of other ASCII as one space, which also stands at both ends."""
    data = np.frombuffer(b" " + text.encode("utf-8", "surrogatepass") + b" ", np.uint8)
    parts, last = [], 0
    for a in range(0, len(data), PART):
        p = _FOLD[data[a : a + PART]].astype(np.uint8)
        blank = p == 32
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        keep[0] |= last != 32
        last = p[-1]
        parts.append(p[keep])
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def grams(text: str):
    """(n, arrays of packed n-grams), for one part of the text after another; parts overlap so that no n-gram is lost."""
    data = folded(text)
    for a in range(0, len(data), PART):
        p = data[a : a + PART + max(SIZES) - 1].astype(np.uint64)
        packed, shift = p, np.uint64(8)
        for n in range(2, max(SIZES) + 1):
            packed = (packed[:-1] << shift) | p[n - 1 :]
            if n in SIZES:
                yield n, packed[:PART]


def buckets(n: int, packed: np.ndarray) -> np.ndarray:
    return ((packed * np.uint64(_GOLD + 2 * n)) >> np.uint64(50)).astype(np.int32)


def places(packed: np.ndarray) -> np.ndarray:
    """Places of 4-grams in the bitmap of known ones."""
    return ((packed * np.uint64(_GOLD)) >> np.uint64(64 - KNOWN_BITS)).astype(np.int32)


def counts(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS)
    for n, packed in grams(text):
        total += np.bincount(buckets(n, packed), minlength=BUCKETS)
    return total


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    classes: list[str]
    table: np.ndarray  # buckets x classes
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    prior: np.ndarray | None = None
    known: np.ndarray | None = None  # packed bits of known 4-grams
    least_known: float = 0.0

    def read(self, text: str | None) -> tuple[np.ndarray, int, int]:
        """(calibrated class probabilities, known 4-grams, all 4-grams); the training shares where the text has no n-gram."""
        total, n, hits, of = np.zeros(len(self.classes)), 0, 0, 0
        if text:
            for size, packed in grams(text):
                ids = buckets(size, packed)
                total += self.table[ids].sum(axis=0, dtype=np.float64)
                n += len(ids)
                if size == 4 and self.known is not None:
                    at = places(packed)
                    hits += int(((self.known[at >> 3] >> (at & 7).astype(np.uint8)) & 1).sum())
                    of += len(at)
        return (softmax((total / n + self.bias) / self.temperature) if n else self.prior.copy()), hits, of

    def posterior(self, text: str | None) -> np.ndarray:
        return self.read(text)[0]

    def foreign(self, hits: int, of: int) -> bool:
        """Whether so few 4-grams are known that the text is of no learned class."""
        if not of or not self.least_known:
            return False
        share = hits / of
        return share + SURE * np.sqrt(max(share * (1 - share), 1 / of) * 4 / of) < self.least_known


def _learn_known(texts: list[str], y: np.ndarray, held: np.ndarray, own: np.ndarray, false_rejections: float) -> tuple[np.ndarray, float]:
    """(bitmap, bound): 4-grams of the texts `own`, by what the texts `held` reach with them and without those of their own class."""
    of_class = {c: np.zeros(1 << KNOWN_BITS, np.uint16) for c in set(y.tolist())}
    drawn = [np.unique(np.concatenate([places(p) for n, p in grams(t) if n == 4] or [np.zeros(0, np.int32)])) for t in texts]
    for k in own:
        of_class[int(y[k])][drawn[k]] += 1
    total = sum(of_class.values())
    seen_in = min(SEEN_IN, max(1, len(own) // 100))
    known = total >= seen_in
    packed = np.packbits(known, bitorder="little")
    within, without = [], []
    for k in held:
        at = np.concatenate([places(p) for n, p in grams(texts[k]) if n == 4] or [np.zeros(0, np.int32)])
        if len(at) >= 100:  # shares of short texts say little
            within.append(known[at].mean())
            without.append((total[at] - of_class[int(y[k])][at] >= seen_in).mean())
    if len(within) < 20:
        return packed, 0.0
    low = np.quantile(without, 0.9) if len(of_class) > 1 else 0.0
    high = np.quantile(within, false_rejections)
    return packed, float((low + high) / 2 if low < high else high / 2)


def train(texts: list[str], labels: list[str], size: int = 16, epochs: int = 40, batch: int = 32, rate: float = 0.5, seed: int = 7, holdout: float = 0.25, false_rejections: float = 0.001) -> Model:
    """Fit on bounded data held by the caller.  A part is held out to set the temperature and the rejection bounds."""
    classes = sorted(set(labels))
    index = {c: i for i, c in enumerate(classes)}
    y = np.array([index[c] for c in labels], dtype=np.int64)
    prior = np.bincount(y, minlength=len(classes)) / max(1, len(y))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    held = order[: int(len(y) * holdout)]
    own = order[len(held) :]
    known, least_known = _learn_known(texts, y, held, own, false_rejections) if len(y) else (None, 0.0)
    if len(classes) < 2:
        k = len(classes)
        return Model(classes, np.zeros((BUCKETS, k), np.float32), np.zeros(k), prior=prior, known=known, least_known=least_known)
    x = np.empty((len(texts), BUCKETS), np.float32)  # the driver holds this one table
    for k, t in enumerate(texts):
        n_grams = counts(t)
        x[k] = n_grams * (SCALE / max(n_grams.sum(), 1))
    e = rng.normal(0, 1 / size, (BUCKETS, size)).astype(np.float32)
    w = np.zeros((size, len(classes)), np.float32)
    b = np.zeros(len(classes), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        rng.shuffle(own)
        for a in range(0, len(own), batch):
            rows = own[a : a + batch]
            h = x[rows] @ e
            g = softmax(h @ w + b)
            g[np.arange(len(rows)), y[rows]] -= 1
            g /= len(rows)
            back = g @ w.T
            w -= step * (h.T @ g)
            b -= step * g.sum(axis=0)
            e -= step * (x[rows].T @ back)
    table = (e @ w) * SCALE
    model = Model(classes, table.astype(np.float32), b.astype(np.float64), prior=prior, known=known, least_known=least_known)
    if len(held) >= 20:
        z = np.stack([x[k] @ table for k in held]).astype(np.float64) / SCALE + b
        fits = [(-np.mean(np.log(softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12)), t) for t in np.geomspace(0.5, 20, 60)]
        model.temperature = float(min(fits)[1])
        sure = softmax(z / model.temperature).max(axis=1)
        model.reject_below = float(min(1.5 / len(classes), np.quantile(sure, false_rejections)))
    return model
