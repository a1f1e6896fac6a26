"""Media columns: WAV payloads, short-time spectra and spectral-peak pair fingerprints.

A media column is a binary column that holds a whole WAV file.  `encode_wav` makes it of bytes as 8-bit mono samples (the format's
unsigned unit, so it is lossless), `store_media` writes it as a table in the shared folder, and `describe_wav` reads a stored file back
with the wave module and computes its features.  A fingerprint is two arrays: the frame of each pair's first peak (sorted), and the pair's code,
which packs both bins and the frames between them; so pairs are looked up by code and aligned by time.

Edge cases: null text is an empty one; the payload is padded with zero bytes to a positive multiple of 64, so an empty
text gives 64 zero samples.  A null media value gives nulls.  Long signals are transformed in blocks of frames with a
frame of context at each side, so memory does not grow with the spectrogram.  Repeated texts give equal values.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import scratch, text_or_empty, tune

UNIT = 64
RATE = 8000
FRAME, HOP = 256, 128
PEAKS = 2  # peaks kept in a frame
FAN = 3  # partners of an anchor
REACH = 32  # frames between the two peaks of a pair
BLOCK = 2048  # frames transformed at once
WINDOW = np.hanning(FRAME).astype(np.float32)

DESCRIPTION = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pair_times array<int>, pair_codes array<long>"


def pad(data: bytes) -> bytes:
    return data + bytes(-len(data) % UNIT if data else UNIT)


def wav_bytes(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def wav_payload(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        if (r.getnchannels(), r.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono samples are expected")
        return r.readframes(r.getnframes())


def peaks(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of the spectral peaks: local maxima over frequency that neither neighbouring frame exceeds."""
    raw = np.frombuffer(payload, np.uint8)
    n = 1 + max(0, -(-(len(raw) - FRAME) // HOP))
    times, bins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, n, BLOCK):
        lo, hi = max(0, a - 1), min(n, a + BLOCK + 1)
        part = raw[lo * HOP : (hi - 1) * HOP + FRAME].astype(np.float32) - 128
        part = np.pad(part, (0, (hi - lo - 1) * HOP + FRAME - len(part)))
        frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP]
        m = np.abs(np.fft.rfft(frames * WINDOW, axis=1))
        inner = m[:, 1:-1]
        top = (inner > m[:, :-2]) & (inner >= m[:, 2:])
        top[1:] &= inner[1:] >= inner[:-1]
        top[:-1] &= inner[:-1] >= inner[1:]
        own = np.where(top, inner, 0)[a - lo : a - lo + min(BLOCK, n - a)]
        best = np.argpartition(own, -PEAKS, axis=1)[:, -PEAKS:]
        there = np.take_along_axis(own, best, 1) > 0
        t = np.broadcast_to(np.arange(a, a + len(own))[:, None], best.shape)[there]
        f = best[there] + 1
        order = np.lexsort((f, t))
        times.append(t[order])
        bins.append(f[order])
    return np.concatenate(times), np.concatenate(bins)


def pairs(t: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Time-coded pairs: the anchor's frame, and both bins with the distance packed into one code."""
    at, codes = [], []
    for k in range(1, FAN + 1):
        dt = t[k:] - t[:-k]
        ok = dt <= REACH
        at.append(t[:-k][ok])
        codes.append(((f[:-k] << 20) | (f[k:] << 8) | dt)[ok])
    at, codes = np.concatenate(at), np.concatenate(codes)
    order = np.lexsort((codes, at))
    return at[order].astype(np.int32), codes[order].astype(np.int64)


def describe(media: bytes) -> tuple:
    payload = wav_payload(media)
    t, f = peaks(payload)
    at, codes = pairs(t, f)
    digest = hashlib.sha256(at.astype("<i4").tobytes() + codes.astype("<i8").tobytes()).hexdigest()[:32]
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), f"{len(t)}:{len(at)}:{digest}", at, codes


def _encode(text: pd.Series) -> pd.Series:
    return pd.Series([wav_bytes(pad((x or "").encode("utf-8", "surrogatepass"))) for x in text], dtype=object)


def _describe(media: pd.Series) -> pd.DataFrame:
    names = [x.split()[0] for x in DESCRIPTION.split(", ")]
    return pd.DataFrame([(None,) * len(names) if x is None else describe(bytes(x)) for x in media], columns=names, dtype=object)


def encode_wav(text: str | Column) -> Column:
    """Binary column: the text's UTF-8 bytes as a WAV file."""
    return F.pandas_udf(_encode, "binary")(text_or_empty(text))


def describe_wav(media: str | Column) -> Column:
    """Struct column read back from stored WAV files (see DESCRIPTION)."""
    return F.pandas_udf(_describe, DESCRIPTION)(media)


def store_media(docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Writes (key, n_bytes, media) under `folder` and returns it as read back."""
    tune(docs.sparkSession)
    made = docs.select(F.col(key), F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"), encode_wav(text).alias("media"))
    made.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def media_features(docs: DataFrame, text: str = "text", key: str = "doc_id", folder: str | None = None) -> DataFrame:
    """One row per document: digests of the media as stored, its fingerprint's digest and both its arrays."""
    folder = folder or scratch(docs.sparkSession, "media")
    stored = store_media(docs, folder, text, key)
    return stored.select(key, "n_bytes", describe_wav("media").alias("d")).select(key, "n_bytes", "d.*")
