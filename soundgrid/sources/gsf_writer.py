"""Survey logs written: records of the generic sensor format as bytes, and files of them in any store that Arrow's file systems open."""

from __future__ import annotations

import struct
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from soundgrid.ship import ship
from soundgrid.sources.gsf import _HEADER, _HEADER_SIZE, SCALES

WIDTHS = {1: (2, "H"), 2: (2, "h"), 3: (2, "h"), 16: (1, "B")}  # depth, across, along, beam flags, as they are written here


def record(kind: int, body: bytes, summed: bool = False) -> bytes:
    """A record with its header, a zero checksum if wanted, and padding to four bytes."""
    body = bytes(4 if summed else 0) + body
    return struct.pack(">II", len(body), kind | summed << 31) + body + bytes(-len(body) % 4)


def text(value: str) -> bytes:
    data = value.encode()
    return struct.pack(">h", len(data)) + data


def ping_body(seconds: int, nanoseconds: int, longitude: int, latitude: int, heading: int, flags: int, arrays: dict[int, list[int]], scales: dict[int, tuple[int, int]] | None = None) -> bytes:
    """A ping's payload; positions in 1e-7 degrees, heading in hundredths, arrays as raw integers by their id."""
    n = len(next(iter(arrays.values()))) if arrays else 0
    out = _HEADER.pack(seconds, nanoseconds, longitude, latitude, n, 0, flags, 0, 0, 0, heading, 0, 0, 0, 0, 0, 0, 0, 0).ljust(_HEADER_SIZE, b"\0")
    if scales:
        body = struct.pack(">i", len(scales)) + b"".join(struct.pack(">Iii", k << 24, *v) for k, v in scales.items())
        out += struct.pack(">I", SCALES << 24 | len(body)) + body
    for k, raw in arrays.items():
        width, letter = WIDTHS[k]
        out += struct.pack(f">I{n}{letter}", k << 24 | width * n, *raw)
    return out


def attitude_body(seconds: int, rows: Iterable[tuple[int, int, int, int, int]]) -> bytes:
    rows = list(rows)
    return struct.pack(">iih", seconds, 0, len(rows)) + b"".join(struct.pack(">hhhhh", *r) for r in rows)


def profile_body(observed: int, applied: int, longitude: int, latitude: int, layers: Iterable[tuple[int, int]]) -> bytes:
    layers = list(layers)
    return struct.pack(">IIIIiiI", observed, 0, applied, 0, longitude, latitude, len(layers)) + b"".join(struct.pack(">II", *x) for x in layers)


def parameters_body(seconds: int, parameters: dict[str, str]) -> bytes:
    return struct.pack(">iih", seconds, 0, len(parameters)) + b"".join(text(f"{k}={v}") for k, v in parameters.items())


def comment_body(seconds: int, comment: str) -> bytes:
    return struct.pack(">iii", seconds, 0, len(comment.encode())) + comment.encode() + b"\0"


def history_body(seconds: int, *texts: str) -> bytes:
    """Texts: machine, operator, command, comment."""
    return struct.pack(">ii", seconds, 0) + b"".join(map(text, texts))


def summary_body(first: int, last: int, low: tuple[int, int, int], high: tuple[int, int, int]) -> bytes:
    """Corners (longitude, latitude in 1e-7 degrees, depth in centimetres)."""
    return struct.pack(">10i", first, 0, last, 0, low[1], low[0], high[1], high[0], low[2], high[2])


def write_logs(spark: SparkSession, files: DataFrame, folder: str) -> str:
    """Files (name, content) under `folder`; a task writes those of its rows, and a repeated task writes the same again."""
    ship(spark)

    def run(frames):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri("file://" + folder.removeprefix("file:").removeprefix("//") if folder.startswith(("/", "file:")) else folder)
        system.create_dir(base, recursive=True)
        for pdf in frames:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write(content)
            yield pd.DataFrame({"name": pdf["name"]})

    files.select("name", "content").mapInPandas(run, "name string").count()
    return folder
