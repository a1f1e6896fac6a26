"""Binary survey logs (generic sensor format) as DataFrames.

A log is a run of records: size, id (bit 31: a checksum precedes the payload), payload, padding to four bytes, all big-endian.  Logs are read in two ways.

`read_*` functions with a path plan first: `plan` reads the headers of each file's records, not their payloads, and gives byte ranges (of pings: `step` at a
time, with the scale factors in force before them).  Ranges are dealt over the cluster, so a file of any size is decoded by many tasks, each of which
holds one range.  This needs a store that Arrow's file systems open by range (local, HDFS, S3, GCS).

`decode` and `index_of` take a table (path, content), as Spark's `binaryFile` or any other source gives it; a task then holds a whole file.
"""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.functions.text import parameter_value
from soundgrid.operators.navigation import beam_positions, centre_of_arrays
from soundgrid.schema import SOUNDINGS, coerce_soundings
from soundgrid.shared import cut
from soundgrid.ship import ship

# fixed values: record ids, and beam arrays by id with their sign
RECORDS = {1: "GSF_HEADER", 2: "GSF_SWATH_BATHYMETRY_PING", 3: "GSF_SOUND_VELOCITY_PROFILE", 4: "GSF_PROCESSING_PARAMETERS", 5: "GSF_SENSOR_PARAMETERS", 6: "GSF_COMMENT", 7: "GSF_HISTORY", 8: "GSF_NAVIGATION_ERROR", 9: "GSF_SWATH_BATHY_SUMMARY", 10: "GSF_SINGLE_BEAM_PING", 11: "GSF_HV_NAVIGATION_ERROR", 12: "GSF_ATTITUDE"}
ARRAYS = {1: ("Z", "u"), 2: ("across_track", "i"), 3: ("along_track", "i"), 4: ("travel_time", "u"), 5: ("beam_angle", "i"), 6: ("mean_cal_amplitude", "i"), 7: ("mean_rel_amplitude", "i"), 8: ("echo_width", "u"), 9: ("quality_factor", "u"), 10: ("receive_heave", "i"), 11: ("depth_error", "u"), 12: ("across_track_error", "u"), 13: ("along_track_error", "u"), 14: ("nominal_depth", "u"), 15: ("quality_flags", "u"), 16: ("beam_flags", "u"), 17: ("signal_to_noise", "i"), 18: ("beam_angle_forward", "u"), 19: ("vertical_error", "u"), 20: ("horizontal_error", "u"), 22: ("sector_number", "i"), 23: ("detection_info", "i"), 24: ("incident_beam_adj", "i"), 25: ("system_cleaning", "i"), 26: ("doppler_correction", "i"), 27: ("sonar_vert_uncertainty", "i"), 28: ("sonar_horz_uncertainty", "i"), 29: ("detection_window", "i"), 30: ("mean_abs_coef", "i")}
SCALES, SERIES = 100, 21
_HEADER = struct.Struct(">iiiihhhhhiHhhhHHiii")
_HEADER_SIZE = 56
_NAMES = ("seconds", "nanoseconds", "longitude", "latitude", "num_beams", "centre_beam", "ping_flags", "reserved", "tide_corrector", "depth_corrector", "heading", "pitch", "roll", "heave", "course", "speed", "height", "separation", "gps_tide_corrector")
_DIVIDE = {"longitude": 1e7, "latitude": 1e7, **dict.fromkeys(("tide_corrector", "depth_corrector", "heading", "pitch", "roll", "heave", "course", "speed"), 100.0), **dict.fromkeys(("height", "separation", "gps_tide_corrector"), 1000.0)}

INDEX = "path string, record_type int, record_name string, record_index long, byte_offset long, data_size long, checksum_flag boolean"
PING = "path string, ping_number long, timestamp timestamp_ntz, longitude double, latitude double, num_beams int, ping_flags int, tide_corrector double, depth_corrector double, heading double, pitch double, roll double, heave double, course double, speed double, height double, separation double, gps_tide_corrector double, scale_factors map<int,struct<multiplier:int,offset:int>>, arrays map<string,array<double>>"
ATTITUDE = "path string, timestamp timestamp_ntz, pitch float, roll float, heave float, heading float"
PROFILE = "path string, X double, Y double, depth double, sound_velocity double, observation_timestamp timestamp_ntz, applied_timestamp timestamp_ntz"
PARAMETERS = "path string, record_index long, parameters map<string,string>, processed_datetime timestamp_ntz"
SUMMARY = "path string, first_ping timestamp_ntz, last_ping timestamp_ntz, min_x double, min_y double, min_z double, max_x double, max_y double, max_z double"
COMMENT = "path string, timestamp timestamp_ntz, comment string"
HISTORY = "path string, processing_timestamp timestamp_ntz, machine_name string, operator_name string, command string, comment string"
HEADER = "path string, version string"


def moment(seconds: int, nanoseconds: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds, microseconds=nanoseconds // 1000)


def records(data: bytes) -> Iterator[tuple[int, int, int, int, bool]]:
    """(id, index within the id, offset of the payload, its size, whether a checksum stands before it)."""
    at, seen = 0, dict.fromkeys(RECORDS, 0)
    while at + 8 <= len(data):
        size, word = struct.unpack_from(">II", data, at)
        kind, summed = word & 0x7FFFFFFF, bool(word >> 31)
        if kind not in RECORDS:
            raise ValueError(f"unknown record id {kind} at byte {at}")
        yield kind, seen[kind], at + 8, size, summed
        seen[kind] += 1
        at += 8 + size
        at += -at % 4


def payload(data: bytes, at: int, size: int, summed: bool) -> memoryview:
    return memoryview(data)[at + (4 if summed else 0) : at + size]


def ping(blob: memoryview, scales: dict[int, tuple[int, int]] | None, beams: bool = True) -> tuple[dict, dict[int, tuple[int, int]] | None, dict[str, np.ndarray]]:
    """(header, scale factors in force, arrays).  Arrays are raw / multiplier - offset; without factors in force the read fails."""
    head = dict(zip(_NAMES, _HEADER.unpack_from(blob), strict=True))
    for k, d in _DIVIDE.items():
        head[k] = head[k] / d
    found, at, n = {}, _HEADER_SIZE, head["num_beams"]
    while at + 4 <= len(blob):
        word = struct.unpack_from(">I", blob, at)[0]
        kind, size = word >> 24, word & 0xFFFFFF
        at += 4
        if kind == SCALES:
            count = struct.unpack_from(">i", blob, at)[0]
            scales = {}
            for k in range(count):
                key, multiplier, offset = struct.unpack_from(">Iii", blob, at + 4 + 12 * k)
                scales[key >> 24] = (multiplier, offset)
        elif not 1 <= kind <= 30:
            break
        elif beams and kind != SERIES and n > 0:
            name, sign = ARRAYS[kind]
            if scales is None or kind not in scales:
                raise ValueError("Record has no scale factors")
            multiplier, offset = scales[kind]
            found[name] = np.frombuffer(blob[at : at + size], f">{sign}{size // n}", count=n) / multiplier - offset
        at += size
    return head, scales, found


def _text(b: bytes) -> str:
    return bytes(b).decode("utf-8", "replace").strip().rstrip("\x00").strip()


def _parameters(blob: memoryview) -> tuple[dict[str, str], dt.datetime | None]:
    seconds, nanoseconds, n = struct.unpack_from(">iih", blob)
    at, made, when = 10, {}, None
    for _ in range(n):
        size = struct.unpack_from(">h", blob, at)[0]
        key, _, value = _text(blob[at + 2 : at + 2 + size]).partition("=")
        at += 2 + size
        if key == "REFERENCE TIME":
            when = dt.datetime.strptime(value, "%Y/%j %H:%M:%S") + dt.timedelta(seconds=seconds, microseconds=nanoseconds // 1000)
        else:
            made[key.lower().replace(" ", "_")] = value
    return made, when


def _wanted(index: int, first: int | None, last: int | None) -> bool:
    return (first is None or index >= first) and (last is None or index < last)


def _decode(kind: int, path: str, data: bytes, first: int | None, last: int | None, at_index: int = 0, scales: dict | None = None) -> Iterator[tuple]:
    """Rows of the records of a kind in `data`, of which the first has the index `at_index`."""
    for k, index, at, size, summed in records(data):
        if k != kind:
            continue
        index += at_index
        blob = payload(data, at, size, summed)
        wanted = _wanted(index, first, last)
        if kind == 2:
            head, scales, arrays = ping(blob, scales, wanted)
            if wanted:
                yield (path, index, moment(head["seconds"], head["nanoseconds"]), *(head[c] for c in ("longitude", "latitude", "num_beams", "ping_flags", "tide_corrector", "depth_corrector", "heading", "pitch", "roll", "heave", "course", "speed", "height", "separation", "gps_tide_corrector")), {i: {"multiplier": m, "offset": o} for i, (m, o) in (scales or {}).items()}, {c: v.tolist() for c, v in arrays.items()})
        elif wanted:
            yield from _other(kind, path, index, blob)


def _other(kind: int, path: str, index: int, blob: memoryview) -> Iterator[tuple]:
    """Rows of a record that is no ping."""
    if kind == 12:
        base = moment(*struct.unpack_from(">ii", blob))
        for i in range(struct.unpack_from(">h", blob, 8)[0]):
            ms, *v = struct.unpack_from(">hhhhh", blob, 10 + 10 * i)
            yield (path, base + dt.timedelta(milliseconds=ms), *(x / 100 for x in v))
    elif kind == 3:
        os_, on, as_, an, lon, lat, n = struct.unpack_from(">IIIIiiI", blob)
        for i in range(n):
            depth, speed = struct.unpack_from(">II", blob, 28 + 8 * i)
            yield path, lon / 1e7, lat / 1e7, depth / 100, speed / 100, moment(os_, on), moment(as_, an)
    elif kind == 4:
        yield path, index, *_parameters(blob)
    elif kind == 9:
        a, b, c, d, y0, x0, y1, x1, z0, z1 = struct.unpack_from(">10i", blob)
        yield path, moment(a, b), moment(c, d), x0 / 1e7, y0 / 1e7, z0 / 100, x1 / 1e7, y1 / 1e7, z1 / 100
    elif kind == 6:
        yield path, moment(*struct.unpack_from(">ii", blob)), _text(blob[12:])
    elif kind == 7:
        at, texts = 8, []
        for _ in range(4):
            n = struct.unpack_from(">h", blob, at)[0]
            texts.append(_text(blob[at + 2 : at + 2 + n]))
            at += 2 + n
        yield path, moment(*struct.unpack_from(">ii", blob)), *texts
    elif kind == 1:
        yield path, _text(blob)


KINDS = {"header": (1, HEADER), "ping": (2, PING), "svp": (3, PROFILE), "processing_parameters": (4, PARAMETERS), "comment": (6, COMMENT), "history": (7, HISTORY), "summary": (9, SUMMARY), "attitude": (12, ATTITUDE)}


def _frames(rows: Iterator[tuple], schema: str, size: int = 500) -> Iterator[pd.DataFrame]:
    names = [f.split(" ")[0] for f in _fields(schema)]
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pd.DataFrame(held, columns=names)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names)


def _fields(schema: str) -> list[str]:
    out, depth, at = [], 0, 0
    for k, c in enumerate(schema):
        depth += {"<": 1, ">": -1}.get(c, 0)
        if c == "," and not depth:
            out.append(schema[at:k].strip())
            at = k + 1
    return [*out, schema[at:].strip()]


def _schema_of(record_type: str) -> tuple[int, str]:
    if record_type not in KINDS:
        raise NotImplementedError(f"record type {record_type} is not decoded; known: {', '.join(KINDS)}")
    return KINDS[record_type]


def index_of(files: DataFrame) -> DataFrame:
    """A row per record of each file (path, content), without decoding."""
    ship(files.sparkSession)

    def run(frames):
        for pdf in frames:
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                yield from _frames(((p, k, RECORDS[k], i, at, size, summed) for k, i, at, size, summed in records(data)), INDEX, 50_000)

    return files.select("path", "content").mapInPandas(run, INDEX)


def decode(files: DataFrame, record_type: str = "ping", first: int | None = None, last: int | None = None) -> DataFrame:
    """Decoded records of one type of each file (path, content): those from `first` to before `last`, or all."""
    kind, schema = _schema_of(record_type)
    ship(files.sparkSession)

    def run(frames):
        for pdf in frames:
            for p, data in zip(pdf["path"], pdf["content"], strict=True):
                yield from _frames(_decode(kind, p, data, first, last), schema)

    return files.select("path", "content").mapInPandas(run, schema)


class Ranges:
    """Reads of byte ranges of one file; small ones that lie close together cost one request."""

    AHEAD = 1 << 16

    def __init__(self, path: str):
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)
        self.file = system.open_input_file(name)
        self.size = self.file.size()
        self.start, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not (self.start <= at and at + n <= self.start + len(self.held)):
            self.start, self.held = at, self.file.read_at(max(n, self.AHEAD), at)
        return self.held[at - self.start : at - self.start + n]


def _headers(ranges: Ranges) -> Iterator[tuple[int, int, int, int, bool]]:
    """As `records`, from the records' headers alone."""
    at, seen = 0, dict.fromkeys(RECORDS, 0)
    while at + 8 <= ranges.size:
        size, word = struct.unpack(">II", ranges.read(at, 8))
        kind, summed = word & 0x7FFFFFFF, bool(word >> 31)
        if kind not in RECORDS:
            raise ValueError(f"unknown record id {kind} at byte {at}")
        yield kind, seen[kind], at + 8, size, summed
        seen[kind] += 1
        at += 8 + size
        at += -at % 4


PLAN = "path string, first long, last long, start long, stop long, scales map<int,struct<multiplier:int,offset:int>>, pings long, beams long"


def _plan(path: str, kind: int, step: int) -> Iterator[tuple]:
    """Byte ranges of `step` records of a kind.  Of a ping, its header and its scale factors are read."""
    ranges = Ranges(path)
    now, entry = None, None  # scale factors after the last ping; the open range
    for k, index, at, size, summed in _headers(ranges):
        if k != kind:
            continue
        if entry is None:
            entry = [path, index, index, at - 8, at, dict(now) if now else {}, 0, 0]
        if kind == 2:
            begin = at + (4 if summed else 0)
            head = ranges.read(begin, min(_HEADER_SIZE + 8, at + size - begin))
            entry[7] += max(0, _HEADER.unpack_from(head)[4])
            if len(head) >= _HEADER_SIZE + 8 and struct.unpack_from(">I", head, _HEADER_SIZE)[0] >> 24 == SCALES:
                n = struct.unpack_from(">i", head, _HEADER_SIZE + 4)[0]
                body = ranges.read(begin + _HEADER_SIZE + 8, 12 * n)
                now = {key >> 24: (m, o) for key, m, o in struct.iter_unpack(">Iii", body)}
        entry[2], entry[4], entry[6] = index + 1, at + size, entry[6] + 1
        if entry[6] == step:
            yield tuple(entry)
            entry = None
    if entry is not None:
        yield tuple(entry)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, length of the files, one partition each; contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("path", "length")
    return found.repartition(max(1, min(10_000, found.count())), "path")


def plan(spark: SparkSession, path: str | list[str], record_type: str = "ping", step: int = 2000) -> DataFrame:
    """Byte ranges (start to stop) of `step` records of a type, from `first` to before `last`; of pings also the scale factors before them, and their number of beams."""
    kind, _ = _schema_of(record_type)
    ship(spark)

    def run(frames):
        for pdf in frames:
            for p in pdf["path"]:
                yield from _frames(((*r[:5], {k: {"multiplier": m, "offset": o} for k, (m, o) in r[5].items()}, *r[6:]) for r in _plan(p, kind, step)), PLAN)

    return _files(spark, path).select("path").mapInPandas(run, PLAN)


def counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, pings, beams of each file, from headers alone."""
    return plan(spark, path).groupBy("path").agg(F.sum("pings").alias("pings"), F.sum("beams").alias("beams"))


def read_index(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A row per record of each file, from the records' headers alone."""
    ship(spark)

    def run(frames):
        for pdf in frames:
            for p in pdf["path"]:
                yield from _frames(((p, k, RECORDS[k], i, at, size, summed) for k, i, at, size, summed in _headers(Ranges(p))), INDEX, 50_000)

    return _files(spark, path).select("path").mapInPandas(run, INDEX)


def read_records(spark: SparkSession, path: str | list[str], record_type: str = "ping", first: int | None = None, last: int | None = None, step: int = 2000, per_task: int = 3) -> DataFrame:
    """Decoded records of one type, from `first` to before `last` of each file or all; `per_task` ranges of `step` records a task, so a large file is read by many."""
    kind, schema = _schema_of(record_type)
    ranges = cut(plan(spark, path, record_type, step))
    if first is not None:
        ranges = ranges.where(F.col("last") > first)
    if last is not None:
        ranges = ranges.where(F.col("first") < last)
    tasks = max(1, -(-ranges.count() // per_task))
    ship(spark)

    def run(frames):
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                data = Ranges(r.path).file.read_at(r.stop - r.start, r.start)
                scales = {k: (v["multiplier"], v["offset"]) for k, v in (r.scales.items() if isinstance(r.scales, dict) else r.scales)} or None
                yield from _frames(_decode(kind, r.path, data, first, last, r.first, scales), schema)

    return ranges.repartitionByRange(tasks, "path", "first").mapInPandas(run, schema)


def read_record(spark: SparkSession, path: str | list[str], record_type: str, index: int) -> DataFrame:
    """The `index`-th record of a type of each file; only its byte range is read."""
    return read_records(spark, path, record_type, index, index + 1, step=1)


def with_values(parameters: DataFrame) -> DataFrame:
    """Processing parameters with `values`: what their texts stand for (see `text.parameter_value`)."""
    return parameters.withColumn("values", F.transform_values("parameters", lambda k, v: parameter_value(v)))


def soundings(pings: DataFrame) -> DataFrame:
    """The fixed sounding schema (and path) from decoded pings: beams exploded, header values repeated, positions and the centre beam worked out.

    The centre beam is found in a ping's arrays before they are exploded, so there is no shuffle and each record is decoded once.
    """
    names = sorted({n for n, _ in ARRAYS.values()})
    at = lambda name: F.try_element_at(F.col("arrays")[name], F.col("beam_number") + 1)
    centre = centre_of_arrays(F.col("arrays")["across_track"], F.col("arrays")["beam_flags"], F.col("ping_flags"))
    wide = pings.withColumn("sg_centre", centre).where("num_beams > 0").withColumn("beam_number", F.explode(F.sequence(F.lit(0), F.col("num_beams") - 1)))
    wide = wide.withColumns({n: at(n) for n in names}).withColumn("centre_beam", F.coalesce(F.col("sg_centre") == F.col("beam_number"), F.lit(False)).cast("smallint")).drop("arrays", "scale_factors", "sg_centre")
    wide = wide.withColumn("beam_flags", F.coalesce(F.col("beam_flags"), F.lit(255.0)))
    return coerce_soundings(beam_positions(wide), keep=["path"])


def stored_columns(pings: DataFrame) -> DataFrame:
    """path, columns: the sounding columns that each file's first ping has, in the order of the schema."""
    head = ["X", "Y", "ping_number", "beam_number", "centre_beam", "ping_flags", "timestamp", *(c for c in pings.columns if c in SOUNDINGS)]
    first = pings.groupBy("path").agg(F.min_by(F.map_keys("arrays"), "ping_number").alias("own"))
    return first.select("path", F.filter(F.array(*map(F.lit, SOUNDINGS)), lambda c: c.isin(*set(head)) | F.array_contains("own", c)).alias("columns"))


def sidecars(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The JSON kept beside each file: its index and the columns of its first ping."""
    return sidecar(read_index(spark, path), stored_columns(read_records(spark, path, "ping", 0, 1, step=1)))


def index_in(sidecars: DataFrame) -> DataFrame:
    """The index that sidecars hold, a row per record."""
    kinds = sidecars.select(F.col("gsf_uri").alias("path"), F.explode("file_record_types").alias("record_name", "t"))
    each = kinds.select("path", "record_name", F.col("t.record_type").alias("record_type"), F.posexplode(F.arrays_zip("t.data_size", "t.checksum_flag", "t.indices")).alias("record_index", "r"))
    return each.select("path", "record_type", "record_name", F.col("record_index").cast("long").alias("record_index"), F.col("r.indices").alias("byte_offset"), F.col("r.data_size").alias("data_size"), F.col("r.checksum_flag").alias("checksum_flag"))


def sidecar(index: DataFrame, columns: list[str] | DataFrame | None = None) -> DataFrame:
    """gsf_uri, size, file_record_types (by record name) and bathymetry_ping_schema.  `columns`: of all files, or by file (path, columns)."""
    per = index.groupBy("path", "record_type", "record_name").agg(F.count("*").cast("int").alias("record_count"), F.sort_array(F.collect_list(F.struct("record_index", "data_size", "checksum_flag", "byte_offset"))).alias("r"), F.max(F.col("byte_offset") + F.col("data_size")).alias("end"))
    entry = F.struct("record_type", "record_count", F.transform("r", lambda x: x["data_size"]).alias("data_size"), F.transform("r", lambda x: x["checksum_flag"]).alias("checksum_flag"), F.transform("r", lambda x: x["byte_offset"]).alias("indices"))
    whole = per.groupBy("path").agg(F.max("end").alias("end"), F.map_from_entries(F.collect_list(F.struct("record_name", entry))).alias("file_record_types"))
    has = F.coalesce(F.col("file_record_types")["GSF_SWATH_BATHYMETRY_PING"]["record_count"] > 0, F.lit(False))
    if isinstance(columns, DataFrame):
        whole = whole.join(columns, "path", "left")
    else:
        whole = whole.withColumn("columns", F.array(*map(F.lit, columns or [])).cast("array<string>"))
    return whole.select(F.col("path").alias("gsf_uri"), (F.floor((F.col("end") + 3) / 4) * 4).cast("long").alias("size"), "file_record_types", F.when(has, F.col("columns")).otherwise(F.array().cast("array<string>")).alias("bathymetry_ping_schema"))


SIDECAR = "gsf_uri string, size long, file_record_types map<string,struct<record_type:int,record_count:int,data_size:array<bigint>,checksum_flag:array<boolean>,indices:array<bigint>>>, bathymetry_ping_schema array<string>"


def read_sidecar(spark: SparkSession, path: str | list[str], document: bool = False) -> DataFrame:
    """Sidecars as `write_sidecars` leaves them, a line each; `document`: one JSON document per file, over any number of lines."""
    return spark.read.schema(SIDECAR).option("multiLine", document).json(path)


def file_manifest(sidecars: DataFrame) -> DataFrame:
    """gsf_uri, size, record_count of pings."""
    return sidecars.select("gsf_uri", "size", F.coalesce(F.col("file_record_types")["GSF_SWATH_BATHYMETRY_PING"]["record_count"], F.lit(0)).alias("record_count"))


def sidecar_uri(path: str) -> str:
    """Where a log's sidecar is kept: beside it, with `.json` for `.gsf`."""
    return path.replace(".gsf", ".json")


def stem(path: str) -> str:
    """A log's name without folders and extension."""
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
