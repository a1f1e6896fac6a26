"""Queries of the sources, sinks and whole jobs: tables are written as logs, tables and documents in the shared folder and read back.

Survey logs are made of lineitem: a file holds the orders of a thousand keys, an order is a ping, its lines are beams.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundgrid import catalog
from soundgrid.catalog import CODED, SOUNDINGS, cells, query, rounded, soundings, table
from soundgrid.functions import text
from soundgrid.operators import aggregate, coverage, planning, stats
from soundgrid.plans import metadata, workflows
from soundgrid.schema import required_schema
from soundgrid.shared import scratch
from soundgrid.ship import ship
from soundgrid.sources import geojson, gsf, gsf_writer, sinks, vector
from soundgrid.streaming import density

_BEAMS = """
SELECT CAST(floor(l_orderkey / 1000) AS BIGINT) AS file_id, l_orderkey AS o,
  dense_rank() OVER (PARTITION BY floor(l_orderkey / 1000) ORDER BY l_orderkey) - 1 AS ping_number,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS beam_number,
  l_partkey % 60000 AS z, l_partkey % 20000 - 10000 AS across, l_suppkey % 100 - 50 AS along, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag,
  (l_orderkey * 7919) % 1800000000 AS lon, -((l_orderkey * 104729) % 800000000) AS lat, (l_orderkey * 13) % 36000 AS heading, CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS ping_flag
FROM lineitem
"""


def logs(spark, d) -> DataFrame:
    """(name, content) of the logs.  A file's records are bounded by its thousand order keys."""
    ship(spark)
    beams = spark.sql(_BEAMS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, d, "lineitem"))

    def encode(pdf: pd.DataFrame) -> pd.DataFrame:
        w, k = gsf_writer, int(pdf["file_id"].iloc[0])
        out = [w.record(1, b"GSF-v03.09\0\0")]
        pdf = pdf.sort_values(["ping_number", "beam_number"])
        for n, p in pdf.groupby("ping_number"):
            first = p.iloc[0]
            scales = {1: (100 if n // 10 % 2 == 0 else 200, 0), 2: (10, 5), 3: (10, 0), 16: (1, 0)} if n % 10 == 0 else None
            arrays = {i: [int(x) for x in p[c]] for i, c in ((1, "z"), (2, "across"), (3, "along"), (16, "flag"))}
            out.append(w.record(2, w.ping_body(int(first["o"]), 500_000_000, int(first["lon"]), int(first["lat"]), int(first["heading"]), int(first["ping_flag"]), arrays, scales), summed=n % 2 == 0))
        out.append(w.record(12, w.attitude_body(k, [(250, 100, -100, 3, 9000), (500, 200, k % 100, 0, 0)])))
        out.append(w.record(3, w.profile_body(k, k + 1, 1_470_000_000, -430_000_000, [(100, 150_000), (200 + k, 149_900)])))
        out.append(w.record(4, w.parameters_body(5, {"REFERENCE TIME": "1970/001 00:00:10", "DRAFT TO APPLY": f"1.5,{k}.25", "ROLL COMPENSATED": "YES", "FILE NUMBER": str(k), "VESSEL": f"Ship {k}", "ODD": f"{k}d"})))
        out.append(w.record(6, w.comment_body(k, f"file {k}")))
        out.append(w.record(7, w.history_body(k, "box", "me", f"run -x {k}", "done")))
        out.append(w.record(9, w.summary_body(int(pdf["o"].min()), int(pdf["o"].max()), (int(pdf["lon"].min()), int(pdf["lat"].min()), int(pdf["z"].min())), (int(pdf["lon"].max()), int(pdf["lat"].max()), int(pdf["z"].max())))))
        return pd.DataFrame({"name": [f"log{k}.gsf"], "content": [b"".join(out)]})

    return beams.groupBy("file_id").applyInPandas(encode, "name string, content binary")


_WRITTEN: dict[tuple[str, str], str] = {}


def folder_of_logs(spark, d) -> str:
    """The logs as files, written once a session."""
    key = spark.sparkContext.applicationId, d
    if key not in _WRITTEN:
        _WRITTEN[key] = gsf_writer.write_logs(spark, logs(spark, d), scratch(spark, "logs"))
    return _WRITTEN[key]


def file_id(path: str = "path"):
    return F.regexp_extract(path, r"log(\d+)\.gsf", 1).cast("long").alias("file_id")


_FILES = f"b AS ({_BEAMS}), p AS (SELECT file_id, ping_number, o, min(lon) AS lon, min(lat) AS lat, min(heading) AS heading, min(ping_flag) AS ping_flag, count(*) AS n FROM b GROUP BY 1, 2, 3), f AS (SELECT DISTINCT file_id FROM b)"


# sources


@query(f"WITH {_FILES} SELECT file_id, 'GSF_SWATH_BATHYMETRY_PING' AS record_name, count(*) AS records, CAST(sum(CASE WHEN ping_number % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS summed, CAST(sum(56 + CASE WHEN ping_number % 10 = 0 THEN 56 ELSE 0 END + 16 + 7 * n + CASE WHEN ping_number % 2 = 0 THEN 4 ELSE 0 END) AS BIGINT) AS bytes, max(ping_number) AS last_index FROM p GROUP BY 1 UNION ALL SELECT file_id, r, 1, 0, s, 0 FROM f, (VALUES ('GSF_HEADER', 12), ('GSF_ATTITUDE', 30), ('GSF_SOUND_VELOCITY_PROFILE', 44), ('GSF_SWATH_BATHY_SUMMARY', 40)) t(r, s)")
def gsf_index(spark, d):
    index = gsf.read_index(spark, folder_of_logs(spark, d)).where("record_name in ('GSF_SWATH_BATHYMETRY_PING', 'GSF_HEADER', 'GSF_ATTITUDE', 'GSF_SOUND_VELOCITY_PROFILE', 'GSF_SWATH_BATHY_SUMMARY')")
    return index.groupBy(file_id(), "record_name").agg(F.count("*").alias("records"), F.sum(F.col("checksum_flag").cast("long")).alias("summed"), F.sum("data_size").alias("bytes"), F.max("record_index").alias("last_index"))


@query(f"WITH {_FILES} SELECT file_id, count(*) AS records, CAST(0 AS BIGINT) AS differ FROM p GROUP BY 1")
def gsf_index_of_content(spark, d):
    """The index of whole contents is that of headers alone; offsets lead to the records."""
    whole = gsf.index_of(logs(spark, d).select(F.col("name").alias("path"), "content")).where("record_type = 2").select(file_id(), "record_index", "byte_offset", "data_size")
    lean = gsf.read_index(spark, folder_of_logs(spark, d)).where("record_type = 2").select(file_id(), "record_index", F.col("byte_offset").alias("at"), F.col("data_size").alias("size"))
    both = whole.join(lean, ["file_id", "record_index"], "full")
    return both.groupBy("file_id").agg(F.count("*").alias("records"), F.sum((~(F.col("at").eqNullSafe(F.col("byte_offset")) & F.col("size").eqNullSafe(F.col("data_size")))).cast("long")).alias("differ"))


@query(f"WITH {_FILES} SELECT file_id, ping_number, make_timestamp(o * 1000000 + 500000) AS timestamp, round(lon / 1e7, 7) AS longitude, round(lat / 1e7, 7) AS latitude, round(heading / 100e0, 2) AS heading, n AS num_beams, ping_flag AS ping_flags FROM p")
def gsf_pings(spark, d):
    p = gsf.read_records(spark, folder_of_logs(spark, d), step=7)
    return p.select(file_id(), "ping_number", "timestamp", F.round("longitude", 7).alias("longitude"), F.round("latitude", 7).alias("latitude"), F.round("heading", 2).alias("heading"), F.col("num_beams").cast("long").alias("num_beams"), "ping_flags")


_BEAM_SQL = "round(z / CASE WHEN (ping_number // 10) % 2 = 0 THEN 100e0 ELSE 200e0 END, 3)"
_CENTRE = "CASE WHEN ping_flag = 0 AND flag = 0 AND row_number() OVER (PARTITION BY o, ping_flag, flag ORDER BY abs(across / 10e0 - 5), beam_number) = 1 THEN 1 ELSE 0 END"


@query(f"WITH b AS ({_BEAMS}) SELECT file_id, ping_number, beam_number, {_BEAM_SQL} AS z, round(across / 10e0 - 5, 1) AS across_track, round(along / 10e0, 1) AS along_track, flag AS beam_flags, {_CENTRE} AS centre_beam, true AS no_pitch_error FROM b")
def gsf_soundings(spark, d):
    s = gsf.soundings(gsf.read_records(spark, folder_of_logs(spark, d), step=50, per_task=2))
    two = lambda c, n: F.round(F.round(F.col(c).cast("double"), 4), n).alias(c)
    return s.select(file_id(), "ping_number", F.col("beam_number").cast("long").alias("beam_number"), F.round(F.col("Z").cast("double"), 3).alias("z"), two("across_track", 1), two("along_track", 1), "beam_flags", "centre_beam", F.isnan("horizontal_error").alias("no_pitch_error"))


@query(f"WITH b AS ({_BEAMS}) SELECT file_id, ping_number, beam_number, {_BEAM_SQL} AS z FROM b WHERE ping_number >= 13 AND ping_number < 18")
def gsf_slice(spark, d):
    """Pings 13 to 17 of each file; the scale factors in force come from ping 10."""
    s = gsf.soundings(gsf.read_records(spark, folder_of_logs(spark, d), "ping", 13, 18, step=4))
    return s.select(file_id(), "ping_number", F.col("beam_number").cast("long").alias("beam_number"), F.round(F.col("Z").cast("double"), 3).alias("z"))


@query(f"WITH b AS ({_BEAMS}) SELECT file_id, ping_number, count(*) AS beams, round(sum({_BEAM_SQL}), 3) AS total FROM b WHERE ping_number = 25 GROUP BY 1, 2")
def gsf_random_record(spark, d):
    p = gsf.read_record(spark, folder_of_logs(spark, d), "ping", 25)
    return p.select(file_id(), "ping_number", F.size(F.col("arrays")["Z"]).cast("long").alias("beams"), F.round(F.aggregate(F.col("arrays")["Z"], F.lit(0.0), lambda a, x: a + x), 3).alias("total"))


@query(f"WITH {_FILES} SELECT file_id, count(*) AS pings, CAST(sum(n) AS BIGINT) AS beams FROM p GROUP BY 1")
def gsf_counts(spark, d):
    return gsf.counts(spark, folder_of_logs(spark, d)).select(file_id(), "pings", "beams")


@query(f"WITH {_FILES} SELECT file_id, 'GSF-v03.09' AS version FROM f")
def gsf_header(spark, d):
    return gsf.read_records(spark, folder_of_logs(spark, d), "header").select(file_id(), "version")


@query(f"WITH {_FILES} SELECT file_id, make_timestamp(file_id * 1000000 + 250000) AS timestamp, 1e0 AS pitch, -1e0 AS roll, 90e0 AS heading FROM f UNION ALL SELECT file_id, make_timestamp(file_id * 1000000 + 500000), 2e0, (file_id % 100) / 100e0, 0e0 FROM f")
def gsf_attitude(spark, d):
    a = gsf.read_records(spark, folder_of_logs(spark, d), "attitude")
    return a.select(file_id(), "timestamp", *(F.round(F.col(c).cast("double"), 2).alias(c) for c in ("pitch", "roll", "heading")))


@query(f"WITH {_FILES} SELECT file_id, 147e0 AS X, -43e0 AS Y, depth, speed AS sound_velocity, make_timestamp(file_id * 1000000) AS observation_timestamp, make_timestamp((file_id + 1) * 1000000) AS applied_timestamp FROM (SELECT file_id, 1e0 AS depth, 1500e0 AS speed FROM f UNION ALL SELECT file_id, (200 + file_id) / 100e0, 1499e0 FROM f)")
def gsf_svp(spark, d):
    return gsf.read_records(spark, folder_of_logs(spark, d), "svp").select(file_id(), "X", "Y", "depth", "sound_velocity", "observation_timestamp", "applied_timestamp")


@query(f"WITH {_FILES} SELECT file_id, key, CASE key WHEN 'draft_to_apply' THEN 'numbers' WHEN 'roll_compensated' THEN 'flag' WHEN 'file_number' THEN 'number' ELSE 'text' END AS kind, CASE key WHEN 'roll_compensated' THEN 'true' WHEN 'vessel' THEN 'ship ' || file_id WHEN 'odd' THEN file_id || 'd' END AS text, CASE WHEN key = 'file_number' THEN CAST(file_id AS DOUBLE) END AS number, CASE WHEN key = 'draft_to_apply' THEN file_id + 1.75e0 END AS total, make_timestamp(15000000) AS processed_datetime FROM f, (VALUES ('draft_to_apply'), ('roll_compensated'), ('file_number'), ('vessel'), ('odd')) t(key)")
def gsf_processing_parameters(spark, d):
    p = gsf.with_values(gsf.read_records(spark, folder_of_logs(spark, d), "processing_parameters"))
    each = p.select(file_id(), "processed_datetime", F.explode("values").alias("key", "x"))
    return each.select("file_id", "key", "x.kind", "x.text", "x.number", F.aggregate("x.numbers", F.lit(0.0), lambda a, b: a + b).alias("total"), "processed_datetime")


@query(f"WITH {_FILES}, s AS (SELECT file_id, min(o) AS a, max(o) AS z, min(lon) AS x0, max(lon) AS x1, min(lat) AS y0, max(lat) AS y1 FROM p GROUP BY 1) SELECT file_id, make_timestamp(a * 1000000) AS first_ping, make_timestamp(z * 1000000) AS last_ping, round(x0 / 1e7, 7) AS min_x, round(x1 / 1e7, 7) AS max_x, round(y0 / 1e7, 7) AS min_y, round(y1 / 1e7, 7) AS max_y FROM s")
def gsf_summary(spark, d):
    s = gsf.read_records(spark, folder_of_logs(spark, d), "summary")
    return s.select(file_id(), "first_ping", "last_ping", *(F.round(c, 7).alias(c) for c in ("min_x", "max_x", "min_y", "max_y")))


@query(f"WITH {_FILES} SELECT file_id, make_timestamp(file_id * 1000000) AS timestamp, 'file ' || file_id AS comment FROM f")
def gsf_comment(spark, d):
    return gsf.read_records(spark, folder_of_logs(spark, d), "comment").select(file_id(), "timestamp", "comment")


@query(f"WITH {_FILES} SELECT file_id, make_timestamp(file_id * 1000000) AS processing_timestamp, 'box' AS machine_name, 'me' AS operator_name, 'run -x ' || file_id AS command, 'done' AS comment FROM f")
def gsf_history(spark, d):
    return gsf.read_records(spark, folder_of_logs(spark, d), "history").drop("path").select(F.regexp_extract("command", r"(\d+)$", 1).cast("long").alias("file_id"), "*")


@query(f"WITH {_FILES} SELECT file_id, 'log' || file_id AS stem, 'log' || file_id || '.json' AS kept_in, ping_number AS record_index, 56 + CASE WHEN ping_number % 10 = 0 THEN 56 ELSE 0 END + 16 + 7 * n + CASE WHEN ping_number % 2 = 0 THEN 4 ELSE 0 END AS data_size, 'X,Y,Z,across_track,along_track,beam_flags,ping_number,beam_number,centre_beam' AS columns FROM p")
def gsf_sidecar(spark, d):
    """Sidecars are written and read back, and their index is exploded again."""
    out = scratch(spark, "sidecars")
    sinks.write_sidecars(gsf.sidecars(spark, folder_of_logs(spark, d)), out)
    known = gsf.read_sidecar(spark, out)
    index = gsf.index_in(known).where("record_type = 2")
    some = F.filter("bathymetry_ping_schema", lambda c: c.isin("X", "Y", "Z", "across_track", "along_track", "beam_flags", "ping_number", "beam_number", "centre_beam", "vertical_error"))
    columns = known.select(file_id("gsf_uri"), F.array_join(some, ",").alias("columns"))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    named = index.select(file_id(), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.replace(name, F.lit(".gsf"), F.lit(".json")).alias("kept_in"), "record_index", "data_size")
    return named.join(columns, "file_id")


@query(f"WITH {_FILES} SELECT file_id, count(*) AS record_count, 'kept' AS state FROM p GROUP BY 1")
def gsf_manifest(spark, d):
    kept, empty = planning.split_empty(gsf.file_manifest(gsf.sidecars(spark, folder_of_logs(spark, d))))
    made = kept.withColumn("state", F.lit("kept")).unionByName(empty.withColumn("state", F.lit("empty")))
    return made.select(file_id("gsf_uri"), F.col("record_count").cast("long").alias("record_count"), "state")


@query(f"WITH {_FILES}, s AS (SELECT min(o) AS a, max(o) AS z FROM p) SELECT make_timestamp(a * 1000000 + 500000) AS start_datetime, make_timestamp(z * 1000000 + 500000) AS end_datetime, (SELECT count(*) FROM b) AS points, (SELECT CAST(sum(n) AS BIGINT) FROM p) AS counted, (SELECT round(sum({_BEAM_SQL}), 1) FROM b) AS total FROM s")
def ingest_logs(spark, d):
    """The whole job: logs to points and cell frequencies, read back."""
    out = scratch(spark, "ingest")
    bounds = workflows.ingest(spark, [folder_of_logs(spark, d)], f"{out}/points", f"{out}/cells", 9, step=100)
    z = F.round(F.col("Z").cast("double"), 3).cast("decimal(18,3)")  # Z is stored in single precision: its thousandths are added exactly, so neither its error nor the order of rows moves the total
    points = spark.read.parquet(f"{out}/points").agg(F.count("*"), F.round(F.sum(z), 1).cast("double")).first()
    counted = spark.read.parquet(f"{out}/cells").agg(F.sum("count")).first()[0]
    return bounds.withColumns({"points": F.lit(points[0]), "total": F.lit(points[1]), "counted": F.lit(counted)})


# sinks


@query(f"WITH s AS ({SOUNDINGS}) SELECT file_id, count(*) AS n, round(sum(Z), 2) AS total FROM s GROUP BY 1")
def append_points(spark, d):
    out = scratch(spark, "points")
    s = soundings(spark, d)
    sinks.create_table(spark, s.schema, out)
    for part in (0, 1):  # two appends to one bag
        sinks.append_points(s.where(F.col("ping_number") % 2 == part), out)
    return spark.read.parquet(out).groupBy("file_id").agg(F.count("*").alias("n"), F.round(F.sum("Z"), 2).alias("total"))


_DENSE = f"d AS (SELECT file_id, ping_number, beam_number, max(Z) AS z FROM ({SOUNDINGS}) GROUP BY 1, 2, 3)"


@query(f"WITH {_DENSE} SELECT file_id, ping_number, beam_number, CASE WHEN file_id < 3 THEN z + 1 ELSE z END AS z, CASE WHEN file_id < 3 THEN 1 END AS pass FROM d")
def upsert_ping_beam(spark, d):
    """A dense table, then new rows for some files with a column more; the other files' partitions stay."""
    out = scratch(spark, "dense")
    s = soundings(spark, d).groupBy("file_id", "ping_number", "beam_number").agg(F.max("Z").alias("z"))
    sinks.upsert_ping_beam(spark, s, out)
    sinks.upsert_ping_beam(spark, s.where("file_id < 3").withColumns({"z": F.col("z") + 1, "pass": F.lit(1)}), out)
    return sinks.read_ping_beam(spark, out).select(F.col("file_id").cast("long").alias("file_id"), "ping_number", "beam_number", "z", "pass")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders")
def write_chunked(spark, d):
    out = scratch(spark, "chunks")
    sinks.write_dense(table(spark, d, "orders").select("o_orderkey"), out, ["o_orderkey"], 1000)
    return spark.read.parquet(out)


@query(f"WITH {CODED} SELECT substring(region_code, 1, 1) AS R0, CAST(substring(region_code, 2, 1) AS INTEGER) AS R1, count(DISTINCT region_code) AS cells, count(*) AS count FROM coded WHERE region_code LIKE 'P4%' GROUP BY 1, 2")
def write_cells(spark, d):
    from soundgrid.functions.dggs import code_filter

    out = scratch(spark, "cells")
    sinks.write_cells(aggregate.cell_frequency(cells(spark, d)), out)
    return spark.read.parquet(out).where(code_filter("P4")).groupBy("R0", F.col("R1").cast("int").alias("R1")).agg(F.count("*").alias("cells"), F.sum("count").alias("count"))


@query("SELECT l_returnflag, count(*) AS count FROM (SELECT * FROM lineitem WHERE l_linestatus = 'F' UNION ALL SELECT * FROM lineitem) GROUP BY 1")
def combine_tables(spark, d):
    """Two written tables combined into one."""
    out = scratch(spark, "combine")
    t = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    t.where("l_linestatus = 'F'").write.parquet(f"{out}/a")
    t.write.parquet(f"{out}/b")
    sinks.combine(spark, [f"{out}/a", f"{out}/b"], f"{out}/both")
    return aggregate.value_count(spark.read.parquet(f"{out}/both"), "l_returnflag")


@query("SELECT count(*) AS rows, 'u1_bathymetry.parquet,u1_coverage,u1_cells' AS names, true AS gone FROM supplier")
def move_data(spark, d):
    out = scratch(spark, "move")
    for name in ("table", "coverage", "cells"):
        table(spark, d, "supplier").write.parquet(f"{out}/{name}")
    new = sinks.move_data(spark, "u1", *(f"{out}/{n}" for n in ("table", "coverage", "cells")), f"{out}/to")
    gone = not any(sinks.exists(spark, f"{out}/{n}") for n in ("table", "coverage", "cells"))
    return spark.read.parquet(new[0]).agg(F.count("*").alias("rows")).withColumns({"names": F.lit(",".join(x.rsplit("/", 1)[-1] for x in new)), "gone": F.lit(gone)})


@query(f"WITH {CODED} SELECT substring(region_code, 1, 3) AS region_code, CAST(sum(1) AS BIGINT) AS count FROM coded GROUP BY 1")
def load_and_concat(spark, d):
    """Cell tables of several files, written apart, loaded and merged."""
    out = scratch(spark, "tables")
    c = cells(spark, d)
    for k in range(3):
        aggregate.reduce_resolution(aggregate.cell_frequency(c.where(F.col("file_id") % 3 == k)), 2).write.parquet(f"{out}/{k}")
    return aggregate.load_and_merge(spark, [f"{out}/{k}" for k in range(3)])


@query(f"WITH s AS ({SOUNDINGS}) SELECT 'X' AS dimension, min(X) AS low, max(X) AS high FROM s UNION ALL SELECT 'Y', min(Y), max(Y) FROM s UNION ALL SELECT 'ping_number', min(ping_number), max(ping_number) FROM s")
def table_domain(spark, d):
    found = sinks.domain(soundings(spark, d), ["X", "Y", "ping_number"])
    return spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in found.items()], "dimension string, low double, high double")


@query(f"WITH s AS ({SOUNDINGS}) SELECT count(*) AS num_points, round(min(X), 6) AS min_x, round(max(Y), 6) AS max_y, round(max(Z), 6) AS max_z, 'epsg:4283' AS horizontal, 'lat' AS vertical FROM s")
def table_crs_and_info(spark, d):
    """Reference systems are kept with the table and read back; points and bounds of it."""
    out = scratch(spark, "crs")
    metadata.crs_column(soundings(spark, d), {"horizontal_datum": "epsg:4283", "vertical_datum": "lat"}).write.parquet(out)
    t = spark.read.parquet(out)
    crs, info = metadata.crs_info(t), metadata.table_info(t)
    return info.select("num_points", F.round("min_x", 6).alias("min_x"), F.round("max_y", 6).alias("max_y"), F.round("max_z", 6).alias("max_z"), F.lit(crs["horizontal_datum"]).alias("horizontal"), F.lit(crs["vertical_datum"]).alias("vertical"))


@query("SELECT CAST(3 AS BIGINT) AS stored, 'ping_number:int64,Z:float,pitch:float' AS columns")
def storage_schema(spark, d):
    out = scratch(spark, "schema")
    sinks.create_table(spark, required_schema(["pitch", "Z", "nope"], ["ping_number"]), out)
    names = {"bigint": "int64", "float": "float"}
    made = spark.read.parquet(out)
    return made.agg(F.lit(len(made.columns)).cast("long").alias("stored"), F.lit(",".join(f"{c}:{names[t]}" for c, t in made.dtypes)).alias("columns"))


# documents


@query("SELECT 'Polygon' AS type, CAST(n_nationkey AS DOUBLE) AS x, n_nationkey + 1e0 AS y FROM nation")
def data_geometry(spark, d):
    """The first feature of each written coverage file."""
    out = scratch(spark, "coverage")
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("double").alias("k"))
    shape = F.concat(F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Polygon","coordinates":[[['), F.col("k"), F.lit(","), F.col("k") + 1, F.lit(']]]}},{"geometry":{"type":"Point"}}]}'))
    n.select(shape.alias("value")).repartition(25, "k").write.option("maxRecordsPerFile", 1).text(out)
    g = geojson.geometries(spark, out).select(F.from_json("geometry", "type string, coordinates array<array<array<double>>>").alias("g"))
    return g.select("g.type", F.col("g.coordinates")[0][0][0].alias("x"), F.col("g.coordinates")[0][0][1].alias("y"))


@query("SELECT n_nationkey AS k, f AS form, 'Polygon' AS type, CAST(2 AS BIGINT) AS rings, CAST(n_nationkey AS DOUBLE) AS x, n_nationkey + 10e0 AS y FROM nation, (VALUES ('geopackage'), ('shapefile'), ('geojson')) t(f)")
def coverage_vectors(spark, d):
    """A square with a hole for each nation, as three formats write it."""
    ship(spark)

    def made(pdf: pd.DataFrame) -> pd.DataFrame:
        import sqlite3
        import struct

        rows = []
        for k in pdf["n_nationkey"]:
            rings = [[(k, k), (k, k + 10.0), (k + 10.0, k + 10.0), (k + 10.0, k), (k, k)], [(k + 1.0, k + 1.0), (k + 2.0, k + 1.0), (k + 2.0, k + 2.0), (k + 1.0, k + 1.0)]]
            points = [struct.pack("<2d", *p) for r in rings for p in r]
            shape = struct.pack("<i4d2i2i", 5, k, k, k + 10, k + 10, 2, 9, 0, 5) + b"".join(points)
            rows.append((k, "shapefile", (struct.pack(">i", 9994)).ljust(100, b"\0") + struct.pack(">2i", 1, len(shape) // 2) + shape))
            wkb = b"\1" + struct.pack("<2i", 3, 2) + b"".join(struct.pack("<i", len(r)) + b"".join(struct.pack("<2d", *p) for p in r) for r in rings)
            db = sqlite3.connect(":memory:")
            db.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
            db.execute("INSERT INTO gpkg_geometry_columns VALUES ('c', 'geom')")
            db.execute("CREATE TABLE c (fid INTEGER PRIMARY KEY, geom BLOB)")
            db.execute("INSERT INTO c (geom) VALUES (?)", (b"GP\0\1" + struct.pack("<i", 4326) + wkb,))
            db.commit()
            rows.append((k, "geopackage", db.serialize()))
            rows.append((k, "geojson", json.dumps({"features": [{"geometry": {"type": "Polygon", "coordinates": rings}}]}).encode()))
        return pd.DataFrame(rows, columns=["k", "form", "content"])

    files = table(spark, d, "nation").select("n_nationkey").mapInPandas(lambda frames: map(made, frames), "k long, form string, content binary")
    read = vector.geometries_of(files.select(F.concat_ws(" ", "k", "form").alias("path"), "content"))
    g = F.from_json("geometry", "type string, coordinates array<array<array<double>>>")
    return read.select(F.split("path", " ")[0].cast("long").alias("k"), F.split("path", " ")[1].alias("form"), g.alias("g")).select("k", "form", "g.type", F.size("g.coordinates").cast("long").alias("rings"), F.col("g.coordinates")[0][1][0].alias("x"), F.col("g.coordinates")[0][1][1].alias("y"))


@query(f"WITH s AS ({SOUNDINGS}), w AS (SELECT CAST(floor(epoch(CAST(timestamp AS TIMESTAMP)) / 2592000) AS BIGINT) AS bucket, l_returnflag FROM s) SELECT bucket, l_returnflag, count(*) AS count FROM w GROUP BY 1, 2")
def stream_density(spark, d):
    """Counts per window of 30 days from a stream of written soundings, run until it is drained."""
    out = scratch(spark, "stream")
    soundings(spark, d).select(F.expr("timestamp_seconds(unix_date(CAST(timestamp AS DATE)) * 86400L)").alias("timestamp"), "l_returnflag").write.parquet(f"{out}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{out}/in").schema).parquet(f"{out}/in")
    counted = density.windowed_density(stream, "30 days", "10 minutes", "l_returnflag")
    flat = counted.select(F.floor(F.unix_micros("window.start") / 2592000000000).alias("bucket"), "l_returnflag", "count")

    def keep(batch, k):
        batch.write.mode("overwrite").parquet(f"{out}/out/{k}")

    flat.writeStream.outputMode("update").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    batches = spark.read.option("recursiveFileLookup", True).parquet(f"{out}/out").withColumn("k", F.regexp_extract(F.col("_metadata.file_path"), r"/out/(\d+)/", 1).cast("long"))
    return batches.groupBy("bucket", "l_returnflag").agg(F.max_by("count", "k").alias("count"))


@query(f"WITH s AS ({SOUNDINGS}) SELECT 'Feature' AS type, 'u1' AS id, 4326 AS epsg, count(*) AS points, 'T' AS title, round(min(X), 4) AS min_x, round(max(Z), 4) AS max_z, strftime(max(CAST(timestamp AS TIMESTAMP)), '%Y-%m-%dT%H:%M:%S.%fZ') AS datetime, strftime(min(CAST(timestamp AS TIMESTAMP)), '%Y-%m-%dT%H:%M:%S.%fZ') AS start FROM s")
def stac_document(spark, d):
    """A survey's STAC item, written as a document and read back."""
    out = scratch(spark, "item")
    s = soundings(spark, d).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    fields = spark.createDataFrame([("survey_general", "lineage", ["made"]), ("survey_general", "survey_title", ["T"]), ("survey_general", "abstract", ["A"]), ("survey_citation", "data_owner", ["O"]), ("survey_citation", "custodian", ["C"]), ("survey_citation", "attribution_citation", ["cite"]), ("bathymetry_technical", "sensor_type", ["S"])], "sheet string, field string, values array<string>")
    item = metadata.stac_item(spark, "u1", stats.basic_statistics(s, ["X", "Y", "Z"]), aggregate.time_bounds(s), fields, F.lit('{"type":"Point","coordinates":[1,2]}'), s.schema, {"model": "M"}, {"horizontal_datum": "epsg:4326"}, {"data": "d", "footprint": "f", "density": "n", "self": "s"})
    sinks.write_document(item, out)
    get = lambda path: F.get_json_object("value", path)
    read = spark.read.text(out)
    p = "$.properties['%s']"
    return read.select(get("$.type").alias("type"), get("$.id").alias("id"), get(p % "proj:epsg").cast("int").alias("epsg"), get(p % "pc:count").cast("long").alias("points"), get("$.properties.title").alias("title"), F.round(get("$.bbox[0]").cast("double"), 4).alias("min_x"), F.round(get("$.bbox[5]").cast("double"), 4).alias("max_z"), get("$.properties.datetime").alias("datetime"), get("$.properties.start_datetime").alias("start"))


_ODD = "SELECT p_partkey, CASE p_size % 10 WHEN 0 THEN '1d' WHEN 1 THEN '5F' WHEN 2 THEN '1e5' WHEN 3 THEN 'nan' WHEN 4 THEN 'Infinity' WHEN 5 THEN ' -7 ' WHEN 6 THEN '2.5' WHEN 7 THEN '1.5e3' WHEN 8 THEN 'a.b' ELSE '0x10' END AS v FROM part"


@query(f"WITH v AS ({_ODD}) SELECT p_partkey, CASE WHEN v IN (' -7 ', '2.5', '1.5e3') THEN 'number' ELSE 'text' END AS kind, CASE WHEN v NOT IN (' -7 ', '2.5', '1.5e3') THEN lower(v) END AS text, CASE v WHEN ' -7 ' THEN -7e0 WHEN '2.5' THEN 2.5e0 WHEN '1.5e3' THEN 1500e0 END AS number FROM v")
def proc_param_odd_forms(spark, d):
    v = spark.sql(_ODD.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))
    return v.select("p_partkey", text.parameter_value(F.col("v")).alias("x")).select("p_partkey", "x.kind", "x.text", "x.number")


_DATED = "SELECT o_orderkey AS position, 'Survey (Details)' AS sheet, 'Mandatory' AS requirement, CASE WHEN o_orderkey % 2 = 0 THEN 'e.g. Jan… Start DateTime ' ELSE 'End DateTime ' END || o_orderkey AS field, CASE o_orderkey % 5 WHEN 0 THEN {iso} WHEN 1 THEN {us} WHEN 2 THEN {words} WHEN 3 THEN {zulu} ELSE {days} END AS value FROM orders"
_SPARK_DATES = {"iso": "date_format(o_orderdate, 'yyyy-MM-dd')", "us": "date_format(o_orderdate, 'M/d/yyyy')", "words": "date_format(o_orderdate, 'MMMM d, yyyy')", "zulu": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm'Z'\")", "days": "date_format(o_orderdate, 'd MMM yyyy')"}
_WHOLE = "CAST(o_orderdate AS DATE)"


@query(f"SELECT 'survey_details' AS sheet, CASE WHEN o_orderkey % 2 = 0 THEN 'start_datetime_' ELSE 'end_datetime_' END || o_orderkey AS field, strftime({_WHOLE}, '%Y-%m-%d') AS day FROM orders")
def harvest_dates(spark, d):
    """Field names lose their examples; dates are read in five ways of writing them."""
    rows = spark.sql(_DATED.format(**_SPARK_DATES).replace("FROM orders", "FROM {orders}"), orders=table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date")))
    return metadata.harvest(rows).select("sheet", "field", F.date_format("when", "yyyy-MM-dd").alias("day"))


# plans without a partition key, boxes, footprints


@query("SELECT c_custkey, CAST(ntile(14) OVER (ORDER BY c_custkey) AS INTEGER) AS block FROM customer")
def scatter_global(spark, d):
    return planning.scatter(table(spark, d, "customer").select("c_custkey"), 14, ["c_custkey"])


@query("SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) % 40 AS INTEGER) AS lane FROM customer")
def lanes_global(spark, d):
    return planning.lanes(table(spark, d, "customer").select("c_custkey"), ["c_custkey"])


@query(f"WITH s AS ({SOUNDINGS}) SELECT file_id, min(ping_number) AS min_ping, max(ping_number) AS max_ping, count(*) OVER () AS results FROM s GROUP BY 1")
def block_ping_bounds(spark, d):
    bounds = planning.ping_bounds(soundings(spark, d), ["file_id"])
    return bounds.withColumn("results", F.lit(bounds.count()).cast("long"))  # how many results came back


_TILES = "SELECT l_suppkey % 40 AS k, -175e0 + (l_suppkey % 40) * 8.5e0 AS min_x, -175e0 + (l_suppkey % 40) * 8.5e0 + 0.5e0 * (1 + l_suppkey % 3) AS max_x, -80e0 + (l_suppkey % 40) * 3.5e0 AS min_y, -80e0 + (l_suppkey % 40) * 3.5e0 + 5e0 AS max_y FROM lineitem"


@query(f"WITH s AS ({SOUNDINGS}), t AS (SELECT DISTINCT * FROM ({_TILES})), w AS (SELECT s.Z FROM s JOIN t ON X BETWEEN min_x AND max_x AND Y BETWEEN min_y AND max_y), a AS (SELECT 'Z' AS attribute, count(v) AS c, sum(v) AS s1, sum(v*v) AS s2, sum(v*v*v) AS s3, sum(v*v*v*v) AS s4, min(v) AS lo, max(v) AS hi FROM (SELECT Z AS v FROM w)), b AS ({catalog._CENTRAL}) SELECT {catalog._FINAL} FROM b")
def bbox_statistics(spark, d):
    """Statistics over boxes of several sizes; a point in several of them counts for each."""
    tiles = spark.sql(_TILES.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, d, "lineitem")).distinct()
    return rounded(stats.reduce_statistics(stats.cell_statistics(soundings(spark, d), tiles, ["Z"], mode="bbox")))


@query(f"WITH {catalog.cell_ctes(4)} SELECT CASE WHEN face IN ('N', 'S') THEN face ELSE 'E' END AS face, count(DISTINCT region_code) AS cells, CAST(0 AS BIGINT) AS open_rings FROM coded GROUP BY 1")
def dissolve_area(spark, d):
    """Dissolved polygons, less their holes, hold as many cells as there are; rings close."""
    made = coverage.polygons(aggregate.cell_frequency(cells(spark, d, 4)), 4)
    turns = lambda r: F.aggregate(F.transform(r, lambda v, i: v["x"] * F.get(r, F.pmod(i + 1, F.size(r)).cast("int"))["y"] - v["y"] * F.get(r, F.pmod(i + 1, F.size(r)).cast("int"))["x"]), F.lit(0).cast("long"), lambda a, x: a + x)
    twice = turns(F.col("outer")) + F.aggregate(F.transform("holes", turns), F.lit(0).cast("long"), lambda a, x: a + x)
    return made.withColumn("ok", (twice == 2 * F.col("area")).cast("long")).groupBy("face").agg(F.sum("area").alias("cells"), F.sum(1 - F.col("ok")).alias("open_rings"))


_HEXES = f"a AS (SELECT (X * {catalog.math.sqrt(3) / 3!r} - Y / 3) / 4e0 AS q, Y * {2 / 3!r} / 4e0 AS r FROM ({SOUNDINGS})), b AS (SELECT q, r, -q - r AS s, round(q) AS rq, round(r) AS rr, round(-q - r) AS rs FROM a), c AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM b), h AS (SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS q, CAST(CASE WHEN dq > dr AND dq > ds THEN rr WHEN dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS r, count(*) AS n FROM c GROUP BY 1, 2)"


@query(f"WITH {_HEXES}, d AS (SELECT q, r FROM h WHERE n >= 3), s AS (SELECT d.q, d.r FROM d, (VALUES (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1), (1, 0)) t(a, b) WHERE NOT EXISTS (SELECT 1 FROM d e WHERE e.q = d.q + a AND e.r = d.r + b)) SELECT count(*) AS sides, 4 * count(*) AS length FROM s")
def hexbin_outline(spark, d):
    sides = coverage.hexbin_outline(coverage.hexbin(soundings(spark, d), 4.0), 4.0, least=3)
    return sides.agg(F.count("*").alias("sides"), F.round(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).cast("long").alias("length"))
