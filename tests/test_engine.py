import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import gsf_files
import __spark_entry__ as entry_points
from soundgrid import catalog
from soundgrid.functions import boundary, dggs, text
from soundgrid.operators import aggregate, coverage, navigation, planning, stats
from soundgrid.plans import metadata, workflows
from soundgrid.schema import SOUNDINGS, coerce_soundings, required_schema
from soundgrid.sources import geojson, gsf, sinks, xlsx
from soundgrid.streaming import density

TABLES = "region nation customer supplier part orders lineitem events".split()


def cells_of(df):
    def v(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return None
        if isinstance(x, (list, np.ndarray)):
            return str([v(y) for y in x])
        return round(float(x), 9) if isinstance(x, (float, np.floating)) else int(x) if isinstance(x, np.integer) else x

    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(v(x) for x in r) for r in df.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    ours, theirs = catalog.queries()[name](spark, sf).toPandas(), con.execute(catalog.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert cells_of(ours) == cells_of(theirs)


def test_entry_points(spark):
    assert entry_points.entry(spark).limit(3).count() == 3
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


GOLDEN = [(0, 0, "Q333333333333333"), (147.3, -43.1, "S300682051484300"), (144.54308, -38, "R784763243726468"), (115.7, -32, "R681237077126887"), (20, 85, "N442025323084757"), (110, -80, "S461127760656245")]


def test_golden_codes_and_edge(spark):
    df = spark.createDataFrame([(float(a), float(b), c) for a, b, c in GOLDEN], "X double, Y double, want string")
    assert dggs.with_cell(df).where("region_code <> want").count() == 0
    ring = boundary.cell_boundary(F.col("c"), decimals=None)
    east, west = (spark.createDataFrame([(c,)], "c string").select(boundary.ring_bbox(ring).alias("b")).first()["b"] for c in ("R78710051642373", "R78710051642374"))
    assert east["max_x"] == west["min_x"] == 144.54308192254643


def test_bad_positions_have_no_code(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (181.0, 0.0), (0.0, 90.1), (float("inf"), 0.0)], "X double, Y double")
    assert {r[0] for r in dggs.with_cell(df).select("region_code").collect()} == {None}
    edge = dggs.with_cell(spark.createDataFrame([(180.0, 0.0), (-180.0, 0.0), (0.0, 90.0), (0.0, -90.0)], "X double, Y double"), resolution=3)
    assert [r[2] for r in edge.collect()][:2] == ["O333", "O333"]


def test_nesting_and_centre_round_trip(spark):
    r = np.random.default_rng(5)
    pts = spark.createDataFrame([(float(a), float(b)) for a, b in zip(r.uniform(-180, 180, 2000), np.degrees(np.arcsin(r.uniform(-1, 1, 2000))), strict=True)], "X double, Y double")
    both = dggs.with_cell(dggs.with_cell(pts, resolution=4, name="low"), resolution=9).cache()
    assert both.where(F.col("low") != dggs.rhealpix_parent(F.col("region_code"), 4)).count() == 0
    ring = boundary.planar_boundary(F.col("region_code"))
    middle = both.select("region_code", ring.alias("r")).cache().select("region_code", boundary.geographic((F.col("r")[0]["x"] + F.col("r")[2]["x"]) / 2, (F.col("r")[0]["y"] + F.col("r")[2]["y"]) / 2).alias("m")).cache()
    assert middle.where(F.col("region_code") != dggs.rhealpix_encode(F.col("m.x"), F.col("m.y"), 9)).count() == 0


def test_outlines_first_vertex_and_darts(spark):
    df = spark.createDataFrame([("N0",), ("N4",), ("N12",), ("S15",), ("Q4",), ("bad",)], "c string")
    got = {r["c"]: r["b"] for r in df.select("c", boundary.cell_boundary(F.col("c")).alias("b")).collect()}
    assert len(got["N0"]) == 3 and len(got["N4"]) == len(got["N12"]) == len(got["Q4"]) == 4 and got["bad"] is None
    assert got["N12"][0]["y"] > got["N12"][2]["y"] and got["N12"][0]["x"] < got["N12"][1]["x"]
    one = df.where("c = 'Q4'").select(boundary.ring_wkt(boundary.cell_boundary(F.col("c"))).alias("w")).first()["w"]
    assert one.startswith("POLYGON ((30") and one.count(",") == 4


def test_statistics_of_known_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (float("nan"),), (None,)], "v double")
    for row in (stats.basic_statistics(df).first(), stats.reduce_statistics(stats.partial_statistics(df)).first()):
        assert row["count"] == 5 and math.isclose(row["variance"], 1902.5) and math.isclose(row["skewness"], 1.49753670333352) and math.isclose(row["kurtosis"], 0.24671648930016365)
    empty = stats.reduce_statistics(stats.partial_statistics(df.limit(0))).first()
    assert empty["count"] == 0 and empty["mean"] is None and empty["kurtosis"] is None
    with pytest.raises(TypeError):
        stats.partial_statistics(spark.createDataFrame([("x",)], "s string"), ["s"])


def test_partials_merge_in_any_grouping(spark):
    df = spark.range(200).select((F.col("id") % 17).cast("double").alias("v"), (F.col("id") % 3).alias("a"), (F.col("id") % 5).alias("b"))
    one = stats.reduce_statistics(stats.partial_statistics(df, ["v"])).first()
    two = stats.reduce_statistics(stats.partial_statistics(df, ["v"], by=["a", "b"])).first()
    assert one == two


def test_bbox_counts_twice_and_exact_once(spark):
    pts = dggs.with_cell(spark.createDataFrame([(40.0, 0.0), (10.0, 5.0)], "X double, Y double").withColumn("Z", F.lit(1.0)), resolution=1)
    cells = spark.createDataFrame([("Q3",), ("Q4",)], "region_code string")
    assert workflows.dataset_statistics(pts, cells, ["Z"]).first()["count"] == 2
    assert workflows.dataset_statistics(pts, cells, ["Z"], mode="bbox").first()["count"] == 2
    assert workflows.dataset_statistics(pts, cells.union(spark.createDataFrame([("Q",)])), ["Z"], mode="bbox").first()["count"] == 4


def filled(polygon, size):
    """Lattice cells inside a polygon with holes, by the even-odd rule; its rings' areas add up to their number."""
    rings = [[(p["x"], p["y"]) for p in r] for r in (polygon["outer"], *polygon["holes"])]
    inside = {(c, r) for c in range(size) for r in range(size) if sum(1 for ring in rings for (x, y1), (_, y2) in zip(ring, ring[1:] + ring[:1], strict=True) if x <= c and min(y1, y2) <= r < max(y1, y2)) % 2}
    turns = [sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True)) / 2 for r in rings]
    assert turns[0] > 0 and all(t < 0 for t in turns[1:]) and sum(turns) == len(inside) == polygon["area"]
    assert all((a[0] == b[0]) != (b[0] == c[0]) for r in rings for a, b, c in zip(r, r[1:] + r[:1], r[2:] + r[:2], strict=True))  # it turns at every corner
    return inside


def parts_of(cells):
    """4-connected components."""
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            c, r = todo.pop()
            part.add((c, r))
            for n in ((c + 1, r), (c - 1, r), (c, r + 1), (c, r - 1)):
                if n in left:
                    left.remove(n)
                    todo.append(n)
        out.append(part)
    return sorted(map(sorted, out))


def code_of(face, c, r, resolution):
    return face + "".join(str(r // 3**k % 3 * 3 + c // 3**k % 3) for k in reversed(range(resolution)))


RINGED = {(c, r) for c in range(9) for r in range(9)} - {(1, 1), (1, 3), (3, 3), (3, 4), (4, 4), (6, 6), (7, 7), (7, 1)}
NESTED = {(c, r) for c in range(9) for r in range(9) if max(abs(c - 4), abs(r - 4)) in (4, 2, 0)}


@pytest.mark.parametrize("cells", [RINGED, NESTED, {(c, r) for c, r in np.random.default_rng(4).integers(0, 9, (45, 2)).tolist()}, {(2, 2)}], ids=["holes", "nested", "random", "one"])
def test_dissolved_polygons(spark, cells):
    df = spark.createDataFrame([(code_of("N", c, r, 2),) for c, r in cells], "region_code string")
    got = coverage.polygons(df, 2).collect()
    assert sorted(sorted(filled(p, 9)) for p in got) == parts_of(cells)


def test_dissolve_over_tiles_and_faces(spark):
    cells = spark.createDataFrame([("O2",), ("O5",), ("P0",), ("P3",), ("S4",), ("S5",)], "region_code string")
    got = {r["face"]: r for r in coverage.dissolve(cells, 1).collect()}
    assert {f: r["area"] for f, r in got.items()} == {"E": 4, "S": 2} and len(got["E"]["outer"]) == 4 and not got["E"]["holes"]
    assert {round(v["x"]) for v in got["E"]["outer"]} == {-120, -60}
    shape = coverage.multipolygon(coverage.dissolve(cells, 1)).first()["geometry"]
    import json

    made = json.loads(shape)
    assert made["type"] == "MultiPolygon" and len(made["coordinates"]) == 2 and made["coordinates"][0][0][0] == made["coordinates"][0][0][-1]


def test_hexagon_outline(spark):
    bins = spark.createDataFrame([(0, 0, 5), (1, 0, 1), (5, 5, 1)], "q long, r long, count long")
    sides = coverage.hexbin_outline(bins, 2.0).toPandas()
    assert len(sides) == 10 + 6 and np.allclose(np.hypot(sides.x2 - sides.x1, sides.y2 - sides.y1), 2.0)
    ends = [(x, y) for r in sides.itertuples() for x, y in ((r.x1, r.y1), (r.x2, r.y2))]
    assert all(ends.count(e) == 2 for e in ends)  # closed, with equal ends
    assert math.isclose(sum(r.x1 * r.y2 - r.x2 * r.y1 for r in sides.itertuples()) / 2, 3 * 3**1.5 / 2 * 4)
    assert coverage.hexbin_outline(bins, 2.0, least=2).count() == 6
    odd = spark.createDataFrame([(float("nan"), 1.0), (None, 1.0), (float("inf"), 0.0), (0.1, 0.1)], "X double, Y double")
    assert [tuple(r) for r in coverage.hexbin(odd, 1.0).collect()] == [(0, 0, 1)]


def test_boxes_are_looked_up_in_squares_of_their_size(spark):
    r = np.random.default_rng(8)
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in 147 + r.uniform(0, 0.02, (1000, 2))], "X double, Y double").withColumns({"gx": F.lit(7), "n": F.monotonically_increasing_id()})
    corner = 147 + r.uniform(0, 0.02, (500, 2))
    boxes = spark.createDataFrame([(k, float(x), float(x + 0.0005), float(y), float(y + 0.0004 * (1 + k % 3))) for k, (x, y) in enumerate(corner)], "box_id long, min_x double, max_x double, min_y double, max_y double")
    p, b = pts.toPandas(), boxes.toPandas()
    want = sum(((p.X >= x.min_x) & (p.X <= x.max_x) & (p.Y >= x.min_y) & (p.Y <= x.max_y)).sum() for x in b.itertuples())
    got = stats.bbox_join(pts, boxes)
    assert got.count() == want > 300 and "gx" in got.columns
    assert stats.bbox_candidates(pts, boxes).count() < 12 * want
    odd = pts.limit(1).select(F.lit(float("nan")).alias("X"), F.lit(1.0).alias("Y"))
    assert stats.bbox_join(odd.union(odd.select(F.lit(None).cast("double"), "Y")), boxes.limit(1).withColumn("min_x", F.lit(-200.0))).count() == 0
    with pytest.raises(ValueError, match="reserved"):
        stats.bbox_join(pts.withColumn("sg_x", F.lit(1)), boxes)


def test_global_ranks_without_a_global_window(spark):
    df = spark.range(1003).select(((F.col("id") * 7919) % 1003).alias("k")).repartition(7)
    ids = planning.row_offsets(df, ["k"])
    assert ids.where("k <> row_id").count() == 0 and ids.count() == 1003
    blocks = {r["block"]: r["n"] for r in planning.scatter(df, 14, ["k"]).groupBy("block").agg(F.count("*").alias("n")).collect()}
    assert [blocks[k] for k in range(1, 15)] == [72] * 9 + [71] * 5
    assert planning.lanes(df, ["k"], 40).where("lane <> k % 40").count() == 0
    assert planning.scatter(df.limit(2), 4, ["k"]).agg(F.max("block")).first()[0] == 2 and planning.row_offsets(df.limit(0), ["k"]).count() == 0
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in plan and "ntile" not in plan


def test_upsert_keeps_columns_and_null_keys(spark):
    old = spark.createDataFrame([(1, "a", 30), (2, "b", 40), (None, "c", 50), (None, "d", 60)], "k long, v string, age int")
    new = spark.createDataFrame([(2, "z", 1.5), (3, "y", 2.5)], "k long, v string, extra double")
    got = {(r["k"], r["v"]): (r["age"], r["extra"]) for r in planning.upsert(old, new, ["k"]).collect()}
    assert got == {(1, "a"): (30, None), (2, "z"): (None, 1.5), (3, "y"): (None, 2.5), (None, "c"): (50, None), (None, "d"): (60, None)}


def test_splits_keep_unknown_files(spark):
    files = spark.createDataFrame([("a", None, None), ("b", 9e9, 0)], "f string, size double, record_count int")
    assert [x.count() for x in (*planning.split_empty(files), *planning.split_large(files, 1))] == [1, 1, 1, 1]


def test_scatter_and_planning(spark):
    blocks = planning.scatter(spark.range(14), 4, ["id"]).groupBy("block").count().orderBy("block")
    assert [r["count"] for r in blocks.collect()] == [4, 4, 3, 3]
    files = spark.createDataFrame([("a", 1048576.0, 0), ("b", 1048577.0, 2)], "f string, size double, record_count int")
    assert [x.count() for x in (*planning.split_empty(files), *planning.split_large(files, 1))] == [1, 1, 1, 1]


def test_text_functions(spark):
    df = spark.createDataFrame([("Survey (General)", "a, 1.5"), ("(X) ", "UNKNWN"), ("A B", "1,2"), ("k", "No"), ("m", "7")], "n string, v string")
    rows = df.select(text.standardise_name(F.col("n")).alias("n"), text.parameter_value(F.col("v")).alias("p")).collect()
    assert [r["n"] for r in rows] == ["survey_general", "x", "a_b", "k", "m"]
    assert [r["p"]["kind"] for r in rows] == ["numbers", "text", "unknowns", "flag", "number"]
    when = spark.createDataFrame([("2020-01-02",), ("3/4/2021",), ("nonsense",)], "v string").select(text.parse_when(F.col("v")).alias("t")).collect()
    assert [r["t"] and r["t"].year for r in when] == [2020, 2021, None]
    assert spark.range(1).select(text.drop_example(F.lit("e.g. abc… value")).alias("v")).first()["v"] == "value"


@pytest.mark.parametrize(("value", "kind", "want"), [("1d", "text", "1d"), ("5F", "text", "5f"), ("1e5", "text", "1e5"), ("nan", "text", "nan"), ("Infinity", "text", "infinity"), ("7", "number", 7.0), (" -7 ", "number", -7.0), ("1_000", "number", 1000.0), ("1.5", "number", 1.5), ("1.5e3", "number", 1500.0), ("1.5d", "text", "1.5d"), (".5", "number", 0.5), ("v1.2", "text", "v1.2"), ("0x10", "text", "0x10"), ("YES", "flag", "true"), ("Unknwn", "text", "unknown"), ("1.5,nan,x", "numbers", None), ("", "text", "")])
def test_parameter_values(spark, value, kind, want):
    x = spark.range(1).select(text.parameter_value(F.lit(value)).alias("x")).first()["x"]
    assert x["kind"] == kind and (x["numbers"][0] == 1.5 and math.isnan(x["numbers"][1]) and x["numbers"][2] is None if kind == "numbers" else x["number" if kind == "number" else "text"] == want)


def test_dates_as_people_write_them(spark):
    want = {"3/4/2020": (2020, 3, 4), "25/12/2020": (2020, 12, 25), "March 4, 2020": (2020, 3, 4), "2020-03-04T05:06Z": (2020, 3, 4), "4 Mar 2020 10:30": (2020, 3, 4), "2020-03-04 05:06:07": (2020, 3, 4), "20200304": (2020, 3, 4), "soon": None, "": None}
    df = spark.createDataFrame([(k,) for k in [*want, None]], "v string").select("v", text.parse_when(F.col("v")).alias("t"))
    got = {r["v"]: r["t"] and (r["t"].year, r["t"].month, r["t"].day) for r in df.collect()}
    assert got == {**want, None: None}


def test_examples_stand_in_field_names(spark):
    rows = spark.createDataFrame([(3, "Survey (General)", "Mandatory", "e.g. x… Survey Title", "Reef … part two"), (4, "Survey (General)", None, "Key words (Keyword)", "a,b"), (5, "Survey (General)", None, "Keyword list", "c")], "position int, sheet string, requirement string, field string, value string")
    got = {r["field"]: r["values"] for r in metadata.harvest(rows).collect()}
    assert got == {"survey_title": ["Reef … part two"], "keywords": ["a", "b", "c"]}


def test_date_cells_of_spreadsheets(tmp_path):
    import io
    import zipfile

    main, rel = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {main}><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm"/><numFmt numFmtId="171" formatCode="0.00&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {main}><sheetData><row r="1"><c r="A1" s="1"><v>43831</v></c><c r="B1" s="2"><v>43831.25</v></c><c r="C1" s="3"><v>43831</v></c><c r="D1"><v>43831</v></c><c r="E1" s="1"><v>1</v></c></row></sheetData></worksheet>')
    assert xlsx.sheet_cells(held.getvalue())["S"][1] == {"A": "2020-01-01 00:00:00", "B": "2020-01-01 06:00:00", "C": "43831", "D": "43831", "E": "1900-01-01 00:00:00"}


def test_logs_are_read_by_ranges(spark, log):
    plan = gsf.plan(spark, log + "/a.gsf", step=2).orderBy("first").collect()
    assert [(r["first"], r["last"], r["pings"], r["beams"]) for r in plan] == [(0, 2, 2, 5), (2, 4, 2, 5), (4, 5, 1, 2)]
    assert [r["scales"].get(1) and r["scales"][1]["multiplier"] for r in plan] == [None, 100, 10]  # those in force before each range
    whole, ranged = (gsf.soundings(gsf.read_records(spark, log + "/a.gsf", step=k)).orderBy("ping_number", "beam_number").toPandas() for k in (2000, 1))
    files = gsf.decode(spark.read.format("binaryFile").load(log + "/a.gsf"))
    in_memory = gsf.soundings(files).orderBy("ping_number", "beam_number").toPandas()
    assert whole.drop(columns="path").equals(ranged.drop(columns="path")) and whole.drop(columns="path").equals(in_memory.drop(columns="path"))
    assert gsf.read_records(spark, log + "/a.gsf", step=1, per_task=1).rdd.getNumPartitions() == 5
    assert [r["ping_number"] for r in gsf.read_record(spark, log + "/a.gsf", "ping", 3).collect()] == [3]
    assert {r["path"].rsplit("/", 1)[1]: (r["pings"], r["beams"]) for r in gsf.counts(spark, log).collect()} == {"a.gsf": (5, 12)}
    plan = gsf.soundings(gsf.read_records(spark, log + "/a.gsf"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Join" not in plan and "Window" not in plan
    index = gsf.index_of(spark.read.format("binaryFile").load(log))
    assert sorted(map(tuple, index.drop("path").collect())) == sorted(map(tuple, gsf.read_index(spark, log).drop("path").collect()))


def test_ingest_skips_empty_files(spark, log, tmp_path):
    bounds = workflows.ingest(spark, [log], str(tmp_path / "p"), str(tmp_path / "c"), 5)
    assert bounds.first()["end_datetime"].minute == 16 and spark.read.parquet(str(tmp_path / "p")).count() == 12
    with pytest.raises(ValueError, match="without pings"):
        workflows.ingest(spark, [log], str(tmp_path / "p2"), str(tmp_path / "c2"), 5, skip_empty=False)
    assert workflows.ingest(spark, [log + "/empty.gsf"], str(tmp_path / "p3"), str(tmp_path / "c3"), 5).first()["end_datetime"] is None


def test_totals_of_ingested_logs_are_exact(spark, tmp_path):
    """Depths are stored in single precision, where 100.35 lies below the half that the total is rounded at."""
    spark.createDataFrame([(70, 10035, 3, 1, "N")], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = con.execute(catalog.oracle_sql()["ingest_logs"]).df().iloc[0]
    got = catalog.queries()["ingest_logs"](spark, str(tmp_path)).first()
    assert want["total"] == 100.4 and got["total"] == want["total"] and got["points"] == got["counted"] == 1


def test_vector_formats():
    import struct

    from soundgrid.sources import vector

    square = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
    far = [(x + 10, y) for x, y in square]
    hole = [(11.0, 1.0), (12.0, 1.0), (12.0, 2.0), (11.0, 1.0)]
    points = b"".join(struct.pack("<2d", *p) for r in (square, far, hole) for p in r)
    shape = struct.pack("<i4d2i3i", 5, 0, 0, 14, 4, 3, 14, 0, 5, 10) + points
    file = struct.pack(">i", 9994).ljust(100, b"\0") + struct.pack(">2i", 1, len(shape) // 2) + shape
    import json

    made = json.loads(vector.first_geometry(file))
    assert made["type"] == "MultiPolygon" and [len(p) for p in made["coordinates"]] == [1, 2] and made["coordinates"][1][1] == [list(p) for p in hole]
    point = b"\0" + struct.pack(">I3d", 1001, 1.0, 2.0, 3.0)
    assert vector._from_wkb(point)[0] == {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}
    several = b"\1" + struct.pack("<2I", 4, 2) + 2 * (b"\1" + struct.pack("<I2d", 1, 5.0, 6.0))
    assert vector._from_wkb(several) == ({"type": "MultiPoint", "coordinates": [[5.0, 6.0]] * 2}, len(several))
    assert vector.first_geometry(b'{"features": []}') is None and json.loads(vector.first_geometry(b'{"type": "Point", "coordinates": [1, 2]}'))["type"] == "Point"
    with pytest.raises(ValueError):
        vector.first_geometry(b"no vector")


def test_outlines_and_centres_by_array(spark):
    df = spark.createDataFrame([([5.0, -1.0, 1.0], [0.0, 0.0, 0.0], 0), ([5.0, -1.0, 1.0], [0.0, 1.0, 0.0], 0), ([float("nan"), 3.0], None, 0), ([1.0], [0.0], 1), ([], [], 0), (None, None, 0)], "a array<double>, f array<double>, p int")
    assert [r[0] for r in df.select(navigation.centre_of_arrays(F.col("a"), F.col("f"), F.col("p"))).collect()] == [1, 2, None, None, None, None]


def test_reference_systems_are_overridden(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "X double, Y double")
    assert metadata.crs_info(df) == {"horizontal_datum": "epsg:4326"}
    once = metadata.crs_column(df, {"horizontal_datum": "epsg:4283"})
    assert metadata.crs_info(metadata.crs_column(once, {"horizontal_datum": "epsg:7844"}))["horizontal_datum"] == "epsg:7844"


def test_own_column_names_are_reserved(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "X double, Y double, sg_code int")
    with pytest.raises(ValueError, match="reserved"):
        dggs.with_cell(df)
    assert dggs.with_cell(df.withColumnRenamed("sg_code", "dggs__code")).columns == ["X", "Y", "dggs__code", "region_code"]
    with pytest.raises(ValueError, match="reserved"):
        planning.upsert(df.withColumnRenamed("sg_code", "sg_age"), df.withColumnRenamed("sg_code", "sg_age"), ["X"])


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from soundgrid import shared

    class Sc:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isEmpty": lambda self: True})()})()})()

        def getConf(self):
            return {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.shared_dir(type("Session", (), {"sparkContext": Sc()})())
    folder = shared.scratch(spark, "x")
    spark.range(1).write.parquet(folder)
    assert sinks.exists(spark, folder)
    kept = shared._SCRATCH[:]
    shared._SCRATCH[:] = [folder]
    shared.release(spark)
    shared._SCRATCH[:] = kept[:-1]
    assert not sinks.exists(spark, folder)


def test_schema(spark):
    assert required_schema(["pitch", "Z", "nope"], ["ping_number", "beam_number"]).names == ["ping_number", "beam_number", "Z", "pitch"]
    got = coerce_soundings(spark.createDataFrame([(1.0, None, 7)], "X double, beam_flags int, extra int"))
    assert got.columns == list(SOUNDINGS) and got.first()["beam_flags"] == 255 and math.isnan(got.first()["Z"])


@pytest.fixture(scope="module")
def log(tmp_path_factory):
    d = tmp_path_factory.mktemp("gsf")
    (d / "a.gsf").write_bytes(gsf_files.whole_file())
    (d / "empty.gsf").write_bytes(gsf_files.record(1, b"GSF-v03.09\0\0"))
    return str(d)


def test_gsf_index_and_sidecar(spark, log, tmp_path):
    index = gsf.read_index(spark, log)
    assert {r["record_name"]: r["count"] for r in index.where("path like '%a.gsf'").groupBy("record_name").count().collect()}["GSF_SWATH_BATHYMETRY_PING"] == 5
    sinks.write_sidecars(gsf.sidecar(index, ["X"]), str(tmp_path / "s"))
    known = gsf.read_sidecar(spark, str(tmp_path / "s"))
    assert sorted((r["record_count"], len(r["size"].__str__()) > 0) for r in gsf.file_manifest(known).collect()) == [(0, True), (5, True)]
    full, empty = planning.split_empty(gsf.file_manifest(known))
    assert full.count() == empty.count() == 1
    assert full.first()["size"] == len(gsf_files.whole_file())
    assert sorted(len(r["bathymetry_ping_schema"]) for r in known.collect()) == [0, 1]


def test_gsf_pings_and_soundings(spark, log):
    pings = gsf.read_records(spark, log + "/a.gsf")
    assert [r["num_beams"] for r in pings.orderBy("ping_number").collect()] == [3, 2, 1, 4, 2]
    s = gsf.soundings(pings).orderBy("ping_number", "beam_number").toPandas()
    assert len(s) == 12 and list(s.columns) == [*SOUNDINGS, "path"]
    assert s.Z.tolist()[:5] == pytest.approx([10.0, 10.1, 10.2, 10.01, 10.11], abs=1e-4)
    assert s.Z.tolist()[6] == pytest.approx(100.3, abs=1e-3)  # new factors from ping 3 on
    assert s.across_track.tolist()[:3] == pytest.approx([-15, -5, 5])
    assert s.centre_beam.tolist() == [0, 1, 0, 0, 1, 0, 0, 1, 0, 0, 0, 0]  # ties go to the first beam; flagged pings and beams have none
    assert s[s.ping_number == 4].beam_flags.tolist() == [255, 255]
    assert s.Y[0] == pytest.approx(-43.0) and s.X[0] == pytest.approx(147.0 - 15 / (111412.84 * math.cos(math.radians(43)) - 93.5 * math.cos(math.radians(129)) * 1 + 0.118 * math.cos(math.radians(215))), abs=1e-7)
    part = gsf.soundings(gsf.read_records(spark, log + "/a.gsf", first=1, last=3)).toPandas()
    want = s[s.ping_number.isin([1, 2])].reset_index(drop=True)
    assert part.sort_values(["ping_number", "beam_number"]).reset_index(drop=True).Z.tolist() == want.Z.tolist()


def test_gsf_other_records(spark, log):
    read = lambda kind: gsf.read_records(spark, log + "/a.gsf", kind).collect()
    assert read("header")[0]["version"] == "GSF-v03.09"
    assert [round(r["pitch"], 2) for r in read("attitude")] == [1.0, 0.0]
    assert [(r["X"], r["depth"], r["sound_velocity"]) for r in read("svp")] == [(147.0, 1.0, 1500.0), (147.0, 2.0, 1499.0)]
    p = read("processing_parameters")[0]
    assert p["parameters"] == {"draft_to_apply": "1.5,2.5", "roll_compensated": "YES"} and p["processed_datetime"].second == 15
    assert read("comment")[0]["comment"] == "hello"
    assert (read("history")[0]["operator_name"], read("history")[0]["comment"]) == ("me", "done")
    assert (read("summary")[0]["min_x"], read("summary")[0]["max_z"]) == (147.0, 50.0)
    with pytest.raises(NotImplementedError):
        gsf.read_records(spark, log, "single_beam")


def test_missing_scale_factors(spark, tmp_path):
    (tmp_path / "b.gsf").write_bytes(gsf_files.record(2, gsf_files.ping(1, 0, 0, gsf_files.beams(2))))
    with pytest.raises(Exception, match="no scale factors"):
        gsf.read_records(spark, str(tmp_path / "b.gsf")).collect()


def test_ingest_and_tables(spark, log, tmp_path):
    d = str(tmp_path)
    bounds = workflows.ingest(spark, [log + "/a.gsf"], d + "/points", d + "/cells", 9).first()
    assert bounds["end_datetime"].minute == 16
    cells = spark.read.parquet(d + "/cells")
    assert cells.agg(F.sum("count")).first()[0] == 12
    assert cells.where(dggs.code_filter("S3")).agg(F.sum("count")).first()[0] == 12 and cells.where(dggs.code_filter("N")).count() == 0
    points = spark.read.parquet(d + "/points")
    keyed = points.withColumn("file_id", F.lit(1)).select("file_id", "ping_number", "beam_number", "Z")
    for _ in range(2):  # a rerun replaces
        sinks.upsert_ping_beam(spark, keyed, d + "/dense")
    assert spark.read.parquet(d + "/dense").count() == 12
    sinks.upsert_ping_beam(spark, keyed.where("ping_number = 0").withColumn("Z", F.lit(5.0).cast("float")), d + "/dense")
    assert spark.read.parquet(d + "/dense").where("Z = 5").count() == 3 and spark.read.parquet(d + "/dense").count() == 12
    sinks.combine(spark, [d + "/points", d + "/points"], d + "/both")
    assert spark.read.parquet(d + "/both").count() == 24
    sinks.write_dense(keyed, d + "/rows", ["ping_number", "beam_number"])
    assert sorted(r["row_id"] for r in spark.read.parquet(d + "/rows").collect()) == list(range(12))
    cells.select("region_code", "count").write.parquet(d + "/more")
    merged = aggregate.load_and_merge(spark, [d + "/more", d + "/cells"])
    assert merged.agg(F.sum("count")).first()[0] == 24
    assert workflows.footprint(points, 9).count() >= 1


def _xlsx(path):
    import zipfile

    label = metadata.VALUE_LABEL
    rows = [["title"], ["Requirement", metadata.FIELD_LABELS[0], label], ["Mandatory", "Lineage", "made"], [None, "Survey Title", "T"], ["Inherited", "Abstract", "no"], ["Optional", "Keywords (x)", "a,b"], ["Optional", "Start DateTime", "2020-01-02"], ["Optional", "Empty", None]]
    cell = lambda c, r, v: f'<c r="{c}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if v else ""
    sheet = "".join(f'<row r="{n}">' + "".join(cell("ABC"[k], n, v) for k, v in enumerate(r)) + "</row>" for n, r in enumerate(rows, 1))
    main, rel = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="Survey (General)" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")


def test_form_and_item(spark, tmp_path):
    _xlsx(tmp_path / "f.xlsx")
    fields = metadata.harvest(xlsx.read_form(spark, str(tmp_path / "f.xlsx")))
    got = {r["field"]: r["values"] for r in fields.collect()}
    assert got == {"lineage": ["made"], "survey_title": ["T"], "keywords": ["a", "b"], "start_datetime": ["2020-01-02"]}
    pts = spark.createDataFrame([(1.0, 2.0, 3.0), (4.0, 5.0, 6.0)], "X double, Y double, Z double").withColumn("timestamp", F.to_timestamp(F.lit("2020-01-01")))
    (tmp_path / "c.geojson").write_text('{"features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}]}')
    geometry = geojson.first_geometry(spark, str(tmp_path / "c.geojson")).first()[0]
    more = spark.createDataFrame([("survey_general", "abstract", ["A"]), ("survey_citation", "data_owner", ["O"]), ("survey_citation", "custodian", ["C"]), ("survey_citation", "attribution_citation", ["cite"]), ("bathymetry_technical", "sensor_type", ["S"])], "sheet string, field string, values array<string>")
    item = metadata.stac_item(spark, "id1", stats.basic_statistics(pts, ["X", "Y", "Z"]), aggregate.time_bounds(pts), fields.select("sheet", "field", "values").unionByName(more), F.lit(geometry), pts.schema, {"model": "M"}, {"horizontal_datum": "epsg:4326"}, {"data": "d", "footprint": "f", "density": "n", "self": "s"})
    import json

    made = json.loads(item.first()["item"])
    assert made["bbox"] == [1, 2, 3, 4, 5, 6] and made["properties"]["proj:epsg"] == 4326 and made["properties"]["pc:count"] == 2
    assert made["properties"]["title"] == "T" and made["geometry"]["type"] == "Point" and made["properties"]["datetime"].startswith("2020-01-01")
    sinks.write_document(item, str(tmp_path / "item"))
    assert spark.read.text(str(tmp_path / "item")).count() == 1


def test_stream(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 3).cast("string").alias("region_code"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"), (F.col("id") % 2).alias("file_id"), F.col("id").alias("ping_number"), F.lit(0).alias("beam_number"), F.lit(1.0).alias("Z"))
    rows.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for name, df, mode in (("d1", density.running_density(source), "complete"), ("d2", density.windowed_density(source), "update")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
        assert spark.table(name).agg(F.sum("count")).first()[0] == 100


def test_cell_code_stays_in_generated_code(spark, sf):
    plan = catalog.queries()["cell_frequency"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "HashAggregate" in plan


def test_carry_forward_and_offsets(spark):
    df = spark.createDataFrame([("p", 0, 5, 2), ("p", 1, None, 3), ("p", 2, 7, 1)], "path string, i int, v int, num_beams int")
    assert [r["v"] for r in navigation.carry_forward(df, "v", ["path"], ["i"]).orderBy("i").collect()] == [5, 5, 7]
    assert [(r["start"], r["stop"]) for r in navigation.beam_offsets(df, ["path"], ["i"]).orderBy("i").collect()] == [(0, 2), (2, 5), (5, 6)]


def test_positional_zip_takes_the_whole_table(spark, sf):
    want = pd.read_parquet(f"{sf}/orders.parquet", columns=["o_orderkey", "o_custkey"]).sort_values("o_orderkey").reset_index(drop=True)
    got = catalog.queries()["positional_zip"](spark, sf).toPandas().sort_values("position").reset_index(drop=True)
    assert len(got) == len(want) > 500
    assert got["a"].tolist() == want["o_orderkey"].tolist() and got["b"].tolist() == want["o_custkey"].tolist() and got["position"].tolist() == list(range(len(want)))


def test_positions_over_group_borders(spark):
    df = spark.createDataFrame([(k,) for k in (9, -3, 4, None, 0, 8, 5)], "k long")
    got = planning.positions(df, "k", width=4).orderBy("position").collect()
    assert [(r.k, r.position) for r in got] == [(k, i) for i, k in enumerate((None, -3, 0, 4, 5, 8, 9))]


def square(code):
    """(x, y) of a cell's upper left corner and its width, in radians of the plane."""
    x0, y0 = (v * math.pi / 4 for v in dggs.CORNERS[code[0]])
    w = math.pi / 2
    for digit in map(int, code[1:]):
        w /= 3
        x0, y0 = x0 + digit % 3 * w, y0 - digit // 3 * w
    return x0, y0, w


def on_ellipsoid(x, y):
    """Longitude and latitude in degrees of a position in the plane; the latitude by bisection of the authalic one."""
    e, lon, sb = math.sqrt(dggs.E2), x, 8 * y / (3 * math.pi)
    if abs(y) > math.pi / 4 + 1e-12:
        u, v = x + 3 * math.pi / 4, abs(y) - math.pi / 2
        sigma = max(abs(u), abs(v)) * 4 / math.pi
        turn, along = (0, u) if v <= 0 and abs(u) <= -v + 1e-12 else (1, v) if u > 0 and abs(v) <= u + 1e-12 else (2, -u) if v > 0 and abs(u) <= v + 1e-12 else (3, -v)
        lon = (along / sigma if sigma else 0) - 3 * math.pi / 4 + turn * math.pi / 2
        sb = math.copysign(1 - sigma * sigma / 3, y)
    q = lambda s: (1 - dggs.E2) * (s / (1 - dggs.E2 * s * s) + math.atanh(e * s) / e)
    low, high = -1.0, 1.0
    for _ in range(60):
        s = (low + high) / 2
        low, high = (s, high) if q(s) < sb * q(1.0) else (low, s)
    return math.degrees(lon), math.degrees(math.asin(s))


def test_boxes_of_all_cells(spark, sf):
    rows = catalog.cells(spark, sf).select("X", "Y", "region_code").toPandas()
    got = catalog.queries()["geometry_slices"](spark, sf).toPandas().set_index("region_code")
    assert sorted(got.index) == sorted(rows["region_code"].unique()) and {"N", "S"} < set(got.index.str[0])
    compared = 0
    for code, box in got.iterrows():
        x, y, w = square(code)
        lon, lat = zip(*(on_ellipsoid(a, b) for a, b in ((x, y), (x + w, y), (x + w, y - w), (x, y - w))), strict=True)
        if max(abs(v) for v in lon) < 180 - 1e-9 and not set(code[1:]) == {"4"}:
            assert np.allclose(box[["min_x", "max_x", "min_y", "max_y"]].astype(float), [min(lon), max(lon), min(lat), max(lat)], rtol=0, atol=2e-6), code
            compared += code[0] in "NS"
    assert compared > 1000
    inside = rows.join(got, on="region_code")
    assert inside["X"].between(inside["min_x"] - 2e-6, inside["max_x"] + 2e-6).all() and inside["Y"].between(inside["min_y"] - 2e-6, inside["max_y"] + 2e-6).all()


def test_boxes_at_the_pole_and_at_longitude_180(spark):
    df = spark.createDataFrame([("N44",), ("S44",), ("N62",), ("N446462",), ("S408888",)], "c string").select("c", boundary.cell_bbox(F.col("c")).alias("b"))
    got = {r["c"]: tuple(r["b"]) for r in df.collect()}
    assert got["N44"][:2] == got["S44"][:2] == got["N62"][:2] == (-180.0, 180.0) and got["N44"][3] == 90.0 and got["S44"][2] == -90.0
    assert all(170 < got[c][0] < got[c][1] <= 180 or -180 <= got[c][0] < got[c][1] < -170 or got[c][:2] == (-180.0, 180.0) for c in ("N446462", "S408888"))


def test_outline_edges_of_all_cells(spark, sf):
    codes = {r[0] for r in catalog.cells(spark, sf, 3).select("region_code").distinct().collect()}
    edges = set()
    for code in codes:
        n = m = 0
        for digit in map(int, code[1:]):
            n, m = 3 * n + digit % 3, 3 * m + digit // 3
        face, n = ("E", n + 27 * "OPQR".index(code[0])) if code[0] in "OPQR" else (code[0], n)
        edges |= {(face, n, m, n + 1, m), (face, n + 1, m, n + 1, m + 1), (face, n + 1, m + 1, n, m + 1), (face, n, m + 1, n, m)}
    want = {e for e in edges if (e[0], e[3], e[4], e[1], e[2]) not in edges}
    got = [tuple(r) for r in catalog.queries()["dissolve_boundary_edges"](spark, sf).select("face", "x1", "y1", "x2", "y2").collect()]
    assert len(got) == len(want) and set(got) == want


def test_beams_near_the_poles(spark, sf):
    keys = ["ping_number", "beam_number", "l_partkey", "l_suppkey"]
    s = catalog.soundings(spark, sf).toPandas().sort_values(keys).reset_index(drop=True)
    got = catalog.queries()["beam_lon_lat"](spark, sf).toPandas().sort_values(keys).reset_index(drop=True)
    assert len(got) == len(s) and (s["Y"].abs() >= 80).sum() > 100
    p, h = np.radians(s["Y"].astype(float)), np.radians(s["heading"].astype(float))
    per_lon = 111412.84 * np.cos(p) - 93.5 * np.cos(3 * p) + 0.118 * np.cos(5 * p)
    per_lat = 111132.92 - 559.82 * np.cos(2 * p) + 1.175 * np.cos(4 * p) - 0.0023 * np.cos(6 * p)
    across, along = s["across_track"].astype(float), s["along_track"].astype(float)
    assert np.allclose(got["beam_x"], s["X"] + (np.cos(h) * across + np.sin(h) * along) / per_lon, rtol=1e-9, atol=2e-6)
    assert np.allclose(got["beam_y"], s["Y"] + (np.cos(h) * along - np.sin(h) * across) / per_lat, rtol=1e-9, atol=2e-6)
