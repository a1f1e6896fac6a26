"""Survey metadata: the spreadsheet's fields, schema descriptions and the STAC item."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soundgrid.functions.text import drop_example, parse_when, split_keywords, standardise_name

# fixed values: sheets and column labels of the survey form
SHEETS = ("Survey (General)", "Survey (Citation)", "Survey (Details)", "Survey (Technical)", "Bathymetry (General)", "Bathymetry (Citation)", "Bathymetry (Details)", "Bathymetry (Technical)")
FIELD_LABELS = ("Survey/Mission Attributes", "Bathy Metadata Attributes")
VALUE_LABEL = "User entered (some defaults pre-entered)"


def entered_rows(rows: DataFrame) -> DataFrame:
    """Rows (sheet, position, requirement, field, value) that hold an entry of their own: not inherited (no requirement counts as not), and with a value."""
    return rows.where(~F.col("requirement").eqNullSafe("Inherited") & F.col("value").isNotNull())


def clean_fields(rows: DataFrame) -> DataFrame:
    """sheet, field, values (array of text in sheet order), when (timestamp of a datetime field).

    A field whose name says keywords is `keywords`, its values split at commas; of another field's name an example (up to an ellipsis) goes.
    Rows of one field are put together.
    """
    keyword = F.contains(F.lower("field"), F.lit("keyword"))
    name = F.when(keyword, "keywords").otherwise(standardise_name(drop_example(F.col("field"))))
    made = rows.withColumn("name", name).withColumn("parts", F.when(keyword, split_keywords(F.col("value"))).otherwise(F.array("value")))
    grouped = made.groupBy(standardise_name(F.col("sheet")).alias("sheet"), F.col("name").alias("field")).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("position", "parts"))), lambda s: s["parts"])).alias("values"))
    return grouped.withColumn("when", F.when(F.contains(F.col("field"), F.lit("datetime")), parse_when(F.col("values")[0])))


def harvest(rows: DataFrame) -> DataFrame:
    return clean_fields(entered_rows(rows))


def harvest_map(fields: DataFrame) -> Column:
    """Aggregate: sheet -> field -> values."""
    return F.map_from_entries(F.collect_list(F.struct("sheet", "fields")))


def crs_column(df: DataFrame, crs: dict[str, str], column: str = "X") -> DataFrame:
    """`df` whose reference systems are kept in the metadata of a column, which Parquet tables carry; a later call overrides them.  The default is EPSG:4326."""
    return df.withMetadata(column, {"crs_info": json.dumps(crs)})


DEFAULT_CRS = {"horizontal_datum": "epsg:4326"}


def crs_info(df: DataFrame, column: str = "X") -> dict[str, str]:
    """Reference systems of a table as `crs_column` left them."""
    found = df.schema[column].metadata.get("crs_info")
    return json.loads(found) if found else dict(DEFAULT_CRS)


def table_info(df: DataFrame) -> DataFrame:
    """One row: points, bounds, dimensions and reference systems of a point table, in one scan."""
    fine = lambda c: F.nanvl(F.col(c), F.lit(None))
    bounds = [f(fine(c)).alias(f"{n}_{c.lower()}") for n, f in (("min", F.min), ("max", F.max)) for c in ("X", "Y", "Z") if c in df.columns]
    return df.agg(F.count("*").alias("num_points"), *bounds).withColumns({"dimensions": F.lit(", ".join(df.columns)), "crs": F.lit(json.dumps(crs_info(df)))})


def describe_schema(schema: T.StructType) -> list[dict]:
    """name, size and type of each dimension and attribute."""
    kinds = {T.DoubleType: (8, "floating"), T.FloatType: (4, "floating"), T.LongType: (8, "signed"), T.IntegerType: (4, "signed"), T.ShortType: (2, "signed"), T.ByteType: (1, "signed")}
    sizes = {T.TimestampType: 8, T.TimestampNTZType: 8, T.BooleanType: 1}
    return [{"name": f.name, "size": kinds.get(type(f.dataType), (sizes.get(type(f.dataType), 0), ""))[0], "type": kinds.get(type(f.dataType), (0, "other"))[1]} for f in schema]


def stac_bbox(statistics: DataFrame) -> DataFrame:
    """bbox (minx, miny, minz, maxx, maxy, maxz) from rows of the attributes X, Y, Z."""
    pick = lambda side, a: F.max(F.when(F.col("attribute") == a, F.col(side)))
    return statistics.agg(F.array(*(pick(side, a) for side in ("minimum", "maximum") for a in "XYZ")).alias("bbox"))


def stac_item(spark, uid: str, statistics: DataFrame, bounds: DataFrame, fields: DataFrame, geometry: Column, schema: T.StructType, sonar: dict[str, str], crs: dict[str, str], links: dict[str, str], created: Column | None = None) -> DataFrame:
    """One row, one JSON text: the STAC item of a survey.

    `links` names data, footprint, density and self.  The item's time is the survey's end.
    """
    one = fields.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(".", "sheet", "field"), F.array_join("values", ",")))).alias("f"))
    text = lambda key: F.col("f")[key]
    stats = statistics.select(F.struct(F.col("attribute").alias("name"), *[c for c in statistics.columns if c != "attribute"]).alias("s")).agg(F.sort_array(F.collect_list("s")).alias("stats"), F.max(F.when(F.col("s.name") == "Z", F.col("s.count"))).alias("n"))
    row = one.join(stats).join(stac_bbox(statistics)).join(bounds)  # each is one row
    when = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    properties = {**{f"sonar:{k}": F.lit(v) for k, v in {**sonar, **crs}.items()}}
    properties |= {
        "processing:lineage": F.concat(text("survey_general.lineage"), F.lit("\nConverted GSF's to Parquet tables")),
        "datetime": when(F.col("end_datetime")),
        "title": text("survey_general.survey_title"),
        "description": text("survey_general.abstract"),
        "start_datetime": when(F.col("start_datetime")),
        "end_datetime": when(F.col("end_datetime")),
        "created": when(F.current_timestamp() if created is None else created),
        "instruments": F.array(text("bathymetry_technical.sensor_type")),
        "providers": F.array(*(F.struct(text(f"survey_citation.{k}").alias("name"), F.array(F.lit(role)).alias("roles")) for k, role in (("data_owner", "producer"), ("custodian", "host")))),
        "proj:epsg": F.substring(F.lit(crs["horizontal_datum"]), 6, 99).cast("int"),
        "pc:count": F.col("n"),
        "pc:type": F.lit("sonar"),
        "pc:encoding": F.lit("Parquet"),
        "pc:schemas": F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in d.items())) for d in describe_schema(schema))),
        "pc:statistics": F.col("stats"),
        "sci:citation": text("survey_citation.attribution_citation"),
    }
    asset = lambda key: F.struct(F.lit(links[key]).alias("href"), F.array(F.lit("data")).alias("roles"))
    item = F.struct(
        F.lit("Feature").alias("type"),
        F.lit("1.0.0").alias("stac_version"),
        F.lit(uid).alias("id"),
        F.struct(*(v.alias(k) for k, v in properties.items())).alias("properties"),
        F.parse_json(geometry).alias("geometry"),
        F.col("bbox"),
        F.array(F.struct(F.lit("self").alias("rel"), F.lit(links["self"]).alias("href"), F.lit("application/json").alias("type"))).alias("links"),
        F.struct(asset("data").alias("bathymetry_data"), asset("footprint").alias("data_footprint"), asset("density").alias("sounding_density")).alias("assets"),
        F.array(*(F.lit(f"https://stac-extensions.github.io/{n}/schema.json") for n in ("projection/v1.0.0", "pointcloud/v1.0.0", "scientific/v1.0.0"))).alias("stac_extensions"),
    )
    return row.select(F.to_json(item).alias("item"))
