"""Vector coverage files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def geometries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, geometry (JSON text) of the first feature of each feature collection."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), F.get_json_object("value", "$.features[0].geometry").alias("geometry")).where("geometry is not null")


def first_geometry(spark: SparkSession, path: str) -> DataFrame:
    """(geometry as JSON text) of the first feature of a feature collection."""
    return geometries(spark, path).select("geometry").limit(1)
