"""Streams of soundings (an extension: batch queries need none of it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_density(stream: DataFrame, window: str = "1 hour", late: str = "10 minutes", column: str = "region_code") -> DataFrame:
    """Counts per cell and time window; rows later than `late` are left out."""
    return stream.withWatermark("timestamp", late).groupBy(F.window("timestamp", window), column).agg(F.count("*").alias("count"))


def without_repeats(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each (file, ping, beam) once, if its repeats come within `late`."""
    return stream.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["file_id", "ping_number", "beam_number"])


def survey_lines(stream: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of soundings of a file with no gap of `gap`."""
    return stream.withWatermark("timestamp", late).groupBy(F.session_window("timestamp", gap), "file_id").agg(F.count("*").alias("count"), F.min("Z").alias("min_z"), F.max("Z").alias("max_z"))


def running_density(stream: DataFrame, column: str = "region_code") -> DataFrame:
    return stream.groupBy(column).agg(F.count("*").alias("count"))
