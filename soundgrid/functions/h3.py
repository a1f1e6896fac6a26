"""H3 indexing, where the optional `h3` package is installed on the executors."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def h3_code(lon: Column, lat: Column, resolution: int = 15) -> Column:
    import h3  # optional

    cell = getattr(h3, "latlng_to_cell", None) or h3.geo_to_h3
    return F.pandas_udf(lambda x, y: pd.Series([cell(b, a, resolution) for a, b in zip(x, y, strict=True)]), "string")(lon, lat)


def h3_boundary(code: Column) -> Column:
    """GeoJSON polygon of a cell."""
    import h3  # optional

    ring = (lambda c: [[x, y] for y, x in h3.cell_to_boundary(c)]) if hasattr(h3, "cell_to_boundary") else (lambda c: [list(p) for p in h3.h3_to_geo_boundary(c, geo_json=True)])
    return F.pandas_udf(lambda cs: pd.Series([json.dumps({"type": "Polygon", "coordinates": [[*ring(c), ring(c)[0]]]}) for c in cs]), "string")(code)


def h3_cell_count(df: DataFrame, column: str = "h3_index") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))
