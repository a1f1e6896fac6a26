"""Sends this package to the executors, for sessions whose workers do not have it on their path."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application; a copy that is already on the workers' path does no harm."""
    sc = spark.sparkContext
    if sc.applicationId in _SENT:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="soundgrid-")) / "soundgrid.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(str(target))
    _SENT.add(sc.applicationId)
