"""Named intermediate values inside one column, so that an expression that uses one often does not repeat it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """body(struct of values), each value computed once."""
    return F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), body)[0]
