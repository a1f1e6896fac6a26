"""Names, processing parameters and spreadsheet values."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def standardise_name(name: Column) -> Column:
    """Lower case, spaces to underscores, no brackets, at most one underscore off either end."""
    return F.regexp_replace(F.regexp_replace(F.translate(F.lower(name), " ()", "_"), "^_", ""), "_$", "")


def parameter_key(key: Column) -> Column:
    return F.replace(F.lower(key), F.lit(" "), F.lit("_"))


_INTEGER = r"^\s*[+-]?\d+(_\d+)*\s*$"
_DECIMAL = r"^\s*[+-]?(\d+(_\d+)*\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _decimal(value: Column) -> Column:
    """A number as written in text, null for anything else: no type suffixes, no hexadecimals; nan and inf by name."""
    low = F.lower(F.trim(value))
    named = F.when(low.rlike(r"^[+-]?(nan|inf|infinity)$"), F.regexp_replace(F.regexp_replace(low, "^\\+", ""), "^(-?)inf$", "$1infinity").try_cast("double"))
    return F.when(value.rlike(_DECIMAL), F.replace(F.trim(value), F.lit("_"), F.lit("")).try_cast("double")).otherwise(named)


def parameter_value(value: Column) -> Column:
    """Struct (kind, text, number, numbers) of a processing parameter's text; exactly one of the last three is set.

    A comma list gives numbers if it holds a point, else as many "unknown"; with a point a number, without one an integer, if it is written as one; yes, no,
    true, false a flag as text; anything else its lower case (`1d`, `1e5` and `nan` are text: no point, and no integer).
    """
    low = F.lower(F.trim(value))
    parts = F.split(value, ",")
    listed, point = F.contains(value, F.lit(",")), F.contains(value, F.lit("."))
    numbers = F.when(listed & point, F.transform(parts, _decimal))
    number = F.when(~listed & point, _decimal(value)).when(~listed & value.rlike(_INTEGER), F.replace(F.trim(value), F.lit("_"), F.lit("")).try_cast("double"))
    flag = F.when(low.isin("yes", "true"), "true").when(low.isin("no", "false"), "false")
    unknown = F.when(listed, F.array_join(F.transform(parts, lambda p: F.lit("unknown")), ",")).when(low.isin("unknwn", "unknown"), "unknown")
    kind = F.when(numbers.isNotNull(), "numbers").when(listed, "unknowns").when(number.isNotNull(), "number").when(flag.isNotNull(), "flag").otherwise("text")
    return F.struct(kind.alias("kind"), F.when(kind == "flag", flag).when(kind.isin("unknowns", "text"), F.coalesce(unknown, low)).alias("text"), F.when(kind == "number", number).alias("number"), numbers.alias("numbers"))


def split_keywords(value: Column) -> Column:
    return F.split(value, ",")


def drop_example(name: Column) -> Column:
    """A field's name up to an ellipsis character is an example in the form; it goes with the character after it."""
    return F.regexp_replace(name, "(?s)^.*?….?", "")


def parse_when(value: Column) -> Column:
    """Timestamp of a date as people write it, null if it is none: month before day where both could be meant; what is left out is that of 1970-01-01 00:00.

    The usual forms are built-in expressions; what none of them reads goes through the general parser (forms hold few values, so this is no hot path).
    """

    def parsed(values: pd.Series) -> pd.Series:
        from dateutil import parser

        def one(x):
            try:
                made = pd.Timestamp(parser.parse(x, default=dt.datetime(1970, 1, 1)))
                return made if made.tzinfo is None else made.tz_convert("UTC").tz_localize(None)
            except (ValueError, OverflowError, TypeError):
                return pd.NaT

        return pd.Series([one(x) for x in values], dtype="datetime64[ns]")

    forms = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy HH:mm:ss", "M/d/yyyy", "yyyy/DDD HH:mm:ss")
    usual = F.coalesce(*(F.try_to_timestamp(value, F.lit(f)) for f in forms))
    return F.coalesce(usual, F.pandas_udf(parsed, "timestamp")(F.when(usual.isNull(), value)))
