"""Parsing the feature document and reading typed values out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstar.schemas import FEATURE_SCHEMA

_EPOCH = "1970-01-01 00:00:00"
# Years 1 to 9999, the range of calendar dates with four-digit years.
EPOCH_MS_RANGE = (-62_135_596_800_000, 253_402_300_799_999)


def with_column_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``name`` = ``expr``, evaluated exactly once per row.

    Filters above a projection are pushed below it by substituting the
    projected expression, and JSON schema pruning then splits a parse into one
    parse per referenced field: a dozen rule checks over a parsed document
    would parse it a dozen times.  A one-element ``explode`` is a generator,
    which filters cannot be pushed through, so the document is parsed once and
    later expressions read fields of the result.  No row is added or lost
    (``array(NULL)`` still has one element).
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def parse_feature(text: Column | str) -> Column:
    """The feature JSON text as a struct of text leaves (one parse per row)."""
    return F.from_json(text, FEATURE_SCHEMA)


def coordinates_array(coords_text: Column) -> Column:
    """``geometry.coordinates`` as an array of text; NULL when not an array."""
    return F.from_json(coords_text, "array<string>")


def epoch_millis_to_ntz(ms: Column) -> Column:
    """Epoch milliseconds to a wall-clock UTC timestamp, independent of the
    session zone (millisecond precision is kept); NULL outside
    ``EPOCH_MS_RANGE``, where the conversion would overflow."""
    inside = F.when(ms.between(*EPOCH_MS_RANGE), ms)
    return F.timestamp_add("MILLISECOND", inside, F.lit(_EPOCH).cast("timestamp_ntz"))


def present_but_uncastable(text: Column, typed: Column) -> Column:
    """True where a value was given but does not fit its column."""
    return text.isNotNull() & typed.isNull()
