"""Classification rules of the location and event-type dimensions.

All are ``CASE WHEN`` chains of built-in expressions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
#
# Depth category: depth < 70 -> Shallow, depth < 300 -> Intermediate, else Deep
# (a missing depth is Deep).
DEPTH_SHALLOW_BELOW = 70
DEPTH_INTERMEDIATE_BELOW = 300
#
# Regions: name, latitude and longitude bounds (inclusive); the first matching box wins.
REGION_BOXES = [
    ("Continental US", (24, 49), (-125, -65)),
    ("Alaska", (55, 72), (-170, -140)),
    ("Hawaii", (18, 23), (-161, -154)),
    ("Antarctica", (-90, -60), None),
]
REGION_OTHER = "Other"
#
# Magnitude types (case-sensitive) -> category and description:
MAGNITUDE_TYPES = [
    (("mb", "mb_lg"), "Body Wave", "Body wave magnitude"),
    (("ms", "ms_20"), "Surface Wave", "Surface wave magnitude"),
    (("mw", "mww", "mwc", "mwb"), "Moment", "Moment magnitude"),
    (("ml", "mlg"), "Local", "Local (Richter) magnitude"),
    (("md",), "Duration", "Duration magnitude"),
]
MAGNITUDE_OTHER = ("Other", "Other magnitude type")
# ---------------------------------------------------------------------------


def depth_category(depth: Column) -> Column:
    return (F.when(depth < DEPTH_SHALLOW_BELOW, "Shallow")
            .when(depth < DEPTH_INTERMEDIATE_BELOW, "Intermediate")
            .otherwise("Deep"))


def region(latitude: Column, longitude: Column) -> Column:
    expr = None
    for name, (lat_lo, lat_hi), lon in REGION_BOXES:
        cond = latitude.between(lat_lo, lat_hi)
        if lon is not None:
            cond = cond & longitude.between(lon[0], lon[1])
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(REGION_OTHER)


def _by_type(magnitude_type: Column, pick: int) -> Column:
    expr = None
    for entry in MAGNITUDE_TYPES:
        cond = magnitude_type.isin(*entry[0])
        expr = F.when(cond, entry[pick]) if expr is None else expr.when(cond, entry[pick])
    return expr.otherwise(MAGNITUDE_OTHER[pick - 1])


def magnitude_category(magnitude_type: Column) -> Column:
    return _by_type(magnitude_type, 1)


def magnitude_description(magnitude_type: Column) -> Column:
    return _by_type(magnitude_type, 2)
