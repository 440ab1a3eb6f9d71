"""Column expressions: JSON paths, classifications, calendar and exact maths."""

from eventstar.functions.calendar import date_attributes
from eventstar.functions.classify import (
    depth_category,
    magnitude_category,
    magnitude_description,
    region,
)
from eventstar.functions.exact import hundredths, rounded_mean, round2
from eventstar.functions.jsonpaths import epoch_millis_to_ntz, parse_feature

__all__ = [
    "date_attributes", "depth_category", "magnitude_category", "magnitude_description",
    "region", "hundredths", "rounded_mean", "round2", "epoch_millis_to_ntz", "parse_feature",
]
