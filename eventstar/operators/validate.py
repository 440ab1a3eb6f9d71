"""Validation of feature documents.

The rule set is one ordered ``CASE WHEN`` producing an ``error_message``
column (NULL = valid); valid and invalid rows are two filters over the same
DataFrame.  No Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.functions.jsonpaths import coordinates_array, parse_feature, with_column_once
from eventstar.schemas import STRING_BOUNDS

# ---------------------------------------------------------------------------
# Messages.
MISSING_FIELD = "Missing required field: {}"
BAD_COORDINATES = "Invalid coordinates format"
VALIDATION_ERROR = "Validation error: {}"
ERROR_TYPE = "validation_error"
UNKNOWN_ID = "unknown"
# JSON texts a loosely typed reader treats as "no value" besides null/absent.
FALSY_TEXTS = ["", "false", "[]", "{}"]
# ---------------------------------------------------------------------------


def _falsy(text: Column) -> Column:
    """Missing, or present with a value that counts as empty (``0``, ``0.0``,
    ``""``, ``false``, ``[]``, ``{}``)."""
    return (text.isNull() | text.isin(*FALSY_TEXTS)
            | F.coalesce(text.try_cast("double") == 0, F.lit(False)))


def with_parsed(features: DataFrame, text_col: str = "feature") -> DataFrame:
    """Add the parsed struct ``e`` and the coordinate array ``coords``."""
    parsed = with_column_once(features, "e", parse_feature(F.col(text_col)))
    return with_column_once(parsed, "coords", coordinates_array(F.col("e.geometry.coordinates")))


def error_message(config: PipelineConfig | None = None) -> Column:
    """Ordered rules; the first failing one names the error.  Needs ``e`` and
    ``coords`` (see :func:`with_parsed`)."""
    eid = F.col("e.id")
    coords_txt = F.col("e.geometry.coordinates")
    coords = F.col("coords")
    missing = {"geometry.coordinates":
               _falsy(coords_txt) | (coords.isNotNull() & (F.size(coords) == 0))}
    rule = F.when(F.lit(False), F.lit(None).cast("string"))
    for path in (config or PipelineConfig()).required_fields:
        rule = rule.when(missing.get(path, _falsy(F.col(f"e.{path}"))), MISSING_FIELD.format(path))
    bound = STRING_BOUNDS["raw_events"]["event_id"]
    rule = (rule.when(F.length(eid) > bound, VALIDATION_ERROR.format(f"id longer than {bound}"))
            .when(coords.isNull(), VALIDATION_ERROR.format("coordinates is not an array"))
            .when(F.size(coords) < 2, BAD_COORDINATES))
    if config is not None and config.check_ranges:
        rule = _range_rules(rule, config)
    return rule


def _range_rules(rule: Column, cfg: PipelineConfig) -> Column:
    """Opt-in range rules (magnitude and depth may be absent)."""
    mag = F.col("e.properties.mag").try_cast("double")
    lon = F.get(F.col("coords"), 0).try_cast("double")
    lat = F.get(F.col("coords"), 1).try_cast("double")
    depth = F.get(F.col("coords"), 2).try_cast("double")
    checks = [
        ("magnitude", mag, cfg.magnitude_range, True),
        ("latitude", lat, cfg.latitude_range, False),
        ("longitude", lon, cfg.longitude_range, False),
        ("depth", depth, cfg.depth_range, True),
    ]
    for name, value, (lo, hi), nullable in checks:
        bad = ~value.between(lo, hi)
        bad = F.coalesce(bad, F.lit(not nullable))
        rule = rule.when(bad, VALIDATION_ERROR.format(f"{name} out of range [{lo}, {hi}]"))
    return rule


def validate(features: DataFrame, config: PipelineConfig | None = None,
             text_col: str = "feature") -> DataFrame:
    """Features with ``e``, ``coords`` and ``error_message`` (NULL = valid)."""
    return with_parsed(features, text_col).withColumn("error_message", error_message(config))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) — two filters over one validated DataFrame."""
    ok = F.col("error_message").isNull()
    return validated.filter(ok), validated.filter(~ok)


def error_rows(invalid: DataFrame, batch_id: Column | str,
               occurred_at: Column | None = None, text_col: str = "feature") -> DataFrame:
    """Invalid features as error-table rows (one per invalid feature)."""
    bid = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return invalid.select(
        bid.cast("string").alias("batch_id"),
        F.coalesce(F.left(F.col("e.id"), F.lit(STRING_BOUNDS["ingestion_errors"]["event_id"])),
                   F.lit(UNKNOWN_ID)).alias("event_id"),
        F.lit(ERROR_TYPE).alias("error_type"),
        F.col("error_message"),
        F.col(text_col).alias("raw_data"),
        (occurred_at if occurred_at is not None else F.current_timestamp()).alias("occurred_at"),
    )


def threshold_exceeded(n_errors: int, max_errors: int | None) -> bool:
    """The run fails once the batch's error count reaches ``max_errors``."""
    return max_errors is not None and n_errors >= max_errors
