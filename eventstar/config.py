"""Run parameters (plain arguments instead of a config file)."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values taken from the reference's shipped defaults.
DEFAULT_LOOKBACK_DAYS = 7
DEFAULT_MAX_ERRORS = 500
DEFAULT_PAGE_SIZE = 100
# Required paths, in the order they are checked.
REQUIRED_FIELDS = ("id", "properties.time", "geometry.coordinates")


@dataclass(frozen=True)
class PipelineConfig:
    """Knobs of one pipeline run.

    ``on_violation`` decides what happens to rows the star schema cannot hold
    (a value that overflows its column, a too-long string, a missing
    coordinate, a duplicated id inside one batch): ``"quarantine"`` writes them
    to the error table and goes on, ``"fail"`` raises like a database
    constraint would.
    """

    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    # "hash": keys computed from natural keys; "dense": 1, 2, 3, ... without gaps.
    surrogate_keys: str = "hash"
    # Buckets of the staging table by event id (a catalog table); None: plain folders.
    staging_buckets: int | None = None
    # Keep the partial states of Q1-Q5 per load, so that reports read no facts.
    report_states: bool = False
    # Loads appear in all tables at once, by a manifest; the fact has month folders.
    publish_atomically: bool = False
    max_errors: int | None = DEFAULT_MAX_ERRORS
    on_violation: str = "quarantine"
    # Paths of the feature document that must hold a value.
    required_fields: tuple[str, ...] = REQUIRED_FIELDS
    # The range defaults.  Opt-in range rules (declared by the reference, never switched on there).
    check_ranges: bool = False
    magnitude_range: tuple[float, float] = (-2.0, 10.0)
    latitude_range: tuple[float, float] = (-90.0, 90.0)
    longitude_range: tuple[float, float] = (-180.0, 180.0)
    depth_range: tuple[float, float] = (-10.0, 800.0)

    def __post_init__(self) -> None:
        if self.on_violation not in ("quarantine", "fail"):
            raise ValueError("on_violation must be 'quarantine' or 'fail'")
        if self.surrogate_keys not in ("hash", "dense"):
            raise ValueError("surrogate_keys must be 'hash' or 'dense'")
        if self.publish_atomically and self.staging_buckets:
            raise ValueError("publish_atomically and staging_buckets cannot be combined")
