"""Explicit schemas of the layer tables and of the feature document.

Nothing is ever inferred: the JSON document is parsed with a fixed schema and
every table is read with its declared ``StructType``, so an absent table reads
as an empty DataFrame of the right shape.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TS, NTZ, D = T.TimestampType(), T.TimestampNTZType(), T.DateType()
MAG, COORD, DEPTH = T.DecimalType(3, 2), T.DecimalType(9, 6), T.DecimalType(8, 3)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One feature, every leaf read as text: JSON numbers arrive as their literal
# text, JSON null and absent keys both become NULL, and ``coordinates`` keeps
# its raw JSON text so a non-array value can be told apart from a missing one.
FEATURE_SCHEMA = _struct(
    ("id", S),
    ("properties", _struct(
        ("mag", S), ("magType", S), ("place", S), ("time", S), ("updated", S),
        ("status", S), ("tsunami", S), ("sig", S))),
    ("geometry", _struct(("coordinates", S))),
)

# A landed page: the catalog's FeatureCollection envelope.
PAGE_SCHEMA = _struct(
    ("metadata", _struct(("count", L))),
    ("features", T.ArrayType(S)),
)

RAW_EVENTS = _struct(("batch_id", S), ("event_id", S), ("raw_data", S), ("ingested_at", TS))

INGESTION_AUDIT = _struct(
    ("batch_id", S), ("start_time", TS), ("end_time", TS), ("records_fetched", L),
    ("records_inserted", L), ("status", S), ("error_message", S))

INGESTION_ERRORS = _struct(
    ("batch_id", S), ("event_id", S), ("error_type", S), ("error_message", S),
    ("raw_data", S), ("occurred_at", TS))

STG_EVENTS = _struct(
    ("event_id", S), ("magnitude", MAG), ("magnitude_type", S), ("place", S),
    ("event_time", NTZ), ("updated_time", NTZ), ("latitude", COORD), ("longitude", COORD),
    ("depth", DEPTH), ("status", S), ("tsunami", B), ("significance", I),
    ("processed_at", TS), ("source_batch_id", S))

DIM_TIME = _struct(
    ("time_key", I), ("date_actual", D), ("year", I), ("quarter", I), ("month", I),
    ("month_name", S), ("day", I), ("day_of_week", I), ("day_name", S),
    ("week_of_year", I), ("is_weekend", B))

DIM_LOCATION = _struct(
    ("location_key", L), ("latitude", COORD), ("longitude", COORD),
    ("depth_category", S), ("region", S), ("place", S))

DIM_EVENT_TYPE = _struct(
    ("event_type_key", L), ("magnitude_type", S), ("magnitude_category", S), ("description", S))

FACT_EVENTS = _struct(
    ("fact_key", L), ("event_id", S), ("time_key", I), ("location_key", L),
    ("event_type_key", L), ("magnitude", MAG), ("depth", DEPTH), ("significance", I),
    ("tsunami", B), ("status", S), ("event_time", NTZ), ("loaded_at", TS))

# What each completed transformation run consumed: raw batches it staged (with
# the end time of their audit row, so a batch landed again is consumed again)
# and staging loads it moved into the star schema (partitioned by the run's id).
TRANSFORM_LOG = _struct(("kind", S), ("consumed_id", S), ("version", TS), ("completed_at", TS))

# One row per transformation run: "started", replaced by "completed".
TRANSFORM_RUNS = _struct(("state", S), ("at", TS))

# Partial states of the reports Q1-Q5, per load (see ``eventstar.plans.analytics``).
_MAG_STATE = (("n", L), ("s_mag", L), ("n_mag", L))
STATE_BY_LOCATION = _struct(("location_key", L), *_MAG_STATE, ("mx", MAG), ("mn", MAG), ("ts", L))
STATE_SIGNIFICANT = _struct(("location_key", L), *_MAG_STATE, ("s_sig", L), ("n_sig", L), ("strong", L))
STATE_BY_DAY = _struct(("time_key", I), *_MAG_STATE, ("major", L), ("mx", MAG), ("s_sig", L))
STATE_BY_TYPE = _struct(("event_type_key", L), ("magnitude", MAG), ("c", L))

# Table name -> schema.  Every stored table also carries a ``load_id``
# partition column (see ``eventstar.plans.store``).
TABLES = {
    "raw_events": RAW_EVENTS,
    "ingestion_audit": INGESTION_AUDIT,
    "ingestion_errors": INGESTION_ERRORS,
    "stg_events": STG_EVENTS,
    "dim_time": DIM_TIME,
    "dim_location": DIM_LOCATION,
    "dim_event_type": DIM_EVENT_TYPE,
    "fact_events": FACT_EVENTS,
    "transform_log": TRANSFORM_LOG,
    "transform_runs": TRANSFORM_RUNS,
    "state_by_location": STATE_BY_LOCATION,
    "state_significant": STATE_SIGNIFICANT,
    "state_by_day": STATE_BY_DAY,
    "state_by_type": STATE_BY_TYPE,
}

# Declared string bounds (column -> max length) checked before rows are kept.
STRING_BOUNDS = {
    "raw_events": {"event_id": 50},
    "ingestion_audit": {"status": 20},
    "ingestion_errors": {"event_id": 50, "error_type": 50},
    "stg_events": {"event_id": 50, "magnitude_type": 10, "status": 20},
    "dim_time": {"month_name": 10, "day_name": 10},
    "dim_location": {"depth_category": 20, "region": 100},
    "dim_event_type": {"magnitude_type": 10, "magnitude_category": 20},
    "fact_events": {"event_id": 50, "status": 20},
}
