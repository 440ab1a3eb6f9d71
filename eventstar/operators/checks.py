"""Integrity checks the layer tables must pass: uniqueness, NOT NULL,
foreign keys and string bounds.

Parquet enforces none of these, so they are computed: each check is one
aggregate (uniqueness: per-key counts with partial aggregation; foreign keys:
distinct fact keys anti-joined to the dimension) and all of them come back as
one small (check, violations) DataFrame.  Every count must be zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstar.schemas import STRING_BOUNDS

UNIQUE = [
    ("raw_events", ["event_id", "batch_id"]),
    ("stg_events", ["event_id"]),
    ("dim_time", ["date_actual"]),
    ("dim_time", ["time_key"]),
    ("dim_location", ["latitude", "longitude", "place_key"]),
    ("dim_location", ["location_key"]),
    ("dim_event_type", ["magnitude_type"]),
    ("dim_event_type", ["event_type_key"]),
    ("fact_events", ["event_id"]),
    ("fact_events", ["fact_key"]),
    ("ingestion_audit", ["batch_id"]),
]

NOT_NULL = {
    "raw_events": ["batch_id", "event_id", "raw_data", "ingested_at"],
    "stg_events": ["event_id", "event_time"],
    "dim_time": ["date_actual", "year", "quarter", "month", "month_name", "day",
                 "day_of_week", "day_name", "week_of_year", "is_weekend"],
    "dim_location": ["latitude", "longitude"],
    "dim_event_type": ["magnitude_type"],
    "fact_events": ["event_id", "event_time"],
    "ingestion_audit": ["batch_id", "start_time"],
    "ingestion_errors": ["batch_id", "occurred_at"],
}

FOREIGN = [
    ("time_key", "dim_time"),
    ("location_key", "dim_location"),
    ("event_type_key", "dim_event_type"),
]


def _count(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("violations")) \
        .select(F.lit(name).alias("check"), "violations")


def integrity_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(check, violations) for every rule over the given layer tables."""
    t = dict(tables)
    if "dim_location" in t:
        t["dim_location"] = t["dim_location"].withColumn(
            "place_key", F.coalesce(F.col("place"), F.lit("")))
    parts = []
    for table, keys in UNIQUE:
        if table in t:
            dup = t[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
            parts.append(_count(dup, f"unique:{table}({','.join(keys)})", F.sum(F.col("c") - 1)))
    if "fact_events" in t:
        for key, dim in FOREIGN:
            if dim in t:
                keys = t["fact_events"].select(key).filter(F.col(key).isNotNull()).distinct()
                orphans = keys.join(t[dim].select(key), key, "left_anti")
                parts.append(_count(orphans, f"foreign_key:fact_events.{key}", F.count(F.lit(1))))
    # Row-level rules (NOT NULL, string bounds): one scan per table.
    for table in t:
        rules = []
        if table in NOT_NULL:
            rules.append((f"not_null:{table}",
                          F.greatest(*[F.col(c).isNull() for c in NOT_NULL[table]], F.lit(False))))
        if table in STRING_BOUNDS:
            over = [F.coalesce(F.length(F.col(c)) > n, F.lit(False))
                    for c, n in STRING_BOUNDS[table].items()]
            rules.append((f"string_bounds:{table}", F.greatest(*over, F.lit(False))))
        if rules:
            counts = t[table].agg(*[F.count_if(cond).cast("bigint").alias(f"r{i}")
                                    for i, (_, cond) in enumerate(rules)])
            pairs = ", ".join(f"'{name}', r{i}" for i, (name, _) in enumerate(rules))
            parts.append(counts.selectExpr(f"stack({len(rules)}, {pairs}) AS (`check`, violations)"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
