"""Staging → star schema: three dimensions and the fact, incrementally.

Surrogate keys are functions of the natural keys (``yyyymmdd`` for dates,
``xxhash64`` for locations, event types and facts).  The fact increment can
therefore compute its foreign keys itself: it never joins the dimensions, and
the location dimension — which grows with the data — is never shuffled
against the fact.  A dimension row exists for every key the fact carries
because each increment inserts the missing natural keys of the same source
rows; ``eventstar.operators.checks`` verifies that.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstar.functions.calendar import date_attributes, time_key
from eventstar.functions.classify import (
    depth_category,
    magnitude_category,
    magnitude_description,
    region,
)
from eventstar.operators.firstwins import first_per_key
from eventstar.operators.joins import anti_join_increment
from eventstar.schemas import DIM_EVENT_TYPE, DIM_LOCATION, DIM_TIME, FACT_EVENTS

WAREHOUSE_ERROR = "warehouse_error"
LOCATION_KEY_COLS = ["latitude", "longitude", "place_key"]


def place_key(place: Column) -> Column:
    """Places compare with NULL and '' as the same value."""
    return F.coalesce(place, F.lit(""))


def location_key(lat: Column, lon: Column, place: Column) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), F.xxhash64(lat, lon, place_key(place)))


def event_type_key(magnitude_type: Column) -> Column:
    return F.when(magnitude_type.isNotNull(), F.xxhash64(magnitude_type))


def fact_key(event_id: Column) -> Column:
    return F.xxhash64(event_id)


@dataclass
class StarIncrement:
    dim_time: DataFrame
    dim_location: DataFrame
    dim_event_type: DataFrame
    fact: DataFrame
    violations: DataFrame  # staged rows that cannot get a location row


def unloaded(stg: DataFrame, fact: DataFrame) -> DataFrame:
    """Staged rows whose event is not in the fact yet."""
    return anti_join_increment(stg, fact.select("event_id"), ["event_id"])


def new_time_rows(src: DataFrame, dim_time: DataFrame, src_rows: int | None = None) -> DataFrame:
    dates = src.select(F.to_date("event_time").alias("d")).distinct()
    dates = anti_join_increment(dates, dim_time.select(F.col("date_actual").alias("d")), ["d"],
                                src_rows)
    return dates.select(*date_attributes(F.col("d"))).select(*[f.name for f in DIM_TIME.fields])


def new_location_rows(src: DataFrame, dim_location: DataFrame,
                      src_rows: int | None = None) -> DataFrame:
    """One row per (latitude, longitude, place or ''); the earliest event
    (event_time, event_id) fixes depth category and place spelling, and a row
    already in the dimension keeps its values."""
    located = (src.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
               .withColumn("place_key", place_key(F.col("place"))))
    first = first_per_key(located, LOCATION_KEY_COLS, ["event_time", "event_id"],
                          ["depth", "place"])
    existing = dim_location.select("latitude", "longitude",
                                   place_key(F.col("place")).alias("place_key"))
    fresh = anti_join_increment(first, existing, LOCATION_KEY_COLS, src_rows)
    return fresh.select(
        F.xxhash64("latitude", "longitude", "place_key").alias("location_key"),
        "latitude", "longitude",
        depth_category(F.col("depth")).alias("depth_category"),
        region(F.col("latitude"), F.col("longitude")).alias("region"),
        "place",
    ).select(*[f.name for f in DIM_LOCATION.fields])


def new_event_type_rows(src: DataFrame, dim_event_type: DataFrame,
                        src_rows: int | None = None) -> DataFrame:
    types = src.filter(F.col("magnitude_type").isNotNull()).select("magnitude_type").distinct()
    types = anti_join_increment(types, dim_event_type.select("magnitude_type"), ["magnitude_type"],
                                src_rows)
    mt = F.col("magnitude_type")
    return types.select(
        F.xxhash64(mt).alias("event_type_key"), mt,
        magnitude_category(mt).alias("magnitude_category"),
        magnitude_description(mt).alias("description"),
    ).select(*[f.name for f in DIM_EVENT_TYPE.fields])


def fact_rows(src: DataFrame) -> DataFrame:
    """Fact rows of the staged rows that have a location; the others are in
    the error table (:func:`location_violations`)."""
    return src.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        fact_key(F.col("event_id")).alias("fact_key"),
        "event_id",
        time_key(F.to_date("event_time")).alias("time_key"),
        location_key(F.col("latitude"), F.col("longitude"), F.col("place")).alias("location_key"),
        event_type_key(F.col("magnitude_type")).alias("event_type_key"),
        "magnitude", "depth", "significance", "tsunami", "status", "event_time",
        F.current_timestamp().alias("loaded_at"),
    ).select(*[f.name for f in FACT_EVENTS.fields])


def location_violations(src: DataFrame) -> DataFrame:
    """Staged rows without latitude or longitude: no location row can hold
    them, so they stay out of the fact."""
    return src.filter(F.col("latitude").isNull() | F.col("longitude").isNull()).select(
        F.col("source_batch_id").alias("batch_id"),
        "event_id",
        F.lit(WAREHOUSE_ERROR).alias("error_type"),
        F.lit("latitude or longitude missing: no location row").alias("error_message"),
        F.lit(None).cast("string").alias("raw_data"),
        F.current_timestamp().alias("occurred_at"),
    )


def key_collisions(new_location: DataFrame, new_event_type: DataFrame, dim_location: DataFrame,
                   dim_event_type: DataFrame) -> DataFrame:
    """Hash keys of new dimension rows that another row has as well (a new one
    or one of the dimension): different natural keys, so joining on them would
    double facts."""
    parts = []
    for new, old, key in ((new_location, dim_location, "location_key"),
                          (new_event_type, dim_event_type, "event_type_key")):
        keys = new.select(F.col(key).alias("key"))
        parts.append(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                     .select("key"))
        parts.append(old.select(F.col(key).alias("key")).join(keys, "key", "left_semi"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def increment(src: DataFrame, dim_time: DataFrame, dim_location: DataFrame,
              dim_event_type: DataFrame, src_rows: int | None = None) -> StarIncrement:
    """New dimension rows and fact rows for the unloaded staged rows ``src``
    (``src_rows``: its counted size, enabling checked broadcasts)."""
    return StarIncrement(
        dim_time=new_time_rows(src, dim_time, src_rows),
        dim_location=new_location_rows(src, dim_location, src_rows),
        dim_event_type=new_event_type_rows(src, dim_event_type, src_rows),
        fact=fact_rows(src),
        violations=location_violations(src),
    )
