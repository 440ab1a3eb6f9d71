"""Dense surrogate keys: 1, 2, 3, ... without gaps, load after load.

New rows are numbered in the order of their natural keys behind the greatest
stored key.  A load that is retried gives its rows the same keys.  Unlike hash
keys, dense keys cannot collide and stay small; the price is that the fact
looks its keys up in the dimensions, which are first reduced to the natural
keys of the increment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstar.functions.calendar import time_key
from eventstar.operators.joins import reduce_to
from eventstar.operators.ranking import numbered
from eventstar.plans.warehouse import StarIncrement, increment, place_key
from eventstar.schemas import FACT_EVENTS


def greatest_key(table: DataFrame, key: str) -> int:
    return table.agg(F.max(key)).first()[0] or 0


def with_dense_key(new: DataFrame, existing: DataFrame, key: str, order: list) -> DataFrame:
    """``new`` with its column ``key`` numbered behind that of ``existing``."""
    return numbered(new.drop(key), order, key, greatest_key(existing, key)).select(*new.columns)


def dense_dimensions(inc: StarIncrement, dim_location: DataFrame, dim_event_type: DataFrame) -> StarIncrement:
    """The increment with dense keys in its new location and type rows."""
    inc.dim_location = with_dense_key(inc.dim_location, dim_location, "location_key",
                                      ["latitude", "longitude", place_key(F.col("place"))])
    inc.dim_event_type = with_dense_key(inc.dim_event_type, dim_event_type, "event_type_key",
                                        ["magnitude_type"])
    return inc


def dense_facts(src: DataFrame, dim_location: DataFrame, dim_event_type: DataFrame, fact: DataFrame,
                src_rows: int | None = None) -> DataFrame:
    """Fact rows of the staged rows ``src`` that have a location.  The
    dimensions hold the rows of this increment already."""
    located = (src.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
               .withColumn("place_key", place_key(F.col("place"))))
    natural = ["latitude", "longitude", "place_key"]
    places = dim_location.select("location_key", "latitude", "longitude",
                                 place_key(F.col("place")).alias("place_key"))
    places = reduce_to(places, located, natural, src_rows)
    types = reduce_to(dim_event_type.select("event_type_key", "magnitude_type"), located,
                      ["magnitude_type"], src_rows)
    rows = (located.join(places, natural, "left").join(types, "magnitude_type", "left")
            .select("event_id", time_key(F.to_date("event_time")).alias("time_key"), "location_key",
                    "event_type_key", "magnitude", "depth", "significance", "tsunami", "status",
                    "event_time", F.current_timestamp().alias("loaded_at")))
    return numbered(rows, ["event_id"], "fact_key", greatest_key(fact, "fact_key")).select(
        *[f.name for f in FACT_EVENTS.fields])


def dense_increment(src: DataFrame, dim_time: DataFrame, dim_location: DataFrame,
                    dim_event_type: DataFrame, src_rows: int | None = None) -> StarIncrement:
    """:func:`eventstar.plans.warehouse.increment` with dense keys; its fact
    rows are made by :func:`dense_facts` once the dimensions are written."""
    inc = increment(src, dim_time, dim_location, dim_event_type, src_rows)
    return dense_dimensions(inc, dim_location, dim_event_type)
