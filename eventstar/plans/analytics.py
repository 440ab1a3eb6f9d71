"""Analytical queries over the star schema.

Q1-Q5 aggregate the fact per dimension key first (partial aggregation happens
map-side), then join the few aggregated rows to the dimension and finish the
aggregate per attribute.  The fact is never shuffled row by row against a
dimension, a hot key is reduced before the shuffle, and the result equals
aggregating the joined rows: inner-join semantics are kept because a key with
no dimension row drops its whole group.  Averages and deviations come from
exact integer sums (``eventstar.functions.exact``).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstar.functions.exact import (
    hundredths,
    round2,
    rounded_mean,
    rounded_quotient,
    stddev_from_moments,
)
from eventstar.operators.ranking import numbered

# Decimal thresholds compare with the DECIMAL(3,2) column as is (a float would
# cast the column to DOUBLE and keep the filter out of the Parquet scan).
MAJOR = Decimal("5.0")   # fixed value: "major" events for Q2, and the Q6 floor
STRONG = Decimal("6.0")  # fixed value: "strong" events for Q3
SIGNIFICANT = 100  # fixed value: Q3 keeps significance above this
RECENT_DAYS = 30   # fixed value: Q6 window
TOP_EVENTS = 20    # fixed value: Q6 report size
RECENT_ERRORS = 10  # fixed value: Q7 report size


def in_order(df: DataFrame, order: list, ranked: bool) -> DataFrame:
    """``df`` sorted, or with ``ranked`` in no order but with the place of each
    row as ``rank``, which survives whatever is done with the rows."""
    return numbered(df, order, "rank") if ranked else df.orderBy(*order)


def _mag_partials(fact: DataFrame, key: str, extra: list | None = None) -> DataFrame:
    m = F.col("magnitude")
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(hundredths(m)).alias("s_mag"),
        F.count(m).alias("n_mag"),
        *(extra or []),
    )


# Q1-Q5 in two parts: per-key partial states of some facts, which merge by
# sum, max and min, and the report made of merged states.

#: Partial state -> how its columns merge.
MERGE = {"n": F.sum, "s_mag": F.sum, "n_mag": F.sum, "mx": F.max, "mn": F.min, "ts": F.sum,
         "major": F.sum, "s_sig": F.sum, "n_sig": F.sum, "strong": F.sum, "c": F.sum}
PARTIALS = {"by_location": ["location_key"], "significant": ["location_key"], "by_day": ["time_key"],
            "by_type": ["event_type_key", "magnitude"]}


def partial_states(fact: DataFrame) -> dict[str, DataFrame]:
    """The states of Q1-Q5 over ``fact``, by name."""
    m, sig = F.col("magnitude"), F.col("significance")
    return {
        "by_location": _mag_partials(fact, "location_key", [
            F.max(m).alias("mx"), F.min(m).alias("mn"), F.count_if(F.col("tsunami")).alias("ts")]),
        "significant": _mag_partials(fact.filter(sig > SIGNIFICANT), "location_key", [
            F.sum(sig.cast("bigint")).alias("s_sig"), F.count(sig).alias("n_sig"),
            F.count_if(m >= F.lit(STRONG)).alias("strong")]),
        "by_day": _mag_partials(fact, "time_key", [
            F.count_if(m >= F.lit(MAJOR)).alias("major"), F.max(m).alias("mx"),
            F.sum(sig.cast("bigint")).alias("s_sig")]),
        "by_type": fact.groupBy("event_type_key", "magnitude").agg(F.count(F.lit(1)).alias("c")),
    }


def merged_states(name: str, states: DataFrame) -> DataFrame:
    """States of several sets of facts as those of their union."""
    keys = PARTIALS[name]
    return states.groupBy(*keys).agg(*[MERGE[c](c).alias(c) for c in states.columns
                                       if c not in keys and c in MERGE])


def q1_report(by_location: DataFrame, dim_location: DataFrame, ranked: bool = False) -> DataFrame:
    j = by_location.join(dim_location.select("location_key", "region"), "location_key")
    out = j.groupBy("region").agg(
        F.sum("n").alias("event_count"),
        rounded_mean(F.sum("s_mag"), F.sum("n_mag"), 2).alias("avg_magnitude"),
        F.max("mx").alias("max_magnitude"),
        F.min("mn").alias("min_magnitude"),
        F.sum("ts").alias("tsunami_events"))
    return in_order(out, [F.desc("event_count"), F.asc("region")], ranked)


def q2_report(by_day: DataFrame, dim_time: DataFrame, ranked: bool = False) -> DataFrame:
    """``dim_time`` has one row per calendar day, so it is bounded by the date
    range (under 40,000 rows per century) and broadcast."""
    days = F.broadcast(dim_time.select("time_key", "day_name", "is_weekend", "day_of_week"))
    out = by_day.join(days, "time_key").groupBy("day_name", "is_weekend", "day_of_week").agg(
        F.sum("n").alias("event_count"),
        rounded_mean(F.sum("s_mag"), F.sum("n_mag"), 2).alias("avg_magnitude"),
        F.sum("major").alias("major_events"))
    return in_order(out, [F.asc("day_of_week")], ranked).drop("day_of_week")


def q3_report(significant: DataFrame, dim_location: DataFrame, ranked: bool = False) -> DataFrame:
    j = significant.join(dim_location.select("location_key", "depth_category"), "location_key")
    out = j.groupBy("depth_category").agg(
        F.sum("n").alias("event_count"),
        rounded_mean(F.sum("s_mag"), F.sum("n_mag"), 2).alias("avg_magnitude"),
        rounded_quotient(F.sum("s_sig"), F.sum("n_sig")).cast("double").alias("avg_significance"),
        F.sum("strong").alias("strong_events"))
    return in_order(out, [F.desc_nulls_first("avg_significance"), F.asc("depth_category")], ranked)


def q4_report(by_day: DataFrame, dim_time: DataFrame, ranked: bool = False) -> DataFrame:
    months = F.broadcast(dim_time.select("time_key", "year", "month", "month_name"))
    out = by_day.join(months, "time_key").groupBy("year", "month", "month_name").agg(
        F.sum("n").alias("event_count"),
        rounded_mean(F.sum("s_mag"), F.sum("n_mag"), 2).alias("avg_magnitude"),
        F.max("mx").alias("max_magnitude"),
        F.sum("s_sig").alias("total_significance"))
    return in_order(out, [F.asc("year"), F.asc("month")], ranked)


def q5_report(by_type: DataFrame, dim_event_type: DataFrame, ranked: bool = False) -> DataFrame:
    """One histogram (event type, magnitude) -> count feeds every statistic; a
    DECIMAL(3,2) magnitude has at most 1,999 distinct values, so each type's
    histogram is bounded and the exact median is taken from it with
    ``percentile(value, 0.5, frequency)``."""
    types = dim_event_type.select("event_type_key", "magnitude_type", "magnitude_category")
    j = by_type.join(types, "event_type_key")
    k = hundredths(F.col("magnitude"))
    c = F.col("c")
    has = F.col("magnitude").isNotNull()
    agg = j.groupBy("magnitude_type", "magnitude_category").agg(
        F.sum(c).alias("event_count"),
        F.sum(F.when(has, k * c)).alias("s1"),
        F.sum(F.when(has, (k * k).cast("decimal(38,0)") * c)).alias("s2"),
        F.sum(F.when(has, c)).alias("nm"),
        F.percentile(F.col("magnitude").cast("double"), F.lit(0.5), c).alias("median_magnitude"),
    )
    nm = F.coalesce(F.col("nm"), F.lit(0))
    out = agg.select(
        "magnitude_type", "magnitude_category", "event_count",
        rounded_mean(F.col("s1"), nm, 2).alias("avg_magnitude"),
        round2(stddev_from_moments(nm, F.col("s1"), F.col("s2"), 0.01)).alias("stddev_magnitude"),
        "median_magnitude")
    return in_order(out, [F.desc("event_count"), F.asc("magnitude_type")], ranked)


def q1_region(fact: DataFrame, dim_location: DataFrame, ranked: bool = False) -> DataFrame:
    """Magnitude distribution by region."""
    return q1_report(partial_states(fact)["by_location"], dim_location, ranked)


def q1b_region_short(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """The four-column variant of Q1."""
    return q1_region(fact, dim_location).select(
        "region", "event_count", "avg_magnitude", "max_magnitude")


def q2_weekday(fact: DataFrame, dim_time: DataFrame, ranked: bool = False) -> DataFrame:
    """Events by day of week, Sunday first."""
    return q2_report(partial_states(fact)["by_day"], dim_time, ranked)


def q3_depth(fact: DataFrame, dim_location: DataFrame, ranked: bool = False) -> DataFrame:
    """Significant events (significance above 100) by depth category."""
    return q3_report(partial_states(fact)["significant"], dim_location, ranked)


def q4_month(fact: DataFrame, dim_time: DataFrame, ranked: bool = False) -> DataFrame:
    """Monthly trend."""
    return q4_report(partial_states(fact)["by_day"], dim_time, ranked)


def q5_magtype(fact: DataFrame, dim_event_type: DataFrame, ranked: bool = False) -> DataFrame:
    """Magnitude type analysis: count, mean, sample deviation and median."""
    return q5_report(partial_states(fact)["by_type"], dim_event_type, ranked)


def q6_high_impact(fact: DataFrame, dim_time: DataFrame, dim_location: DataFrame,
                   dim_event_type: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Top 20 recent strong events (magnitude ≥ 5 within 30 days of ``as_of``).

    The fact filter reaches the Parquet scan; the selective fact side makes
    Spark inject a runtime filter into the dimension scans, and the top-k runs
    as ``TakeOrderedAndProject`` (per-partition top 20, then a merge).
    """
    day = F.lit(as_of) if as_of is not None else F.current_date()
    since = F.timestamp_add("DAY", F.lit(-RECENT_DAYS), day.cast("timestamp_ntz"))
    f = fact.filter((F.col("magnitude") >= F.lit(MAJOR)) & (F.col("event_time") >= since))
    if "event_month" in fact.columns:                    # a fact in month folders opens those only
        f = f.filter(F.col("event_month") >= F.date_format(since, "yyyy-MM"))
    j = (f.join(F.broadcast(dim_time.select("time_key", "date_actual")), "time_key")
         .join(dim_location.select("location_key", "place", "region", "depth_category"),
               "location_key")
         .join(dim_event_type.select("event_type_key", "magnitude_type"), "event_type_key"))
    return (j.orderBy(F.col("magnitude").desc_nulls_first(),
                      F.col("significance").desc_nulls_first(), F.col("event_id"))
            .limit(TOP_EVENTS)
            .select("event_id", "date_actual", "place", "region", "magnitude", "depth",
                    "depth_category", "tsunami", "significance", "magnitude_type"))


def q7_recent_errors(errors: DataFrame, ranked: bool = False) -> DataFrame:
    """The ten latest error rows (ties broken by event id, then message)."""
    order = [F.desc_nulls_first(c) for c in ("occurred_at", "event_id", "error_message")]
    top = errors.orderBy(*order).limit(RECENT_ERRORS).select(
        "batch_id", "event_id", "error_type", "error_message", "occurred_at")
    return in_order(top, order, True) if ranked else top
