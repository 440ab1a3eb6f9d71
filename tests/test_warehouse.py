"""Dimensions, keys, fact and the analytical queries on literal data."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventstar.functions.calendar import date_attributes
from eventstar.functions.exact import rounded_mean
from eventstar.plans import analytics
from eventstar.plans.layers import Batch, build_layers
from tests.conftest import feature, features_df


def layers_of(spark, docs):
    return build_layers(spark, [Batch(features_df(spark, docs), "b1", dt.datetime(2024, 1, 2))])


@pytest.mark.parametrize("lat,lon,region", [
    (24, -125, "Continental US"), (49, -65, "Continental US"), (60, -150, "Alaska"),
    (20, -155, "Hawaii"), (-60, 0, "Antarctica"), (0, 0, "Other")])
def test_region_edges(spark, lat, lon, region):
    lay = layers_of(spark, [feature(coords=[lon, lat, 5])])
    assert [r.region for r in lay.dim_location.collect()] == [region]


def test_magnitude_types(spark):
    types = ["mb", "ms_20", "mww", "mlg", "md", "mwr", "Mw"]
    docs = [feature(eid=f"e{i}", magType=t) for i, t in enumerate(types)]
    lay = layers_of(spark, docs)
    got = {r.magnitude_type: r.magnitude_category for r in lay.dim_event_type.collect()}
    assert [got[t] for t in types] == ["Body Wave", "Surface Wave", "Moment", "Local",
                                      "Duration", "Other", "Other"]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 5),), (dt.date(2021, 1, 3),)], "d date")
    rows = df.select(*date_attributes(F.col("d"))).orderBy("date_actual").collect()
    iso, sunday = rows
    assert iso.week_of_year == 53
    assert (sunday.day_of_week, sunday.is_weekend, sunday.day_name, sunday.month_name) == \
        (0, True, "Sunday   ", "May      ")
    assert sunday.time_key == 20240505 and sunday.quarter == 2


def test_same_null_place_two_depths_one_location(spark):
    docs = [feature(eid="a", place=None, coords=[10, 10, 10], time=1000 * 86400 * 10),
            feature(eid="b", place=None, coords=[10, 10, 400], time=1000 * 86400 * 11)]
    lay = layers_of(spark, docs)
    locs = lay.dim_location.collect()
    assert len(locs) == 1 and locs[0].depth_category == "Shallow"
    assert lay.fact.count() == 2
    assert lay.fact.select("location_key").distinct().collect()[0][0] == locs[0].location_key


def test_fact_keys_resolve(spark):
    lay = layers_of(spark, [feature(eid="a"), feature(eid="b", magType=None),
                            feature(eid="c", coords=[1, 2])])
    fact = lay.fact
    assert fact.count() == 3
    for key, dim in [("time_key", lay.dim_time), ("location_key", lay.dim_location),
                     ("event_type_key", lay.dim_event_type)]:
        orphans = fact.filter(F.col(key).isNotNull()).join(dim, key, "left_anti").count()
        assert orphans == 0
    assert fact.filter(F.col("event_type_key").isNull()).count() == 1


def test_exact_mean_rounds_once(spark):
    # 2,500,001 x 2.34 and 2,499,998 x 2.35: exact mean 2.344999.. -> 2.34
    s = 2_500_001 * 234 + 2_499_998 * 235
    n = 2_500_001 + 2_499_998
    df = spark.createDataFrame([(s, n)], "s long, n long")
    assert df.select(rounded_mean(F.col("s"), F.col("n"), 2)).first()[0] == 2.34
    df2 = spark.createDataFrame([(-5, 2), (5, 2), (0, 0)], "s long, n long")
    assert [r[0] for r in df2.select(rounded_mean(F.col("s"), F.col("n"), 2)).collect()] == \
        [-0.03, 0.03, None]


def test_queries_on_literal_star(spark):
    day = 1704067200000  # 2024-01-01 (Monday) in epoch ms
    docs = [
        feature(eid="a", mag=5.5, time=day, coords=[-100, 30, 10], tsunami=1, sig=600),
        feature(eid="b", mag=2.0, time=day + 86400000, coords=[-100, 30, 10], sig=50),
        feature(eid="c", mag=6.1, time=day + 6 * 86400000, coords=[-150, 60, 350], sig=900,
                magType="mb"),
        feature(eid="d", mag=None, time=day, coords=[0, 0, 1]),
    ]
    lay = layers_of(spark, docs)
    q1 = {r.region: r for r in analytics.q1_region(lay.fact, lay.dim_location).collect()}
    assert q1["Continental US"].event_count == 2
    assert q1["Continental US"].avg_magnitude == 3.75
    assert q1["Continental US"].max_magnitude == Decimal("5.50")
    assert q1["Continental US"].tsunami_events == 1
    assert q1["Alaska"].min_magnitude == Decimal("6.10")
    q2 = analytics.q2_weekday(lay.fact, lay.dim_time).collect()
    assert [r.day_name.strip() for r in q2] == ["Sunday", "Monday", "Tuesday"]
    q3 = {r.depth_category: r for r in analytics.q3_depth(lay.fact, lay.dim_location).collect()}
    assert q3["Shallow"].avg_significance == 600.0 and q3["Deep"].strong_events == 1
    q4 = analytics.q4_month(lay.fact, lay.dim_time).collect()
    assert [(r.year, r.month, r.event_count, r.total_significance) for r in q4] == \
        [(2024, 1, 3, 1550)]
    q5 = {r.magnitude_type: r for r in analytics.q5_magtype(lay.fact, lay.dim_event_type).collect()}
    assert q5["mw"].median_magnitude == 3.75 and q5["mw"].stddev_magnitude == 2.47
    assert q5["mb"].stddev_magnitude is None
    q6 = analytics.q6_high_impact(lay.fact, lay.dim_time, lay.dim_location, lay.dim_event_type,
                                  as_of=dt.date(2024, 1, 20)).collect()
    assert [r.event_id for r in q6] == ["c", "a"]
    assert analytics.q6_high_impact(lay.fact, lay.dim_time, lay.dim_location, lay.dim_event_type,
                                    as_of=dt.date(2024, 3, 1)).count() == 0


def test_q6_desc_puts_null_significance_first(spark):
    day = 1704067200000
    docs = [feature(eid="x", mag=7.0, time=day, sig=900), feature(eid="y", mag=7.0, time=day),
            feature(eid="z", mag=8.0, time=day, sig=1)]
    lay = layers_of(spark, docs)
    q6 = analytics.q6_high_impact(lay.fact, lay.dim_time, lay.dim_location, lay.dim_event_type,
                                  as_of=dt.date(2024, 1, 10)).collect()
    assert [r.event_id for r in q6] == ["z", "y", "x"]


def test_q7_latest_errors_first(spark):
    rows = [("b1", f"e{i:02d}", "validation_error", "m", dt.datetime(2024, 1, 1, 0, i)) for i in range(15)]
    errs = spark.createDataFrame(rows, "batch_id string, event_id string, error_type string, "
                                       "error_message string, occurred_at timestamp")
    got = [r.event_id for r in analytics.q7_recent_errors(errs).collect()]
    assert got == [f"e{i:02d}" for i in range(14, 4, -1)]


def test_classification_boundaries_by_literal(spark):
    from pyspark.sql import functions as F

    from eventstar.functions import classify
    depths = [("69.999", "Shallow"), ("70", "Intermediate"), ("299.999", "Intermediate"),
              ("300", "Deep"), (None, "Deep"), ("-5", "Shallow")]
    df = spark.createDataFrame(depths, "d string, want string").select(
        classify.depth_category(F.col("d").cast("decimal(8,3)")).alias("got"), "want")
    assert [r for r in df.collect() if r.got != r.want] == []
    places = [(24, -125, "Continental US"), (49, -65, "Continental US"), (49.000001, -65, "Other"),
              (24, -125.000001, "Other"), (55, -170, "Alaska"), (72, -140, "Alaska"),
              (72.000001, -140, "Other"), (55, -139.999999, "Other"), (18, -161, "Hawaii"),
              (23, -154, "Hawaii"), (17.999999, -155, "Other"), (23, -153.999999, "Other"),
              (-60, 10, "Antarctica"), (-90, -180, "Antarctica"), (-59.999999, 0, "Other"), (0, 0, "Other")]
    df = spark.createDataFrame([(float(a), float(b), w) for a, b, w in places],
                               "a double, b double, want string").select(
        classify.region(F.col("a").cast("decimal(9,6)"), F.col("b").cast("decimal(9,6)")).alias("got"), "want")
    assert [r for r in df.collect() if r.got != r.want] == []
    types = [("mb", "Body Wave", "Body wave magnitude"), ("mb_lg", "Body Wave", "Body wave magnitude"),
             ("ms", "Surface Wave", "Surface wave magnitude"),
             ("ms_20", "Surface Wave", "Surface wave magnitude"),
             ("mw", "Moment", "Moment magnitude"), ("mww", "Moment", "Moment magnitude"),
             ("mwc", "Moment", "Moment magnitude"), ("mwb", "Moment", "Moment magnitude"),
             ("ml", "Local", "Local (Richter) magnitude"), ("mlg", "Local", "Local (Richter) magnitude"),
             ("md", "Duration", "Duration magnitude"), ("mwr", "Other", "Other magnitude type"),
             ("Mw", "Other", "Other magnitude type"), ("", "Other", "Other magnitude type")]
    df = spark.createDataFrame(types, "t string, c string, d string").select(
        classify.magnitude_category(F.col("t")).alias("gc"),
        classify.magnitude_description(F.col("t")).alias("gd"), "c", "d")
    assert [r for r in df.collect() if (r.gc, r.gd) != (r.c, r.d)] == []


def test_key_collisions_are_found(spark):
    from eventstar.plans.warehouse import key_collisions
    old_l = spark.createDataFrame([(1,), (2,)], "location_key bigint")
    old_t = spark.createDataFrame([(9,)], "event_type_key bigint")

    def found(locations, types):
        new_l = spark.createDataFrame([(x,) for x in locations], "location_key bigint")
        new_t = spark.createDataFrame([(x,) for x in types], "event_type_key bigint")
        return sorted(r.key for r in key_collisions(new_l, new_t, old_l, old_t).collect())
    assert found([3, 4], [5]) == []
    assert found([2, 3, 3], [9]) == [2, 3, 9]
