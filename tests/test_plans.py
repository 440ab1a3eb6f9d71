"""Plan shape: one parse per document, anti-joins, partial aggregation,
broadcast only where bounded, top-k, no Python in the plan."""

import datetime as dt

from eventstar.plans import analytics, staging
from eventstar.plans.layers import Batch, build_layers
from eventstar.sources.fixture import fixture_features
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def lay(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan for inspection
    return build_layers(spark, [Batch(fixture_features(spark, SF_SMALL), "b1")])


def test_documents_parsed_once(spark):
    l = lay(spark)
    try:
        x = staging.extract(l.raw)
        # the feature text is parsed once for validation and once at staging
        text = optimized(x.filter("reject_reason IS NULL"))
        assert text.count("from_json(StructField(id") <= 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_and_partial_aggregates(spark):
    l = lay(spark)
    try:
        for df in [l.stg, l.fact, analytics.q1_region(l.fact, l.dim_location),
                   analytics.q5_magtype(l.fact, l.dim_event_type)]:
            p = plan(df)
            assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
        q1 = plan(analytics.q1_region(l.fact, l.dim_location))
        assert "partial_sum" in q1 and "partial_count" in q1
        from eventstar.plans import staging
        again, _ = staging.stage_extracted(staging.extract(l.raw), l.stg.select("event_id"), 100)
        stg = plan(again)
        assert "LeftAnti" in stg and "LeftSemi" in stg and "partial_min" in stg
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_fact_never_joins_dimensions(spark):
    l = lay(spark)
    try:
        joins = [ln for ln in plan(l.fact).splitlines() if "Join" in ln]
        # at most the increment's anti-join (and its semi-join reduction);
        # against an empty history even those are optimised away
        assert all("LeftAnti" in ln or "LeftSemi" in ln for ln in joins)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top_k_and_bounded_broadcast(spark):
    l = lay(spark)
    try:
        q6 = plan(analytics.q6_high_impact(l.fact, l.dim_time, l.dim_location, l.dim_event_type,
                                           as_of=dt.date(2024, 2, 5)))
        assert "TakeOrderedAndProject" in q6
        q2 = plan(analytics.q2_weekday(l.fact, l.dim_time))
        assert "BroadcastHashJoin" in q2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_checked_broadcast_of_small_increment(spark):
    from pyspark.sql import functions as F
    from eventstar.operators.joins import BROADCAST_KEY_LIMIT, anti_join_increment
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hist = spark.range(1000).select(F.col("id").cast("string").alias("k"))
        new = spark.range(990, 1010).select(F.col("id").cast("string").alias("k"))
        small = anti_join_increment(new, hist, ["k"], new_rows=20)
        p = plan(small)
        assert "BroadcastHashJoin" in p and "LeftSemi" in p
        assert sorted(r.k for r in small.collect()) == [str(i) for i in range(1000, 1010)]
        big = anti_join_increment(new, hist, ["k"], new_rows=BROADCAST_KEY_LIMIT + 1)
        assert "BroadcastHashJoin" not in plan(big)
        assert small.count() == big.count() == new.join(hist, "k", "left_anti").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_q6_large_dimensions_get_runtime_filters(spark):
    """When the dimensions are too large to broadcast, the selective fact
    filter of Q6 becomes a bloom filter on the dimension scans."""
    from eventstar.registry import stored_pipeline
    star = stored_pipeline(spark, SF_SMALL).star()
    confs = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        q6 = plan(analytics.q6_high_impact(star["fact"], star["dim_time"], star["dim_location"],
                                           star["dim_event_type"], as_of=dt.date(2024, 2, 5)))
        assert "might_contain" in q6 and "TakeOrderedAndProject" in q6
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
