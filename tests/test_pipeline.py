"""The stored pipeline: layers on disk, re-runs, audit, thresholds, checks."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.operators.checks import integrity_checks
from eventstar.plans.ingest import ErrorThresholdExceeded
from eventstar.plans.pipeline import Pipeline, ViolationError
from eventstar.session import scratch_path
from eventstar.sources.fixture import fixture_features
from tests.conftest import SF_SMALL, feature, features_df


def new_pipe(spark, config=PipelineConfig()):
    return Pipeline(spark, scratch_path(spark, "test-layers"), config)


def test_full_run_rerun_and_checks(spark):
    pipe = new_pipe(spark)
    feats = fixture_features(spark, SF_SMALL)
    stats = pipe.ingest_batch(feats, batch_id="b1")
    n = feats.count()
    assert stats["events_fetched"] == n
    assert stats["events_valid"] + stats["events_invalid"] == n
    assert stats["events_loaded"] == stats["events_valid"]
    counts = pipe.run_transformations(load_id="L1")
    assert counts["raw_events"] == stats["events_valid"]
    assert counts["fact_events"] == counts["staging_events"] > 0
    # algebra: errors = invalid, fact ids = staged ids
    assert pipe.store.read("ingestion_errors").count() == stats["events_invalid"]
    stg_ids = pipe.store.read("stg_events").select("event_id")
    fact_ids = pipe.store.read("fact_events").select("event_id")
    assert stg_ids.subtract(fact_ids).count() == 0 and fact_ids.subtract(stg_ids).count() == 0
    # a second transformation run adds nothing; a retry of L1 rewrites the same rows
    assert pipe.run_transformations(load_id="L2") == counts
    assert pipe.run_transformations(load_id="L1") == counts
    audit = pipe.store.read("ingestion_audit").collect()
    assert [(a.status, a.records_fetched, a.records_inserted) for a in audit] == \
        [("success", stats["events_valid"], stats["events_valid"])]
    rows = integrity_checks(pipe.tables() | {
        name: pipe.store.read(name) for name in
        ["raw_events", "stg_events", "fact_events", "ingestion_audit", "ingestion_errors"]}).collect()
    assert [r for r in rows if r.violations] == []
    assert {"unique:ingestion_audit(batch_id)", "not_null:ingestion_errors"} <= {r.check for r in rows}


def test_overlapping_batches_first_wins(spark):
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, [feature(eid="a", mag=1.0), feature(eid="b")]), "b1")
    pipe.ingest_batch(features_df(spark, [feature(eid="a", mag=3.0), feature(eid="c")]), "b2")
    pipe.run_transformations("L1")
    stg = {r.event_id: r for r in pipe.store.read("stg_events").collect()}
    assert set(stg) == {"a", "b", "c"} and str(stg["a"].magnitude) == "1.00"
    assert stg["a"].source_batch_id == "b1"


def test_threshold_stops_before_raw(spark):
    pipe = new_pipe(spark, PipelineConfig(max_errors=2))
    docs = [feature(eid=None), feature(eid=None), feature()]
    with pytest.raises(ErrorThresholdExceeded):
        pipe.ingest_batch(features_df(spark, docs), "b1")
    assert pipe.store.read("ingestion_errors").count() == 2
    assert pipe.store.read("raw_events").count() == 0
    ok = new_pipe(spark, PipelineConfig(max_errors=3))
    assert ok.ingest_batch(features_df(spark, docs), "b1")["events_loaded"] == 1


def test_empty_batch_no_audit(spark):
    pipe = new_pipe(spark)
    assert pipe.ingest_batch(features_df(spark, []), "b0") == {"status": "success",
                                                               "events_fetched": 0}
    assert pipe.store.read("ingestion_audit").count() == 0


def test_quarantine_and_fail_modes(spark):
    docs = [feature(eid="big", mag=10.0), feature(eid="ok"), feature(eid="nolat", coords=[1, None])]
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, docs), "b1")
    pipe.run_transformations("L1")
    pipe.run_transformations("L2")
    errs = pipe.store.read("ingestion_errors").filter(F.col("error_type") != "validation_error")
    assert sorted((r.event_id, r.error_type) for r in errs.collect()) == [
        ("big", "staging_error"), ("nolat", "warehouse_error")]
    strict = new_pipe(spark, PipelineConfig(on_violation="fail"))
    strict.ingest_batch(features_df(spark, docs), "b1")
    with pytest.raises(ViolationError):
        strict.run_transformations("L1")


def test_catalog_window_ingestion(spark):
    pipe = new_pipe(spark)
    t = 1704067200000  # 2024-01-01
    docs = [feature(eid="in", time=t), feature(eid="late", time=t + 10 * 86400000)]
    stats = pipe.run_ingestion(features_df(spark, docs), end_time=dt.datetime(2024, 1, 3),
                               lookback_days=7)
    assert stats["events_loaded"] == 1 and stats["start_time"].startswith("2023-12-27")
    docs = [feature(eid=f"m{i}", time=t + i * 60_000, mag=float(i)) for i in range(6)]
    capped = new_pipe(spark).run_ingestion(features_df(spark, docs), end_time=dt.datetime(2024, 1, 3),
                                           min_magnitude=2, max_results=3)
    assert capped["events_loaded"] == 3  # m5, m4, m3: newest three with magnitude >= 2


def test_runs_consume_only_new_batches_and_recover(spark):
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, [feature(eid="a"), feature(eid="b")]), "b1")
    pipe.run_transformations("L1")
    pipe.ingest_batch(features_df(spark, [feature(eid="b", mag=9.0), feature(eid="c")]), "b2")
    pipe.load_staging("L2")  # a run that stopped after staging
    counts = pipe.run_transformations("L3")
    assert counts["staging_events"] == counts["fact_events"] == 3
    fact_ids = sorted(r.event_id for r in pipe.store.read("fact_events").collect())
    assert fact_ids == ["a", "b", "c"]
    log = {(r.load_id, r.kind, r.consumed_id) for r in pipe.store.read("transform_log").collect()}
    assert ("L1", "raw_batch", "b1") in log and ("L3", "raw_batch", "b2") in log
    assert ("L3", "stg_load", "L2") in log
    # nothing pending: the next run reads no raw batch and adds nothing
    assert pipe.run_transformations("L4") == counts
    assert [(r.kind, r.consumed_id) for r in pipe.store.read("transform_log")
            .filter("load_id = 'L4'").collect()] == [("stg_load", "L4")]


def test_ingest_pages_records_unreadable(spark):
    import json
    pipe = new_pipe(spark)
    page = json.dumps({"type": "FeatureCollection", "metadata": {"count": 1},
                       "features": [feature(eid="a")]})
    pages = spark.createDataFrame([("p1", page), ("p2", "<html>")], "page_id string, value string")
    stats = pipe.ingest_pages(pages, "b1")
    assert (stats["pages"], stats["pages_unreadable"], stats["events_loaded"]) == (2, 1, 1)
    errs = pipe.store.read("ingestion_errors").collect()
    assert [(e.error_type, e.error_message) for e in errs] == [("page_error", "Unreadable page: p2")]


def test_duplicate_in_batch_fail_mode(spark):
    from eventstar.plans.ingest import DuplicateInBatch
    pipe = new_pipe(spark, PipelineConfig(on_violation="fail"))
    with pytest.raises(DuplicateInBatch):
        pipe.ingest_batch(features_df(spark, [feature(), feature()]), "b1")
    audit = pipe.store.read("ingestion_audit").collect()
    assert [(a.status, a.records_inserted) for a in audit] == [("failed", 0)]
    assert pipe.store.read("raw_events").count() == 0


def test_ingest_many_equals_sequential(spark):
    from eventstar.sources.fixture import fixture_pages
    pages = fixture_pages(spark, SF_SMALL)
    parts = [(pages.filter(f"page_id % 3 = {k}"), f"b{k}") for k in range(3)]
    seq, par = new_pipe(spark), new_pipe(spark)
    for df, bid in parts:
        seq.ingest_pages(df, bid)
    stats = par.ingest_many(parts, parallel=3)
    assert [s["batch_id"] for s in stats] == ["b0", "b1", "b2"]
    for table in ["raw_events", "ingestion_errors", "ingestion_audit"]:
        a = seq.store.read(table).select("batch_id", "event_id" if table != "ingestion_audit"
                                         else "records_inserted")
        b = par.store.read(table).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert seq.run_transformations("L") == par.run_transformations("L")


def test_sql_views_match_dataframe_query(spark):
    from eventstar.plans import analytics
    pipe = new_pipe(spark)
    pipe.ingest_batch(fixture_features(spark, SF_SMALL), "b1")
    pipe.run_transformations("L1")
    names = pipe.register_views(prefix="t_")
    assert "t_fact_events" in names and "t_dim_location" in names
    sql = spark.sql("""
        SELECT l.region, COUNT(*) AS event_count, MAX(f.magnitude) AS max_magnitude,
               MIN(f.magnitude) AS min_magnitude,
               SUM(CASE WHEN f.tsunami THEN 1 ELSE 0 END) AS tsunami_events
        FROM t_fact_events f JOIN t_dim_location l ON f.location_key = l.location_key
        GROUP BY l.region""")
    star = pipe.star()
    df = analytics.q1_region(star["fact"], star["dim_location"]).drop("avg_magnitude")
    cols = ["region", "event_count", "max_magnitude", "min_magnitude", "tsunami_events"]
    assert sorted(map(tuple, sql.select(*cols).collect())) == \
        sorted(map(tuple, df.select(*cols).collect()))


def test_ingest_many_failing_batch_does_not_stop_others(spark):
    import json as _json
    pipe = new_pipe(spark, PipelineConfig(max_errors=2))

    def pages(docs):
        body = _json.dumps({"type": "FeatureCollection", "metadata": {"count": len(docs)},
                            "features": docs})
        return spark.createDataFrame([("p", body)], "page_id string, value string")

    good = pages([feature(eid="a"), feature(eid="b")])
    bad = pages([feature(eid=None), feature(eid=None), feature(eid="c")])
    with pytest.raises(ErrorThresholdExceeded):
        pipe.ingest_many([(good, "ok"), (bad, "bad")], parallel=2)
    raw = sorted(r.event_id for r in pipe.store.read("raw_events").collect())
    assert raw == ["a", "b"]
    assert pipe.store.read("ingestion_errors").filter("batch_id = 'bad'").count() == 2


def test_location_keeps_first_depth_category_across_runs(spark):
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, [feature(eid="a", coords=[5, 5, 10])]), "b1")
    pipe.run_transformations("L1")
    pipe.ingest_batch(features_df(spark, [feature(eid="b", coords=[5, 5, 400])]), "b2")
    pipe.run_transformations("L2")
    locs = pipe.store.read("dim_location").collect()
    assert [(l.depth_category, l.place) for l in locs] == [("Shallow", "Test Location")]
    keys = {r.event_id: r.location_key for r in pipe.store.read("fact_events").collect()}
    assert keys["a"] == keys["b"] == locs[0].location_key


def ids(pipe, table):
    return sorted(r.event_id for r in pipe.store.read(table).collect())


def test_a_batch_landed_again_is_consumed_again(spark):
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, [feature(eid="a"), feature(eid=None)]), "b1")
    pipe.run_transformations("L1")
    pipe.ingest_batch(features_df(spark, [feature(eid="a"), feature(eid="b")]), "b1")
    counts = pipe.run_transformations("L2")
    assert counts["raw_events"] == counts["staging_events"] == counts["fact_events"] == 2
    # the corrected feature's error row went with the retry
    assert pipe.store.read("ingestion_errors").count() == 0
    # a completed run is not redone: its rows stay
    assert pipe.run_transformations("L1") == counts
    # without any valid row the batch replaces what it left
    pipe.ingest_batch(features_df(spark, [feature(eid=None)]), "b1")
    assert ids(pipe, "raw_events") == []


def test_batches_without_a_success_audit_row_are_not_consumed(spark):
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, [feature(eid="a")]), "b1")
    half = pipe.store.read("raw_events").withColumn("batch_id", F.lit("b2")).withColumn(
        "event_id", F.lit("half"))
    pipe.store.write(half, "raw_events", "b2")
    pipe.run_transformations("L1")
    assert ids(pipe, "stg_events") == ["a"]


def test_odd_load_ids_are_partition_folders(spark):
    pipe = new_pipe(spark)
    odd = "2024-01-01T00:00:00/é=% [x]"
    pipe.ingest_batch(features_df(spark, [feature(eid="a")]), odd)
    assert pipe.store.has("raw_events", odd)
    pipe.run_transformations(odd)
    assert {r.load_id for r in pipe.store.read("stg_events").collect()} == {odd}


def test_times_outside_the_calendar_are_quarantined(spark):
    pipe = new_pipe(spark)
    docs = [feature(eid=f"t{t}", time=t) for t in (9_000_000_000_000_000_000, 8_000_000_000_000_000,
                                                   253_402_300_799_999, -62_135_596_800_001)]
    pipe.ingest_batch(features_df(spark, [*docs, feature(eid="u", updated=8_000_000_000_000_000)]), "b1")
    counts = pipe.run_transformations("L1")
    assert ids(pipe, "fact_events") == ["t253402300799999"] and counts["dim_time"] == 1
    errors = sorted((r.event_id, r.error_message) for r in pipe.store.read("ingestion_errors").collect())
    assert errors == [("t-62135596800001", "time out of range"), ("t8000000000000000", "time out of range"),
                      ("t9000000000000000000", "time out of range"), ("u", "updated out of range")]


def test_undated_features_reach_validation_through_the_window(spark):
    t = 1704067200000
    docs = [feature(eid="in", time=t), feature(eid="out", time=t + 40 * 86400000),
            feature(eid="none", time=None), feature(eid="zero", time=0), feature(eid="abc", time="abc"),
            feature(eid="frac", time=1704067200000.5)]
    for cap in (None, 1):
        pipe = new_pipe(spark)
        stats = pipe.run_ingestion(features_df(spark, docs), end_time=dt.datetime(2024, 1, 3),
                                   max_results=cap)
        assert (stats["events_fetched"], stats["events_invalid"]) == (5, 2)
        pipe.run_transformations("L1")
        assert ids(pipe, "fact_events") == ["in"]
        assert ids(pipe, "ingestion_errors") == ["abc", "frac", "none", "zero"]


def test_windowed_pages_keep_page_errors(spark):
    import json
    short = json.dumps({"metadata": {"count": 500}, "features": [feature(eid="a", time=1704067200000)]})
    pages = spark.createDataFrame([("p1", short), ("p2", "oops"), ("p3", "{}"), (None, None)],
                                  "page_id string, value string")
    pipe = new_pipe(spark)
    out = pipe.run_full_pipeline(pages=pages, end_time=dt.datetime(2024, 1, 3))["ingestion"]
    assert (out["pages"], out["pages_unreadable"], out["pages_incomplete"], out["events_loaded"]) == (4, 2, 1, 1)
    assert sorted(r.error_message for r in pipe.store.read("ingestion_errors").collect()) == [
        "Page declares 500 features, has 1: p1", "Unreadable page: p2", "Unreadable page: unknown"]


def test_rows_without_location_stay_out_of_the_fact(spark):
    pipe = new_pipe(spark)
    pipe.ingest_batch(features_df(spark, [feature(eid="ok"), feature(eid="nolat", coords=[1, None])]), "b1")
    pipe.run_transformations("L1")
    assert ids(pipe, "fact_events") == ["ok"]
    (err,) = pipe.store.read("ingestion_errors").collect()
    assert err.event_id == "nolat" and '"nolat"' in err.raw_data
