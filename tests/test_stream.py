"""Incremental ingestion of landed page files with Structured Streaming."""

import os

from eventstar.plans.layers import Batch, build_layers
from eventstar.plans.pipeline import Pipeline
from eventstar.session import scratch_path
from eventstar.sources.fixture import fixture_features, fixture_pages
from eventstar.streaming.incremental import replay_fixture_stream, start_ingest_stream
from tests.conftest import SF_SMALL

COLS = ["event_id", "magnitude", "magnitude_type", "place", "event_time", "latitude",
        "longitude", "depth", "tsunami", "significance"]


def test_stream_equals_batch(spark):
    streamed = replay_fixture_stream(spark, SF_SMALL, pages_per_file=4).select(*COLS)
    batch = build_layers(spark, [Batch(fixture_features(spark, SF_SMALL), "b1")]).stg.select(*COLS)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_processes_each_file_once(spark):
    root = scratch_path(spark, "stream-once")
    landing = os.path.join(root, "landing")
    pages = fixture_pages(spark, SF_SMALL)
    pages.filter("page_id < 5").select("value").write.text(os.path.join(landing, "a"))
    pipe = Pipeline(spark, os.path.join(root, "layers"))
    ck = os.path.join(root, "ck")
    src = os.path.join(landing, "*")
    start_ingest_stream(spark, src, pipe, ck).awaitTermination()
    first = pipe.layer_counts()
    start_ingest_stream(spark, src, pipe, ck).awaitTermination()  # nothing new
    assert pipe.layer_counts() == first
    pages.filter("page_id >= 5").select("value").write.text(os.path.join(landing, "b"))
    start_ingest_stream(spark, src, pipe, ck).awaitTermination()
    after = pipe.layer_counts()
    assert after["raw_events"] > first["raw_events"]
    assert after["fact_events"] == after["staging_events"]
