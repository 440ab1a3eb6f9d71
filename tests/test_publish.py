"""Publication of whole loads, month folders, compaction; accounts of fetches."""

import os

import pytest
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.layer_queries import _stop_at
from eventstar.operators.firstwins import first_per_key, first_per_key_sparse
from eventstar.plans import analytics
from eventstar.plans.pipeline import Pipeline
from eventstar.session import scratch_path
from eventstar.sources.pages import fetch_accounting, fetched_features, parse_pages
from tests.conftest import feature, features_df

MONTH = 30 * 86_400_000


def published(spark):
    root = os.path.join(scratch_path(spark, "published"), "layers")
    return Pipeline(spark, root, PipelineConfig(publish_atomically=True))


def test_a_stopped_run_shows_nothing_and_is_done_again(spark):
    pipe = published(spark)
    start = 1_700_000_000_000
    pipe.ingest_batch(features_df(spark, [feature("a", time=start, coords=(1, 1, 1))]), "one")
    _stop_at(pipe, "fact_events", "L1")
    reader = Pipeline(spark, pipe.store.root, pipe.config)
    assert not any(df.count() for name, df in reader.tables().items() if name != "raw_events")
    pipe.ingest_batch(features_df(spark, [feature("a", time=start), feature("b", time=start + MONTH, mag=6.5),
                                          feature("c", time=start + 2 * MONTH)]), "two")
    assert reader.run_transformations("L1")["fact_events"] == 3
    assert reader.run_transformations("L2")["fact_events"] == 3                 # nothing new
    fact = reader.store.read("fact_events")
    assert {r["event_month"] for r in fact.collect()} == {"2023-11", "2023-12", "2024-01"}
    # a filter on times opens the folders of its months only
    star = reader.star()
    import datetime as dt
    top = analytics.q6_high_impact(star["fact"], star["dim_time"], star["dim_location"], star["dim_event_type"],
                                   as_of=dt.date(2024, 1, 10))
    assert [r["event_id"] for r in top.collect()] == ["b", "c"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")           # plans are cut at 100 characters
    try:
        plan = reader.store.read("fact_events").filter("event_month >= '2023-12'")._jdf \
            .queryExecution().executedPlan().toString()
        assert "(event_month#" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
        plan = top._jdf.queryExecution().optimizedPlan().toString()
        assert "(event_month#" in plan
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    before = sorted(map(str, fact.drop("load_id").collect()))
    assert reader.store.compact("fact_events", 1).startswith("compact-")
    again = Pipeline(spark, pipe.store.root, pipe.config).store.read("fact_events")
    assert sorted(map(str, again.drop("load_id").collect())) == before
    assert again.select(F.input_file_name()).distinct().count() == 3 and reader.store.compact("fact_events") is None
    assert reader.store.read("stg_events").count() == 3


def test_publication_and_buckets_exclude_each_other():
    with pytest.raises(ValueError, match="cannot be combined"):
        PipelineConfig(publish_atomically=True, staging_buckets=4)


def page(spark, rows):
    pages = spark.createDataFrame(rows, "fetch_id string, page_no bigint, page_id string, value string")
    return parse_pages(pages, ("fetch_id", "page_no"))


def text(count, *ids):
    declared = "" if count is None else f'"count":{count}'
    return '{"metadata":{%s},"features":[%s]}' % (declared, ",".join(f'{{"id":"{i}"}}' for i in ids))


def test_fetches_end_as_they_are_read(spark):
    rows = [("whole", 0, "w0", text(3, "a", "b")), ("whole", 1, "w1", text(3, "c")), ("whole", 2, "w2", text(3, "d")),
            ("short", 0, "s0", text(9, "a")), ("short", 1, "s1", text(9, "b")),
            ("failing", 0, "f0", text(9, "a")), ("failing", 1, "f1", "<html>"), ("failing", 2, "f2", text(9, "c")),
            ("empty", 0, "e0", text(9)), ("empty", 1, "e1", text(9, "x")),
            ("silent", 0, "n0", text(None, "a")), ("silent", 1, "n1", text(None, "b"))]
    got = {r["page_id"]: (r["state"], r["fetched"], r["kept"]) for r in fetch_accounting(page(spark, rows)).collect()}
    assert got == {"w0": ("read", 2, 2), "w1": ("complete", 3, 1), "w2": ("surplus", 4, 0),
                   "s0": ("read", 1, 1), "s1": ("read", 2, 1),
                   "f0": ("read", 1, 1), "f1": ("failed", 1, 0), "f2": ("surplus", 2, 0),
                   "e0": ("empty", 0, 0), "e1": ("surplus", 1, 0),
                   "n0": ("complete", 1, 1), "n1": ("surplus", 2, 0)}
    capped = {r["page_id"]: (r["state"], r["kept"]) for r in fetch_accounting(page(spark, rows), 1).collect()}
    assert capped["w0"] == ("capped", 1) and capped["w1"] == ("surplus", 0) and capped["f0"] == ("capped", 1)
    feats = fetched_features(page(spark, rows)).collect()
    assert sorted((r["page_id"], r["feature"]) for r in feats) == sorted(
        (p, f'{{"id":"{i}"}}') for p, i in [("w0", "a"), ("w0", "b"), ("w1", "c"), ("s0", "a"), ("s1", "b"),
                                            ("f0", "a"), ("n0", "a")])
    assert fetch_accounting(page(spark, [])).count() == 0


def test_sparse_first_wins_equals_the_plain_one(spark):
    rows = [(f"k{i % 40 if i % 5 else i}", None if i % 3 else "p", (i * 7) % 11, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, p string, o int, v string")
    want = first_per_key(df, ["k", "p"], ["o"], ["o", "v"])
    got = first_per_key_sparse(df, ["k", "p"], ["o"], ["o", "v"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    once = df.filter("v IN ('v1', 'v2')")
    plan = first_per_key_sparse(once, ["k", "p"], ["o"], ["o", "v"])
    assert plan.count() == 2
    assert "Aggregate" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert first_per_key_sparse(df.filter(F.lit(False)), ["k"], ["o"], ["v"]).count() == 0
