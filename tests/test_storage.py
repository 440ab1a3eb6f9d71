"""Bucketed staging, dense keys, rules by load, stateful stream."""

import os

import pytest
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.operators.violations import violations
from eventstar.plans.pipeline import Pipeline
from eventstar.plans.staging import extract, stage_extracted
from eventstar.plans.store import LayerStore
from eventstar.session import scratch_path
from eventstar.streaming.stateful import start_stateful_stream
from tests.conftest import feature, features_df


def pipeline(spark, **options):
    return Pipeline(spark, os.path.join(scratch_path(spark, "storage"), "layers"), PipelineConfig(**options))


def load(pipe, spark, docs, name):
    pipe.ingest_batch(features_df(spark, docs), name)
    return pipe.run_transformations(name)


# ------------------------------------------------------------------ buckets

def test_the_bucketed_history_is_not_moved(spark):
    pipe = pipeline(spark, staging_buckets=4)
    load(pipe, spark, [feature(f"e{i}") for i in range(20)], "one")
    load(pipe, spark, [feature(f"e{i}") for i in range(10, 30)], "two")
    stg = pipe.store.read("stg_events")
    assert {(r["event_id"], r["load_id"]) for r in stg.collect()} == \
        {(f"e{i}", "one") for i in range(20)} | {(f"e{i}", "two") for i in range(20, 30)}
    raw = pipe.store.read("raw_events").drop("load_id")
    new, _ = stage_extracted(extract(raw), stg.select("event_id"), None, 4)
    plan = new._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "Scan parquet" in line and "stg_events" in line]
    assert scan and "Bucketed: true" in scan[0]
    below = plan[plan.index("SortMergeJoin"):]
    join_side = [line for line in below.splitlines() if line.strip()]
    depth = {line: len(line) - len(line.lstrip(" :+-")) for line in join_side}
    at = join_side.index(scan[0])
    above = []
    level = depth[scan[0]]
    for line in reversed(join_side[:at]):
        if depth[line] < level:
            above.append(line)
            level = depth[line]
    assert not any("Exchange" in line for line in above), above


def test_a_bucketed_load_replaces_itself_and_is_found_by_another_catalog(spark):
    pipe = pipeline(spark, staging_buckets=3)
    load(pipe, spark, [feature("a"), feature("b")], "it's")
    rows = pipe.store.read("stg_events").drop("load_id")
    pipe.store.write(rows.filter("event_id = 'a'"), "stg_events", "it's")
    assert [r["event_id"] for r in pipe.store.read("stg_events").collect()] == ["a"]
    pipe.store.write(rows.limit(0), "stg_events", "empty")
    spark.sql(f"DROP TABLE {pipe.store._cataloged('stg_events')}")           # the files stay
    again = LayerStore(spark, pipe.store.root, pipe.store.buckets)
    assert [(r["event_id"], r["load_id"]) for r in again.read("stg_events").collect()] == [("a", "it's")]
    assert again.read("stg_events", exclude_load="it's").count() == 0


# --------------------------------------------------------------- dense keys

def test_dense_keys_go_on_and_are_the_same_for_a_retry(spark):
    pipe = pipeline(spark, surrogate_keys="dense")
    docs = [feature(f"e{i}", coords=(i % 5, i % 3, 10), place=None if i % 2 else "x",
                    magType=["mw", "ml", None][i % 3]) for i in range(30)]
    load(pipe, spark, docs[:12], "one")
    load(pipe, spark, docs, "two")
    star = pipe.star()
    for name, key in (("dim_location", "location_key"), ("dim_event_type", "event_type_key"),
                      ("fact", "fact_key")):
        keys = sorted(r[0] for r in star[name].select(key).collect())
        assert keys == list(range(1, len(keys) + 1))
        first = star[name].filter("load_id = 'one'")
        assert first.agg(F.max(key)).first()[0] == first.count()
    joined = (star["fact"].join(star["dim_location"].drop("load_id"), "location_key")
              .select("event_id", "latitude", "longitude", "place"))
    assert {r["event_id"]: (int(r["longitude"]), int(r["latitude"]), r["place"]) for r in joined.collect()} == \
        {f"e{i}": (i % 5, i % 3, None if i % 2 else "x") for i in range(30)}
    before = sorted(map(tuple, star["fact"].drop("loaded_at").collect()))
    pipe.load_warehouse("two")                                               # the same load once more
    assert sorted(map(tuple, pipe.star()["fact"].drop("loaded_at").collect())) == before
    assert violations({"fact_events": star["fact"].limit(0)}, star | {"fact_events": star["fact"]}).count() == 0


def test_unknown_key_kind_is_refused():
    with pytest.raises(ValueError, match="surrogate_keys"):
        PipelineConfig(surrogate_keys="serial")


# --------------------------------------------------------------- violations

def test_a_sound_load_breaks_nothing_and_a_repeated_one_is_named(spark):
    pipe = pipeline(spark)
    load(pipe, spark, [feature("a"), feature("b", place=None)], "one")
    load(pipe, spark, [feature("c", magType="ml")], "two")
    assert pipe.load_violations("two").count() == 0
    star = pipe.star()
    repeated = star["fact"].drop("load_id").filter("event_id = 'a'")
    found = violations({"fact_events": repeated.withColumn("location_key", F.lit(5).cast("bigint"))},
                       {"fact_events": star["fact"], "dim_time": star["dim_time"],
                        "dim_location": star["dim_location"], "dim_event_type": star["dim_event_type"]})
    rows = {(r["rule"], r["key"]): r["n_rows"] for r in found.collect()}
    assert rows.pop(("unique(event_id)", "a")) == 2
    assert rows.pop(("foreign_key(location_key)", "5")) == 1
    assert [rule for rule, _ in rows] == ["unique(fact_key)"]


def test_null_keys_repeat_nothing(spark):
    schema = "location_key bigint, latitude decimal(9,6), longitude decimal(9,6), depth_category string, " \
             "region string, place string"
    rows = spark.createDataFrame([(1, None, None, "Deep", "Other", None), (None, None, None, "Deep", "Other", None)],
                                 schema)
    got = {(r["rule"], r["key"]): r["n_rows"] for r in violations({"dim_location": rows}, {}).collect()}
    assert got == {("not_null(latitude)", "null|null|"): 2, ("not_null(longitude)", "null|null|"): 2}


def test_history_is_only_looked_up(spark):
    pipe = pipeline(spark)
    load(pipe, spark, [feature(f"e{i}") for i in range(20)], "one")
    load(pipe, spark, [feature("x")], "two")
    plan = pipe.load_violations("two")._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "CartesianProduct" not in plan


# ------------------------------------------------------------------- stream

def test_repeats_and_late_pages_are_settled_in_state(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    pipe = pipeline(spark, max_errors=None)

    def land(name, *docs):
        feats = features_df(spark, list(docs)).collect()
        (landing / name).write_text('{"type":"FeatureCollection","metadata":{"count":%d},"features":[%s]}\n'
                                    % (len(docs), ",".join(f["feature"] for f in feats)))

    def drain():
        query = start_stateful_stream(spark, str(landing), pipe, str(tmp_path / "check"), files_per_batch=1)
        query.awaitTermination()
        assert query.exception() is None
        return query

    land("a.json", feature("e1"), feature("e2"), feature("bad", time=None), feature("big", mag=10.0))
    land("b.json", feature("e1", mag=1.0), feature("e3"))
    drain()
    land("c.json", feature("e2"), feature("old", time=1000), feature("big", mag=5.0))   # late, and mended
    (landing / "d.json").write_text("<html>\n")
    last = drain()
    stg = pipe.store.read("stg_events")
    assert {r["event_id"]: float(r["magnitude"]) for r in stg.collect()} == \
        {"e1": 5.2, "e2": 5.2, "e3": 5.2, "old": 5.2, "big": 5.0}
    errors = {(r["event_id"], r["error_type"]) for r in pipe.store.read("ingestion_errors").collect()}
    assert errors == {("bad", "validation_error"), ("big", "staging_error"), ("unknown", "page_error")}
    assert pipe.store.read("raw_events").count() == 8
    # the ids met are state; no layer table is read
    state = last.lastProgress["stateOperators"][0]
    assert state["operatorName"] == "dedupeWithinWatermark" and state["numRowsTotal"] == 5
    assert all("layers" not in str(s["description"]) for s in last.lastProgress["sources"])
