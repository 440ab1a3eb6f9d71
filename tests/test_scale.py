"""Work that must not grow faster than the input: tasks of a read, passes over
documents, batches and micro-batches."""

import datetime as dt

from pyspark.sql import functions as F

from eventstar.operators.ranking import newest
from eventstar.plans.layers import Batch, build_layers
from eventstar.registry import stored_pipeline
from eventstar.session import scratch_path, written
from eventstar.sources.fixture import fixture_features, read_events
from eventstar.streaming.incremental import MICRO_BATCHES, replay_fixture_stream
from eventstar.streaming.stateful import replay_with_state


def events(spark, n=1500):
    """A folder with an ``events`` table of one file; some ids null or twice."""
    root = scratch_path(spark, "events")
    start = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    rows = spark.range(n, numPartitions=1).select(
        F.col("id").alias("event_id"), F.timestamp_add("SECOND", F.col("id") * 60, start).alias("ts"))
    rows.write.parquet(f"{root}/events.parquet")
    return root


def test_a_file_of_many_events_is_dealt_to_many_tasks(spark):
    root = events(spark, 1000)
    odd = spark.read.parquet(f"{root}/events.parquet").filter("event_id < 30")
    odd.unionByName(odd.withColumn("event_id", F.lit(None).cast("bigint"))).write.mode("append") \
        .parquet(f"{root}/events.parquet")
    dealt = read_events(spark, root, rows_per_task=100)
    assert dealt.rdd.getNumPartitions() == 11
    plain = spark.read.parquet(f"{root}/events.parquet")
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()
    sizes = dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 300


def test_kept_layers_make_and_parse_documents_once(spark):
    batch = Batch(fixture_features(spark, events(spark, 300)), "b1", dt.datetime(2024, 1, 2))
    lazy, kept = build_layers(spark, [batch]), build_layers(spark, [batch], keep=written)
    for name, df in kept.tables().items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "from_json" not in plan and "to_json" not in plan, name
        other = lazy.tables()[name]
        cols = [c for c in df.columns if c not in ("processed_at", "loaded_at")]
        assert df.dtypes == other.dtypes
        assert df.select(cols).exceptAll(other.select(cols)).isEmpty() and df.count() == other.count()


def test_a_selection_computes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def time(i):
        seen.add(1)
        return i // 7

    rows = spark.range(200).select("id", time.asNondeterministic()("id").alias("t"))
    got = newest(rows, "t", ["id"], 50).collect()
    want = sorted(((-(i // 7), i) for i in range(200)))[:50]
    assert sorted((-r.t, r.id) for r in got) == want
    assert seen.value == 200


def test_a_backlog_is_drained_in_a_bounded_number_of_micro_batches(spark):
    root = events(spark)
    staged = replay_fixture_stream(spark, root, pages_per_file=1)
    assert 1 < staged.select("load_id").distinct().count() <= MICRO_BATCHES
    want = build_layers(spark, [Batch(fixture_features(spark, root), "b1")]).stg
    cols = ["event_id", "magnitude", "event_time", "depth"]
    assert staged.select(cols).exceptAll(want.select(cols)).isEmpty() and staged.count() == want.count()
    kept = replay_with_state(spark, root, pages_per_file=1)
    assert 1 < kept.select("load_id").distinct().count() <= 6
    assert kept.select(cols).exceptAll(want.select(cols)).isEmpty() and kept.count() == want.count()


def test_many_events_are_landed_in_a_bounded_number_of_batches(spark):
    pipe = stored_pipeline(spark, events(spark), events_per_batch=100, most_batches=3)
    audit = pipe.store.read("ingestion_audit").collect()
    assert len(audit) == 3 and {r.status for r in audit} == {"success"}
    assert pipe.config.max_errors == 2500
