"""Named queries over the test tables: each builds its layers from the
``events`` table (through the fixture rule) and returns a DataFrame whose
columns match the statement of the same name in ``eventstar.oracle``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar import layer_queries, oracle
from eventstar.config import PipelineConfig
from eventstar.functions.jsonpaths import parse_feature
from eventstar.operators.checks import integrity_checks
from eventstar.operators.validate import split, validate
from eventstar.plans import analytics
from eventstar.plans.ingest import DuplicateInBatch, ErrorThresholdExceeded
from eventstar.plans.layers import Batch, Layers, build_layers, land, staged_increment
from eventstar.plans.pipeline import layer_counts_frame
from eventstar.session import written
from eventstar.sources.catalog import catalog_window
from eventstar.sources.fixture import fixture_features, fixture_pages
from eventstar.sources.pages import explode_features, page_accounting, page_errors, parse_pages

STG_OUT = ["event_id", "magnitude", "magnitude_type", "place", "event_time", "updated_time",
           "latitude", "longitude", "depth", "status", "tsunami", "significance",
           "source_batch_id"]


def _ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def _planning(spark: SparkSession) -> None:
    """The fixture projects many CASE expressions; inferring constraints over
    them makes plan optimisation superlinear (seconds to minutes, and heap),
    while the inferred filters add nothing here.  Turn it off for the session."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return build_layers(spark, [Batch(fixture_features(spark, sf_dir), oracle.BATCH_1)], keep=written)


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land([Batch(fixture_features(spark, sf_dir), oracle.BATCH_1)])[1]


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[Batch, Batch]:
    feats = fixture_features(spark, sf_dir, extra=", ts AS source_ts")
    b1 = feats.filter(F.col("source_ts") < F.lit(_ts(oracle.SPLIT_HIGH)).cast("timestamp_ntz"))
    b2 = feats.filter(F.col("source_ts") >= F.lit(_ts(oracle.SPLIT_LOW)).cast("timestamp_ntz"))
    return (Batch(b1.drop("source_ts"), oracle.BATCH_1, _ts(oracle.SPLIT_HIGH)),
            Batch(b2.drop("source_ts"), oracle.BATCH_2, dt.datetime(2024, 1, 31)))


def landed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = explode_features(parse_pages(fixture_pages(spark, sf_dir)))
    valid, _ = split(validate(feats))
    return valid.select(F.col("page_id").cast("bigint").alias("page_id"),
                        F.col("e.id").alias("event_id"))


def catalog_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = catalog_window(fixture_features(spark, sf_dir), _ts(oracle.WINDOW[0]),
                       _ts(oracle.WINDOW[1]), min_magnitude=oracle.WINDOW_MIN_MAG,
                       max_results=oracle.WINDOW_CAP)
    e = parse_feature(F.col("feature"))
    return w.select(e["id"].alias("event_id"),
                    e["properties"]["time"].try_cast("bigint").alias("time_ms"),
                    e["properties"]["mag"].try_cast("decimal(3,2)").alias("magnitude"))


def page_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_accounting(parse_pages(fixture_pages(spark, sf_dir)))


def validate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split(validate(fixture_features(spark, sf_dir)))
    return valid.select(F.col("e.id").alias("event_id"))


def validate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(spark, sf_dir).select("event_id", "error_type", "error_message")


def validate_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = PipelineConfig(check_ranges=True, magnitude_range=oracle.RANGE_MAGNITUDE,
                         depth_range=oracle.RANGE_DEPTH)
    _, invalid = split(validate(fixture_features(spark, sf_dir), cfg))
    return invalid.select(F.coalesce(F.col("e.id"), F.lit("unknown")).alias("event_id"),
                          "error_message")


def error_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion of the same broken features under three limits: the default,
    one that their number reaches, and one that it just misses."""
    feats = fixture_features(spark, sf_dir)
    n = split(validate(feats))[1].count()
    outcome = []
    for run, limit in (("default", PipelineConfig().max_errors), ("reached", n), ("missed", n + 1)):
        pipe = _scratch_pipeline(spark, "threshold", PipelineConfig(max_errors=limit))
        try:
            pipe.ingest_batch(feats, run)
            exceeded = False
        except ErrorThresholdExceeded:
            exceeded = True
        counts = pipe.store.read("ingestion_errors").agg(F.count(F.lit(1)).alias("invalid_count")).join(
            pipe.store.read("raw_events").agg(F.count(F.lit(1)).alias("raw_rows")))
        outcome.append(counts.select(F.lit(run).alias("run"), "invalid_count", F.lit(limit).alias("max_errors"),
                                     F.lit(exceeded).alias("exceeded"), "raw_rows"))
    return outcome[0].unionByName(outcome[1]).unionByName(outcome[2])


def batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored audit rows of a batch and of one that failed, as it offers
    every event twice under the rule that this fails."""
    pipe = _scratch_pipeline(spark, "audit", PipelineConfig(max_errors=None, on_violation="fail"))
    feats = fixture_features(spark, sf_dir)
    pipe.ingest_batch(feats, oracle.BATCH_1)
    try:
        pipe.ingest_batch(feats.unionByName(feats), oracle.BATCH_2)
    except DuplicateInBatch:
        pass
    return pipe.store.read("ingestion_audit").select(
        "batch_id", "records_fetched", "records_inserted", "status", "error_message",
        (F.col("start_time") <= F.col("end_time")).alias("in_time"))


def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).stg.select(*STG_OUT)


def staging_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    b1, b2 = _two_batches(spark, sf_dir)
    return staged_increment(spark, [b1], [b2], keep=written).select(*STG_OUT)


def staging_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    b1, b2 = _two_batches(spark, sf_dir)
    return build_layers(spark, [b1, b2], keep=written).stg.select(*STG_OUT)


def dim_time_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).dim_time


def dim_location_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).dim_location.select(
        "latitude", "longitude", "depth_category", "region", "place")


def dim_event_type_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers(spark, sf_dir).dim_event_type.select(
        "magnitude_type", "magnitude_category", "description")


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lay = layers(spark, sf_dir)
    return (lay.fact
            .join(lay.dim_time.select("time_key", "date_actual"), "time_key", "left")
            .join(lay.dim_location.select("location_key", "latitude", "longitude", "place"),
                  "location_key", "left")
            .join(lay.dim_event_type.select("event_type_key", "magnitude_type"),
                  "event_type_key", "left")
            .select("event_id", "date_actual", "latitude", "longitude", "place",
                    "magnitude_type", "magnitude", "depth", "significance", "tsunami",
                    "status", "event_time"))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = layers(spark, sf_dir).tables()
    return layer_counts_frame({
        "raw_events": t["raw_events"], "staging_events": t["stg_events"],
        "fact_events": t["fact_events"], "dim_time": t["dim_time"],
        "dim_location": t["dim_location"], "dim_event_type": t["dim_event_type"]})


def q1_region(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q1_region(lay.fact, lay.dim_location)


def q1b_region_short(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q1b_region_short(lay.fact, lay.dim_location)


def q2_weekday(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q2_weekday(lay.fact, lay.dim_time)


def q3_depth(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q3_depth(lay.fact, lay.dim_location)


def q4_month(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q4_month(lay.fact, lay.dim_time)


def q5_magtype(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q5_magtype(lay.fact, lay.dim_event_type)


def q6_high_impact(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return analytics.q6_high_impact(lay.fact, lay.dim_time, lay.dim_location,
                                    lay.dim_event_type, as_of=dt.date.fromisoformat(oracle.AS_OF))


def q7_recent_errors(spark, sf_dir):
    return analytics.q7_recent_errors(_errors(spark, sf_dir)).drop("occurred_at")


def stored_pipeline(spark: SparkSession, sf_dir: str, events_per_batch: int = 10_000,
                    most_batches: int = 16):
    """Run the stored pipeline over the fixture's pages: batches of about
    ``events_per_batch`` events (every page in exactly one batch) landed
    side by side, then one transformation run.  Beyond ``most_batches`` of them
    the batches grow instead, and the limit of errors in proportion: every
    batch costs a dozen jobs, whose results all go to the driver.  Tables go
    below the session's scratch folder."""
    import math
    import os

    from eventstar.plans.pipeline import Pipeline
    from eventstar.session import scratch_path
    from eventstar.sources.fixture import count_events

    root = scratch_path(spark, "stored")
    wanted = max(1, math.ceil(count_events(spark, sf_dir) / events_per_batch))
    n = min(wanted, most_batches)
    limit = PipelineConfig().max_errors * math.ceil(wanted / n)
    # The pages are built once; a page's batch is its id's remainder.
    (fixture_pages(spark, sf_dir, page_size=100)
     .withColumn("part", F.pmod("page_id", F.lit(n)).cast("int"))
     .write.partitionBy("part").parquet(os.path.join(root, "pages")))
    pages = spark.read.parquet(os.path.join(root, "pages"))
    batches = [(pages.filter(F.col("part") == k).drop("part"), f"fixture-{k:04d}")
               for k in range(n)]
    pipe = Pipeline(spark, os.path.join(root, "layers"), PipelineConfig(max_errors=limit))
    pipe.ingest_many(batches)
    pipe.run_transformations("fixture-load")
    return pipe


def _scratch_pipeline(spark: SparkSession, name: str, config: PipelineConfig = PipelineConfig()):
    import os

    from eventstar.plans.pipeline import Pipeline
    from eventstar.session import scratch_path
    return Pipeline(spark, os.path.join(scratch_path(spark, name), "layers"), config)


#: No error limit: the fixture's share of broken rows is fixed, their number is not.
_NO_LIMIT = PipelineConfig(max_errors=None)


def _second_load(spark: SparkSession, sf_dir: str):
    """Two stored loads of overlapping batches; the first lacks one magnitude
    type and some places.  The rows of load "second" went through every
    anti-join against history."""
    pipe = _scratch_pipeline(spark, "increment", _NO_LIMIT)
    for name, rows in layer_queries.halves(spark, sf_dir):
        pipe.ingest_batch(rows, name)
        pipe.run_transformations(name)
    return pipe.store


def _of_second(spark, sf_dir, table, *cols):
    return _second_load(spark, sf_dir).read(table).filter("load_id = 'second'").select(*cols)


def dim_time_increment(spark, sf_dir):
    """Days that the second load adds."""
    return _of_second(spark, sf_dir, "dim_time", "time_key", "date_actual", "week_of_year")


def dim_location_increment(spark, sf_dir):
    """Locations that the second load adds."""
    return _of_second(spark, sf_dir, "dim_location", "latitude", "longitude", "place",
                      "depth_category", "region")


def dim_event_type_increment(spark, sf_dir):
    """Magnitude types that the second load adds."""
    return _of_second(spark, sf_dir, "dim_event_type", "magnitude_type", "magnitude_category",
                      "description")


def fact_increment(spark, sf_dir):
    """Facts that the second load adds."""
    return _of_second(spark, sf_dir, "fact_events", "event_id", "time_key", "magnitude",
                      "event_time")


def retry_batch(spark, sf_dir):
    """A batch landed in part, transformed, landed again whole under its id,
    and transformed again: nothing is lost or doubled."""
    pipe = _scratch_pipeline(spark, "retry", _NO_LIMIT)
    feats = fixture_features(spark, sf_dir, extra=", event_id AS seq")
    for load, rows in (("L1", F.col("seq") % 3 == 0), ("L2", F.lit(True))):
        pipe.ingest_batch(feats.filter(rows).select("feature"), "b1")
        pipe.run_transformations(load)
    return pipe.store.read("fact_events").select("event_id", "time_key", "magnitude")


def retry_empties_errors(spark, sf_dir):
    """Error rows left after a batch with broken features is landed again
    without them: those of the other batch only."""
    pipe = _scratch_pipeline(spark, "retry-errors", _NO_LIMIT)
    feats = fixture_features(spark, sf_dir, extra=", event_id AS seq")
    judged = written(validate(feats).select("feature", "seq", "error_message"), "judged")
    broken = judged.filter("error_message IS NOT NULL").select("feature", "seq")
    sound = judged.filter("error_message IS NULL").select("feature", "seq")
    for batch, part in (("b0", 0), ("b1", 1)):
        pipe.ingest_batch(broken.unionByName(sound).filter(F.col("seq") % 2 == part)
                          .select("feature"), batch)
    pipe.ingest_batch(sound.filter("seq % 2 = 1").select("feature"), "b1")
    return pipe.store.read("ingestion_errors").groupBy("batch_id", "error_message").agg(
        F.count(F.lit(1)).alias("n_errors"))


def window_ingestion(spark, sf_dir):
    """Statistics of a windowed ingestion: every feature without a readable
    time is offered to validation beside those of the window."""
    pipe = _scratch_pipeline(spark, "window", _NO_LIMIT)
    stats = pipe.run_ingestion(fixture_features(spark, sf_dir), _ts(oracle.WINDOW[0]),
                               _ts(oracle.WINDOW[1]), batch_id="w")
    audit = pipe.store.read("ingestion_audit").select("records_fetched", "records_inserted")
    return audit.select(F.lit(stats["events_fetched"]).cast("bigint").alias("events_fetched"),
                        F.lit(stats["events_invalid"]).cast("bigint").alias("events_invalid"),
                        "records_fetched", "records_inserted")


def page_error_rows(spark, sf_dir):
    """Pages with a wrong count, without features and unreadable ones."""
    pages = fixture_pages(spark, sf_dir)
    kind = F.pmod("page_id", F.lit(4))
    broken = pages.select("page_id", F.when(kind == 1, F.regexp_replace(
        "value", '"count":[0-9]+', '"count":7777')).when(kind == 2, F.lit("<html>"))
        .when(kind == 3, F.lit('{"type":"FeatureCollection"}')).otherwise(F.col("value"))
        .alias("value"))
    rows = page_errors(parse_pages(broken), "b1")
    return rows.select("error_type", "error_message")


def integrity(spark, sf_dir):
    """Integrity checks over the stored warehouse built from the fixture."""
    st = stored_pipeline(spark, sf_dir).store
    return integrity_checks({name: st.read(name) for name in
                             ["raw_events", "stg_events", "dim_time", "dim_location",
                              "dim_event_type", "fact_events"]})


def stream_increment(spark, sf_dir):
    from eventstar.streaming.incremental import replay_fixture_stream
    return replay_fixture_stream(spark, sf_dir).select(*STG_OUT[:-1])


def _comparable(df: DataFrame) -> DataFrame:
    """Output types that every client converts alike: DECIMAL as DOUBLE (the
    oracle engine hands decimals to pandas as floats) and DATE as a
    timestamp.  Values are unchanged; the layer tables keep their types."""
    from pyspark.sql import types as T

    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _planned(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _planning(spark)
        return _comparable(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _planned(fn) for name, fn in (_QUERIES | layer_queries.QUERIES).items()}


_QUERIES = {
        "landed_features": landed_features,
        "catalog_window": catalog_window_q,
        "page_count_check": page_count_check,
        "validate_valid": validate_valid,
        "validate_errors": validate_errors,
        "validate_ranges": validate_ranges,
        "error_threshold": error_threshold,
        "batch_audit": batch_audit,
        "staging_load": staging_load,
        "staging_increment": staging_increment,
        "staging_overlap": staging_overlap,
        "dim_time_load": dim_time_load,
        "dim_location_load": dim_location_load,
        "dim_event_type_load": dim_event_type_load,
        "fact_load": fact_load,
        "layer_counts": layer_counts,
        "q1_region": q1_region,
        "q1b_region_short": q1b_region_short,
        "q2_weekday": q2_weekday,
        "q3_depth": q3_depth,
        "q4_month": q4_month,
        "q5_magtype": q5_magtype,
        "q6_high_impact": q6_high_impact,
        "q7_recent_errors": q7_recent_errors,
        "integrity_checks": integrity,
        "stream_increment": stream_increment,
        "dim_time_increment": dim_time_increment,
        "dim_location_increment": dim_location_increment,
        "dim_event_type_increment": dim_event_type_increment,
        "fact_increment": fact_increment,
        "retry_batch": retry_batch,
        "retry_empties_errors": retry_empties_errors,
        "window_ingestion": window_ingestion,
        "page_error_rows": page_error_rows,
}


__all__ = ["queries", "stored_pipeline"]
