"""Incremental staging with keyed state.

``eventstar.streaming.incremental`` anti-joins each micro-batch against all
staged ids.  Here the ids seen are the state of the stream: an event is staged
when its id is met first, and repeats within ``horizon`` are dropped by the
state store, which is partitioned by id and dropped by the watermark.  No
micro-batch reads a layer table, so its cost depends on what it holds and not
on the history.

The watermark runs on the arrival of events, not on the time they tell of: an
event of last year that lands today is not late.  So nothing is dropped for its
age; ``horizon`` only has to span the time over which the source repeats an
event (its lookback window).  A repeat after that would be staged again;
``Pipeline.load_violations`` names it.

Each micro-batch writes valid features to the raw layer, broken pages and
features to the error table, and first-met events to staging, under its own
load id; a batch replayed after a failure has the same arrival times and
rewrites its rows.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventstar.config import PipelineConfig
from eventstar.operators.validate import error_rows, split, validate
from eventstar.plans import staging
from eventstar.plans.pipeline import Pipeline
from eventstar.session import scratch_path, written
from eventstar.sources.fixture import fixture_pages
from eventstar.sources.pages import explode_features, page_errors, parse_pages
from eventstar.streaming.incremental import files_per_micro_batch

HORIZON = "30 days"
_STAGED = [c for c in staging.STG_EVENTS.fieldNames()]
_ERROR = ["batch_id", "event_id", "error_type", "error_message", "raw_data"]


def first_met(rows: DataFrame, horizon: str = HORIZON) -> DataFrame:
    """The rows of a stream whose ``event_id`` was not met within ``horizon``
    of their ``ingested_at``."""
    return rows.withWatermark("ingested_at", horizon).dropDuplicatesWithinWatermark(["event_id"])


def _packed(df: DataFrame, kind: str, cols: list[str]) -> DataFrame:
    """Rows of one kind in the common form of the stream: a column per kind."""
    nothing = {"raw": _RAW_TYPE, "error": _ERROR_TYPE, "staged": _STAGED_TYPE}
    return df.select(F.lit(kind).alias("kind"), *[
        (F.struct(*cols) if k == kind else F.lit(None)).cast(t).alias(k) for k, t in nothing.items()])


_RAW_TYPE = "struct<event_id string, raw_data string>"
_ERROR_TYPE = "struct<event_id string, error_type string, error_message string, raw_data string>"
_STAGED_TYPE = staging.STG_EVENTS.simpleString()


def classified(pages: DataFrame, config: PipelineConfig, horizon: str = HORIZON) -> DataFrame:
    """kind, raw, error, staged: all that a stream of pages gives."""
    parsed = parse_pages(pages.withColumn("ingested_at", F.current_timestamp()), ("ingested_at",))
    valid, invalid = split(validate(explode_features(parsed, ("ingested_at",)), config))
    raw = staging.raw_rows(valid, "", F.col("ingested_at"))
    extracted = staging.extract(raw)
    sound = first_met(extracted.filter(F.col("reject_reason").isNull()), horizon)
    rejected = staging.reject_error_rows(extracted.filter(F.col("reject_reason").isNotNull()))
    errors = [page_errors(parsed, ""), error_rows(invalid, ""), rejected]
    out = _packed(raw, "raw", ["event_id", "raw_data"]).unionByName(_packed(sound, "staged", _STAGED))
    for df in errors:
        out = out.unionByName(_packed(df, "error", _ERROR[1:]))
    return out


def start_stateful_stream(spark: SparkSession, landing: str, pipeline: Pipeline, checkpoint: str,
                          files_per_batch: int | None = None, horizon: str = HORIZON,
                          prefix: str = "state") -> StreamingQuery:
    """Drain ``landing`` (page files, one page per line) into raw, error and
    staging tables, with the ids met as keyed state below ``checkpoint``."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    pages = reader.load(landing).select(F.col("_metadata.file_path").alias("page_id"), "value")
    store = pipeline.store

    def each_batch(df: DataFrame, epoch_id: int) -> None:
        load = f"{prefix}-{epoch_id:08d}"
        batch = F.lit(load).alias("batch_id")
        rows = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            raw = rows.filter("kind = 'raw'").select(batch, "raw.*", F.current_timestamp().alias("ingested_at"))
            store.write(staging.dedupe_batch(raw), "raw_events", load)
            store.write(rows.filter("kind = 'error'").select(
                batch, "error.*", F.current_timestamp().alias("occurred_at")), "ingestion_errors", load)
            store.write(rows.filter("kind = 'staged'").select("staged.*").withColumn(
                "source_batch_id", batch), "stg_events", load)
        finally:
            rows.unpersist()

    return (classified(pages, pipeline.config, horizon).writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def replay_with_state(spark: SparkSession, sf_dir: str, pages_per_file: int = 100) -> DataFrame:
    """Land the fixture's pages as files, every fifth page again in later
    files and the first pages last of all, drain each in a few micro-batches
    (see :func:`files_per_micro_batch`), and return the staging table."""
    root = scratch_path(spark, "state-stream")
    landing = os.path.join(root, "landing")
    pages = written(fixture_pages(spark, sf_dir), "pages")
    first = F.col("page_id") < 10
    config = PipelineConfig(max_errors=None)
    pipe = Pipeline(spark, os.path.join(root, "layers"), config)
    for name, part in (("main", pages.filter(~first)), ("again", pages.filter("page_id % 5 = 0")),
                       ("late", pages.filter(first))):
        (part.select("value").write.option("maxRecordsPerFile", pages_per_file)
         .text(os.path.join(landing, name)))
        files = files_per_micro_batch(spark, os.path.join(landing, name), 2)
        query = start_stateful_stream(spark, os.path.join(landing, "*"), pipe,
                                      os.path.join(root, "checkpoint"), files_per_batch=files)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return pipe.store.read("stg_events")
