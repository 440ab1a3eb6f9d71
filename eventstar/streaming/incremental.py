"""Incremental ingestion of newly landed page files (Structured Streaming).

A file-source stream over the landing folder feeds ``foreachBatch``: each
micro-batch is one ingestion batch followed by one transformation run, with
the batch id derived from the epoch id.  A micro-batch replayed after a
failure reuses its id, and every write replaces only that id's partitions,
so the layers see each landed file exactly once.  The source checkpoint
remembers which files were processed; ``availableNow`` drains what is there
and stops, so any scheduler can trigger it.

A micro-batch costs some twenty jobs and a scan of the staged ids, whatever it
holds.  A backlog is therefore drained in a bounded number of micro-batches,
which grow with it (:func:`files_per_micro_batch`).
"""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventstar.config import PipelineConfig
from eventstar.plans.pipeline import Pipeline
from eventstar.session import scratch_path, written
from eventstar.sources.fixture import fixture_pages


#: Micro-batches that drain a backlog.
MICRO_BATCHES = 8


def files_per_micro_batch(spark: SparkSession, landing: str, micro_batches: int = MICRO_BATCHES) -> int:
    """Files a trigger takes so that those in ``landing`` are drained in at
    most ``micro_batches``; one as long as there are no more."""
    return max(1, -(-len(spark.read.text(landing).inputFiles()) // micro_batches))


def start_ingest_stream(spark: SparkSession, landing: str, pipeline: Pipeline,
                        checkpoint: str, files_per_batch: int | None = None,
                        wholetext: bool = False, prefix: str = "stream") -> StreamingQuery:
    """Drain ``landing`` (page files: one page per line, or one per file with
    ``wholetext``) into the pipeline's layers."""
    reader = spark.readStream.format("text").option("wholetext", str(wholetext).lower())
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    pages = reader.load(landing).select(F.col("_metadata.file_path").alias("page_id"), "value")

    def each_batch(df: DataFrame, epoch_id: int) -> None:
        batch_id = f"{prefix}-{epoch_id:08d}"
        stats = pipeline.ingest_pages(df, batch_id)
        if stats.get("events_fetched", 0):
            pipeline.run_transformations(load_id=batch_id)

    return (pages.writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def replay_fixture_stream(spark: SparkSession, sf_dir: str,
                          config: PipelineConfig = PipelineConfig(),
                          pages_per_file: int = 100) -> DataFrame:
    """Land the fixture's pages as files of at most ``pages_per_file`` pages,
    every tenth page a second time in another file, drain them in up to
    ``MICRO_BATCHES`` micro-batches of a file or, if there are more files, of
    several, and return the resulting staging table.  The limit of errors is
    that of a file, times the files of a micro-batch."""
    root = scratch_path(spark, "stream")
    landing = os.path.join(root, "landing")
    pages = written(fixture_pages(spark, sf_dir), "pages")
    for name, part in (("all", pages), ("again", pages.filter("page_id % 10 = 0"))):
        (part.select("value").write.option("maxRecordsPerFile", pages_per_file)
         .text(os.path.join(landing, name)))
    files = files_per_micro_batch(spark, os.path.join(landing, "*"))
    if config.max_errors is not None:
        config = replace(config, max_errors=config.max_errors * files)
    pipe = Pipeline(spark, os.path.join(root, "layers"), config)
    q = start_ingest_stream(spark, os.path.join(landing, "*"), pipe,
                            os.path.join(root, "checkpoint"), files_per_batch=files)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return pipe.store.read("stg_events")
