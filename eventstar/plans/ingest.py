"""Ingestion of one batch: validate → error rows → threshold → raw → audit.

One parse of the input feeds both sinks (the validated DataFrame is
persisted and released at the end); row counts come from ``Observation``s
attached to the writes, so no extra counting job reads the data again.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.operators.validate import error_rows, split, threshold_exceeded, validate
from eventstar.plans.staging import dedupe_batch, raw_rows
from eventstar.plans.store import LayerStore

THRESHOLD_MESSAGE = "Error threshold exceeded"


class ErrorThresholdExceeded(RuntimeError):
    pass


class DuplicateInBatch(RuntimeError):
    pass


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def audit_row(store: LayerStore, batch_id: str, start: dt.datetime, end: dt.datetime,
              fetched: int, inserted: int, status: str, message: str | None = None) -> DataFrame:
    return store.spark.createDataFrame(
        [(batch_id, start, end, fetched, inserted, status, message)],
        "batch_id string, start_time timestamp, end_time timestamp, records_fetched bigint, "
        "records_inserted bigint, status string, error_message string")


def run_ingestion(store: LayerStore, features: DataFrame, batch_id: str | None = None,
                  config: PipelineConfig = PipelineConfig(),
                  window: tuple | None = None, extra_errors: DataFrame | None = None) -> dict:
    """Land one batch of feature documents (column ``feature``).

    ``extra_errors`` are further error-table rows of the same batch (e.g.
    unreadable pages), written by the same job as the validation errors.
    Returns the run statistics.  Raises :class:`ErrorThresholdExceeded` after
    the error rows are written when the batch holds ``max_errors`` or more
    invalid features; the raw layer is then left untouched.
    """
    batch_id = batch_id or str(uuid.uuid4())
    start = _now()
    validated = validate(features, config).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = Observation("seen")
        observed = validated.observe(
            seen, F.count(F.lit(1)).alias("fetched"),
            F.count_if(F.col("error_message").isNotNull()).alias("invalid"))
        valid, invalid = split(observed)
        errs = error_rows(invalid, batch_id)
        if extra_errors is not None:
            errs = errs.unionByName(extra_errors.select(*errs.columns))
        store.write(errs, "ingestion_errors", batch_id)
        counts = seen.get
        fetched, n_invalid = int(counts["fetched"]), int(counts["invalid"])
        n_valid = fetched - n_invalid
        stats = {"status": "success", "batch_id": batch_id, "events_fetched": fetched}
        # a batch landed again without valid rows replaces what it left before
        again = store.has("raw_events", batch_id)
        if fetched == 0 and not again:
            return {"status": "success", "events_fetched": 0}
        if threshold_exceeded(n_invalid, config.max_errors):
            raise ErrorThresholdExceeded(f"{THRESHOLD_MESSAGE}: {n_invalid}/{config.max_errors}")
        inserted = 0
        if n_valid or again:
            inserted = _load_raw(store, split(validated)[0], batch_id, n_valid, start, config)
        stats.update(events_valid=n_valid, events_invalid=n_invalid, events_loaded=inserted,
                     failed=n_valid - inserted)
        if window is not None:
            stats.update(start_time=window[0].isoformat(), end_time=window[1].isoformat())
        return stats
    finally:
        validated.unpersist()


def _load_raw(store: LayerStore, valid: DataFrame, batch_id: str, n_valid: int,
              start: dt.datetime, config: PipelineConfig) -> int:
    raw = dedupe_batch(raw_rows(valid, batch_id))
    try:
        if config.on_violation == "fail":
            n = raw.count()
            if n != n_valid:
                raise DuplicateInBatch(f"{n_valid - n} duplicated event ids in batch {batch_id}")
        written = Observation("raw")
        store.write(raw.observe(written, F.count(F.lit(1)).alias("n")), "raw_events", batch_id)
        inserted = int(written.get["n"])
    except Exception as exc:
        store.write(audit_row(store, batch_id, start, _now(), n_valid, 0, "failed", str(exc)),
                    "ingestion_audit", batch_id)
        raise
    store.write(audit_row(store, batch_id, start, _now(), n_valid, inserted, "success"),
                "ingestion_audit", batch_id)
    return inserted
