"""Raw → staging: typed extraction, first-wins dedupe, anti-join increment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstar.functions.jsonpaths import (
    EPOCH_MS_RANGE,
    coordinates_array,
    epoch_millis_to_ntz,
    parse_feature,
    present_but_uncastable,
    with_column_once,
)
from eventstar.operators.firstwins import first_per_key, first_per_key_sparse
from eventstar.operators.joins import anti_join_increment, merge_anti_join
from eventstar.schemas import STG_EVENTS, STRING_BOUNDS

STAGING_ERROR = "staging_error"
_STG_COLS = [f.name for f in STG_EVENTS.fields]


def raw_rows(valid: DataFrame, batch_id: Column | str, ingested_at: Column | None = None,
             text_col: str = "feature") -> DataFrame:
    """Raw-layer envelope of valid features: batch, id, document, arrival time."""
    bid = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return valid.select(
        bid.cast("string").alias("batch_id"),
        F.col("e.id").alias("event_id"),
        F.col(text_col).alias("raw_data"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
    )


def dedupe_batch(raw: DataFrame) -> DataFrame:
    """One raw row per (event_id, batch_id): a page overlap can return an event
    twice within one batch.  Deterministic choice (smallest document text).
    Documents of ids met once, nearly all, are not shuffled."""
    return first_per_key_sparse(raw, ["event_id", "batch_id"], ["raw_data"], ["raw_data", "ingested_at"]) \
        .select("batch_id", "event_id", "raw_data", "ingested_at")


def extract(raw: DataFrame) -> DataFrame:
    """Typed staging columns from raw rows, plus ``reject_reason``.

    Only rows with a magnitude key and a coordinates key are candidates (the
    rest stay in raw and are never staged).  A present value that does not fit
    its column (magnitude 10.0 in DECIMAL(3,2), a fractional integer, an
    over-long string) sets ``reject_reason`` instead of aborting the load.
    """
    p = with_column_once(raw.select("batch_id", "raw_data", "ingested_at"), "e",
                         parse_feature(F.col("raw_data")))
    p = p.filter(F.col("e.properties.mag").isNotNull()
                 & F.col("e.geometry.coordinates").isNotNull())
    props = lambda k: F.col(f"e.properties.{k}")
    p = with_column_once(p, "coords", coordinates_array(F.col("e.geometry.coordinates")))
    texts = {
        "magnitude": F.nullif(props("mag"), F.lit("")),
        "time": props("time"),
        "updated": props("updated"),
        "latitude": F.get(F.col("coords"), 1),
        "longitude": F.get(F.col("coords"), 0),
        "depth": F.get(F.col("coords"), 2),
        "tsunami": props("tsunami"),
        "significance": props("sig"),
    }
    typed = {
        "magnitude": texts["magnitude"].try_cast("decimal(3,2)"),
        "time": texts["time"].try_cast("bigint"),
        "updated": texts["updated"].try_cast("bigint"),
        "latitude": texts["latitude"].try_cast("decimal(9,6)"),
        "longitude": texts["longitude"].try_cast("decimal(9,6)"),
        "depth": texts["depth"].try_cast("decimal(8,3)"),
        "tsunami": texts["tsunami"].try_cast("int"),
        "significance": texts["significance"].try_cast("int"),
    }
    out = p.select(
        F.col("e.id").alias("event_id"),
        typed["magnitude"].alias("magnitude"),
        props("magType").alias("magnitude_type"),
        props("place").alias("place"),
        epoch_millis_to_ntz(typed["time"]).alias("event_time"),
        epoch_millis_to_ntz(typed["updated"]).alias("updated_time"),
        typed["latitude"].alias("latitude"),
        typed["longitude"].alias("longitude"),
        typed["depth"].alias("depth"),
        props("status").alias("status"),
        F.coalesce(typed["tsunami"] != 0, F.lit(False)).alias("tsunami"),
        typed["significance"].alias("significance"),
        F.current_timestamp().alias("processed_at"),
        F.col("batch_id").alias("source_batch_id"),
        F.col("ingested_at"),
        F.col("raw_data"),
        _reject_reason(texts, typed).alias("reject_reason"),
    )
    return out


def _reject_reason(texts: dict, typed: dict) -> Column:
    rule = None
    for name in texts:
        cond = present_but_uncastable(texts[name], typed[name])
        msg = f"{name} value does not fit its column"
        rule = F.when(cond, msg) if rule is None else rule.when(cond, msg)
    for name in ("time", "updated"):
        rule = rule.when(~typed[name].between(*EPOCH_MS_RANGE), f"{name} out of range")
    rule = rule.when(typed["time"].isNull(), "time missing")
    rule = rule.when(F.col("e.id").isNull(), "event_id missing")
    for col, n in STRING_BOUNDS["stg_events"].items():
        src = {"event_id": "e.id", "magnitude_type": "e.properties.magType",
               "status": "e.properties.status"}[col]
        rule = rule.when(F.length(F.col(src)) > n, f"{col} longer than {n}")
    return rule


def stage(raw: DataFrame, staged_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new staging rows, rejected rows) for raw rows not yet staged."""
    return stage_extracted(extract(raw), staged_ids)


def stage_extracted(x: DataFrame, staged_ids: DataFrame, x_rows: int | None = None,
                    buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """:func:`stage` over already extracted rows (see :func:`extract`).

    First-wins per event_id over (ingested_at, batch_id) runs as a partial
    aggregate; the increment is then anti-joined against every staged id
    without shuffling the staged history when the increment is small
    (:func:`anti_join_increment`).  A history stored in ``buckets`` by event id
    is merge-joined where it lies, whatever the increment's size; the new rows
    come out in those buckets.
    """
    good = x.filter(F.col("reject_reason").isNull())
    payload = [c for c in _STG_COLS if c != "event_id"]
    first = first_per_key(good, ["event_id"], ["ingested_at", "source_batch_id"], payload)
    bad = x.filter(F.col("reject_reason").isNotNull())
    if buckets:
        new_rows = merge_anti_join(first, staged_ids, "event_id", buckets)
        return new_rows.select(*_STG_COLS), merge_anti_join(bad, staged_ids, "event_id", buckets)
    new_rows = anti_join_increment(first, staged_ids, ["event_id"], x_rows).select(*_STG_COLS)
    return new_rows, anti_join_increment(bad, staged_ids, ["event_id"], x_rows)


def reject_error_rows(rejected: DataFrame) -> DataFrame:
    """Rejected staging candidates as error-table rows."""
    return rejected.select(
        F.col("source_batch_id").alias("batch_id"),
        F.coalesce(F.col("event_id"), F.lit("unknown")).alias("event_id"),
        F.lit(STAGING_ERROR).alias("error_type"),
        F.col("reject_reason").alias("error_message"),
        F.col("raw_data"),
        F.current_timestamp().alias("occurred_at"),
    )
