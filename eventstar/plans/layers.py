"""All layers of one or more batches as lazy DataFrames (nothing written).

The same plan pieces the stored pipeline uses, composed into one logical
plan: handy for tests, for the driver's query registry and for reasoning
about a load before running it.  Whoever reads several layers, or large ones,
passes ``keep`` (such as ``eventstar.session.written``), which is given the raw
candidates and the staging layer, so that documents are made and parsed once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.operators.validate import error_rows, split, validate
from eventstar.plans import staging, warehouse
from eventstar.schemas import DIM_EVENT_TYPE, DIM_LOCATION, DIM_TIME, STG_EVENTS


@dataclass
class Batch:
    features: DataFrame
    batch_id: str
    ingested_at: dt.datetime | None = None


@dataclass
class Layers:
    raw: DataFrame
    errors: DataFrame
    stg: DataFrame
    dim_time: DataFrame
    dim_location: DataFrame
    dim_event_type: DataFrame
    fact: DataFrame
    rejected: DataFrame
    violations: DataFrame
    valid: DataFrame = field(repr=False, default=None)
    invalid: DataFrame = field(repr=False, default=None)

    def tables(self) -> dict[str, DataFrame]:
        return {"raw_events": self.raw, "stg_events": self.stg, "dim_time": self.dim_time,
                "dim_location": self.dim_location, "dim_event_type": self.dim_event_type,
                "fact_events": self.fact}


def _empty(spark: SparkSession, schema) -> DataFrame:
    """An empty table Catalyst can prove empty (``limit(0)`` becomes an
    empty local relation), so joins against it are removed from the plan."""
    return spark.createDataFrame([], schema).limit(0)


def _ts(t: dt.datetime | None) -> Column | None:
    return F.lit(t).cast("timestamp") if t is not None else None


Keep = Callable[[DataFrame, str], DataFrame]


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


def land(batches: list[Batch], config: PipelineConfig | None = None,
         keep: Keep = _lazy) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(raw, errors, valid, invalid) of the given batches."""
    raws, errs, valids, invalids = [], [], [], []
    for b in batches:
        valid, invalid = split(validate(b.features, config))
        # read twice by the deduplication, and by every layer above
        candidates = keep(staging.raw_rows(valid, b.batch_id, _ts(b.ingested_at)), "raw")
        raws.append(staging.dedupe_batch(candidates))
        errs.append(error_rows(invalid, b.batch_id, _ts(b.ingested_at)))
        valids.append(valid)
        invalids.append(invalid)

    def union(xs):
        out = xs[0]
        for x in xs[1:]:
            out = out.unionByName(x)
        return out
    return union(raws), union(errs), union(valids), union(invalids)


def build_layers(spark: SparkSession, batches: list[Batch],
                 config: PipelineConfig | None = None,
                 staged: DataFrame | None = None, keep: Keep = _lazy) -> Layers:
    """Every layer after landing ``batches`` and running one transformation.

    ``staged`` are rows already in staging before this run (default none);
    the star schema is built from scratch over staged ∪ new rows.
    """
    raw, errors, valid, invalid = land(batches, config, keep)
    staged = staged if staged is not None else _empty(spark, STG_EVENTS)
    new_stg, rejected = staging.stage(raw, staged.select("event_id"))
    stg = keep(staged.select(*[f.name for f in STG_EVENTS.fields]).unionByName(new_stg), "stg")
    inc = warehouse.increment(stg, _empty(spark, DIM_TIME), _empty(spark, DIM_LOCATION),
                              _empty(spark, DIM_EVENT_TYPE))
    return Layers(raw=raw, errors=errors, stg=stg, dim_time=inc.dim_time,
                  dim_location=inc.dim_location, dim_event_type=inc.dim_event_type,
                  fact=inc.fact, rejected=rejected, violations=inc.violations,
                  valid=valid, invalid=invalid)


def staged_increment(spark: SparkSession, first: list[Batch], second: list[Batch],
                     config: PipelineConfig | None = None, keep: Keep = _lazy) -> DataFrame:
    """Rows the second run adds to staging after the first run staged its own."""
    raw1, _, _, _ = land(first, config, keep)
    empty = _empty(spark, STG_EVENTS).select("event_id")
    stg1, _ = staging.stage(raw1, empty)
    raw2, _, _, _ = land(second, config, keep)
    new2, _ = staging.stage(raw1.unionByName(raw2), stg1.select("event_id"))
    return new2


__all__ = ["Batch", "Layers", "build_layers", "land", "staged_increment"]
