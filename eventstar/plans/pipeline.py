"""The whole pipeline over a :class:`LayerStore`: ingestion, transformations,
layer counts."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventstar.config import PipelineConfig
from eventstar.operators.violations import violations
from eventstar.plans import analytics, densekeys, staging, warehouse
from eventstar.plans.ingest import run_ingestion
from eventstar.plans.publish import PublishedStore
from eventstar.plans.store import LayerStore
from eventstar.sources.catalog import catalog_window, lookback_window
from eventstar.sources.pages import explode_features, page_errors, parse_pages

# Fixed value: (reported name, table) of the layer counts, in report order.
LAYER_TABLES = [
    ("raw_events", "raw_events"),
    ("staging_events", "stg_events"),
    ("fact_events", "fact_events"),
    ("dim_time", "dim_time"),
    ("dim_location", "dim_location"),
    ("dim_event_type", "dim_event_type"),
]


class ViolationError(RuntimeError):
    pass


def _side_by_side(*jobs) -> None:
    """Run independent writes of one run as concurrent Spark jobs."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()


def layer_counts_frame(tables: dict[str, DataFrame]) -> DataFrame:
    """One (layer, row_count) row per layer, as one job over six scans."""
    parts = [tables[name].agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("layer"), "row_count") for name, _ in LAYER_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class Pipeline:
    """Batch ELT over a folder of layer tables."""

    def __init__(self, spark: SparkSession, root: str, config: PipelineConfig = PipelineConfig()):
        self.spark = spark
        buckets = {"stg_events": ("event_id", config.staging_buckets)} if config.staging_buckets else {}
        self.store = PublishedStore(spark, root) if config.publish_atomically else \
            LayerStore(spark, root, buckets)
        self.config = config

    # -- ingestion ---------------------------------------------------------
    def run_ingestion(self, features: DataFrame, start_time: dt.datetime | None = None,
                      end_time: dt.datetime | None = None, lookback_days: int | None = None,
                      batch_id: str | None = None, min_magnitude: float | None = None,
                      max_results: int | None = None) -> dict:
        """Select the catalog window of ``features`` (optionally a minimum
        magnitude and a cap on the newest events) and land it as one batch."""
        start, end = lookback_window(start_time, end_time,
                                     lookback_days or self.config.lookback_days)
        # rows without a readable time go on to validation, not out of sight
        window = catalog_window(features, start, end, min_magnitude=min_magnitude,
                                max_results=max_results, keep_undated=True)
        return run_ingestion(self.store, window, batch_id, self.config, window=(start, end))

    def ingest_batch(self, features: DataFrame, batch_id: str | None = None) -> dict:
        """Land ``features`` as they are (no window)."""
        return run_ingestion(self.store, features, batch_id, self.config)

    def ingest_pages(self, pages: DataFrame, batch_id: str | None = None,
                     start_time: dt.datetime | None = None, end_time: dt.datetime | None = None,
                     lookback_days: int | None = None, windowed: bool = False) -> dict:
        """Land catalog pages (``page_id``, ``value``) as one batch, with
        ``windowed`` only their features in the catalog window.

        Pages that are not FeatureCollections, and pages that declare another
        number of features than they have, are recorded in the error table
        (``page_error``); the features there are are ingested.  Page counts
        are reported.  The pages are read and parsed once for all of it; page
        errors and validation errors are written by one job.
        """
        batch_id = batch_id or str(uuid.uuid4())
        parsed = parse_pages(pages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            seen = Observation("pages")
            observed = parsed.observe(
                seen, F.count(F.lit(1)).alias("pages"),
                F.count_if(~F.col("readable")).alias("unreadable"),
                F.count_if(F.col("readable") & ~F.col("complete")).alias("incomplete"))
            features, window = explode_features(parsed), None
            if windowed:
                window = lookback_window(start_time, end_time,
                                         lookback_days or self.config.lookback_days)
                features = catalog_window(features, *window, keep_undated=True)
            stats = run_ingestion(self.store, features, batch_id, self.config, window=window,
                                  extra_errors=page_errors(observed, batch_id))
        finally:
            parsed.unpersist()
        counts = seen.get
        stats.update(pages=int(counts["pages"]), pages_unreadable=int(counts["unreadable"]),
                     pages_incomplete=int(counts["incomplete"]))
        return stats

    def ingest_many(self, batches: list[tuple[DataFrame, str]], parallel: int = 4) -> list[dict]:
        """Land several independent batches of pages (backfill).

        Each batch writes only its own ``load_id`` partitions, and which
        version of an event wins is decided later at staging (by ingestion
        time), so batches do not interact: their Spark jobs are submitted
        from ``parallel`` threads and run side by side on the cluster.
        Statistics come back in input order.  A failing batch raises after
        the others finished (its error rows and audit row are written, as in
        a sequential run).
        """
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            futures = [pool.submit(self.ingest_pages, pages, batch_id)
                       for pages, batch_id in batches]
            return [f.result() for f in futures]

    # -- transformations ---------------------------------------------------
    def run_transformations(self, load_id: str | None = None) -> dict:
        """Raw → staging → star schema, then the layer counts.

        Only raw batches that landed whole and that no completed run has
        consumed in their present version are read (partition pruning on
        ``load_id``): a batch landed again under its id is pending again, and
        history is not rescanned on every run.  Staging still anti-joins every
        staged id, so an event re-fetched in a later batch is not staged twice.
        The run's consumption is logged last; a run that fails before that is
        simply redone by the next one.
        """
        load_id = self._open(load_id or str(uuid.uuid4()))
        self.store.begin(load_id)
        batches = self.load_staging(load_id)
        loads = self.load_warehouse(load_id)
        self.store.publish(load_id)
        self._close(load_id, batches, loads)
        return self.layer_counts()

    def _open(self, load_id: str) -> str:
        """Record the start of a run.  A run that completed, or whose staged
        rows another run has moved on, is not redone: its rows stay, and what
        is pending runs under a fresh id."""
        done = self.store.read("transform_runs").filter(
            (F.col("load_id") == load_id) & (F.col("state") == "completed")).select("load_id")
        moved = self.store.read("transform_log", exclude_load=load_id).filter(
            (F.col("kind") == "stg_load") & (F.col("consumed_id") == load_id)).select("load_id")
        if not done.unionByName(moved).isEmpty():
            load_id = f"{load_id}-{uuid.uuid4().hex[:8]}"
        self._mark(load_id, "started")
        return load_id

    def _mark(self, load_id: str, state: str) -> None:
        one = self.spark.range(1).select(F.lit(state).alias("state"),
                                         F.current_timestamp().alias("at"))
        self.store.write(one, "transform_runs", load_id)

    def _close(self, load_id: str, batches: list[tuple[str, dt.datetime]],
               loads: list[str]) -> None:
        rows = [("raw_batch", b, v) for b, v in batches] + [("stg_load", x, None) for x in loads]
        df = self.spark.createDataFrame(rows, "kind string, consumed_id string, version timestamp") \
            .withColumn("completed_at", F.current_timestamp())
        self.store.write(df, "transform_log", load_id)
        self._mark(load_id, "completed")

    def _log(self, kind: str, load_id: str) -> DataFrame:
        return self.store.read("transform_log", exclude_load=load_id).filter(
            F.col("kind") == kind).select("consumed_id", "version")

    def _pending_batches(self, load_id: str) -> list[tuple[str, dt.datetime]]:
        """Batches that landed whole (their audit row says success) and that no
        other run consumed as they are now.  The log is joined in Spark; only
        the pending batches reach the driver."""
        landed = self.store.read("ingestion_audit").filter(F.col("status") == "success") \
            .select(F.col("batch_id").alias("consumed_id"), F.col("end_time").alias("version"))
        rows = landed.join(self._log("raw_batch", load_id), ["consumed_id", "version"], "left_anti")
        return sorted((r[0], r[1]) for r in rows.collect())

    def _unfinished_runs(self, load_id: str) -> list[str]:
        """Other runs that started and did not complete."""
        runs = self.store.read("transform_runs", exclude_load=load_id)
        return sorted(r[0] for r in runs.filter(F.col("state") == "started")
                      .select("load_id").distinct().collect())

    def load_staging(self, load_id: str) -> list[tuple[str, dt.datetime]]:
        """Stage the pending raw batches; returns them with their versions."""
        st = self.store
        self.spark.sparkContext.setJobDescription(f"eventstar staging {load_id}")
        if not st.has("transform_runs", load_id):
            self._mark(load_id, "started")
        batches = self._pending_batches(load_id)
        raw = st.read("raw_events").filter(F.col("load_id").isin([b for b, _ in batches]))
        staged_ids = st.read("stg_events", exclude_load=load_id).select("event_id")
        # Parsed once for both outputs (rejects and staged rows).
        x = staging.extract(raw).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # The counted increment decides whether its keys are broadcast
            # against the staged history (see anti_join_increment).
            n = x.count()
            new_rows, rejected = staging.stage_extracted(x, staged_ids, n, self.config.staging_buckets)
            if self.config.on_violation == "fail":
                bad = rejected.select("event_id", "reject_reason").limit(1).collect()
                if bad:
                    raise ViolationError(
                        f"staging: {bad[0]['event_id']}: {bad[0]['reject_reason']}")
                st.write(new_rows, "stg_events", load_id)
            else:
                # A rejected raw row stays unstaged; record it once per (batch, event).
                errs = staging.reject_error_rows(rejected)
                known = st.read("ingestion_errors", exclude_load=load_id) \
                    .filter(F.col("error_type") == staging.STAGING_ERROR) \
                    .select("batch_id", "event_id")
                _side_by_side(
                    lambda: st.write(errs.join(known, ["batch_id", "event_id"], "left_anti"),
                                     "ingestion_errors", load_id),
                    lambda: st.write(new_rows, "stg_events", load_id))
        finally:
            x.unpersist()
        return batches

    def load_warehouse(self, load_id: str) -> list[str]:
        """Move this run's staging load, and those of runs that did not
        complete, into the star schema; returns them.  A completed run has
        moved all staging loads there were, so the rows are anti-joined only
        against fact partitions of unfinished runs: neither staging nor the
        fact is scanned whole."""
        st = self.store
        self.spark.sparkContext.setJobDescription(f"eventstar warehouse {load_id}")
        unfinished = self._unfinished_runs(load_id)
        moved = {r[0] for r in self._log("stg_load", load_id)
                 .filter(F.col("consumed_id").isin(unfinished)).collect()}
        loads = [x for x in unfinished if x not in moved] + [load_id]
        stg = st.read("stg_events").filter(F.col("load_id").isin(loads))
        fact = st.read("fact_events").filter(F.col("load_id").isin(unfinished))
        src = warehouse.unloaded(stg, fact).persist(StorageLevel.MEMORY_AND_DISK)
        dense = self.config.surrogate_keys == "dense"
        try:
            n = src.count()
            make = densekeys.dense_increment if dense else warehouse.increment
            inc = make(src, st.read("dim_time", exclude_load=load_id),
                       st.read("dim_location", exclude_load=load_id),
                       st.read("dim_event_type", exclude_load=load_id), src_rows=n)
            if self.config.on_violation == "fail":
                bad = inc.violations.select("event_id").limit(1).collect()
                if bad:
                    raise ViolationError(f"warehouse: {bad[0]['event_id']}: no location")
            writes = [lambda: st.write(inc.dim_time, "dim_time", load_id),
                      lambda: st.write(inc.dim_location, "dim_location", load_id),
                      lambda: st.write(inc.dim_event_type, "dim_event_type", load_id)]
            if self.config.on_violation != "fail":
                writes.append(lambda: st.write(self._with_documents(inc.violations),
                                               "ingestion_errors", f"{load_id}-warehouse"))
            _side_by_side(*writes)  # dimensions first, then the fact
            if dense:
                inc.fact = densekeys.dense_facts(src, st.read("dim_location"), st.read("dim_event_type"),
                                                 st.read("fact_events", exclude_load=load_id), n)
            else:
                self._check_keys(load_id)
            # Sorted by time within each file: min/max statistics then let
            # time-window filters (Q6) skip row groups.
            st.write(inc.fact.sortWithinPartitions("event_time"), "fact_events", load_id)
            if self.config.report_states:
                mine = st.read("fact_events").filter(F.col("load_id") == load_id)
                _side_by_side(*[lambda n=n, s=s: st.write(s, f"state_{n}", load_id)
                                for n, s in analytics.partial_states(mine).items()])
        finally:
            src.unpersist()
        return loads

    def _check_keys(self, load_id: str) -> None:
        """Stop before the fact is written if two dimension rows share a key."""
        dims = [self.store.read(t) for t in ("dim_location", "dim_event_type")]
        mine, others = F.col("load_id") == load_id, F.col("load_id") != load_id
        twice = warehouse.key_collisions(*(d.filter(mine) for d in dims),
                                         *(d.filter(others) for d in dims)).limit(1).collect()
        if twice:
            raise ViolationError(f"warehouse: two dimension rows with the key {twice[0][0]}")

    def _with_documents(self, violations: DataFrame) -> DataFrame:
        """Error rows with the raw documents of their events; only the raw
        batches that have such rows are read."""
        batches = [r[0] for r in violations.select("batch_id").distinct().collect()]
        raw = self.store.read("raw_events").filter(F.col("load_id").isin(batches)) \
            .select("batch_id", "event_id", "raw_data")
        return violations.drop("raw_data").join(raw, ["batch_id", "event_id"], "left")

    # -- reporting ---------------------------------------------------------
    def tables(self) -> dict[str, DataFrame]:
        return {name: self.store.read(table) for name, table in LAYER_TABLES}

    def layer_counts(self) -> dict:
        rows = layer_counts_frame(self.tables()).collect()  # six rows
        return {r["layer"]: int(r["row_count"]) for r in rows}

    def merged_reports(self) -> dict[str, DataFrame]:
        """Q1-Q5 from the states that the loads have stored: their size follows
        the keys, not the events, and the fact is not read.  Needs
        ``report_states`` for all loads."""
        st = self.store
        s = {n: analytics.merged_states(n, st.read(f"state_{n}")) for n in analytics.PARTIALS}
        days, places = st.read("dim_time"), st.read("dim_location")
        return {"q1_region": analytics.q1_report(s["by_location"], places),
                "q2_weekday": analytics.q2_report(s["by_day"], days),
                "q3_depth": analytics.q3_report(s["significant"], places),
                "q4_month": analytics.q4_report(s["by_day"], days),
                "q5_magtype": analytics.q5_report(s["by_type"], st.read("dim_event_type"))}

    def load_violations(self, load_id: str) -> DataFrame:
        """What the rows of one load break beside those of all others: rule,
        key and number of rows (see ``eventstar.operators.violations``)."""
        names = ["stg_events", "dim_time", "dim_location", "dim_event_type", "fact_events"]
        mine = {t: self.store.read(t).filter(F.col("load_id") == load_id).drop("load_id") for t in names}
        others = {t: self.store.read(t, exclude_load=load_id).drop("load_id") for t in names}
        return violations(mine, others)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every layer table as a temporary view (``prefix`` + table
        name) so analysts can query the warehouse with ``spark.sql``; Catalyst
        plans the SQL exactly like the DataFrame queries.  Returns the names."""
        from eventstar.schemas import TABLES

        names = []
        for table in TABLES:
            self.store.read(table).drop("load_id").createOrReplaceTempView(prefix + table)
            names.append(prefix + table)
        return names

    def star(self) -> dict[str, DataFrame]:
        st = self.store
        return {"fact": st.read("fact_events"), "dim_time": st.read("dim_time"),
                "dim_location": st.read("dim_location"),
                "dim_event_type": st.read("dim_event_type"),
                "errors": st.read("ingestion_errors")}

    # -- whole run ---------------------------------------------------------
    def run_full_pipeline(self, features: DataFrame | None = None,
                          start_time: dt.datetime | None = None,
                          end_time: dt.datetime | None = None,
                          pages: DataFrame | None = None) -> dict:
        """Ingest the window of ``features`` (or of ``pages``), transform, and
        report both."""
        t0 = time.time()
        ingestion = self.run_ingestion(features, start_time, end_time) if pages is None else \
            self.ingest_pages(pages, None, start_time, end_time, windowed=True)
        transformations = self.run_transformations()
        end = dt.datetime.now(dt.timezone.utc)
        return {"status": "success", "duration_seconds": time.time() - t0,
                "ingestion": ingestion, "transformations": transformations,
                "completed_at": end.isoformat()}

    run = run_full_pipeline
