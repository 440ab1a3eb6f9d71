"""Loads that are published as a whole.

A transformation run writes staging, dimensions and fact as separate Parquet
tables.  Here each attempt at a load writes into folders of its own,
``table/load_id=X/attempt=Y``, and a manifest row written last names the
attempt that counts.  Readers see published attempts only (and the run that
writes, its own): a run that stops between two tables leaves nothing to be
seen, and the next one does its work again.

The manifest has a row per load.  It is written as one file, which the commit
of the write makes visible at once; a published load is not published again.
Old attempts stay as files until :meth:`PublishedStore.compact` rewrites the
table; compaction is an attempt, too, whose manifest row names the loads that
it stands for.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventstar.plans.store import LOAD_ID, LayerStore, folder_of
from eventstar.schemas import TABLES

#: Tables that a transformation run writes together.
TOGETHER = ("stg_events", "dim_time", "dim_location", "dim_event_type", "fact_events",
            "state_by_location", "state_significant", "state_by_day", "state_by_type")
MONTH = "event_month"
MANIFEST = "load_id string, attempt string, table_name string, stands_for array<string>"


class PublishedStore(LayerStore):
    """A :class:`LayerStore` whose loads of :data:`TOGETHER` appear at once.

    The fact is also partitioned by month, so a filter on its times opens the
    folders of those months only.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.attempts: dict[str, str] = {}            # of loads being written here

    def begin(self, load_id: str) -> None:
        self.attempts[load_id] = uuid.uuid4().hex

    def publish(self, load_id: str) -> None:
        """Make what this attempt has written visible."""
        self._manifest([(load_id, self.attempts[load_id], None, None)], load_id)
        del self.attempts[load_id]

    def _manifest(self, rows: list[tuple], name: str) -> None:
        df = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        df.write.mode("errorifexists").parquet(os.path.join(self.path("manifest"), folder_of(name)))

    def published(self) -> DataFrame:
        """load_id, attempt, table_name (null: all), stands_for."""
        if not self.exists(self.path("manifest")):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(os.path.join(self.path("manifest"), "*"))

    def _visible(self, table: str) -> list[tuple[str, str]]:
        """(load, attempt) that readers of ``table`` see; the manifest has a row
        per run, compactions keep those that count few."""
        rows = (self.published().filter(F.col("table_name").isNull() | (F.col("table_name") == table))
                .select("load_id", "attempt", "stands_for").collect())
        replaced = {load for r in rows for load in r["stands_for"] or []}
        return [(r["load_id"], r["attempt"]) for r in rows if r["load_id"] not in replaced]

    def read(self, table: str, exclude_load: str | None = None) -> DataFrame:
        if table not in TOGETHER:
            return super().read(table, exclude_load)
        schema = self.schema(table).add("attempt", T.StringType())
        if table == "fact_events":
            schema = schema.add(MONTH, T.StringType())
        if not self.exists(self.path(table)):
            return self.spark.createDataFrame([], self.schema(table))
        rows = self.spark.read.schema(schema).parquet(self.path(table))
        ids = [*self._visible(table), *self.attempts.items()]
        rows = rows.filter(F.col("attempt").isin([a for load, a in ids if load != exclude_load]))
        return rows.drop("attempt")

    def write(self, df: DataFrame, table: str, load_id: str) -> None:
        if table not in TOGETHER:
            return super().write(df, table, load_id)
        if load_id not in self.attempts:
            self.begin(load_id)
        self._write_attempt(df, table, load_id, self.attempts[load_id])

    def _write_attempt(self, df: DataFrame, table: str, load_id: str, attempt: str) -> None:
        cols = [f.name for f in TABLES[table].fields]
        path = os.path.join(self.path(table), folder_of(load_id), f"attempt={attempt}")
        if table == "fact_events":
            (df.select(*cols, F.date_format("event_time", "yyyy-MM").alias(MONTH))
             .sortWithinPartitions(MONTH, "event_time").write.mode("overwrite").partitionBy(MONTH).parquet(path))
        else:
            df.select(*cols).write.mode("overwrite").parquet(path)

    def compact(self, table: str, partitions: int | None = None) -> str | None:
        """Rewrite all published loads of ``table`` as one, with few files;
        returns its load id.  Readers see the old loads until the new one is
        published; a load published meanwhile stays beside it.  The files of
        the loads it stands for can be removed once no reader uses them."""
        loads = sorted(load for load, _ in self._visible(table))
        if len(loads) < 2:
            return None
        name, attempt = f"compact-{uuid.uuid4().hex[:12]}", uuid.uuid4().hex
        rows = self.read(table).filter(F.col(LOAD_ID).isin(loads))
        if table == "fact_events":
            month = F.date_format("event_time", "yyyy-MM")
            rows = rows.repartitionByRange(month, "event_time") if partitions is None else \
                rows.repartitionByRange(partitions, month, "event_time")
        elif partitions is not None:
            rows = rows.repartition(partitions)
        self._write_attempt(rows, table, name, attempt)
        self._manifest([(name, attempt, table, loads)], name)
        return name
