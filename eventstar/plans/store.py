"""Layer tables as Parquet folders partitioned by ``load_id``.

Every write replaces the folder of its own ``load_id``, also by no rows, so a
retried load with the same id rewrites its own rows and nothing else; reads
for anti-joins exclude the current load id so a retry sees the same
"existing" rows as the first attempt.  Parquet has no
multi-table transaction: dimensions are written before the fact, so a reader
can at worst see a dimension row without facts, which inner-join queries
ignore.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventstar.schemas import TABLES
from eventstar.session import written

LOAD_ID = "load_id"
# Characters that Spark writes as %XX in partition folders.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^")


def folder_of(load_id: str) -> str:
    name = "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 0x20 else c for c in load_id)
    return f"{LOAD_ID}={name}"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


class LayerStore:
    """``buckets``: table -> (key, number) of tables stored in buckets by a key.

    Such a table is a catalog table over its folder, partitioned by ``load_id``
    and, within, bucketed and sorted by the key, so joins on the key need not
    move it.  A session whose catalog does not know it yet registers it.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: dict[str, tuple[str, int]] | None = None):
        self.spark = spark
        self.root = root
        self.buckets = buckets or {}

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def schema(self, table: str) -> T.StructType:
        return T.StructType(TABLES[table].fields + [T.StructField(LOAD_ID, T.StringType())])

    def exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(p)

    def begin(self, load_id: str) -> None:
        """A transformation run starts to write ``load_id``."""

    def publish(self, load_id: str) -> None:
        """The run has written all tables of ``load_id``."""

    def has(self, table: str, load_id: str) -> bool:
        return self.exists(os.path.join(self.path(table), folder_of(load_id)))

    def read(self, table: str, exclude_load: str | None = None) -> DataFrame:
        """The table (all loads, or all but ``exclude_load``); an absent
        table reads as empty with its declared schema."""
        if table in self.buckets:
            df = self.spark.table(self._cataloged(table))
        elif self.exists(self.path(table)):
            df = self.spark.read.schema(self.schema(table)).parquet(self.path(table))
        else:
            df = self.spark.createDataFrame([], self.schema(table))
        if exclude_load is not None:
            df = df.filter(F.col(LOAD_ID) != exclude_load)
        return df

    def write(self, df: DataFrame, table: str, load_id: str) -> None:
        # Named jobs (thread-local, so also inside concurrent writers) make
        # event logs and history servers readable on a shared cluster.
        self.spark.sparkContext.setJobDescription(f"eventstar write {table} {load_id}")
        cols = [f.name for f in TABLES[table].fields]
        if table in self.buckets:
            return self._write_buckets(df.select(*cols), table, load_id)
        (df.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .parquet(os.path.join(self.path(table), folder_of(load_id))))

    def _cataloged(self, table: str) -> str:
        """The name of a bucketed table; registered if it is not yet."""
        key, n = self.buckets[table]
        name = f"{table}_{hashlib.md5(self.path(table).encode()).hexdigest()[:12]}"
        if not self.spark.catalog.tableExists(name):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(table).fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
                           f"PARTITIONED BY ({LOAD_ID}) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {n} BUCKETS "
                           f"LOCATION '{_quoted(self.path(table))}'")
            if self.exists(self.path(table)):
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _write_buckets(self, df: DataFrame, table: str, load_id: str) -> None:
        """Replace the partition of ``load_id``.  The rows come from the table
        itself (an anti-join), which may not be overwritten while it is read, so
        they are written aside first; then they are dealt by the key, and a
        bucket of a load is one file."""
        key, n = self.buckets[table]
        name, view = self._cataloged(table), f"load_{uuid.uuid4().hex}"
        written(df, table).repartition(n, key).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD_ID} = '{_quoted(load_id)}') "
                           f"SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
