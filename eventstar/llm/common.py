"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.session import scratch_path

#: Rows up to which ``small_side`` hints a broadcast of a few narrow columns.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts the
    lineage, survives lost executors and is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are at most ``limit``;
    unchanged otherwise, so the join shuffles.  For narrow rows only."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def join_hot(rows: DataFrame, info: DataFrame, key: str, weight: str, total: int,
             how: str = "inner", share: int = 1000) -> DataFrame:
    """``rows`` joined to the one row that ``info`` has per key, where a key may
    hold a large part of ``rows``.

    ``weight`` is the column of ``info`` (kept) with the key's number of rows
    out of ``total``.  Keys with at least a ``share``-th of them, of which there
    are ``share`` at most, are joined by broadcast where the rows are; the
    others are shuffled.
    """
    hot = info.filter(F.col(weight) * share >= total)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(
        cold.join(info.filter(F.col(weight) * share < total), key, how))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch inside the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from fn(b)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text_column: str, max_bytes: int = 8 << 20
           ) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of about ``max_bytes`` of text, so that a task
    holds the working arrays of few texts at a time."""
    col = batch.column(batch.schema.get_field_index(text_column))
    start, size = 0, 0
    for i in range(batch.num_rows):
        v = col[i]
        n = len(v.as_buffer()) if v.is_valid else 0
        if i > start and size + n > max_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)
