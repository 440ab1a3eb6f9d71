"""Joins of a small increment against a large history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest increment (rows) whose key hashes are broadcast: 8 bytes a row.
BROADCAST_KEY_LIMIT = 2_000_000


def reduce_to(history: DataFrame, new: DataFrame, keys: list[str],
              new_rows: int | None = None) -> DataFrame:
    """The rows of ``history`` whose ``keys`` may occur in ``new``.

    For an increment counted at up to :data:`BROADCAST_KEY_LIMIT` rows
    (``new_rows``) those whose key hash occurs in it: the hashes, of a fixed
    width however long the keys are, are broadcast, and the history is scanned
    but never shuffled.  Beyond that, or without a count, all of it.
    """
    if new_rows is None or new_rows > BROADCAST_KEY_LIMIT:
        return history
    hashes = new.select(F.xxhash64(*keys).alias("_hash"))
    return (history.withColumn("_hash", F.xxhash64(*keys))
            .join(F.broadcast(hashes), "_hash", "left_semi").drop("_hash"))


def anti_join_increment(new: DataFrame, history: DataFrame, keys: list[str],
                        new_rows: int | None = None) -> DataFrame:
    """``new`` rows whose ``keys`` do not occur in ``history``.

    A plain left-anti join can only broadcast its right side, the large
    history, so both sides are shuffled.  Here the history's key columns are
    first reduced to those the increment may hit (:func:`reduce_to`); the
    anti-join on the keys themselves then runs between two small sides.  NULL
    keys never match in either form.
    """
    return new.join(reduce_to(history.select(*keys), new, keys, new_rows), keys, "left_anti")


def merge_anti_join(new: DataFrame, history: DataFrame, key: str, buckets: int) -> DataFrame:
    """``new`` rows whose ``key`` does not occur in a ``history`` that is stored
    in ``buckets`` by it: ``new`` is dealt into the same buckets, and each meets
    its part of the history where that lies.  The history is not moved, however
    large the increment is."""
    return new.repartition(buckets, key).join(history.select(key).hint("merge"), key, "left_anti")
