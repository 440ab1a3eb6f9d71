"""Ranks and top-n selections that no single task computes.

A window without partitions, and a limit of millions of rows, end in one task.
Here rows are sorted over range partitions and numbered within theirs; the
partitions' counts, a row each, give the offsets.  A selection of the newest
``n`` first finds the time of the n-th row by histograms of fixed size and then
filters; only rows of that very time are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventstar.session import written

_ROW_BITS = 33          # monotonically_increasing_id: partition above, row below
BINS = 4096


def numbered(df: DataFrame, order: list[Column | str], name: str = "number", start: int = 0) -> DataFrame:
    """``df`` with ``name``: start + 1, start + 2, ... in ``order``, without gaps.

    Rows equal in ``order`` meet in one partition, so it should be unique up to
    a few rows.  The numbers depend on the rows only, not on the partitions, as
    far as ``order`` is unique.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # a row per partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.lit(start) + F.col("_offset") + local + 1).drop("_part", "_offset", "_at"))


def cut_of_newest(times: DataFrame, time: str, n: int) -> tuple[int, int, int] | None:
    """(cut, wanted, there): the time of the n-th newest row, how many rows of
    that very time belong to the newest ``n``, and how many there are; None if
    there are at most ``n`` rows.  Null times are not counted."""
    low, high, total = times.agg(F.min(time), F.max(time), F.count(time)).first()
    if total <= n:
        return None
    wanted, there = n, total
    while True:
        width = -(-(high - low + 1) // BINS)
        bucket = F.floor((F.col(time) - low) / F.lit(width)) if width > 1 else F.col(time) - low
        counts = (times.filter(F.col(time).between(low, high)).groupBy(bucket.cast("bigint").alias("b"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("low"), F.max(time).alias("high"))
                  .collect())                                                        # BINS rows at most
        for r in sorted(counts, reverse=True):
            if r["n"] >= wanted:
                low, high, there = r["low"], r["high"], r["n"]
                break
            wanted -= r["n"]
        if low == high:
            return low, wanted, there


def newest(df: DataFrame, time: str, ties: list[Column | str], n: int) -> DataFrame:
    """The ``n`` rows of ``df`` with the greatest ``time`` (a bigint column), in
    no order; rows of equal time by ``ties``, first ones first.  The rows are
    computed once: the histograms, the cut and the result read them written."""
    df = written(df, "newest")
    cut = cut_of_newest(df.select(time), time, n)
    if cut is None:
        return df.filter(F.col(time).isNotNull())
    at, wanted, there = cut
    above = df.filter(F.col(time) > at)
    level = df.filter(F.col(time) == at)
    if wanted < there:
        level = numbered(level, ties, "_rank").filter(F.col("_rank") <= wanted).drop("_rank")
    return above.unionByName(level)


def running_sum(df: DataFrame, key: str, position: str, value: str, name: str,
                block: int = 100_000) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same
    ``key`` up to this ``position`` (a bigint, unique within the key).

    Sums run within blocks of positions and the blocks' sums are added, so a
    key of any length is no single group.
    """
    rows = df.withColumn("_block", F.floor(F.col(position) / block))
    blocks = rows.groupBy(key, "_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(key, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(key, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.withColumn(name, F.sum(value).over(inside)).join(offsets, [key, "_block"])
            .withColumn(name, F.col(name) + F.col("_before")).drop("_block", "_before"))
