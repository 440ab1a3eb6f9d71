import random

import pytest
from pyspark.sql import functions as F

from eventstar.operators.ranking import cut_of_newest, newest, numbered


def test_numbers_have_no_gaps_and_follow_the_order(spark):
    values = list(range(500))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, f"t{v % 7}") for v in values], "v int, t string").repartition(6)
    got = numbered(df, [F.desc("t"), "v"], "n", start=10).collect()
    want = sorted(((f"t{v % 7}", v) for v in values), key=lambda x: (-int(x[0][1:]), x[1]))
    assert [(r["t"], r["v"]) for r in sorted(got, key=lambda r: r["n"])] == want
    assert sorted(r["n"] for r in got) == list(range(11, 511))
    assert numbered(df.limit(0), ["v"]).count() == 0


@pytest.mark.parametrize("spread", [1, 50, 10**12])
def test_newest_is_the_sorted_prefix(spark, spread):
    rng = random.Random(spread)
    rows = [(rng.randrange(spread) - spread // 3, f"id{i:03d}") for i in range(300)] + [(None, "none")] * 4
    df = spark.createDataFrame(rows, "t bigint, id string").repartition(5)
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (-r[0], r[1]))
    for n in (1, 7, 150, 299, 300, 1000):
        got = newest(df, "t", ["id"], n).collect()
        assert sorted(map(tuple, got)) == sorted(order[:n])


def test_the_cut_falls_among_equal_times(spark):
    df = spark.createDataFrame([(i // 100,) for i in range(1000)], "t bigint")
    assert cut_of_newest(df, "t", 250) == (7, 50, 100)
    assert cut_of_newest(df, "t", 300) == (7, 100, 100)
    assert cut_of_newest(df, "t", 1000) is None


def test_no_task_holds_the_selection(spark):
    df = spark.range(1000).select(F.col("id").alias("t"), F.col("id").cast("string").alias("id"))
    plan = newest(df, "t", ["id"], 600)._jdf.queryExecution().toString()
    for single in ("TakeOrderedAndProject", "GlobalLimit", "SinglePartition"):
        assert single not in plan
