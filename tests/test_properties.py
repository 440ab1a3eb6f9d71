"""Property tests: exact rounding against Python decimals, first-wins
against brute force (with one hot key holding a large share of rows)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventstar.functions.exact import rounded_mean, rounded_quotient
from eventstar.operators.firstwins import first_per_key

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**12)),
                min_size=1, max_size=20))
def test_rounded_quotient_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "s long, n long")
    got = [r[0] for r in df.select(rounded_quotient(F.col("s"), F.col("n"))).collect()]
    want = [int((Decimal(s) / Decimal(n)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
            for s, n in pairs]
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-200, 999), min_size=1, max_size=60))
def test_rounded_mean_of_hundredths(spark, ks):
    df = spark.createDataFrame([(k,) for k in ks], "k long")
    got = df.agg(rounded_mean(F.sum("k"), F.count("k"), 2)).first()[0]
    exact = (Decimal(sum(ks)) / Decimal(len(ks)) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == float(exact)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.text(max_size=3)),
                min_size=1, max_size=80),
       st.integers(0, 60))
def test_first_per_key_matches_brute_force(spark, rows, hot):
    rows = rows + [(0, 1, "hot")] * hot  # key 0 may hold most of the rows
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = {r.k: (r.o, r.v) for r in first_per_key(df, ["k"], ["o"], ["o", "v"]).collect()}
    want = {}
    for k, o, v in rows:
        if k not in want or (o, v) < want[k]:
            want[k] = (o, v)
    assert got == want
