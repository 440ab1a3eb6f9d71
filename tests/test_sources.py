"""Landed pages, page accounting and the catalog window."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from eventstar.session import scratch_path
from eventstar.sources.catalog import catalog_window, lookback_window
from eventstar.sources.pages import (
    explode_features,
    page_accounting,
    parse_pages,
    page_errors,
    read_page_files,
)
from tests.conftest import feature, features_df


def test_pages_from_files(spark):
    folder = scratch_path(spark, "pages")
    os.makedirs(folder)
    page = {"type": "FeatureCollection", "metadata": {"count": 2},
            "features": [feature(eid="a"), feature(eid="b")]}
    short = {"type": "FeatureCollection", "metadata": {"count": 5}, "features": [feature(eid="c")]}
    for name, body in [("p1.json", json.dumps(page, indent=2)), ("p2.json", json.dumps(short)),
                       ("p3.json", "<html>oops</html>"),
                       ("p4.json", json.dumps({"type": "FeatureCollection", "features": []}))]:
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(body)
    parsed = parse_pages(read_page_files(spark, folder))
    feats = explode_features(parsed)
    assert sorted(r.feature and json.loads(r.feature)["id"] for r in feats.collect()) == \
        ["a", "b", "c"]
    acc = {os.path.basename(r.page_id): r for r in page_accounting(parsed).collect()}
    assert acc["p1.json"].complete and not acc["p2.json"].complete
    assert not acc["p3.json"].readable and acc["p4.json"].feature_count == 0
    errs = page_errors(parsed, "b1").collect()
    assert sorted(e.error_message.split(":")[0] for e in errs) == [
        "Page declares 5 features, has 1", "Unreadable page"]
    assert all(e.error_type == "page_error" and "/p" in e.error_message for e in errs)


def test_catalog_window(spark):
    t = 1704067200000
    docs = [feature(eid=f"e{i}", time=t + i * 3600_000, mag=float(i)) for i in range(10)]
    df = features_df(spark, docs)
    start, end = dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 1, 8)
    ids = lambda d: [json.loads(r.feature)["id"] for r in d.collect()]
    assert sorted(ids(catalog_window(df, start, end))) == [f"e{i}" for i in range(2, 9)]
    assert sorted(ids(catalog_window(df, start, end, min_magnitude=0))) == \
        [f"e{i}" for i in range(2, 9)]
    assert sorted(ids(catalog_window(df, start, end, min_magnitude=5))) == ["e5", "e6", "e7", "e8"]
    assert ids(catalog_window(df, start, end, max_results=2)) == ["e8", "e7"]


def test_lookback_window():
    end = dt.datetime(2024, 1, 15)
    assert lookback_window(None, end, 7) == (dt.datetime(2024, 1, 8), end)
    s, e = lookback_window(None, None, 7)
    assert (e - s) == dt.timedelta(days=7)


def test_scratch_root_reads_session_setting(spark):
    from eventstar.session import scratch_path, scratch_root
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = scratch_root(spark)
    if configured:
        assert root == configured
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root)
