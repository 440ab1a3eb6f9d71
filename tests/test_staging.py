"""Raw → staging extraction, first-wins and quarantine rules."""

import datetime as dt
from decimal import Decimal

import pytest

from eventstar.plans.layers import Batch, build_layers
from tests.conftest import feature, features_df


def stage_rows(spark, docs, **kw):
    lay = build_layers(spark, [Batch(features_df(spark, docs), "b1", dt.datetime(2024, 1, 2))], **kw)
    return lay, {r.event_id: r for r in lay.stg.collect()}


def test_typed_extraction(spark):
    lay, rows = stage_rows(spark, [feature(tsunami=1, sig=42, status="reviewed",
                                           updated=1700000000123)])
    r = rows["test123"]
    assert r.magnitude == Decimal("5.20")
    assert r.latitude == Decimal("37.800000") and r.longitude == Decimal("-122.400000")
    assert r.depth == Decimal("10.500")
    assert r.event_time == dt.datetime(2023, 11, 14, 22, 13, 19)
    assert r.updated_time == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert r.tsunami is True and r.significance == 42 and r.status == "reviewed"
    assert r.source_batch_id == "b1"


def test_two_coordinates_depth_null_and_deep(spark):
    lay, rows = stage_rows(spark, [feature(coords=[1, 2])])
    assert rows["test123"].depth is None
    assert [r.depth_category for r in lay.dim_location.collect()] == ["Deep"]


def test_null_and_empty_magnitude(spark):
    lay, rows = stage_rows(spark, [feature(eid="a", mag=None), feature(eid="b", mag="")])
    assert "a" not in rows and lay.raw.count() == 2
    assert rows["b"].magnitude is None


def test_rounding_half_up(spark):
    _, rows = stage_rows(spark, [feature(mag=5.255)])
    assert rows["test123"].magnitude == Decimal("5.26")


def test_tsunami_values(spark):
    docs = [feature(eid="n"), feature(eid="z", tsunami=0), feature(eid="o", tsunami=1),
            feature(eid="t", tsunami=2)]
    _, rows = stage_rows(spark, docs)
    assert [rows[k].tsunami for k in "nzot"] == [False, False, True, True]


def test_overflow_quarantined(spark):
    lay, rows = stage_rows(spark, [feature(eid="big", mag=10.0), feature(eid="ok")])
    assert set(rows) == {"ok"}
    rej = lay.rejected.collect()
    assert [(r.event_id, r.reject_reason) for r in rej] == [
        ("big", "magnitude value does not fit its column")]


def test_fractional_integer_and_long_type_quarantined(spark):
    lay, rows = stage_rows(spark, [feature(eid="f", sig=12.5), feature(eid="l", magType="x" * 11)])
    assert rows == {}
    assert sorted(r.reject_reason for r in lay.rejected.collect()) == [
        "magnitude_type longer than 10", "significance value does not fit its column"]


def test_first_ingested_wins(spark):
    early = Batch(features_df(spark, [feature(mag=1.0)]), "b-early", dt.datetime(2024, 1, 1))
    late = Batch(features_df(spark, [feature(mag=2.0)]), "b-late", dt.datetime(2024, 1, 5))
    lay = build_layers(spark, [late, early])
    rows = lay.stg.collect()
    assert len(rows) == 1 and rows[0].source_batch_id == "b-early"
    assert rows[0].magnitude == Decimal("1.00")


def test_duplicate_in_batch_deduped(spark):
    lay, rows = stage_rows(spark, [feature(), feature()])
    assert lay.raw.count() == 1 and len(rows) == 1


def test_already_staged_not_restaged(spark):
    first = build_layers(spark, [Batch(features_df(spark, [feature(mag=1.0)]), "b1")])
    again = build_layers(spark, [Batch(features_df(spark, [feature(mag=3.0)]), "b2")],
                         staged=first.stg)
    rows = again.stg.collect()
    assert len(rows) == 1 and rows[0].magnitude == Decimal("1.00")


@pytest.mark.parametrize("depth,cat", [(69.999, "Shallow"), (70, "Intermediate"),
                                       (299.999, "Intermediate"), (300, "Deep")])
def test_depth_edges(spark, depth, cat):
    lay, _ = stage_rows(spark, [feature(coords=[0, 0, depth])])
    assert [r.depth_category for r in lay.dim_location.collect()] == [cat]
