"""Validation rules (required fields, falsy values, arity, opt-in ranges)."""

import json

from eventstar.config import PipelineConfig
from eventstar.operators.validate import error_rows, split, threshold_exceeded, validate
from tests.conftest import feature, features_df


def messages(spark, docs, config=None):
    v = validate(features_df(spark, docs), config)
    return [r["error_message"] for r in v.select("error_message").collect()]


def test_valid_event(spark):
    assert messages(spark, [feature()]) == [None]


def test_id_only(spark):
    assert messages(spark, [{"id": "test"}]) == ["Missing required field: properties.time"]


def test_missing_or_empty_id(spark):
    docs = [feature(eid=None), feature(eid="")]
    assert messages(spark, docs) == ["Missing required field: id"] * 2


def test_epoch_zero_is_missing(spark):
    docs = [feature(time=0), feature(time=0.0)]
    assert messages(spark, docs) == ["Missing required field: properties.time"] * 2


def test_missing_coordinates(spark):
    docs = [feature(coords=[]), feature(coords=None),
            json.dumps({"id": "x", "properties": {"time": 5}, "geometry": {"coordinates": None}})]
    assert messages(spark, docs) == ["Missing required field: geometry.coordinates"] * 3


def test_coordinate_arity(spark):
    assert messages(spark, [feature(coords=[1]), feature(coords=[1, 2])]) == \
        ["Invalid coordinates format", None]


def test_rule_order_id_first(spark):
    assert messages(spark, [{"properties": {}}]) == ["Missing required field: id"]


def test_unparsable_and_non_array(spark):
    docs = ["not json", feature(coords=5)]
    assert messages(spark, docs) == ["Missing required field: id",
                                     "Validation error: coordinates is not an array"]


def test_null_magnitude_is_valid(spark):
    assert messages(spark, [feature(mag=None)]) == [None]


def test_split_and_error_rows(spark):
    v = validate(features_df(spark, [feature(), {"id": "test"}, feature(eid=None)]))
    valid, invalid = split(v)
    assert valid.count() == 1
    rows = error_rows(invalid, "b1").orderBy("event_id").collect()
    assert [(r.batch_id, r.event_id, r.error_type) for r in rows] == [
        ("b1", "test", "validation_error"), ("b1", "unknown", "validation_error")]
    assert json.loads(rows[0].raw_data) == {"id": "test"}


def test_range_rules_opt_in(spark):
    docs = [feature(mag=-1.0), feature(coords=[0, 95, 1]), feature(coords=[0, 0, 900]),
            feature(mag=None, coords=[0, 0])]
    assert messages(spark, docs) == [None] * 4
    cfg = PipelineConfig(check_ranges=True, magnitude_range=(0.0, 10.0))
    assert messages(spark, docs, cfg) == [
        "Validation error: magnitude out of range [0.0, 10.0]",
        "Validation error: latitude out of range [-90.0, 90.0]",
        "Validation error: depth out of range [-10.0, 800.0]",
        None]


def test_threshold():
    assert not threshold_exceeded(499, 500)
    assert threshold_exceeded(500, 500)
    assert not threshold_exceeded(10**6, None)


def test_falsy_and_long_ids_and_required_fields(spark):
    docs = [feature(eid=0), feature(eid=False), feature(eid="0"), feature(eid="x" * 51),
            feature(eid="x" * 50), feature(mag=None)]
    got = [r.error_message for r in validate(features_df(spark, docs)).collect()]
    assert got == ["Missing required field: id"] * 3 + ["Validation error: id longer than 50", None, None]
    cfg = PipelineConfig(required_fields=("id", "properties.mag"))
    got = [r.error_message for r in validate(features_df(spark, docs), cfg).collect()]
    assert got[-1] == "Missing required field: properties.mag"
    errors = error_rows(split(validate(features_df(spark, docs)))[1], "b").collect()
    assert max(len(r.event_id) for r in errors) == 50
