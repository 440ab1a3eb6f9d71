import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventstar.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Scratch data goes below the installation's spark.checkpoint.dir; only
    # where none is configured does eventstar.session.scratch_root make a
    # local folder (local master only).
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def feature(eid="test123", mag=5.2, time=1699999999000, coords=(-122.4, 37.8, 10.5),
            **props):
    """A feature dict; pass None to omit a key (``mag=None`` omits ``mag``)."""
    p = {"mag": mag, "magType": props.pop("magType", "mw"), "place": props.pop("place", "Test Location"),
         "time": time}
    p.update(props)
    doc = {"type": "Feature", "properties": {k: v for k, v in p.items() if v is not None},
           "geometry": {"type": "Point"}}
    if eid is not None:
        doc["id"] = eid
    if coords is not None:
        doc["geometry"]["coordinates"] = list(coords) if isinstance(coords, (list, tuple)) else coords
    return doc


def features_df(spark, docs):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in docs]
    return spark.createDataFrame(rows, "feature string")
