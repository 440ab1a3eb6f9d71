"""Spark-native event warehouse.

Lands GeoJSON feature documents, validates them, keeps them append-only in a
raw layer, extracts a deduplicated staging layer, grows a star schema and
answers analytical questions about it.  Everything is expressed with built-in
DataFrame operators so Catalyst and AQE plan the distributed work.
"""

from eventstar.config import PipelineConfig
from eventstar.plans.pipeline import Pipeline
from eventstar.session import build_session, scratch_root

__all__ = ["Pipeline", "PipelineConfig", "build_session", "scratch_root"]
