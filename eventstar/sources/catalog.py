"""The catalog window over landed features.

The reference pulls a time window from a web catalog page by page.  Here the
features are already landed; the window is a filter on the parsed time (both
bounds inclusive), an optional minimum magnitude, and an optional cap on the
newest ``max_results`` events.  Without a cap no ordering is needed at all;
with a small one the plan is a top-k (``TakeOrderedAndProject``), and with a
large one a distributed selection (``eventstar.operators.ranking``), so no task
merges the capped rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventstar.functions.jsonpaths import parse_feature, with_column_once
from eventstar.operators.ranking import newest

# Rows up to which a cap is a top-k, whose candidates meet in one task.
TOP_K_ROWS = 10_000


def lookback_window(start: dt.datetime | None, end: dt.datetime | None,
                    lookback_days: int) -> tuple[dt.datetime, dt.datetime]:
    """end defaults to now (UTC); start defaults to end - lookback_days."""
    end = end or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    start = start or end - dt.timedelta(days=lookback_days)
    return start, end


def _epoch_ms(t: dt.datetime) -> int:
    if t.tzinfo is not None:
        t = t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (t - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)


def catalog_window(features: DataFrame, start: dt.datetime, end: dt.datetime,
                   min_magnitude: float | None = None, max_results: int | None = None,
                   text_col: str = "feature", keep_undated: bool = False,
                   top_k_rows: int = TOP_K_ROWS) -> DataFrame:
    """Features whose ``properties.time`` lies in [start, end].

    ``min_magnitude`` and ``max_results`` apply only when truthy (0 means no
    filter / no cap).  With a cap the newest events win (ties by id); one of
    more than ``top_k_rows`` is selected without a task that holds all of it.
    ``keep_undated`` also keeps features whose time is missing, zero or not a
    whole number, beside the window and the cap: validation decides on them.
    """
    p = with_column_once(features, "_p", parse_feature(F.col(text_col)))
    t = F.col("_p.properties.time").try_cast("bigint")
    undated = (t.isNull() | (t == 0)) if keep_undated else F.lit(False)
    inside = t.between(_epoch_ms(start), _epoch_ms(end))
    if min_magnitude:
        inside &= F.col("_p.properties.mag").try_cast("double") >= float(min_magnitude)
    if max_results and keep_undated:
        top = catalog_window(features, start, end, min_magnitude, max_results, text_col,
                             top_k_rows=top_k_rows)
        return top.unionByName(p.filter(undated).drop("_p"))
    out = p.filter(inside | undated)
    if max_results and max_results <= top_k_rows:
        out = out.orderBy(t.desc(), F.col("_p.id")).limit(int(max_results))
    elif max_results:
        timed = out.withColumns({"_t": t, "_id": F.col("_p.id")}).drop("_p")
        return newest(timed, "_t", ["_id", text_col], int(max_results)).drop("_t", "_id")
    return out.drop("_p")
