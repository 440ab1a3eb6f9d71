"""Keyed first-wins deduplication without a window.

``min(struct(order..., payload...))`` per key is an ordinary aggregate: each
map task reduces its rows to one per key before the shuffle (partial
aggregation), so a key holding a third of all rows costs one row per map task
on the wire instead of a third of the data in one window task.  The struct's
field order is the tie-break order, so the winner is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys met twice whose broadcast is hinted.
BROADCAST_KEYS = 500_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str],
                  payload: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` tuple.

    ``payload`` are the columns kept from the winning row (default: all
    non-key columns).  Ties on ``order`` are broken by the payload values.
    """
    payload = payload if payload is not None else [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ordered = [c.alias(f"_o{i}") for i, c in enumerate(order_cols)]
    # A payload column that is also an order column travels once, as the
    # order field (the raw document is both: carrying it twice would double
    # the shuffle).
    in_order = {o: f"_o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    rest = [c for c in payload if c not in in_order]
    best = F.min(F.struct(*ordered, *[F.col(c) for c in rest])).alias("_w")
    return (df.groupBy(*keys).agg(best)
            .select(*keys, *[F.col(f"_w.{in_order.get(c, c)}").alias(c) for c in payload]))


def first_per_key_sparse(df: DataFrame, keys: list[str], order: list[Column | str],
                         payload: list[str]) -> DataFrame:
    """:func:`first_per_key` where few keys occur twice.

    Only the keys are counted; rows of keys met once, nearly all, are neither
    aggregated nor shuffled with what they carry.  The keys met twice are
    broadcast up to a counted number and shuffled beyond it.  ``df`` is read
    twice, so it should be persisted or cheap; null keys are keys.
    """
    named = {k: f"_k{i}" for i, k in enumerate(keys)}
    twice = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
             .select(*[F.col(k).alias(a) for k, a in named.items()])).persist()
    n = twice.count()
    if not n:
        twice.unpersist()
        return df.select(*keys, *payload)
    side = F.broadcast(twice) if n <= BROADCAST_KEYS else twice
    same = F.lit(True)
    for k, a in named.items():
        same &= df[k].eqNullSafe(side[a])
    again = first_per_key(df.join(side, same, "left_semi"), keys, order, payload)
    return df.join(side, same, "left_anti").select(*keys, *payload).unionByName(again)
