"""Constraint rules checked for a new load, as rows.

The rules of a table (NOT NULL, bounded strings, uniqueness, foreign keys) are
exploded in one pass over its new rows.  NOT NULL and bounds are decided there;
keys are counted, and only the keys of the new load are looked up in the
history: it is reduced to them by a semi-join on key hashes, which are
broadcast up to a counted size.  Every violation comes back with the rule and
the key, so it can be mended.

Defined results: keys with a null column are equal to nothing and refer to
nothing, as in a database; ``n_rows`` counts the new rows that break the rule,
for uniqueness all rows of the key, stored ones included; an empty load breaks
no rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventstar.operators.checks import FOREIGN, NOT_NULL, UNIQUE
from eventstar.operators.joins import BROADCAST_KEY_LIMIT
from eventstar.schemas import STRING_BOUNDS

COLUMNS = ["table_name", "rule", "key", "n_rows"]
#: Columns that name a row in a report.
ROW_KEYS = {
    "raw_events": ["event_id", "batch_id"],
    "stg_events": ["event_id"],
    "dim_time": ["time_key"],
    "dim_location": ["latitude", "longitude", "place_key"],
    "dim_event_type": ["magnitude_type"],
    "fact_events": ["event_id"],
    "ingestion_audit": ["batch_id"],
    "ingestion_errors": ["batch_id", "event_id"],
}


def _with_place_key(table: str, rows: DataFrame) -> DataFrame:
    if table != "dim_location":
        return rows
    return rows.withColumn("place_key", F.coalesce("place", F.lit("")))


def _text(cols: list[str]) -> Column:
    """The key as text, null if one of its columns is."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols]) if len(cols) > 1 else \
        F.col(cols[0]).cast("string")


def _key(cols: list[str]) -> Column:
    there = F.lit(True)
    for c in cols:
        there &= F.col(c).isNotNull()
    return F.when(there, _text(cols))


def _named(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])


def unique_rules(table: str) -> list[tuple[str, list[str]]]:
    return [(f"unique({','.join(keys)})", keys) for t, keys in UNIQUE if t == table]


def foreign_rules(table: str) -> list[tuple[str, str, str]]:
    return [(f"foreign_key({key})", key, dim) for key, dim in FOREIGN] if table == "fact_events" else []


def findings(table: str, new: DataFrame) -> DataFrame:
    """kind, rule, key of the new rows of a table, from one pass: broken row
    rules (kind ``row``) and the keys to count (``unique``) or to look up
    (``foreign``)."""
    rows = _with_place_key(table, new)
    name = _named([c for c in ROW_KEYS[table] if c in rows.columns])

    def found(kind: str, rule: str, when: Column, key: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), key.alias("key")))

    parts = [found("row", f"not_null({c})", F.col(c).isNull(), name) for c in NOT_NULL.get(table, [])]
    parts += [found("row", f"length({c})<={n}", F.length(c) > n, name)
              for c, n in STRING_BOUNDS.get(table, {}).items()]
    parts += [found("unique", rule, _key(keys).isNotNull(), _key(keys)) for rule, keys in unique_rules(table)]
    parts += [found("foreign", rule, F.col(key).isNotNull(), F.col(key).cast("string"))
              for rule, key, _ in foreign_rules(table)]
    return (rows.select(F.explode(F.array_compact(F.array(*parts))).alias("f")).select("f.*")
            .groupBy("kind", "rule", "key").agg(F.count(F.lit(1)).alias("n_rows")))


def _hit(history: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """rule, key of the history that are wanted; its columns are not shuffled
    while the wanted key hashes are few enough to broadcast."""
    hashes = wanted.select(F.xxhash64("rule", "key").alias("_hash"))
    side = F.broadcast(hashes) if n_wanted <= BROADCAST_KEY_LIMIT else hashes
    return (history.withColumn("_hash", F.xxhash64("rule", "key")).join(side, "_hash", "left_semi")
            .drop("_hash"))


def _keys_of(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    parts = [F.struct(F.lit(rule).alias("rule"), key.alias("key")) for rule, key in rules]
    return rows.select(F.explode(F.array(*parts)).alias("f")).select("f.*").filter("key IS NOT NULL")


def load_violations(table: str, new: DataFrame, history: DataFrame,
                    dimensions: dict[str, DataFrame] | None = None) -> DataFrame:
    """table_name, rule, key, n_rows of what the rows ``new`` of ``table``
    break, beside the rows stored before (``history``); ``dimensions`` hold all
    dimension rows, those of this load included."""
    found = findings(table, new).persist()
    n_keys = found.filter("kind <> 'row'").count()
    parts = [found.filter("kind = 'row'").select("rule", "key", "n_rows")]
    if unique_rules(table):
        keys = found.filter("kind = 'unique'").drop("kind")
        stored = _keys_of(_with_place_key(table, history),
                          [(rule, _key(cols)) for rule, cols in unique_rules(table)])
        old = _hit(stored, keys, n_keys).groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n_old"))
        both = keys.join(old, ["rule", "key"], "left").withColumn(
            "n_rows", F.col("n_rows") + F.coalesce("n_old", F.lit(0)))
        parts.append(both.filter("n_rows > 1").select("rule", "key", "n_rows"))
    for rule, key, dim in foreign_rules(table):
        keys = found.filter((F.col("kind") == "foreign") & (F.col("rule") == rule)).drop("kind")
        there = _hit(_keys_of(dimensions[dim], [(rule, F.col(key).cast("string"))]), keys, n_keys)
        parts.append(keys.join(there, ["rule", "key"], "left_anti").select("rule", "key", "n_rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.lit(table).alias("table_name"), "rule", "key", "n_rows")


def violations(new: dict[str, DataFrame], history: dict[str, DataFrame]) -> DataFrame:
    """The violations of all tables of a load (see :func:`load_violations`).
    Foreign keys are looked up in the dimensions of the load and of before."""
    dims = {}
    for _, dim in FOREIGN:
        sides = [t[dim] for t in (history, new) if dim in t]
        if sides:
            dims[dim] = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    out = None
    for table, rows in new.items():
        part = load_violations(table, rows, history[table] if table in history else rows.limit(0), dims)
        out = part if out is None else out.unionByName(part)
    return out
