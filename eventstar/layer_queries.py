"""Registered queries of the storage and state features, with the statement of
each beside it: bucketed staging, stateful stream, dense keys, rules checked by
load, large capped windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar import oracle
from eventstar.config import PipelineConfig
from eventstar.functions.jsonpaths import parse_feature
from eventstar.operators.validate import error_rows, split, validate
from eventstar.operators.violations import violations
from eventstar.plans import analytics
from eventstar.plans.layers import Batch, build_layers
from eventstar.plans.pipeline import Pipeline, layer_counts_frame
from eventstar.session import scratch_path, written
from eventstar.sources.catalog import catalog_window
from eventstar.sources.fixture import (
    count_events,
    feature_json,
    fixture_features,
    fixture_pages,
    read_events,
    seismic_rows,
)
from eventstar.sources.pages import fetch_accounting, parse_pages
from eventstar.streaming.stateful import replay_with_state

STAGED = ["event_id", "magnitude", "magnitude_type", "place", "event_time", "latitude", "longitude",
          "depth", "tsunami", "significance"]
BUCKETS = 16


def _time(text: str):
    return F.lit(dt.datetime.fromisoformat(text)).cast("timestamp_ntz")


def _pipeline(spark: SparkSession, name: str, **options) -> Pipeline:
    config = PipelineConfig(max_errors=None, **options)
    return Pipeline(spark, f"{scratch_path(spark, name)}/layers", config)


def halves(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Two overlapping loads that cover all events: those before SPLIT_HIGH
    without one magnitude type and without some places; those from SPLIT_LOW,
    and all that the first leaves out."""
    feats = fixture_features(spark, sf_dir, extra=", ts AS source_ts, event_id AS seq")
    left_out = (F.col("seq") % 11 == 9) | (F.col("seq") % 701 % 5 == 3)
    early = (F.col("source_ts") < _time(oracle.SPLIT_HIGH)) & ~left_out
    late = (F.col("source_ts") >= _time(oracle.SPLIT_LOW)) | left_out
    return [("first", feats.filter(early).select("feature")), ("second", feats.filter(late).select("feature"))]


#: The staged rows of the two loads in DuckDB.
HALVES = f"""
WITH fx AS ({oracle.FIXTURE}),
{oracle.VALIDATED},
h AS (SELECT *, source_ts < TIMESTAMP '{oracle.SPLIT_HIGH}' AND seq % 11 <> 9 AND seq % 701 % 5 <> 3 AS early,
             source_ts >= TIMESTAMP '{oracle.SPLIT_LOW}' OR seq % 11 = 9 OR seq % 701 % 5 = 3 AS late,
             make_timestamp(time_ms * 1000) AS event_time
      FROM v WHERE error_message IS NULL AND magnitude IS NOT NULL),
staged AS (SELECT *, CASE WHEN early THEN 'first' ELSE 'second' END AS load FROM h WHERE early OR late)
"""
_STAGED_SQL = ("event_id, CAST(magnitude AS DOUBLE) AS magnitude, magnitude_type, place, event_time, "
               "CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
               "CAST(depth AS DOUBLE) AS depth, tsunami, significance")


def staging_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging stored in buckets by event id, after two overlapping loads and
    the second landed once more under another id."""
    pipe = _pipeline(spark, "bucketed", staging_buckets=BUCKETS)
    loads = halves(spark, sf_dir)
    for name, feats in [*loads, ("third", loads[1][1])]:
        pipe.ingest_batch(feats, name)
        pipe.run_transformations(name)
    return pipe.store.read("stg_events").select(*STAGED, F.col("load_id").alias("load"))


STAGING_BUCKETED = HALVES + f"SELECT {_STAGED_SQL}, load FROM staged"


def stream_dedup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging after a stream with repeated and late pages, settled in state."""
    return replay_with_state(spark, sf_dir).select(*STAGED)


STREAM_DEDUP_STATE = oracle.STAR + f"SELECT {_STAGED_SQL} FROM stg"


def dense_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of all rows of the star schema after two loads: locations, event
    types, and facts with the rows they refer to."""
    pipe = _pipeline(spark, "dense", surrogate_keys="dense")
    for name, feats in halves(spark, sf_dir):
        pipe.ingest_batch(feats, name)
        pipe.run_transformations(name)
    star = pipe.star()
    place = F.coalesce("place", F.lit(""))
    where = F.concat_ws("|", F.col("latitude").cast("string"), F.col("longitude").cast("string"), place)
    out = star["dim_location"].select(
        F.lit("dim_location").alias("table_name"), F.col("location_key").alias("key"), where.alias("natural_key"),
        F.lit(None).cast("bigint").alias("location_key"), F.lit(None).cast("bigint").alias("event_type_key"))
    types = star["dim_event_type"].select(
        F.lit("dim_event_type"), "event_type_key", "magnitude_type", F.lit(None), F.lit(None))
    facts = star["fact"].select(F.lit("fact_events"), "fact_key", "event_id", "location_key", "event_type_key")
    return out.union(types).union(facts)


DENSE_KEYS = HALVES + """,
places AS (SELECT latitude, longitude, coalesce(place, '') AS place_key, min(load) AS load
           FROM staged GROUP BY ALL),
loc AS (SELECT *, row_number() OVER (ORDER BY load, latitude, longitude, place_key) AS k FROM places),
typ AS (SELECT *, row_number() OVER (ORDER BY load, magnitude_type) AS k FROM (
          SELECT magnitude_type, min(load) AS load FROM staged WHERE magnitude_type IS NOT NULL GROUP BY ALL))
SELECT 'dim_location' AS table_name, k AS key, concat_ws('|', latitude, longitude, place_key) AS natural_key,
       CAST(NULL AS BIGINT) AS location_key, CAST(NULL AS BIGINT) AS event_type_key FROM loc
UNION ALL SELECT 'dim_event_type', k, magnitude_type, NULL, NULL FROM typ
UNION ALL SELECT 'fact_events', row_number() OVER (ORDER BY s.load, s.event_id), s.event_id, loc.k, typ.k
FROM staged s JOIN loc ON loc.latitude = s.latitude AND loc.longitude = s.longitude
                      AND loc.place_key = coalesce(s.place, '')
LEFT JOIN typ ON typ.magnitude_type = s.magnitude_type"""


def violations_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule, planted in a load that also repeats stored rows."""
    feats = fixture_features(spark, sf_dir, extra=", ts AS source_ts")

    def star(rows):
        return build_layers(spark, [Batch(feats.filter(rows).select("feature"), oracle.BATCH_1)], keep=written)

    old = star(F.col("source_ts") < _time(oracle.SPLIT_HIGH))
    late = star(F.col("source_ts") >= _time(oracle.SPLIT_LOW))
    every = star(F.lit(True))
    seq = F.substring("event_id", 3, 20).cast("bigint")
    stg = late.stg.withColumns({
        "event_time": F.when(seq % 89 != 0, F.col("event_time")),
        "magnitude_type": F.when(seq % 97 == 0, F.lit("x" * 11)).otherwise(F.col("magnitude_type")),
        "status": F.when(seq % 101 == 0, F.lit("s" * 21))})
    stg = stg.unionByName(stg.filter(seq % 83 == 0))
    fact = late.fact.withColumns({
        "fact_key": F.lit(None).cast("bigint"),
        "time_key": F.when(seq % 79 == 0, F.lit(19000101)).otherwise(F.col("time_key")),
        "location_key": F.when(seq % 73 == 0, F.lit(-1)).otherwise(F.col("location_key"))})
    types = late.dim_event_type.withColumn("event_type_key", F.lit(None).cast("bigint")).withColumn(
        "magnitude_category", F.lit("c" * 21))
    nameless = late.dim_event_type.limit(0).unionByName(spark.range(2).select(
        F.lit(None).cast("bigint").alias("event_type_key"), F.lit(None).cast("string").alias("magnitude_type"),
        F.lit("Other").alias("magnitude_category"), F.lit("Other").alias("description")))
    places = late.dim_location.withColumn("location_key", F.lit(None).cast("bigint"))
    history = {"stg_events": old.stg, "fact_events": old.fact, "dim_time": every.dim_time,
               "dim_location": every.dim_location, "dim_event_type": every.dim_event_type}
    new = {"stg_events": stg, "fact_events": fact, "dim_event_type": types.unionByName(nameless),
           "dim_location": places}
    return violations(new, history)


VIOLATIONS_DELTA = oracle.STAR + f""",
ids AS (SELECT event_id, seq, source_ts, time_ms FROM fx),
old AS (SELECT s.* FROM stg s JOIN ids USING (event_id) WHERE source_ts < TIMESTAMP '{oracle.SPLIT_HIGH}'),
late0 AS (SELECT s.*, seq FROM stg s JOIN ids USING (event_id) WHERE source_ts >= TIMESTAMP '{oracle.SPLIT_LOW}'),
late AS (SELECT * FROM late0 UNION ALL SELECT * FROM late0 WHERE seq % 83 = 0),
news AS (SELECT *, CASE WHEN seq % 89 <> 0 THEN event_time END AS et,
                CASE WHEN seq % 97 = 0 THEN repeat('x', 11) ELSE magnitude_type END AS mt,
                CASE WHEN seq % 101 = 0 THEN repeat('s', 21) END AS st FROM late),
counts AS (SELECT event_id, count(*) AS n FROM news GROUP BY event_id),
fcounts AS (SELECT event_id, count(*) AS n FROM late0 GROUP BY event_id),
olds AS (SELECT event_id, count(*) AS n FROM old GROUP BY event_id),
ltypes AS (SELECT DISTINCT magnitude_type FROM late0 WHERE magnitude_type IS NOT NULL),
lplaces AS (SELECT latitude, longitude, coalesce(place, '') AS place_key FROM late0 GROUP BY ALL)
SELECT 'stg_events' AS table_name, 'not_null(event_time)' AS rule, event_id AS key, count(*) AS n_rows
FROM news WHERE et IS NULL GROUP BY event_id
UNION ALL SELECT 'stg_events', 'length(magnitude_type)<=10', event_id, count(*)
FROM news WHERE length(mt) > 10 GROUP BY event_id
UNION ALL SELECT 'stg_events', 'length(status)<=20', event_id, count(*)
FROM news WHERE length(st) > 20 GROUP BY event_id
UNION ALL SELECT 'stg_events', 'unique(event_id)', c.event_id, c.n + coalesce(o.n, 0)
FROM counts c LEFT JOIN olds o ON o.event_id = c.event_id WHERE c.n + coalesce(o.n, 0) > 1
UNION ALL SELECT 'fact_events', 'unique(event_id)', c.event_id, c.n + coalesce(o.n, 0)
FROM fcounts c LEFT JOIN olds o ON o.event_id = c.event_id WHERE c.n + coalesce(o.n, 0) > 1
UNION ALL SELECT 'fact_events', 'foreign_key(time_key)', '19000101', count(*)
FROM late0 WHERE seq % 79 = 0 HAVING count(*) > 0
UNION ALL SELECT 'fact_events', 'foreign_key(location_key)', '-1', count(*)
FROM late0 WHERE seq % 73 = 0 HAVING count(*) > 0
UNION ALL SELECT 'dim_event_type', 'unique(magnitude_type)', magnitude_type, 2 FROM ltypes
UNION ALL SELECT 'dim_event_type', 'length(magnitude_category)<=20', magnitude_type, 1 FROM ltypes
UNION ALL SELECT 'dim_event_type', 'not_null(magnitude_type)', 'null', 2
UNION ALL SELECT 'dim_location', 'unique(latitude,longitude,place_key)',
                 concat_ws('|', latitude, longitude, place_key), 2 FROM lplaces"""


def catalog_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer half of all dated events: a cap far beyond a top-k, whose cut
    falls among events of one time (times are cut to the hour)."""
    hour = 3_600_000
    feats = fixture_features(spark, sf_dir)
    coarse = feats.select(F.regexp_replace(
        "feature", r'"time":(\d+)', F.concat(F.lit('"time":'), (F.floor(
            F.get_json_object("feature", "$.properties.time").cast("bigint") / hour) * hour).cast("string")))
        .alias("feature"))
    cap = count_events(spark, sf_dir) // 2
    # the cap is named large enough that the selection, not the top-k, runs
    window = catalog_window(coarse, dt.datetime(2000, 1, 1), dt.datetime(2100, 1, 1), max_results=cap,
                            top_k_rows=10)
    e = parse_feature(F.col("feature"))
    return window.select(e["id"].alias("event_id"), e["properties"]["time"].cast("bigint").alias("time_ms"))


CATALOG_TOP_N = f"""
WITH fx AS ({oracle.FIXTURE}),
t AS (SELECT event_id, time_ms // 3600000 * 3600000 AS time_ms, seq FROM fx),
r AS (SELECT *, row_number() OVER (ORDER BY time_ms DESC, event_id ASC NULLS FIRST) AS n
      FROM t WHERE time_ms >= epoch_us(TIMESTAMP '2000-01-01 00:00:00') // 1000)
SELECT event_id, time_ms FROM r WHERE n <= (SELECT count(*) // 2 FROM events)"""


DAYS = 10 * 86_400_000


def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's features with times over more than a year, and ``seq``."""
    rows = seismic_rows(read_events(spark, sf_dir), extra=", event_id AS seq")
    spread = F.when(F.col("time_ms") == 0, F.col("time_ms")).otherwise(
        F.col("time_ms") + F.col("seq") % 40 * DAYS)
    return feature_json(rows.withColumn("time_ms", spread))


SPREAD_FIXTURE = f"""SELECT * REPLACE (CASE WHEN time_ms = 0 THEN 0 ELSE time_ms + seq % 40 * {DAYS} END AS time_ms)
FROM ({oracle.FIXTURE})"""


def reports_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in the reports that have an order: report, rank,
    label."""
    feats = _spread(spark, sf_dir)
    lay = build_layers(spark, [Batch(feats.select("feature"), oracle.BATCH_1)], keep=written)
    fact = written(lay.fact, "spread-fact")
    place, day, kind = (written(t, "spread-dim") for t in (lay.dim_location, lay.dim_time, lay.dim_event_type))
    invalid = split(validate(feats))[1]
    at = F.timestamp_seconds(1_700_000_000 + F.col("seq"))
    errors = error_rows(invalid, oracle.BATCH_1, at)
    month = F.concat_ws("-", "year", "month")
    parts = [("q1", analytics.q1_region(fact, place, True), F.col("region")),
             ("q2", analytics.q2_weekday(fact, day, True), F.trim("day_name")),
             ("q3", analytics.q3_depth(fact, place, True), F.col("depth_category")),
             ("q4", analytics.q4_month(fact, day, True), month),
             ("q5", analytics.q5_magtype(fact, kind, True), F.col("magnitude_type")),
             ("q7", analytics.q7_recent_errors(errors, True), F.unix_seconds("occurred_at").cast("string"))]
    out = None
    for name, df, label in parts:
        rows = df.select(F.lit(name).alias("report"), F.col("rank").cast("bigint").alias("rank"),
                         label.alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _report(name: str) -> str:
    """A report's statement behind the common table expressions of the star."""
    return oracle.statements()[name][len(oracle.STAR):]


def reports_ranked_sql() -> str:
    star = oracle.STAR.replace(oracle.FIXTURE, SPREAD_FIXTURE)
    return star + f""",
r1 AS ({_report("q1_region")}), r2 AS ({_report("q2_weekday")}), r3 AS ({_report("q3_depth")}),
r4 AS ({_report("q4_month")}), r5 AS ({_report("q5_magtype")}),
wd AS (SELECT r2.*, w.n FROM r2 JOIN (SELECT unnest(['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday',
       'Friday', 'Saturday']) AS d, unnest(range(7)) AS n) w ON w.d = trim(r2.day_name)),
er AS (SELECT 1700000000 + seq AS sec FROM v WHERE error_message IS NOT NULL),
o AS (SELECT 'q1' AS report, row_number() OVER (ORDER BY event_count DESC, region) AS rank, region AS label FROM r1
UNION ALL SELECT 'q2', row_number() OVER (ORDER BY n), trim(day_name) FROM wd
UNION ALL SELECT 'q3', row_number() OVER (ORDER BY avg_significance DESC NULLS FIRST, depth_category),
                 depth_category FROM r3
UNION ALL SELECT 'q4', row_number() OVER (ORDER BY year, month), concat(year, '-', month) FROM r4
UNION ALL SELECT 'q5', row_number() OVER (ORDER BY event_count DESC, magnitude_type), magnitude_type FROM r5
UNION ALL SELECT 'q7', row_number() OVER (ORDER BY sec DESC), CAST(sec AS VARCHAR) FROM er)
SELECT * FROM o WHERE report <> 'q7' OR rank <= 10"""


def reports_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 from the stored states of three loads, no fact read: one row per
    report row, its values as text."""
    pipe = _pipeline(spark, "merged", report_states=True)
    feats = _spread(spark, sf_dir)
    for k in range(3):
        pipe.ingest_batch(feats.filter(F.col("seq") % 3 == k).select("feature"), f"b{k}")
        pipe.run_transformations(f"b{k}")
    out = None
    for name, df in pipe.merged_reports().items():
        rows = df.select(F.lit(name).alias("report"), F.concat_ws("|", *[
            F.coalesce(_plain(df, c), F.lit("null")) for c in sorted(df.columns)]).alias("cells"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _plain(df: DataFrame, name: str):
    """A cell as text that both engines write alike."""
    kind = dict(df.dtypes)[name]
    if kind == "double" or kind.startswith("decimal"):
        return F.round(F.col(name).cast("double") * 1000).cast("bigint").cast("string")
    return F.col(name).cast("string")


def reports_merged_sql() -> str:
    # a location has the depth category of the first event of the first load that has it
    star = oracle.STAR.replace(oracle.FIXTURE, SPREAD_FIXTURE).replace(
        "ORDER BY event_time, event_id) AS rn",
        "ORDER BY CAST(substr(event_id, 3) AS BIGINT) % 3, event_time, event_id) AS rn")
    thousand = lambda c: f"coalesce(CAST(CAST(round(CAST({c} AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR), 'null')"
    text = lambda c: f"coalesce(CAST({c} AS VARCHAR), 'null')"                                        # noqa: E731
    numbers = {"avg_magnitude", "max_magnitude", "min_magnitude", "avg_significance", "stddev_magnitude",
               "median_magnitude"}
    columns = {
        "q1_region": "avg_magnitude event_count max_magnitude min_magnitude region tsunami_events",
        "q2_weekday": "avg_magnitude day_name event_count is_weekend major_events",
        "q3_depth": "avg_magnitude avg_significance depth_category event_count strong_events",
        "q4_month": "avg_magnitude event_count max_magnitude month month_name total_significance year",
        "q5_magtype": "avg_magnitude event_count magnitude_category magnitude_type median_magnitude stddev_magnitude"}
    parts = []
    for name, cols in columns.items():
        cells = ", ".join(thousand(c) if c in numbers else text(c) for c in cols.split())
        parts.append(f"SELECT '{name}' AS report, concat_ws('|', {cells}) AS cells FROM ({_report(name)})")
    return star + "\nUNION ALL\n".join(parts)


def _fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's pages as five fetches: one that declares its total, one
    that declares more than there is, one with a failing page, one that
    declares half, one that declares nothing."""
    pages = fixture_pages(spark, sf_dir).withColumns({
        "fetch_id": F.col("page_id") % 5, "page_no": F.floor(F.col("page_id") / 5).cast("bigint")})
    pages = written(pages, "fetches")
    total = pages.groupBy("fetch_id").agg(
        F.sum(F.get_json_object("value", "$.metadata.count").cast("bigint")).alias("total"))
    kind, count = F.col("fetch_id"), '"count":[0-9]+'
    declared = F.when(kind == 1, F.col("total") + 1000).when(kind == 3, F.floor(F.col("total") / 2)) \
        .otherwise(F.col("total"))
    text = (F.when((kind == 2) & (F.col("page_no") == 1), F.lit("<html>"))
            .when(kind == 4, F.regexp_replace("value", count, ""))
            .otherwise(F.regexp_replace("value", F.lit(count), F.concat(F.lit('"count":'), declared.cast("string")))))
    parsed = pages.join(total, "fetch_id").select("page_id", text.alias("value"), "fetch_id", "page_no")
    return parse_pages(parsed, ("fetch_id", "page_no"))


def fetch_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting over whole fetches, without a cap and with one."""
    parsed = _fetches(spark, sf_dir)
    cols = ["fetch_id", "page_no", "feature_count", "declared_count", "fetched", "kept", "state"]
    return fetch_accounting(parsed).select(F.lit(0).alias("cap"), *cols).unionByName(
        fetch_accounting(parsed, 150).select(F.lit(150).alias("cap"), *cols))


FETCH_ACCOUNTS = f"""
WITH fx AS ({oracle.FIXTURE}),
p AS (SELECT seq // 100 % 5 AS fetch_id, seq // 100 // 5 AS page_no, count(*) AS n FROM fx GROUP BY ALL),
t AS (SELECT fetch_id, sum(n) AS total FROM p GROUP BY fetch_id),
d AS (SELECT p.fetch_id, page_no, fetch_id = 2 AND page_no = 1 AS bad,
             CASE WHEN fetch_id = 2 AND page_no = 1 THEN 0 ELSE n END AS n,
             CASE fetch_id WHEN 1 THEN total + 1000 WHEN 3 THEN total // 2 WHEN 4 THEN 0
                           ELSE CASE WHEN fetch_id = 2 AND page_no = 1 THEN 0 ELSE total END END AS declared
      FROM p JOIN t USING (fetch_id)),
r AS (SELECT cap, d.*, sum(n) OVER (PARTITION BY cap, fetch_id ORDER BY page_no) AS fetched
      FROM d, (SELECT unnest([0, 150]) AS cap)),
e AS (SELECT *, CASE WHEN bad THEN 'failed' WHEN n = 0 THEN 'empty' WHEN cap > 0 AND fetched >= cap THEN 'capped'
                     WHEN fetched >= declared THEN 'complete' END AS ending FROM r),
l AS (SELECT *, coalesce(page_no > min(page_no) FILTER (WHERE ending IS NOT NULL)
                         OVER (PARTITION BY cap, fetch_id), false) AS behind FROM e)
SELECT CAST(cap AS INTEGER) AS cap, fetch_id, page_no, n AS feature_count, CAST(declared AS BIGINT) AS declared_count,
       CAST(fetched AS BIGINT) AS fetched,
       CAST(CASE WHEN behind THEN 0 WHEN cap = 0 THEN n ELSE greatest(0, least(n, cap - (fetched - n))) END AS BIGINT)
         AS kept,
       CASE WHEN behind THEN 'surplus' ELSE coalesce(ending, 'read') END AS state
FROM l"""


def batch_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of a batch in which every seventh event comes three times, with
    other documents."""
    feats = fixture_features(spark, sf_dir, extra=", event_id AS seq")
    other = [feats.filter("seq % 7 = 0").withColumn("feature", F.regexp_replace(
        "feature", '"sig":[0-9]+', f'"sig":{s}')) for s in ("5000", "0")]
    pipe = _pipeline(spark, "first-wins")
    pipe.ingest_batch(feats.unionByName(other[0]).unionByName(other[1]).select("feature"), "b")
    raw = pipe.store.read("raw_events")
    return raw.select("event_id", F.get_json_object("raw_data", "$.properties.sig").cast("int").alias("significance"))


BATCH_FIRST_WINS = f"""
WITH fx AS ({oracle.FIXTURE}),
{oracle.VALIDATED}
SELECT event_id, CAST(CASE WHEN seq % 7 = 0 THEN 0 ELSE significance END AS INTEGER) AS significance
FROM v WHERE error_message IS NULL"""


class Stopped(RuntimeError):
    """A run that ends between two tables."""


def _stop_at(pipe: Pipeline, table: str, load_id: str) -> None:
    """One transformation run whose write of ``table`` fails."""
    write = pipe.store.write

    def failing(df: DataFrame, name: str, load: str) -> None:
        if name == table:
            raise Stopped(table)
        write(df, name, load)

    pipe.store.write = failing
    try:
        pipe.run_transformations(load_id)
    except Stopped:
        pass
    finally:
        del pipe.store.write


def publish_atomic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a load, after one that stopped between the
    dimensions and the fact, and after that was done again."""
    pipe = _pipeline(spark, "published", publish_atomically=True)
    root = pipe.store.root
    (one, first), (two, second) = halves(spark, sf_dir)
    out = None

    def look(stage: str) -> None:
        nonlocal out
        tables = Pipeline(spark, root, pipe.config).tables()          # a reader of its own
        rows = written(layer_counts_frame(tables), "counts").filter("layer <> 'raw_events'")
        rows = rows.select(F.lit(stage).alias("stage"), "layer", "row_count")
        out = rows if out is None else out.unionByName(rows)

    pipe.ingest_batch(first, one)
    pipe.run_transformations(one)
    look("first")
    pipe.ingest_batch(second, two)
    _stop_at(pipe, "fact_events", two)
    look("stopped")
    Pipeline(spark, root, pipe.config).run_transformations(two)       # another process takes over
    look("resumed")
    return out


PUBLISH_ATOMIC = HALVES + """,
seen AS (SELECT 'first' AS stage, * FROM staged WHERE early UNION ALL SELECT 'stopped', * FROM staged WHERE early
         UNION ALL SELECT 'resumed', * FROM staged)
SELECT stage, 'staging_events' AS layer, count(*) AS row_count FROM seen GROUP BY stage
UNION ALL SELECT stage, 'fact_events', count(*) FROM seen GROUP BY stage
UNION ALL SELECT stage, 'dim_time', count(DISTINCT CAST(event_time AS DATE)) FROM seen GROUP BY stage
UNION ALL SELECT stage, 'dim_location', count(DISTINCT (latitude, longitude, coalesce(place, ''))) FROM seen GROUP BY stage
UNION ALL SELECT stage, 'dim_event_type', count(DISTINCT magnitude_type) FROM seen GROUP BY stage"""


def compaction_keeps_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 over a fact in month folders: three loads, the first two compacted
    before the third came and all after it; the rows by what they were read
    from, with the number of load folders that readers see."""
    pipe = _pipeline(spark, "compacted", publish_atomically=True)
    feats = _spread(spark, sf_dir)
    out = None

    def look(stage: str) -> None:
        nonlocal out
        star = Pipeline(spark, pipe.store.root, pipe.config).star()
        top = analytics.q6_high_impact(star["fact"], star["dim_time"], star["dim_location"],
                                       star["dim_event_type"], as_of=dt.date(2024, 12, 1))
        loads = star["fact"].select("load_id").distinct().agg(F.count(F.lit(1)).alias("n_loads"))
        rows = written(top.select("event_id", "magnitude", "significance").join(loads), "top")
        rows = rows.select(F.lit(stage).alias("stage"), "*")
        out = rows if out is None else out.unionByName(rows)

    for k in range(3):
        pipe.ingest_batch(feats.filter(F.col("seq") % 3 == k).select("feature"), f"b{k}")
        pipe.run_transformations(f"b{k}")
        if k == 1:
            look("two loads")
            pipe.store.compact("fact_events")
            look("compacted")
    look("third load")
    pipe.store.compact("fact_events", 2)
    look("compacted again")
    return out


COMPACTION_KEEPS_ROWS = f"""
WITH fx AS ({SPREAD_FIXTURE}),
{oracle.VALIDATED},
f AS (SELECT * FROM v WHERE error_message IS NULL AND magnitude IS NOT NULL AND magnitude_type IS NOT NULL
      AND magnitude >= 5 AND make_timestamp(time_ms * 1000) >= TIMESTAMP '2024-11-01 00:00:00'),
s AS (SELECT 'two loads' AS stage, 2 AS n_loads, f.* FROM f WHERE seq % 3 < 2
      UNION ALL SELECT 'compacted', 1, f.* FROM f WHERE seq % 3 < 2
      UNION ALL SELECT 'third load', 2, f.* FROM f UNION ALL SELECT 'compacted again', 1, f.* FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY magnitude DESC, significance DESC, event_id) AS rank
      FROM s)
SELECT stage, event_id, CAST(magnitude AS DOUBLE) AS magnitude, significance, CAST(n_loads AS BIGINT) AS n_loads
FROM r WHERE rank <= 20"""


QUERIES = {
    "publish_atomic": publish_atomic,
    "compaction_keeps_rows": compaction_keeps_rows,
    "fetch_accounting": fetch_accounts,
    "batch_first_wins": batch_first_wins,
    "reports_ranked": reports_ranked,
    "reports_merged": reports_merged,
    "staging_bucketed": staging_bucketed,
    "stream_dedup_state": stream_dedup_state,
    "dense_keys": dense_keys,
    "violations_delta": violations_delta,
    "catalog_top_n": catalog_top_n,
}

def statements() -> dict[str, str]:
    return {
        "staging_bucketed": STAGING_BUCKETED,
        "stream_dedup_state": STREAM_DEDUP_STATE,
        "dense_keys": DENSE_KEYS,
        "violations_delta": VIOLATIONS_DELTA,
        "catalog_top_n": CATALOG_TOP_N,
        "reports_ranked": reports_ranked_sql(),
        "fetch_accounting": FETCH_ACCOUNTS,
        "publish_atomic": PUBLISH_ATOMIC,
        "compaction_keeps_rows": COMPACTION_KEEPS_ROWS,
        "batch_first_wins": BATCH_FIRST_WINS,
        "reports_merged": reports_merged_sql(),
    }
