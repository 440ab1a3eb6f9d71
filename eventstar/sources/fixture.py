"""Seismic feature documents derived from the driver's ``events`` table.

The test tables hold no seismic columns, so each ``events`` row is turned into
one GeoJSON feature with a fixed, documented rule (FIXTURES.md §3).  Every row
of ``events`` becomes a feature; some are deliberately broken (no id, epoch
zero time, a single coordinate, no magnitude) to exercise validation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed derivation rule; the oracle SQL in ``__spark_entry__`` uses the same
# text with DuckDB's spelling of the string type and of epoch milliseconds.
FIXTURE_SQL = """
SELECT
  CASE WHEN event_id % 101 = 1 THEN NULL ELSE concat('ev', CAST(event_id AS {STR})) END AS event_id,
  CASE WHEN event_id % 50 = 7 THEN NULL
       ELSE CAST(CAST((event_id*37) % 1200 - 200 AS double)/100 AS decimal(3,2)) END AS magnitude,
  CASE event_id % 11 WHEN 0 THEN 'mb' WHEN 1 THEN 'ms_20' WHEN 2 THEN 'mww' WHEN 3 THEN 'ml'
       WHEN 4 THEN 'md' WHEN 5 THEN 'mb_lg' WHEN 6 THEN 'mwr' WHEN 7 THEN 'Mw' WHEN 8 THEN 'mlg'
       WHEN 9 THEN 'mw' ELSE NULL END AS magnitude_type,
  CASE WHEN event_id % 701 % 13 = 5 THEN NULL
       ELSE concat(CAST(event_id % 701 % 97 AS {STR}), ' km W of Town') END AS place,
  CASE WHEN event_id % 103 = 2 THEN 0 ELSE {MS} END AS time_ms,
  CAST(CAST(((event_id % 701)*7919) % 180001 AS double)/1000 - 90 AS decimal(9,6)) AS latitude,
  CAST(CAST(((event_id % 701)*104729) % 360001 AS double)/1000 - 180 AS decimal(9,6)) AS longitude,
  CASE WHEN event_id % 29 = 3 THEN NULL
       ELSE CAST(CAST((event_id*31) % 81001 AS double)/100 - 10 AS decimal(8,3)) END AS depth,
  event_id % 107 = 3 AS short_coords,
  event_id % 17 = 0 AS tsunami,
  CAST((event_id*53) % 1000 AS int) AS significance{EXTRA}
FROM {SRC}
"""

# Epoch milliseconds of the NTZ ``ts`` column, truncated, zone-independent.
SPARK_MS = "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def count_events(spark: SparkSession, sf_dir: str) -> int:
    return spark.read.parquet(f"{sf_dir}/events.parquet").count()


# Rows of ``events`` that one task turns into documents.
ROWS_PER_TASK = 50_000


def read_events(spark: SparkSession, sf_dir: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The ``events`` table, dealt out to as many tasks as its rows call for.

    Its rows are narrow, so a file of a few row groups holds millions of them
    and would be read, turned into documents and parsed by one or two tasks.
    Rows are dealt by all that the rule reads, so repeated or null ids spread.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tasks = -(-count_events(spark, sf_dir) // rows_per_task)              # counted in the file footers
    return events.repartition(tasks, "event_id", "ts") if tasks > 1 else events


FIXTURE_COLUMNS = ("event_id", "magnitude", "magnitude_type", "place", "time_ms", "latitude",
                   "longitude", "depth", "short_coords", "tsunami", "significance")


def seismic_rows(events: DataFrame, extra: str = "") -> DataFrame:
    """Typed seismic columns for each ``events`` row (the fixture rule).

    ``extra`` is a SQL select-list tail (starting with a comma) of further
    columns computed from ``events`` and carried along.
    """
    view = f"fixture_src_{abs(events.semanticHash())}"
    events.createOrReplaceTempView(view)
    sql = FIXTURE_SQL.format(STR="string", MS=SPARK_MS, SRC=view, EXTRA=extra)
    return events.sparkSession.sql(sql)


def feature_json(rows: DataFrame) -> DataFrame:
    """Serialise typed rows to GeoJSON feature text (column ``feature``).

    NULL fields are omitted by ``to_json``, which yields the missing-id and
    missing-magnitude cases; a short row carries a single coordinate.  Columns
    other than the fixture's own are carried along.
    """
    wide = "decimal(11,6)"
    coords = F.when(F.col("short_coords"), F.array(F.col("longitude").cast(wide))) \
        .otherwise(F.array(F.col("longitude").cast(wide), F.col("latitude").cast(wide),
                           F.col("depth").cast(wide)))
    doc = F.struct(
        F.lit("Feature").alias("type"),
        F.col("event_id").alias("id"),
        F.struct(
            F.col("magnitude").alias("mag"),
            F.col("magnitude_type").alias("magType"),
            F.col("place").alias("place"),
            F.col("time_ms").alias("time"),
            F.col("tsunami").cast("int").alias("tsunami"),
            F.col("significance").alias("sig"),
        ).alias("properties"),
        F.struct(F.lit("Point").alias("type"), coords.alias("coordinates")).alias("geometry"),
    )
    extra = [c for c in rows.columns if c not in FIXTURE_COLUMNS]
    return rows.select(F.to_json(doc).alias("feature"), *extra)


def fixture_features(spark: SparkSession, sf_dir: str, extra: str = "") -> DataFrame:
    """One ``feature`` text column per ``events`` row."""
    return feature_json(seismic_rows(read_events(spark, sf_dir), extra=extra))


def fixture_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Catalog pages built from the fixture: ``page_id`` and the page text.

    Page ``p`` holds the features of events ``p*page_size ..
    (p+1)*page_size - 1``, so a page never holds more than ``page_size``
    features and the per-page ``collect_list`` is bounded.  The envelope is
    the catalog's FeatureCollection with ``metadata.count`` = features on the
    page.
    """
    feats = fixture_features(
        spark, sf_dir,
        extra=f", CAST(event_id DIV {int(page_size)} AS bigint) AS page_id, event_id AS seq")
    pages = feats.groupBy("page_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", "feature"))).alias("items"))
    texts = F.transform("items", lambda x: x["feature"])
    return pages.select(
        "page_id",
        F.concat(F.lit('{"type":"FeatureCollection","metadata":{"count":'),
                 F.size("items").cast("string"),
                 F.lit('},"features":['), F.array_join(texts, ","), F.lit("]}")).alias("value"))
