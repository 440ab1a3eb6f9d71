"""Landed catalog pages (FeatureCollection documents) as a feature source.

Each landed file is one page; a page is bounded by the catalog's page limit,
so reading a file as one text value is safe.  Pages are exploded into one row
per feature text; the page's own ``metadata.count`` is kept for accounting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventstar.functions.jsonpaths import with_column_once
from eventstar.operators.ranking import running_sum
from eventstar.schemas import PAGE_SCHEMA


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: ``page_id`` (the file path) and ``value``."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("page_id"), "value"))


def parse_pages(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pages with ``metadata_count``, ``features`` (array of text), ``readable``
    (false when the page is not a FeatureCollection; an object without a
    ``features`` key is an empty one) and ``complete`` (it has as many
    features as it declares, if it declares a number).  Columns named in
    ``keep`` are carried along."""
    p = with_column_once(pages, "_p", F.from_json("value", PAGE_SCHEMA))
    features = F.col("_p.features")
    bare = (F.coalesce(F.startswith(F.get_json_object("value", "$"), F.lit("{")), F.lit(False))
            & F.get_json_object("value", "$.features").isNull())
    count = F.col("_p.metadata.count")
    return p.select(
        "page_id", "value",
        count.alias("metadata_count"),
        features.alias("features"),
        (features.isNotNull() | bare).alias("readable"),
        F.coalesce(count == F.coalesce(F.size(features), F.lit(0)), F.lit(True)).alias("complete"),
        *keep,
    )


def explode_features(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per feature text (column ``feature``) of the readable pages;
    an empty page contributes nothing."""
    return parsed.filter("readable").select(
        "page_id", F.explode("features").alias("feature"), *keep)


def page_accounting(parsed: DataFrame) -> DataFrame:
    """Per page: declared count, features present, and whether they agree."""
    n = F.coalesce(F.size("features"), F.lit(0))
    declared = F.coalesce(F.col("metadata_count"), F.lit(0))
    return parsed.select(
        "page_id",
        declared.alias("declared_count"),
        n.cast("bigint").alias("feature_count"),
        "readable",
        (declared == n).alias("complete"),
    )


def fetch_accounting(parsed: DataFrame, max_results: int | None = None) -> DataFrame:
    """Accounting over the pages of each fetch, in the order of ``page_no``.

    ``parsed`` are parsed pages with ``fetch_id`` and ``page_no`` (a bigint,
    unique within the fetch).  A fetch reads pages until the running total
    reaches the total that the page at hand declares (none declared counts as
    0, so one page is read) or ``max_results``; an empty page and a failing one
    end it, with what was read so far.

    Per page: fetch_id, page_no, page_id, feature_count, declared_count,
    fetched (the running total), kept (features of the page that belong to the
    fetch), state: ``read``, or what ends the fetch (``failed``, ``empty``,
    ``capped``, ``complete``), or ``surplus`` behind the end.
    """
    n = F.when(F.col("readable"), F.coalesce(F.size("features"), F.lit(0))).otherwise(0).cast("bigint")
    narrow = parsed.select("fetch_id", "page_no", "page_id", "readable", n.alias("feature_count"),
                           F.coalesce("metadata_count", F.lit(0)).alias("declared_count"))
    total = running_sum(narrow, "fetch_id", "page_no", "feature_count", "fetched")
    cap = F.lit(int(max_results)) if max_results else F.lit(None).cast("bigint")
    end = (F.when(~F.col("readable"), "failed").when(F.col("feature_count") == 0, "empty")
           .when(F.col("fetched") >= cap, "capped")
           .when(F.col("fetched") >= F.col("declared_count"), "complete"))
    judged = total.withColumn("end", end)
    ends = judged.filter("end IS NOT NULL").groupBy("fetch_id").agg(F.min("page_no").alias("last"))
    behind = F.coalesce(F.col("page_no") > F.col("last"), F.lit(False))
    spare = F.greatest(F.lit(0), F.least("feature_count", cap - (F.col("fetched") - F.col("feature_count"))))
    return judged.join(ends, "fetch_id", "left").select(
        "fetch_id", "page_no", "page_id", "feature_count", "declared_count", "fetched",
        F.when(behind, 0).when(cap.isNull(), F.col("feature_count")).otherwise(spare).cast("bigint").alias("kept"),
        F.when(behind, "surplus").otherwise(F.coalesce("end", F.lit("read"))).alias("state"))


def fetched_features(parsed: DataFrame, max_results: int | None = None) -> DataFrame:
    """One row per feature text (``feature``) that the fetches read; the pages
    themselves are joined on their narrow accounts."""
    kept = fetch_accounting(parsed, max_results).filter("kept > 0").select("fetch_id", "page_no", "kept")
    return parsed.join(kept, ["fetch_id", "page_no"]).select(
        "page_id", F.explode(F.slice("features", F.lit(1), F.col("kept").cast("int"))).alias("feature"))


def page_errors(parsed: DataFrame, batch_id: str) -> DataFrame:
    """Pages that are not FeatureCollections, and pages with another number of
    features than they declare, as error-table rows."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("unknown"))
    unreadable = ~F.col("readable")
    short = F.concat(F.lit("Page declares "), F.col("metadata_count").cast("string"),
                     F.lit(" features, has "),
                     F.coalesce(F.size("features"), F.lit(0)).cast("string"), F.lit(": "), page)
    return parsed.filter(unreadable | ~F.col("complete")).select(
        F.lit(batch_id).alias("batch_id"),
        F.lit("unknown").alias("event_id"),
        F.lit("page_error").alias("error_type"),
        F.when(unreadable, F.concat(F.lit("Unreadable page: "), page)).otherwise(short)
        .alias("error_message"),
        F.col("value").alias("raw_data"),
        F.current_timestamp().alias("occurred_at"),
    )
