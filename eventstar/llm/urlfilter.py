"""URL rules by a sort-merge range join.

The canonical key of a host is its labels in reverse order, each closed by a
dot (``a.example.net`` is ``net.example.a.``).  A rule's host and all its
subdomains are then the keys that start with the rule's key: one interval of
the sort order, and intervals of different rules nest or are apart.  Hosts and
rule keys are range-partitioned together; a sorted sweep carries the stack of
the last rule key passed (that rule with all rules around it) to the hosts
behind it, where the rules whose interval has ended are popped.  A block's
sweep starts with the stack that the blocks before it end with.

Each distinct host is swept once, however many urls it has, and the stacks
that are not empty are joined back to the urls.

Defined results: null urls and urls without ``://`` have empty host and path;
``A-Z`` of hosts are lower-cased, nothing else; the longest fitting rule wins,
by host and path characters (ties: a longer host, then the smaller rule
string); without one the verdict is the default; repeated rows get one result
each; extra columns are not read; an empty table gives no rows, an empty rule
list the default for all.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventstar.llm.common import materialize, table

#: (verdict, host, path) of the registered query; fixed by its contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DEFAULT_VERDICT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end;
    path: from there up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.split(rest, "[/?#]", 2)[0], F.lit(""))
    path = F.split(F.substring(rest, F.length(host) + 1, F.length(rest)), "[?#]", 2)[0]
    return (F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
            F.coalesce(path, F.lit("")))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """verdict, host, path rows of a rule list."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per rule key: the rules of this key and of all keys around it,
    longest first."""
    lower = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    keyed = rules.select(host_key(lower).alias("key"), lower.alias("host"), "path", "verdict",
                         F.concat(lower, "path").alias("rule"))
    labels = F.split(F.col("key"), "\\.")
    around = keyed.select("key").distinct().select(
        F.col("key").alias("inner"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels) - 1),
                              lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."),
                                                 F.lit(".")))).alias("key"))
    entry = F.struct((-F.length("rule")).alias("rank"), (-F.length("host")).alias("narrow"),
                     "rule", "path", "verdict", "key")
    return (around.join(keyed, "key").groupBy(F.col("inner").alias("key"))
            .agg(F.sort_array(F.collect_set(entry)).alias("stack")))


def active_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """host, active: the rules (longest first) whose interval holds the host;
    hosts without any are left out."""
    stacks = rule_stacks(rules)
    events = (stacks.select("key", F.lit(0).alias("kind"), "stack", F.lit(None).cast("string").alias("host"))
              .unionByName(hosts.select(host_key(F.col("host")).alias("key"), F.lit(1).alias("kind"),
                                        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
                                        "host")))
    n = int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, so that both uses below see the same blocks
    swept = materialize(events.repartitionByRange(n, "key", "kind")
                        .withColumn("block", F.spark_partition_id()), "url-sweep")
    # one row per block at most
    ends = (swept.groupBy("block")
            .agg(F.max_by("stack", F.when(F.col("kind") == 0, F.col("key"))).alias("end")))
    starts = ends.select("block", F.last("end", ignorenulls=True).over(
        Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("start"))
    passed = F.last("stack", ignorenulls=True).over(
        Window.partitionBy("block").orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    stacked = (swept.withColumn("passed", passed).filter("kind = 1")
               .join(F.broadcast(starts), "block"))       # n rows
    return (stacked.select("host", F.filter(F.coalesce("passed", "start"),
                                            lambda r: F.startswith(F.col("key"), r["key"]))
                           .alias("active"))
            .filter(F.size("active") > 0))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    active = active_rules(urls.select("host").filter("host <> ''").distinct(), rules)
    fit = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.get(fit, F.lit(0))
    return (urls.join(active, "host", "left")
            .select("page_id", "host", "path", best["rule"].alias("rule"),
                    F.coalesce(best["verdict"], F.lit(default)).alias("verdict")))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


#: The same in DuckDB: all rules tried on each url.
OP3_SQL = """
WITH rules(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0
                              THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*'), '') AS raw_host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
urls AS (SELECT row_number() OVER () AS n, page_id, path,
                translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
         FROM parts),
fits AS (SELECT u.n, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
                max_by(r.verdict, length(r.host || r.path)) AS verdict
         FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host))
                                 AND starts_with(u.path, r.path) GROUP BY u.n)
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON u.n = f.n
"""
