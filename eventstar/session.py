"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "eventstar", extra: dict | None = None) -> SparkSession:
    """A session with the settings every plan here assumes.

    Session zone UTC (timestamps without zone are wall-clock UTC), AQE on so
    joins and partition counts adapt at runtime, skew-join splitting on, UI off.
    Constraint propagation is off: the wide CASE projections of the document
    extraction make it superlinear at plan time while the filters it infers
    add nothing to these plans.  On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (about 128-256 MB per shuffle partition).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.constraintPropagation.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session without that
    setting gets a fresh folder of its own (tests); a cluster session must name
    a shared folder, never a machine-local one.
    """
    sc = spark.sparkContext
    conf = sc.getConf()
    root = conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    key = sc.applicationId
    if key not in _LOCAL_ROOTS:
        if not conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="eventstar-")
        sc.setCheckpointDir(os.path.join(_LOCAL_ROOTS[key], "rdd"))
    return _LOCAL_ROOTS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the scratch root."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the scratch root and read back: computed once, with
    no lineage to redo when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
