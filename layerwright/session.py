"""Session settings and the shared work folder."""

from __future__ import annotations

import itertools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # lets AQE split a skewed join even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the JVM compiles large methods late, badly or (from 8000 bytes on) never, so a step over many columns stays
    # interpreted: beyond this size or number of columns the operators run one by one, in small methods
    "spark.sql.codegen.hugeMethodLimit": "4000",
    "spark.sql.codegen.maxFields": "30",
    # a query that people or models propose must not reach files by their path
    "spark.sql.runSQLOnFiles": "false",
}
_FOLDERS: dict[str, str] = {}
_COUNTER = itertools.count()


def build(master: str | None = None, app: str = "layerwright", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on. The cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings to a session somebody else built."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """Shared folder for tables that cut lineage: `spark.checkpoint.dir` of the session.

    Only a local master without the setting gets a folder of its own; on a cluster a machine-local
    folder would not survive the loss of an executor, so the setting is required there.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="layerwright-")
            spark.sparkContext.setCheckpointDir(root)
        _FOLDERS[app] = f"{root.rstrip('/')}/layerwright-{app}-{uuid.uuid4().hex[:8]}"
    return _FOLDERS[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path under the work folder; never reused."""
    return os.path.join(work_folder(spark), f"{name}-{next(_COUNTER)}")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when a table arrives in fewer pieces than there are cores (small files). A large
    table has more pieces than that and is left as it is: no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the work folder and read it back: cuts lineage in a way that survives the loss
    of executors, and later steps prune its columns."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
