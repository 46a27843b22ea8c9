"""Atomic publication: a set of tables is written to a run folder, then one pointer moves."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from layerwright.operators import metrics


def _context(spark: SparkSession, path: str):
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.java.net.URI(path) if "://" in path else jvm.java.net.URI("file:///"), conf)


def publish(tables: dict[str, DataFrame], root: str, run_id: str) -> dict[str, int]:
    """Write all tables to a folder that nobody has read yet, then move root/CURRENT there in one rename.

    Readers see the old set until the rename; a failure before it leaves them untouched. A repeat of a published run
    gets a folder of its own, so nobody who still reads the first one is disturbed. Returns the rows of each table, as written.
    """
    spark = next(iter(tables.values())).sparkSession
    version = fresh_version(run_id)
    counts = {}
    for name, df in tables.items():
        out, seen = metrics.watched(df, name)
        out.write.parquet(f"{root}/{version}/{name}")
        counts[name] = seen.get["rows"]
    point(spark, root, version)
    return counts


def replace(tables: dict[str, DataFrame], root: str, run_id: str) -> dict[str, int]:
    """Publish `tables` in place of those of the same names; the other tables of the current version go on as they are.

    All of them change at once. A table may be derived from its own current version, as that stays where it is.
    """
    spark = next(iter(tables.values())).sparkSession
    kept = {name: read(spark, root, name) for name in table_names(spark, root) if name not in tables}
    return publish({**kept, **tables}, root, run_id)


def table_names(spark: SparkSession, root: str) -> list[str]:
    """The tables of the current version; none before the first publication."""
    version = current_version(spark, root)
    if version is None:
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{version}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def fresh_version(run_id: str) -> str:
    """A folder name for this attempt of a run."""
    return f"{run_id}.{uuid.uuid4().hex[:12]}"


def point(spark: SparkSession, root: str, version: str) -> None:
    """Make a finished folder the current one."""
    jvm, context = _context(spark, root)
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    fresh = path(f"{root}/CURRENT.{version}")
    out = fs.create(fresh, True)
    out.write(bytearray(version, "utf-8"))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fresh, path(f"{root}/CURRENT"), options)


def current_version(spark: SparkSession, root: str) -> str | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.text(f"{root}/CURRENT").first()[0]


def current_run(spark: SparkSession, root: str) -> str | None:
    """The id of the run whose tables are published."""
    version = current_version(spark, root)
    return version and version.rpartition(".")[0]


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published version of a table."""
    return spark.read.parquet(f"{root}/{current_version(spark, root)}/{name}")
