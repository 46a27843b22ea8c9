"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import layerwright
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows in one Arrow batch: a task holds one batch of texts at a time.
BATCH_ROWS = 256
HELD_OUT_OF, HELD_OUT = 4, 2


_SHIPPED: set[str] = set()


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, since one row may hold a very long text, and this package on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        # Spark copies the archive from the driver to each executor; no task reads this folder
        folder = tempfile.mkdtemp(prefix="layerwright-package-")
        root = os.path.dirname(os.path.abspath(layerwright.__file__))
        shutil.copytree(root, os.path.join(folder, "layerwright"), ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "layerwright-package"), "zip", folder, "layerwright"))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(key: Column) -> Column:
    """TRUE for the quarter of the keys that nothing may be learned from; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def learnable(key: Column) -> Column:
    """TRUE for keys that may be learned from: known, and not held out."""
    return key.isNotNull() & ~held_out(key)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], schema: str) -> DataFrame:
    """Apply `fn` to each Arrow batch. It returns the columns of `schema` by name."""
    names = [part.split()[0] for part in _fields(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def _array(values: object) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        return values.combine_chunks()
    return values if isinstance(values, pa.Array) else pa.array(values)


def _fields(schema: str) -> list[str]:
    """Split "a long, b array<struct<x:int,y:int>>" at its outer commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(schema):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            out.append(schema[start:i].strip())
            start = i + 1
    return [*out, schema[start:].strip()]
