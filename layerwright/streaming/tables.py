"""Incremental tables: landing of new files, latest-wins upsert, month replay, persisted fingerprints.

A batch adds a partition of its own, whose size follows the batch and not the table; repeating a batch replaces that
partition. Readers take the newest (or first) row per key over all partitions, and `compact` makes one of them now and then.
Replayed months are written to the work folder first, then moved in with a dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerwright import session
from layerwright.operators import skew
from layerwright.sources import landing


def _overwrite(df: DataFrame, name: str, path: str, partition: str) -> None:
    ready = session.staged(df, name)
    (ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def incremental_landing(spark: SparkSession, folder: str, source: str, root: str, checkpoint: str,
                        pattern: str = "*.csv") -> StreamingQuery:
    """Land every new file of a folder once, the files of a batch together. The stream carries paths only; content is read
    by `land_files`, whose manifest makes a repeated batch harmless."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = (spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", 1000)
             .load(folder).select("path"))

    def batch(df: DataFrame, epoch: int) -> None:
        paths = sorted(r["path"] for r in df.collect())  # at most maxFilesPerTrigger names
        if paths:
            landing.land_files(df.sparkSession, paths, source, root, f"stream-{epoch}")

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _extreme(rows: DataFrame, key: str, order: str, least: bool = False) -> DataFrame:
    """The row with the largest (or least) `order` of each key; an extreme of plain numbers, combined on the map side."""
    picked = rows.groupBy(key).agg((F.min if least else F.max)(order).alias(order))
    return rows.join(picked, [key, order], "left_semi").dropDuplicates([key])


def _add(df: DataFrame, path: str, epoch: int) -> None:
    (df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch").parquet(path))


def upsert_batch(path: str, key: str = "ticket_id", order: str = "bronze_id") -> Callable:
    """foreachBatch: add the newest row per key of the batch; `latest` reads the table."""
    def batch(df: DataFrame, epoch: int) -> None:
        _add(_extreme(df, key, order), path, epoch)
    return batch


def latest(spark: SparkSession, path: str, key: str = "ticket_id", order: str = "bronze_id") -> DataFrame:
    """The newest row per key over all batches."""
    return _extreme(spark.read.parquet(path).drop("epoch"), key, order)


def compact(spark: SparkSession, path: str, into: str, key: str = "ticket_id", order: str = "bronze_id") -> None:
    """Write the newest rows alone to the new folder `into`, as the batch before all others, for later batches to add to."""
    _add(latest(spark, path, key, order), into, -1)


def replay_batch(path: str, derive: Callable[[DataFrame], DataFrame], history: Callable[[SparkSession], DataFrame],
                 month: str = "created_month") -> Callable:
    """foreachBatch for late data: re-derive only the months that the batch touches, from all their rows.

    `history` gives the landed rows with the month column, the batch included.
    """
    def batch(df: DataFrame, epoch: int) -> None:
        # months, not rows, come to the driver
        touched = [r[0] for r in df.select(month).distinct().collect()]
        if touched:
            rows = history(df.sparkSession).filter(F.col(month).isin(touched))
            _overwrite(derive(rows), "replay", path, month)
    return batch


def landed_replay_batch(landed: str, path: str, derive: Callable[[DataFrame], DataFrame], month: str = "created_month") -> Callable:
    """foreachBatch: land the batch, then re-derive the months it touches from all rows landed so far.

    Landed rows lie in one folder per month and batch, so the filter on months prunes folders: a replay reads the touched
    months alone, however long the history. A repeated batch replaces its own folders.
    """
    def batch(df: DataFrame, epoch: int) -> None:
        rows = df.withColumn("epoch", F.lit(epoch))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month, "epoch").parquet(landed))
        replay_batch(path, derive, lambda spark: spark.read.schema(rows.schema).parquet(landed).drop("epoch"), month)(df, epoch)
    return batch


def fingerprint_batch(path: str, out: str) -> Callable:
    """foreachBatch: known content points to its first ticket; new content is remembered.

    Rows: bronze_id, ticket_id, ticket_number, fingerprint. The survivor is the lowest number seen up to this batch. Only
    fingerprints of the batch are looked for in what was remembered, and only they are added. Frequencies are
    not revised here: a full rebuild may merge differently.
    """
    def batch(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        rows = df.select("fingerprint", "ticket_number", "bronze_id", "ticket_id")
        new = session.staged(_extreme(rows, "fingerprint", "ticket_number", least=True), "new-fingerprints")
        known = new
        if landing.exists(spark, path):
            before = spark.read.parquet(path).filter(F.col("epoch") < epoch).drop("epoch")
            asked = before.join(new.select("fingerprint"), "fingerprint", "left_semi")
            known = _extreme(asked.unionByName(new), "fingerprint", "ticket_number", least=True)
        copies = df.groupBy("fingerprint").agg(F.count("*").alias("copies"))
        first = known.select("fingerprint", F.col("ticket_id").alias("survivor_ticket_id")).join(copies, "fingerprint")
        met = skew.spread_join(df, first, F.col("fingerprint"), "fingerprint", "copies", F.col("bronze_id"))
        _add(met.filter(F.col("ticket_id") != F.col("survivor_ticket_id")), out, epoch)
        _add(new, path, epoch)
    return batch
