"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only after a look at it showed at most this many rows and characters.
BROADCAST_ROWS, BROADCAST_CHARS = 200_000, 32_000_000
# A key with this many rows on the big side is handled apart, unless more than HOT_KEYS keys could have as many: then
# only keys that hold at least one in HOT_KEYS of all rows. So the list of hot keys is bounded without a cut.
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, chars: int = BROADCAST_CHARS) -> bool:
    """TRUE when the frame is small by rows and by what they hold; reads no more than it needs to know that."""
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct("*")))).alias("size")).first()
    return seen["n"] <= rows and (seen["size"] or 0) <= chars


def spread_join(left: DataFrame, right: DataFrame, key: Column, right_key: str, weight: str,
                unique: Column, hot_rows: int | None = None) -> DataFrame:
    """Left join on a string key when `right` holds one row per key and is too large to broadcast.

    `weight` is the number of left rows per key, known from the aggregate that made `right`. Rows of
    hot keys meet a broadcast list of at most HOT_KEYS keys; all other rows are shuffled by key. Rows that
    need no partner there (hot or NULL key) travel under their own unique id, so no task collects them.
    All columns of `right` but key and weight are added.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    values = [c for c in right.columns if c not in (right_key, weight)]
    packed = right.select(F.col(right_key).alias("_k"), F.col(weight).alias("_w"), F.struct(*values).alias("_v"))
    share = F.coalesce(right.agg(F.sum(weight) / F.lit(HOT_KEYS)).scalar(), F.lit(0.0))
    hot = packed.filter((F.col("_w") >= limit) & (F.col("_w") >= share)).select(F.col("_k").alias("_hk"), F.col("_v").alias("_hv"))
    marked = left.withColumn("_key", key).join(F.broadcast(hot), F.col("_key") == F.col("_hk"), "left")
    apart = F.concat(F.lit("\u0000"), F.xxhash64(unique).cast("string"))
    routed = marked.withColumn("_route", F.when(F.col("_hk").isNull() & F.col("_key").isNotNull(), F.col("_key"))
                               .otherwise(apart))
    # spread by all means: packed sizes say little about what a broadcast takes in memory
    joined = routed.join(packed.select("_k", "_v").hint("merge"), F.col("_route") == F.col("_k"), "left")
    value = F.coalesce(F.col("_hv"), F.col("_v"))
    return joined.select(*[F.col(c) for c in left.columns], *[value[c].alias(c) for c in values])


def lookup_join(left: DataFrame, right: DataFrame, key: Column, right_key: str, weight: str,
                unique: Column, small: bool) -> DataFrame:
    """Left join against one row per key: broadcast when `right` was measured small, else spread."""
    if not small:
        return spread_join(left, right, key, right_key, weight, unique)
    values = [c for c in right.columns if c not in (right_key, weight)]
    side = right.select(F.col(right_key).alias("_k"), *values)
    return left.join(F.broadcast(side), key == F.col("_k"), "left").drop("_k")
