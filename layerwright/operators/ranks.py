"""Ranks and exact quantiles without a task that holds all rows of a table or group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerwright import session

# parts of a power of two that the first and the second level of a selection tell apart
COARSE, FINE = 16, 2**20


def numbered(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Add the place of each row in a total order, from 1: a page is then `rank BETWEEN a AND b`.

    Rows are dealt by range and sorted within each range; a range's first rank is the number of rows in the ranges before it.
    One number for each range meets on the driver. Rows that are equal in the order get different ranks.
    """
    place = F.monotonically_increasing_id().alias("_place")
    rows = session.staged(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", place), "numbered")
    part = F.shiftright("_place", 33).cast("int")
    before, starts = 0, []
    for r in rows.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _before long")
    within = F.col("_place").bitwiseAND(F.lit(2**33 - 1)) + 1
    return (rows.join(F.broadcast(offsets), part == F.col("_part")).withColumn(name, F.col("_before") + within)
            .drop("_place", "_part", "_before"))


def _scale(x: Column) -> Column:
    """A number that rises with x, one for each power of two and linear between two of them."""
    size = F.abs(x)
    power = F.floor(F.log2(size))
    return F.when(x == 0, 0.0).otherwise(F.signum(x) * (1100 + power + size / F.pow(F.lit(2.0), power) - 1))


def quantiles(values: DataFrame, group: list[str], x: str, weight: str, wanted: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles of x per group: the group columns and one column for each name in `wanted`.

    `values` has a row for each value or some more, with its weight. Selection in three steps: weights by coarse parts of the
    number line tell in which part a rank lies, finer parts of that part narrow it down, and only values of the fine part
    are sorted. No aggregation buffer grows with the number of different values; the window over the parts of a
    group sees at most some 30,000 of them. Groups may have NULL keys; rows without x don't count, NaN is none either.
    """
    g = F.struct(*[F.col(c) for c in group])
    level = _scale(F.col("x"))
    rows = (values.select(g.alias("g"), F.col(x).cast("double").alias("x"), F.col(weight).alias("w")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
            .groupBy("g", "x").agg(F.sum("w").alias("w"))
            .withColumns({"coarse": F.floor(level * COARSE), "fine": F.floor(level * FINE)}))
    at = lambda p: (F.col("n") - 1) * F.lit(float(p))
    targets = rows.groupBy("g").agg(F.sum("w").alias("n")).select("g", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(up).alias("up"), (F.ceil(at(p)) if up else F.floor(at(p))).alias("rank"),
                 (at(p) - F.floor(at(p))).alias("share")) for name, p in wanted.items() for up in (False, True)])).alias("t")).select("g", "t.*")
    for keys, step in ((["g"], "coarse"), (["g", "coarse"], "fine"), (["g", "coarse", "fine"], "x")):
        inside = rows.join(targets.select(*keys).distinct(), keys, "left_semi") if len(keys) > 1 else rows
        parts = inside.groupBy(*keys, step).agg(F.sum("w").alias("w"))
        upto = F.sum("w").over(Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        parts = parts.withColumn("start", upto - F.col("w"))
        targets = (targets.join(parts, keys).filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("w")))
                   .withColumn("rank", F.col("rank") - F.col("start")).drop("start", "w"))
    value = lambda name, up: F.max(F.when((F.col("name") == name) & (F.col("up") == up), F.col("x")))
    share = lambda name: F.max(F.when(F.col("name") == name, F.col("share")))
    found = targets.groupBy("g").agg(*[(value(n, False) * (1 - share(n)) + value(n, True) * share(n)).alias(n) for n in wanted])
    return found.select("g.*", *wanted)


def with_quantiles(df: DataFrame, found: DataFrame, group: list[str]) -> DataFrame:
    """Join quantiles to a frame of one row per group; NULL keys meet NULL keys."""
    names = [c for c in found.columns if c not in group]
    side = found.select(*[F.col(c).alias(f"_{c}") for c in group], *names)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    return df.join(side, same, "left").drop(*[f"_{c}" for c in group])
