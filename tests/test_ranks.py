import random

import numpy as np
from pyspark.sql import functions as F

from layerwright.operators import ranks


def test_quantiles_equal_sorting_everything(spark):
    rng = random.Random(2)
    draw = {"a": lambda: rng.choice([0.0, -0.0, 1.5, -7.25, 1e300, -1e-300, 3.0]), "b": lambda: rng.gauss(0, 1000), None: lambda: float(rng.randrange(-5, 900)),
            "one": lambda: 4.5, "near": lambda: 1 + rng.randrange(2000) * 1e-12}
    rows = [(g, x(), 1 + rng.randrange(3)) for g, x in draw.items() for _ in range(1 if g == "one" else 700)]
    df = spark.createDataFrame([*rows, ("none", None, 5), ("a", None, 1), ("b", float("nan"), 9)], "g string, x double, n long").repartition(5)
    wanted = {"low": 0.0, "p01": 0.01, "mid": 0.5, "p99": 0.99, "top": 1.0}
    got = {r.g: r for r in ranks.quantiles(df, ["g"], "x", "n", wanted).collect()}
    assert got.keys() == draw.keys()
    for g in draw:
        own = np.repeat([x for k, x, _ in rows if k == g], [n for k, _, n in rows if k == g])
        for name, p in wanted.items():
            assert np.isclose(got[g][name], np.quantile(own, p), rtol=1e-12, atol=0), (g, name)


def test_quantile_plan_has_no_percentile_buffer(spark):
    df = spark.range(10).select(F.lit("k").alias("g"), F.col("id").cast("double").alias("x"), F.lit(1).alias("n"))
    plan = ranks.quantiles(df, ["g"], "x", "n", {"mid": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower()


def test_no_values(spark):
    df = spark.createDataFrame([], "g string, x double, n long")
    assert ranks.quantiles(df, ["g"], "x", "n", {"mid": 0.5}).collect() == []
    assert ranks.numbered(df, "x").collect() == []


def test_numbered_rows_make_pages(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 7 == 0 else rng.randrange(40)) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        df = ranks.numbered(spark.createDataFrame(rows, "id long, v int").repartition(6), F.asc_nulls_last("v"), F.col("id"))
        got = {r.id: r["rank"] for r in df.collect()}
        page = [r.id for r in df.filter("rank BETWEEN 11 AND 20").orderBy("rank").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    want = [i for i, _ in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))]
    assert got == {i: n + 1 for n, i in enumerate(want)} and page == want[10:20]
