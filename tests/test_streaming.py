import re

from pyspark.sql import functions as F

from layerwright.sources import landing
from layerwright.streaming import relay, tables

EVENTS = "event_id long, event_type string, aggregate_id string, created_at timestamp, trace_id string, payload string"


def events(spark, ids):
    return spark.createDataFrame([(i, "e", "a") for i in ids], "event_id long, event_type string, aggregate_id string").select(
        "event_id", "event_type", "aggregate_id", F.expr("timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,event_id)").alias("created_at"),
        F.lit(None).cast("string").alias("trace_id"), F.lit("{}").alias("payload"))


def test_relay_resumes_from_its_checkpoint(spark, tmp_path):
    src, sink, mark = (str(tmp_path / n) for n in ("src", "sink", "mark"))
    events(spark, range(5)).write.parquet(src)

    def once():
        stream = spark.readStream.schema(EVENTS).parquet(src)
        relay.relay(stream, sink, mark).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(sink).collect())
    assert once() == [str(i) for i in range(5)] and once() == [str(i) for i in range(5)]
    events(spark, range(5, 8)).write.mode("append").parquet(src)
    assert once() == [str(i) for i in range(8)]


def test_dedup_by_event_id(spark, tmp_path):
    src, sink = str(tmp_path / "src"), str(tmp_path / "sink")
    events(spark, [1, 2, 2, 3, 1]).write.parquet(src)
    rows = relay.dedup_events(spark.readStream.schema(EVENTS).parquet(src)).select("event_id")
    rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "m")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_incremental_landing(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "lake")
    folder.mkdir()
    (folder / "a.csv").write_text("ticket_id,cost\nTKT-1,5\n")

    def once():
        tables.incremental_landing(spark, str(folder), "s", root, str(tmp_path / "m")).awaitTermination()
        return spark.read.schema(landing.BRONZE).parquet(f"{root}/bronze").count()
    assert once() == 1
    (folder / "b.csv").write_text("ticket_id,cost\nTKT-2,5\nTKT-3,1\n")
    (folder / "copy.csv").write_text("ticket_id,cost\nTKT-1,5\n")  # same bytes as a.csv
    assert once() == 3 and once() == 3


def test_upsert_replay_and_fingerprints(spark, tmp_path):
    path = str(tmp_path / "t")
    up = tables.upsert_batch(path)
    schema = "ticket_id string, bronze_id long, status string"
    up(spark.createDataFrame([("a", 1, "open"), ("b", 2, "open")], schema), 0)
    for _ in range(2):  # a repeated batch changes nothing
        up(spark.createDataFrame([("a", 5, "closed"), ("a", 4, "x"), ("c", 6, "open"), ("b", 1, "late")], schema), 1)
    want = {"a": "closed", "b": "open", "c": "open"}
    assert {r.ticket_id: r.status for r in tables.latest(spark, path).collect()} == want
    # a batch writes what it holds, not the table again
    assert {r.epoch: r["count"] for r in spark.read.parquet(path).groupBy("epoch").count().collect()} == {0: 2, 1: 3}
    small = str(tmp_path / "compacted")
    tables.compact(spark, path, small)
    tables.upsert_batch(small)(spark.createDataFrame([("b", 9, "done")], schema), 2)
    assert {r.ticket_id: r.status for r in tables.latest(spark, small).collect()} == {**want, "b": "done"}
    assert spark.read.parquet(small).count() == 4

    out = str(tmp_path / "months")
    hist = spark.createDataFrame([("2024-01", 1), ("2024-01", 2), ("2024-02", 7)], "created_month string, x int")
    rep = tables.replay_batch(out, lambda d: d.groupBy("created_month").agg(F.sum("x").alias("x")), lambda s: hist)
    rep(hist, 0)
    rep(hist.filter("x = 7"), 1)
    assert {r.created_month: r.x for r in spark.read.parquet(out).collect()} == {"2024-01": 3, "2024-02": 7}

    fp, found = str(tmp_path / "fp"), str(tmp_path / "found")
    batch = tables.fingerprint_batch(fp, found)
    cols = "bronze_id long, ticket_id string, ticket_number long, fingerprint string"
    batch(spark.createDataFrame([(1, "T1", 1, "f"), (2, "T2", 2, "g")], cols), 0)
    for _ in range(2):  # a repeated batch changes nothing
        batch(spark.createDataFrame([(3, "T9", 9, "f"), (4, "T4", 4, "h"), (5, "T5", 5, "h")], cols), 1)
    got = {(r.ticket_id, r.survivor_ticket_id) for r in spark.read.parquet(found).collect()}
    assert got == {("T9", "T1"), ("T5", "T4")} and spark.read.parquet(fp).select("fingerprint").distinct().count() == 3
    assert spark.read.parquet(found).count() == 2


def test_replay_reads_the_touched_months_only(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "months")
    batch = tables.landed_replay_batch(landed, out, lambda d: d.groupBy("created_month").agg(F.sum("x").alias("x")))
    cols = "created_month string, x int"
    batch(spark.createDataFrame([("2024-01", 1), ("2024-01", 2), ("2024-02", 7), (None, 5)], cols), 0)
    assert {r.created_month: r.x for r in spark.read.parquet(out).collect()} == {"2024-01": 3, "2024-02": 7}
    for _ in range(2):  # a repeated batch changes nothing
        batch(spark.createDataFrame([("2024-01", 10), ("2024-03", 4)], cols), 1)
    assert {r.created_month: r.x for r in spark.read.parquet(out).collect()} == {"2024-01": 13, "2024-02": 7, "2024-03": 4}
    batch(spark.createDataFrame([], cols), 2)
    assert spark.read.parquet(out).count() == 3
    # the filter of a replay selects folders, not rows
    plan = spark.read.schema(cols).parquet(landed).filter(F.col("created_month").isin("2024-01", "2024-03"))._jdf.queryExecution().executedPlan()
    assert re.search(r"PartitionFilters: \[[^]]*created_month#\d+ IN", plan.toString())
