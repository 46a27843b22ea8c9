import csv

import pytest
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright.operators import metrics, review, rules
from layerwright.plans import publish, run, silver
from layerwright.sources import landing, refdata
from layerwright.sources import tickets as T


def write(path, header, rows, bom=False):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)
    return str(path)


def test_verbatim_rows(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('﻿id,name,note\n1,  padded ,"two\nlines, ""quoted"""\n2,,\n3,short\n4,a,b,extra,"more, x"\n', encoding="utf-8")
    header = landing.read_header(spark, str(path))
    got = {r.row_no: r.payload for r in landing.read_rows(spark, str(path), header).collect()}
    assert header == ["id", "name", "note"]
    assert got[1] == {"id": "1", "name": "  padded ", "note": 'two\nlines, "quoted"'}
    assert got[2] == {"id": "2", "name": "", "note": ""}
    assert got[3] == {"id": "3", "name": "short", "note": None}
    assert got[4] == {"id": "4", "name": "a", "note": "b", "_extra_fields": '["extra", "more, x"]'}


def test_landing_is_idempotent_and_reports_drift(spark, tmp_path):
    root = str(tmp_path / "lake")
    a = write(tmp_path / "a.csv", ["ticket_id", "cost"], [["TKT-1", "5"], ["TKT-2", "6"]])
    first, again = landing.land(spark, a, "s", root, "r1"), landing.land(spark, a, "s", root, "r2")
    assert (first.rows_out, again.rows_out, again.skipped) == (2, 0, True)
    b = write(tmp_path / "b.csv", ["ticket_id", "floor_area"], [["TKT-1", "120"]])
    c = landing.land(spark, b, "s", root, "r3")
    assert c.drift == {"added": ["floor_area"], "removed": ["cost"]} and c.alerts
    d = landing.land(spark, write(tmp_path / "d.csv", ["ticket_id", "floor_area"], [["TKT-1", "120"], ["TKT-9", "1"]]), "s", root, "r4")
    assert (d.rows_out, d.repeated, d.drift) == (2, 1, None)
    bronze = spark.read.schema(landing.BRONZE).parquet(f"{root}/bronze")
    assert bronze.count() == 5 and bronze.select("bronze_id").distinct().count() == 5


@pytest.fixture(scope="module")
def ticket_file(spark, tmp_path_factory):
    orders = T.table(spark, "/root/testdata/sf0.001", "orders")
    rows = T.raw_tickets(orders).orderBy("bronze_id").select(*silver.SOURCE_COLUMNS).collect()
    return write(tmp_path_factory.mktemp("in") / "tickets.csv", silver.SOURCE_COLUMNS, rows)


def test_run_twice_then_block(spark, tmp_path, ticket_file):
    root = str(tmp_path / "lake")
    args = (spark, [ticket_file], "tickets", root)
    maps = (T.label_map(spark), T.template_map(spark))
    mild = [c for c in fv.DQ_CHECKS if c[1] != "critical"]
    one = run.run(*args, "r1", *maps, checks=mild)
    assert one.counts["bronze"] == one.counts["tickets"] + one.counts["quarantine"] + one.counts["duplicates"]
    assert one.counts["fct_tickets"] == one.counts["tickets"]

    def mark():
        skip = ("_run_id", "_processed_at", "raw")
        return metrics.table_fingerprint(publish.read(spark, f"{root}/silver", "tickets"), skip).first()

    before, held = mark(), publish.read(spark, f"{root}/silver", "tickets")
    again = run.run(*args, "r1", *maps, checks=mild)  # a repeat of a published run, while somebody reads the first
    assert held.count() == one.counts["tickets"] and again.counts == one.counts
    two = run.run(*args, "r2", *maps, checks=mild)
    assert mark() == before and two.counts == one.counts
    log = spark.read.parquet(f"{root}/stage_runs")
    good = metrics.previous_success(log, spark.read.parquet(f"{root}/runs"), "silver", "r2").first()
    assert good.run_id == "r1" and good.metrics and log.filter("stage = 'gate'").count() == 3
    with pytest.raises(run.GateBlocked):
        run.run(*args, "r3", *maps, checks=[("always_fails", "critical", "true", 0.0)])
    assert publish.current_run(spark, f"{root}/gold") == "r2"
    assert publish.current_run(spark, f"{root}/silver") == "r3"


def test_rule_threshold_edge_and_validity(spark):
    t = spark.createDataFrame([("a", 1), ("b", None), ("c", 3), ("d", 4)], "ticket_id string, x int")
    out = {r.check_id: r for r in rules.gate_results(t, [("edge", "critical", "x = 1", 0.25), ("over", "critical", "x >= 3", 0.25)], "now()").collect()}
    assert out["edge"].passed and not out["edge"].blocking and out["edge"].sample == ["a"]
    assert not out["over"].passed and out["over"].blocking and out["over"].sample == ["c", "d"]
    tried = {"null": "x IS NULL", "odd": "x % 2 = 1 AND ticket_id <> 'select; from'", "number": "x + 1", "unknown": "nope = 1",
             "subquery": "x IN (SELECT 1)", "outside": "reflect('java.lang.System', 'nanoTime') IS NULL"}
    got = {r.check_id: r for r in rules.evaluate_predicates(t, tried).collect()}
    assert (got["null"].violations, got["null"].total, got["null"].violation_rate, got["null"].sample) == (1, 4, 0.25, ["b"])
    assert (got["odd"].problem, got["odd"].violations) == (None, 2)
    assert all(got[c].problem and got[c].violations is None and got[c].sample == [] for c in ("number", "unknown", "subquery", "outside"))
    v = rules.evaluate_cleaning(t.select(F.col("ticket_id").alias("v")), "CASE WHEN v LIKE '%a%' THEN NULL ELSE upper(v) END")
    assert [r.cleaned for r in v.orderBy("v").collect()] == [None, "B", "C", "D"]
    with pytest.raises(ValueError):
        rules.evaluate_cleaning(t.select(F.col("ticket_id").alias("v")), "(SELECT 1)")


def test_proposed_queries_read_allowed_views_only(spark):
    spark.conf.set("spark.sql.runSQLOnFiles", "false")
    spark.range(4).createOrReplaceTempView("t_open")
    spark.range(4).createOrReplaceTempView("t_closed")
    ok = ["SELECT id, count(*) AS n FROM t_open GROUP BY id", "WITH c AS (SELECT * FROM t_open) SELECT * FROM c JOIN t_open USING (id)",
          "SELECT id FROM t_open WHERE id = (SELECT max(id) FROM t_open)"]
    for query in ok:
        assert rules.query_problem(spark, query, {"t_open"}) is None, query
    bad = ["DROP TABLE t_open", "SELECT 1; SELECT 2", "SELECT * FROM t_closed", "SELECT * FROM text.`/etc/hostname`", "SELECT * FROM range(3)",
           "SELECT id FROM t_open WHERE id IN (SELECT id FROM t_closed)", "WITH t_closed AS (SELECT * FROM t_closed) SELECT * FROM t_closed",
           "SELECT java_method('java.lang.System', 'nanoTime') AS v FROM t_open", "SELECT nope FROM t_open"]
    for query in bad:
        assert rules.query_problem(spark, query, {"t_open"}), query
    row = rules.evaluate_query(spark, ok[0], {"t_open"}).first()
    assert (row.problem, row.columns, row.rows) == (None, ["id", "n"], 4)
    assert rules.evaluate_query(spark, bad[2], {"t_open"}).first().rows is None
    rules.register_sandbox(spark, "mart_by_id", ok[0], {"t_open"})
    assert spark.table("mart_by_id").count() == 4
    for name, query in (("bad name", ok[0]), ("mart_closed", bad[2])):
        with pytest.raises(ValueError):
            rules.register_sandbox(spark, name, query, {"t_open"})


def test_reference_maintenance(spark, tmp_path):
    cur = spark.createDataFrame([("a", "hvac", 1), ("b", "it", 1)], "label string, category string, approved_at int")
    new = spark.createDataFrame([("a", "plumbing", 2), ("c", "x", 2)], "label string, category string, approved_at int")
    assert {r.label: r.category for r in refdata.upsert(cur, new, ["label"]).collect()} == {"a": "plumbing", "b": "it", "c": "x"}
    assert {r.label: r.category for r in refdata.seed(cur, new, ["label"]).collect()} == {"a": "hvac", "b": "it", "c": "x"}
    path = str(tmp_path / "map")
    refdata.export_csv(T.label_map(spark).withColumn("source", F.lit("seed")), "label", path)
    assert refdata.read_labels(spark, path).count() == len(T.LABELS)
    assert refdata.taxonomy(spark)["related"].filter("category_a < category_b").count() == len(fv.RELATED)


def test_review_round_trip(spark):
    schema = ("proposal_id string, kind string, subject string, created_at int, proposal map<string,string>, status string, "
              "source string, confidence double, overridden boolean, agent_original map<string,string>, reviewed_by string")
    none = (None, None)
    led = spark.createDataFrame([
        ("p1", "category_label", "roofing", 1, {"category": "plumbing", "label_kind": "category_label"}, "proposed", "rules", .6, False, *none),
        ("p2", "category_label", "old", 1, {"category": "hvac"}, "approved", "model", .9, False, *none)], schema)
    dec = spark.createDataFrame([("p1", True, "ann", {"category": "general_maintenance"}), ("p2", True, "ann", None)],
                                "proposal_id string, approve boolean, reviewer string, overrides map<string,string>")
    done = review.decide(led.drop("agent_original", "reviewed_by"), dec).collect()
    assert [d.proposal_id for d in done] == ["p1"]  # p2 was decided before
    assert done[0].proposal == {"category": "general_maintenance", "label_kind": "category_label"}
    assert done[0].agent_original == {"category": "plumbing"} and done[0].source == "rules+human"
    fix = spark.createDataFrame([("category_label", "old", "p3", {"category": "it_network"}, "bo", 5)],
                                "kind string, subject string, proposal_id string, values map<string,string>, reviewer string, created_at int")
    row = review.correct(led, fix).first()
    assert row.proposal == {"category": "it_network"} and row.agent_original == {"category": "hvac"} and row.status == "approved"
    # a decision is appended; from then on its proposal is no longer pending and cannot be decided again
    grown = review.append(review.append(led.limit(0), led), review.decide(led, dec))
    assert grown.count() == 3 and review.pending(grown).count() == 0 and review.decide(grown, dec).count() == 0
    assert review.latest_per_subject(grown).count() == 2
    assert [(e.text, e.agent_answer, e.human_answer) for e in review.episodes(grown).collect()] == [
        ("roofing", {"category": "plumbing"}, {"category": "general_maintenance"})]
    seeded = spark.createDataFrame([("category_label", "seeded", {"category": "hvac"})], "kind string, subject string, proposal map<string,string>")
    more = fix.withColumn("subject", F.lit("seeded")).unionAll(fix.withColumn("subject", F.lit("nowhere")))
    got = {r.subject: (r.status, r.agent_original) for r in review.correct(led, more, seeded).collect()}
    assert got == {"seeded": ("approved", {"category": "hvac"}), "nowhere": ("rejected", None)}
    assert metrics.stage_status(False, []) == "succeeded" and metrics.stage_status(True, ["x"]) == "blocked"
    assert metrics.stage_alerts(2, 100, 0, 0) and not metrics.stage_alerts(1, 100, 0, 0)
