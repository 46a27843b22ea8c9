import pytest
from pyspark.sql import functions as F

from layerwright.operators import metrics
from layerwright.plans import publish
from layerwright.sources import refdata


def test_replace_keeps_the_other_tables(spark, tmp_path):
    root, one = str(tmp_path), lambda *v: spark.createDataFrame([(x,) for x in v], "x string")
    rows = lambda name: sorted(r.x for r in publish.read(spark, root, name).collect())
    assert publish.table_names(spark, root) == []
    publish.replace({"a": one("1", "2"), "b": one("3")}, root, "r1")
    # from its own current version
    publish.replace({"a": publish.read(spark, root, "a").filter("x = '2'").unionByName(one("4"))}, root, "r2")
    assert publish.table_names(spark, root) == ["a", "b"] and rows("a") == ["2", "4"] and rows("b") == ["3"]
    publish.replace({"b": one()}, root, "r3")
    assert rows("a") == ["2", "4"] and rows("b") == [] and publish.current_run(spark, root) == "r3"


def test_rules_come_back_from_a_file(spark, tmp_path):
    path = str(tmp_path / "rules")
    checks = [("z", "critical", "a = 'x, \"y\"'\nAND b < 1", 0.5), ("a", "info", "c IS NULL", 0.0)]
    refdata.export_csv(refdata.rule_frame(spark, checks), "check_id", path)
    assert refdata.rule_list(refdata.read_rules(spark, path)) == sorted(checks)
    assert refdata.rule_list(refdata.rule_frame(spark, [])) == []
    (tmp_path / "bad.csv").write_text("check_id,severity,predicate,threshold\nq,info,a = 1,many\n")
    for bad in (refdata.read_rules(spark, str(tmp_path / "bad.csv")), refdata.rule_frame(spark, [*checks, checks[0]])):
        with pytest.raises(ValueError):
            refdata.rule_list(bad)


def test_episodes_come_back_in_order(spark, tmp_path):
    path, schema = str(tmp_path / "episodes"), "task string, text string, agent_answer map<string,string>, human_answer map<string,string>"
    rows = [("t", 'b\n"x" ', {"k": "1"}, {"k": None}), ("t", "a", None, {}), ("t", None, {"k": ""}, {"l": "é"})]
    refdata.export_json(spark.createDataFrame(rows, schema), "text", path)
    back = {r.text: r for r in refdata.read_episodes(spark, path).collect()}
    assert set(back) == {None, "a", rows[0][1]} and back["a"].agent_answer is None
    assert back[rows[0][1]].agent_answer == {"k": "1"} and not (back[rows[0][1]].human_answer or {}).get("k")
    assert back[None].agent_answer == {"k": ""} and back[None].human_answer == {"l": "é"}


def test_numbers_come_from_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else "x", None) for i in range(40)], "k long, a string, b string").repartition(7)
    out, seen = metrics.watched(rows, "t", ["a", "b"], even=F.col("k") % 2 == 0)
    out.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 40 and seen.get["even"] == 20
    want = {r["column"]: r.null_rate for r in metrics.null_rates(spark.read.parquet(str(tmp_path / "t")), ["a", "b"]).collect()}
    assert metrics.watched_rates(seen.get) == want == {"a": 0.35, "b": 1.0}
    out, seen = metrics.watched(rows.filter("k < 0"), "none", ["a"])
    out.write.parquet(str(tmp_path / "none"))
    assert seen.get["rows"] == 0 and metrics.watched_rates(seen.get) == {"a": 0.0}
    assert publish.publish({"x": rows, "y": rows.limit(0)}, str(tmp_path / "p"), "r") == {"x": 40, "y": 0}
