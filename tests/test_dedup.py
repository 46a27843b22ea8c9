"""Duplicate rules on keys that repeat, are null or come once, with and without the list of repeated keys."""

import pytest
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright import session
from layerwright.operators import dedup
from layerwright.plans import silver

ROWS = [(1, "TKT-1", 1, "f1", ["a"]), (2, "TKT-1", 1, "f2", ["b"]), (3, "TKT-2", 2, "f2", ["b"]), (4, "TKT-3", 3, "f3", ["c"]),
        (5, None, None, "f4", ["d"]), (6, None, None, "f4", ["d"]), (7, "TKT-4", 4, "f2", ["b"]), (7, "TKT-4", 4, "f2", ["b"])]


@pytest.mark.parametrize("most", [dedup.REPEATED_KEYS, 0])
def test_latest_rows_and_repeated_content(spark, monkeypatch, most):
    monkeypatch.setattr(dedup, "REPEATED_KEYS", most)
    slim = spark.createDataFrame(ROWS, "bronze_id long, ticket_id string, ticket_number long, fingerprint string, content array<string>")
    latest = dedup.latest_per_id(slim)
    assert sorted(r.bronze_id for r in latest.collect()) == [2, 3, 4, 6, 7]
    found = {r.fingerprint: (r.copies, r.keep.ticket_id) for r in dedup.repeated_content(latest).collect()}
    assert found == {"f2": (3, "TKT-1")}
    assert sorted(r.bronze_id for r in dedup.superseded(slim, latest).collect()) == [1, 5]


def test_rows_of_single_keys_are_not_sorted(spark):
    slim = spark.createDataFrame(ROWS, "bronze_id long, ticket_id string, ticket_number long, fingerprint string, content array<string>")
    plan = dedup.latest_per_id(slim)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    assert "LeftSemi" in dedup.repeated_content(slim)._jdf.queryExecution().optimizedPlan().toString()


def test_references_come_from_the_narrow_rows(spark):
    notes = ["  Duplicate of  ticket #0012. Closing.", "duplicate of ticket #000", "Duplicate of ticket #7", "n/a", None, "see duplicate of ticket #7"]
    columns = ["ticket_id", *fv.FINGERPRINT_FIELDS]
    rows = [(i, *["TKT-7" if c == "ticket_id" else note if c == "resolution_notes" else "x" for c in columns]) for i, note in enumerate(notes)]
    slim = dedup.narrow(spark.createDataFrame(rows, ", ".join(["bronze_id long", *[f"{c} string" for c in columns]])))
    refs = dedup.references(slim)
    assert sorted((r.bronze_id, r.duplicate_of_ticket_id) for r in refs.collect()) == [(0, "TKT-12"), (2, "TKT-7")]
    assert [r.bronze_id for r in dedup.missing_references(refs, slim).collect()] == [0]


def test_wide_steps_are_cut_into_methods_that_the_jvm_compiles(spark, tmp_path):
    """A scan of as many columns as a ticket has, in one generated method, would stay interpreted for long."""
    session.tune(spark)
    wide = spark.range(10).selectExpr(*[f"concat('a', id % {i + 2}) AS {c}" for i, c in enumerate(silver.TICKET_COLUMNS)])
    wide.write.parquet(f"{tmp_path}/wide")
    read = spark.read.parquet(f"{tmp_path}/wide")
    plan = read.select(*[F.upper(c).alias(c) for c in read.columns])._jdf.queryExecution().executedPlan().toString()
    assert "Project" in plan and "*(1) Project" not in plan
