"""One batch run: land, clean, check, publish. Driver code only strings DataFrames together."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright.operators import metrics, review, rules
from layerwright.plans import gold, publish, silver
from layerwright.sources import landing


class GateBlocked(RuntimeError):
    """A critical rule failed; the published gold tables stay as they are."""


@dataclass
class RunResult:
    run_id: str
    status: str
    counts: dict[str, int]
    alerts: list[str] = field(default_factory=list)


def run(spark: SparkSession, paths: list[str], source: str, root: str, run_id: str, labels: DataFrame,
        templates: DataFrame, checks: list[tuple] | None = None, as_of: str = "timestamp_ntz '2100-01-01 00:00:00'",
        pending: DataFrame | None = None) -> RunResult:
    """Land the files, rebuild silver, run the gate and publish gold under `root`."""
    alerts = [a for f in landing.land_files(spark, paths, source, root, run_id) for a in f.alerts]
    raw = landing.flat_view(spark.read.schema(landing.BRONZE).parquet(f"{root}/bronze"), silver.SOURCE_COLUMNS)
    built = silver.build(raw, labels, templates, run_id)
    before = _rates_of_last_good_run(spark, root, run_id)
    # written to a folder of this attempt first and checked there; the pointer moves only when the counts add up
    version = publish.fresh_version(run_id)
    folder = f"{root}/silver/{version}"
    parts = {"tickets": built.tickets, "quarantine": built.quarantine, "duplicates": built.duplicates}
    for name, df in parts.items():
        df.write.parquet(f"{folder}/{name}")
    done = {name: spark.read.parquet(f"{folder}/{name}") for name in parts}
    counts = {name: df.count() for name, df in done.items()} | {"bronze": raw.select("bronze_id").count()}
    if counts["bronze"] != counts["tickets"] + counts["quarantine"] + counts["duplicates"]:
        raise RuntimeError(f"reconciliation failed: {counts}")
    publish.point(spark, f"{root}/silver", version)
    tickets = done["tickets"]
    waiting = review.pending(pending).count() if pending is not None else 0
    unresolved = tickets.filter(F.col("category_source") == "unresolved").count() if waiting else 0
    alerts += metrics.stage_alerts(counts["quarantine"], counts["bronze"], waiting, unresolved)
    # one row per watched column
    rates = {r["column"]: r["null_rate"] for r in metrics.null_rates(tickets).collect()}
    if before is not None:
        alerts += [r["alert"] for r in metrics.null_rate_alerts(_rates(spark, rates), _rates(spark, before)).collect()]
    log(spark, root, "stage_runs", run_id, "silver", metrics.stage_status(False, alerts), rates)
    results = rules.gate_results(tickets, checks if checks is not None else fv.DQ_CHECKS, as_of)
    results = results.withColumn("run_id", F.lit(run_id)).withColumn("checked_at", F.current_timestamp())
    results.write.mode("append").parquet(f"{root}/dq_results")
    mine = spark.read.parquet(f"{root}/dq_results").filter(F.col("run_id") == run_id)
    alerts += [f"rule {r['check_id']} ({r['severity']}): {r['violation_rate']:.2%} of the rows, allowed {r['threshold']:.2%}"
               for r in mine.filter(~F.col("passed")).collect()]
    blocked = not rules.gate_open(mine)
    log(spark, root, "stage_runs", run_id, "gate", metrics.stage_status(blocked, alerts), {})
    if blocked:
        log(spark, root, "runs", run_id, "run", "blocked", {k: float(n) for k, n in counts.items()})
        raise GateBlocked("; ".join(alerts))
    publish.publish(gold.build(tickets, run_id), f"{root}/gold", run_id)
    counts["fct_tickets"] = publish.read(spark, f"{root}/gold", "fct_tickets").count()
    alerts += gold.count_check(counts, counts["tickets"])
    status = "succeeded_with_warnings" if alerts else "succeeded"
    log(spark, root, "runs", run_id, "run", status, {k: float(n) for k, n in counts.items()})
    return RunResult(run_id, status, counts, alerts)


_LOG = "run_id string, stage string, status string, metrics map<string,double>"


def log(spark: SparkSession, root: str, name: str, run_id: str, stage: str, status: str, numbers: dict[str, float]) -> None:
    """Append one row to a log table under `root`."""
    row = spark.createDataFrame([(run_id, stage, status, numbers)], _LOG)
    row.withColumn("finished_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def _rates(spark: SparkSession, rates: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(rates.items()), "column string, null_rate double")


def _rates_of_last_good_run(spark: SparkSession, root: str, run_id: str) -> dict[str, float] | None:
    """Null rates that the log has for the newest good silver stage of a run that ended."""
    if not all(landing.exists(spark, f"{root}/{name}") for name in ("stage_runs", "runs")):
        return None
    stages, runs = (spark.read.parquet(f"{root}/{name}") for name in ("stage_runs", "runs"))
    found = metrics.previous_success(stages, runs, "silver", run_id).first()
    return found["metrics"] if found else None

