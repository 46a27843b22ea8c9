"""Read-only reports over all layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.plans.gold import pct


def bronze_summary(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count("*").alias("rows"), F.count_distinct("file_sha256").alias("files"), F.max("ingested_at").alias("last"))


def silver_summary(tickets: DataFrame, quarantine: DataFrame, duplicates: DataFrame) -> DataFrame:
    def tagged(df: DataFrame, part: str) -> DataFrame:
        return df.select(F.lit(part).alias("part"))
    rows = tagged(tickets, "tickets").unionAll(tagged(quarantine, "quarantined")).unionAll(tagged(duplicates, "duplicates"))
    return rows.agg(*[F.count_if(F.col("part") == p).alias(p) for p in ("tickets", "quarantined", "duplicates")])


def quarantine_reasons(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def top_flags(tickets: DataFrame, k: int = 12) -> DataFrame:
    return (tickets.select(F.explode("dq_flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "flag").limit(k))


def duplicates_by_rule(duplicates: DataFrame) -> DataFrame:
    return duplicates.groupBy("match_rule").agg(F.count("*").alias("n"))


def category_sources(tickets: DataFrame, k: int = 15) -> DataFrame:
    return (tickets.groupBy("category", "category_source").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "category", "category_source").limit(k))


def gate_latest(results: DataFrame) -> DataFrame:
    """Results of the run checked last; that run is one value, not a join."""
    last = results.agg(F.max_by("run_id", "checked_at")).scalar()
    return results.filter(F.col("run_id") == last).select("check_id", "severity", "violations", "violation_rate", "threshold", "passed")


def sla_by_category(mart: DataFrame) -> DataFrame:
    return mart.groupBy("category").agg(F.sum("tickets_created").alias("created"), F.sum("sla_measurable").alias("measurable"),
                                        pct(F.sum("sla_met"), F.sum("sla_measurable")).alias("sla_pct"))


def vendors(mart: DataFrame) -> DataFrame:
    return mart.select("assignee", "assignee_type", "tickets_assigned", F.col("median_resolution_hours").alias("median_h"),
                       F.col("sla_compliance_pct").alias("sla_pct"), "avg_cost_usd", "temporary_fix_pct").orderBy(F.desc("tickets_assigned"), "assignee")


def backlog_by_building(mart: DataFrame, k: int = 8) -> DataFrame:
    return (mart.groupBy("building").agg(F.sum("open_tickets").alias("open"), F.sum("open_safety_hazards").alias("hazards"),
                                         F.sum("past_sla").alias("past_sla"), F.max("oldest_open_days").alias("oldest_days"))
            .orderBy(F.desc("open"), "building").limit(k))


def hazards(view: DataFrame, k: int = 8) -> DataFrame:
    return (view.groupBy("issue_type", "priority", "inferred_severity").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_last("issue_type"), F.asc_nulls_last("priority"), "inferred_severity").limit(k))


def proposals(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("agent", "status").agg(F.count("*").alias("n"))


def usage(calls: DataFrame) -> DataFrame:
    return calls.groupBy("provider", "model", "status").agg(
        F.count("*").alias("calls"), F.sum("input_tokens").alias("tok_in"), F.sum("output_tokens").alias("tok_out"),
        F.round(F.sum("cost_usd"), 4).alias("usd"))


def events(outbox: DataFrame) -> DataFrame:
    return outbox.groupBy("event_type").agg(F.count("*").alias("n"), F.count("published_at").alias("relayed"))


def recent_runs(runs: DataFrame, k: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("created_at"), "run_id").limit(k)
