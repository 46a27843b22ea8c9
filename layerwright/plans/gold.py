"""Gold: star schema, marts, hazard view and edge table as plain DataFrames over silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright.functions import clean
from layerwright.operators import ranks


def as_of_date(tickets: DataFrame) -> Column:
    """Day of the newest ticket, as a scalar subquery: rebuilds are reproducible without a clock."""
    return tickets.agg(F.max("created_at").cast("date")).scalar()


# ------------------------------------------------------------------ dimensions
def dim_category(spark: SparkSession, descriptions: DataFrame | None = None) -> DataFrame:
    """The categories; `descriptions` (category, description) come with the user's reference data."""
    names = spark.createDataFrame([(c,) for c in fv.CATEGORIES], "category string")
    if descriptions is None:
        return names.withColumn("description", F.lit(None).cast("string"))
    return names.join(F.broadcast(names.join(descriptions.select("category", "description"), "category")), "category", "left")


def dim_building(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col("building").isNotNull()).select("building").distinct()


def dim_assignee(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col("assignee").isNotNull()).select("assignee", "assignee_type").distinct()


def dim_date(tickets: DataFrame) -> DataFrame:
    """Every day from the first creation to the last event."""
    span = tickets.agg(F.min("created_at").cast("date").alias("lo"),
                       F.greatest(F.max("created_at"), F.max("resolved_at")).cast("date").alias("hi"))
    day = F.explode(F.sequence("lo", "hi", F.expr("interval 1 day")))
    return span.select(day.alias("date_key")).select("date_key", *clean.date_facts(F.col("date_key")))


# ------------------------------------------------------------------ fact
def fct_tickets(tickets: DataFrame, as_of: Column, run_id: str = "") -> DataFrame:
    measurable = (F.col("resolution_hours").isNotNull() & F.col("sla_hours").isNotNull() & ~F.col("is_duplicate_closure"))
    return tickets.select(
        "ticket_id", F.col("created_at").cast("date").alias("created_date"),
        F.col("resolved_at").cast("date").alias("resolved_date"),
        "category", "building", "assignee", "assignee_type", "priority", "status", "is_open", "inferred_severity",
        "is_safety_hazard", "issue_type", "resolution_hours", "sla_hours", "sla_met", "cost_usd",
        "resolution_outcome", "is_duplicate_closure", measurable.alias("sla_measurable"),
        clean.open_age_hours(F.col("created_at"), as_of, F.col("is_open")).alias("open_age_hours"),
        F.lit(run_id).alias("_run_id"), F.current_timestamp().alias("_built_at"))


# ------------------------------------------------------------------ shared measures
def pct(part: Column, whole: Column, places: int = 1) -> Column:
    """100 * part / whole, rounded half up; NULL for an empty whole."""
    ratio = (part.cast("decimal(20,0)") * F.lit(100)).cast("decimal(22,0)") / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(ratio, places).cast("decimal(12,%d)" % places)


def with_hours(mart: DataFrame, fct: DataFrame, group: dict[str, Column]) -> DataFrame:
    """Median and 90 % quantile of the hours of work that was really done, per group of a mart."""
    worked = fct.filter(~F.col("is_duplicate_closure") & F.col("resolution_hours").isNotNull())
    hours = worked.groupBy(*[c.alias(name) for name, c in group.items()], "resolution_hours").agg(F.count("*").alias("n"))
    wanted = {"median_resolution_hours": 0.5, "p90_resolution_hours": 0.9}
    found = ranks.quantiles(hours, list(group), "resolution_hours", "n", wanted)
    rounded = {name: F.round(F.col(name).cast("decimal(18,6)"), 1).cast("decimal(12,1)") for name in wanted}
    return ranks.with_quantiles(mart, found.withColumns(rounded), list(group))


def _resolved() -> Column:
    return F.count_if(F.col("resolved_date").isNotNull() & ~F.col("is_duplicate_closure"))


def _sla_met() -> Column:
    return F.count_if(F.col("sla_measurable") & F.col("sla_met"))


# ------------------------------------------------------------------ marts
def mart_sla_performance(fct: DataFrame) -> DataFrame:
    measurable = F.count_if(F.col("sla_measurable"))
    fct = fct.filter(F.col("created_date").isNotNull())
    group = {"month": F.trunc("created_date", "MM"), "category": F.col("category"), "priority": F.coalesce("priority", F.lit("unspecified"))}
    mart = fct.groupBy(*[c.alias(name) for name, c in group.items()]).agg(
        F.count("*").alias("tickets_created"), _resolved().alias("tickets_resolved"),
        measurable.alias("sla_measurable"), _sla_met().alias("sla_met"),
        pct(_sla_met(), measurable).alias("sla_compliance_pct"), pct(measurable, F.count("*")).alias("metric_coverage_pct"))
    return with_hours(mart, fct, group).select(
        *group, "tickets_created", "tickets_resolved", "sla_measurable", "sla_met", "sla_compliance_pct",
        "median_resolution_hours", "p90_resolution_hours", "metric_coverage_pct")


def mart_vendor_scorecard(fct: DataFrame) -> DataFrame:
    measurable, n = F.count_if(F.col("sla_measurable")), F.count("*")
    fct = fct.filter(F.col("assignee").isNotNull())
    group = {"assignee": F.col("assignee"), "assignee_type": F.col("assignee_type")}
    mart = fct.groupBy(*group).agg(
        n.alias("tickets_assigned"), F.count_if(F.col("is_open")).alias("open_now"), _resolved().alias("resolved"),
        pct(_sla_met(), measurable).alias("sla_compliance_pct"), measurable.alias("sla_measurable"),
        F.sum("cost_usd").alias("total_cost_usd"),
        F.round(F.sum("cost_usd") / F.nullif(F.count("cost_usd"), F.lit(0)), 2).cast("decimal(14,2)").alias("avg_cost_usd"),
        F.count("cost_usd").alias("tickets_with_cost"),
        pct(F.count_if(F.col("resolution_outcome") == "temporary_fix"), n).alias("temporary_fix_pct"),
        pct(F.count_if(F.col("resolution_outcome") == "not_reproduced"), n).alias("not_reproduced_pct"),
        F.count_if(F.col("is_safety_hazard")).alias("safety_tickets"))
    return with_hours(mart, fct, group).select(
        *group, "tickets_assigned", "open_now", "resolved", "median_resolution_hours", "p90_resolution_hours", "sla_compliance_pct",
        "sla_measurable", "total_cost_usd", "avg_cost_usd", "tickets_with_cost", "temporary_fix_pct", "not_reproduced_pct", "safety_tickets")


def mart_open_backlog(fct: DataFrame, as_of: Column) -> DataFrame:
    age = F.col("open_age_hours")
    return (fct.filter(F.col("is_open") & ~F.col("is_duplicate_closure"))
            .groupBy(F.coalesce("building", F.lit("unknown")).alias("building"), "category",
                     F.coalesce("priority", F.lit("unspecified")).alias("priority"))
            .agg(F.count("*").alias("open_tickets"),
                 F.count_if(F.col("is_safety_hazard")).alias("open_safety_hazards"),
                 F.count_if(F.col("inferred_severity") == "critical").alias("open_inferred_critical"),
                 F.count_if(age <= 168).alias("age_0_7d"),
                 F.count_if((age > 168) & (age <= 720)).alias("age_8_30d"),
                 F.count_if((age > 720) & (age <= 2160)).alias("age_31_90d"),
                 F.count_if(age > 2160).alias("age_over_90d"),
                 F.count_if(F.col("sla_hours").isNotNull() & (age > F.col("sla_hours"))).alias("past_sla"),
                 F.round(F.max(age) / 24, 1).cast("decimal(12,1)").alias("oldest_open_days"))
            .withColumn("as_of_date", as_of))


def underprioritised_hazards(tickets: DataFrame, as_of: Column) -> DataFrame:
    """Open hazards that were filed as low, medium or without priority.

    Fact and ticket share the row, so the description is kept along instead of joined back by id.
    Readers that want the most severe first sort by severity, then age.
    """
    age = clean.open_age_hours(F.col("created_at"), as_of, F.col("is_open"))
    urgent = (F.col("is_open") & F.col("is_safety_hazard") & ~F.col("is_duplicate_closure")
              & F.col("inferred_severity").isin("critical", "high")
              & F.coalesce("priority", F.lit("low")).isin("low", "medium"))
    return tickets.filter(urgent).select(
        "ticket_id", "building", "category", "issue_type", "priority", "inferred_severity",
        F.round(age / 24, 1).cast("decimal(12,1)").alias("open_days"), "description")


def hazards_in_order(hazards: DataFrame) -> DataFrame:
    """Hazards with their place, the most severe first, then the oldest: a page is a range of `rank`."""
    return ranks.numbered(hazards, F.col("inferred_severity"), F.col("open_days").desc_nulls_last(), F.col("ticket_id"))


def kg_edges(tickets: DataFrame) -> DataFrame:
    """Edges (subject, predicate, object): five facts per ticket from one scan, two distinct relations,
    and the ontology."""
    spark = tickets.sparkSession
    t = tickets.filter(~F.col("is_duplicate_closure"))

    def edge(st, s, p, ot, o) -> Column:
        return F.struct(F.lit(st).alias("subject_type"), s.alias("subject"), F.lit(p).alias("predicate"),
                        F.lit(ot).alias("object_type"), o.alias("object"))

    tid = F.col("ticket_id")
    facts = F.array(
        edge("ticket", tid, "in_category", "category", F.col("category")),
        edge("ticket", tid, "located_in", "building", F.col("building")),
        edge("ticket", tid, "concerns_asset", "asset", F.col("asset_id")),
        edge("ticket", tid, "assigned_to", "party", F.col("assignee")),
        edge("ticket", tid, "has_issue", "issue_type", F.col("issue_type")))
    per_ticket = t.select(F.explode(F.filter(facts, lambda e: e["object"].isNotNull())).alias("e")).select("e.*")
    relations = F.array(
        F.when(F.col("building").isNotNull(), edge("asset", F.col("asset_id"), "located_in", "building", F.col("building"))),
        F.when(F.col("issue_type") != "unspecified", edge("issue_type", F.col("issue_type"), "broader", "category", F.col("category"))))
    between = (t.select(F.explode(F.filter(relations, lambda e: e["subject"].isNotNull())).alias("e")).select("e.*").distinct())
    ontology = spark.createDataFrame(
        [("party", p, "qualified_for", "category", c) for p, cats in fv.QUALIFIED_FOR.items() for c in cats]
        + [("category", min(pair), "related_to", "category", max(pair)) for pair in fv.RELATED], per_ticket.schema)
    return per_ticket.unionAll(between).unionAll(ontology)


def build(tickets: DataFrame, run_id: str = "", as_of: Column | None = None) -> dict[str, DataFrame]:
    """All gold tables by name. The marts read the fact."""
    as_of = as_of_date(tickets) if as_of is None else as_of
    fct = fct_tickets(tickets, as_of, run_id)
    return {
        "dim_category": dim_category(tickets.sparkSession),
        "dim_building": dim_building(tickets),
        "dim_assignee": dim_assignee(tickets),
        "dim_date": dim_date(tickets),
        "fct_tickets": fct,
        "mart_sla_performance": mart_sla_performance(fct).withColumn("_run_id", F.lit(run_id)),
        "mart_vendor_scorecard": mart_vendor_scorecard(fct).withColumn("_run_id", F.lit(run_id)),
        "mart_open_backlog": mart_open_backlog(fct, as_of).withColumn("_run_id", F.lit(run_id)),
        "v_underprioritised_hazards": underprioritised_hazards(tickets, as_of),
        "kg_edges": kg_edges(tickets),
    }


def count_check(counts: dict[str, int], silver_rows: int) -> list[str]:
    """Alert when the fact lost or gained rows against silver."""
    n = counts.get("fct_tickets")
    return [] if n == silver_rows else [f"gold holds {n} tickets, silver {silver_rows}"]
