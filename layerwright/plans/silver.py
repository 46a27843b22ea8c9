"""Silver: landed rows become typed tickets, quarantined rows or audited duplicates - exactly one each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright import session
from layerwright.functions import clean
from layerwright.operators import dedup, enrich, people, skew

SOURCE_COLUMNS = ["ticket_id", "created_at", "resolved_at", "category", "priority", "status", "building",
                  "description", "submitted_by", "assigned_to", "resolution_notes", "cost", "sla_hours"]
TICKET_COLUMNS = [
    "ticket_id", "ticket_number", "created_at", "resolved_at", "resolution_hours", "status", "is_open",
    "priority", "category", "category_source", "category_confidence", "category_from_description", "issue_type",
    "inferred_severity", "is_safety_hazard", "building", "floor", "room", "asset_id", "description",
    "description_template", "submitted_by", "assignee", "assignee_type", "resolution_notes",
    "resolution_outcome", "root_cause", "part_replaced", "eta_business_days", "onsite_hours",
    "is_duplicate_closure", "duplicate_of_ticket_id", "cost_usd", "sla_hours", "sla_met", "dq_flags",
]


@dataclass
class Silver:
    tickets: DataFrame
    quarantine: DataFrame
    duplicates: DataFrame


def valid_rows(raw: DataFrame) -> DataFrame:
    return raw.filter(clean.usable_id(F.col("ticket_id"))
                      & ~clean.junk_text(F.col("category"), F.col("description"), F.col("building")))


def quarantine_rows(raw: DataFrame) -> DataFrame:
    """Rows without a usable key or marked as junk, with all reasons that apply."""
    reasons = clean.quarantine_reasons(F.col("ticket_id"), F.col("category"), F.col("description"), F.col("building"))
    return raw.filter(~clean.usable_id(F.col("ticket_id"))
                      | clean.junk_text(F.col("category"), F.col("description"), F.col("building"))
                      ).withColumn("reasons", reasons)


def enriched(valid: DataFrame, raw: DataFrame, labels: DataFrame, templates: DataFrame) -> DataFrame:
    """Swap repair, template and both reference lookups."""
    rows = enrich.detect_swap(valid, labels)
    rows = enrich.with_template(rows, enrich.known_buildings(raw))
    return enrich.with_template_info(rows, templates)


def parse_fields(rows: DataFrame) -> DataFrame:
    """Type every field that needs no lookup. Works in steps: cleaned text, value, then what depends on
    values, each a projection of its own."""
    texts = ["created_at", "resolved_at", "status", "priority", "cost", "sla_hours", "resolution_notes", "assigned_to"]
    rows = clean.with_clean(rows, {f"{c}_text": c for c in texts}).drop(*texts)
    t = {c: F.col(f"{c}_text") for c in texts}
    rows = rows.withColumn("cost_bare", clean.bare_amount(t["cost"])).withColumns({
        "created_at": clean.parse_timestamp(t["created_at"]),
        "resolved_at": clean.parse_timestamp(t["resolved_at"]),
        "status": clean.status_value(t["status"]),
        "priority": clean.priority_value(t["priority"]),
        "cost_usd": clean.cost_value(t["cost"], F.col("cost_bare")),
        "cost_flag": clean.cost_flag(t["cost"], F.col("cost_bare")),
        "sla_hours": clean.sla_value(t["sla_hours"]),
        "sla_flag": clean.sla_flag(t["sla_hours"]),
        "assignee": enrich.assignee_name(t["assigned_to"]),
        "assignee_type": enrich.assignee_type(t["assigned_to"]),
        "resolution_outcome": clean.note_outcome(t["resolution_notes"]),
    })
    # the outcome tells which pattern the note has, so that one alone is asked for its value
    def noted(outcome: str, value: Column) -> Column:
        return F.when(F.col("resolution_outcome") == outcome, value)

    def detail(outcome: str) -> Column:
        return noted(outcome, clean.note_detail(t["resolution_notes"], outcome))

    rows = rows.withColumns({
        "root_cause": detail("resolved_root_cause"),
        "part_replaced": detail("fixed_on_site"),
        "eta_business_days": detail("parts_on_order").try_cast("int"),
        "onsite_hours": detail("completed").try_cast("decimal(6,2)"),
        "duplicate_of_ticket_id": noted("duplicate", clean.duplicate_reference(t["resolution_notes"])),
        "is_open": clean.is_open(F.col("status")),
        "seconds": clean.seconds_between(F.col("created_at"), F.col("resolved_at")),
    })
    rows = rows.withColumn("resolution_hours", clean.hours_2dp(F.col("seconds")))
    return rows.withColumn("sla_met", F.col("resolution_hours") <= F.col("sla_hours"))


def _typed(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns({
        "tid": clean.ticket_id(F.col("ticket_id")),
        "floor": clean.floor_number(F.col("description")),
        "room": clean.room_name(F.col("description")),
        "asset_id": clean.asset_id(F.col("description")),
        "building_name": clean.building(F.col("building")),
    }).drop("category")
    return enrich.resolve_category(parse_fields(rows))


def _flags() -> Column:
    """Flags in their fixed order; later duplicate flags are appended at the end."""
    def when(cond: Column, flag: str) -> Column:
        return F.when(cond, F.lit(flag))

    def text(c: str) -> Column:
        return F.col(f"{c}_text")

    created, resolved = F.col("created_at"), F.col("resolved_at")
    return F.array_compact(F.array(
        when(F.col("swapped"), "category_description_swapped"),
        when(F.col("label").isNull() & (F.col("label_key") != ""), "category_label_unmapped"),
        when((F.length("description") > 0) & F.col("tmpl").isNull(), "description_template_unmapped"),
        when(F.col("category_conflict"), "category_conflicts_with_description"),
        when(created.isNull() & text("created_at").isNotNull(), "created_at_unparseable"),
        when(created.isNull() & text("created_at").isNull(), "created_at_missing"),
        when(resolved.isNull() & text("resolved_at").isNotNull(), "resolved_at_unparseable"),
        when(resolved < created, "resolved_before_created"),
        clean.unrecognised(text("status"), F.col("status"), "status_unrecognised"),
        when(F.col("is_open") & resolved.isNotNull(), "resolved_at_on_open_ticket"),
        when(~F.col("is_open") & resolved.isNull(), "closed_without_resolved_at"),
        clean.unrecognised(text("priority"), F.col("priority"), "priority_unrecognised"),
        when(text("priority").isNull(), "priority_missing"),
        F.col("cost_flag"),
        F.col("sla_flag"),
        F.col("submitter_flag"),
        when(text("assigned_to").isNotNull() & F.col("assignee_type").isNull(), "assignee_unknown"),
        when((F.col("category") != "unknown") & ~enrich.qualified(F.col("assignee"), F.col("category")),
             "assignee_not_qualified_for_category"),
        when(F.col("duplicate_of_ticket_id").isNotNull() & F.col("is_open"), "duplicate_closure_on_open_ticket"),
        F.col("f1"), F.col("f2"),
    ))


def _row_marks(slim: DataFrame, latest: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One narrow row per ticket row that a duplicate rule touches: drop it, or the flags to append."""
    none = F.lit(None).cast("string")
    parts = [
        dedup.superseded(slim, latest).select("bronze_id", F.lit(True).alias("drop"), none.alias("f1"), none.alias("f2")),
        outcomes.select("bronze_id", F.col("survivor_ticket_id").isNotNull().alias("drop"),
                        F.col("dup_flag").alias("f1"), none.alias("f2")),
        dedup.missing_references(dedup.references(slim), slim).select("bronze_id", F.lit(False).alias("drop"), none.alias("f1"),
                                                    F.lit("duplicate_reference_not_found").alias("f2")),
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy("bronze_id").agg(F.max("drop").alias("drop"), F.max("f1").alias("f1"), F.max("f2").alias("f2"))


def _narrow_rows(valid: DataFrame, stage: bool) -> tuple[DataFrame, DataFrame]:
    keep = session.staged if stage else (lambda df, name: df)
    slim = keep(dedup.narrow(valid), "narrow")
    return slim, keep(dedup.latest_per_id(slim), "latest")


def build(raw: DataFrame, labels: DataFrame, templates: DataFrame, run_id: str = "",
          safety_bits: float = fv.DEDUP_SAFETY_BITS, stage: bool = True) -> Silver:
    """The three silver tables of a landed frame (bronze_id, the source columns, row_hash, source_file).

    Duplicate decisions are taken on narrow rows; the wide rows meet only the (few) rows they touch,
    by unique id. With `stage` the narrow rows are written to the work folder: several steps read
    them, and the cleaning behind them runs once.
    """
    valid = valid_rows(raw)
    slim, latest = _narrow_rows(valid, stage)
    # decided once: the marks and the audit table both read them
    outcomes = dedup.content_outcomes(latest, safety_bits)
    outcomes = session.staged(outcomes, "outcomes") if stage else outcomes
    marks = _row_marks(slim, latest, outcomes)

    names = people.people_map(valid).select("raw_name", F.col("submitted_by").alias("submitter"),
                                            "submitter_flag", "uses")
    # a row for each spelling: the look at its size and the join both read it
    names = session.staged(names, "people") if stage else names
    rows = _typed(enriched(valid, raw, labels, templates))
    rows = skew.lookup_join(rows, names, F.col("submitted_by"), "raw_name", "uses", F.col("bronze_id"),
                            skew.fits(names))
    rows = rows.join(marks, "bronze_id", "left").filter(~F.coalesce(F.col("drop"), F.lit(False)))
    tickets = rows.select(
        F.col("tid").alias("ticket_id"),
        clean.ticket_number(F.col("tid")).alias("ticket_number"),
        "created_at", "resolved_at", "resolution_hours", "status", "is_open", "priority", "category",
        "category_source", "category_confidence", "category_from_description",
        F.col("tmpl.issue_type").alias("issue_type"),
        F.col("tmpl.severity").alias("inferred_severity"),
        F.col("tmpl.is_safety_hazard").alias("is_safety_hazard"),
        F.col("building_name").alias("building"),
        "floor", "room", "asset_id", "description",
        F.nullif(F.col("description_template"), F.lit("")).alias("description_template"),
        F.col("submitter").alias("submitted_by"),
        "assignee", "assignee_type",
        F.col("resolution_notes_text").alias("resolution_notes"),
        "resolution_outcome", "root_cause", "part_replaced", "eta_business_days", "onsite_hours",
        F.col("duplicate_of_ticket_id").isNotNull().alias("is_duplicate_closure"),
        "duplicate_of_ticket_id", "cost_usd", "sla_hours", "sla_met",
        _flags().alias("dq_flags"),
        *([F.col("payload").alias("raw")] if "payload" in raw.columns else []),
        F.col("bronze_id").alias("_bronze_id"),
        *[F.col(c).alias(f"_{c}") for c in ("row_hash", "source_file") if c in raw.columns],
        F.lit(run_id).alias("_run_id"),
        F.current_timestamp().alias("_processed_at"),
    )
    keep = ["payload"] if "payload" in raw.columns else []
    quarantine = quarantine_rows(raw).select(
        F.col("bronze_id").alias("_bronze_id"), F.col("ticket_id").alias("ticket_id_raw"), "reasons",
        *[F.col(c).alias("raw") for c in keep], F.lit(run_id).alias("_run_id"))
    audit = dedup.duplicates(slim, latest, outcomes).withColumnRenamed("bronze_id", "_bronze_id").withColumn(
        "_run_id", F.lit(run_id))
    return Silver(tickets, quarantine, audit)


def reconcile(raw: DataFrame, silver: Silver) -> DataFrame:
    """One row: counts per outcome and whether they add up to the landed rows."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(F.lit(tag).alias("part"))

    parts = (tagged(raw, "bronze").unionAll(tagged(silver.tickets, "silver"))
             .unionAll(tagged(silver.quarantine, "quarantine")).unionAll(tagged(silver.duplicates, "duplicates")))
    n = parts.agg(*[F.count_if(F.col("part") == p).alias(f"{p}_rows") for p in ("bronze", "silver", "quarantine", "duplicates")])
    return n.withColumn("reconciled", F.col("bronze_rows") == F.col("silver_rows") + F.col("quarantine_rows") + F.col("duplicates_rows"))
