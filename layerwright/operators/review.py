"""Review ledger: proposals, decisions, trust and the queue. The ledger only grows; the current state
is a query over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright.operators import ranks


def trust_score(agent: Column, judge: Column, human: Column, weights: dict[str, float] | None = None) -> Column:
    """Weighted mean of the signals that are present; 0 when there is none."""
    w = weights or fv.TRUST_WEIGHTS
    parts = [(w["human"], human), (w["judge"], judge), (w["agent"], agent)]
    total = sum((F.when(s.isNotNull(), s * F.lit(wt)).otherwise(0.0) for wt, s in parts), F.lit(0.0))
    weight = sum((F.when(s.isNotNull(), F.lit(wt)).otherwise(0.0) for wt, s in parts), F.lit(0.0))
    return F.when(weight > 0, total / weight).otherwise(0.0)


def judge_probability(p_correct: Column, agrees: Column) -> Column:
    """A judge that disagrees cannot vouch for more than one half; NULL without a verdict."""
    return F.when(agrees, p_correct).when(p_correct.isNotNull(), F.least(p_correct, F.lit(0.5)))


def policy(rows: DataFrame, with_judge: bool, threshold: float = fv.AUTO_APPROVE) -> DataFrame:
    """Adds approve and reason. Reads source, confidence, trust, judge_p."""
    value = F.col("trust") if with_judge else F.col("confidence")
    name = "trust" if with_judge else "confidence"
    shown = F.format_string("%.2f", value)
    rules = F.col("source") == "rules"
    silent = F.col("judge_p").isNull() if with_judge else F.lit(False)
    enough = value >= threshold
    reason = (F.when(rules, "from rules, a person decides")
              .when(silent, "no verdict of the judge, a person decides")
              .when(~enough, F.concat(F.lit(f"{name} "), shown, F.lit(f" below {threshold}")))
              .otherwise(F.concat(F.lit(f"{name} "), shown, F.lit(f" reaches {threshold}"))))
    return rows.withColumn("approve", F.coalesce(~rules & ~silent & enough, F.lit(False))).withColumn("reason", reason)


def current(proposals: DataFrame) -> DataFrame:
    """The ledger only grows: of the rows of a proposal the newest one holds, by `seq`, the order of appending."""
    if "seq" not in proposals.columns:
        return proposals
    newest = proposals.groupBy("proposal_id").agg(F.max("seq").alias("seq"))
    return proposals.join(newest, ["proposal_id", "seq"], "left_semi")


def append(proposals: DataFrame, rows: DataFrame) -> DataFrame:
    """The ledger with `rows` after all there is. `seq` 0 stands for what was proposed, 1 for what was decided on it."""
    if "seq" not in proposals.columns:
        proposals = proposals.withColumn("seq", F.lit(0))
    last = F.lit(proposals.agg(F.coalesce(F.max("seq"), F.lit(-1))).first()[0] + 1)
    return proposals.unionByName(rows.withColumn("seq", last), allowMissingColumns=True)


def _one_per_subject(proposals: DataFrame, newest: bool) -> DataFrame:
    """The first or the last proposal of each (kind, subject) by time, then id."""
    least = F.max if newest else F.min
    when = proposals.groupBy("kind", "subject").agg(least("created_at").alias("created_at"))
    ties = proposals.join(when, ["kind", "subject", "created_at"], "left_semi")
    picked = ties.groupBy("kind", "subject").agg(least("proposal_id").alias("proposal_id"))
    return ties.join(picked, ["kind", "subject", "proposal_id"], "left_semi")


def latest_per_subject(proposals: DataFrame, statuses: tuple[str, ...] = ("approved", "auto_approved")) -> DataFrame:
    """Newest decided proposal per (kind, subject). Extremes of plain values are combined on the map side."""
    return _one_per_subject(current(proposals).filter(F.col("status").isin(*statuses)), newest=True)


def first_per_subject(proposals: DataFrame) -> DataFrame:
    """The first answer a model gave per (kind, subject). Overridden proposals count, with their original values."""
    by_model = (F.coalesce("source", F.lit("")) != "human") & F.col("provider").isNotNull() & (F.col("agent") == "classification")
    return _one_per_subject(current(proposals).filter(by_model), newest=False)


def original_per_subject(proposals: DataFrame) -> DataFrame:
    """The earliest proposal per (kind, subject) that nobody overrode, whoever wrote it."""
    return _one_per_subject(current(proposals).filter(~F.coalesce("overridden", F.lit(False))), newest=False)


def pending(proposals: DataFrame, kind: str | None = None) -> DataFrame:
    rows = current(proposals).filter(F.col("status") == "proposed")
    if kind is not None:
        rows = rows.filter(F.col("kind") == kind)
    return rows.select("kind", "subject").distinct()


def queue(proposals: DataFrame) -> DataFrame:
    """Least trusted first; without trust last; then oldest."""
    return current(proposals).filter(F.col("status") == "proposed").orderBy(F.asc_nulls_last("trust"), "created_at", "proposal_id")


def queue_places(proposals: DataFrame) -> DataFrame:
    """The queue with the place of each proposal, for pages of it."""
    rows = current(proposals).filter(F.col("status") == "proposed")
    return ranks.numbered(rows, F.asc_nulls_last("trust"), F.col("created_at"), F.col("proposal_id"))


_DECIDED = ("proposal", "status", "source", "overridden", "agent_original", "reviewed_by", "seq")


def decide(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decided copies of pending proposals, ready for `append`.

    decisions: proposal_id, approve, reviewer, overrides MAP<STRING,STRING> (NULL for none). Only
    proposals still in review are decided; an override keeps the agent's original values.
    """
    rows = current(proposals).filter(F.col("status") == "proposed").join(decisions, "proposal_id")
    changed = F.col("approve") & F.col("overrides").isNotNull() & (F.size("overrides") > 0)
    original = F.map_filter("proposal", lambda k, v: F.map_contains_key(F.col("overrides"), k))
    kept = F.map_filter("proposal", lambda k, v: ~F.map_contains_key(F.col("overrides"), k))
    return rows.select(
        *[c for c in proposals.columns if c not in _DECIDED],
        F.when(changed, F.map_concat(kept, "overrides")).otherwise(F.col("proposal")).alias("proposal"),
        F.when(F.col("approve"), "approved").otherwise("rejected").alias("status"),
        F.when(changed, F.concat("source", F.lit("+human"))).otherwise(F.col("source")).alias("source"),
        changed.alias("overridden"), F.when(changed, original).alias("agent_original"),
        F.col("reviewer").alias("reviewed_by"))


def correct(proposals: DataFrame, corrections: DataFrame, mappings: DataFrame | None = None) -> DataFrame:
    """Corrections of what holds now, as approved rows of their own, ready for `append`.

    corrections: kind, subject, proposal_id (new), values MAP, reviewer, created_at. The base is the newest approved
    proposal of the subject or else its mapping (kind, subject, proposal MAP), seeded ones included. A correction
    without either comes back with status `rejected` and no proposal, so that it can be reported.
    """
    base = latest_per_subject(proposals).select("kind", "subject", F.col("proposal").alias("decided"))
    rows = corrections.join(base, ["kind", "subject"], "left")
    known = F.col("decided")
    if mappings is not None:
        rows = rows.join(mappings.select("kind", "subject", F.col("proposal").alias("mapped")), ["kind", "subject"], "left")
        known = F.coalesce("decided", "mapped")
    rows = rows.withColumn("base", known)
    kept = F.map_filter("base", lambda k, v: ~F.map_contains_key(F.col("values"), k))
    original = F.map_filter("base", lambda k, v: F.map_contains_key(F.col("values"), k))
    found = F.col("base").isNotNull()
    return rows.select("proposal_id", "kind", "subject", "created_at", F.map_concat(kept, "values").alias("proposal"),
                       F.when(found, "approved").otherwise("rejected").alias("status"), F.lit("human").alias("source"),
                       F.lit(1.0).alias("confidence"), found.alias("overridden"), original.alias("agent_original"),
                       F.col("reviewer").alias("reviewed_by"))


def human_precedents(labels: DataFrame, templates: DataFrame) -> DataFrame:
    """kind, text, answer of every mapping a person approved."""
    human = F.col("approved_by") != "policy:auto"
    a = labels.filter(human).select(F.lit("category_label").alias("kind"), F.col("label").alias("text"),
                                    F.lower(F.concat_ws("|", "category", "label_kind")).alias("answer"))
    b = templates.filter(human).select(F.lit("description_template").alias("kind"), F.col("template").alias("text"),
                                       F.lower(F.concat_ws("|", "category", F.col("is_safety_hazard").cast("string"))).alias("answer"))
    return a.unionByName(b)


def recorded_decisions(proposals: DataFrame, final: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """The agent's first answer against what holds now, per (kind, subject): kind, subject, confidence, original, final, correct.

    final: kind, subject, proposal MAP. `fields` names for each kind what is compared, whatever the case of letters.
    A value that a person changed counts as the agent gave it.
    """
    first = first_per_subject(proposals)
    given = F.map_zip_with("proposal", F.coalesce("agent_original", F.create_map().cast("map<string,string>")),
                           lambda k, now, then: F.coalesce(then, now))
    wanted = reduce(lambda rest, kv: F.when(F.col("kind") == kv[0], F.array(*[F.lit(f) for f in kv[1]])).otherwise(rest),
                    fields.items(), F.array().cast("array<string>"))
    rows = first.withColumn("original", given).join(final.withColumnRenamed("proposal", "now"), ["kind", "subject"])
    rows = rows.withColumn("wanted", wanted)

    def part(values: str) -> Column:
        return F.map_filter(values, lambda k, v: F.array_contains("wanted", k))

    same = F.forall("wanted", lambda f: F.lower(F.try_element_at("original", f)).eqNullSafe(F.lower(F.try_element_at("now", f))))
    return rows.select("kind", "subject", "confidence", part("original").alias("original"), part("now").alias("final"), same.alias("correct"))


def episodes(proposals: DataFrame) -> DataFrame:
    """What people changed: the agent's values against the human's, per overridden approval."""
    return current(proposals).filter(F.col("overridden") & F.col("status").isin("approved", "auto_approved")).select(
        "kind", F.col("subject").alias("text"), F.col("agent_original").alias("agent_answer"),
        F.map_filter("proposal", lambda k, v: F.map_contains_key(F.col("agent_original"), k)).alias("human_answer"))


def proposal_from_guess(guesses: DataFrame, kind: str, subject: str, fields: list[str]) -> DataFrame:
    """Rule-based guesses as pending proposals; they never pass the policy by themselves."""
    body = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    return guesses.select(
        F.sha2(F.concat_ws("\u001f", F.lit(kind), F.col(subject)), 256).alias("proposal_id"), F.lit(kind).alias("kind"),
        F.col(subject).alias("subject"), body.alias("proposal"), F.lit("proposed").alias("status"),
        F.col("source"), F.col("confidence"), F.lit(False).alias("overridden"))


