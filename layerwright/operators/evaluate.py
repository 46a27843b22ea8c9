"""Scoring against labelled truth, policy replay, queue ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerwright import fixed_values as fv
from layerwright.functions import clean
from layerwright.operators import review, similarity


def with_truth(labelled: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Left join of the answers; a missing answer is a miss. Adds predicted, truth, correct."""
    rows = labelled.join(predictions, key, "left")
    return rows.withColumns({
        "truth": clean.truth_of(F.col("expected"), F.col("predicted")),
        "correct": clean.accepts(F.col("expected"), F.col("predicted")),
        "answer": F.coalesce("predicted", F.lit("missing"))})


def accuracy(rows: DataFrame, task: Column | None = None) -> DataFrame:
    """Per task: items, accuracy, secondary accuracy over the rows that carry a secondary label."""
    secondary = F.count_if(F.col("secondary_ok") & F.col("secondary_labelled"))
    return (rows.groupBy((task if task is not None else F.col("task")).alias("task"))
            .agg(F.count("*").alias("items"), F.round(F.avg(F.col("correct").cast("double")), 4).alias("accuracy"),
                 F.round(secondary / F.nullif(F.count_if("secondary_labelled"), F.lit(0)), 4).alias("secondary_accuracy")))


def errors(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("correct") | (F.col("secondary_labelled") & ~F.col("secondary_ok")))


def category_report(rows: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per truth category. The confusion counts are made first: one
    row per (truth, answer), however many items there are."""
    confusion = rows.groupBy("truth", "answer").agg(F.count("*").alias("n"))
    hit = F.col("truth") == F.col("answer")
    by_truth = confusion.groupBy(F.col("truth").alias("category")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"), F.sum("n").alias("support"))
    by_answer = confusion.groupBy(F.col("answer").alias("category")).agg(F.sum("n").alias("answered"))
    r = by_truth.join(by_answer, "category", "left")
    precision = F.coalesce(F.col("tp") / F.nullif(F.col("answered"), F.lit(0)), F.lit(0.0))
    recall = F.col("tp") / F.col("support")
    r = r.withColumn("p", precision).withColumn("r", recall)
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    return r.select("category", F.round("p", 3).alias("precision"), F.round("r", 3).alias("recall"),
                    F.round(f1, 3).alias("f1"), "support")


def macro_f1(report: DataFrame) -> DataFrame:
    return report.agg(F.round(F.avg("f1"), 4).alias("macro_f1"), F.count("*").alias("categories"))


def promotion_gate(scores: DataFrame, minimum: float = 0.9) -> DataFrame:
    """Pass when every task reaches the minimum."""
    return scores.agg(F.min("accuracy").alias("lowest"), (F.min("accuracy") >= minimum).alias("passed"))


# ------------------------------------------------------------------ policies
POLICIES = {"agent": "agent_conf", "judge": "judge_p", "trust": "trust", "trust_no_human": "trust_no_human"}


def policy_results(scored: DataFrame, threshold: float = fv.AUTO_APPROVE) -> DataFrame:
    """Each policy replayed at one threshold: approved, coverage, precision, wrong, left to people."""
    stack = F.array(*[F.struct(F.lit(p).alias("policy"), F.coalesce(F.col(c), F.lit(0.0)).alias("score"))
                      for p, c in POLICIES.items()])
    rows = scored.select("correct", F.explode(stack).alias("s")).select("correct", "s.*")
    ok = F.col("score") >= threshold
    n, wrong, total = F.count_if(ok), F.count_if(ok & ~F.col("correct")), F.count("*")
    return rows.groupBy("policy").agg(
        n.alias("auto_approved"), F.round(n / total, 4).alias("coverage"),
        F.round(1 - wrong / F.nullif(n, F.lit(0)), 4).alias("precision"), wrong.alias("wrong_auto_approved"),
        (total - n).alias("sent_to_review"))


def queue_ranking(scored: DataFrame, item: str, depths: list[int] | None = None) -> DataFrame:
    """precision@k and recall@k when the queue is worked from the lowest score.

    Only the first max(k) items per ordering are ranked; each map task passes on no more than those.
    """
    depths = depths or fv.REVIEW_DEPTHS
    keys = {"agent": "agent_conf", "judge": "judge_p", "trust": "trust"}
    stack = F.array(*[F.struct(F.lit(o).alias("ordering"), F.coalesce(F.col(c), F.lit(0.0)).alias("score")) for o, c in keys.items()])
    rows = scored.select(F.col(item).alias("item"), "correct", F.explode(stack).alias("s")).select("item", "correct", "s.*")
    rank = F.row_number().over(Window.partitionBy("ordering").orderBy("score", "item"))
    head = rows.withColumn("rank", rank).filter(F.col("rank") <= max(depths))
    wrong_total = scored.agg(F.count_if(~F.col("correct"))).scalar()
    at = head.select("ordering", "rank", "correct", F.explode(F.array(*[F.lit(k) for k in depths])).alias("k"))
    hits = F.count_if((F.col("rank") <= F.col("k")) & ~F.col("correct"))
    return at.groupBy("ordering", "k").agg(
        F.round(hits / F.col("k"), 3).alias("precision"),
        F.round(hits / F.nullif(wrong_total, F.lit(0)), 3).alias("recall"))


def replay(decisions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Recorded decisions with the scores of all policies, ready for `policy_results` and `queue_ranking`.

    decisions: kind, subject, confidence, original and final MAP, correct, one row per (kind, subject). verdicts: kind, subject,
    p_correct, agrees; where there is none the judge stays silent. The human signal of a decision comes from all
    others of its kind with similar text, its own left out, in one pass over counted votes.
    """
    asked = decisions.select("kind", F.col("subject").alias("text"), F.col("original").alias("answer"))
    given = decisions.select("kind", F.col("subject").alias("text"), F.col("final").alias("answer"))
    signal = similarity.human_signal(asked, given).select("kind", F.col("text").alias("subject"), "human_signal", "votes")
    rows = decisions.join(verdicts, ["kind", "subject"], "left").join(signal, ["kind", "subject"], "left").withColumn(
        "judge_p", review.judge_probability(F.col("p_correct"), F.col("agrees")))
    agent, nobody = F.col("confidence"), F.lit(None).cast("double")
    return rows.select("kind", "subject", F.concat_ws(":", "kind", "subject").alias("item"), "correct", agent.alias("agent_conf"), "judge_p", "human_signal",
                       "votes", review.trust_score(agent, F.col("judge_p"), F.col("human_signal")).alias("trust"),
                       review.trust_score(agent, F.col("judge_p"), nobody).alias("trust_no_human"))


def ranking_with_base(scored: DataFrame, item: str = "item", depths: list[int] | None = None) -> DataFrame:
    """`queue_ranking` beside what a random order would give: items, wrong ones and their share."""
    items, wrong = scored.agg(F.count("*")).scalar(), scored.agg(F.count_if(~F.col("correct"))).scalar()
    return queue_ranking(scored, item, depths).withColumns({
        "items": items, "wrong": wrong, "random_precision": F.round(wrong / F.nullif(items, F.lit(0)), 3)})


# ------------------------------------------------------------------ result against truth
def truth_score(truth: DataFrame, tickets: DataFrame, quarantine: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row: what the run did against what it should have done.

    truth: ticket_id, outcome (ticket | quarantine | duplicate), category, created_at, cost_usd, survivor,
    drift. All joins are on the ticket id, after one row per id was made.
    """
    got = tickets.select("ticket_id", F.col("category").alias("g_category"), F.col("created_at").alias("g_created"),
                         F.col("cost_usd").alias("g_cost"), F.lit(True).alias("kept"))
    dups = duplicates.groupBy(F.col("duplicate_ticket_id").alias("ticket_id")).agg(F.max("survivor_ticket_id").alias("g_survivor"))
    rows = truth.join(got, "ticket_id", "full").join(dups, "ticket_id", "full")
    real, dup = F.col("outcome") == "ticket", F.col("outcome") == "duplicate"
    kept = real & F.coalesce("kept", F.lit(False))
    caught = dup & F.coalesce(F.col("g_survivor") == F.col("survivor"), F.lit(False))
    false_merge = F.col("g_survivor").isNotNull() & ~F.coalesce(dup, F.lit(False))
    cost_ok = (F.col("g_cost").isNull() & F.col("cost_usd").isNull()) | F.coalesce(
        F.abs(F.col("g_cost") - F.col("cost_usd")) < 0.01, F.lit(False))

    def pct(a: Column, b: Column) -> Column:
        return F.round(100 * F.count_if(a) / F.nullif(F.count_if(b), F.lit(0)), 2)

    drift = kept & F.coalesce("drift", F.lit(False))
    return rows.agg(
        F.count_if(kept).alias("kept"), F.count_if(real).alias("real"),
        F.count_if(F.col("outcome") == "quarantine").alias("junk_expected"),
        F.count_if(dup).alias("duplicates_expected"), F.count_if(caught).alias("duplicates_caught"),
        F.count_if(false_merge).alias("false_merges"), pct(caught, dup).alias("duplicate_recall_pct"),
        F.round(100 * F.count_if(caught) / F.nullif(F.count_if(caught) + F.count_if(false_merge), F.lit(0)), 2).alias("duplicate_precision_pct"),
        pct(kept & (F.col("g_created") == F.col("created_at")), kept).alias("created_at_exact_pct"),
        pct(kept & cost_ok, kept).alias("cost_exact_pct"),
        pct(kept & (F.col("g_category") == F.col("category")), kept).alias("category_pct"),
        pct(drift & (F.col("g_category") == F.col("category")), drift).alias("category_on_drift_pct"),
        F.count_if(drift).alias("drift_rows"),
    ).withColumn("junk_quarantined", quarantine.agg(F.count("*")).scalar())
