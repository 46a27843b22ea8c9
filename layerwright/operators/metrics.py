"""Run and stage metrics, alerts, usage and latency."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerwright import fixed_values as fv


def null_rates(tickets: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, null_rate (4 places) from one aggregate."""
    columns = columns or fv.NULL_RATE_COLUMNS
    row = tickets.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.round(F.coalesce(F.col(c), F.lit(0.0)), 4).alias("null_rate")) for c in columns])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def watched(df: DataFrame, name: str, columns: list[str] | None = None, **counted: Column) -> tuple[DataFrame, Observation]:
    """`df`, and what `seen` has to say of it once the returned frame was written: no scan of its own.

    Write the frame as it is returned, without another shuffle, so that every task reports once.
    """
    seen = Observation(name)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in columns or []]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls, *[F.count_if(c).alias(n) for n, c in counted.items()]), seen


def watched_rates(numbers: dict[str, int]) -> dict[str, float]:
    """Null rate (4 places, as in `null_rates`) of every watched column; 0 of an empty table."""
    rate = lambda n: Decimal(repr(n / max(1, numbers["rows"])))
    return {c.removeprefix("null "): float(rate(n).quantize(Decimal("0.0001"), ROUND_HALF_UP))
            for c, n in numbers.items() if c.startswith("null ")}


def outcome_counts(tickets: DataFrame, quarantine: DataFrame, duplicates: DataFrame) -> DataFrame:
    """metric, key, n: flags, category sources, quarantine reasons, duplicate rules."""
    cells = F.concat(F.transform("dq_flags", lambda f: F.struct(F.lit("dq_flag").alias("metric"), f.alias("key"))),
                     F.array(F.struct(F.lit("category_source").alias("metric"), F.col("category_source").alias("key"))))
    parts = (tickets.select(F.explode(cells).alias("c")).select("c.*")
             .unionByName(quarantine.select(F.lit("quarantine_reason").alias("metric"), F.explode("reasons").alias("key")))
             .unionByName(duplicates.select(F.lit("duplicate_rule").alias("metric"), F.col("match_rule").alias("key"))))
    return parts.groupBy("metric", "key").agg(F.count("*").alias("n"))


def null_rate_alerts(now: DataFrame, before: DataFrame, limit: float = fv.ALERT_NULL_RATE_DELTA) -> DataFrame:
    """Columns whose null rate moved by more than the limit since the previous good run."""
    rows = now.join(before.withColumnRenamed("null_rate", "before"), "column")
    moved = rows.filter(F.abs(F.col("null_rate") - F.col("before")) > limit)
    text = F.format_string("%s: empty in %.2f%% of the rows, before in %.2f%%", "column", 100 * F.col("null_rate"), 100 * F.col("before"))
    return moved.select("column", "before", "null_rate", text.alias("alert"))


def stage_alerts(quarantined: int, bronze_rows: int, pending: int, unresolved: int) -> list[str]:
    alerts = []
    rate = quarantined / max(1, bronze_rows)
    if rate > fv.ALERT_QUARANTINE_RATE:
        alerts.append(f"{rate:.2%} of the rows are quarantined, more than {fv.ALERT_QUARANTINE_RATE:.2%}")
    if pending:
        alerts.append(f"{unresolved} tickets without category, {pending} proposals to be decided")
    return alerts


def stage_status(blocking: bool, alerts: list[str]) -> str:
    return "blocked" if blocking else "warning" if alerts else "succeeded"


def previous_success(stage_runs: DataFrame, runs: DataFrame, stage: str, current_run: str) -> DataFrame:
    """Metrics of the newest earlier good run of a stage."""
    good = stage_runs.filter((F.col("stage") == stage) & F.col("status").isin("succeeded", "warning") & (F.col("run_id") != current_run))
    return (good.join(runs.select("run_id").distinct(), "run_id", "left_semi").orderBy(F.desc("finished_at"), F.desc("run_id")).limit(1)
            .select("stage", "run_id", "metrics"))


# ------------------------------------------------------------------ usage
def with_cost(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """cost_usd per call: free providers cost 0, the full model name wins over the part after the last
    slash, an unknown model has no cost. The price list is configuration of a few rows."""
    tail = F.element_at(F.split("model", "/"), -1)
    full = prices.select(F.col("model").alias("_m1"), F.col("price_in").alias("_i1"), F.col("price_out").alias("_o1"))
    part = prices.select(F.col("model").alias("_m2"), F.col("price_in").alias("_i2"), F.col("price_out").alias("_o2"))
    rows = (calls.join(F.broadcast(full), F.col("model") == F.col("_m1"), "left")
            .join(F.broadcast(part), tail == F.col("_m2"), "left"))
    price_in, price_out = F.coalesce("_i1", "_i2"), F.coalesce("_o1", "_o2")
    cost = (F.col("input_tokens") * price_in + F.col("output_tokens") * price_out) / 1e6
    return rows.withColumn("cost_usd", F.when(F.col("provider").isin(fv.FREE_PROVIDERS), F.lit(0.0)).otherwise(cost)).drop(
        "_m1", "_i1", "_o1", "_m2", "_i2", "_o2")


def usage_rollup(calls: DataFrame, failure_limit: float = fv.ALERT_FAILURE_RATE) -> DataFrame:
    """Per run: calls, cache hits, failures, tokens, cost, and whether the failure rate is alarming."""
    made = F.count_if(F.col("status") != "cache_hit")
    failed = F.count_if(F.col("status").isin("error", "invalid_output", "refused"))
    return calls.groupBy("run_id").agg(
        made.alias("calls"), F.count_if(F.col("status") == "cache_hit").alias("cache_hits"), failed.alias("failures"),
        F.coalesce(F.sum(F.col("input_tokens") + F.col("output_tokens")), F.lit(0)).alias("tokens"),
        F.sum("cost_usd").alias("cost_usd"),
        F.coalesce(failed / F.nullif(made, F.lit(0)) > failure_limit, F.lit(False)).alias("failure_alert"))


def latency(calls: DataFrame, group: list[str]) -> DataFrame:
    """Median and the value at position int(0.95 n) of the sorted latencies, both exact.

    Latencies are combined to (value, count) first; the position is found on the running count, so no
    group is collected into one list.
    """
    ok = calls.filter((F.col("status") == "ok") & F.col("latency_ms").isNotNull())
    hist = ok.groupBy(*group, "latency_ms").agg(F.count("*").alias("n"))
    total = hist.groupBy(*group).agg(F.sum("n").alias("ok_calls"), F.percentile("latency_ms", 0.5, F.col("n")).alias("p50"))

    upto = F.sum("n").over(Window.partitionBy(*group).orderBy("latency_ms"))
    position = F.least(F.col("ok_calls") - 1, F.floor(F.col("ok_calls") * 0.95).cast("bigint"))
    # the element at 0-based `position` is the first whose running count exceeds it
    p95 = (hist.withColumn("upto", upto).join(total.select(*group, "ok_calls"), group)
           .filter(F.col("upto") > position).groupBy(*group).agg(F.min("latency_ms").alias("p95")))
    checked = calls.groupBy(*group).agg(F.count_if(F.col("status") == "ok").alias("_ok"),
                                        F.count_if(F.col("status") == "invalid_output").alias("_bad"))
    return (total.join(p95, group).join(checked, group)
            .withColumn("format_compliance", F.round(1 - F.col("_bad") / F.col("_ok"), 4)).drop("_ok", "_bad"))


def answering_models(calls: DataFrame) -> DataFrame:
    return (calls.filter(F.col("status") == "ok").groupBy(F.coalesce("served_model", F.lit("?")).alias("served_model"))
            .agg(F.count("*").alias("n")))


def table_fingerprint(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Order-free fingerprint of a table: rows and the sum of the row hashes."""
    cols: list[Column] = [F.to_json(F.struct(F.col(c))) for c in sorted(df.columns) if c not in ignore]
    return df.agg(F.count("*").alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("fingerprint"))
