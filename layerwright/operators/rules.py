"""Rule predicates as a publication gate, and checks before a rule or model query is adopted."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType
from pyspark.sql.window import Window

# In an analysed plan: functions that call into the JVM have no place in a rule or a proposed query.
_CALLS_OUT = re.compile(r"\b(reflect|try_reflect|java_method)\(", re.IGNORECASE)
_SUBQUERY = re.compile(r"\b(scalar-subquery|exists|list|lateral-subquery|outer)#")
_RELATION = re.compile(r"'(UnresolvedRelation|UnresolvedTableValuedFunction|UnresolvedInlineTable)\b ?(?:\[([^\]]*)\])?")
_CTE = re.compile(r"^.*\bCTE \[([^\]]*)\]", re.MULTILINE)
MODEL_NAME = re.compile(r"^mart_[a-z0-9_]{3,60}$")


def rule_table(spark: SparkSession, checks: list[tuple], as_of: str) -> DataFrame:
    """check_id, severity, predicate, threshold; `as_of` is a SQL literal that stands for the clock."""
    rows = [(c, s, p.replace("{as_of}", as_of), float(t)) for c, s, p, t in checks]
    return spark.createDataFrame(rows, "check_id string, severity string, predicate string, threshold double")


def gate_results(tickets: DataFrame, checks: list[tuple], as_of: str, samples: int = 5) -> DataFrame:
    """All rules in one pass: total, violations (TRUE only, NULL does not count), rate, passed, samples.

    The number of rules is the number of expressions in the plan; the data is read once for the counts
    and once for the samples.
    """
    preds = {c: F.expr(f"({p.replace('{as_of}', as_of)})") for c, _, p, _ in checks}
    counted = tickets.agg(F.count("*").alias("total"), *[F.count_if(p).alias(c) for c, p in preds.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("check_id"), F.lit(s).alias("severity"), F.lit(float(t)).alias("threshold"),
                              F.col(c).alias("violations")) for c, s, _, t in checks])
    long = counted.select("total", F.explode(rows).alias("r")).select("total", "r.*")
    rate = F.col("violations") / F.greatest(F.col("total"), F.lit(1))
    out = (long.withColumn("raw_rate", rate).withColumn("violation_rate", F.round("raw_rate", 6))
           .withColumn("passed", F.col("raw_rate") <= F.col("threshold"))
           .withColumn("blocking", ~F.col("passed") & (F.col("severity") == "critical")).drop("raw_rate"))
    return out.join(violation_samples(tickets, preds, samples), "check_id", "left").withColumn(
        "sample", F.coalesce("sample", F.array().cast("array<string>")))


def violation_samples(tickets: DataFrame, preds: dict, k: int = 5) -> DataFrame:
    """First k violating ids per rule. Every map task keeps k rows per rule."""
    hit = F.array_compact(F.array(*[F.when(p, F.lit(c)) for c, p in preds.items()]))
    rank = F.row_number().over(Window.partitionBy("check_id").orderBy("ticket_id"))
    return (tickets.select("ticket_id", F.explode(hit).alias("check_id")).withColumn("r", rank).filter(F.col("r") <= k)
            .groupBy("check_id").agg(F.sort_array(F.collect_list("ticket_id")).alias("sample")))


def gate_open(results: DataFrame) -> bool:
    """TRUE when no critical rule failed. One row per rule reaches the driver at most."""
    return results.filter("blocking").limit(1).count() == 0


def _analysed(df: DataFrame) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def predicate_problem(df: DataFrame, predicate: str) -> str | None:
    """Why a text is not a boolean expression over the columns of `df`, or None. Judged by Spark's own analysis of it."""
    try:
        probe = df.limit(0).select(F.expr(f"({predicate})").alias("hit"))
    except PySparkException as exc:
        return exc.getCondition() or type(exc).__name__
    kind = probe.schema["hit"].dataType
    if not isinstance(kind, BooleanType):
        return f"type {kind.simpleString()}"
    plan = _analysed(probe)
    return "subquery" if _SUBQUERY.search(plan) else "calls out" if _CALLS_OUT.search(plan) else None


def evaluate_predicates(df: DataFrame, predicates: dict[str, str], key: str = "ticket_id", samples: int = 3) -> DataFrame:
    """check_id, problem, total, violations, violation_rate, sample: one row per predicate, all tried in one pass.

    A predicate with a problem is not run; its counts are NULL.
    """
    problems = {name: predicate_problem(df, p) for name, p in predicates.items()}
    sound = {name: F.expr(f"({p})") for name, p in predicates.items() if problems[name] is None}
    counted = df.agg(F.count("*").alias("total"), *[F.count_if(p).alias(f"n{i}") for i, p in enumerate(sound.values())])
    none = F.lit(None).cast("long")
    found = {name: F.col(f"n{i}") for i, name in enumerate(sound)}
    rows = F.array(*[F.struct(F.lit(name).alias("check_id"), F.lit(problem).cast("string").alias("problem"),
                              found.get(name, none).alias("violations")) for name, problem in problems.items()])
    long = counted.select("total", F.explode(rows).alias("r")).select("r.*", F.when(F.col("r.problem").isNull(), F.col("total")).alias("total"))
    rate = F.round(F.col("violations") / F.greatest("total", F.lit(1)), 6)
    first = violation_samples(df.withColumnRenamed(key, "ticket_id"), sound, samples) if sound and key == "ticket_id" else None
    out = long.select("check_id", "problem", "total", "violations", rate.alias("violation_rate"))
    if first is None:
        return out.withColumn("sample", F.array().cast("array<string>"))
    return out.join(first, "check_id", "left").withColumn("sample", F.coalesce("sample", F.array().cast("array<string>")))


def query_problem(spark: SparkSession, query: str, allowed: set[str]) -> str | None:
    """Why a text is not a query over the `allowed` views alone, or None.

    The parsed plan names every relation, those in subqueries too; files, other tables and table functions are none
    of the allowed names.
    """
    wrapped = f"SELECT * FROM ({query})"
    try:
        parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(wrapped).toString()
        plan = _analysed(spark.sql(wrapped))
    except PySparkException as exc:
        return exc.getCondition() or type(exc).__name__
    own = {name.strip() for names in _CTE.findall(parsed) for name in names.split(",")}
    if hidden := sorted(name for name in own - allowed if spark.catalog.tableExists(name)):
        return f"names a part like a table: {', '.join(hidden)}"
    used = set(_RELATION.findall(parsed))
    strange = sorted(name or kind for kind, name in used if kind != "UnresolvedRelation" or name not in allowed | own)
    return f"reads {', '.join(strange)}" if strange else "calls out" if _CALLS_OUT.search(plan) else None


def evaluate_query(spark: SparkSession, query: str, allowed: set[str]) -> DataFrame:
    """problem, columns, rows: one row about a proposed model query. One that has a problem is not run."""
    problem = query_problem(spark, query, allowed)
    if problem:
        return spark.range(1).select(F.lit(problem).alias("problem"), F.lit(None).cast("array<string>").alias("columns"),
                                     F.lit(None).cast("long").alias("rows"))
    found = spark.sql(f"SELECT * FROM ({query})")
    return found.agg(F.count("*").alias("rows")).select(
        F.lit(None).cast("string").alias("problem"), F.array(*[F.lit(c) for c in found.columns]).alias("columns"), "rows")


def evaluate_cleaning(values: DataFrame, expression: str, column: str = "v") -> DataFrame:
    """before / after of a cleaning expression over text values."""
    rows = values.select(F.col(column).alias("v"))
    out = rows.select("v", F.expr(f"({expression})").cast("string").alias("cleaned"))
    plan = _analysed(out)
    if _SUBQUERY.search(plan) or _CALLS_OUT.search(plan):
        raise ValueError("a cleaning rule is an expression over v alone")
    return out


def register_sandbox(spark: SparkSession, name: str, query: str, allowed: set[str]) -> None:
    """Publish an approved model query as a view."""
    if not MODEL_NAME.match(name):
        raise ValueError(f"{name!r}: a model is named mart_ and 3 to 60 letters, digits or underscores")
    problem = query_problem(spark, query, allowed)
    if problem:
        raise ValueError(problem)
    spark.sql(f"SELECT * FROM ({query})").createOrReplaceTempView(name)
