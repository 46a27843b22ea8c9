"""Reference data: reading maps and labelled sets, upsert, seeding, export."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright import fixed_values as fv

_LABELS = "label string, label_kind string, category string, confidence double, source string"
_TEMPLATES = ("template string, category string, issue_type string, severity string, is_safety_hazard boolean, "
              "confidence double, source string")

_RULES = "check_id string, severity string, predicate string, threshold double"
MOST_RULES = 10_000


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=_LABELS, escape='"', multiLine=True)


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """Template map; the order of the file decides between equal prefix matches."""
    rows = spark.read.csv(path, header=True, schema=_TEMPLATES, escape='"', multiLine=True)
    return rows.withColumn("map_order", F.monotonically_increasing_id())


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Labelled evaluation set; `a|b` in an expected column means either answer."""
    return spark.read.csv(path, header=True, escape='"', multiLine=True)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule list: check_id, severity, predicate, threshold. A rule whose threshold is no number has none and is refused by `rule_list`."""
    return spark.read.csv(path, header=True, schema=_RULES, escape='"', multiLine=True)


def rule_list(rules: DataFrame) -> list[tuple[str, str, str, float]]:
    """Rules as the gate takes them, by id. Rules are written by people; more than `MOST_RULES`, one id twice or an empty field are errors."""
    rows = [tuple(r) for r in rules.select("check_id", "severity", "predicate", "threshold").limit(MOST_RULES + 1).collect()]
    wrong = sorted({str(r[0]) for r in rows if None in r})
    twice = sorted(n for n, k in Counter(r[0] for r in rows).items() if k > 1 and n is not None)
    if wrong or twice or len(rows) > MOST_RULES:
        raise ValueError(f"rules with empty fields {wrong}, listed twice {twice}, {len(rows)} rules read, {MOST_RULES} allowed")
    return sorted(rows)


def rule_frame(spark: SparkSession, checks: list[tuple]) -> DataFrame:
    """A rule list as a table, to be exported."""
    return spark.createDataFrame([(c, s, p, float(t)) for c, s, p, t in checks], _RULES)


def read_episodes(spark: SparkSession, path: str) -> DataFrame:
    """Precedents as JSON lines: what was asked, what the agent said and what a person said."""
    return spark.read.schema("task string, text string, agent_answer map<string,string>, human_answer map<string,string>").json(path)


def taxonomy(spark: SparkSession) -> dict[str, DataFrame]:
    """The fixed taxonomy and ontology as small tables."""
    return {
        "categories": spark.createDataFrame([(c,) for c in fv.CATEGORIES], "category string"),
        "keywords": spark.createDataFrame([(c, w) for c, ws in fv.KEYWORDS.items() for w in ws], "category string, keyword string"),
        "assignees": spark.createDataFrame([(k, n, t) for k, (n, t) in fv.ASSIGNEES.items()], "raw string, name string, type string"),
        "related": spark.createDataFrame([tuple(sorted(p)) for p in fv.RELATED], "category_a string, category_b string"),
        "qualified": spark.createDataFrame([(p, c) for p, cs in fv.QUALIFIED_FOR.items() for c in sorted(cs)], "party string, category string"),
    }


def upsert(current: DataFrame, new: DataFrame, keys: list[str], newest: str = "approved_at") -> DataFrame:
    """Later approval wins. A maximum per key, so the map side keeps one row per key and task."""
    both = current.unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(F.col(newest), F.xxhash64(*rest))).alias("r")
    return both.groupBy(*keys).agg(picked).select(*keys, "r.*")


def seed(current: DataFrame, seeds: DataFrame, keys: list[str]) -> DataFrame:
    """Seeds never overwrite an approved row."""
    return current.unionByName(seeds.join(current.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def export_csv(df: DataFrame, key: str, path: str) -> None:
    """A reviewed map as one sorted file. Maps are reviewed by people and small."""
    df.orderBy(key).coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')


def export_json(df: DataFrame, key: str, path: str) -> None:
    """JSON lines in order of the key, over as many files as the rows need: episodes and decisions grow with use."""
    df.orderBy(key).write.mode("overwrite").json(path)
