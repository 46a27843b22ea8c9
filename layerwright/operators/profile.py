"""Column profiling. One scan turns a table into (column, value, count); every statistic derives from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType, StructType
from pyspark.sql.window import Window

from layerwright import fixed_values as fv
from layerwright.functions import clean
from layerwright.operators import ranks


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, v, n. Equal values are combined on the map side, so a value that fills a third of the
    table costs no more than any other."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    return df.select(F.explode(cells).alias("c")).groupBy("c.column", "c.v").agg(F.count("*").alias("n"))


def column_profile(counts: DataFrame) -> DataFrame:
    """One row per column: totals, emptiness, placeholders, distinct values, lengths, numeric look."""
    v, n, norm = F.col("v"), F.col("n"), F.lower(F.trim("v"))

    def rows_with(cond: Column) -> Column:
        return F.sum(F.when(cond, n).otherwise(0))

    blank = v.isNull() | (F.trim(v) == "")
    base = counts.groupBy("column").agg(
        F.sum(n).alias("total"),
        rows_with(blank).alias("empty"),
        rows_with(norm.isin(fv.NULL_TOKENS) & (F.trim(v) != "")).alias("placeholder"),
        F.count(v).alias("distinct_raw"),
        rows_with(v != F.trim(v)).alias("whitespace_padded"),
        (F.sum(F.length(v) * n) / F.nullif(rows_with(v.isNotNull()), F.lit(0))).alias("avg_length"),
        F.max(F.length(v)).alias("max_length"),
        rows_with(v.rlike(fv.NUMERIC_LIKE)).alias("numeric_like"),
        rows_with(F.startswith(v, F.lit("$"))).alias("currency_prefixed"))
    folded = (counts.filter(v.isNotNull()).select("column", norm.alias("norm")).distinct()
              .groupBy("column").agg(F.count("*").alias("distinct_normalised")))
    return (base.join(folded, "column", "left")
            .withColumn("distinct_normalised", F.coalesce("distinct_normalised", F.lit(0)))
            .withColumn("avg_length", F.round("avg_length", 1)))


def top_values(counts: DataFrame, k: int = fv.TOP_VALUES) -> DataFrame:
    """Most frequent values per column. The rank filter lets every map task keep k rows per column."""
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("v")))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= k).select("column", "rank", F.col("v").alias("value"), "n")


def shapes(counts: DataFrame, k: int = fv.TOP_SHAPES) -> DataFrame:
    """Most frequent value shapes with one example; empty values left out."""
    by_shape = (counts.filter(F.col("v") != "").groupBy("column", clean.value_shape(F.col("v")).alias("shape"))
                .agg(F.sum("n").alias("n"), F.min("v").alias("example")))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "shape"))
    return by_shape.withColumn("rank", rank).filter(F.col("rank") <= k)


def numeric_stats(counts: DataFrame) -> DataFrame:
    """Range and quantiles of the columns of which at least 30% of the filled values look numeric."""
    v, n = F.col("v"), F.col("n")
    x = F.when(v.rlike(fv.NUMERIC_LIKE), F.regexp_replace(v, "[$,]", "")).try_cast("double")
    filled = F.sum(F.when(v.isNull() | (F.trim(v) == ""), 0).otherwise(n))
    rows = counts.withColumn("x", x)
    stats = rows.groupBy("column").agg(
        filled.alias("filled"), F.sum(F.when(v.rlike(fv.NUMERIC_LIKE), n).otherwise(0)).alias("numeric_like"),
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.sum(F.when(F.col("x") < 0, n).otherwise(0)).alias("negative"),
        F.sum(F.when(F.col("x") == 0, n).otherwise(0)).alias("zero"))
    enough = (F.col("numeric_like") > 0) & (F.col("numeric_like") >= fv.NUMERIC_SHARE * F.greatest(F.col("filled"), F.lit(1)))
    stats = stats.filter(enough).select("column", "min", "max", "negative", "zero")
    return stats.join(ranks.quantiles(rows, ["column"], "x", "n", {"p01": 0.01, "p50": 0.5, "p99": 0.99}), "column", "left")


def day_month_evidence(counts: DataFrame) -> DataFrame:
    """Which part of a two-digit date exceeds 12, for columns that hold such dates at all."""
    v, n = F.col("v"), F.col("n")
    first = F.regexp_extract(v, fv.DAY_MONTH, 1).try_cast("int")
    second = F.regexp_extract(v, fv.DAY_MONTH, 2).try_cast("int")
    return (counts.filter(v.rlike(fv.DAY_MONTH)).groupBy("column")
            .agg(F.sum(F.when(first > 12, n).otherwise(0)).alias("first_part_gt_12"),
                 F.sum(F.when(second > 12, n).otherwise(0)).alias("second_part_gt_12"),
                 F.sum(n).alias("ambiguous_candidates")))


def cross_stats(df: DataFrame, columns: list[str], key: str = "ticket_id",
                ignored: tuple[str, ...] = ("ticket_id", "created_at", "submitted_by")) -> DataFrame:
    """Rows, repeated ids, repeated rows and rows repeated but for id, creation time and submitter."""
    def digest(cols: list[str]) -> Column:
        return F.sha2(F.to_json(F.array(*[F.col(c) for c in cols])), 256)

    keys = F.array(F.struct(F.lit("id").alias("kind"), F.col(key).alias("k")),
                   F.struct(F.lit("row").alias("kind"), digest(columns).alias("k")),
                   F.struct(F.lit("rest").alias("kind"), digest([c for c in columns if c not in ignored]).alias("k")))
    # one row per (kind, key): the counting never meets all rows of a frequent key
    groups = df.select(F.explode(keys).alias("e")).groupBy("e.kind", "e.k").agg(F.count("*").alias("n"))

    def extra(kind: str) -> Column:
        mine = F.col("kind") == kind
        return F.sum(F.when(mine, F.col("n"))) - F.count(F.when(mine, F.col("k")))

    return groups.agg(
        F.sum(F.when(F.col("kind") == "row", F.col("n"))).alias("total_rows"),
        extra("id").alias("duplicate_ticket_ids"), extra("row").alias("exact_duplicate_rows"),
        extra("rest").alias("duplicates_ignoring_id_created_submitter"))


def column_facts(df: DataFrame, columns: list[str], max_values: int = 12) -> DataFrame:
    """Null share, distinct values, and the value list of columns with few values, for typed tables."""
    counts = value_counts(df, columns)
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.asc_nulls_last("v")))
    lists = (counts.filter(F.col("v").isNotNull()).withColumn("r", rank).filter(F.col("r") <= max_values + 1)
             .groupBy("column").agg(F.sort_array(F.collect_list("v")).alias("values")))
    base = counts.groupBy("column").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("v").alias("distinct"))
    few = F.when(F.col("distinct").between(1, max_values), F.col("values"))
    return base.join(lists, "column", "left").select(
        "column", F.round(100 * F.col("nulls") / F.col("total"), 1).alias("null_pct"), "distinct", few.alias("values"))


def full_profile(counts: DataFrame) -> DataFrame:
    """Everything known per column in one row. The parts have one row per column and are joined by it."""
    tops = top_values(counts).groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value", "n"))).alias("top_values"))
    shp = shapes(counts).groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("rank", "shape", "n", "example"))).alias("shapes"))
    num = numeric_stats(counts).select("column", F.struct("min", "max", "negative", "zero", "p01", "p50", "p99").alias("numeric"))
    days = day_month_evidence(counts).select("column", F.struct(
        "first_part_gt_12", "second_part_gt_12", "ambiguous_candidates").alias("day_month"))
    dated = F.exists("shapes", lambda s: s["shape"].rlike("99/99/9999|99-99-9999"))
    out = column_profile(counts)
    for part in (tops, shp, num, days):
        out = out.join(part, "column", "left")
    return out.withColumn("day_month", F.when(dated, F.col("day_month")))


def compact(profile: DataFrame) -> DataFrame:
    """The bounded view a reviewer reads: 10 values of 60 characters, 8 shapes of 40; zero counts become NULL."""
    counts = ["total", "empty", "placeholder", "distinct_raw", "distinct_normalised", "whitespace_padded",
              "avg_length", "numeric_like", "currency_prefixed"]
    return profile.select(
        "column", *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in counts], "numeric", "day_month",
        F.transform(F.slice("top_values", 1, 10), lambda t: F.struct(
            F.substring(F.coalesce(t["value"], F.lit("None")), 1, 60).alias("value"), t["n"].alias("n"))).alias("top_values"),
        F.transform(F.slice("shapes", 1, 8), lambda s: F.struct(
            F.substring(s["shape"], 1, 40).alias("shape"), s["n"].alias("n"),
            F.substring(s["example"], 1, 40).alias("example"))).alias("shapes"))


def tag_columns(profile: DataFrame) -> DataFrame:
    """Semantic type, sensitivity, tags and evidence per column from its name and its profile."""
    name, top = F.lower("column"), F.col("top_values")
    filled = F.filter(top, lambda t: F.length(t["value"]) > 0)

    def weight(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, t: acc + t["n"])

    def share(pattern: str) -> Column:
        return F.coalesce(F.try_divide(weight(F.filter(filled, lambda t: t["value"].rlike(pattern))), weight(filled)), F.lit(0.0))

    dated = F.exists(F.slice("shapes", 1, 3), lambda s: s["shape"].rlike(fv.DATE_SHAPE))
    rows = (profile.withColumns({"person_share": share(fv.PERSON_SHAPE), "email_share": share(fv.EMAIL_LIKE),
                                 "phone_share": share(fv.PHONE_LIKE), "dated": F.coalesce(dated, F.lit(False))}))
    person = (F.col("person_share") >= 0.5) & name.rlike("by|name|user|owner")
    semantic = (F.when(name.rlike("_id$|^id$"), "identifier")
                .when(name.rlike("_at$") | F.col("dated"), "timestamp")
                .when(name.rlike("cost|amount|price"), "monetary")
                .when(name.rlike("_hours$|duration"), "duration")
                .when(person, "person_name")
                .when((F.coalesce("avg_length", F.lit(0.0)) > 25) | (F.col("distinct_raw") > 500), "free_text")
                .otherwise("categorical"))
    rows = rows.withColumn("semantic_type", semantic)
    kind = F.col("semantic_type")
    phone = ~kind.isin("identifier", "timestamp", "monetary", "duration") & (F.col("phone_share") > 0.1)
    rows = rows.withColumn("contact", (F.col("email_share") > 0) | phone)
    tags = F.array_compact(F.array(
        F.when(kind == "monetary", F.lit("finance")), F.when(kind == "person_name", F.lit("pii:name")),
        F.when(kind == "free_text", F.lit("may_contain_pii")), F.when(F.col("contact"), F.lit("pii:contact")),
        F.when(name == "assigned_to", F.lit("org:vendor_or_team")),
        F.when(F.col("placeholder") > 0, F.lit("has_placeholder_values"))))
    sensitivity = (F.when(F.col("contact") | (kind == "person_name"), "pii").when(kind == "categorical", "public")
                   .otherwise("internal"))
    evidence = F.struct(F.col("distinct_raw").alias("distinct"),
                        F.when(kind == "person_name", F.round("person_share", 2)).alias("person_name_share_top_values"))
    return rows.select("column", "semantic_type", sensitivity.alias("sensitivity"), tags.alias("tags"), evidence.alias("evidence"))


def heuristic_rules(profile: DataFrame) -> DataFrame:
    """Rule proposals that follow from the profile: placeholders to NULL, case variants to one spelling."""
    examples = F.slice(F.transform(F.filter(F.slice("top_values", 1, 10), lambda t: F.lower(F.trim(t["value"])).isin(fv.NULL_TOKENS)),
                                   lambda t: t["value"]), 1, 3)
    share = F.format_string("%.1f%%", 100 * F.col("placeholder") / F.col("total"))
    nulls = profile.filter(F.col("placeholder") > 0).select(
        F.concat("column", F.lit("_placeholders")).alias("check_id"), "column",
        F.concat(F.col("placeholder").cast("string"), F.lit(" values ("), share, F.lit(") are placeholder tokens such as "),
                 F.array_join(examples, ", ")).alias("issue"),
        F.lit("set_null").alias("action"),
        F.lit("CASE WHEN lower(trim(v)) IN ('n/a','null','tbd','???','unknown','error') THEN NULL ELSE v END").alias("cleaning_expression"),
        F.lit("warning").alias("severity"))
    cases = profile.filter((F.col("distinct_raw") > F.col("distinct_normalised")) & (F.col("distinct_normalised") > 0)).select(
        F.concat("column", F.lit("_case_variants")).alias("check_id"), "column",
        F.concat(F.col("distinct_raw").cast("string"), F.lit(" raw spellings collapse to "),
                 F.col("distinct_normalised").cast("string"), F.lit(" after case folding")).alias("issue"),
        F.lit("standardise").alias("action"), F.lit("lower(trim(v))").alias("cleaning_expression"),
        F.lit("info").alias("severity"))
    return nulls.unionByName(cases)


# ------------------------------------------------------------------ groundedness
def _number(raw: Column) -> Column:
    return F.regexp_replace(F.rtrim(raw, F.lit("%")), ",", "").try_cast("double")


def _parts(value: Column, kind: DataType) -> tuple[list[Column], list[Column]]:
    """Numbers (as arrays of doubles) and texts (as arrays) that a column of a profile holds, from its typed fields."""
    if isinstance(kind, NumericType):
        return [F.array(value.cast("double"))], []
    if isinstance(kind, StringType):
        return [], [F.array(value)]
    numbers, texts = [], []
    if isinstance(kind, StructType):
        for field in kind.fields:
            n, t = _parts(value[field.name], field.dataType)
            numbers, texts = numbers + n, texts + t
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        for field in kind.elementType.fields:
            each = value[field.name]  # one field of all elements
            if isinstance(field.dataType, NumericType):
                numbers.append(each.cast("array<double>"))
            elif isinstance(field.dataType, StringType):
                texts.append(each)
    return numbers, texts


def profile_numbers(profile: DataFrame, table: dict[str, int]) -> DataFrame:
    """column, k: every number a column's compact profile or the table facts (one row) mention, 2 decimals."""
    numbers, texts = [F.array(*[F.lit(float(v)) for v in table.values()])], []
    for field in profile.schema.fields:
        if field.name != "column":
            n, t = _parts(F.col(field.name), field.dataType)
            numbers, texts = numbers + n, texts + t
    none = F.array().cast("array<double>")
    read = [F.flatten(F.transform(F.coalesce(t, F.array().cast("array<string>")), lambda x: F.coalesce(F.transform(
        F.regexp_extract_all(x, F.lit(fv.CITED_NUMBER), F.lit(0)), _number), none))) for t in texts]
    every = F.concat(*[F.coalesce(n, none) for n in numbers], *read)
    return (profile.select("column", F.explode(every).alias("k")).filter(F.col("k").isNotNull())
            .select("column", F.round("k", 2).alias("k")).distinct())


def groundedness(claims: DataFrame, numbers: DataFrame, total_rows: Column) -> DataFrame:
    """Share of the numbers cited in a claim (check_id, column, text) that its column's profile supports: present, or a
    percentage of the row total. Small whole numbers are structure and are not counted.

    One row per claim; a claim that cites nothing has score NULL. A column that the profile does not have is judged
    by the numbers of all columns. `numbers` is a profile's: bounded, however large the table.
    """
    known = numbers.groupBy("column").agg(F.collect_set("k").alias("known"))
    everything = numbers.agg(F.collect_set("k")).scalar()
    met = claims.join(known, "column", "left").withColumn("known", F.coalesce("known", everything)).withColumn("total", total_rows.cast("double"))
    cited = F.transform(F.coalesce(F.regexp_extract_all("text", F.lit(fv.CITED_NUMBER), F.lit(0)), F.array().cast("array<string>")),
                        lambda r: F.struct(r.alias("raw"), _number(r).alias("value"), F.endswith(r, F.lit("%")).alias("pct")))
    met = met.withColumn("said", F.filter(cited, lambda c: (F.abs(c["value"]) > 12) | c["pct"]))

    def supported(c: Column) -> Column:
        tolerance = 0.5 * F.pow(F.lit(10.0), -F.length(F.regexp_extract(c["raw"], r"\.(\d+)", 1))) + 1e-9
        share = c["pct"] & F.exists("known", lambda k: (k > 0) & (k <= F.col("total"))
                                    & (F.abs(100 * k / F.col("total") - c["value"]) <= tolerance))
        return F.coalesce(F.array_contains("known", F.round(c["value"], 2)) | share, F.lit(False))

    met = met.withColumn("marked", F.transform("said", lambda c: F.struct(c["raw"].alias("raw"), supported(c).alias("ok"))))
    grounded, all_ = F.size(F.filter("marked", lambda m: m["ok"])), F.size("marked")
    return met.select("check_id", "column", all_.cast("long").alias("cited"), grounded.cast("long").alias("grounded"),
                      F.when(all_ > 0, F.round(grounded / all_, 3)).alias("score"),
                      F.transform(F.filter("marked", lambda m: ~m["ok"]), lambda m: m["raw"]).alias("ungrounded"))
