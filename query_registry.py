"""The registered queries: every operator over the whole driver tables.

Each callable takes (spark, sf_dir). Landed tickets and the silver tables are derived from `orders` once
per session and folder and kept as tables in the work folder, as a real run would; later queries read
only the columns they need.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType

from layerwright import fixed_values as fv
from layerwright import session
from layerwright.functions import clean, guard
from layerwright.operators import dedup, enrich, evaluate, metrics, people, profile, review, rules, similarity
from layerwright.plans import gold, publish, reports, run, silver
from layerwright.sources import landing, refdata
from layerwright.sources import tickets as T
from layerwright.streaming import relay, tables

_KEPT: dict[tuple, object] = {}
AS_OF = "timestamp_ntz '2030-01-01 00:00:00'"


def _once(spark: SparkSession, sf: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and arrays as text, so that both sides of a check have the same types."""
    def cast(f):
        if isinstance(f.dataType, DecimalType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, ArrayType):
            return F.array_join(F.col(f"`{f.name}`"), ",").alias(f.name)
        return F.col(f"`{f.name}`")
    return df.select(*[cast(f) for f in df.schema.fields])


# ------------------------------------------------------------------ derived tables
def landed(spark: SparkSession, sf: str) -> DataFrame:
    return _once(spark, sf, "landed", lambda: session.staged(
        T.raw_tickets(session.spread(T.table(spark, sf, "orders"))), "landed"))


def built(spark: SparkSession, sf: str) -> silver.Silver:
    def make() -> silver.Silver:
        s = silver.build(landed(spark, sf), T.label_map(spark), T.template_map(spark))
        return silver.Silver(session.staged(s.tickets, "tickets"), session.staged(s.quarantine, "quarantine"),
                             session.staged(s.duplicates, "duplicates"))
    return _once(spark, sf, "silver", make)


def _tickets(spark, sf):
    return built(spark, sf).tickets


def _fct(spark, sf):
    t = _tickets(spark, sf)
    return gold.fct_tickets(t, gold.as_of_date(t))


def _valid(spark, sf):
    return silver.valid_rows(landed(spark, sf))


def _parsed(spark, sf):
    return silver.parse_fields(_valid(spark, sf))


def _enriched(spark, sf):
    raw = landed(spark, sf)
    return silver.enriched(silver.valid_rows(raw), raw, T.label_map(spark), T.template_map(spark))


def _narrow(spark, sf):
    return _once(spark, sf, "narrow", lambda: silver._narrow_rows(_valid(spark, sf), True))


def _counts(spark, sf):
    return profile.value_counts(landed(spark, sf), silver.SOURCE_COLUMNS)


def _texts(spark, sf, name="documents"):
    return session.spread(T.table(spark, sf, name))


# ------------------------------------------------------------------ projections of events
def _k():
    return F.get_json_object("props", "$.k").cast("int")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Proposals in a review ledger, one per event."""
    e = T.table(spark, sf, "events").withColumn("k", _k())
    status = clean.lookup({"click": "approved", "signup": "auto_approved", "purchase": "rejected"}, F.col("event_type"))
    return e.select(
        F.col("event_id").alias("proposal_id"), F.col("ts").alias("created_at"),
        F.when(F.col("user_id") % 2 == 0, "category_label").otherwise("description_template").alias("kind"),
        F.concat(F.lit("subject "), F.col("user_id").cast("string")).alias("subject"), "user_id",
        F.coalesce(status, F.lit("proposed")).alias("status"),
        F.when(F.col("k") % 5 == 0, "rules").when(F.col("k") % 7 == 0, "human").otherwise("model").alias("source"),
        F.when(F.col("k") % 3 == 0, "hvac").when(F.col("k") % 3 == 1, "plumbing").otherwise("electrical").alias("answer"),
        (F.col("k") / 100).alias("confidence"),
        F.when(F.col("k") % 4 != 0, (F.col("event_id") * 37 % 100) / 100).alias("judge_p"),
        F.when(F.col("k") % 2 == 0, (F.col("event_id") * 13 % 10) / 10).alias("human"),
        F.when(F.col("event_type") == "view", "classification").otherwise("quality").alias("agent"),
        F.when(F.col("event_id") % 9 != 0, "hosted").alias("provider"), F.lit(False).alias("overridden"))


def decided(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger after a round of decisions on every second pending proposal: approved, rejected or changed."""
    plain = ledger(spark, sf).withColumn("proposal", F.create_map(
        F.lit("category"), F.col("answer"), F.lit("label_kind"), F.lit("category_label"))).drop("answer", "judge_p", "human")
    i = F.col("event_id")
    choices = T.table(spark, sf, "events").filter(i % 2 == 0).select(
        i.alias("proposal_id"), (i % 10 != 4).alias("approve"), F.lit("ann").alias("reviewer"),
        F.when(i % 3 == 0, F.create_map(F.lit("category"), F.lit("pest_control"))).alias("overrides"))
    return review.append(review.append(plain.limit(0), plain), review.decide(plain, choices))


def _mapping(spark: SparkSession, sf: str) -> DataFrame:
    """What holds now, for every user that has an even number: kind, subject, proposal."""
    user = F.col("user_id")
    return T.table(spark, sf, "events").filter(user % 4 != 1).select(
        F.when(user % 2 == 0, "category_label").otherwise("description_template").alias("kind"),
        F.concat(F.lit("subject "), user.cast("string")).alias("subject"),
        F.create_map(F.lit("category"), F.when(user % 3 == 0, "HVAC").otherwise("plumbing"), F.lit("label_kind"), F.lit("category_label"),
                     F.lit("is_safety_hazard"), F.lit("false")).alias("proposal")).dropDuplicates(["kind", "subject"])


def scored(spark: SparkSession, sf: str) -> DataFrame:
    right = F.when(F.col("user_id") % 3 == 0, "hvac").when(F.col("user_id") % 3 == 1, "plumbing").otherwise("electrical")
    return ledger(spark, sf).withColumns({
        "correct": F.col("answer") == right, "agent_conf": F.col("confidence"),
        "trust": review.trust_score(F.col("confidence"), F.col("judge_p"), F.col("human")),
        "trust_no_human": review.trust_score(F.col("confidence"), F.col("judge_p"), F.lit(None).cast("double"))})


def calls(spark: SparkSession, sf: str) -> DataFrame:
    """Model calls with their cost, one per event."""
    e = T.table(spark, sf, "events").withColumn("k", _k())
    prices = spark.createDataFrame([("model-a", 4.0, 20.0), ("vendor/model-b", 1.0, 5.0)], "model string, price_in double, price_out double")
    status = clean.lookup({"error": "error", "signup": "cache_hit", "purchase": "invalid_output"}, F.col("event_type"))
    u = F.col("user_id")
    rows = e.select(
        F.col("ts").cast("date").cast("string").alias("run_id"),
        F.when(u % 3 == 0, "ollama").when(u % 3 == 1, "hosted").otherwise("router").alias("provider"),
        F.when(u % 4 == 0, "model-a").when(u % 4 == 1, "vendor/model-b").when(u % 4 == 2, "vendor/model-a").otherwise("model-x").alias("model"),
        F.coalesce(status, F.lit("ok")).alias("status"), (F.col("k") * 10).alias("input_tokens"), F.col("k").alias("output_tokens"),
        F.round(F.col("value") * 10).cast("bigint").alias("latency_ms"))
    return metrics.with_cost(rows, prices)


def _evaluated(spark, sf):
    """Labels as truth, a length rule as the answer under test."""
    docs = T.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    rows = T.table(spark, sf, "labels").join(docs, "doc_id")
    n = F.col("n_chars")
    return rows.select(
        "doc_id", F.col("lang").alias("task"), F.when(F.col("quality") == 1, "good").otherwise("poor").alias("expected"),
        F.when(n >= 500, "good").when(n >= 20, "poor").alias("predicted"),
        (F.col("quality") == 1).alias("secondary_labelled"), (F.col("toxic") == 0).alias("secondary_ok"))


def _outbox(events: DataFrame) -> DataFrame:
    return events.select("event_id", "event_type", F.col("user_id").cast("string").alias("aggregate_id"),
                         F.col("ts").cast("timestamp").alias("created_at"), F.lit(None).cast("string").alias("trace_id"),
                         F.col("props").alias("payload"))


def _event_stream(spark, sf):
    schema = T.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


# ------------------------------------------------------------------ queries
def clean_timestamps(spark, sf):
    return _parsed(spark, sf).select(
        "bronze_id", F.col("created_at").alias("created_ts"),
        clean.timestamp_format(F.col("created_at_text"), F.col("created_at")).alias("created_format"),
        F.col("resolved_at").alias("resolved_ts"),
        clean.timestamp_format(F.col("resolved_at_text"), F.col("resolved_at")).alias("resolved_format"))


def swap_detection(spark, sf):
    return enrich.detect_swap(_valid(spark, sf), T.label_map(spark)).select("bronze_id", "label_key", "description", "swapped")


def description_templates(spark, sf):
    return (_enriched(spark, sf).filter(F.col("description").isNotNull()).groupBy(F.col("description_template").alias("template"))
            .agg(F.count("*").alias("n"), F.max(F.col("tmpl").isNotNull()).alias("mapped"), F.min("tmpl.category").alias("category")))


def category_resolution(spark, sf):
    rows = enrich.resolve_category(_enriched(spark, sf).drop("category"))
    return rows.select("bronze_id", "category", "category_source", "category_confidence", "category_from_description", "category_conflict")


def qualification(spark, sf):
    rows = enrich.resolve_category(_enriched(spark, sf).drop("category"))
    who = rows.withColumn("assignee", enrich.assignee_name(clean.clean_text(F.col("assigned_to")))).filter(F.col("assignee").isNotNull())
    return who.groupBy("assignee", "category").agg(F.count("*").alias("n")).withColumn(
        "qualified", enrich.qualified(F.col("assignee"), F.col("category")))


def worklist_labels(spark, sf):
    todo = enrich.worklist_labels(_valid(spark, sf), T.label_map(spark))
    return enrich.classify_labels(todo).drop("source")


def worklist_templates(spark, sf):
    todo = enrich.worklist_templates(_enriched(spark, sf))
    return enrich.classify_templates(todo).drop("source", "issue_type")


def keyword_classify(spark, sf):
    texts = _texts(spark, sf, "conversations").select(F.col("text").alias("template")).distinct()
    return enrich.classify_templates(texts).select(F.md5("template").alias("text_id"), "category", "severity", "is_safety_hazard", "confidence")


def fingerprint_groups(spark, sf):
    return dedup.content_decisions(_narrow(spark, sf)[1]).select(
        "fingerprint", "copies", F.col("keep.ticket_id").alias("keep_ticket"), F.round("bits", 6).alias("bits"), "merge")


def duplicate_audit(spark, sf):
    slim, latest = _narrow(spark, sf)
    return dedup.duplicates(slim, latest, dedup.content_outcomes(latest))


def duplicate_references(spark, sf):
    slim = _narrow(spark, sf)[0]
    return dedup.missing_references(dedup.references(slim), slim)


def silver_tickets(spark, sf):
    return _plain(_tickets(spark, sf).select(*silver.TICKET_COLUMNS))


def silver_build(spark, sf):
    """Silver from the landed rows, not from the kept table: the whole computation."""
    s = silver.build(landed(spark, sf), T.label_map(spark), T.template_map(spark))
    return _plain(s.tickets.select(*silver.TICKET_COLUMNS))


def rule_results(spark, sf):
    return _plain(rules.gate_results(_tickets(spark, sf), fv.DQ_CHECKS, AS_OF))


def column_tags(spark, sf):
    tags = profile.tag_columns(profile.full_profile(_counts(spark, sf)))
    return tags.select("column", "semantic_type", "sensitivity", F.array_join("tags", ",").alias("tags"))


def compact_profile(spark, sf):
    c = profile.compact(profile.full_profile(_counts(spark, sf)))
    return c.select("column", "total", "empty", "placeholder", F.to_json("top_values").alias("top_values"), F.to_json("shapes").alias("shapes"))


def proposed_rules(spark, sf):
    return profile.heuristic_rules(profile.full_profile(_counts(spark, sf)))


def groundedness(spark, sf):
    full = profile.full_profile(_counts(spark, sf))
    facts = profile.cross_stats(landed(spark, sf), silver.SOURCE_COLUMNS).first().asDict()
    numbers = profile.profile_numbers(profile.compact(full), facts)
    claims = profile.heuristic_rules(full).select("check_id", "column", F.col("issue").alias("text"))
    return _plain(profile.groundedness(claims, numbers, F.lit(facts["total_rows"])))


def cleaning_preview(spark, sf):
    rule = "CASE WHEN lower(trim(v)) LIKE '%tbd%' OR lower(trim(v)) IN ('n/a','null','???','unknown','error') THEN NULL ELSE v END"
    return rules.evaluate_cleaning(landed(spark, sf).select(F.col("cost").alias("v")).distinct(), rule)


def redact_pii(spark, sf):
    r = _texts(spark, sf).select("doc_id", guard.redact(F.col("text")).alias("r"))
    return r.select("doc_id", "r.redactions", F.md5("r.text").alias("text_md5"))


def templates_many_names(spark, sf):
    """Texts that name parts, masked by as many names as there are parts; many names begin like others."""
    part = T.table(spark, sf, "part")
    name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    texts = part.select(F.col("p_partkey").alias("bronze_id"), F.concat(F.lit("lamp out at "), name, F.lit(", near x"), name, F.lit(" 7")).alias("description"))
    rows = enrich.with_template(texts, part.select(name.alias("name")).distinct())
    return rows.select(F.col("bronze_id").alias("p_partkey"), F.col("description_template").alias("template"))


def _pending(todo: DataFrame, column: str) -> DataFrame:
    return todo.filter(F.length(column) % 2 == 0).select(F.col(column).alias("subject"))


def worklist_labels_pending(spark, sf):
    args = (_valid(spark, sf), T.label_map(spark))
    todo = enrich.worklist_labels(*args, pending=_pending(enrich.worklist_labels(*args), "label"))
    return enrich.classify_labels(todo).drop("source")


def worklist_templates_pending(spark, sf):
    rows = _enriched(spark, sf)
    todo = enrich.worklist_templates(rows, pending=_pending(enrich.worklist_templates(rows), "template"))
    return enrich.classify_templates(todo).drop("source", "issue_type")


# ------------------------------------------------------------------ landing
def lake(spark: SparkSession, sf: str) -> tuple[str, list[tuple]]:
    """Customers as CSV files, landed: all, the same once more, half of them again, and some with other columns."""
    def make() -> tuple[str, list[tuple]]:
        root, rows = session.fresh_folder(spark, "lake"), T.table(spark, sf, "customer")
        key = F.col("c_custkey")
        parts = {"first": rows.select("c_custkey", "c_name", "c_mktsegment"),
                 "half": rows.filter(key % 2 == 0).select("c_custkey", "c_name", "c_mktsegment"),
                 "other": rows.filter(key % 3 == 0).select("c_custkey", "c_name", "c_nationkey")}
        files = {}
        for name, df in parts.items():
            folder = session.fresh_folder(spark, f"csv-{name}")
            df.write.csv(folder, header=True)
            # one name for each file that was written
            files[name] = sorted(r[0] for r in spark.read.format("binaryFile").load(folder).select("path").collect())
        done = [(step, f.rows_in, f.rows_out, f.repeated, f.skipped) for step, name in
                (("first", "first"), ("again", "first"), ("half", "half"), ("other", "other"))
                for f in landing.land_files(spark, files[name], "customers", root, step)]
        return root, done
    return _once(spark, sf, "lake", make)


def landed_text_rows(spark, sf):
    """Documents, with the line breaks and quotes in their texts, landed from one CSV file: row numbers and lineage."""
    def make() -> str:
        root, folder = session.fresh_folder(spark, "text-lake"), session.fresh_folder(spark, "csv-text")
        # one file in parts that many tasks write: the header, then the rows in order
        docs = T.table(spark, sf, "documents").select("doc_id", "text", "lang").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        spark.createDataFrame([(",".join(docs.columns),)], "line string").coalesce(1).write.text(f"{folder}/header")
        docs.write.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{folder}/rows")
        written = [sorted(r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f"{folder}/{part}").select("path").collect())
                   for part, glob in (("header", "*.txt"), ("rows", "*.csv"))]
        file = [path for some in written for path in some]
        landing.land_files(spark, [file], "documents", root, "first")
        landing.land_files(spark, [file], "documents", root, "again")
        return root
    root = _once(spark, sf, "text-lake", make)
    rows = spark.read.schema(landing.BRONZE).parquet(f"{root}/bronze")
    files = spark.read.schema(landing.MANIFEST).parquet(f"{root}/manifest").select("file_sha256", "header_fingerprint", "row_count", "path")
    field = lambda name: F.try_element_at("payload", F.lit(name))
    return rows.join(F.broadcast(files), "file_sha256").select(
        field("doc_id").cast("long").alias("doc_id"), "row_no", (F.col("bronze_id") - F.col("landing_seq") * landing.SEQ_STEP).alias("number_in_file"),
        F.md5(field("text")).alias("text_md5"), field("lang").alias("lang"), "source", "run_id", "landing_seq", "header_fingerprint", "row_count",
        F.endswith("path", "source_file").alias("named"), F.col("ingested_at").isNotNull().alias("dated"))


def _bronze(spark, sf):
    return spark.read.schema(landing.BRONZE).parquet(f"{lake(spark, sf)[0]}/bronze")


def landed_rows(spark, sf):
    rows = landing.flat_view(_bronze(spark, sf), ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])
    return rows.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


def landing_manifest(spark, sf):
    m = spark.read.schema(landing.MANIFEST).parquet(f"{lake(spark, sf)[0]}/manifest")
    return m.groupBy(F.array_join("header", ",").alias("header")).agg(
        F.sum("row_count").alias("rows"), F.max(F.array_join("drift_added", ",")).alias("added"), F.max(F.array_join("drift_removed", ",")).alias("removed"))


def landing_repeat(spark, sf):
    """What each landing step did; one row per file comes from the driver."""
    done = spark.createDataFrame(lake(spark, sf)[1], "step string, rows_in long, rows_out long, repeated long, skipped boolean")
    return done.groupBy("step").agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"), F.sum("repeated").alias("repeated"),
                                    F.every("skipped").alias("skipped"))


def bronze_summary(spark, sf):
    return reports.bronze_summary(_bronze(spark, sf)).select("rows", (F.col("files") >= 3).alias("several_files"), F.col("last").isNotNull().alias("dated"))


def reference_tables(spark, sf):
    """Who supplied which brand and which brands were returned together: first both from returned lines, then who supplied
    replaced from all lines. What was not replaced stays."""
    lines = T.table(spark, sf, "lineitem").join(T.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    supplied = lambda rows: rows.select(F.col("l_suppkey").cast("string").alias("a"), F.col("p_brand").alias("b")).distinct()
    returned = lines.filter("l_returnflag = 'R'")
    brands = returned.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("brands")).select("brands").distinct()
    related = (brands.select("brands", F.explode("brands").alias("a")).select("a", F.explode("brands").alias("b")).filter("a < b").distinct())
    root = session.fresh_folder(spark, "reference")
    publish.publish({"supplied": supplied(returned), "related": related}, root, "first")
    publish.replace({"supplied": supplied(lines)}, root, "second")
    parts = [publish.read(spark, root, name).select(F.lit(name).alias("name"), "a", "b") for name in publish.table_names(spark, root)]
    return parts[0].unionByName(parts[1])


def stage_runs(spark, sf):
    """Null rates of the silver tickets and their rows, noted by the write and logged; read from the log."""
    root = session.fresh_folder(spark, "stage")
    out, seen = metrics.watched(built(spark, sf).tickets, "tickets", fv.NULL_RATE_COLUMNS)
    out.write.parquet(f"{root}/tickets")
    run.log(spark, root, "stage_runs", "r1", "silver", "succeeded", {**metrics.watched_rates(seen.get), "rows": float(seen.get["rows"])})
    return spark.read.parquet(f"{root}/stage_runs").select("run_id", "stage", "status", F.explode("metrics").alias("metric", "value"))


def gate_from_file(spark, sf):
    """The gate with rules that were written to a file and read again."""
    path = session.fresh_folder(spark, "rules")
    refdata.export_csv(refdata.rule_frame(spark, fv.DQ_CHECKS), "check_id", path)
    return _plain(rules.gate_results(_tickets(spark, sf), refdata.rule_list(refdata.read_rules(spark, path)), AS_OF))


def episode_files(spark, sf):
    """Documents as precedents, written as JSON lines and read again: texts with any character, answers with gaps."""
    path = session.fresh_folder(spark, "episodes")
    answer = lambda name: F.create_map(F.lit(name), F.col(name))
    docs = T.table(spark, sf, "documents")
    refdata.export_json(docs.select(F.lit("origin").alias("task"), "text", answer("lang").alias("agent_answer"), answer("source").alias("human_answer")), "text", path)
    rows = refdata.read_episodes(spark, path).select("task", F.md5("text").alias("text_md5"), F.try_element_at("agent_answer", F.lit("lang")).alias("lang"),
                                                     F.try_element_at("human_answer", F.lit("source")).alias("source"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


def gate_latest(spark, sf):
    results = rules.gate_results(_tickets(spark, sf), fv.DQ_CHECKS, AS_OF)
    older = results.withColumn("run_id", F.lit("r1")).withColumn("checked_at", F.lit(1)).withColumn("passed", F.lit(None).cast("boolean"))
    newer = results.withColumn("run_id", F.lit("r2")).withColumn("checked_at", F.lit(2))
    return _plain(reports.gate_latest(older.unionByName(newer)))


def rule_tryout(spark, sf):
    tried = {"open": "is_open", "number": "cost_usd + 1", "subquery": "is_open IN (SELECT true)", "unknown": "nope = 1"}
    rows = rules.evaluate_predicates(_tickets(spark, sf), tried)
    return rows.select("check_id", F.col("problem").isNotNull().alias("refused"), "total", "violations")


def table_fingerprint(spark, sf):
    rows = T.table(spark, sf, "customer")
    a, b = (metrics.table_fingerprint(df) for df in (rows, rows.repartition(7).select(*reversed(rows.columns))))
    return a.join(b.withColumnRenamed("fingerprint", "other"), "rows").select("rows", (F.col("fingerprint") == F.col("other")).alias("same"))


def answering_models(spark, sf):
    rows = calls(spark, sf).withColumn("served_model", F.when(F.col("output_tokens") % 3 != 0, F.col("model")))
    return metrics.answering_models(rows)


def evaluation_errors(spark, sf):
    return evaluate.errors(_scored_labels(spark, sf)).select("doc_id", "truth", "answer")


def jaccard_recall(spark, sf, leave_own_out=True):
    """Benchmark passages most similar to the turns of a conversation; a looser threshold than the
    default, because free prose shares fewer words than short labels do."""
    batch = T.table(spark, sf, "conversations").select(F.col("conv_id").alias("batch_id"), F.lit("text").alias("kind"), "text")
    episodes = T.table(spark, sf, "benchmark").select(F.lit("text").alias("kind"), "text")
    exclude = batch.select("batch_id", "text") if leave_own_out else None
    r = similarity.recall(batch, episodes, min_similarity=0.15, exclude=exclude)
    return r.select(F.col("batch_id").alias("conv_id"), F.md5("episode").alias("episode"), F.round("similarity", 9).alias("similarity"), "rank")


def human_signal(spark, sf):
    docs = T.table(spark, sf, "documents").select("doc_id", "lang", "text")
    d = T.table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("lang").alias("kind"), "text", F.create_map(
            F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"), F.col("toxic").cast("string")).alias("answer"))
    d = session.staged(d, "decisions")
    # asked for one field of two, and once more for texts that nobody decided on
    asked = d.withColumn("answer", F.map_filter("answer", lambda k, v: k == "quality"))
    strange = T.table(spark, sf, "nation").select(F.lit("en").alias("kind"), F.col("n_name").alias("text"),
                                                  F.create_map(F.lit("quality"), F.lit("1")).alias("answer"))
    r = similarity.human_signal(asked.unionByName(strange), d)
    return r.select("kind", F.md5("text").alias("text_id"), F.element_at("answer", "quality").alias("answer"),
                    F.round("human_signal", 9).alias("human_signal"), "votes")


def ledger_state(spark, sf):
    rows = review.current(decided(spark, sf))
    return rows.groupBy("kind", "status", "source", "overridden", F.element_at("proposal", "category").alias("category"),
                        F.element_at("agent_original", "category").alias("was")).agg(F.count("*").alias("n"))


def corrections(spark, sf):
    user = F.col("user_id")
    wanted = T.table(spark, sf, "events").filter(user % 5 == 0).select(
        F.when(user % 2 == 0, "category_label").otherwise("description_template").alias("kind"),
        F.concat(F.lit("subject "), user.cast("string")).alias("subject"), F.concat(F.lit("fix "), user.cast("string")).alias("proposal_id"),
        F.create_map(F.lit("category"), F.lit("it_network")).alias("values"), F.lit("bo").alias("reviewer"),
        F.lit(None).cast("timestamp").alias("created_at")).dropDuplicates(["kind", "subject"])
    rows = review.correct(decided(spark, sf), wanted, _mapping(spark, sf))
    return rows.select("kind", "subject", "proposal_id", "status", "overridden", F.element_at("proposal", "category").alias("category"),
                       F.element_at("proposal", "label_kind").alias("label_kind"), F.element_at("agent_original", "category").alias("was"))


def recorded_decisions(spark, sf):
    rows = review.recorded_decisions(decided(spark, sf), _mapping(spark, sf), {
        "category_label": ["category", "label_kind"], "description_template": ["category", "is_safety_hazard"]})
    return rows.select("kind", "subject", "confidence", F.element_at("original", "category").alias("original"),
                       F.element_at("final", "category").alias("final"), "correct")


def replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded decisions with a judge's verdict on most of them and the signal of all other decisions of their kind."""
    def make() -> DataFrame:
        rows = review.recorded_decisions(decided(spark, sf), _mapping(spark, sf), {
            "category_label": ["category", "label_kind"], "description_template": ["category", "is_safety_hazard"]})
        n, last = F.count("*"), F.max("proposal_id")
        verdicts = (ledger(spark, sf).groupBy("kind", "subject").agg(n.alias("n"), (last % 100 / 100).alias("p_correct"), (n % 2 == 0).alias("agrees"))
                    .filter("n % 5 <> 0").drop("n"))
        return session.staged(evaluate.replay(session.staged(rows, "decisions"), verdicts), "replayed")
    return _once(spark, sf, "replayed", make)


def recorded_replay(spark, sf):
    return replayed(spark, sf).select("kind", "subject", "correct", "judge_p", F.round("human_signal", 9).alias("human_signal"), "votes",
                                      F.round("trust", 9).alias("trust"), F.round("trust_no_human", 9).alias("trust_no_human"))


def episodes(spark, sf):
    rows = review.episodes(decided(spark, sf))
    return rows.groupBy("kind", "text", F.element_at("agent_answer", "category").alias("agent"),
                        F.element_at("human_answer", "category").alias("human")).agg(F.count("*").alias("n"))


def auto_approve_policy(spark, sf):
    rows = review.policy(scored(spark, sf), with_judge=True)
    short = (F.when(F.startswith("reason", F.lit("from rules")), "rules").when(F.startswith("reason", F.lit("no verdict")), "no verdict")
             .when(F.contains("reason", F.lit(" below ")), "too low").otherwise("enough"))
    return rows.select("proposal_id", "approve", short.alias("reason"))


def latency(spark, sf):
    return metrics.latency(calls(spark, sf), ["provider"])


def usage_rollup(spark, sf):
    return metrics.usage_rollup(calls(spark, sf)).withColumn("cost_usd", F.round("cost_usd", 6))


def truth_score(spark, sf):
    """What the run made of the tickets against what was meant by the orders."""
    dups = built(spark, sf).duplicates.filter(F.col("match_rule") == fv.RULE_SAME_CONTENT)
    return _plain(evaluate.truth_score(T.truth(T.table(spark, sf, "orders")), _tickets(spark, sf), built(spark, sf).quarantine, dups))


def row_hashes(spark, sf):
    cols = ["c_custkey", "c_name", "c_mktsegment"]
    payload = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("string") for c in cols]))
    return T.table(spark, sf, "customer").select("c_custkey", landing.row_hash(payload).alias("row_hash"))


def repeated_rows(spark, sf):
    rows = T.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("row_hash"), F.col("source").alias("file_sha256"))
    return landing.seen_before(rows, rows).select("doc_id")


def leaked_items(spark, sf):
    return similarity.leaked_items(T.table(spark, sf, "benchmark"), _texts(spark, sf))


def stream_relay(spark, sf):
    sink, mark = session.fresh_folder(spark, "relay"), session.fresh_folder(spark, "relay-checkpoint")
    relay.relay(_outbox(_event_stream(spark, sf)), sink, mark).awaitTermination()
    return spark.read.parquet(sink).select("event_id", "event_type", "key", "body")


def stream_dedup(spark, sf):
    """Events delivered in two overlapping lots; every event comes through once."""
    source = session.fresh_folder(spark, "delivered")
    rows = T.table(spark, sf, "events")
    rows.unionAll(rows.filter(F.col("event_id") % 3 == 0)).write.parquet(source)
    sink, mark = session.fresh_folder(spark, "dedup"), session.fresh_folder(spark, "dedup-checkpoint")
    stream = spark.readStream.schema(rows.schema).parquet(source)
    out = relay.dedup_events(_outbox(stream), "60 days").select("event_id", "event_type")
    (out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", mark).trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(sink)


def stream_upsert(spark, sf):
    table, mark = session.fresh_folder(spark, "upsert"), session.fresh_folder(spark, "upsert-checkpoint")
    rows = _once(spark, sf, "deliveries", lambda: session.fresh_folder(spark, "deliveries"))
    keep = _valid(spark, sf).select(clean.ticket_id(F.col("ticket_id")).alias("ticket_id"), "bronze_id",
                                    clean.status_value(clean.clean_text(F.col("status"))).alias("status"))
    if (spark, sf, "written") not in _KEPT:
        keep.write.mode("overwrite").parquet(rows)
        _KEPT[(spark, sf, "written")] = True
    stream = spark.readStream.schema(keep.schema).option("maxFilesPerTrigger", 4).parquet(rows)
    (stream.writeStream.foreachBatch(tables.upsert_batch(table)).option("checkpointLocation", mark)
     .trigger(availableNow=True).start().awaitTermination())
    return tables.latest(spark, table)


def _delivered(spark: SparkSession, name: str, rows: DataFrame, lot: Column, lots: int, batch: Callable) -> None:
    """Hand `rows` to `batch` in lots that arrive one after the other; the stream resumes from its checkpoint for each."""
    source, mark = session.fresh_folder(spark, name), session.fresh_folder(spark, f"{name}-checkpoint")
    for i in range(lots):
        rows.filter(lot == i).write.mode("append").parquet(source)
        (spark.readStream.schema(rows.schema).parquet(source).writeStream.foreachBatch(batch).option("checkpointLocation", mark)
         .trigger(availableNow=True).start().awaitTermination())


def stream_replay(spark, sf):
    """Monthly figures of events of which a tenth arrives late; late rows change the months they belong to."""
    landed_, out = session.fresh_folder(spark, "landed-by-month"), session.fresh_folder(spark, "months")
    events = T.table(spark, sf, "events").select("event_id", "user_id", "ts", F.date_format("ts", "yyyyMM").cast("int").alias("created_month"))
    derive = lambda rows: rows.groupBy("created_month").agg(
        F.count("*").alias("events"), F.countDistinct("user_id").alias("users"), F.max("event_id").alias("last_event"))
    _delivered(spark, "late-events", events, F.when(F.col("event_id") % 10 == 3, 1).otherwise(0), 2,
               tables.landed_replay_batch(landed_, out, derive))
    return spark.read.parquet(out)


def stream_fingerprints(spark, sf):
    """Documents in three lots; each copy points to the lowest document of its content that had arrived by then."""
    seen, out = session.fresh_folder(spark, "fingerprints"), session.fresh_folder(spark, "fingerprint-copies")
    docs = T.table(spark, sf, "documents").filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("bronze_id"), F.col("doc_id").cast("string").alias("ticket_id"), F.col("doc_id").alias("ticket_number"),
        F.sha2("text", 256).alias("fingerprint"))
    _delivered(spark, "documents", docs, F.col("bronze_id") % 3, 3, tables.fingerprint_batch(seen, out))
    return spark.read.schema("ticket_id string, survivor_ticket_id string, fingerprint string").parquet(out).drop("epoch")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def of(fn):  # a query over the silver tickets
        return lambda spark, sf: _plain(fn(_tickets(spark, sf)))

    def fact(fn):
        return lambda spark, sf: _plain(fn(_fct(spark, sf)))

    def backlog(spark, sf):
        return gold.mart_open_backlog(_fct(spark, sf), gold.as_of_date(_tickets(spark, sf)))

    def hazard(spark, sf):
        return gold.underprioritised_hazards(_tickets(spark, sf), gold.as_of_date(_tickets(spark, sf)))

    def count(fn):  # a query over (column, value, count)
        return lambda spark, sf: fn(_counts(spark, sf))

    def parts(fn):
        return lambda spark, sf: fn(built(spark, sf).tickets, built(spark, sf).quarantine, built(spark, sf).duplicates)

    def numeric(spark, sf):
        s = profile.numeric_stats(_counts(spark, sf))
        return s.select("column", "min", "max", "negative", "zero", *[F.round(c, 6).alias(c) for c in ("p01", "p50", "p99")])

    def facts(spark, sf):
        cols = ["status", "priority", "category", "assignee", "building", "is_open", "resolution_outcome", "ticket_id"]
        return _plain(profile.column_facts(_tickets(spark, sf), cols))

    return {
        # cleansing
        "clean_timestamps": clean_timestamps,
        "clean_costs": lambda s, d: _plain(_parsed(s, d).select("bronze_id", "cost_usd", "cost_flag")),
        "clean_sla": lambda s, d: _plain(_parsed(s, d).select("bronze_id", F.col("sla_hours").alias("sla_value"), "sla_flag", "resolution_hours", "sla_met")),
        "clean_enums": lambda s, d: _parsed(s, d).select("bronze_id", "status", "is_open", "priority", "assignee", "assignee_type", clean.building(F.col("building")).alias("building")),
        "resolution_notes": lambda s, d: _plain(_parsed(s, d).select("bronze_id", "resolution_outcome", "root_cause", "part_replaced", "eta_business_days", "onsite_hours", "duplicate_of_ticket_id")),
        "value_shapes": lambda s, d: T.table(s, d, "customer").groupBy(clean.value_shape(F.col("c_name")).alias("shape")).agg(F.count("*").alias("n")),
        "token_estimate": lambda s, d: T.table(s, d, "documents").select("doc_id", guard.token_estimate(F.col("text")).alias("tokens")),
        "instruction_phrases": lambda s, d: T.table(s, d, "documents").select("doc_id", guard.instruction_phrase(F.col("text")).alias("flagged")),
        "text_slugs": lambda s, d: T.table(s, d, "part").withColumn("name", F.concat_ws(" ", "p_name", "p_brand")).select("p_partkey", "name", clean.slug(F.col("name")).alias("slug")),
        # rows
        "quarantine_rows": lambda s, d: _plain(silver.quarantine_rows(landed(s, d)).select("bronze_id", F.col("ticket_id").alias("ticket_id_raw"), "reasons")),
        "quarantine_reasons": lambda s, d: reports.quarantine_reasons(silver.quarantine_rows(landed(s, d))),
        "swap_detection": swap_detection,
        "swap_candidates": lambda s, d: enrich.swap_candidates(_valid(s, d)),
        "description_templates": description_templates,
        "locations": of(lambda t: t.select("ticket_id", "floor", "room", "asset_id")),
        "category_resolution": lambda s, d: _plain(category_resolution(s, d)),
        "qualification": qualification,
        "person_resolution": lambda s, d: people.people_map(_valid(s, d)),
        "templates_many_names": templates_many_names,
        "worklist_labels_pending": worklist_labels_pending,
        "worklist_templates_pending": worklist_templates_pending,
        "worklist_labels": worklist_labels,
        "worklist_templates": worklist_templates,
        "keyword_classify": keyword_classify,
        # duplicates
        "dedup_supersede": lambda s, d: dedup.superseded(*_narrow(s, d)),
        "fingerprint_groups": fingerprint_groups,
        "value_frequencies": lambda s, d: dedup.value_frequencies(_narrow(s, d)[1]),
        "duplicate_audit": duplicate_audit,
        "duplicates_by_rule": lambda s, d: reports.duplicates_by_rule(built(s, d).duplicates),
        "duplicate_references": duplicate_references,
        # silver
        "silver_tickets": silver_tickets,
        "silver_build": silver_build,
        "reconciliation": lambda s, d: silver.reconcile(landed(s, d), built(s, d)),
        "outcome_counts": parts(metrics.outcome_counts),
        "null_rates": of(metrics.null_rates),
        "column_facts": facts,
        "lineage": lambda s, d: (_tickets(s, d).select("_bronze_id").join(landed(s, d).select("bronze_id", "source_file"), F.col("_bronze_id") == F.col("bronze_id"))
                                 .groupBy("source_file").agg(F.count("*").alias("tickets"))),
        "rule_results": rule_results,
        "gate_latest": gate_latest,
        "rule_tryout": rule_tryout,
        "truth_score": truth_score,
        # gold
        "category_tickets": lambda s, d: gold.dim_category(s).select("category").join(_tickets(s, d).groupBy("category").agg(F.count("*").alias("n")), "category", "left"),
        "dim_building": of(gold.dim_building),
        "dim_assignee": of(gold.dim_assignee),
        "dim_date": of(gold.dim_date),
        "fct_tickets": lambda s, d: _plain(_fct(s, d).drop("_run_id", "_built_at")),
        "mart_sla_performance": fact(gold.mart_sla_performance),
        "mart_vendor_scorecard": fact(gold.mart_vendor_scorecard),
        "mart_open_backlog": lambda s, d: _plain(backlog(s, d)),
        "underprioritised_hazards": lambda s, d: _plain(hazard(s, d)),
        "hazards_in_order": lambda s, d: _plain(gold.hazards_in_order(hazard(s, d)).select("rank", "inferred_severity", "open_days", "ticket_id")),
        "kg_edges": of(gold.kg_edges),
        # reports
        "report_silver": parts(reports.silver_summary),
        "report_top_flags": lambda s, d: reports.top_flags(_tickets(s, d)),
        "report_category_sources": of(reports.category_sources),
        "report_sla_by_category": fact(lambda f: reports.sla_by_category(gold.mart_sla_performance(f))),
        "report_vendors": fact(lambda f: reports.vendors(gold.mart_vendor_scorecard(f))),
        "report_backlog": lambda s, d: _plain(reports.backlog_by_building(backlog(s, d))),
        "report_hazards": lambda s, d: reports.hazards(hazard(s, d)),
        # profile
        "column_profile": count(profile.column_profile),
        "top_values": count(profile.top_values),
        "shape_histogram": count(profile.shapes),
        "numeric_stats": numeric,
        "day_month_evidence": count(profile.day_month_evidence),
        "cross_stats": lambda s, d: profile.cross_stats(landed(s, d), silver.SOURCE_COLUMNS),
        "column_tags": column_tags,
        "compact_profile": compact_profile,
        "proposed_rules": proposed_rules,
        "groundedness": groundedness,
        "cleaning_preview": cleaning_preview,
        # landing, reference data
        "landed_rows": landed_rows,
        "landed_text_rows": landed_text_rows,
        "landing_manifest": landing_manifest,
        "landing_repeat": landing_repeat,
        "bronze_summary": bronze_summary,
        "reference_tables": reference_tables,
        "gate_from_file": gate_from_file,
        "stage_runs": stage_runs,
        "episode_files": episode_files,
        "row_hashes": row_hashes,
        "repeated_rows": repeated_rows,
        # text, similarity
        "redact_pii": redact_pii,
        "token_sets": lambda s, d: _texts(s, d).select("doc_id", F.array_join(F.array_sort(clean.tokens(F.col("text"))), " ").alias("tokens")),
        "jaccard_recall": jaccard_recall,
        "jaccard_recall_all": lambda s, d: jaccard_recall(s, d, leave_own_out=False),
        "human_signal": human_signal,
        "leaked_items": leaked_items,
        # review
        "latest_decision": lambda s, d: review.latest_per_subject(ledger(s, d)).select("kind", "subject", "proposal_id", "status", "answer"),
        "first_proposal": lambda s, d: review.first_per_subject(ledger(s, d)).select("kind", "subject", "proposal_id", "answer"),
        "original_proposal": lambda s, d: review.original_per_subject(decided(s, d)).select("kind", "subject", "proposal_id"),
        "pending_subjects": lambda s, d: review.pending(decided(s, d)),
        "ledger_state": ledger_state,
        "corrections": corrections,
        "recorded_decisions": recorded_decisions,
        "episodes": episodes,
        "trust_scores": lambda s, d: scored(s, d).select("proposal_id", F.round("trust", 9).alias("trust"), F.round("trust_no_human", 9).alias("trust_no_human")),
        "auto_approve_policy": auto_approve_policy,
        "recorded_replay": recorded_replay,
        "recorded_policies": lambda s, d: evaluate.policy_results(replayed(s, d)),
        "recorded_ranking": lambda s, d: evaluate.ranking_with_base(replayed(s, d)),
        "review_queue_places": lambda s, d: review.queue_places(scored(s, d)).select("proposal_id", "rank"),
        "review_queue": lambda s, d: review.queue(scored(s, d)).select("proposal_id", F.round("trust", 9).alias("trust")),
        "policy_replay": lambda s, d: evaluate.policy_results(scored(s, d)),
        "precision_at_k": lambda s, d: evaluate.queue_ranking(scored(s, d), "proposal_id"),
        "report_proposals": lambda s, d: reports.proposals(ledger(s, d)),
        # evaluation
        "precision_recall_f1": lambda s, d: evaluate.category_report(_scored_labels(s, d)),
        "accuracy": lambda s, d: evaluate.accuracy(_scored_labels(s, d)),
        "promotion_gate": lambda s, d: evaluate.promotion_gate(evaluate.accuracy(_scored_labels(s, d))),
        # usage
        "macro_f1": lambda s, d: evaluate.macro_f1(evaluate.category_report(_scored_labels(s, d))),
        "evaluation_errors": evaluation_errors,
        "answering_models": answering_models,
        "table_fingerprint": table_fingerprint,
        "usage_cost": lambda s, d: reports.usage(calls(s, d)),
        "usage_rollup": usage_rollup,
        "latency": latency,
        "event_counts": lambda s, d: reports.events(T.table(s, d, "events").withColumn("published_at", F.when(F.col("value") >= 10, F.col("ts")))),
        # streaming
        "stream_relay": stream_relay,
        "stream_dedup": stream_dedup,
        "stream_upsert": stream_upsert,
        "stream_replay": stream_replay,
        "stream_fingerprints": stream_fingerprints,
    }


def _scored_labels(spark, sf):
    rows = _evaluated(spark, sf)
    return evaluate.with_truth(rows.drop("predicted"), rows.select("doc_id", "predicted"), "doc_id")
