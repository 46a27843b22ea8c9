"""Driver tables and the ticket projection over `orders`.

The projection writes every order as a messy, text-only ticket row, so that all cleansing rules see
realistic input whose size follows the table. Some orders land more than once: as a re-submission
under a new id or as a corrected re-delivery of the same id. The CASE texts are valid in Spark SQL
and in the SQL of the result check alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# n = o_orderkey, v = copy (0 first delivery, 1 re-submission, 2 re-delivery), twin = low-information row
ROWS = {
    "twin": "n % 101 = 0",
    "ticket_id": "CASE WHEN v = 1 THEN 'TKT-' || CAST(n + 10000000 AS VARCHAR(20))"
                 " WHEN n % 401 = 0 THEN 'N/A' WHEN n % 397 = 0 THEN '' WHEN n % 389 = 0 THEN CAST(n AS VARCHAR(20))"
                 " WHEN n % 7 = 1 THEN '  TKT-' || CAST(n + 1000 AS VARCHAR(20)) || ' '"
                 " ELSE 'TKT-' || CAST(n + 1000 AS VARCHAR(20)) END",
    "category": "CASE WHEN n % 101 = 0 THEN CASE n % 3 WHEN 0 THEN 'HVAC' WHEN 1 THEN 'hvac ' ELSE 'Pest Control' END"
                " ELSE CASE n % 12 WHEN 0 THEN 'HVAC' WHEN 1 THEN 'hvac ' WHEN 2 THEN 'Pest Control'"
                " WHEN 3 THEN 'PEST  CONTROL' WHEN 4 THEN 'Electrical' WHEN 5 THEN 'Elec' WHEN 6 THEN 'Other'"
                " WHEN 7 THEN 'Plumbing' WHEN 8 THEN 'Lift' WHEN 9 THEN 'IT' WHEN 10 THEN 'Zeta Desk'"
                " ELSE 'Bugs in office Block ' || CAST(n % 17 AS VARCHAR(20)) END END",
    "priority": "CASE WHEN n % 101 = 0 THEN '' WHEN n % 613 = 0 THEN 'whatever'"
                " ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent!!!' WHEN '2-HIGH' THEN 'hi'"
                " WHEN '3-MEDIUM' THEN 'Med' WHEN '5-LOW' THEN 'LOW' ELSE '' END END",
    "status": "CASE WHEN v = 2 THEN 'Closed' WHEN n % 101 = 0 THEN '' WHEN n % 617 = 0 THEN 'weird'"
              " ELSE CASE o_orderstatus WHEN 'O' THEN 'In Progress' WHEN 'F' THEN 'Closed' ELSE 'Pending Vendor' END END",
    "building": "CASE WHEN n % 101 = 0 THEN 'Block 1' WHEN n % 307 = 0 THEN 'admin' WHEN n % 311 = 0 THEN 'unknown'"
                " ELSE 'Block ' || CAST(n % 17 AS VARCHAR(20)) END",
    "description": "CASE WHEN n % 509 = 0 THEN 'DELETE ME' WHEN n % 101 = 0 THEN 'bugs in office'"
                   " WHEN n % 12 = 11 THEN 'Pest' ELSE CASE n % 9"
                   " WHEN 0 THEN 'Breaker keeps tripping in server room ' || CAST(n % 900 AS VARCHAR(20)) || '. Critical — affects production systems.'"
                   " WHEN 1 THEN 'WiFi down on ' || CAST(n % 30 AS VARCHAR(20)) || ' floor, Block ' || CAST(n % 17 AS VARCHAR(20)) || '. Multiple users affected.'"
                   " WHEN 2 THEN 'Unit H-' || lpad(CAST(n % 1000 AS VARCHAR(20)), 3, '0') || ' cycling on and off every few minutes. Coils might be frozen.'"
                   " WHEN 3 THEN 'Hot water not working in block ' || CAST(n % 17 AS VARCHAR(20)) || '. Multiple sinks affected'"
                   " WHEN 4 THEN 'Power outlet not working at desk ' || CAST(n % 400 AS VARCHAR(20)) || '. Tried multiple devices.'"
                   " WHEN 5 THEN 'Sparking outlet in Block ' || CAST(n % 17 AS VARCHAR(20)) || ' — DO NOT USE, taped off'"
                   " WHEN 6 THEN 'Elevator A-' || lpad(CAST(n % 1000 AS VARCHAR(20)), 3, '0') || ' stuck between floors 2 and 9. No one inside (confirmed).'"
                   " WHEN 7 THEN 'N/A' ELSE 'Novel request about order ' || CAST(n AS VARCHAR(20)) END END",
    "submitted_by": "CASE WHEN v = 1 THEN 'Emily Brown' ELSE CASE o_custkey % 10 WHEN 0 THEN 'John Smith'"
                    " WHEN 1 THEN 'j. smith' WHEN 2 THEN 'Emily Brown' WHEN 3 THEN 'bob martinez'"
                    " WHEN 4 THEN 'Robert Martinez' WHEN 5 THEN 'admin' WHEN 6 THEN 'Cher' WHEN 7 THEN 'Ann Lee'"
                    " WHEN 8 THEN 'Abe Lee' ELSE 'A. Lee' END END",
    "assigned_to": "CASE WHEN n % 101 = 0 THEN '' ELSE CASE n % 8 WHEN 0 THEN 'ABC Mechanical' WHEN 1 THEN 'maintenance team'"
                   " WHEN 2 THEN 'CITYWIDE ELECTRIC' WHEN 3 THEN 'Unknown Crew' WHEN 4 THEN 'PestPro Services'"
                   " WHEN 5 THEN 'Joe (in-house)' WHEN 6 THEN 'vendor tech' ELSE '' END END",
    "resolution_notes": "CASE WHEN n % 101 = 0 THEN 'fixed' WHEN n % 13 = 0 THEN '' ELSE CASE n % 11"
                        " WHEN 0 THEN CASE WHEN n % 4 = 0 THEN 'Duplicate of ticket #99' || CAST(n AS VARCHAR(20)) || '. Closing.'"
                        " ELSE 'Duplicate of ticket #' || CAST(n + 980 AS VARCHAR(20)) || '. Closing.' END"
                        " WHEN 1 THEN 'Temporary fix applied' WHEN 2 THEN 'Issue could not be reproduced'"
                        " WHEN 3 THEN 'Parts on order. ETA ' || CAST(n % 30 + 1 AS VARCHAR(20)) || ' business days.' WHEN 4 THEN 'Vendor called. Scheduled for Monday'"
                        " WHEN 5 THEN 'Completed. Took ' || CAST(n % 9 AS VARCHAR(20)) || '.' || CAST(n % 10 AS VARCHAR(20)) || ' hours on site.'"
                        " WHEN 6 THEN 'Dispatched technician. Fixed on site. Replaced valve type ' || CAST(n % 50 AS VARCHAR(20)) || '.'"
                        " WHEN 7 THEN 'Resolved. Root cause: worn seal ' || CAST(n % 7 AS VARCHAR(20)) || '.' WHEN 8 THEN 'Resolved by reset.'"
                        " WHEN 9 THEN 'done' ELSE 'something novel' END END",
    "cost": "CASE WHEN n % 101 = 0 THEN '' WHEN n % 23 = 0 THEN '-1' WHEN n % 29 = 0 THEN 'abc'"
            " WHEN n % 31 = 0 THEN '5000000' WHEN n % 37 = 0 THEN 'TBD'"
            " WHEN n % 3 = 0 THEN '$1,' || lpad(CAST(n % 1000 AS VARCHAR(20)), 3, '0') || '.50'"
            " ELSE CAST(n % 5000 AS VARCHAR(20)) || '.25' END",
    "sla_hours": "CASE WHEN n % 101 = 0 THEN '' WHEN n % 19 = 0 THEN '0' WHEN n % 43 = 0 THEN '7.9' ELSE CASE n % 6"
                 " WHEN 0 THEN '24' WHEN 1 THEN '48' WHEN 2 THEN '8' WHEN 3 THEN '72' WHEN 4 THEN '999' ELSE 'x' END END",
    "source_file": "'batch_' || CAST(o_custkey % 3 AS VARCHAR(20)) || '.csv'",
}
# What was meant by a row, from the order alone; t is the time of the ticket. These never look at the texts above.
_TOLD = ("CASE n % 9 WHEN 0 THEN 'electrical' WHEN 1 THEN 'it_network' WHEN 2 THEN 'hvac' WHEN 3 THEN 'plumbing' WHEN 4 THEN 'electrical'"
         " WHEN 5 THEN 'electrical' WHEN 6 THEN 'elevator' ELSE 'unknown' END")
_UNUSABLE = "(n % 401 = 0 OR n % 397 = 0 OR n % 389 = 0)"
TRUTH = {
    "outcome": f"CASE WHEN n % 509 = 0 OR (v <> 1 AND {_UNUSABLE}) THEN 'quarantine' WHEN v = 1 AND NOT {_UNUSABLE} THEN 'duplicate' ELSE 'ticket' END",
    "ticket_id": "CASE WHEN v = 1 THEN 'TKT-' || CAST(n + 10000000 AS VARCHAR(20)) ELSE 'TKT-' || CAST(n + 1000 AS VARCHAR(20)) END",
    "survivor": "'TKT-' || CAST(n + 1000 AS VARCHAR(20))",
    "category": "CASE WHEN n % 101 = 0 THEN CASE WHEN n % 3 = 2 THEN 'pest_control' ELSE 'hvac' END"
                " WHEN n % 12 IN (0, 1) THEN 'hvac' WHEN n % 12 IN (2, 3, 11) THEN 'pest_control' WHEN n % 12 IN (4, 5) THEN 'electrical'"
                f" WHEN n % 12 = 7 THEN 'plumbing' WHEN n % 12 = 8 THEN 'elevator' WHEN n % 12 = 9 THEN 'it_network' ELSE {_TOLD} END",
    "created_at": "CASE WHEN n % 503 = 0 OR n % 499 = 0 THEN NULL"
                  " ELSE CASE CASE WHEN v = 1 THEN (n + 3) % 8 ELSE n % 8 END WHEN 2 THEN date_trunc('day', t) WHEN 4 THEN date_trunc('day', t)"
                  " WHEN 3 THEN date_trunc('minute', t) WHEN 6 THEN date_trunc('minute', t) ELSE t END END",
    "cost_usd": "CASE WHEN n % 101 = 0 OR n % 23 = 0 OR n % 29 = 0 OR n % 31 = 0 OR n % 37 = 0 THEN NULL"
                " WHEN n % 3 = 0 THEN 1000.5 + n % 1000 ELSE 0.25 + n % 5000 END",
    "drift": "n % 101 <> 0 AND n % 12 = 10",
}
CREATED_JUNK = "CASE WHEN n % 503 = 0 THEN 'asap' WHEN n % 499 = 0 THEN '13/45/2024' END"
RESOLVED_JUNK = "CASE WHEN o_orderstatus = 'O' OR n % 101 = 0 THEN '' WHEN n % 47 = 0 THEN '???' END"
FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy hh:mm a", "MM/dd/yyyy",
           "MM-dd-yyyy HH:mm:ss", "dd-MMM-yyyy HH:mm", None]

# Reviewed mappings that fit the projection: (label, kind, category, confidence)
LABELS = [
    ("hvac", "category_label", "hvac", 0.9), ("pest control", "category_label", "pest_control", 0.9),
    ("pest", "category_label", "pest_control", 0.9), ("electrical", "category_label", "electrical", 0.9),
    ("elec", "category_label", "electrical", 0.9), ("other", "generic_label", "unknown", 0.95),
    ("plumbing", "category_label", "plumbing", 0.9), ("lift", "category_label", "elevator", 0.9),
    ("it", "category_label", "it_network", 0.8),
]
# (template, category, issue_type, severity, is_safety_hazard, confidence)
TEMPLATES = [
    ("breaker keeps tripping in server room <n>. critical — affects production systems.", "electrical",
     "breaker_tripping", "critical", True, 0.95),
    ("wifi down on <n> floor, <bldg>. multiple users affected.", "it_network", "wifi_outage", "high", False, 0.9),
    ("unit <asset> cycling on and off every few minutes. coils might be frozen.", "hvac",
     "equipment_malfunction", "medium", False, 0.85),
    ("hot water not working in <bldg>. multiple sinks affected.", "plumbing", "hot_water_failure", "medium", False, 0.9),
    ("power outlet not working at desk <n>. tried multiple devices.", "electrical", "outlet_failure", "medium", False, 0.9),
    ("sparking outlet in <bldg> — do not use, taped off", "electrical", "outlet_sparking", "critical", True, 0.9),
    ("elevator <asset> stuck between floors <n> and <n>. no one inside (confirmed).", "elevator",
     "elevator_stuck", "critical", True, 0.95),
    ("bugs in office <bldg>", "pest_control", "bug_infestation", "medium", False, 0.7),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _write_time(t, k):
    """Text of a timestamp in format k; format 7 is epoch seconds."""
    from functools import reduce
    epoch = F.unix_seconds(t.cast("timestamp")).cast("string")
    cases = reduce(lambda acc, i: acc.when(k == i, F.date_format(t, FORMATS[i])), range(7), F)
    return cases.otherwise(epoch)


def _copies(orders: DataFrame) -> DataFrame:
    """Orders with the number of the copy and the times they name: t0 of the first delivery, t of this one."""
    copies = F.array_compact(F.array(
        F.lit(0), F.expr("CASE WHEN n % 33 = 0 AND n % 101 <> 0 THEN 1 END"), F.expr("CASE WHEN n % 211 = 0 THEN 2 END")))
    base = (orders.select(F.col("o_orderkey").alias("n"), "o_custkey", "o_orderstatus", "o_orderpriority",
                          F.col("o_orderdate").cast("timestamp_ntz").alias("d"))
            .withColumn("v", F.explode(copies)))
    seconds = F.expr("CAST(n * 7919 % 86400 AS DECIMAL(18,6))")
    shift = F.expr("CASE WHEN n % 211 = 3 THEN 0 ELSE 10000 END")
    later = shift + F.expr("CASE WHEN v = 1 THEN 9 ELSE 0 END")
    return base.withColumns({"t0": F.col("d") + F.make_dt_interval(shift, F.lit(0), F.lit(0), seconds),
                             "t": F.col("d") + F.make_dt_interval(later, F.lit(0), F.lit(0), seconds)})


def truth(orders: DataFrame) -> DataFrame:
    """What every row of `raw_tickets` should become; a corrected re-delivery is the same ticket. Rows to be quarantined have no id."""
    rows = _copies(orders).select("n", "v", *[F.expr(x.replace("VARCHAR(20)", "STRING")).alias(c) for c, x in TRUTH.items()])
    key = F.when(F.col("outcome") == "quarantine", F.concat_ws(" ", F.lit("row"), "n", "v")).otherwise(F.col("ticket_id"))
    return (rows.filter((F.col("v") < 2) | (F.col("outcome") == "quarantine")).withColumn("ticket_id", key)
            .withColumns({"created_at": F.col("created_at").cast("timestamp_ntz"), "cost_usd": F.col("cost_usd").cast("double")}).drop("n", "v"))


def raw_tickets(orders: DataFrame) -> DataFrame:
    """bronze_id, the 13 source columns, row_hash, source_file. One scan; copies come from an explode."""
    base, t0, t = _copies(orders), F.col("t0"), F.col("t")
    resolved = t0 + F.make_dt_interval(F.lit(0), F.expr("CAST(n * 31 % 2000 - 400 AS INT)"), F.lit(0), F.lit(0).cast("decimal(18,6)"))
    k = F.expr("CASE WHEN v = 1 THEN (n + 3) % 8 ELSE n % 8 END")
    created_text = F.coalesce(F.expr(CREATED_JUNK), _write_time(t, k))
    resolved_text = F.coalesce(F.expr(RESOLVED_JUNK), _write_time(resolved, F.expr("CASE WHEN n % 2 = 0 THEN 1 ELSE 7 END")))
    cols = {k_: F.expr(v.replace("VARCHAR(20)", "STRING")) for k_, v in ROWS.items() if k_ != "twin"}
    rows = base.select(
        F.expr("n + v * 1000000000000").alias("bronze_id"),
        cols["ticket_id"].alias("ticket_id"), created_text.alias("created_at"), resolved_text.alias("resolved_at"),
        *[cols[c].alias(c) for c in ("category", "priority", "status", "building", "description", "submitted_by",
                                     "assigned_to", "resolution_notes", "cost", "sla_hours", "source_file")])
    return rows


def label_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABELS, "label string, label_kind string, category string, confidence double")


def template_map(spark: SparkSession) -> DataFrame:
    rows = [(*t, i) for i, t in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "template string, category string, issue_type string, severity string, "
                                       "is_safety_hazard boolean, confidence double, map_order int")
