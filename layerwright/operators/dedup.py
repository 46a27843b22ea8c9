"""Duplicate decisions on narrow rows: same id (D1), same improbable content (D2), dangling references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright import session
from layerwright.functions import clean
from layerwright.operators import skew


# Up to this many 64-bit hashes of repeated keys, rows of all other keys are told apart before anything wide is sorted.
REPEATED_KEYS = 2_000_000


def _repeated(rows: DataFrame, key: str) -> DataFrame | None:
    """Hashes of the keys that several rows have, to be broadcast; None if there are too many. A key that only one row has
    may share such a hash, so what is taken for repeated is still to be counted by the key itself."""
    codes = rows.select(F.xxhash64(key).alias("_code")).groupBy("_code").agg(F.count("*").alias("n")).filter("n > 1").select("_code")
    codes = session.staged(codes, f"repeated-{key.replace('_', '-')}")
    return codes if codes.limit(REPEATED_KEYS + 1).count() <= REPEATED_KEYS else None


def _of_repeated(rows: DataFrame, key: str, codes: DataFrame, how: str = "left_semi") -> DataFrame:
    return rows.withColumn("_code", F.xxhash64(key)).join(F.broadcast(codes), "_code", how).drop("_code")


def fingerprint(values: Column) -> Column:
    return F.sha2(F.array_join(values, "\u001f"), 256)


def narrow(valid: DataFrame) -> DataFrame:
    """What the decisions need of a valid row: id, number, the ticket that its note names, and the cleaned lower-case
    values of the fields a re-submission does not change."""
    fields = {f"c_{f}": f for f in fv.FINGERPRINT_FIELDS}
    rows = clean.with_clean(valid.withColumn("tid", clean.ticket_id(F.col("ticket_id"))), fields)
    content = F.array(*[F.coalesce(F.lower(c), F.lit("")) for c in fields])
    return (rows.select("bronze_id", F.col("tid").alias("ticket_id"), clean.ticket_number(F.col("tid")).alias("ticket_number"),
                        clean.duplicate_reference(F.col("c_resolution_notes")).alias("duplicate_of_ticket_id"), content.alias("content"))
            .withColumn("fingerprint", fingerprint(F.col("content"))))


def latest_per_id(slim: DataFrame) -> DataFrame:
    """D1: the row that landed last per ticket id. A plain maximum, so the map side already reduces an id
    that was delivered very often to one row per task. A maximum of whole rows sorts them, so ids that came once
    are left out of it."""
    columns = ["bronze_id", "ticket_number", "fingerprint", "content"]
    codes = _repeated(slim, "ticket_id")
    several = slim if codes is None else _of_repeated(slim, "ticket_id", codes)
    newest = several.groupBy("ticket_id").agg(F.max(F.struct(*columns)).alias("w")).select("ticket_id", "w.*")
    if codes is None:
        return newest
    return newest.unionByName(_of_repeated(slim, "ticket_id", codes, "left_anti").select("ticket_id", *columns))


def superseded(slim: DataFrame, latest: DataFrame) -> DataFrame:
    """D1 audit rows. Anti join on the unique row id, not on the ticket id, so a hot id does no harm."""
    return (slim.select("bronze_id", "ticket_id").join(latest.select("bronze_id"), "bronze_id", "left_anti")
            .select("bronze_id", F.col("ticket_id").alias("duplicate_ticket_id"),
                    F.col("ticket_id").alias("survivor_ticket_id"), F.lit(fv.RULE_SAME_ID).alias("match_rule")))


def value_frequencies(latest: DataFrame) -> DataFrame:
    """How often each non-empty value occurs per field among the rows left by D1."""
    return (latest.select(F.posexplode("content").alias("field_no", "value")).filter(F.col("value") != "")
            .groupBy("field_no", "value").agg(F.count("*").alias("n")))


def repeated_content(latest: DataFrame) -> DataFrame:
    """One row per fingerprint that occurs more than once, with the survivor (lowest number, then row). Content that
    occurs once stays out of the sort behind the minimum."""
    codes = _repeated(latest, "fingerprint")
    latest = latest if codes is None else _of_repeated(latest, "fingerprint", codes)
    keep = F.min(F.struct("ticket_number", "bronze_id", "ticket_id")).alias("keep")
    return (latest.groupBy("fingerprint").agg(F.count("*").alias("copies"), keep, F.min("content").alias("content"))
            .filter(F.col("copies") > 1))


def information_bits(groups: DataFrame, latest: DataFrame) -> DataFrame:
    """Bits per repeated fingerprint: sum over its non-empty values of -log2(share of rows with it)."""
    total = latest.agg(F.count("*")).scalar().cast("double")
    key = F.concat_ws("\u001f", F.col("field_no").cast("string"), F.col("value"))
    freq = value_frequencies(latest).select(key.alias("field_value"), "n", F.col("n").alias("uses"))
    parts = (groups.select("fingerprint", F.posexplode("content").alias("field_no", "value"))
             .filter(F.col("value") != ""))
    met = skew.spread_join(parts, freq, key, "field_value", "uses", F.concat("fingerprint", F.col("field_no").cast("string")))
    bits = met.groupBy("fingerprint").agg(F.sum(-F.log2(F.col("n") / total)).alias("bits"))
    return groups.join(bits, "fingerprint", "left").withColumn("bits", F.coalesce("bits", F.lit(0.0)))


def content_decisions(latest: DataFrame, safety_bits: float = fv.DEDUP_SAFETY_BITS) -> DataFrame:
    """Per repeated fingerprint: merge, or keep all because a coincidence is plausible."""
    total = latest.agg(F.count("*")).scalar()
    return (information_bits(repeated_content(latest), latest)
            .withColumn("merge", F.col("bits") >= clean.information_threshold(total, safety_bits)))


def content_outcomes(latest: DataFrame, safety_bits: float = fv.DEDUP_SAFETY_BITS) -> DataFrame:
    """D2 per row of a repeated fingerprint: flag, or the ticket it is merged into."""
    rules = content_decisions(latest, safety_bits).select(
        "fingerprint", "copies", "merge", F.col("keep.bronze_id").alias("keep_row"),
        F.col("keep.ticket_id").alias("keep_ticket"))
    rows = latest.select("bronze_id", "ticket_id", "fingerprint")
    met = skew.spread_join(rows, rules, F.col("fingerprint"), "fingerprint", "copies", F.col("bronze_id"))
    first = F.col("bronze_id") == F.col("keep_row")
    return met.filter(F.col("keep_row").isNotNull()).select(
        "bronze_id", "ticket_id",
        F.when(F.col("merge") & ~first, F.col("keep_ticket")).alias("survivor_ticket_id"),
        F.when(~F.col("merge"), "possible_duplicate").when(first, "has_resubmitted_duplicates").alias("dup_flag"))


def references(slim: DataFrame) -> DataFrame:
    """Narrow rows whose note names a ticket."""
    return slim.select("bronze_id", "duplicate_of_ticket_id").filter(F.col("duplicate_of_ticket_id").isNotNull())


def missing_references(refs: DataFrame, slim: DataFrame) -> DataFrame:
    """Rows whose note names a ticket that exists neither as ticket nor as audited duplicate.

    `refs` has bronze_id and duplicate_of_ticket_id. The distinct references meet the ids once.
    """
    wanted = refs.groupBy("duplicate_of_ticket_id").agg(F.count("*").alias("uses"))
    ids = slim.select(F.col("ticket_id").alias("duplicate_of_ticket_id")).distinct()
    gone = wanted.join(ids, "duplicate_of_ticket_id", "left_anti").withColumn("ref_missing", F.lit(True))
    met = skew.spread_join(refs, gone, F.col("duplicate_of_ticket_id"), "duplicate_of_ticket_id", "uses",
                           F.col("bronze_id"))
    return met.filter("ref_missing").select("bronze_id")


def duplicates(slim: DataFrame, latest: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The audit table: every removed row with its survivor and the rule."""
    merged = outcomes.filter(F.col("survivor_ticket_id").isNotNull()).select(
        "bronze_id", F.col("ticket_id").alias("duplicate_ticket_id"), "survivor_ticket_id",
        F.lit(fv.RULE_SAME_CONTENT).alias("match_rule"))
    return superseded(slim, latest).unionByName(merged)
