"""Person resolution: spelling variants of one submitter become one display name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright.functions import clean


def people_map(rows: DataFrame, name: str = "submitted_by", row_id: str = "bronze_id") -> DataFrame:
    """One row per distinct spelling: raw_name, resolved, flag, uses.

    The key of a person is (initial after nickname expansion, surname); the display name is the most
    frequent full spelling, the earliest row deciding a tie. A key with two different first names is
    ambiguous and nobody is guessed. All steps run on distinct spellings with partial aggregation.
    """
    # the conditions mention the count so that they stay above the aggregate: on distinct spellings, not rows
    used = F.col("uses") > 0
    named = ~F.lower("text").isin(fv.SYSTEM_ACCOUNTS)
    spellings = (rows.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("raw_name"))
                 .agg(F.count("*").alias("uses"), F.min(row_id).alias("first_row"))
                 .withColumn("text", clean.clean_text(F.col("raw_name")))
                 .filter(F.when(used, F.col("text")).isNotNull())
                 .withColumn("parts", F.when(named, clean.name_parts(F.col("text"))))
                 .withColumn("first", clean.first_name(F.col("parts")))
                 .withColumn("expanded", clean.expand_nickname(F.col("first")))
                 .withColumn("display", F.when(F.col("first").isNotNull(), F.initcap("text"))))
    person = F.concat_ws("\u001f", F.substring("expanded", 1, 1), F.lower(F.element_at("parts", -1)))
    # the key mentions the count too: the join below wants it not null, which would be asked of every row
    keyed = spellings.withColumn("key", F.when(used & F.col("first").isNotNull(), person)
                                 .when(used, F.concat(F.lit("\u0000"), F.col("raw_name"))))
    displays = (keyed.filter(F.when(used, F.length("first")) > 1).groupBy("key", "display")
                .agg(F.sum("uses").alias("n"), F.min("first_row").alias("first_row"),
                     F.min("expanded").alias("lo"), F.max("expanded").alias("hi")))
    people = (displays.groupBy("key")
              .agg(F.max_by("display", F.struct(F.col("n"), -F.col("first_row"))).alias("canonical"),
                   (F.min("lo") != F.max("hi")).alias("ambiguous")))
    known = F.coalesce(~F.col("ambiguous"), F.lit(False))
    nobody = F.lit(None).cast("string")
    resolved = (F.when(~named, nobody).when(F.col("display").isNull(), F.col("text"))
                .when(known, F.col("canonical")).otherwise(F.col("display")))
    flag = (F.when(~named, "submitter_system_account").when(F.col("display").isNull(), "submitter_unparsed")
            .when(~known, "submitter_ambiguous"))
    return keyed.join(people, "key", "left").select(
        "raw_name", resolved.alias("submitted_by"), flag.alias("submitter_flag"), "uses")
