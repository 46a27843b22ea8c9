"""Landing: files as they are, with content hash, lineage, row hash, manifest and schema drift.

All files of a batch land together, in the same few jobs whatever their number: one pass surveys them (headers, row numbers,
content keys), the manifest is looked at once, one write adds their rows, each file to a partition of its own, and one entry for
each file ends the batch. A table of the 128-bit hashes that each batch brought tells which rows landed before, so that older
rows are not read. A batch that broke off is repeated under the same numbers and replaces what it left.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.sources import delimited

EXTRA = "_extra_fields"
# bronze_id is landing_seq * SEQ_STEP + row_no, so files cannot meet
SEQ_STEP, MOST_FILES = 2**40, 2**23
MANIFEST = ("source string, file_sha256 string, path string, header array<string>, header_fingerprint string, "
            "row_count bigint, drift_added array<string>, drift_removed array<string>, run_id string, "
            "landing_seq bigint, ingested_at timestamp")
_HASHES = "h binary, landing_seq bigint, rows bigint, part_source string, batch bigint"


@dataclass
class Landed:
    rows_in: int
    rows_out: int
    file_sha256: str
    skipped: bool = False
    repeated: int = 0
    drift: dict | None = None
    alerts: list[str] = field(default_factory=list)


def read_header(spark: SparkSession, path: str) -> list[str]:
    return next(iter(delimited.survey(spark, [path]).values())).header


def read_rows(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """row_no, payload MAP: every value as text, nothing trimmed, empty text kept apart from missing."""
    rows = delimited.records(spark, delimited.survey(spark, [path]))
    return rows.select("row_no", delimited.payload(F.array(*[F.lit(h) for h in header]), F.col("fields"), F.col("surplus"), EXTRA).alias("payload"))


def header_fingerprint(header: list[str]) -> Column:
    return F.substring(F.sha2(F.to_json(F.array(*[F.lit(h) for h in header])), 256), 1, 16)


def row_hash(payload: Column) -> Column:
    """sha256 over the key-sorted entries; NULL and empty text stay different."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(payload))), 256)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


BRONZE = ("bronze_id bigint, source string, source_file string, file_sha256 string, row_no bigint, "
          "payload map<string,string>, row_hash string, run_id string, ingested_at timestamp, part_source string, landing_seq bigint")


def land(spark: SparkSession, path: str, source: str, root: str, run_id: str) -> Landed:
    """Append one file to `root`/bronze unless its content is already there; keep the manifest."""
    return land_files(spark, [path], source, root, run_id)[0]


def land_files(spark: SparkSession, paths: list[str | list[str]], source: str, root: str, run_id: str) -> list[Landed]:
    """Append files to `root`/bronze in the order given, but for content that has landed from this source before, or earlier
    in the list. What is said of a file is as if they had landed one after the other. At most MOST_FILES files of a source.
    A file in parts is the list of their paths, in order; it goes by the name of the first."""
    bronze_path, manifest_path, hashes_path = (f"{root}/{name}" for name in ("bronze", "manifest", "hashes"))
    surveyed = delimited.survey(spark, paths)
    files = [surveyed[delimited.plain(delimited.pieces_of(p)[0])] for p in paths]
    known, header, seq = _landed(_table(spark, manifest_path, MANIFEST).filter(F.col("source") == source), [f.key for f in files])
    batch, out, new = seq + 1, [], []
    for f in files:
        if f.key in known:
            out.append(Landed(known[f.key], 0, f.key, skipped=True))
            continue
        drift = None
        if header is not None and header != f.header:
            drift = {"added": [c for c in f.header if c not in header], "removed": [c for c in header if c not in f.header]}
        name, header, seq, known[f.key] = f.path.rsplit("/", 1)[-1], f.header, seq + 1, f.rows
        alerts = [f"{name}: columns new {drift['added']}, gone {drift['removed']}"] if drift else []
        out.append(Landed(f.rows, f.rows, f.key, drift=drift, alerts=alerts))
        new.append((f, name, seq, out[-1]))
    if seq >= MOST_FILES:
        raise ValueError(f"{MOST_FILES} files of {source} have landed: begin a new source")
    if not new:
        return out
    # one row for each file of the batch
    about = spark.createDataFrame([(delimited.plain(f.path), name, f.key, f.header, number) for f, name, number, _ in new],
                                  "path string, source_file string, file_sha256 string, header array<string>, landing_seq bigint")
    rows = delimited.records(spark, {delimited.plain(f.path): f for f, *_ in new}).join(F.broadcast(about), "path")
    rows = rows.withColumn("payload", delimited.payload(F.col("header"), F.col("fields"), F.col("surplus"), EXTRA))
    stamped = rows.select(
        (F.col("landing_seq") * F.lit(SEQ_STEP) + F.col("row_no")).alias("bronze_id"), F.lit(source).alias("source"), "source_file", "file_sha256",
        "row_no", "payload", row_hash(F.col("payload")).alias("row_hash"), F.lit(run_id).alias("run_id"), F.current_timestamp().alias("ingested_at"),
        F.lit(source).alias("part_source"), "landing_seq")
    _replace(stamped, bronze_path, "part_source", "landing_seq")
    numbers = [number for *_, number, _ in new]
    mine = _table(spark, bronze_path, BRONZE).filter((F.col("part_source") == source) & F.col("landing_seq").between(numbers[0], numbers[-1]))
    older = _table(spark, hashes_path, _HASHES).filter((F.col("part_source") != source) | (F.col("batch") < batch))
    own = mine.groupBy(_short(F.col("row_hash")).alias("h"), "landing_seq").agg(F.count("*").alias("rows"))
    _replace(own.select("h", "landing_seq", "rows", F.lit(source).alias("part_source"), F.lit(batch).alias("batch")), hashes_path, "part_source", "batch")
    own = _table(spark, hashes_path, _HASHES).filter((F.col("part_source") == source) & (F.col("batch") == batch))
    repeated = {r["landing_seq"]: r["n"] for r in _repeated(own, older).collect()}
    for _, _, number, done in new:
        done.repeated = repeated.get(number, 0)
    entries = spark.createDataFrame(
        [(source, f.key, f.path, f.header, f.rows, (d.drift or {}).get("added"), (d.drift or {}).get("removed"), run_id, number) for f, _, number, d in new],
        "source string, file_sha256 string, path string, header array<string>, row_count bigint, drift_added array<string>, "
        "drift_removed array<string>, run_id string, landing_seq bigint")
    fingerprint = F.substring(F.sha2(F.to_json("header"), 256), 1, 16)
    (entries.withColumns({"header_fingerprint": fingerprint, "ingested_at": F.current_timestamp()}).coalesce(1).write.mode("append").parquet(manifest_path))
    return out


def _landed(manifest: DataFrame, keys: list[str]) -> tuple[dict[str, int], list[str] | None, int]:
    """What the manifest of a source knows: rows of the given contents, the newest header, the last number."""
    asked = F.when(F.col("file_sha256").isin(keys), F.struct("file_sha256", "row_count"))
    row = manifest.agg(F.collect_list(asked).alias("known"), F.max_by("header", "landing_seq").alias("header"), F.max("landing_seq").alias("seq")).first()
    return {r["file_sha256"]: r["row_count"] for r in row["known"]}, row["header"], row["seq"] or 0


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write the partitions that the rows have; a repeat of a broken attempt replaces what that left behind."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _short(row_hash: Column) -> Column:
    """The first 128 bits of a row hash, which no two rows share by chance."""
    return F.unhex(F.substring(row_hash, 1, 32))


def _repeated(own: DataFrame, older: DataFrame) -> DataFrame:
    """(landing_seq, n): how many rows of each file have content that an older batch or an earlier file of this one brought.

    `own` has a row for each content and file, so that a content delivered very often weighs one row; the other side of the
    joins has one row for each content.
    """
    first = own.groupBy("h").agg(F.min("landing_seq").alias("first"))
    before = older.select("h").join(first.select("h"), "h", "left_semi").distinct().withColumn("before", F.lit(True))
    met = own.join(first, "h").join(before, "h", "left").filter((F.col("first") < F.col("landing_seq")) | F.col("before"))
    return met.groupBy("landing_seq").agg(F.sum("rows").alias("n"))


def seen_before(rows: DataFrame, all_rows: DataFrame, file: str = "file_sha256") -> DataFrame:
    """Rows whose content hash also occurs in another file.

    Per hash the smallest and the largest file name are enough to know that, so the lookup side is one
    row per hash and a content that was delivered very often does not multiply.
    """
    spread = all_rows.groupBy(F.col("row_hash").alias("_h")).agg(F.min(file).alias("_lo"), F.max(file).alias("_hi")).filter(F.col("_lo") != F.col("_hi"))
    return rows.join(spread.select("_h"), F.col("row_hash") == F.col("_h"), "left_semi")


def flat_view(bronze: DataFrame, columns: list[str]) -> DataFrame:
    """The named payload keys as columns beside the lineage."""
    return bronze.select("bronze_id", *[F.try_element_at("payload", F.lit(c)).alias(c) for c in columns],
                         "payload", "row_hash", "source_file")
