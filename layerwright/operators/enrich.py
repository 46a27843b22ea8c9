"""Reference lookups: swapped fields, templates, category resolution, keyword classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import fixed_values as fv
from layerwright import session
from layerwright.functions import clean
from layerwright.operators import skew


# letters of the pieces by which names are found in texts; a name takes a longer one than SIZES[1] only if each shorter one is in more than FEW names
SIZES, FEW = (5, 8, 16, 32), 1_000


# ------------------------------------------------------------------ building names
def known_buildings(raw: DataFrame) -> DataFrame:
    """Distinct cleaned names over all landed rows, without junk."""
    name = clean.clean_text(F.col("building"))
    return (raw.select(name.alias("name")).filter(F.col("name").isNotNull() & ~clean.junk_text(F.col("name")))
            .distinct())


def _quoted(name: Column) -> Column:
    """Literal, case-insensitive pattern of a name."""
    return F.concat(F.lit(r"(?iu)\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _needed(name: Column) -> Column:
    """The longest part of a name, in lower case, that a text must hold for the name to match while it is being masked.

    An inserted placeholder can only stand for parts that are pieces of it; what is left must come from the text.
    """
    inner = F.regexp_replace(F.lower(name), r"^(?:bldg|ldg|dg|g)?>", "\u0001")
    inner = F.regexp_replace(inner, r"<(?:b|bl|bld|bldg)?$", "\u0001")
    parts = F.split(F.regexp_replace(inner, "<bldg>", "\u0001"), "\u0001", -1)
    longest = F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    low = F.lower(name)
    return F.when(F.contains(F.lit("<bldg>"), low), F.lit("")).when(
        F.contains(low, F.lit("<")) | F.contains(low, F.lit(">")), longest).otherwise(low)


def _mask(text: Column, patterns: Column) -> Column:
    return F.aggregate(patterns, text, lambda acc, p: F.regexp_replace(acc, p, F.lit("<bldg>")))


def _longest_first(names: Column) -> Column:
    """Patterns of the names, in the order in which they are masked."""
    entries = F.transform(names, lambda n: F.struct((-F.length(n)).alias("rank"), n.alias("name")))
    return F.transform(F.array_sort(entries), lambda e: _quoted(e["name"]))


def _cut(text: Column, size: int) -> Column:
    """The pieces of a text that have the size, as 64-bit hashes."""
    # a text shorter than the size gives itself, which is no anchor of that size
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.transform(places, lambda i: F.xxhash64(F.substring(text, i, F.lit(size))))


def _offered(needed: Column) -> Column:
    """size, anchor: the pieces under which a name may stand in the index. A short name is its own anchor."""
    n, kind = F.length(needed), "array<struct<size:int,anchor:bigint>>"

    def sized(size: int) -> Column:
        return F.transform(_cut(needed, size), lambda h: F.struct(F.lit(size).alias("size"), h.alias("anchor")))

    long = F.concat(sized(SIZES[1]), *[F.when(n >= size, sized(size)).otherwise(F.array().cast(kind)) for size in SIZES[2:]])
    whole = F.array(F.struct(n.alias("size"), F.xxhash64(needed).alias("anchor")))
    return F.array_distinct(F.when(n < SIZES[0], whole).when(n < SIZES[1], sized(SIZES[0])).otherwise(long))


def _anchors(names: DataFrame) -> DataFrame:
    """anchor, size, name, needed: each name under the piece of what a text needs that the fewest names have, short pieces first as long
    as few names have them. Pieces are counted and chosen as numbers."""
    numbered = session.staged(names.withColumn("id", F.monotonically_increasing_id()), "numbered-names")
    pieces = numbered.select("id", F.explode(_offered(F.col("needed"))).alias("p")).select("id", "p.size", "p.anchor")
    uses = pieces.groupBy("anchor").agg(F.count("*").alias("uses"))
    rank = F.struct(F.when(F.col("uses") <= FEW, F.col("size")).otherwise(SIZES[-1] + 1).alias("order"), "uses", "anchor", "size")
    best = pieces.join(uses.hint("merge"), "anchor").groupBy("id").agg(F.min(rank).alias("best"))
    return best.join(numbered.hint("merge"), "id").select("best.anchor", "best.size", "name", "needed")


def with_template(rows: DataFrame, names: DataFrame, text: str = "description", out: str = "description_template",
                  row_id: str = "bronze_id") -> DataFrame:
    """Add the masked template of a text; '' when there is no text. The same way for any number of names.

    Each name stands in an index under one anchor: a piece of few possible lengths that the fewest names have, as a hash. Each distinct
    text asks for its pieces of those lengths, whatever lengths the names have, and the names found are looked for in the
    text itself. So work grows with the text and never with text x names or text x lengths; what is shuffled for a piece is
    two numbers. The names that are there are then masked one after the other, longest first.
    """
    texts = rows.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.count("*").alias("uses"))
    # the pieces and the masking both read the distinct texts: found once
    texts = session.staged(texts.withColumn("text_id", F.monotonically_increasing_id()), "texts")
    keyed = session.staged(_anchors(names.filter(F.length("name") > 0).select("name", _needed(F.col("name")).alias("needed")).distinct()), "names")
    # names that are pieces of the placeholder itself: their letters bound how many there can be of a length
    always = sorted(r[0] for r in keyed.filter("needed = ''").select("name").collect())
    fixed = F.array(*map(F.lit, always)) if always else F.array().cast("array<string>")
    # what a text needs is mostly the name itself and then not sent along
    part = F.when(F.col("needed") != F.lower("name"), F.col("needed")).alias("part")
    anchors = keyed.filter("needed <> ''").select("anchor", "name", part)
    # at most SIZES[0] - 1 + len(SIZES) numbers: shorter names are their own anchor
    sizes = sorted(r[0] for r in keyed.filter("needed <> ''").select("size").distinct().collect())
    pieces = (texts.select("text_id", F.explode(F.array_distinct(F.concat(*[_cut(F.lower("text"), n) for n in sizes]))).alias("anchor")) if sizes
              else texts.limit(0).select("text_id", F.lit(0).cast("long").alias("anchor")))
    met = pieces.join(F.broadcast(anchors) if skew.fits(anchors) else anchors.hint("merge"), "anchor")
    per_text = met.groupBy("text_id").agg(F.collect_set(F.struct("name", "part")).alias("found"))
    found = F.coalesce("found", F.array().cast("array<struct<name:string,part:string>>"))
    there = F.filter(found, lambda e: F.contains(F.lower("text"), F.coalesce(e["part"], F.lower(e["name"]))))
    named = F.array_distinct(F.concat(F.transform(there, lambda e: e["name"]), fixed))
    # merge: a table that is small when packed is many times that as a list of names in one process
    masked = (texts.join(per_text.hint("merge"), "text_id", "left")
              .select("text", "uses", clean.mask_variables(_mask(F.col("text"), _longest_first(named))).alias(out)))
    # three steps of the join read it: masked once
    masked = session.staged(masked, "masked")
    joined = skew.spread_join(rows, masked, F.col(text), "text", "uses", F.col(row_id))
    return joined.withColumn(out, F.coalesce(out, F.lit("")))


# ------------------------------------------------------------------ label and template maps
def label_lookup(labels: DataFrame) -> DataFrame:
    return labels.select("label", F.struct("label_kind", "category", "confidence").alias("info"))


def template_index(templates: DataFrame) -> DataFrame:
    """Template map extended by the prefixes that name exactly one category.

    Turns the prefix rule (a truncated text of 25 characters or more inherits the mapping when all
    templates that start with it agree on the category) into an equality lookup. Size: the characters
    of the map, not templates squared.
    """
    info = F.struct("category", "issue_type", "severity", "is_safety_hazard", "confidence")
    base = templates.select("template", info.alias("info"), "map_order")
    exact = base.select(F.col("template").alias("key"), "info", "map_order", F.lit(True).alias("exact"))
    cuts = F.when(F.length("template") >= fv.MIN_PREFIX, F.sequence(F.lit(fv.MIN_PREFIX), F.length("template")))
    prefix = (base.select("template", "info", "map_order", F.explode(cuts).alias("n"))
              .select(F.col("template").substr(F.lit(1), F.col("n")).alias("key"), "info", "map_order",
                      F.lit(False).alias("exact")))
    # a template is also a prefix of itself, so the category test sees every template that starts with the key
    merged = exact.unionByName(prefix).groupBy("key").agg(
        F.max_by("info", F.when(F.col("exact"), -F.col("map_order"))).alias("own"),
        F.max(F.col("exact")).alias("has_own"),
        F.min("info.category").alias("lo"), F.max("info.category").alias("hi"),
        F.min_by("info", "map_order").alias("first"))
    chosen = F.when(F.col("has_own"), F.col("own")).when(F.col("lo") == F.col("hi"), F.col("first"))
    return merged.select(F.col("key").alias("template"), chosen.alias("tmpl")).filter(F.col("tmpl").isNotNull())


def detect_swap(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows whose category holds a sentence while the description is empty or a known label are put right.

    Adds label_key, description (cleaned), swapped and label (struct of the mapping or NULL). The label
    map is reviewed by people; its size is checked before the broadcast.
    """
    info = label_lookup(labels)
    small = skew.fits(info)
    r = (rows.withColumn("_cat_key", clean.normalize_label(F.col("category")))
         .withColumn("_desc", clean.clean_text(F.col("description")))
         .withColumn("_desc_key", F.coalesce(F.lower("_desc"), F.lit(""))))  # cleaned already
    for key, out in (("_cat_key", "_cat_info"), ("_desc_key", "_desc_info")):
        side = info.select(F.col("label").alias("_label"), F.col("info").alias(out))
        if small:
            r = r.join(F.broadcast(side), F.col(key) == F.col("_label"), "left").drop("_label")
        else:
            uses = rows.select((clean.normalize_label(F.col("category")) if out == "_cat_info" else
                                clean.normalize_label(clean.clean_text(F.col("description")))).alias("_label"))
            weights = uses.groupBy("_label").agg(F.count("*").alias("_uses"))
            r = skew.spread_join(r, side.join(weights, "_label"), F.col(key), "_label", "_uses", F.col("bronze_id"))
    sentence = F.coalesce(F.col("_cat_info.label_kind") == "description_text",
                          clean.word_count(F.col("_cat_key")) >= 4)
    desc_is_label = F.coalesce(F.col("_desc_info.label_kind").isin("category_label", "generic_label"), F.lit(False))
    swapped = sentence & (F.col("_desc").isNull() | desc_is_label)
    return (r.withColumn("swapped", swapped)
            .withColumn("label_key", F.when(F.col("swapped"), F.col("_desc_key")).otherwise(F.col("_cat_key")))
            .withColumn("label", F.when(F.col("swapped"), F.col("_desc_info")).otherwise(F.col("_cat_info")))
            .withColumn("_eff", F.when(F.col("swapped"), clean.clean_text(F.col("category"))).otherwise(F.col("_desc")))
            .drop("description", "_cat_key", "_desc", "_desc_key", "_cat_info", "_desc_info")
            .withColumnRenamed("_eff", "description"))


def swap_candidates(rows: DataFrame) -> DataFrame:
    """Short descriptions on rows whose category looks like a sentence: possible labels."""
    words = clean.word_count(F.col("description"))
    return (rows.filter((clean.word_count(F.col("category")) >= 4) & words.between(1, 3))
            .select(clean.normalize_label(F.col("description")).alias("label")).distinct())


def with_template_info(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Add tmpl, the mapping of the description template (exact or unique prefix)."""
    index = template_index(templates)
    key = F.when(F.col("description").isNotNull(), F.col("description_template"))
    small = skew.fits(index)
    if not small:
        uses = rows.groupBy(F.col("description_template").alias("template")).agg(F.count("*").alias("_uses"))
        index = index.join(uses, "template")
    else:
        index = index.withColumn("_uses", F.lit(0))
    return skew.lookup_join(rows, index, key, "template", "_uses", F.col("bronze_id"), small)


# ------------------------------------------------------------------ category, assignee
def related(a: Column, b: Column) -> Column:
    pairs = ["|".join(sorted(p)) for p in fv.RELATED]
    return (a == b) | F.concat_ws("|", F.least(a, b), F.greatest(a, b)).isin(pairs)


def assignee_name(text: Column) -> Column:
    """Display name from the master data; unknown parties stay as typed."""
    return F.coalesce(clean.lookup({k: v[0] for k, v in fv.ASSIGNEES.items()}, F.lower(text)), text)


def assignee_type(text: Column) -> Column:
    return clean.lookup({k: v[1] for k, v in fv.ASSIGNEES.items()}, F.lower(text))


def qualified(party: Column, category: Column) -> Column:
    """Three-valued: NULL when nothing is known about the party."""
    allowed = F.create_map(*[x for p, cats in fv.QUALIFIED_FOR.items()
                             for x in (F.lit(p), F.array(*[F.lit(c) for c in cats]))])
    return F.array_contains(F.try_element_at(allowed, party), category)


def resolve_category(rows: DataFrame) -> DataFrame:
    """An informative label wins, then the description; unrelated answers are a conflict.

    Reads label and tmpl; adds category, category_source, category_confidence, category_from_description,
    category_conflict. The landed category must not be in the frame any more.
    """
    informative = (F.col("label.label_kind").isin("category_label", "description_text")
                   & (F.col("label.category") != "unknown"))
    by_label, from_desc = F.col("_by_label"), F.col("category_from_description")
    return (rows.withColumn("_by_label", F.coalesce(informative, F.lit(False)))
            .withColumn("category_from_description", F.when(F.col("tmpl.category") != "unknown", F.col("tmpl.category")))
            .withColumn("category", F.when(by_label, F.col("label.category")).otherwise(F.coalesce(from_desc, F.lit("unknown"))))
            .withColumn("category_source", F.when(by_label, "label_map").when(from_desc.isNotNull(), "description_template")
                        .otherwise("unresolved"))
            .withColumn("category_confidence", F.when(by_label, F.col("label.confidence"))
                        .when(from_desc.isNotNull(), F.col("tmpl.confidence")).cast("decimal(4,3)"))
            .withColumn("category_conflict", F.coalesce(by_label & ~related(F.col("category"), from_desc), F.lit(False)))
            .drop("_by_label"))


# ------------------------------------------------------------------ keyword classifier
def _keyword_hit(text: Column, word: str) -> Column:
    """A word start, or a whole word for keywords of up to three letters. The plain search goes first:
    most keywords do not occur at all."""
    tail = "(?![a-z])" if len(word) <= 3 else ""
    return (F.contains(text, F.lit(word)) & text.rlike(rf"(?<![a-z])\Q{word}\E{tail}")).cast("int")


def keyword_score(rows: DataFrame, text: Column) -> DataFrame:
    """Add guess and guess_confidence: the category with most matching keywords. In steps, so that the
    keywords are searched once per text."""
    board = F.array(*[F.struct(reduce(lambda a, b: a + b, [_keyword_hit(F.col("_low"), w) for w in words]).alias("hits"),
                               F.lit(category).alias("category")) for category, words in fv.KEYWORDS.items()])
    rows = rows.withColumn("_low", F.lower(text)).withColumn("_board", board)
    rows = rows.withColumn("_best", F.array_max(F.transform("_board", lambda s: s["hits"])))
    rows = rows.withColumn("_won", F.array_sort(F.transform(F.filter("_board", lambda s: s["hits"] == F.col("_best")),
                                                            lambda s: s["category"])))
    none = F.col("_best") == 0
    return (rows.withColumn("guess", F.when(none, "unknown").otherwise(F.element_at("_won", 1)))
            .withColumn("guess_confidence", F.when(none, 0.3).when(F.size("_won") == 1, 0.6).otherwise(0.4))
            .drop("_low", "_board", "_best", "_won"))


def is_junk(text: Column) -> Column:
    t = F.lower(clean.strip(text))
    return t.isin(fv.NULL_TOKENS + fv.JUNK_WORDS) | clean.contains_any(t, fv.JUNK_MARKERS)


def classify_labels(labels: DataFrame, col: str = "label") -> DataFrame:
    """Rule-based guess per distinct label: kind, category, confidence."""
    text = F.col(col)
    scored = keyword_score(labels.withColumn("_junk", is_junk(text)), text)
    kind = (F.when(F.col("_junk"), "junk").when(text.isin(fv.GENERIC_LABELS), "generic_label")
            .when(clean.word_count(text) >= 4, "description_text").otherwise("category_label"))
    plain = F.col("_junk") | text.isin(fv.GENERIC_LABELS)
    return (scored.withColumn("label_kind", kind)
            .withColumn("category", F.when(plain, "unknown").otherwise(F.col("guess")))
            .withColumn("confidence", F.when(plain, 0.6).otherwise(F.col("guess_confidence")))
            .withColumn("source", F.lit("rules")).drop("_junk", "guess", "guess_confidence"))


def classify_templates(templates: DataFrame, col: str = "template") -> DataFrame:
    """Rule-based guess per distinct template: category, severity, hazard, confidence."""
    text = F.lower(col)
    scored = keyword_score(templates.withColumn("_t", text).withColumn("_junk", is_junk(F.col("_t"))), F.col("_t"))
    t, junk = F.col("_t"), F.col("_junk")
    severity = (F.when(junk, "low").when(clean.contains_any(t, fv.SEVERITY_CRITICAL), "critical")
                .when(clean.contains_any(t, fv.SEVERITY_HIGH), "high")
                .when(clean.contains_any(t, fv.SEVERITY_LOW), "low").otherwise("medium"))
    return (scored.withColumn("category", F.when(junk, "unknown").otherwise(F.col("guess")))
            .withColumn("issue_type", F.lit("unclassified"))
            .withColumn("severity", severity)
            .withColumn("is_safety_hazard", ~junk & clean.contains_any(t, fv.HAZARD))
            .withColumn("confidence", F.when(junk, 0.6).otherwise(F.col("guess_confidence")))
            .withColumn("source", F.lit("rules")).drop("_t", "_junk", "guess", "guess_confidence"))


def worklist_labels(valid: DataFrame, labels: DataFrame, pending: DataFrame | None = None) -> DataFrame:
    """Labels that still need a mapping: seen or swapped in, neither known nor waiting for review."""
    seen = (valid.select(clean.normalize_label(F.col("category")).alias("label")).distinct()
            .unionByName(swap_candidates(valid)).distinct().filter(F.col("label") != ""))
    out = seen.join(labels.select("label"), "label", "left_anti")
    return out if pending is None else out.join(pending.select(F.col("subject").alias("label")), "label", "left_anti")


def worklist_templates(rows: DataFrame, pending: DataFrame | None = None) -> DataFrame:
    """Templates without a mapping, each with its earliest description as example.

    `rows` carries description, description_template and tmpl (prefix matches count as mapped).
    """
    out = (rows.filter(F.col("description").isNotNull() & (F.col("description_template") != "") & F.col("tmpl").isNull())
           .groupBy(F.col("description_template").alias("template"))
           .agg(F.min_by("description", "bronze_id").alias("example")))
    return out if pending is None else out.join(pending.select(F.col("subject").alias("template")), "template", "left_anti")
