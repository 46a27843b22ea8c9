"""Value cleansing as Column expressions. No Python runs per row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import fixed_values as fv

# Unicode white space plus the four ASCII separators that count as space in the source system; the plain
# blank is kept apart so that text with single blanks only (most values) has nothing to replace.
_OTHER_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = rf"(?: *[{_OTHER_SPACE}])+ *| {{2,}}"
# Words of non-space characters with single blanks between them: nothing to do. Ranges, not classes, and
# possessive loops: one cheap pass over the text.
_WORD = r"[!-~\xa1-\u167f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff\u3001-\uffff]"
_TIDY = rf"^(?:{_WORD}++(?: {_WORD}++)*+)?+$"
_EDGE = rf"^[ {_OTHER_SPACE}]+|[ {_OTHER_SPACE}]+$"
_PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_NAN = r"(?i)^[+-]?s?nan\d*$"
_INFINITE = r"(?i)^[+-]?inf(inity)?$"


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Small fixed mapping as a map literal; NULL when the key is absent."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), key)


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """One literal alternation, so the text expression is evaluated once however many needles there are. The look at the first
    letter goes first: most places of a text start no needle, and the alternation would try them all there."""
    needles = list(needles)
    heads = "".join(rf"\x{{{ord(h):x}}}" for h in sorted({n[0] for n in needles}))
    return text.rlike(f"(?=[{heads}])(?:" + "|".join(rf"\Q{n}\E" for n in needles) + ")")


def collapse(v: Column) -> Column:
    return F.when(v.rlike(_TIDY), v).otherwise(F.trim(F.regexp_replace(v, _SPACE, " ")))


def strip(v: Column) -> Column:
    return F.when(v.rlike(_TIDY), v).otherwise(F.regexp_replace(v, _EDGE, ""))


def word_count(v: Column) -> Column:
    text = collapse(F.coalesce(v, F.lit("")))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def clean_text(v: Column) -> Column:
    """Collapse white space, trim; placeholder tokens become NULL."""
    return drop_placeholder(collapse(v))


def drop_placeholder(text: Column) -> Column:
    return F.when(~F.lower(text).isin(fv.NULL_TOKENS), text)


def with_clean(rows: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """clean_text for many columns (new name -> source) as two projections, so that each text is
    collapsed once."""
    step = rows.withColumns({out: collapse(F.col(src)) for out, src in columns.items()})
    return step.withColumns({out: drop_placeholder(F.col(out)) for out in columns})


def normalize_label(v: Column) -> Column:
    """Key of the label map. Placeholders stay: they are labels somebody typed."""
    return F.coalesce(F.lower(collapse(v)), F.lit(""))


# The parsers below take text that went through clean_text. Callers keep that text in a column of its
# own, so that one row cleans it once and no expression grows by being nested into another.

# ------------------------------------------------------------------ dates
def _iso_text(text: Column) -> Column:
    """Rewrite any accepted wall-clock shape to `y-M-d[ H:m:s]`, which one cast can read."""
    shapes = fv.TIMESTAMP_SHAPES
    us12 = shapes["us_12h"]
    hour = F.regexp_extract(text, us12, 4).try_cast("int")
    pm = F.lower(F.regexp_extract(text, us12, 6)) == "p"
    hour24 = F.when(hour.between(1, 12), hour % 12 + F.when(pm, 12).otherwise(0))
    months = {m: f"{i:02d}" for i, m in enumerate(fv.MONTHS, 1)}
    month = lookup(months, F.lower(F.regexp_extract(text, shapes["dd_mon_yyyy"], 2)))
    # what a shape must hold goes first: a plain search costs a fraction of a pattern
    slash, dash = F.contains(text, F.lit("/")), F.contains(text, F.lit("-"))
    iso = (F.substring(text, 5, 1) == "-") & (text.rlike(shapes["iso_t"]) | text.rlike(shapes["iso_space"]) | text.rlike(shapes["iso_date"]))
    return (
        F.when(iso, F.upper(text))
        .when(slash & text.rlike(shapes["us_date"]), F.regexp_replace(text, shapes["us_date"], "$3-$1-$2"))
        .when(dash & text.rlike(shapes["us_dash_24h"]), F.regexp_replace(text, shapes["us_dash_24h"], "$3-$1-$2 $4"))
        .when(slash & text.rlike(us12), F.concat(F.regexp_replace(text, us12, "$3-$1-$2 "), hour24.cast("string"),
                                         F.regexp_replace(text, us12, ":$5:00")))
        .when(dash & text.rlike(shapes["dd_mon_yyyy"]),
              F.concat(F.regexp_replace(text, shapes["dd_mon_yyyy"], "$3-"), month,
                       F.regexp_replace(text, shapes["dd_mon_yyyy"], "-$1 $4:00")))
    )


def parse_timestamp(text: Column) -> Column:
    """TIMESTAMP_NTZ or NULL. The shape is tested first, so no cast has to fail on the way to the right
    format. Epoch seconds are UTC; every other shape is wall time."""
    # seconds since 1970 added to a zone-free timestamp: the session zone plays no part
    bare = ~F.contains(text, F.lit("-")) & ~F.contains(text, F.lit("/"))
    seconds = F.when(bare & text.rlike(fv.TIMESTAMP_SHAPES["epoch"]), text).try_cast("decimal(18,6)")
    epoch = F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    ts = F.coalesce(epoch, _iso_text(text).try_cast("timestamp_ntz"))
    return F.when(F.year(ts).between(fv.MIN_YEAR, fv.MAX_YEAR), ts)


def timestamp_format(text: Column, ts: Column) -> Column:
    """Name of the format that gave `ts`."""
    fmt = reduce(lambda acc, kv: acc.when(text.rlike(kv[1]), F.lit(kv[0])), fv.TIMESTAMP_SHAPES.items(), F)
    return F.when(ts.isNotNull(), fmt)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def hours_2dp(seconds: Column) -> Column:
    """seconds / 3600 rounded to two places, half to even, as DECIMAL(10,2).

    The value that gets rounded is the double nearest to the quotient. Away from a tie the integer
    remainder decides. On a tie (remainder 18 of 36) the double lies a little above, a little below or
    exactly on it; its fraction times 2^62 is a whole number, so the comparison is exact.
    """
    s = seconds.cast("bigint")
    base = F.floor(s / F.lit(36)).cast("bigint")
    rem = F.pmod(s, F.lit(36))
    x = s.cast("double") / F.lit(3600.0)
    frac = ((x - F.floor(x)) * F.lit(float(2**62))).cast("bigint").cast("decimal(20,0)") * F.lit(200).cast("decimal(4,0)")
    tie = F.pmod(F.floor(s / F.lit(18)).cast("bigint"), F.lit(200)).cast("decimal(4,0)") * F.lit(2**62).cast("decimal(20,0)")
    up = F.when(rem != 18, rem > 18).otherwise((frac > tie) | ((frac == tie) & (base % 2 == 1)))
    hundredths = base + F.when(up, 1).otherwise(0)
    return F.when(s >= 0, (hundredths.cast("decimal(12,0)") / F.lit(100)).cast("decimal(10,2)"))


# ------------------------------------------------------------------ numbers
def bare_amount(text: Column) -> Column:
    """Without currency sign and separators."""
    return strip(F.regexp_replace(text, r"[$,_]", ""))


def cost_value(text: Column, bare: Column | None = None) -> Column:
    """DECIMAL(12,2), half to even; NULL for sentinels, implausible amounts and other text. `bare`: the bare amount, if it is a column."""
    bare = bare_amount(text) if bare is None else bare
    amount = F.when(bare.rlike(_PLAIN_NUMBER), bare).try_cast("decimal(38,10)")
    return F.when(amount.between(0, fv.MAX_PLAUSIBLE_COST), F.bround(amount, 2)).cast("decimal(12,2)")


def cost_flag(text: Column, bare: Column | None = None) -> Column:
    bare = bare_amount(text) if bare is None else bare
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(bare.rlike(_INFINITE), F.when(F.startswith(bare, F.lit("-")), "cost_negative_sentinel")
              .otherwise("cost_implausible"))
        .when(~bare.rlike(_PLAIN_NUMBER), "cost_unparseable")
        .when(bare.try_cast("double") < 0, "cost_negative_sentinel")
        .when(bare.try_cast("double") > fv.MAX_PLAUSIBLE_COST, "cost_implausible")
    )


def _whole_hours(text: Column) -> Column:
    """The number cut toward zero, capped far beyond any accepted value."""
    number = F.when(text.rlike(_PLAIN_NUMBER), text).try_cast("double")
    return F.least(F.greatest(number, F.lit(-1e9)), F.lit(1e9)).cast("int")


def sla_value(text: Column) -> Column:
    hours = _whole_hours(text)
    return F.when(hours.between(fv.SLA_MIN_HOURS, fv.SLA_MAX_HOURS), hours)


def sla_flag(text: Column) -> Column:
    hours = _whole_hours(text)
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(~text.rlike(_PLAIN_NUMBER), "sla_unparseable")
        .when(hours.isin(fv.SLA_SENTINELS), "sla_sentinel")
        .when(~hours.between(fv.SLA_MIN_HOURS, fv.SLA_MAX_HOURS), "sla_out_of_range")
    )


# ------------------------------------------------------------------ enums
def priority_value(text: Column) -> Column:
    return lookup(fv.PRIORITIES, F.lower(text))


def status_value(text: Column) -> Column:
    return lookup(fv.STATUSES, F.lower(text))


def unrecognised(text: Column, value: Column, flag: str) -> Column:
    return F.when(text.isNotNull() & value.isNull(), F.lit(flag))


def is_open(status: Column) -> Column:
    return status.isin(fv.OPEN_STATUSES)


# ------------------------------------------------------------------ free text
def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def mask_variables(text: Column) -> Column:
    """Asset ids and numbers to placeholders; the building names are masked before."""
    masked = F.regexp_replace(F.regexp_replace(text, fv.ASSET, "<asset>"), fv.NUMBER, "<n>")
    return F.lower(collapse(masked))


def floor_number(text: Column) -> Column:
    # the plain search goes first: most texts name no floor
    named = F.when(F.contains(F.lower(text), F.lit("floor")), text)
    return F.regexp_substr(F.regexp_substr(named, F.lit(fv.FLOOR)), F.lit(r"\d{1,3}")).cast("int")


def room_name(text: Column) -> Column:
    return F.lower(F.regexp_substr(text, F.lit(fv.ROOM)))


def asset_id(text: Column) -> Column:
    # the plain search goes first: an asset has a dash
    return F.regexp_substr(F.when(F.contains(text, F.lit("-")), text), F.lit(fv.ASSET))


def note_outcome(text: Column) -> Column:
    """First matching pattern decides; other text is 'other', no text NULL."""
    outcome = reduce(lambda acc, p: acc.when(text.rlike(p[0]), F.lit(p[1])), fv.NOTE_PATTERNS, F)
    return F.when(F.length(text) > 0, outcome.otherwise("other"))


def note_detail(text: Column, outcome: str) -> Column:
    """The value a note of this outcome carries. The patterns start with different words, so no other
    outcome can hold it."""
    pattern = next(p for p, o in fv.NOTE_PATTERNS if o == outcome)
    return _group(text, pattern, 1)


def duplicate_reference(v: Column) -> Column:
    """Ticket named by a duplicate note. The pattern is the first one of all, so it can be asked alone."""
    named = F.when(F.contains(v, F.lit("#")), v)  # most notes name none, and a plain search tells
    number = F.regexp_replace(F.regexp_extract(collapse(named), fv.NOTE_PATTERNS[0][0], 1), "^0+", "")
    return F.concat(F.lit("TKT-"), F.nullif(number, F.lit("")))


def ticket_id(v: Column) -> Column:
    return strip(F.coalesce(v, F.lit("")))


def ticket_number(tid: Column) -> Column:
    return _group(tid, r"(?U)^TKT-(\d+)$", 1).try_cast("bigint")


def building(v: Column) -> Column:
    text = clean_text(v)
    return F.when(~F.lower(text).isin(fv.SYSTEM_ACCOUNTS), text)


def junk_text(*parts: Column) -> Column:
    """TRUE when a junk marker occurs anywhere in the joined text."""
    return contains_any(F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts])), fv.JUNK_MARKERS)


def usable_id(tid_raw: Column) -> Column:
    return ticket_id(tid_raw).rlike(r"(?U)^TKT-\d+$")


def quarantine_reasons(tid_raw: Column, category: Column, description: Column, building_raw: Column) -> Column:
    return F.array_compact(F.array(
        F.when(~usable_id(tid_raw), F.lit("invalid_ticket_id")),
        F.when(junk_text(category, description, building_raw), F.lit("test_or_junk_marker")),
    ))


# ------------------------------------------------------------------ people
def name_parts(text: Column) -> Column:
    """Words of a name; a dot ends a word."""
    return F.split(collapse(F.regexp_replace(text, r"\.", ". ")), " ")


def first_name(parts: Column) -> Column:
    """Lower-case first name or initial; NULL when the text is not a person's name."""
    return F.when(F.size(parts) >= 2, F.nullif(F.lower(F.regexp_replace(F.element_at(parts, 1), r"\.+$", "")), F.lit("")))


def expand_nickname(first: Column) -> Column:
    return F.coalesce(lookup(fv.NICKNAMES, first), first)


# ------------------------------------------------------------------ analytics helpers
def value_shape(v: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(v, "[0-9]", "9"), "[A-Za-z]", "a")


def tokens(v: Column) -> Column:
    """Distinct lower-case ASCII words of two letters or more, without stop words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(v, F.lit(""))), F.lit("([a-z]+)"), F.lit(1))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(fv.STOP_WORDS)))


def slug(v: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(v), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    s = F.substring(s, 1, 60)
    return F.when(v.isNotNull(), F.when(s == "", F.lit("unspecified")).otherwise(s))


def clamp(v: Column) -> Column:
    return F.when(v.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def open_age_hours(created_at: Column, as_of: Column, open_: Column) -> Column:
    """Hours from creation to the end of the as-of day, one decimal."""
    end = (F.date_add(as_of, 1)).cast("timestamp_ntz")
    secs = seconds_between(created_at, end).cast("decimal(18,0)")
    return F.when(open_ & created_at.isNotNull(), F.round(secs / F.lit(3600).cast("decimal(4,0)"), 1).cast("decimal(12,1)"))


def date_facts(d: Column) -> list[Column]:
    dow = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    return [
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        F.extract(F.lit("WEEK"), d).cast("int").alias("iso_week"),
        F.trunc(d, "MM").alias("month"),
        dow.alias("iso_dow"),
        (dow >= 6).alias("is_weekend"),
    ]


def accepts(expected: Column, actual: Column) -> Column:
    """TRUE when the answer is one of the accepted answers in `a|b`; a missing answer is a miss."""
    return F.coalesce(F.array_contains(F.split(expected, r"\|"), actual), F.lit(False))


def truth_of(expected: Column, predicted: Column) -> Column:
    return F.when(accepts(expected, predicted), predicted).otherwise(F.element_at(F.split(expected, r"\|"), 1))


def information_threshold(n: Column, safety_bits: float) -> Column:
    return 2 * F.log2(F.greatest(F.lit(2), n).cast("double")) + F.lit(safety_bits)
