"""Personal data and instruction phrases in free text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerwright import fixed_values as fv


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, r"(?U)\D", "")


def luhn_ok(digits: Column) -> Column:
    """Checksum over a digit string, from the right: every second digit is doubled."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    doubled = F.transform(
        values,
        lambda d, i: F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2),
    )
    total = F.aggregate(doubled, F.lit(0), lambda acc, d: acc + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def _replace_matches(text: Column, pattern: str, label: str, check) -> tuple[Column, Column]:
    """Replace the matches that pass `check`; returns (text, number replaced).

    The text is cut at the matches: pieces between them and the matches alternate, so one ordered
    zip rebuilds the text whatever the matches contain.
    """
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = F.transform(found, lambda m: F.when(check(m), F.lit(label)).otherwise(m))
    woven = F.concat(F.zip_with(between, kept, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))))
    changed = F.size(F.filter(found, check))
    return F.when(changed > 0, F.array_join(woven, "")).otherwise(text), changed


def redact(text: Column) -> Column:
    """struct(text, redactions): e-mail, then checksummed card numbers, then phone numbers."""
    email_n = F.regexp_count(text, F.lit(fv.EMAIL))
    step1 = F.regexp_replace(text, fv.EMAIL, "[EMAIL]")
    step2, card_n = _replace_matches(step1, fv.CARD, "[CARD]", lambda m: luhn_ok(_digits(m)))
    step3, phone_n = _replace_matches(step2, fv.PHONE, "[PHONE]", lambda m: F.length(_digits(m)) >= 10)
    return F.struct(step3.alias("text"), (email_n + card_n + phone_n).alias("redactions"))


def instruction_phrase(text: Column) -> Column:
    return text.rlike(fv.INSTRUCTION_PHRASES)


def token_estimate(text: Column) -> Column:
    return (F.floor(F.length(text) / 3) + 1).cast("int")
