"""Personal data against plain patterns, and the method against counts made by hand."""

import math
import random
import re

import pytest

from layerwright.llm import pii

_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _double(d: int) -> int:
    return sum(map(int, str(2 * d)))


def _valid(kind: str, match: str) -> bool:
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        checked = sum(digits[-1::-2]) + sum(map(_double, digits[-2::-2]))
        return 14 <= len(digits) <= 19 and checked % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _brute(text: str) -> list[tuple[str, int, int]]:
    found = [(m.start(), i, m.end()) for i, (kind, p) in enumerate(_PLAIN.items())
             for m in re.finditer(p, text) if _valid(kind, m[0])]
    return [(pii.KINDS[i], s, e) for s, i, e in sorted(found)]


def test_base_spans_equal_the_plain_patterns():
    rnd = random.Random(11)
    parts = ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234567", "+", "-", " ",
             "x", "%", "é", "0", "00000000255", "日", "9" * 15, "a.b-c", "(", ")", "1", "5500005555555559", "\n"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(1, 25))) for _ in range(6000)]
    for text in [*texts, "a@b.c@d.e", "x@y..z", "1.2.3.4.5.6.7.8", "+1 2", "+12345678901 ) ", "", "000.0.0.00"]:
        assert pii.spans(text) == _brute(text), text
    assert pii.spans(None) == []


@pytest.mark.parametrize("text", ["9" * 400_000, "1." * 200_000, "a" * 400_000 + "@", "a@" * 200_000, "+1" * 200_000, "1 " * 200_000])
def test_very_long_runs_are_read_once(text):
    pii.spans(text)


def _corpus():
    near = "the parcel for Quimby went to q.uimby@mail.example yesterday morning"
    return [*[(i, f"{near} {i}") for i in range(4)], *[(10 + i, "yesterday morning the parcel went for nobody") for i in range(20)],
            (50, "Quimby alone"), (60, None), (61, ""), (62, "nothing here"), (0, f"{near} 0"), (None, f"call +49 30 1234567 {near}")]


def test_disclosure_against_counts(spark):
    rows = _corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "k").selectExpr("k", "text", "'x' AS base", "1 AS id")
    found = pii.find(docs, "k", "text", support=3, generalise=0.85).collect()
    assert len(found) == len(rows)
    holding = [t for _, t in rows if t and "@" in t]
    share = lambda term: (math.log(len(holding) * len(rows) / len(holding) / sum(term in re.findall(r"[^\W\d_]{4,}", t or "") for _, t in rows))
                          / math.log(len(rows) / len(holding)))
    assert share("Quimby") >= 0.85 > share("parcel")
    for row in found:
        text = next((t for k, t in rows if k == row.k and (k is not None or t)), None) or ""
        terms = {text[s.start:s.end]: s.disclosure for s in row.terms}
        assert set(terms) == ({"Quimby"} if "@" in text else set()), (row.k, terms)
        assert all(abs(v - share(k)) < 1e-9 for k, v in terms.items())
    strict = pii.find(docs, "k", "text", support=99).collect()
    assert not any(r.terms for r in strict) and [len(r.base) for r in strict] == [len(r.base) for r in found]


def test_sanitised_rows_keep_their_columns(spark):
    rows = _corpus()
    docs = spark.createDataFrame([(t, k, "b", [1]) for k, t in rows], "text string, k long, base string, terms array<int>")
    out = pii.sanitise(docs, "k", "text", remove=0.99)
    assert out.schema == docs.schema
    got = sorted((str(r.k), str(r.text)) for r in out.collect())
    fix = lambda t: t and t.replace("+49 30 1234567", "[PHONE]").replace("Quimby went", "[NAME] went").replace("q.uimby@mail.example", "[EMAIL]")
    assert got == sorted((str(k), str(fix(t))) for k, t in rows)
    gone = pii.sanitise(docs, "k", "text", remove=0.0).filter("k = 1").first().text
    assert gone == "the parcel for  went to [EMAIL] yesterday morning 1"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "k long, text string")
    assert pii.find(docs, "k", "text").count() == 0 and pii.sanitise(docs, "k", "text").count() == 0
