"""Information-theoretic sanitisation.

Addresses, IPs, card and phone numbers are found by pattern; each distinct value is a protected entity. Over the whole
corpus it is counted in how many rows a term stands near an entity, in how many rows the entity occurs, and in how many
rows the term occurs at all. From these come the pointwise mutual information of term and entity and, divided by the
information content of the entity, the share of it that the term gives away: 1 if the term only ever occurs with the entity,
0 if the two have nothing to do with each other. Terms that give away more than a threshold are generalised
to their kind, those beyond a higher one are removed. Both need `SUPPORT` rows that hold term and entity together, as
fewer say nothing about the corpus.

A term is a run of at least `TERM_LETTERS` letters, as written. The `WINDOW` terms on either side of an entity stand near it;
disclosure is estimated from these. With `everywhere`, a term that gives away too much is a span wherever it stands in any text,
also in rows without an entity, with its largest disclosure; without, only where it stands near the entity. Base
spans are never changed by the method.

Cases: a null text is empty and has no spans. Equal rows have equal spans; rows that share a key but not the text are kept
apart. Rows are counted as they come, repeated ones too. Further columns of the input are ignored by `find`
and kept by `sanitise`.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW, REACH = 8, 240       # terms on either side, and how far they are looked for
TERM_LETTERS = 4
SUPPORT = 3
GENERALISE, REMOVE = 0.85, 0.97
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No pattern is tried at more than one place of a run of digits: a match always ends with the run, so these read
# each text once, however long.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORDS = rf"\p{{L}}{{{TERM_LETTERS},}}"
_TERM = regex.compile(_WORDS)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is the whole run before it, back to the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """Base spans as (kind, start, end) in code points, by start and then by kind as listed in KINDS."""
    out: list[tuple[int, int, int]] = []
    if text and "@" in text:
        out += [(s, 0, e) for s, e in emails(text)]
    if text and _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def _free(found: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Tells whether a stretch of the text touches none of the spans."""
    ordered = sorted(found)
    starts, reach, furthest = [s for s, _ in ordered], [], 0
    for _, e in ordered:
        furthest = max(furthest, e)
        reach.append(furthest)
    return lambda s, e: not (i := bisect.bisect_left(starts, e)) or reach[i - 1] <= s


def contexts(text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) for the terms near each span that do not touch a span."""
    out: list[tuple[str, str, int, int]] = []
    free = _free([(s, e) for _, s, e in found])
    for kind, start, end in found:
        low, high = max(0, start - REACH), min(len(text), end + REACH)
        before = [m.span() for m in _TERM.finditer(text, low, start)]
        after = [m.span() for m in _TERM.finditer(text, end, high)]
        # a word that the reach cuts is left out
        before = [w for w in before if w[0] > low or low == 0 or not text[low - 1].isalpha()][-WINDOW:]
        after = [w for w in after if w[1] < high or high == len(text) or not text[high].isalpha()][:WINDOW]
        entity = f"{kind}:{text[start:end]}"
        out += [(entity, text[a:b], a, b) for a, b in (*before, *after) if free(a, b)]
    return out


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_NEAR = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_TERMS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("disclosure", pa.float64())]))
_SPAN_SQL = "array<struct<kind:string,start:bigint,end:bigint>>"


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def find(docs: DataFrame, key: str, text: str, support: int = SUPPORT, generalise: float = GENERALISE,
         everywhere: bool = False) -> DataFrame:
    """Every row's key, `text_key`, `base` spans and `terms`: spans of the method with the `disclosure` of each.

    The texts are read twice, for the patterns and for the counts of terms, and are not shuffled. `everywhere` reads them
    twice more, to look for the terms and to mark them, and may shuffle them once for that.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))

    def scan(batch: pa.RecordBatch) -> dict[str, object]:
        base, near = [], []
        for value in batch.column(1).to_pylist():
            found = spans(value)
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
            near.append([{"entity": c, "term": t, "start": s, "end": e} for c, t, s, e in contexts(value, found)] if found else [])
        return {"id": batch.column(0), "text_key": batch.column(2), "base": pa.array(base, _SPAN), "near": pa.array(near, _NEAR)}

    scanned = session.staged(map_batches(rows, scan, f"id {kind}, text_key long, base {_SPAN_SQL}, "
                                         "near array<struct<entity:string,term:string,start:bigint,end:bigint>>"), "pii-scan")
    near = scanned.filter(F.size("near") > 0).select("id", "text_key", F.explode("near").alias("n")).select(
        "id", "text_key", F.xxhash64("n.entity").alias("entity"), F.xxhash64("n.term").alias("term"), "n.start", "n.end")
    # one row of the scan may name a pair, an entity or a term several times: it counts once
    ones = scanned.filter(F.size("near") > 0).select(F.explode(F.array_distinct(F.transform(
        "near", lambda n: F.struct(F.xxhash64(n["entity"]).alias("entity"), F.xxhash64(n["term"]).alias("term"))))).alias("p"))
    pairs = ones.groupBy("p.entity", "p.term").agg(F.count(F.lit(1)).alias("n_both")).filter(F.col("n_both") >= support)
    entities = (scanned.filter(F.size("near") > 0)
                .select(F.explode(F.array_distinct(F.transform("near", lambda n: F.xxhash64(n["entity"])))).alias("entity"))
                .groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")))
    held = F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(_WORDS), F.lit(0)), lambda w: F.xxhash64(w)))).alias("term")
    words = (rows.select(held)
        .groupBy("term").agg(F.count(F.lit(1)).alias("n_term")))
    asked = pairs.join(entities, "entity").join(words, "term").withColumn("n_all", F.lit(float(scanned.count())))
    told = asked.filter(F.col("n_all") > F.col("n_entity")).withColumn(
        "disclosure", F.log(F.col("n_both") * F.col("n_all") / F.col("n_entity") / F.col("n_term"))
        / F.log(F.col("n_all") / F.col("n_entity")))
    risky = told.filter(F.col("disclosure") >= generalise).select("entity", "term", "disclosure")
    if everywhere:
        hits = _occurrences(rows, scanned, risky, held, kind)
    else:
        hits = (near.join(risky, ["entity", "term"]).groupBy("id", "text_key", "start", "end").agg(F.max("disclosure").alias("disclosure"))
                .groupBy("id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "disclosure"))).alias("terms")))
    return (scanned.select("id", "text_key", "base").alias("s").join(hits.alias("h"), _same("s", "h"), "left")
            .select("s.id", "s.text_key", "s.base", F.coalesce(F.col("h.terms"), F.expr(
                "cast(array() as array<struct<start:bigint,end:bigint,disclosure:double>>)")).alias("terms"))
            .withColumnRenamed("id", key))


def _occurrences(rows: DataFrame, scanned: DataFrame, risky: DataFrame, held: Column, kind: str) -> DataFrame:
    """`id`, `text_key` and `terms` of the rows that hold a risky term: all places of such terms that touch no base span."""
    named = scanned.filter(F.size("near") > 0).select(F.explode("near").alias("n")).select(
        F.xxhash64("n.term").alias("term"), F.col("n.term").alias("word"))
    worst = risky.groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    # one row for each term, written so that its size is known before the join
    listed_ = session.staged(worst.join(named.groupBy("term").agg(F.min("word").alias("word")), "term"), "pii-terms")
    holding = (rows.select("id", "text_key", held).join(listed_, "term").groupBy("id", "text_key")
               .agg(F.collect_set(F.struct("word", "disclosure")).alias("found")))
    # equal rows have equal spans: one of them is enough
    texts = (rows.alias("r").join(holding.alias("h"), _same("r", "h")).select("r.id", "r.text_key", "r.text", "h.found")
             .dropDuplicates(["id", "text_key"]))

    def mark(batch: pa.RecordBatch) -> dict[str, object]:
        out = []
        for value, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            told = {f["word"]: f["disclosure"] for f in found}
            free = _free([(s, e) for _, s, e in spans(value)])
            out.append([{"start": m.start(), "end": m.end(), "disclosure": told[m[0]]} for m in _TERM.finditer(value)
                        if m[0] in told and free(*m.span())])
        return {"id": batch.column(0), "text_key": batch.column(1), "terms": pa.array(out, _TERMS)}

    return map_batches(texts, mark, f"id {kind}, text_key long, terms array<struct<start:bigint,end:bigint,disclosure:double>>")


def listed(base: Column, terms: Column) -> Column:
    """kind:start:end of all spans by start, then kind (those of the method last), joined by commas."""
    order = {k: i for i, k in enumerate((*KINDS, TERM))}
    rank = lambda k: F.element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), k)
    every = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"),
                                             s["kind"].alias("kind"))),
        F.transform(terms, lambda s: F.struct(s["start"].alias("start"), F.lit(order[TERM]).alias("rank"), s["end"].alias("end"),
                                              F.lit(TERM).alias("kind"))))
    return F.array_join(F.transform(F.array_sort(every), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def cleaned(text: str, base: list, terms: list, remove: float = REMOVE) -> str:
    """The text with every span replaced: base spans and generalised terms by their kind, the strongest terms by nothing."""
    marks = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base]
    marks += [(s["start"], s["end"], "" if s["disclosure"] >= remove else "[NAME]" if text[s["start"]].isupper() else "[WORD]")
              for s in terms]
    out, at = [], 0
    for start, end, put in sorted(marks):
        if start >= at:
            out += [text[at:start], put]
        at = max(at, end)  # overlapping spans become one, named after the first
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, key: str, text: str, remove: float = REMOVE, everywhere: bool = False, **limits: float) -> DataFrame:
    """`docs` with `text` sanitised and all other columns as they are. Rows without any text that could be a span do not move."""
    found = find(docs, key, text, everywhere=everywhere, **limits).filter((F.size("base") > 0) | (F.size("terms") > 0)).select(F.col(key).alias("id"), "text_key", "base", "terms").distinct()
    at, columns = docs.columns.index(text), [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*columns)
    body, id_ = f"c{at}", f"c{docs.columns.index(key)}"
    # every base kind holds one of these characters, every term a run of letters
    may = F.coalesce(F.col(body).rlike(f"[0-9@]|{_WORDS}" if everywhere else "[0-9@]"), F.lit(False))
    wide = own.filter(may).withColumn("text_key", F.xxhash64(F.col(body).cast("string")))
    joined = wide.alias("w").join(found.alias("f"), F.col(f"w.{id_}").eqNullSafe(F.col("f.id"))
                                  & (F.col("w.text_key") == F.col("f.text_key")), "left").select(*columns, "f.base", "f.terms")

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        names = batch.schema.names
        texts = [t if b is None else cleaned(t, b, s or [], remove) for t, b, s in
                 zip(*(batch.column(names.index(n)).to_pylist() for n in (body, "base", "terms")), strict=True)]
        return {n: pa.array(texts, pa.string()) if n == body else batch.column(names.index(n)) for n in columns}

    schema = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(columns, docs.schema.fields, strict=True))
    return map_batches(joined, run, schema).unionByName(own.filter(~may)).toDF(*docs.columns)
