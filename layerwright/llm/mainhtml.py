"""Main text of web pages, with a suffix array over the blocks of each host.

Every page becomes a stream of blocks (the text between two block elements), each marked by the elements around it: inside an
article, inside the main element, inside a frame of the page (menus, headers, footers, sidebars, notices, adverts, forms,
comments, by element, role or class words), or plain. A block is one token, by a hash of its text.

The streams of a host, all blocks of all its pages, are concatenated, page by page, and their suffixes sorted: Spark deals (host, first
DEPTH tokens) by range, so that a host with a third of all pages lies over many slices, and equal suffixes are grouped to one row before
that. Blocks that stand on one page of their host only can't repeat; they end a stream and start no suffix. Neighbours in the order tell
how long a run of blocks repeats on another page; where the neighbours lie in other slices, the
slices' first and last rows (four a slice) are compared with them. Blocks covered by a repeated run of at least LONG words are
boilerplate by this method, what is left are the unique runs of the page. An exact check by the marks follows.

What counts as main text:

* With an article on the page: its blocks outside frames. The check puts back what repeats there, since copies of an article, licence
  lines and quoted passages repeat too and are still its text; `n_repeated` counts the blocks put back. Without one, the main element's
  blocks in the same way.
* Else the plain blocks that no repeated run covers, where what repeats inside articles or main elements of other pages doesn't count (marks
  show it to be main text there). A covered stretch of at least half the page's plain words, or of COPIED
  words, is kept: it is a copied text rather than boilerplate. `n_repeated` counts its covered plain blocks.

So on pages that mark their article all runs are found and counted, and the text is that of the marks.

Character references are decoded, white space (any Unicode white space) in a block becomes one space, empty blocks go. Line
breaks end blocks. Scripts, styles, comments, templates, heads and attribute values are never text. Unclosed elements: a frame
without an end tag ends where an article or main element begins; an article without one lasts to the end of the page; a tag
without its ">" is text. A null or empty page has an empty text; a null url or one without a host belongs to the host "". Pages
that repeat an id are pages of their own, told apart by a row number; a null id stays null. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright import session
from layerwright.llm.common import map_batches, prepared
from layerwright.operators import skew

# words that a repeated run must have to be boilerplate, words from which it is a copied text, tokens by which suffixes are sorted
LONG, COPIED, DEPTH = 5, 100, 8
PLAIN, MAIN, ARTICLE, FRAME = range(4)

_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small
span strike strong sub sup time tt u var wbr img""".split())
# elements without an effect on the text around them
_UNSEEN = frozenset("script style title link meta base".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# nothing inside these is text; their content is markup of its own
_RAW = frozenset("script style textarea title xmp noframes iframe".split())
_FRAMES = frozenset("""nav header footer aside form menu dialog button select fieldset noscript template svg canvas object
head audio video map datalist""".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
_WORDS = _COMMENTS | frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent
gdpr notice notices newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs related share
sharing social popup modal overlay footer header masthead widget widgets pagination pager paywall skip toolbar""".split())
_NEVER = frozenset("html body article main".split())  # of these only comment words count
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_NAMED = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_PART = re.compile(r"[a-z]+")


def blocks(page: str) -> list[tuple[int, str]]:
    """The blocks of a page: (mark, text) in page order."""
    out: list[tuple[int, str]] = []
    for mark, parts in _runs(page):
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((mark, text))
    return out


@dataclass
class _Open:
    """An element that marks what is in it: `depth` counts elements of its name inside, `before` holds the block it interrupts."""
    name: str
    mark: int
    depth: int = 0
    before: list[str] | None = None


def _runs(page: str) -> Iterator[tuple[int, list[str]]]:
    """Pieces of text between block elements, with their marks."""
    size, at, lower, tries = len(page), 0, None, 32
    stack: list[_Open] = []
    parts: list[str] = []
    mark, last_end = PLAIN, {}

    def marked(upto: int | None = None) -> int:
        own = [o.mark for o in stack[:upto]]
        return FRAME if FRAME in own else max(own, default=PLAIN)

    def flush() -> Iterator[tuple[int, list[str]]]:
        nonlocal parts
        for i, o in enumerate(stack):
            if o.before:
                yield marked(i), o.before
            o.before = None
        if parts:
            yield mark, parts
        parts = []

    def close(k: int) -> Iterator[tuple[int, list[str]]]:
        """End the k-th open element and all inside it; a block that an inline element interrupted goes on."""
        nonlocal parts, mark
        if stack[k].before is not None:
            if parts:
                yield mark, parts
            parts = stack[k].before
        del stack[k:]
        mark = marked()

    while at < size:
        start = page.find("<", at)
        if start != at:
            parts.append(page[at:] if start < 0 else page[at:start])
        if start < 0:
            break
        after = page[start + 1:start + 2]
        if page.startswith("<!--", start):
            end = page.find("-->", start + 2 if page.startswith(("<!-->", "<!--->"), start) else start + 4)
            at = size if end < 0 else end + 3
            continue
        if after in ("!", "?") or after == "/" and not page[start + 2:start + 3].isalpha():
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        if not (after.isascii() and (after.isalpha() or after == "/")):
            parts.append("<")
            at = start + 1
            continue
        found = _TAG.match(page, start) if tries else None
        if found:
            name, rest, at = found[1].lower(), found[2], found.end()
        else:
            # a quote without its end: the tag ends at the next ">", and after many such all tags do
            tries = max(0, tries - 1)
            end = page.find(">", start)
            if end < 0:
                parts.append(page[start:])
                break
            inside = page[start + 1 + (after == "/"):end]
            name = re.split(r"[\s/]", inside, maxsplit=1)[0].lower()
            rest, at = inside[len(name):], end + 1
        if name not in _INLINE and name not in _UNSEEN:
            yield from flush()
            while stack and (stack[-1].name == "p" or stack[-1].name == "head" and name not in ("head", "noscript", "template")):
                yield from close(len(stack) - 1)  # any block ends a paragraph, any but these the head
        if after == "/":
            k = max((i for i, o in enumerate(stack) if o.name == name), default=-1)
            if k >= 0 and stack[k].depth:
                stack[k].depth -= 1
            elif k >= 0:
                yield from close(k)
            continue
        if name in _RAW:
            if lower is None:
                lower = page.lower()
                if len(lower) != size:  # a letter that grows when lowered would shift all places
                    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), page)
            end = lower.find(f"</{name}", at)
            at = end if end >= 0 else size if name in ("script", "style") else at
            continue
        if name in _VOID:
            continue
        kind = _mark(name, rest)
        if kind in (ARTICLE, MAIN):
            # frames that never end don't hold the article
            while stack and stack[-1].mark == FRAME and not _ends(page, stack[-1].name, at, last_end):
                yield from close(len(stack) - 1)
        if kind != PLAIN:
            stack.append(_Open(name, kind))
            if name in _INLINE:
                stack[-1].before, parts = parts, []
            mark = marked()
        else:
            for o in reversed(stack):
                if o.name == name:
                    o.depth += 1
                    break
    yield from flush()


def _ends(page: str, name: str, at: int, last_end: dict[str, int]) -> bool:
    """Whether an end tag of the name follows; the last one is looked up once a page."""
    if name not in last_end:
        last_end[name] = max((m.start() for m in re.finditer(f"</{re.escape(name)}(?=[\\s>/])", page, re.I)), default=-1)
    return last_end[name] >= at


def _mark(name: str, rest: str) -> int:
    kind = FRAME if name in _FRAMES else ARTICLE if name == "article" else MAIN if name == "main" else PLAIN
    if kind == FRAME or "=" not in rest and "hidden" not in rest.lower():
        return kind
    words = _COMMENTS if name in _NEVER else _WORDS
    for found in _NAMED.finditer(rest):
        key, value = found[1].lower(), (found[2] or "").strip("\"'").lower()
        if key == "role":
            if value in _ROLES and name not in _NEVER:
                return FRAME
            kind = {"main": MAIN, "article": ARTICLE}.get(value, kind) if kind == PLAIN else kind
        elif key == "hidden":
            if name not in _NEVER and rest[found.start() - 1:found.start()].isspace():
                return FRAME
        else:
            for one in value.split():
                if not one.startswith(("has-", "with-", "no-", "js-")) and not words.isdisjoint(_PART.findall(one)):
                    return FRAME
    return kind


def _words(text: str) -> int:
    """Words of a block; scripts without spaces count by their length."""
    return max(len(text.split()), len(text) // 12)


def _token(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - 2**63


def parse(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """Pages as blocks: row, key, url, host, marked (whether marks decide), and of all blocks: texts (null: not main text by the marks),
    sizes, tokens, own (whether there is a text), outside (whether the block stands outside articles and main elements)."""
    prepared(pages.sparkSession)
    kind, link = pages.schema[key].dataType.simpleString(), pages.schema[url].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)", 1))

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        marked, texts, sizes, tokens, own, outside = [], [], [], [], [], []
        for one in batch.column(4).to_pylist():
            found = blocks(one or "")
            best = next((m for m in (ARTICLE, MAIN) if any(k == m for k, _ in found)), PLAIN)
            marked.append(best != PLAIN)
            texts.append([t if k == best else None for k, t in found])
            sizes.append([_words(t) for _, t in found])
            tokens.append([_token(t) for _, t in found])
            own.append([k == best for k, _ in found])
            outside.append([k in (PLAIN, FRAME) for k, _ in found])
        flags = pa.list_(pa.bool_())
        return {"row": batch.column(0), "key": batch.column(1), "url": batch.column(2), "host": batch.column(3), "marked": pa.array(marked, pa.bool_()),
                "texts": pa.array(texts, pa.list_(pa.string())), "sizes": pa.array(sizes, pa.list_(pa.int32())), "tokens": pa.array(tokens, pa.list_(pa.int64())),
                "own": pa.array(own, flags), "outside": pa.array(outside, flags)}

    rows = session.spread(pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).cast("string").alias("page")))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "key", "url", host.alias("host"), "page")
    return map_batches(rows, run, f"row long, key {kind}, url {link}, host string, marked boolean, texts array<string>, sizes array<int>, "
                                  "tokens array<bigint>, own array<boolean>, outside array<boolean>")


def streams(pages: DataFrame, outside: bool = False) -> DataFrame:
    """row, host, streams (at, tokens): neighbouring blocks of each page that stand on other pages of the host too; `outside` takes only blocks
    outside articles and main elements, here and there.

    A block that stands on one page only is in no repeated run, so it ends a stream. That is found by 64-bit keys of host and block:
    two blocks of one key would only stay in a stream where nothing repeats.
    """
    seen = pages.select("row", F.xxhash64("host").alias("h"), "outside", F.posexplode("tokens").alias("at", "t"))
    seen = (seen.filter(F.get("outside", F.col("at"))) if outside else seen).select("row", "at", F.xxhash64("h", "t").alias("k"))
    shared = seen.groupBy("k").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).filter("lo < hi").select("k")
    places = seen.join(shared, "k").groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("places"))
    first = F.filter("places", lambda x, i: F.coalesce(F.get("places", i - 1) != x - 1, F.lit(True)))
    last = F.filter("places", lambda x, i: F.coalesce(F.get("places", i + 1) != x + 1, F.lit(True)))
    rows = pages.select("row", "host", "tokens").join(places, "row").select("row", "host", "tokens", first.alias("first"), last.alias("last"))
    cut = F.zip_with("first", "last", lambda a, z: F.struct(a.alias("at"), F.slice("tokens", a + 1, z - a + 1).alias("tokens")))
    return rows.select("row", "host", cut.alias("streams"))


def suffixes(pages: DataFrame) -> DataFrame:
    """Every suffix of every stream, as far as it is sorted: row, host, at (its block), run (its first DEPTH tokens)."""
    pieces = pages.select("row", "host", F.explode("streams").alias("s")).select("row", "host", F.col("s.at").alias("start"), F.posexplode("s.tokens").alias("i", "t"),
                                                                                  F.col("s.tokens").alias("tokens"))
    return pieces.select("row", "host", (F.col("start") + F.col("i")).alias("at"), F.slice("tokens", F.col("i") + 1, DEPTH).alias("run"))


_SORTED = "host string, run array<bigint>, lo long, hi long, reach int, slice int, edge int, open int"
# rows at the ends of a slice: first, first of another page, last, last of another page
_FIRST, _FIRST_OTHER, _LAST, _LAST_OTHER = 1, 2, 4, 8
# a row may reach further by what stands before its slice, or behind it
_BEFORE, _BEHIND = 1, 2


def suffix_array(suffix: DataFrame) -> DataFrame:
    """Distinct suffixes in order, with `reach`: how many of their first tokens repeat, in their order, on another page of the host."""
    distinct = suffix.groupBy("host", "run").agg(F.min("row").alias("lo"), F.max("row").alias("hi"))
    order = distinct.repartitionByRange("host", "run").sortWithinPartitions("host", "run").select("host", "run", "lo", "hi")
    slices = session.staged(order.mapInArrow(_neighbours, _SORTED), "suffixes")
    # at most four rows for each slice, and no more slices than spark.sql.shuffle.partitions
    ends = _Ends([tuple(r) for r in slices.filter("edge > 0").select("slice", "edge", "host", "run", "lo", "hi").toLocalIterator()])

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                r["reach"] = max(r["reach"], ends.reach(r))
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    inside, outer = slices.filter("open = 0"), slices.filter("open > 0").mapInArrow(further, _SORTED)
    return inside.unionByName(outer).select("host", "run", "reach")


def _common(one: list[int], other: list[int]) -> int:
    return next((i for i, (a, b) in enumerate(zip(one, other)) if a != b), min(len(one), len(other)))  # noqa: B905


def _alone(row: dict) -> int | None:
    """The page of a suffix that stands on one page only."""
    return row["lo"] if row["lo"] == row["hi"] else None


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One slice of the suffix array: compare each suffix with the nearest ones of other pages, before and behind it."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("host", pa.string()), ("run", pa.list_(pa.int64())), ("lo", pa.int64()), ("hi", pa.int64()), ("reach", pa.int32()),
                        ("slice", pa.int32()), ("edge", pa.int32()), ("open", pa.int32())])

    def groups() -> Iterator[list[dict]]:
        """Rows in a row that stand on the same page only; a suffix of several pages is a group of its own."""
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (_alone(row) is None or _alone(row) != _alone(held[0])):
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def close(group: list[dict], before: dict | None, behind: dict | None, number: int) -> list[dict]:
        for i, row in enumerate(group):
            row |= {"slice": part, "edge": 0, "open": 0, "reach": len(row["run"]) if _alone(row) is None else 0}
            if _alone(row) is not None:
                for other, flag in ((before, _BEFORE), (behind, _BEHIND)):
                    if other is None:
                        row["open"] |= flag
                    elif other["host"] == row["host"]:
                        row["reach"] = max(row["reach"], _common(row["run"], other["run"]))
            row["edge"] |= (_FIRST, _FIRST_OTHER)[number] if number < 2 and i == 0 else 0
        if behind is None:
            group[-1]["edge"] |= _LAST
        return group

    def walk() -> Iterator[dict]:
        before, group, number = None, None, 0
        for following in groups():
            if group:
                yield from hold(close(group, before, following[0], number))
                before, number = group[-1], number + 1
            group = following
        if group:
            closed = close(group, before, None, number)
            if kept:
                kept[-1]["edge"] |= _LAST_OTHER
            yield from kept
            yield from closed

    kept: list[dict] = []

    def hold(rows: list[dict]) -> Iterator[dict]:
        """The last row of the group before the last one gets a mark: keep one group back."""
        yield from kept
        kept[:] = rows

    return _batches(walk(), schema)


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(held, schema)


class _Ends:
    """The ends of all slices."""

    def __init__(self, rows: list[tuple]):
        self.first: dict[int, list[dict]] = {}
        self.last: dict[int, list[dict]] = {}
        for part, edge, host, run, lo, hi in rows:
            row = {"host": host, "run": list(run), "lo": lo, "hi": hi}
            for ends, own, other in ((self.first, _FIRST, _FIRST_OTHER), (self.last, _LAST, _LAST_OTHER)):
                if edge & (own | other):
                    ends.setdefault(part, [None, None])
                    if edge & own:
                        ends[part][0] = row
                    if edge & other:
                        ends[part][1] = row
        self.parts = sorted(self.first)

    def reach(self, row: dict) -> int:
        best = 0
        for flag, ends, parts in ((_BEFORE, self.last, [p for p in reversed(self.parts) if p < row["slice"]]),
                                  (_BEHIND, self.first, [p for p in self.parts if p > row["slice"]])):
            if row["open"] & flag:
                other = next((o for p in parts for o in ends[p] if o and _alone(o) != row["lo"]), None)
                if other and other["host"] == row["host"]:
                    best = max(best, _common(row["run"], other["run"]))
        return best


def _repeats(pages: DataFrame, asked: DataFrame, outside: bool) -> DataFrame:
    """row, at, reach: the repeated runs of the pages asked for."""
    suffix = suffixes(session.staged(streams(pages, outside), "streams"))
    repeated = suffix_array(suffix).filter("reach > 0")
    return suffix.join(asked.select("row"), "row", "left_semi").join(repeated, ["host", "run"]).select("row", "at", "reach")


def extract(pages: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """Main text of every page: key, url, text, n_repeated (blocks that may be main text and stand in a repeated run)."""
    kind, link = pages.schema[key].dataType.simpleString(), pages.schema[url].dataType.simpleString()
    folder = session.fresh_folder(pages.sparkSession, "pages")
    parse(pages, key, url, page).write.option("compression", "zstd").parquet(folder)
    found = pages.sparkSession.read.parquet(folder)
    plain = found.filter("NOT marked")
    hosts = found.join(plain.select("host").distinct(), "host", "left_semi")
    runs = _repeats(found, found.filter("marked"), False).unionByName(_repeats(hosts, plain, True))

    def count(batch: pa.RecordBatch) -> dict[str, object]:
        rows = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
        repeated = [sum(c and o for c, o in zip(_covered(sizes, _runs_of(covers)), own, strict=True)) for sizes, own, covers in rows]
        return {"row": batch.column(0), "covers": batch.column(3), "n_repeated": pa.array(repeated, pa.int64())}

    covers = found.select("row", "sizes", "own").join(runs.groupBy("row").agg(F.collect_list(F.struct("at", "reach")).alias("covers")), "row")
    covers = map_batches(covers, count, "row long, covers array<struct<at:int,reach:int>>, n_repeated long").filter("n_repeated > 0")
    # few pages have such blocks; the others' texts need not travel to learn that
    covers = session.staged(covers, "covers")

    def decide(batch: pa.RecordBatch) -> dict[str, object]:
        rows = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
        # marks have the last word: what they show to be main text stays although it repeats
        texts = [unique_text(t, s, [] if marked else _runs_of(covered)) for t, s, marked, covered in rows]
        return {key: batch.column(0), url: batch.column(1), "text": pa.array(texts, pa.string()), "n_repeated": batch.column(6)}

    rows = (found.select("row", "key", "url", "texts", "sizes", "marked")
            .join(F.broadcast(covers) if skew.fits(covers) else covers.hint("merge"), "row", "left")
            .select("key", "url", "texts", "sizes", "marked", "covers", F.coalesce("n_repeated", F.lit(0)).cast("long").alias("n_repeated")))
    return map_batches(rows, decide, f"{key} {kind}, {url} {link}, text string, n_repeated long")


def _runs_of(covers: list[dict] | None) -> list[tuple[int, int]]:
    return [(c["at"], c["reach"]) for c in covers or []]


def _covered(sizes: list[int], covers: list[tuple[int, int]]) -> list[bool]:
    """Which blocks are boilerplate by repetition alone: those in a run of at least LONG words."""
    covered = [False] * len(sizes)
    for at, reach in covers:
        if sum(sizes[at:at + reach]) >= LONG:
            covered[at:at + reach] = [True] * reach
    return covered


def unique_text(texts: list[str | None], sizes: list[int], covers: list[tuple[int, int]]) -> str:
    """The plain blocks (None: a frame) outside boilerplate, where `covers` are repeated runs (first block, length)."""
    covered = _covered(sizes, covers)
    words = [n if t is not None else 0 for t, n in zip(texts, sizes, strict=True)]
    kept: list[str] = []
    for repeated, stretch in groupby(range(len(texts)), key=covered.__getitem__):
        own = list(stretch)
        size = sum(words[i] for i in own)
        if not repeated or size >= COPIED or 2 * size >= sum(words):
            kept += [texts[i] for i in own if texts[i] is not None]
    return "\n".join(kept)
