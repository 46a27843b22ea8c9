"""Main text of pages: markup, and repeated runs against a plain search."""

import random

import pytest

from layerwright.llm import mainhtml

PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p><article>no";</script><body><div class="cookie-notice">We use
<b>cookies</b></div><nav><ul><li>a<li>b</nav><!-- <article>no</article> --><article class=post><header>by me</header><h1>T &amp;amp; &lt;x&gt;</h1>
<p>one <span class="ad">buy</span> two<script>if(a<b)"</p>"</script> thr<b>ee</b><p>x < y &nbsp;\tz<br>w<aside>rel</aside><ul><li>i<li>j</ul>
<div id="comments"><article>c1</article></div><form><p>name</form><p title="a > b" class=lead>end</article><footer>f"""


def _main(page):
    found = mainhtml.blocks(page)
    return [t for m, t in found if m == mainhtml.ARTICLE]


def test_article_without_frames():
    assert _main(PAGE) == ["T &amp; <x>", "one two three", "x < y z", "w", "i", "j", "end"]


def test_broken_markup():
    assert _main("<nav><li>menu<article>kept</article>") == ["kept"]
    assert _main("<aside><article>card</article></aside><article>kept") == ["kept"]
    assert _main("<article>a<p class='ad'>buy<p>b</p></artic") == ["a", "b</artic"] or _main("<article>a<p class='ad'>buy<p>b</p></artic") == ["a", "b", "</artic"]
    assert _main("<article><p title='it>a</p><p>b</p></article>")[-1] == "b"
    assert _main("<ARTICLE>A&eacute;&#x4e2d;&bogus;&lt</ARTICLE>") == ["Aé中&bogus;<"]
    assert _main("<article><div class=ad>x<div>y</div>z</div>t</article>") == ["t"]
    assert _main("<article>a<style>p{}") == ["a"] and _main("<article>a<!-- b") == ["a"] and _main("<article>a<!--> b") == ["a b"]
    assert _main("") == [] and _main("<") == [] and mainhtml.blocks("a<") == [(mainhtml.PLAIN, "a<")]
    assert _main("<article>İ<script>x</SCRIPT>b</article>") == ["İb"]
    assert _main("<body class='has-sidebar menu'><article class='post no-comments'>a<article class=comment>c</article></article>") == ["a"]


def test_long_and_hostile_pages_take_linear_time():
    for page in ("<" * 300_000, "<a '" * 100_000, "<nav>" * 20_000 + "<article>x", "<!--" * 100_000, "<p class='" * 50_000, "&amp" * 200_000,
                 "<article>" + "<p>word " * 200_000):
        mainhtml.blocks(page)


def test_main_element_and_text_of_frames():
    assert mainhtml.blocks("<main><p>a<nav>b</nav></main>c") == [(mainhtml.MAIN, "a"), (mainhtml.FRAME, "b"), (mainhtml.PLAIN, "c")]
    assert mainhtml.blocks('<div role="main">a</div><div hidden>b</div><div data-hidden=1>c</div>') == [
        (mainhtml.MAIN, "a"), (mainhtml.FRAME, "b"), (mainhtml.PLAIN, "c")]


def _reach(streams, host, row, at):
    """Plain search: how many tokens from here repeat on another page of the host."""
    own = next(s["tokens"][at - s["at"]:] for s in streams[row] if s["at"] <= at < s["at"] + len(s["tokens"]))[:mainhtml.DEPTH]
    best = 0
    for other, (name, pieces) in enumerate(zip(host, streams, strict=True)):
        if other != row and name == host[row]:
            for s in pieces:
                for i in range(len(s["tokens"])):
                    best = max(best, mainhtml._common(own, s["tokens"][i:i + mainhtml.DEPTH]))
    return best


@pytest.mark.parametrize("parts", [1, 13, 60])
def test_suffix_array(spark, parts):
    rng = random.Random(parts)
    host = [rng.choice(["a", "a", "b", ""]) for _ in range(60)]
    streams = [[{"at": at, "tokens": [rng.choice([rng.randrange(4), rng.randrange(4), rng.randrange(10**6)]) for _ in range(rng.randrange(1, 14))]}
                for at in (0, 20)] for _ in host]
    streams[7] = [{"at": 0, "tokens": [1] * 60}]  # a page that repeats itself
    streams[8] = streams[9] = [{"at": 3, "tokens": list(range(12))}]
    df = spark.createDataFrame(list(zip(range(60), host, streams, strict=True)), "row long, host string, streams array<struct<at:int,tokens:array<bigint>>>")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        suffix = mainhtml.suffixes(df)
        got = {(r.row, r.at): r.reach for r in suffix.join(mainhtml.suffix_array(suffix), ["host", "run"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    want = {(row, s["at"] + i): _reach(streams, host, row, s["at"] + i) for row, pieces in enumerate(streams) for s in pieces for i in range(len(s["tokens"]))}
    assert got == want


def test_runs():
    texts, sizes = ["one two three", None, "own words of this page", "four five six"], [3, 3, 5, 3]
    assert mainhtml.unique_text(texts, sizes, [(0, 2)]) == "own words of this page\nfour five six"
    assert mainhtml.unique_text(texts, sizes, [(0, 1), (3, 1)]) == "\n".join(t for t in texts if t)  # runs too short
    assert mainhtml.unique_text(texts, sizes, [(0, 3)]) == "\n".join(t for t in texts if t)  # half the page is a copy
    assert mainhtml.unique_text(["a", "b", "c"], [5, 120, 200], [(0, 1), (1, 1)]) == "a\nb\nc"  # neighbours make one long stretch
    assert mainhtml.unique_text(["a", "b", "c"], [5, 120, 200], [(0, 1)]) == "b\nc"


def test_pages(spark):
    notice, terms = "<div>This site stores small files on your device</div>", "<p>All rights reserved by the owner of this site</p>"
    body = lambda i: f"<h1>Title {i}</h1><p>Page number {i} tells something of its own, {i * 7} times</p>"
    rows = [(i, f"https://Host.example:80/{i}", f"<body>{notice}{body(i)}{terms}") for i in range(8)]
    rows += [(20, "http://other.example/", f"<body>{notice}{body(20)}{terms}"), (21, "http://copy.example/1", body(21)), (22, "http://copy.example/2", body(21)),
             (23, "http://host.example/x", f"{notice}<article>{terms}</article>"), (24, None, None), (None, "u", ""), (24, "", "plain text"), (25, "x", " <nav>a</nav>")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, row int").repartition(5)
    got = sorted(((r.page_id, r.url, r.text) for r in mainhtml.extract(df, "page_id", "url", "html").collect()), key=str)
    plain = lambda i: f"Title {i}\nPage number {i} tells something of its own, {i * 7} times"
    want = [(i, f"https://Host.example:80/{i}", plain(i)) for i in range(8)]
    want += [(20, "http://other.example/", f"This site stores small files on your device\n{plain(20)}\nAll rights reserved by the owner of this site"),
             (21, "http://copy.example/1", plain(21)), (22, "http://copy.example/2", plain(21)),
             (23, "http://host.example/x", "All rights reserved by the owner of this site"), (24, None, ""), (None, "u", ""), (24, "", "plain text"), (25, "x", "")]
    assert got == sorted(want, key=str)


def test_runs_of_articles_are_found(spark):
    """Pages that mark their article take part as a whole: their blocks repeat, that is counted, and the marks keep them. What only articles
    of other pages hold is no boilerplate of a page without marks."""
    licence = "<p>This text may be copied by all who name its author</p>"
    page = lambda i: f"<nav>menu of this site with many entries</nav><article><h1>Title {i}</h1><p>Own words {i} of page {i}</p>{licence}</article>"
    rows = [(i, "http://a.example/", page(i)) for i in range(4)] + [(4, "http://b.example/", page(4)), (5, "http://a.example/", f"<p>Its own story, page without marks</p>{licence}")]
    rows += [(6, "http://c.example/", page(6)), (7, "http://c.example/", f"<main>{licence}<p>more {7}</p></main>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: (r.text, r.n_repeated) for r in mainhtml.extract(df, "page_id", "url", "html").collect()}
    text = "This text may be copied by all who name its author"
    want = {i: (f"Title {i}\nOwn words {i} of page {i}\n{text}", int(i != 4)) for i in (0, 1, 2, 3, 4, 6)}
    assert got == {**want, 5: (f"Its own story, page without marks\n{text}", 0), 7: (f"{text}\nmore 7", 1)}


def test_streams_hold_all_blocks_that_repeat(spark):
    rng = random.Random(8)
    host = [rng.choice(["a", "b", ""]) for _ in range(40)]
    tokens = [[rng.choice([rng.randrange(9), rng.randrange(10**9)]) for _ in range(rng.randrange(15))] for _ in host]
    out = [[rng.random() < .6 for _ in t] for t in tokens]
    df = spark.createDataFrame(list(zip(range(40), host, tokens, out, strict=True)), "row long, host string, tokens array<bigint>, outside array<boolean>")
    for outside in (False, True):
        use = [[not outside or o for o in x] for x in out]
        elsewhere = lambda row, t: any(t == u and w for r in range(40) if r != row and host[r] == host[row] for u, w in zip(tokens[r], use[r], strict=True))  # noqa: B023, E731
        want = {(row, i): t for row in range(40) for i, t in enumerate(tokens[row]) if use[row][i] and elsewhere(row, t)}
        found = [(r.row, s.at, s.tokens) for r in mainhtml.streams(df, outside).collect() for s in r.streams]
        assert {(row, at + i): t for row, at, some in found for i, t in enumerate(some)} == want
        assert not {(row, at + len(some)) for row, at, some in found} & {(row, at) for row, at, _ in found}  # neighbours are in one stream


def test_no_pages(spark):
    assert mainhtml.extract(spark.createDataFrame([], "page_id long, url string, html string"), "page_id", "url", "html").collect() == []
