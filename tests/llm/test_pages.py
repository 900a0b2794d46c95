"""Operators over pages on odd rows."""

from __future__ import annotations

import base64
import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.conftest import write
from tickwise.llm import htmltext, queries, urlfilter, warc

PAGES = [
    (1, "http://a.example.org/es/x?q#f", "<p>one</p>"), (2, "HTTP://B.Example.Org/en/12", "<p>one</p>"),
    (3, None, None), (4, "no scheme", ""), (4, "http://example.org/es/", "<p>one</p>"),
    (None, "http://com/fr/\r\nX: y", "<p>ünï</p>"), (5, "http://x.com/de/", "<p>ünï</p>"),
    (6, "http://notexample.org/es/", "z" * 3_000_000), (7, "://", "<article>"), (8, "http://net", "a & b"),
]


@pytest.fixture(scope="module")
def pages_dir(spark, tmp_path_factory):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = rows.withColumns({c: F.lit("x") for c in ("host", "path", "text", "row_key", "digest", "payload")})
    return write(spark, str(tmp_path_factory.mktemp("pages")), pages=rows)


def test_archives(spark, pages_dir):
    got = sorted((tuple(r) for r in queries.op4_warc(spark, pages_dir).collect()), key=repr)
    first, want = {}, []
    for k, (p, _, h) in enumerate(PAGES):
        order = (p is None, p or 0, k)
        first[h or ""] = min(first.get(h or "", order), order)
    for k, (p, _, h) in enumerate(PAGES):
        raw, order = (h or "").encode(), first[h or ""]
        revisit = order != (p is None, p or 0, k)
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "revisit" if revisit else "response", order[1] if revisit else None))
    # of the two rows with id 4 and different payloads each is judged on its own
    assert got == sorted(want, key=repr)


def test_bundles_are_seekable_and_plain_zstd_reads_them(spark, pages_dir, tmp_path):
    rows = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 500) for i in range(200)],
                                 "page_id long, url string, html string").repartition(2)
    folder = str(tmp_path / "w")
    index = warc.write_bundles(rows, folder, "page_id", "page_id", "url", "html", frame_bytes=20_000)
    places = index.collect()
    assert len({(p.bundle, p.frame) for p in places}) > 10
    for bundle in {p.bundle for p in places}:
        with open(bundle, "rb") as f:  # any reader of the format sees the records one after another
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") == sum(p.bundle == bundle for p in places)
    back = {r.page_id: r.payload for r in warc.read_bundles(index).collect()}
    assert back == {i: (f"<p>{i}</p>" * 500).encode() for i in range(200)}
    # payloads under min_bytes are never revisits
    same = spark.createDataFrame([(1, None, "a"), (2, None, "a")], "page_id long, url string, html string")
    kinds = [r.record_type for r in warc.read_bundles(
        warc.write_bundles(same, folder, "page_id", "page_id", "url", "html", min_bytes=2)).collect()]
    assert kinds == ["response"] * 2


def judged(url):
    host, _, path = ("", "", "")
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = []
    for rule, verdict in queries.URL_RULES:
        rh, _, rp = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith("/" + rp):
            fits.append((len(rule), verdict == "block", rule, verdict))
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_filter(spark, pages_dir):
    got = sorted((tuple(r) for r in queries.op5_url_filter(spark, pages_dir).collect()), key=repr)
    assert got == sorted(((p, *judged(u)) for p, u, _ in PAGES), key=repr)


def test_url_rules_edge_cases(spark):
    urls = spark.createDataFrame([(1, "http://h/a/b")], "page_id long, url string")
    assert urlfilter.url_filter(urls, "page_id", "url", urlfilter.rules_table(spark, [])).collect()[0].verdict == "allow"
    both = urlfilter.rules_table(spark, [("h/a", "allow"), ("h/a", "block"), ("h/", "allow")])
    assert urlfilter.url_filter(urls, "page_id", "url", both).collect()[0].verdict == "block"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies.</div><div class="ad">Buy.</div>
<div class="layout"><div class="post post-17"><h2>Title &amp; more</h2><p>First   para <b>bold</b><br>next<p>Second &lt;x&gt;
 para <a href="/y">link</a></p><form><input><label>Mail</label></form><ul><li>one<li>two</ul>
<!-- <p>hidden</p> --><pre>a
 b</pre></div><aside>Related</aside><section class="comments"><p>I liked it a lot, thank you for writing it.</p></section></div>
<footer>&copy; me</footer></body></html>"""


def test_extraction_of_a_page_with_all_kinds_of_furniture():
    blocks, paths = htmltext.parse(PAGE)
    best = paths[htmltext.best_container(blocks, paths)]
    assert best == "/body/div.layout/div.post.post-#"
    assert htmltext.main_text(PAGE, best) == (
        "Title & more\nFirst para bold next\nSecond <x> para link\none\ntwo\na b")
    # a host's path that the page lacks falls back on the page's own
    assert htmltext.main_text(PAGE, "/body/article") == htmltext.main_text(PAGE, None)


@pytest.mark.parametrize("page, want", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<script>x", ""), ("<div><p>a</div></b></p>c", "a\nc"),
    ("<p>1 < 2 &amp 3 &#x41;&nope;</p>", "1 < 2 & 3 A&nope;"), ("<!-- x", ""), ("<p", ""), ("<table><tr><td>x<td>y</table>", "x\ny")])
def test_broken_pages(page, want):
    assert htmltext.main_text(page, None) == want


@pytest.mark.parametrize("page, want", [
    # nothing but links, with and without a container that holds no text
    ("<html><body><a href='/'>Home</a></body></html>", "Home"),
    ("<body><div class='x'></div><p><a href='/'>Home</a></p><ul><li><a href='/b'>B</a></ul></body>", "Home\nB"),
    # anchors that are no links, or are never closed, do not spoil what follows
    ("<body><div>side</div><article><a name=x><p>" + "long text " * 9 + "</p></article></body>", ("long text " * 9).strip()),
    ("<body><div>side</div><article><p><a href=x>to<p>" + "long text " * 9 + "</article></body>",
     "to\n" + ("long text " * 9).strip()),
    ("<body><div>side</div><article><p><a href=x>to</p><p>" + "long text " * 9 + "</p></article></body>",
     "to\n" + ("long text " * 9).strip())])
def test_links(page, want):
    assert htmltext.container_vote(page)
    assert htmltext.main_text(page, None) == want


def test_links_count_where_they_are_open():
    def linked(page):
        return [b[2] for b in htmltext.parse(page)[0]]
    assert linked("<p><a href=x>one</a> two<p>three") == [3, 0]
    assert linked("<ul><li><a href=x>one<li><a href=y>two</ul><p>three") == [3, 3, 0]
    assert linked("<a href=x><div>one</div><div>two</div></a><p>three") == [3, 3, 0]


BODY = "long text " * 50


@pytest.mark.parametrize("page, want", [
    ("<article><h1>Title</h1><div class=body><p>{}</div><p>Closing</p></article>", "Title\n{}\nClosing"),
    ("<article><section class=lead>Lead</section><section class=body><p>{}</section></article>", "Lead\n{}"),
    ("<div class=post><div class=lead>Lead</div><div class=body><p>{}</div></div><div>side</div>", "Lead\n{}"),
    ("<p>Own text of the body</p><div class=body><p>{}</div>", "Own text of the body\n{}"),
    # links alone do not widen it
    ("<div class=page><ul><li><a href=x>Home</a></ul><div class=body><p>{}</div></div>", "{}")])
def test_nothing_around_the_best_container_is_lost(page, want):
    page, want = f"<body>{page.format(BODY)}</body>", want.format(BODY.strip())
    assert htmltext.main_text(page, None) == want
    assert htmltext.main_text(page, htmltext.container_vote(page)) == want
    # nor where the host's other pages have no text around it
    inner = [p for p in htmltext.parse(page)[1] if p.endswith(".body")][0]
    assert htmltext.main_text(page, inner) == want


@pytest.mark.parametrize("part, want", [
    ("<figure><img src=x><figcaption>Figure 1</figcaption></figure>", "Figure 1"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", "so x=1 holds"),
    ("<section id='discussion'><p>Discussed</p></section>", "Discussed"),
    ("<h2 id='related-work'>Related work</h2>", "Related work"),
    ("<h2 class='section-header'>Part</h2><h3 class=header>Sub</h3>", "Part\nSub"),
    ("<div class='search-results-study'><div><p>Found</p></div></div>", "Found"),
    ("<p>a <span class='search-term'>word</span></p>", "a word"),
    # named furniture stays out
    ("<section class='comments'><p>nice</p></section><div class='ad-box'>Buy</div><div id=shareButtons>x</div>", None),
    ("<div class=search-study><p>Found</p><div class=ad>Buy</div></div>", "Found")])
@pytest.mark.parametrize("tag", ["article", "div class=post"])
def test_content_of_an_article_is_no_furniture(tag, part, want):
    page = f"<body><{tag}><p>{BODY}</p>{part}<p>End</p></{tag.split()[0]}></body>"
    want = "\n".join(t for t in (BODY.strip(), want, "End") if t)
    assert htmltext.main_text(page, None) == want
    assert htmltext.main_text(page, htmltext.container_vote(page)) == want


def test_parts_of_names_are_furniture_outside_the_article():
    page = ("<body>{}<div class='page-header-x'><p>Site</p></div><div class=post><p>" + BODY
            + "</p></div><section id=comments><p>nice</p></section></body>")
    assert htmltext.main_text(page.format(""), None) == BODY.strip()
    assert htmltext.main_text(page.format("<p>Intro</p>"), None) == "Intro\n" + BODY.strip()
    # unless the page has nothing else
    assert htmltext.main_text("<div class='search-results-study'><p>Found</p></div>", None) == "Found"


def test_extraction_by_consensus(spark):
    # one page of the host has a longer sidebar than article: the host's vote decides
    page = "<body><div class='main'><p>{}</p></div><div class='extra'><p>{}</p></div></body>"
    rows = [(i, "http://h/", page.format("article text " * 20, "side")) for i in range(5)]
    rows.append((9, "http://h/", page.format("brief", "side words " * 50)))
    df = spark.createDataFrame([*rows, (10, None, None)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in htmltext.extract_text(df, "url", "html").collect()}
    assert got[9] == "brief" and got[10] == "" and got[0].startswith("article text")


def test_extraction_of_odd_rows(spark, pages_dir):
    rows = queries.op10_html_text(spark, pages_dir).collect()
    assert len(rows) == len(PAGES) and all(r.n_chars == len(r.text) for r in rows)


def test_deep_nesting_takes_linear_memory():
    import tracemalloc
    page = "<div>" * 100_000 + "deep text"
    tracemalloc.start()
    assert htmltext.main_text(page, None) == "deep text"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    # so do closing tags that close nothing
    assert htmltext.main_text("<b>" * 20_000 + "</i>" * 20_000 + "x", None) == "x"


@pytest.mark.parametrize("page, want", [
    ("<div hidden>gone</div><p>stays</p>", "stays"), ("<div hidden=''>gone</div><p>stays</p>", "stays"),
    ("<script data-x=it's>var x = 1;</script><p>text</p>", "text"),
    ("<p title='a>b' lang=\"x>y\">in</p>", "in"), ("<p data-note=5\">in</p>", "in"),
    ("<p x='never closed>in</p>", "in")])
def test_odd_attributes(page, want):
    assert htmltext.main_text(page, None) == want


def test_an_article_keeps_its_header_and_topics():
    body = f"<p>{BODY}</p>"
    head = f"<article><header><h1>Title</h1><p>Lead</p></header><div class=body>{body}</div></article>"
    for page in (head, f"<body><header><p>Site</p></header>{head}</body>"):
        for path in (None, htmltext.container_vote(page)):
            assert htmltext.main_text(page, path) == f"Title\nLead\n{BODY.strip()}"
    for part in ("<div class='sharing'><p>About sharing</p></div>", "<p class='search'>About sharing</p>",
                 "<table id='search'><tr><td>About sharing</table>"):
        assert htmltext.main_text(f"<article>{body}{part}</article>", None) == f"{BODY.strip()}\nAbout sharing"
    # but a box of links of that name is furniture, and so is one outside the article
    links = "<div class='related'><ul><li><a href=x>More</a><li><a href=y>Even more</a></ul></div>"
    assert htmltext.main_text(f"<article>{body}{links}</article>", None) == BODY.strip()
    assert htmltext.main_text(f"<article>{body}</article><div class=related><p>Read on</p></div>", None) == BODY.strip()


@pytest.mark.parametrize("layout", [
    "<html><body><nav><a href=/>Home</a></nav><main><article>{}</article></main><footer>f</footer></body></html>",
    "<body><div id=wrap><div class='ad'>Buy</div><div class='post p-{n}'>{}</div><aside><p>side</p></aside></div></body>",
    "<table><tr><td><ul><li><a href=a>a</a></ul><td class=content>{}</table>",
    "<article><header><h1>{first}</h1></header><section>{rest}</section></article>"])
def test_known_texts_come_back_from_any_layout(layout):
    import html

    import duckdb

    from tests.conftest import SF001
    texts = duckdb.sql(f"SELECT text FROM '{SF001}/documents.parquet' WHERE length(text) BETWEEN 300 AND 5000").fetchall()
    for n, (text,) in enumerate(texts[:60]):
        want = [x for line in text.split("\n") if (x := " ".join(line.split()))]
        blocks = [f"<p>{html.escape(x)}</p>" for x in want]
        page = layout.format("\n".join(blocks), n=n, first=html.escape(want[0]), rest="\n".join(blocks[1:]))
        for path in (None, htmltext.container_vote(page)):
            assert htmltext.main_text(page, path) == "\n".join(want)


def test_url_expressions_and_rules_join_on_the_hash_prefix_alone(spark):
    import re

    from tests.conftest import SF001, plan_text
    txt = plan_text(queries.op5_url_filter(spark, SF001))
    keys = re.findall(r"(?:Left|Right) keys \[(\d+)\]: (.*)", txt)
    assert keys and all(n == "1" and "prefix_key" in k for n, k in keys)
