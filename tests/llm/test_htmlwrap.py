import html
import random
import re

import corpus
import pytest

from acctpulse.llm import htmlwrap
from acctpulse.llm.htmlwrap import Page, added, merge

SCHEMA = "page_id bigint, url string, html string"


def texts(spark, pages, **more):
    df = spark.createDataFrame(pages, SCHEMA).selectExpr("*", "1 as form", "'x' as text", "2 as slots", "3 as blocks")
    got, _ = htmlwrap.extract(df, ["page_id", "url"], **more)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert all(len(r.text) == r.n_chars for r in rows)
    return {r.page_id: r.text for r in rows}


def by_tags(source):
    """The article of the given tables' pages, cut at its tags of blocks."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", re.sub(r"(?s)<(script|style).*?</\1>|<!--.*?-->", "", source), re.S)
    blocks = re.split(r"</?(?:h1|p)>", inner[1]) if inner else []
    told = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(b for b in told if b)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_given_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    got, wrappers = htmlwrap.extract(pages, ["page_id"])
    expected = {r.page_id: by_tags(r.html) for r in pages.collect()}
    assert {r.page_id: r.text for r in got.collect()} == expected
    hosts = wrappers.collect()
    assert len({r.host for r in hosts}) == len(hosts) and sum(r.pages for r in hosts) == pages.count()


def template(rng, n, notice="", foot=True):
    """A page without telling elements, its text and what is around it."""
    lines = [corpus.text(rng, "en", rng.randint(30, 60)).replace("\n", " ") for _ in range(n)]
    parts = [f"<div class=x{rng.randint(1, 99)}><span>{line[:20]}</span>{line[20:]}</div>" if i % 3 == 2 else f"<p>{line}" for i, line in enumerate(lines)]
    links = "".join(f"<div><a href=/{i}>Section {i}</a></div>" for i in range(rng.randint(2, 6)))
    bottom = "<div class=c><p>All rights reserved by the house of Example, in every country.</p></div>" if foot else ""
    return (
        f"<html><body><div id=top>{links}</div><div id=q>{notice}<div class=body>{''.join(parts)}</div></div>{bottom}</body></html>",
        "\n".join(lines),
    )


def test_pages_without_telling_elements_are_cut_by_their_hosts_wrapper(spark):
    rng = random.Random(2)
    made = [template(rng, rng.randint(2, 7), "<p class=cookie-notice>We use cookies</p>" if i % 2 else "") for i in range(40)]
    pages = [(i, f"http://host.example/{i}", source) for i, (source, _) in enumerate(made)]
    assert texts(spark, pages) == {i: text for i, (_, text) in enumerate(made)}


NOISE = (
    "<header><h1>Site</h1></header><nav>menu</nav><div class='sidebar-left'>side</div><aside>aside</aside>"
    "<div role=navigation>x</div><form>field <p>label</p></form><div class='siteNotice'>n</div><footer>foot</footer>"
    "<script>if (a < b) document.write('</p><article>no</article>')</script><style>p{}</style>"
    "<section id=comments><article class=comment><p>first!</p></article></section><noscript>on</noscript>"
)
CASES = {
    "A <b> &amp; A\u00e9\nB": "<article><h1>A &lt;b&gt; &amp;amp; &#x41;&eacute;</h1><p>B</article>",
    "one two three\nfour": "<main><p>one\n\t <b>two</b><!-- x --> <i>three</i><p>four</main>",
    "a b\nc": f"{NOISE}<article>{NOISE.replace('<header><h1>Site</h1></header>', '')}<p>a<br>b</p>c</article>{NOISE}",
    "Head\nText, more": "<article><header><h1>Head</h1></header><p>Text<span class=ad>buy <span>now</span></span>, more</article>",
    "x\ny\nz\n1\n2": "<article><ul><li>x<li>y</ul><dl><dt>z</dl><table><tr><td>1<td>2</table></article>",
    "open to the end": "<article><p>open to the end<p class='un",
    "5 < 6 & 7": "<article>5 < 6 & 7</article>",
    "tail": "<form action=x><article><p>tail</p></article></form>",
    "in\nout": "<article><td>in</div></td><p>out</article>",
    "kept": "<div class='has-sidebar'><article class='post with-comments'>kept</article></div>",
    "quoted": "<article><p title=\"a > b\" data-x='</article>'>quoted</p></article>",
}


def test_cases_by_hand(spark):
    pages = [(i, f"http://h{i}.example/", source) for i, source in enumerate(CASES.values())]
    assert texts(spark, pages) == dict(enumerate(CASES))
    assert texts(spark, pages, broadcast_forms=0) == dict(enumerate(CASES))


def test_awkward_rows(spark):
    rng = random.Random(4)
    long = "".join(f"<p>{corpus.text(rng, 'en', 9)} &amp; {i}" for i in range(20_000))
    deep = "<div>" * 5_000 + "deep" + "</div>" * 5_000
    pages = [
        (1, None, None), (2, "http://a.example", ""), (3, "no host", "plain words"), (4, "http://a.example/", "<p>"),
        (5, "http://a.example/", f"<article>{long}</article>"), (6, "http://b.example/", f"<article>{deep}</article>"),
        (7, "http://c.example/", "<article>" + "<p " * 50_000), (8, "http://c.example/", "<!--" * 50_000),
        (9, "http://c.example/", "<article>" + "<h2>t</h2><p>u</p>" * 5_000 + "</article>"),
        (10, "http://c.example/", "<article>" + "".join(rng.choice(["<p>p</p>", "<ul><li>l</ul>", "<h2>h</h2>", "<pre>c</pre>", "t"]) for _ in range(5_000))),
    ]
    same = [(50, "http://d.example/", "<body><div>the very same page, often crawled</div></body>")] * 6
    told = texts(spark, pages + same)
    assert [told[i] for i in (1, 2, 4, 6, 7, 8)] == ["", "", "", "deep", "", ""]
    assert told[5].count("\n") == 19_999 and told[9] == "\n".join(["t\nu"] * 5_000)
    assert len(told[10].replace("\n", "")) == 5_000 and told[3] == "plain words"
    assert told[50] == "the very same page, often crawled"
    got, _ = htmlwrap.extract(spark.createDataFrame(pages + same, SCHEMA), ["page_id"])
    assert got.count() == len(pages + same)
    assert htmlwrap.extract(spark.createDataFrame([], SCHEMA), ["page_id"])[0].collect() == []


def expression(*sources):
    whole = None
    for source in sources:
        page = Page(source)
        for slot in page.root.slots():
            slot.data = [1, 1, 0, 0, 0]
        whole = merge(whole, page.root, added) if whole else page.root
    return whole.expression()


def test_mismatches_become_optional_and_repeated_groups():
    assert expression("<p>a<p>b<p>c") == "page(p(#)+)"
    assert expression("<dl><dt>a<dd>b<dt>c<dd>d</dl>") == "page(dl((dt(#) dd(#))+))"
    assert expression("<h1>a</h1><p>b", "<h1>a</h1><ul><li>x</ul><p>b") == "page(h1(#) ul(li(#))? p(#))"
    assert expression("<p>b", "<h1>a</h1><p>b<p>c<hr>") == "page(h1(#)? p(#)+)"
    rng = random.Random(1)
    mixed = "".join(rng.choice(["<p>x</p>", "<h2>y</h2>", "<ul><li>z</ul>"]) for _ in range(500))
    assert expression(mixed) == "page((h2(#)+? p(#)+? ul(li(#))+?)+)"


def test_many_forms_of_one_host_are_aligned_in_rounds(spark):
    rng = random.Random(6)
    kinds = ["h2", "p", "pre", "blockquote", "ul", "table", "dl", "figure"]
    pages = []
    for i in range(400):
        inner = "".join(f"<{k}>{k} {i}</{k}>" for k in (rng.choice(kinds) for _ in range(rng.randint(1, 12))))
        pages.append((i, "http://one.example/", f"<nav>n</nav><article>{inner}</article>"))
    df = spark.createDataFrame(pages, SCHEMA)
    found = htmlwrap.forms(df)
    assert found.count() > 5 * htmlwrap.GROUP_FORMS
    got, wrappers = htmlwrap.extract(df, ["page_id"])
    assert [r.pages for r in wrappers.collect()] == [400]
    expected = {i: "\n".join(t for t in re.split(r"<[^>]*>", source.split("</nav>")[1]) if t) for i, _, source in pages}
    assert {r.page_id: r.text for r in got.collect()} == expected
