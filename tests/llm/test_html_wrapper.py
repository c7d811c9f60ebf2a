import html
import random
import re

import pytest

from cardloom.llm import html_wrapper as hw
from cardloom.llm.queries import op11_main_text

SCHEMA = "page_id long, url string, html string, host int, text string, wrapper int"
VOCABULARY = "river stone lamp under quiet seven market paper window green told march over house".split()


def sentences(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n)).capitalize() + "."


def extract(spark, pages):
    frame = spark.createDataFrame([(i, u, h, 1, "x", 2) for i, u, h in pages], SCHEMA).repartition(3)
    rows = hw.main_text(frame).collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return rows


def test_given_pages(spark, sample):
    """Their article is marked, so a plain pattern finds it too."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sample}/pages.parquet").collect()}
    rows = op11_main_text(spark, sample).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        blocks = [re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>|<br>", inner)]
        want = " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())
        assert r.text == want and r.url == pages[r.page_id].url


def templates(rng, k):
    """Pages of three hosts with unlike templates, and the text each article has."""
    title, paragraphs = sentences(rng, 6), [sentences(rng, rng.randint(20, 60)) for _ in range(rng.randint(2, 6))]
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    menu = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.sample(VOCABULARY, 4))
    comments = "".join(f"<li><p>{sentences(rng, 15)}</p></li>" for _ in range(rng.randint(0, 5)))
    wanted = " ".join([title, *paragraphs])
    yield "http://a.org/x", (
        f"<html><head><title>{title}</title><script>if (a < b) x('</p>')</script></head><body>"
        f"<header><h2>The Daily</h2><ul>{menu}</ul></header><div class='cookie-banner'>We use cookies {k}</div>"
        f"<main><article><h1>{title}</h1>{body}</article><aside><h3>More</h3><p>{sentences(rng, 30)}</p></aside>"
        f"<section id=comments><h3>Comments</h3><ul>{comments}</ul></section></main>"
        f"<form><p>Sign up {k}</p><input><button>Go</button></form><footer>(c) {k}</footer></body></html>"
    ), wanted
    # No mark of the article at all: lengths, links and the template's texts decide.
    yield "https://b.org/y", (
        f"<div><ul>{menu}</ul></div><div>Welcome to the site of b, all rights reserved by somebody</div>"
        f"<div><h1>{title}</h1>{body}</div><div>Written with care by the people of b since 1999</div>"
    ), wanted
    # Headings between paragraphs, unclosed tags, advertisements on some pages only.
    ad = f"<div class='ad-slot'><p>{sentences(rng, 12)}</p></div>" if rng.random() < 0.5 else ""
    mixed = "".join(f"<h2>Part {sentences(rng, 2)}</h2><p>{p}" for p in paragraphs)
    yield "https://c.org/z", (
        f"<nav>{menu}</nav><article class=post-{k}><h1>{title}</h1>{ad}{mixed}</article>"
        f"<div class=sidebar><p>{sentences(rng, 40)}</p></div>"
    ), " ".join([title, *re.sub(r"</h2><p>|<p>|<h2>", "\n", mixed).split("\n")[1:]])


def test_unlike_templates(spark):
    rng = random.Random(4)
    pages, wanted = [], {}
    for k in range(25):
        for url, page, text in templates(rng, k):
            wanted[len(pages)] = text
            pages.append((len(pages), f"{url}{k}", page))
    for r in extract(spark, pages):
        assert r.text == wanted[r.page_id]


def test_odd_pages(spark):
    pages = [
        (1, None, "<p>no address</p>"),
        (2, "no scheme", None),
        (3, "http://h/1", ""),
        (4, "http://h/2", "plain text only,\n without tags"),
        (5, "http://one/1", "<article>a<b>b</b>c &amp; &eacute;&#x41;&amp <br>d<i> e</article><!-- open"),
        (5, "http://one/1", "<article>a<b>b</b>c &amp; &eacute;&#x41;&amp <br>d<i> e</article><!-- open"),
        (None, "http://deep/1", "<div>" * 5000 + "deep" + "</div>" * 5000),
        (7, "http://long/1", "<article>" + "<p>one two three" * 20000 + "</article>"),
        (8, "http://bad/1", "<p class=\"x>text</p> 1 < 2 <a href='q'>l</a> tail <"),
        (9, "http://raw/1", "<article><p>x</p><script>never ends <p>y</p>"),
        (10, "http://nest/1", "<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul>"),
        (11, "HTTP://NEST/2?a", "<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>f</ul>"),
    ]
    got = extract(spark, pages)
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(pages)
    assert text[1] == "no address" and text[2] == "" and text[3] == ""
    assert text[4] == "plain text only, without tags"
    assert text[5] == "abc & éA& d e"
    assert text[None] == "deep"
    assert text[7] == " ".join(["one two three"] * 20000)
    assert text[9] == "x" and text[10] == "a b c d e" and text[11] == "a b c d f"
    assert hw.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pages_that_are_all_alike(spark):
    page = "<nav>a b</nav><article><h1>T</h1><p>the same on every page</p></article>"
    got = extract(spark, [(i, "http://x/1", page) for i in range(5)])
    assert {r.text for r in got} == {"T the same on every page"}


def test_notice_that_every_article_repeats(spark):
    rng = random.Random(8)
    pages = [
        (i, "http://x/1", f"<article><h1>T{i}</h1><div>Please write to us</div><p>{sentences(rng, 9)}</p></article>")
        for i in range(6)
    ]
    assert not any("Please" in r.text for r in extract(spark, pages))


def nodes_of(*pages):
    out = []
    for p in pages:
        nodes, texts = hw.folded(p, {})
        for n in hw.leaves(nodes):
            n[2] = [1, hash(texts[n[2][0]]) if len(n[2]) == 3 else None, 1, 0]
        out.append(nodes)
    return out


def shape(nodes):
    return "".join(
        (n[0].split("|")[0] if n[0] != hw.GROUP else "")
        + ("" if n[0] == hw.TEXT else f"({shape(n[2])})")
        + n[1].replace("1", "")
        for n in nodes
    )


@pytest.mark.parametrize(
    "pages, want",
    [
        (["<h1>a</h1><p>b</p>", "<h1>c</h1><p>d</p><p>e</p>"], "h1(#)p(#)+"),
        (["<h1>a</h1><p>b</p>", "<h1>c</h1><ul><li>x</ul><p>d</p>"], "h1(#)ul(li(#))?p(#)"),
        (["<h2>a</h2><p>b</p>", "<h2>c</h2><p>d</p><h2>c</h2><p>d</p>"], "(h2(#)p(#))+"),
        (["<h2>a</h2><p>b</p><h2>a</h2><p>b</p>", "<h2>c</h2><p>d</p>"], "(h2(#)p(#))+"),
        (["<div><p>a</div><div><p>b<ul><li>c</ul></div>"], "div(p(#)ul(li(#))?)+"),
    ],
)
def test_inferred_expressions(pages, want):
    first, *rest = nodes_of(*pages)
    for other in rest:
        first = hw._Wrappers().lists(first, other)
    assert shape(first) == want


def test_wide_levels_are_generalised_and_lose_no_text(spark):
    """Every page has blocks of its own names: names go, the texts stay."""
    rng = random.Random(9)
    pages, wanted = [], {}
    for i in range(150):
        parts = [sentences(rng, 8) for _ in range(3)]
        names = ["".join(rng.choices("bcdfgjk", k=8)) for _ in parts]
        blocks = "".join(f"<div class={n}>{p}</div>" for n, p in zip(names, parts))
        pages.append((i, "http://w/1", f"<article>{blocks}</article><nav>{parts[0]}</nav>"))
        wanted[i] = " ".join(parts)
    for r in extract(spark, pages):
        assert r.text == wanted[r.page_id]


def test_layout_of_the_pages_does_not_matter(spark):
    rng = random.Random(4)
    pages = [(k, f"{u}{k}", p) for k in range(12) for u, p, _ in templates(rng, k)]
    frame = spark.createDataFrame([(i, u, h, 1, "x", 2) for i, u, h in pages], SCHEMA)
    few = hw.wrappers(frame.withColumn("host", hw.host_of(frame.url)).coalesce(1))
    many = hw.wrappers(frame.withColumn("host", hw.host_of(frame.url)).repartition(7, "html"))
    assert sorted(few.collect()) == sorted(many.collect()) and few.count() == 3
