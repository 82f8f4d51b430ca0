"""Extraction against pages made from known articles, templates without article elements, and odd rows."""

import html
import random
import re
import time
from collections import defaultdict

import pytest
from lexloom.llm import html_text

WORDS = "alpha beta gamma delta R&D <tag> café © lorem ipsum".split()


def article(rng):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 60))) for _ in range(rng.randint(1, 6))]


def body(paragraphs):
    return "".join(f"<p>  {html.escape(p)}\n" + ("</p>" if k % 2 else "") for k, p in enumerate(paragraphs))


def semantic(rng, paragraphs):
    return (
        "<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t='</p><article>no</article>';</script></head><body>"
        "<header><h1>Site</h1></header><nav><ul><li><a href='/x'>no</a></li></ul></nav><div class='cookie-notice'>no</div><!-- <p>no</p> -->"
        f"<main><article id=a1>{body(paragraphs)}<form><label>no</label><input></form><aside>no</aside><section class='comments'><article><p>no</p></article></section></article></main>"
        f"<div class='sidebar widget'><p>no {rng.random()}</p></div><div class=ad>no {rng.random()}</div><footer>&copy; no</footer></body></html>"
    )


def divs(rng, paragraphs):
    return (
        f"<html><body><div class=c1><a href=/>Home</a> <a href=/n>News {rng.random()}</a></div><div class=c2>Constant slogan of this site</div><div class=c3><div>{body(paragraphs)}</div></div>"
        "<div class=c4><p>All rights reserved</p></div></body>"
    )


def plain(paragraphs):
    return " ".join(" ".join(p.split()) for p in paragraphs)


@pytest.mark.parametrize("make", [semantic, divs])
def test_known_articles(spark, make):
    rng = random.Random(4)
    rows, want = [], {}
    for k in range(60):
        text = article(rng)
        want[k] = plain(text)
        rows.append((k, f"http://h{k % 3}.org/{k}", make(rng, text)))
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r.text for r in html_text.main_text(spark.read.parquet(f"{sf}/pages.parquet")).collect()}
    for p in pages:
        assert got[p.page_id] == inner(p.html)


def variants(page):
    """A page with its article under other names, and in wrappers that are called like a sidebar."""
    yield re.sub(r"(</?)(article|main)\b", r"\1div", page)
    yield page.replace("<article>", "<div class=post-body>").replace("</article>", "</div>")
    yield page.replace("<body>", "<body class='search-ready comment-enabled'>").replace("<article>", "<div class='related-work'><article class='has-sidebar'>").replace("</article>", "</article></div>")


def test_other_names(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    want = {p.page_id: inner(p.html) for p in pages}
    for k in range(3):
        rows = [(p.page_id, p.url, list(variants(p.html))[k]) for p in pages]
        got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
        assert sum(r.text == want[r.page_id] for r in got) >= 0.95 * len(rows)


def inner(page):
    found = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", page)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", found[1] if found else "")).split())


def plain_template(pages):
    """Slots and template text of one host from the vectors themselves: a count for each distinct page."""
    pages = sorted({p for p in pages if p})
    counts, facts = defaultdict(lambda: [0] * len(pages)), {}
    for k, page in enumerate(pages):
        for number, above, kind, n, weight in html_text._tokens(page):
            counts[number][k] = n
            old = facts.get(number, (above, kind, 0.0))
            facts[number] = (above, kind, old[2] + weight)
    least = max(html_text.LEAST_PAGES, html_text.SUPPORT * len(pages))
    on = {x: sum(map(bool, c)) for x, c in counts.items()}
    return html_text.deduce([(x, facts[x][0], facts[x][1], tuple(c), on[x], sum(c), facts[x][2]) for x, c in counts.items() if on[x] >= least])


def test_templates_are_those_of_plain_vectors(spark):
    rng, hosts = random.Random(8), {}
    for h in range(6):
        notice = f"<div class=x{h}><p>The same words on every page of host {h}</p></div>"
        make = [semantic, divs][h % 2]
        hosts[f"h{h}"] = [make(rng, article(rng)).replace("</body>", (notice if rng.random() < 0.9 else "") + "</body>") for _ in range(rng.randint(1, 25))]
        hosts[f"h{h}"] += [hosts[f"h{h}"][0]] * 5 + ["", None]
    rows = [(h, p) for h, pages in hosts.items() for p in pages]
    got = {r.host: r for r in html_text.templates(spark.createDataFrame(rows, "host string, html string")).collect()}
    for h, pages in hosts.items():
        weights, texts = plain_template(pages)
        assert (h in got) == (len({p for p in pages if p}) >= html_text.LEAST_PAGES)
        if h in got:
            found = dict(zip(got[h].paths, got[h].weights))
            assert found.keys() == weights.keys() and all(abs(found[x] - weights[x]) < 1e-6 for x in weights)
            assert got[h].texts == texts and len(texts) > 0


def test_template_decides(spark):
    """Repeated text inside the slot goes by its vector alone; pages that are copies but for an advert keep theirs."""
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(30):
        text = article(rng)
        rows.append((k, f"http://one.org/{k}", f"<body><div class=top><p>{rng.random()}</p></div><div class=c>{body(text)}<p>Read more of this site every day</p></div><div class=end><p>end {rng.random()}</p></div></body>"))
        want[k] = plain(text)
    text = article(rng)
    for k in range(100, 110):
        rows.append((k, f"http://two.org/{k}", f"<body><article>{body(text)}</article><div class=ad>{rng.random()}</div></body>"))
        want[k] = plain(text)
    rows += [(200, "http://one.org/x", None), (201, "http://one.org/y", "<html><p>Error 404</p></html>")]
    want |= {200: "", 201: "Error 404"}
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


@pytest.mark.parametrize("piece", ["<div>", "<a ", "<b><p>x", "<a '>", "<p class='x>y", "<!--", "<script>", "&amp", "= <i = ", "</q></zz><div>"])
def test_broken_pages_take_time_in_proportion(piece):
    began = time.process_time()
    html_text.extract(piece * (200_000 // len(piece)))
    assert time.process_time() - began < 2


@pytest.mark.parametrize(
    "page, want",
    [(None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<b>b</b>c<br>d<p>e", "abc d e"), ("<article>x</article><p>y", "x"), ("<article>a < b &#233; &nbsp; c<di", "a < b é c"), ("<p>" * 3000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep")],
)
def test_pieces(page, want):
    assert html_text.extract(page) == want


def test_odd_rows(spark):
    rows = [(None, None, None), (1, "http://a.b/c", "<p>x"), (1, "http://a.b/c", "<p>x"), (2, "u", "<article>" + "w " * 200000)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = html_text.main_text(pages).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, 1, 399999]
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_wrappers_with_readers_names():
    """A wrapper called after comments, or a form around the page, does not take the article with it; comments still go."""
    text = " ".join(f"Sentence number {k} of the article stands here." for k in range(12))
    foot = "<footer>Address, imprint, terms of use, and all that stands at the end.</footer>"
    for wrap in ("<div class='comments-open page'>", "<form id=aspnetForm>"):
        end = "</form>" if "form" in wrap else "</div>"
        assert html_text.extract(f"<body>{wrap}<p>{text}</p>{end}{foot}</body>") == text
        assert html_text.extract(f"<body>{wrap}<nav>Home About</nav><div><p>{text}</p></div>{end}{foot}</body>") == text
    many = "".join(f"<p>Reader {k} says that this is long and wrong, and goes on about it.</p>" for k in range(60))
    assert html_text.extract(f"<body><article><p>{text}</p></article><div class=comments>{many}</div></body>") == text
    assert html_text.extract(f"<body><div><p>{text}</p></div><form><input><p>Your name and mail</p></form></body>") == text
