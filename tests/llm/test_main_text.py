import random
import re
from html.parser import HTMLParser

import numpy as np
import pytest

from parcelwise.llm import main_text
from parcelwise.llm.boosting import boost
from parcelwise.llm.main_text import decode, derived, extract, features, fit, read

PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t='</p><article>';</script></head><body>"
    "<nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy now.</div>"
    "<article><h1>Head &lt;1&gt;</h1><p><b>First  line\n of the text, which is long enough to read.<br>Same block.<p>Second &eacute; part.</p>"
    "loose <i>words</i> here</article><footer>&copy; me</footer></body></html>"
)


def lines(page, inside):
    nodes, segments = read(page)
    return [t for k, t in segments if inside(nodes, k)]


def in_article(nodes, k):
    while k >= 0:
        if nodes[k].tag == "article":
            return True
        k = nodes[k].parent
    return False


def test_reading_blocks():
    want = ["Head <1>", "First line of the text, which is long enough to read. Same block.", "Second é part.", "loose words here"]
    assert lines(PAGE, in_article) == want
    everything = lines(PAGE, lambda nodes, k: True)
    assert everything == ["One", "Two", "Buy now.", *want, "© me"]
    for cut in range(len(PAGE)):  # a page may end anywhere
        nodes, segments = read(PAGE[:cut])
        assert len(features(nodes)) == len(nodes) == len(decode(nodes, np.zeros(len(nodes))))
        assert not any("<" in t.removesuffix("<") and "Head" not in t for _, t in segments)
    assert read("")[1] == [] and read("a < b > c &am")[1] == [(0, "a < b > c &am")]


def everything(page):
    return lines(page, lambda nodes, k: True)


def test_dropped_elements_end_where_html_ends_them():
    assert everything("<article><p>a <svg/>b</p><p>c</p></article>") == ["a b", "c"]
    assert everything("<p>a<svg><path d='x'/><g>no</g></svg>b<p>c") == ["ab", "c"]
    assert everything("<head><title>t</title><meta x><p>a</p><p>b</p>") == ["a", "b"]
    assert everything("<html><head><link>words <b>here</b>") == ["words here"]
    assert everything("<head><script>x</script></head><body>a</body>") == ["a"]
    for tag in ("button", "select", "math", "svg", "noscript", "object"):
        assert everything(f"<div>a<{tag}>no</div><p>b</p>") == ["a", "b"], tag
        assert everything(f"<div>a</div><{tag}>no<p>b</p>c") == ["a", "b", "c"], tag
        assert everything(f"<div>a<{tag}>no</{tag}>b</div><p>c") == ["ab", "c"], tag
    for tag in ("button", "noscript", "template", "object"):
        assert everything(f"<div>a<{tag}><div>no</div><p>no</{tag}>b</div><p>c") == ["ab", "c"], tag
    assert everything("<div><svg><foreignObject><div>no</div></foreignObject></svg>b</div>") == ["b"]
    assert everything("<div><button>x<button>y</button>b</div>") == ["b"]
    assert everything("<div>a<svg><g><p>b</p></div>c") == ["a", "b", "c"]


class Independent(HTMLParser):
    """Text by block of a page without errors, by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.held, self.hidden = [], "", 0

    def flush(self):
        text = re.sub(r"\s+", " ", self.held).strip()
        self.held = ""
        if text:
            self.out.append(text)

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HIDDEN
        if tag in main_text.BLOCKS and not self.hidden:
            self.flush()
        if tag == "br" and not self.hidden:
            self.held += " "

    def handle_startendtag(self, tag, attrs):
        if tag not in HIDDEN:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in main_text.BLOCKS and not self.hidden:
            self.flush()
        self.hidden -= tag in HIDDEN

    def handle_data(self, data):
        if not self.hidden:
            self.held += data


HIDDEN = ("svg", "button", "select", "noscript", "script", "style", "head")


def random_page(rng, depth=0):
    made = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.45 or depth > 3:
            made.append(rng.choice(["plain words ", "a &amp; b &lt;c&gt; &eacute;", "<b>bold</b> <i class='x>y'>it</i>", "one<br>two", "<svg/>", "<!-- no <p> -->", "<img src=x>"]))
        elif kind < 0.6:
            tag = rng.choice(["svg", "button", "select", "noscript", "script", "style"])
            made.append(f"<{tag} a='1'>{'hidden words ' if tag != 'svg' else '<g>hidden</g>'}</{tag}>")
        else:
            tag = rng.choice(["div", "section", "article", "ul", "table", "blockquote"])
            made.append(f"<{tag} class='k'>{random_page(rng, depth + 1)}</{tag}>")
    return "".join(made)


def test_same_text_as_an_independent_parser():
    rng = random.Random(11)
    for _ in range(300):
        page = f"<html><head><title>t</title><style>p{{}}</style></head><body>{random_page(rng)}</body></html>"
        parser = Independent()
        parser.feed(page)
        parser.close()
        parser.flush()
        assert everything(page) == parser.out, page


def test_learning_without_marked_or_short_articles(spark):
    """Pages in capitals, all long, or without an article teach something too, and no page is left empty."""
    para = "This is a paragraph of the text that readers come for, long enough to be one. It has two sentences. "
    menu = "<ul>" + "".join(f"<li><a href='#'>Link {k}</a></li>" for k in range(8)) + "</ul>"
    page = lambda k, tag, n: f"<html><body><div class='menu'>{menu}</div><{tag}>" + f"<p>{k} {para * 3}</p>" * n + f"</{tag}><div class='footer'>&copy; {k}</div></body></html>"
    for tag, n in (("ARTICLE", 3), ("article", 90), ("div", 4)):
        pages = spark.createDataFrame([(k, "u", page(k, tag, n)) for k in range(30)], "page_id long, url string, html string")
        got = extract(pages, fit(pages)).collect()
        assert all(r["text"].count(para.strip()[:40]) == 3 * n for r in got), tag
        assert not any("Link" in r["text"] for r in got), tag


def test_decoding_is_best_and_consistent():
    rng = np.random.default_rng(0)
    page = "<div>a<div>b<p>c</div><p>d</div><p>e"
    nodes, _ = read(page)
    n = len(nodes)
    for _ in range(50):
        logit = rng.normal(size=n)
        best, chosen = 0.0, None
        for bits in range(2**n):
            own = [bits >> k & 1 for k in range(n)]
            gap = False
            for k in range(n):
                path = []
                at = k
                while at >= 0:
                    path.append(own[at])
                    at = nodes[at].parent
                gap |= "101" in re.sub("0+", "0", "".join(map(str, path)))
            if not gap and (value := float(np.dot(own, logit))) > best + 1e-12:
                best, chosen = value, own
        got = decode(nodes, logit)
        assert float(np.dot(got, logit)) == pytest.approx(best)
        assert chosen is None or got.tolist() == [bool(x) for x in chosen]


def test_boosting_learns():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = boost(x[:1500], y[:1500], bins=256)  # bins finer than the rule
    assert ((trees.logit(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.97


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), sample_pages=120)


def test_whole_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(600)
    want = {r["page_id"]: "\n".join(lines(r["html"], in_article)) for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in extract(pages, model).collect()}
    assert sum(got[k] == want[k] for k in want) / len(want) > 0.99


def test_held_out_layouts(spark, model):
    """Pages with other containers and parts, made from pages that training has not seen."""
    rng = random.Random(99)
    good = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(300).collect():
        page = derived(r["html"], rng)
        nodes, segments = read(page)
        marks = [""] * len(nodes)
        for k, node in enumerate(nodes):
            marks[k] = node.mark or (marks[node.parent] if k else "")
        content = decode(nodes, model.logit(features(nodes)))
        good += [t for k, t in segments if content[k]] == [t for k, t in segments if marks[k] == "in"]
        total += 1
    assert good / total > 0.85


def test_edge_rows(spark, model):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", PAGE, "x"), (4, "u", PAGE, None), (4, "u", PAGE, None), (5, "u", "<p>" * 3000 + "deep", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages, model).collect()
    assert sorted((str(r["page_id"]), r["text"] == "\n".join(lines(PAGE, in_article))) for r in got if r["page_id"] != 5) == [("1", False), ("2", False), ("4", True), ("4", True), ("None", True)]
    empty = pages.limit(0)
    nothing = fit(empty)
    assert extract(empty, nothing).collect() == []
    assert {r["text"] for r in extract(pages, nothing).collect()} == {""}
