"""The main text of web pages: boosted trees over DOM nodes, decoded over the tree.

A page is read into its block elements; text belongs to the innermost block around it. For every block
the trees give the odds of being content, from the density of its subtree, attribute tokens, depth and its
siblings. Decoding picks the best labels of the whole tree at once: outside content may lie content, content may
hold blocks that are not, but below those nothing is content again, so no descendant contradicts an ancestor.

Training takes a bounded sample of pages that mark their article, and derives further pages from each: the
article in other containers, other boilerplate around and inside. So the trees don't lean on one mark.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelwise.llm.boosting import Trees, boost

SAMPLE_PAGES = 200
SAMPLE_CHARS = 20_000
VARIANTS = 5

# Elements of the HTML standard, and words that name parts of pages.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("head noscript template svg math select button object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What a head may hold, the foreign elements, what ends them, and the places in them where html goes on.
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
FOREIGN = frozenset("svg math".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small"
    " span strong strike sub sup table tt u ul var".split()
)
HTML_INSIDE = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
CLOSES_P = BLOCKS - {"body", "html", "li", "dd", "dt", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
GOOD_WORDS = frozenset("article body content entry main post story text blog hentry page prose single".split())
BAD_WORDS = frozenset(
    "ad ads advert advertisement alert aside banner bar box breadcrumb breadcrumbs bottom comment comments consent cookie cookies disclaimer disqus"
    " discussion foot footer form header login masthead menu meta modal nav navbar navigation newsletter notice notification pagination popup"
    " promo promoted related reply replies respond rss search share sharing shoutbox sidebar signup social sponsor sponsored subscribe tags toolbar top topbar"
    " warning widget".split()
)
TAG_GROUPS = tuple(
    frozenset(g.split())
    for g in ("p pre blockquote", "h1 h2 h3 h4 h5 h6", "li dd dt", "ul ol dl menu dir", "article main", "nav aside footer header", "div section", "form fieldset legend dialog", "table tr td th tbody thead tfoot", "body html")
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    place: int  # among the parent's children
    start: int  # characters of text before it
    words: frozenset = frozenset()
    mark: str = ""
    children: list[int] = field(default_factory=list)
    chars: int = 0
    link_chars: int = 0
    n_words: int = 0
    stops: int = 0
    own_chars: int = 0


def read(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The blocks of a page, parents first, and its text segments (block, text) in page order.

    Inline elements, known or not, only pass their text on. A start tag closes what the standard lets it close.
    """
    nodes = [Node("html", -1, 0, 0, 0)]
    open_blocks = [0]
    segments: list[tuple[int, str]] = []
    held: list[str] = []
    state = {"chars": 0, "link": 0, "linked": 0}
    at, size = 0, len(page)
    hidden: list[str] = []

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                node = nodes[open_blocks[-1]]
                node.own_chars += len(text)
                node.chars += len(text)
                node.link_chars += min(state["linked"], len(text))
                node.n_words += text.count(" ") + 1
                node.stops += text.count(". ") + text.count("! ") + text.count("? ") + text.endswith((".", "!", "?"))
                state["chars"] += len(text)
                segments.append((open_blocks[-1], text))
            state["linked"] = 0

    def close(upto: int) -> None:
        flush()
        del open_blocks[upto:]

    def innermost(tags: frozenset, stop: frozenset = frozenset()) -> int | None:
        for k in range(len(open_blocks) - 1, 0, -1):
            tag = nodes[open_blocks[k]].tag
            if tag in tags:
                return k
            if tag in stop:
                return None
        return None

    def foreign() -> int | None:
        """Where in ``hidden`` the foreign element begins that html would end now."""
        for k in range(len(hidden) - 1, -1, -1):
            if hidden[k] in HTML_INSIDE:
                return None
            if hidden[k] in FOREIGN:
                return k
        return None

    def never_closed(tag: str) -> bool:
        """No end tag follows: such an element ends with the next block."""
        if tag not in last_end:
            if not last_end:
                last_end[""] = page.lower()
            last_end[tag] = last_end[""].rfind("</" + tag)
        return last_end[tag] < at

    last_end: dict = {}
    for match in _TOKEN.finditer(page):
        if match.start() < at:
            continue  # inside a raw element
        text = page[at : match.start()]
        at = match.end()
        if hidden == ["head"] and text.strip():
            hidden.clear()
        if text and not hidden:
            held.append(text)
            if state["link"]:
                state["linked"] += len(text)
        tag = (match[2] or "").lower()
        if not tag:
            continue
        closing = match[1] == "/"
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            continue
        closed = match[3].rstrip().endswith("/") and tag in FOREIGN
        if hidden:
            if closing and tag in hidden:
                while hidden.pop() != tag:
                    pass
                continue
            if not closing and tag in ENDS_FOREIGN and (k := foreign()) is not None:
                del hidden[k:]
            elif closing:
                if tag not in BLOCKS or innermost(frozenset([tag])) is None:
                    continue
                hidden.clear()  # the end of what the dropped element stands in
            if hidden and not closing:
                if tag == "body" or hidden == ["head"] and tag not in HEAD or never_closed(hidden[0]) and tag in BLOCKS:
                    hidden.clear()
            if hidden:
                again = tag == hidden[-1] and tag in ("button", "select")  # the second one ends the first
                if (tag in BLOCKS or tag in DROPPED or tag in HTML_INSIDE) and tag != "hr" and not closed and not again:
                    hidden.append(tag)
                continue
        if tag in DROPPED:
            if not closing and not closed:
                hidden.append(tag)
            continue
        if tag == "a":
            state["link"] = 0 if closing else 1
        elif tag == "br":
            held.append(" ")
        if tag not in BLOCKS:
            continue
        if closing:
            k = innermost(frozenset([tag]))
            if k is not None:
                close(k)
            else:
                flush()
            continue
        flush()
        if tag in CLOSES_P and (k := innermost(frozenset(["p"]), frozenset(["td", "th", "li", "dd"]))) is not None:
            close(k)
        if tag == "li" and (k := innermost(frozenset(["li"]), frozenset(["ul", "ol", "menu"]))) is not None:
            close(k)
        if tag in ("dt", "dd") and (k := innermost(frozenset(["dt", "dd"]), frozenset(["dl"]))) is not None:
            close(k)
        if tag in ("tr", "td", "th") and (k := innermost(frozenset(["tr"] if tag == "tr" else ["td", "th"]), frozenset(["table"]))) is not None:
            close(k)
        if tag == "html" or tag == "hr":
            continue
        parent = open_blocks[-1]
        node = Node(tag, parent, nodes[parent].depth + 1, len(nodes[parent].children), state["chars"])
        if match[3].strip():
            own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(match[3])}
            named = " ".join(own.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label"))
            node.words = frozenset(_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()))
            node.mark = own.get("data-part", "")
        nodes[parent].children.append(len(nodes))
        open_blocks.append(len(nodes))
        nodes.append(node)
    if at < size and not hidden:
        held.append(page[at:])
    flush()
    for k in range(len(nodes) - 1, 0, -1):
        up, node = nodes[nodes[k].parent], nodes[k]
        up.chars += node.chars
        up.link_chars += node.link_chars
        up.n_words += node.n_words
        up.stops += node.stops
    return nodes, segments


def features(nodes: list[Node]) -> np.ndarray:
    """One row per block."""
    total = max(1, nodes[0].chars)
    size = np.ones(len(nodes))
    for k in range(len(nodes) - 1, 0, -1):
        size[nodes[k].parent] += size[k]
    out = np.zeros((len(nodes), 19 + 2 * len(TAG_GROUPS)))
    above: list[tuple[int, int]] = []
    groups: list[list[float]] = []
    for k, n in enumerate(nodes):
        good, bad = bool(n.words & GOOD_WORDS), bool(n.words & BAD_WORDS)
        if n.parent >= 0:
            p = nodes[n.parent]
            over = above[n.parent]
            around, siblings = p.chars - n.chars, len(p.children)
            up = groups[n.parent]
            under_aside = over[1]
        else:
            around, siblings, over, up, under_aside = 0, 1, (0, 0), [0.0] * len(TAG_GROUPS), 0
        group = [float(n.tag in g) for g in TAG_GROUPS]
        groups.append([max(a, b) for a, b in zip(group, up)])
        above.append((over[0] + good, under_aside + bad))
        words = max(1, n.n_words)
        out[k] = (
            n.chars, n.own_chars, n.n_words, n.chars / size[k], n.link_chars / max(1, n.chars), n.stops / words, n.stops, n.chars / words,
            n.chars / total, n.start / total, n.depth, n.place, siblings, around / max(1, siblings - 1), around / total,
            good, bad, over[0], over[1], *group, *up,
        )
    return out


def decode(nodes: list[Node], logit: np.ndarray) -> np.ndarray:
    """The labels of the best tree: True for content. Equal sums favour no content."""
    n = len(nodes)
    out_below = np.zeros(n)  # nothing from here on is content
    inside = np.zeros(n)  # this block is content
    outside = np.zeros(n)  # this block isn't, but something below may be
    for k in range(n - 1, -1, -1):
        own = nodes[k].children
        inside[k] = logit[k] + sum(max(inside[c], out_below[c]) for c in own)
        outside[k] = sum(max(inside[c], outside[c]) for c in own)
    content = np.zeros(n, bool)
    state = ["outside"] * n
    state[0] = "inside" if inside[0] > outside[0] else "outside"
    for k in range(n):
        if state[k] == "inside":
            content[k] = True
        for c in nodes[k].children:
            if state[k] == "inside":
                state[c] = "inside" if inside[c] > 0 else "gone"
            elif state[k] == "outside":
                state[c] = "inside" if inside[c] > outside[c] else "outside"
            else:
                state[c] = "gone"
    return content


_ARTICLE = re.compile(r"(<article\b)([^>]*>.*?)(</article\s*>|\Z)", re.DOTALL | re.IGNORECASE)
#: Containers and other parts that derived training pages have.
_HOMES = ("article", "main", "div", 'div class="content"', 'div id="main-content"', 'div class="post-body"', 'section class="entry"', 'div class="story"', 'td', 'div class="x7"')
_MENUS = ("nav", 'div class="menu"', 'div id="navbar"', 'header', 'div class="top-bar"', "div")
_ASIDES = ("aside", 'div class="sidebar"', 'div class="widget"', 'div id="related"', 'section class="promo"', "div")
_NOTICES = ('div class="notice"', 'div class="cookie-consent"', 'div role="alert"', 'div class="newsletter signup"', 'div class="ad"', 'p class="disclaimer"', "form", 'div class="share"')
_COMMENTS = ('div class="comments"', 'section id="comments"', 'ol class="commentlist"', 'div id="disqus"', 'div class="replies"')
_FEET = ("footer", 'div class="footer"', 'div id="bottom"', "div")


def derived(page: str, rng: random.Random) -> str | None:
    """A page with the same article in other surroundings, parts marked by ``data-part``; None without an article."""
    found = _ARTICLE.search(page)
    if not found:
        return None
    inner = found[2].partition(">")[2]
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", _SPACE.sub(" ", re.sub(r"<[^>]*>", " ", page[found.start() :]))) if s.strip()] or ["Word."]
    some = lambda most: " ".join(rng.choices(sentences, k=rng.randint(1, most)))[: rng.randint(20, 500)]
    part = lambda opened, body, mark: f'<{opened} data-part="{mark}">{body}</{opened.split()[0]}>'
    links = lambda: "<ul>" + "".join(f'<li><a href="#">{rng.choice(some(1).split() or ["x"])}</a></li>' for _ in range(rng.randint(2, 9))) + "</ul>"
    before, after = [], []
    if rng.random() < 0.9:
        before.append(part(rng.choice(_MENUS), links(), "out"))
    for _ in range(rng.choice([0, 1, 1, 2])):
        body = some(3) if rng.random() < 0.7 else f'{some(1)}<input name="q"><label>{some(1)[:20]}</label>'
        rng.choice([before, after]).append(part(rng.choice(_NOTICES), body, "out"))
    if rng.random() < 0.5:
        rng.choice([before, after]).append(part(rng.choice(_ASIDES), f"<h3>{some(1)[:30]}</h3>" + rng.choice([links(), f"<p>{some(2)}</p>"]), "out"))
    extra = ""
    if rng.random() < 0.5:
        said = "".join(f'<{rng.choice(["div", "li", "p"])} class="comment">{some(4)}' for _ in range(rng.randint(1, 5)))
        extra = part(rng.choice(_COMMENTS), said, "out")
    if rng.random() < 0.25:
        cut = inner.find("<p", len(inner) // 2)
        junk = part(rng.choice(_NOTICES[:-2]), some(1), "out")
        inner = inner[:cut] + junk + inner[cut:] if cut > 0 else inner + junk
    if extra and rng.random() < 0.3:
        inner, extra = inner + extra, ""
    if rng.random() < 0.9:
        after.append(part(rng.choice(_FEET), f"&copy; {some(2)}", "out"))
    home = rng.choice(_HOMES)
    body = "".join(before) + part(home, inner, "in") + extra + "".join(after)
    if home == "td":
        body = f"<table><tr>{part(home, inner, 'in')}<td data-part='out'>{links()}</td></tr></table>" + "".join(after)
    if rng.random() < 0.4:
        body = f'<div class="{rng.choice(["wrap", "page", "container", "main"])}">{body}</div>'
    return f"<html><body>{body}</body></html>"


def likely(page: str) -> str:
    """A page whose article is made of the longer blocks of ``page``: what to learn from where nothing marks one."""
    _, segments = read(page)
    long = [text for _, text in segments if len(text) >= 80] or [text for _, text in segments]
    return "<article>" + "".join(f"<p>{html.escape(text)}</p>" for text in long) + "</article>" if long else ""


def fit(
    pages: DataFrame,
    *,
    html_col: str = "html",
    sample_pages: int = SAMPLE_PAGES,
    sample_chars: int = SAMPLE_CHARS,
    variants: int = VARIANTS,
    seed: int = 1,
) -> Trees:
    """Learns from ``sample_pages`` different pages at most, those with the smallest hashes among pages with an
    article and up to ``sample_chars`` characters. Where there is no such page, from a tenth as many longer ones with
    an article, the shortest first; where none marks an article, from pages without, whose longer blocks are taken for one.

    The hashes are looked up first, so that tasks send no pages but the chosen ones."""
    size = F.char_length("html")
    # 0 and 1: with an article, short and long; 2 and 3: without.
    tier = F.when(F.col("html").rlike("(?i)<article"), 0).otherwise(2) + F.when(size <= sample_chars, 0).otherwise(1)
    drawn = pages.select(pages[html_col].alias("html")).where(size > 0)
    drawn = drawn.select("html", F.xxhash64("html").alias("draw"), tier.alias("tier"))
    long_first = F.when(F.col("tier") % 2 == 1, F.col("size"))
    listed = drawn.select("tier", "draw", size.alias("size")).distinct().orderBy("tier", long_first, "draw").limit(sample_pages).collect()
    listed = [r for r in listed if r["tier"] == listed[0]["tier"]]
    if listed and listed[0]["tier"] % 2:
        listed = listed[: max(1, sample_pages // 10)]
    draws = [r["draw"] for r in listed]
    chosen = drawn.where(F.col("draw").isin(draws)).groupBy("draw").agg(F.min("html").alias("html")) if draws else drawn.limit(0)
    sample = [r["html"] for r in sorted(chosen.limit(sample_pages).collect(), key=lambda r: r["draw"])]
    if listed and listed[0]["tier"] >= 2:
        sample = [likely(page) for page in sample]
    rng = random.Random(seed)
    xs, ys = [], []
    for page in sample:
        made = [_ARTICLE.sub(lambda m: f'{m[1]} data-part="in"{m[2]}{m[3]}', page, count=1), *(derived(page, rng) for _ in range(variants))]
        for text in filter(None, made):
            nodes, _ = read(text)
            marks = [""] * len(nodes)
            for k, node in enumerate(nodes):
                marks[k] = node.mark or (marks[node.parent] if k else "")
            xs.append(features(nodes))
            ys.append(np.array([m == "in" for m in marks], float))
    if not xs:
        return boost(np.zeros((0, 1)), np.zeros(0))
    return boost(np.concatenate(xs), np.concatenate(ys))


def extract(
    pages: DataFrame, model: Trees, *, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """Per row: the ``carry`` columns and ``text``, the main text, its blocks joined by line breaks.

    Empty where the html is NULL, empty or has no content. Character references are decoded, white space in a block is
    one space. Repeated rows are read each, other columns are ignored, an empty table gives no row. No shuffle.
    """
    narrow = pages.select(*(pages[c] for c in carry), pages[html_col].alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    shared = pages.sparkSession.sparkContext.broadcast(model)  # trees x 2 ** depth numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                read_pages = [read(v.as_py() or "") for v in part.column(part.num_columns - 1)]
                logits = trees.logit(np.concatenate([features(nodes) for nodes, _ in read_pages]))
                texts, begin = [], 0
                for nodes, segments in read_pages:
                    content = decode(nodes, logits[begin : begin + len(nodes)])
                    begin += len(nodes)
                    texts.append("\n".join(text for block, text in segments if content[block]))
                yield pa.record_batch(
                    [*part.columns[:-1], pa.array(texts, pa.string())], names=[*part.schema.names[:-1], "text"]
                )

    return narrow.mapInArrow(run, f"{schema}, text string" if schema else "text string")
