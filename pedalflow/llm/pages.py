"""The main text of web pages: boosted trees over the nodes of the page, decoded along the tree.

Each element that can hold a block gets features of itself (tag, words of its class, id and role, depth), of its subtree
(share of the page's text, of links, characters per element, punctuation) and of its siblings. Trees give the log odds that
the node is, or leads to, main text. Decoding then chooses the set of nodes with the highest total such that a node is
kept only under kept nodes: a node's worth is its own log odds plus the worths of its children, where a child of
negative worth is dropped with all below it.

The trees are fitted on a bounded sample of the given pages whose markup names its parts (``article``, ``nav``, ...), and on
rearranged forms of these, in which other tags and class names stand for the same parts and further parts are added. So
they also learn pages that use plain ``div``s.

Defined results: null and empty pages have the empty text; scripts, styles, templates, SVG, frames, form fields (buttons
too), what stands for a missing script, comments, the head and the title are never text; formulas and what stands inside
``object`` and ``canvas`` belong to the text around them; character references are decoded once; white space, ``br`` and
the bounds of blocks become one space each; tags left open are closed as HTML closes them, and a page that breaks off, also in a
tag or a quoted value, ends there; a stray closing tag is passed over. Comments end as in HTML (``<!-->``, ``--!>``), and a "<" that
begins no tag is text. As in HTML, a head ends and a body begins at the first text or tag that
cannot be in a head, also where no tag says so, and the body goes on to the end of the page; the trees decide on its own
text as on any node's. Each page is read whole and for itself. An empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalflow.llm import trees
from pedalflow.llm.arrays import text_chunks
from pedalflow.llm.ship import ship

# The sample: so many pages, none longer than this; each is rearranged so many times.
SAMPLE_PAGES, MAX_SAMPLE_CHARS, REARRANGED = 120, 50_000, 3

# Groups of tags.
NEVER_TEXT = frozenset("head title script style noscript template svg select textarea button option iframe".split())
RAW_TEXT = frozenset("script style textarea title noscript iframe".split())
IN_HEAD = frozenset("base basefont bgsound link meta title style script template noscript noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img object canvas "
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced maction semantics annotation "
    "annotation-xml msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable".split()
)
# Bounds of these are white space, as those of blocks; they are no nodes of their own.
CELLS = frozenset("mtr mlabeledtr mtd".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
TAGS = (
    "html body div section article main nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li table tr td th dl dt dd blockquote "
    "pre figure figcaption span a fieldset address details"
).split()
# Words in class, id and role that tell parts of a page.
HINTS = (
    "ad ads advert advertisement banner sponsor promo cookie cookies consent gdpr notice alert popup modal nav navigation menu "
    "breadcrumb breadcrumbs pagination header masthead logo footer copyright sidebar aside widget related recommended share social "
    "comment comments reply discussion disqus form login signup search subscribe newsletter toolbar skip meta tags byline author "
    "article post content entry main story body text"
).split()

_TAG_ID = {t: i for i, t in enumerate(TAGS)}
_HINT_BIT = {h: 1 << i for i, h in enumerate(HINTS)}
# A tag's attributes as HTML reads them: an unquoted value ends at white space or ">", a quote inside it is a character. No part is
# looked at twice, so a tag costs its length, also one that never ends.
_ATTRIBUTES = re.compile(
    r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|(?=>)))?+)*+"
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_COMMENT_END = re.compile(r"--!?>")
_HINTED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TRUTH = re.compile(r"data-part=\"(\w)\"")
_WORDS = re.compile(r"[a-z]+")
_BREAK = -1


def _past(page: str, mark: str, at: int) -> int:
    """Just behind the next ``mark``, or the end of the page."""
    found = page.find(mark, at)
    return len(page) if found < 0 else found + len(mark)


def next_tag(page: str, at: int) -> tuple[int, int, bool, str, str]:
    """The next tag or comment from ``at`` on: where it begins and ends, whether it closes, its name in lower case and its attributes.

    A comment has no name; neither has a tag in which the page ends, which is none. What is no tag is passed over as text.
    """
    begin = at
    while True:
        begin = page.find("<", begin)
        if begin < 0:
            return len(page), len(page), False, "", ""
        after = page[begin + 1 : begin + 3]
        if page.startswith("<!--", begin):
            if page.startswith(">", begin + 4) or page.startswith("->", begin + 4):
                return begin, _past(page, ">", begin), False, "", ""
            ended = _COMMENT_END.search(page, begin + 4)
            return begin, ended.end() if ended else len(page), False, "", ""
        if after[:1] in ("!", "?"):
            return begin, _past(page, ">", begin), False, "", ""
        closing = after[:1] == "/"
        name = _NAME.match(page, begin + 1 + closing)
        if name is None:
            if closing and len(after) > 1:
                return begin, _past(page, ">", begin), False, "", ""
            begin += 1
            continue
        end = _ATTRIBUTES.match(page, name.end()).end()
        if not page.startswith(">", end):  # the page ends in the tag
            return begin, len(page), False, "", ""
        return begin, end + 1, closing, name[0].lower(), page[name.end() : end]


class Page(NamedTuple):
    """Nodes in page order with their texts. Lists run over the nodes, ``pieces`` over texts and breaks."""

    parent: list[int]
    end: list[int]  # one past the last node of the subtree
    tag: list[int]
    hints: list[int]
    depth: list[int]
    truth: list[str]  # part letters written for training, else empty
    chars: list[int]
    link_chars: list[int]
    marks: list[int]  # punctuation
    pieces: list[tuple[int, str]]  # (node or _BREAK, text)


def _hints(attributes: str) -> int:
    found = 0
    for m in _HINTED.finditer(attributes):
        for word in _WORDS.findall((m[1] or m[2] or m[3] or "").lower()):
            found |= _HINT_BIT.get(word, 0)
    return found


def parse(page: str, implied_body: bool = False) -> Page:
    """With ``implied_body`` as HTML has it, and as pages are read for their main text; without, a body begins at its tag only
    and text outside every element is the root's, which is no text."""
    parent, end, tag_ids, hints, depth, truth = [-1], [0], [_TAG_ID["html"]], [0], [0], [""]
    chars, link_chars, marks, pieces = [0], [0], [0], []
    stack: list[tuple[str, int]] = [("", 0)]  # open elements and their nodes
    hidden, links, at = 0, 0, 0
    in_body = False
    n_open: dict[str, int] = {}  # of each name

    def push(name: str, node: int) -> None:
        stack.append((name, node))
        n_open[name] = n_open.get(name, 0) + 1

    def open_node(tag: str, own: int = 0, part: str = "") -> int:
        above = stack[-1][1]
        parent.append(above)
        end.append(0)
        tag_ids.append(_TAG_ID.get(tag, len(TAGS)))
        hints.append(own)
        depth.append(depth[above] + 1)
        truth.append(part)
        chars.append(0)
        link_chars.append(0)
        marks.append(0)
        return len(parent) - 1

    def open_body(own: int = 0, part: str = "") -> None:
        nonlocal in_body
        if not in_body:
            close({"head"})
            in_body = True
            pieces.append((_BREAK, " "))
            push("body", open_node("body", own, part))

    def take(text: str) -> None:
        if implied_body and not in_body and stack[-1][0] in ("", "head") and not text.isspace():
            open_body()
        if not text or hidden:
            return
        if "&" in text:
            text = html.unescape(text)
        node = stack[-1][1]
        pieces.append((node, text))
        n = len(text.strip())
        chars[node] += n
        if links:
            link_chars[node] += n
        marks[node] += text.count(".") + text.count(",")

    def close_top() -> None:
        nonlocal hidden, links
        name, node = stack.pop()
        n_open[name] -= 1
        if node != stack[-1][1]:
            end[node] = len(parent)
        if name in NEVER_TEXT:
            hidden -= 1
        elif name == "a":
            links -= 1
        if name not in INLINE:
            pieces.append((_BREAK, " "))

    def close(names: set[str] | frozenset[str], stops: set[str] = frozenset()) -> None:
        if not any(n_open.get(n) for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    close_top()
                return
            if stack[k][0] in stops:
                return

    while at < len(page):
        begin, after, closing, name, attributes = next_tag(page, at)
        if begin > at:
            take(page[at:begin])
        at = after
        if not name:
            continue
        if closing:
            if name in ("html", "body"):  # what follows is still in the body
                continue
            if name == "p" and not n_open.get("p"):
                pieces.append((_BREAK, " "))
            close({name})
            continue
        if name in ("html", "body") and (hints_of := _hints(attributes)):
            hints[0] |= hints_of
        if name == "html" or (name in ("head", "body") and in_body):
            continue
        if name == "body":
            part = _TRUTH.search(attributes)
            open_body(_hints(attributes), part[1] if part else "")
            continue
        if implied_body and not in_body and stack[-1][0] in ("", "head") and name != "head" and name not in IN_HEAD:
            open_body()
        if name in VOID:
            if name not in INLINE:
                pieces.append((_BREAK, " "))
            continue
        if name in CLOSES_P:
            close({"p"}, {"td", "th", "table"})
        if name in SAME_CLOSES:
            close(SAME_CLOSES[name], STOPS[name])
        node = stack[-1][1]
        inline = name in INLINE
        own = _hints(attributes) if attributes else 0
        if not inline:
            pieces.append((_BREAK, " "))
        if (not (inline or name in CELLS) or own) and name not in NEVER_TEXT and not hidden:
            part = _TRUTH.search(attributes) if attributes else None
            node = open_node(name, own, part[1] if part else "")
        push(name, node)
        if name in NEVER_TEXT:
            hidden += 1
        elif name == "a":
            links += 1
        if name in RAW_TEXT:
            stop = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = stop.start() if stop else len(page)
    while len(stack) > 1:
        close_top()
    end[0] = len(parent)
    return Page(parent, end, tag_ids, hints, depth, truth, chars, link_chars, marks, pieces)


N_FEATURES = len(TAGS) + 1 + 2 * len(HINTS) + 14


def features(pages: list[Page]) -> np.ndarray:
    """One row of features for each node of the pages."""
    sizes = np.array([len(p.parent) for p in pages])
    first = np.concatenate([[0], np.cumsum(sizes)])
    shift = np.repeat(first[:-1], sizes)

    def flat(name: str) -> np.ndarray:
        return np.array([v for p in pages for v in getattr(p, name)], np.int64)

    parent, end, tag, depth = flat("parent"), flat("end") + shift, flat("tag"), flat("depth")
    hints = np.array([v for p in pages for v in p.hints], np.uint64)
    n = len(parent)
    node = np.arange(n)
    root = parent < 0
    parent = np.where(root, node, parent + shift)

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return (total[end] - total[node]).astype(np.float64)

    chars, link_chars, marks = (subtree(flat(c)) for c in ("chars", "link_chars", "marks"))
    nodes = end - node
    page_chars = np.repeat(chars[first[:-1]], sizes)
    above = hints.copy()  # hints of the node and all above it
    by_depth = np.argsort(depth, kind="stable")
    levels = np.searchsorted(depth[by_depth], np.arange(1, int(depth.max()) + 2 if n else 1))
    for begin_level, end_level in zip(levels, levels[1:]):
        some = by_depth[begin_level:end_level]
        above[some] |= above[parent[some]]
    children = np.bincount(parent[~root], minlength=n)
    order = np.lexsort((node, parent))
    index = np.empty(n, np.int64)
    starts = np.concatenate([[True], parent[order][1:] != parent[order][:-1]])
    index[order] = np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    _, alike = np.unique(parent * (len(TAGS) + 1) + tag, return_inverse=True)
    same_tag = np.bincount(alike)[alike]
    siblings = np.maximum(children[parent], 1)

    out = np.zeros((n, N_FEATURES), np.float32)
    out[node, tag] = 1
    at = len(TAGS) + 1
    for masks in (hints, above):
        for k in range(len(HINTS)):
            out[:, at + k] = (masks >> np.uint64(k)) & np.uint64(1)
        at += len(HINTS)
    numbers = (
        depth,
        np.log1p(chars),
        link_chars / np.maximum(chars, 1),
        chars / nodes,
        chars / np.maximum(page_chars, 1),
        marks / np.maximum(chars, 1),
        np.log1p(flat("chars")),
        np.log1p(nodes),
        children,
        index / siblings,
        siblings,
        same_tag / siblings,
        (node - shift) / np.repeat(sizes, sizes),
        tag[parent],
    )
    for k, values in enumerate(numbers):
        out[:, at + k] = values
    return out


def kept_nodes(page: Page, odds: np.ndarray) -> list[bool]:
    """The nodes to keep: the set of highest total log odds in which a node is kept only under kept nodes."""
    n = len(page.parent)
    worth = odds.tolist()
    for i in range(n - 1, 0, -1):
        if worth[i] > 0:
            worth[page.parent[i]] += worth[i]
    keep = [True] * n
    for i in range(1, n):
        keep[i] = keep[page.parent[i]] and worth[i] > 0
    return keep


def text_of(page: Page, keep: list[bool]) -> str:
    return " ".join("".join(t for node, t in page.pieces if node == _BREAK or (node and keep[node])).split())


# Training ---------------------------------------------------------------------------------------------------------------

# Tags and classes that stand for a part in rearranged pages.
_MAIN = ("article", "main", "div class=\"content\"", "div class=\"post\"", "div id=\"main-text\"", "section class=\"entry\"", "div class=\"story\"", "div")
_AROUND = {
    "menu": ("nav", "div class=\"menu\"", "ul class=\"nav\"", "div id=\"navigation\"", "div class=\"breadcrumbs\"", "div class=\"pagination\""),
    "top": ("header", "div class=\"header\"", "div id=\"masthead\"", "div class=\"toolbar\"", "div class=\"logo\""),
    "foot": ("footer", "div class=\"footer\"", "div id=\"footer\"", "p class=\"copyright\""),
    "side": ("aside", "div class=\"sidebar\"", "div class=\"widget\"", "div class=\"related\"", "section class=\"recommended\"", "div class=\"share\"", "div class=\"social\""),
    "ad": ("div class=\"ad\"", "div class=\"advert\"", "div class=\"sponsor\"", "div class=\"promo\"", "div class=\"ads\"", "div class=\"advertisement\"", "div class=\"banner\""),
    "notice": ("div class=\"cookie\"", "div class=\"notice\"", "div id=\"consent\"", "div class=\"popup\"", "div role=\"alert\"", "div class=\"modal\"", "div id=\"cookies\"", "section class=\"gdpr\""),
    "form": ("form", "div class=\"login\"", "div class=\"subscribe\"", "form class=\"search\"", "div class=\"newsletter\"", "section id=\"signup\""),
    "comments": ("section class=\"comments\"", "div id=\"comments\"", "div class=\"discussion\"", "ol class=\"comment\"", "div class=\"reply\"", "div id=\"disqus\""),
}
_FILLER = "The river rose in the night, and by morning the lower road was gone. People came out to look. Nobody spoke much."
_NAMED_PART = re.compile(r"<(article|main)\b[^>]*>(.*?)</\1\s*>", re.S | re.I)
_LANDMARKS = {"nav", "footer", "aside", "form", "header"}
_BOILERPLATE_HINTS = sum(_HINT_BIT[h] for h in HINTS[: HINTS.index("article")])


def _wrap(kind: str, inside: str, part: str) -> str:
    return f'<{kind} data-part="{part}">{inside}</{kind.split()[0]}>'


def rearranged(content: str, around: str, rng: random.Random) -> str:
    """A page with this main part, and parts made of the sentences of ``around``; each says in ``data-part`` what it is."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", around) if s][:60] or [_FILLER]

    def some(n: int) -> str:
        return " ".join(rng.choice(sentences) for _ in range(n))

    def item(kind: str) -> str:
        if kind in ("menu", "side"):
            inside = "".join(f'<li><a href="#">{w}</a></li>' for w in some(3).split()[: rng.randint(3, 9)])
            inside = f"<ul>{inside}</ul>" if rng.random() < 0.7 else inside
        elif kind == "comments":
            inside = "".join(f"<div><b>{some(1).split()[0]}</b><p>{some(rng.randint(1, 4))}</p></div>" for _ in range(rng.randint(1, 5)))
        elif kind == "form":
            inside = f"<label>{some(1)}</label><input><p>{some(1)}</p>"
        elif rng.random() < 0.5:
            inside = some(rng.randint(1, 2))
        else:
            inside = "".join(f"<p>{some(1)}</p>" for _ in range(rng.randint(1, 2)))
        return _wrap(rng.choice(_AROUND[kind]), inside, "n")

    if rng.random() < 0.2:
        content = f"<p>{some(1)}</p>"
    before = [item(k) for k in ("top", "menu", "notice", "ad", "form", "side") if rng.random() < 0.6]
    after = [item(k) for k in ("side", "comments", "ad", "form", "notice", "foot") if rng.random() < 0.6]
    rng.shuffle(before)
    rng.shuffle(after)
    if rng.random() < 0.3:
        content += item(rng.choice(("ad", "side", "comments")))
    body = "".join(before) + _wrap(rng.choice(_MAIN), content, "y") + "".join(after)
    if rng.random() < 0.4:
        body = f'<div data-part="y">{body}</div>'
    return f"<html><body>{body}</body></html>"


def node_labels(page: Page) -> np.ndarray:
    """1 for nodes that are or lead to main text, by the parts that the page names."""
    n = len(page.parent)
    label, inside = [0] * n, [""] * n
    article = {_TAG_ID["article"], _TAG_ID["main"]}
    landmarks = {_TAG_ID[t] for t in _LANDMARKS}
    written = any(page.truth)
    for i in range(1, n):
        state = inside[page.parent[i]]
        if state != "n":
            if written:
                state = page.truth[i] or state
            elif page.tag[i] in landmarks or page.hints[i] & _BOILERPLATE_HINTS:
                state = "n"
            elif page.tag[i] in article:
                state = "y"
        inside[i] = state
        label[i] = int(state == "y")
    for i in range(n - 1, 0, -1):
        if label[i]:
            label[page.parent[i]] = 1
    return np.array(label)


def fit_pages(sample: list[str]) -> trees.Forest:
    """Trees fitted on the pages that name their parts and on rearranged forms of them; the order does not matter."""
    paragraphs = "".join(f"<p>{_FILLER} {_FILLER}</p>" for _ in range(4))
    sources = [(f"<h1>{_FILLER[:40]}</h1>{paragraphs}", _FILLER)] * 5
    pages = []
    for page in sorted(sample):
        found = _NAMED_PART.search(page)
        if found:
            pages.append(parse(page, implied_body=True))
            # A main part may be no more than a few words.
            few = " ".join(re.sub(r"<[^>]*>", " ", found[2]).split()[: 1 + len(pages) % 4])
            pages.append(parse(page.replace(found[2], f"<h1>{few}</h1><p>{few}</p>"), implied_body=True))
            plain = re.sub(r"<[^>]*>", " ", re.sub(r"<(script|style)\b.*?</\1", " ", page, flags=re.S | re.I))
            sources.append((found[2], plain))
    rng = random.Random(7)
    pages += [parse(rearranged(content, around, rng)) for content, around in sources for _ in range(REARRANGED)]
    return trees.fit(features(pages), np.concatenate([node_labels(p) for p in pages]))


def learn(pages: DataFrame) -> trees.Forest:
    """Fit on a bounded sample: of the pages, drawn by a hash of their html with the chance that gives twice as many as
    asked, the first ``SAMPLE_PAGES`` by that hash. Copies of a page count once; pages not drawn are not moved."""
    short = pages.filter(F.length("html") <= MAX_SAMPLE_CHARS).select("html")
    n = short.count()
    draw = F.pmod(F.xxhash64("html"), F.lit(1 << 30))
    chance = min(1.0, 2 * SAMPLE_PAGES / max(n, 1))
    drawn = short.filter(draw < int(chance * (1 << 30))).distinct()
    return fit_pages([r["html"] for r in drawn.orderBy(draw, "html").limit(SAMPLE_PAGES).collect()])


def extract(pages: DataFrame, forest: trees.Forest) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages`` (``page_id``, ``url``, ``html``)."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(forest)  # some 30 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, "html", rows=500):
            parsed = [parse(h or "", implied_body=True) for h in chunk.column("html").to_pylist()]
            odds = shared.value.margins(features(parsed))
            texts, begin = [], 0
            for page in parsed:
                n = len(page.parent)
                texts.append(text_of(page, kept_nodes(page, odds[begin : begin + n])))
                begin += n
            yield pa.RecordBatch.from_arrays(
                [chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    )
