"""Operator 5: main text of HTML pages by maximum-scoring subsequence.

A page becomes a sequence of tags and words.  Words score above 0 and tags below,
words of links, and of parts that are no article, below 0 too; the weights are log odds
learned from labelled pages.  One linear scan finds the contiguous run with the
greatest sum: the content region.  The region is widened to the article (or
``main``) that holds it, or else to the smallest element around it short of the body,
so that a low score at an edge loses no paragraph.  Of the region, the parts that are no
article (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
comments of readers) are left out; the rest is returned block by block.

Classes, ids and roles mark a part by whole names: one of ``APART_WORDS``, alone or with
words of place (``site-header``), but not ``no-comments`` or ``entry-header``.  They do
not mark an article outside other articles, nor the element that holds the best run
of the page without such marks, if the marks leave little beside it.

Text: character references are decoded after tags are found, white space inside a
block becomes one space, blocks are trimmed and joined by a line feed.  ``br``
counts as white space.  A null or empty page, or one without words, gives an empty
text.  Unclosed tags end with their parent; a cut-off tag at the end is markup; a new
``article`` or ``main`` ends an unclosed part that is none.  Extra columns are not
carried; repeated rows give repeated rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linemend.llm.base import lean, table

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)                                                    # comment
      | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?][^>]*(?:>|\Z)                      # declarations
      | <(?P<raw>script|style|textarea|title|noscript|template|xmp|iframe)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+> .*? (?:</(?P=raw)\s*>|\Z)
      | <(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)
    """,
    re.VERBOSE | re.DOTALL | re.IGNORECASE,
)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|aria-label|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are no article, whatever their attributes say.
APART = frozenset("nav header footer aside form button select option datalist fieldset head menu dialog svg canvas object audio video map".split())
#: Words of class, id and role that mark such parts.
APART_WORDS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert
    sidebar sidebars aside nav navbar navigation menu menus breadcrumb breadcrumbs header masthead topbar footer foot comment comments commentlist disqus
    discussion reply replies respond share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay widget
    widgets toolbar pagination pager search complementary contentinfo dialog disclaimer legal copyright""".split()
)
#: Words beside them that only say where or of what kind: ``site-header``, ``comment-list``.
PLACE_WORDS = frozenset("site page global top bottom left right primary secondary area bar box block list item links buttons form section container wrapper inner".split())
LASTING = frozenset(("comment", "comments", "commentlist", "disqus", "discussion", "reply", "replies", "respond"))
ROOTS = frozenset(("html", "body", "article", "main"))
#: A paragraph in a heading ends an open one around it, through so many headings.
HEADINGS, NESTED_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6")), 8
NAME_OF, WORD_OF = re.compile(r"\S+"), re.compile(r"[a-z]+")
#: Marks by class give way to the element with the best run if they leave less than this part of its score.
LEFT_BESIDE = 0.25

# Labelled pages: content stands between the two marks.  They cover the usual
# shapes: semantic tags, plain divisions, tables, link lists, comment threads.
OPEN, CLOSE = "<!--content-->", "<!--/content-->"
LABELLED = (
    "<html><head><title>A day</title></head><body><nav><ul><li><a href=1>Home page</a></li><li><a href=2>All news</a></li></ul></nav><article><!--content--><h1>A day at the lake</h1>"
    "<p>We went out early, when the mist still lay on the water and no one else was there to be seen.</p><p>By noon the sun had come through and the boats were out.</p><!--/content-->"
    "</article><footer>All rights kept</footer></body></html>",
    "<body><div class=top><a href=1>Start</a> | <a href=2>Help</a></div><div class=text><!--content--><h2>On bread</h2><p>Flour and water are all that is needed, and a night of patience for the dough to rise.</p>"
    "<p>It is baked in a hot oven until the crust is <b>dark</b> and sounds hollow.</p><!--/content--></div><div class=links><a href=3>More on baking</a><a href=4>Tools</a></div></body>",
    "<body><table><tr><td><a href=1>one</a><br><a href=2>two</a></td><td><!--content--><p>The committee met on Monday to hear what had been found in the last year of work on the bridge.</p>"
    "<p>Nothing was decided, but two members asked for a further report by the spring.</p><!--/content--></td></tr></table><p><a href=9>Print</a></p></body>",
    "<body><header><h1>The Daily</h1></header><main><!--content--><h1>Rain again</h1><p>It rained for the third week, and the <a href=5>river</a> rose over the lower fields near the mill.</p>"
    "<blockquote>No one remembers a summer like this one.</blockquote><p>Farmers hope for a dry autumn.</p><!--/content--><section class=comments><p>First!</p><p>So true</p></section></main></body>",
    "<body><ul><li><a href=1>Sport</a></li><li><a href=2>Money</a></li></ul><div><!--content--><p>A short note on how to fold a map: begin with the long side, then press each crease in turn.</p><!--/content--></div>"
    "<form><label>Mail</label><input><button>Send</button></form></body>",
)


@dataclass
class Page:
    """Tokens of a page in order.  ``kind``: a tag name, or ``w`` / ``w:a`` /
    ``w:apart`` for words; ``size``: words of a text token, 1 for a tag."""

    kind: list[str] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    block: list[bool] = field(default_factory=list)
    apart: list[bool] = field(default_factory=list)
    #: (name, first token, token after the last) of every element that can hold content
    spans: list[tuple[str, int, int]] = field(default_factory=list)
    marks: list[tuple[int, bool]] = field(default_factory=list)
    #: (place in the source, lasting, first token, token after the last) of elements that attributes name as apart
    named: list[tuple[int, bool, int, int]] = field(default_factory=list)


def _is_apart(name: str, attrs: str) -> tuple[bool, bool, bool]:
    """Whether an element is no part of an article, whether only class, id or role
    say so, and whether it ends only with its tag."""
    if name in APART:
        return True, False, False
    if not attrs.strip() or name in ("html", "body"):
        return False, False, False
    found: set[str] = set()
    for m in ATTR.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False, False
        if key in ("class", "id", "role"):
            for whole in NAME_OF.findall(value):
                words = set(WORD_OF.findall(whole))
                if words & APART_WORDS and words <= APART_WORDS | PLACE_WORDS:
                    found |= words & APART_WORDS
    if name in INLINE and name != "span" or name == "main":
        return False, False, False
    return bool(found), bool(found), bool(found & LASTING)


def tokenise(source: str | None, wrappers: frozenset[int] | None = frozenset()) -> Page:
    """Elements that begin at the places ``wrappers`` (None: everywhere) are not marked
    by class, id and role."""
    page, at = Page(), 0
    source = source or ""
    # name, first token, apart, lasting, place if named apart, index of the nearest block element (itself, if it is one)
    stack: list[tuple[str, int, bool, bool, int | None, int]] = []
    open_: Counter[str] = Counter()
    links = apart = lasting_apart = 0

    def put(kind: str, size: int, text: str | None, block: bool) -> None:
        page.kind.append(kind)
        page.size.append(size)
        page.text.append(text)
        page.block.append(block)
        page.apart.append(apart > 0)

    def words(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        n = len(text.split())
        put("w:apart" if apart else "w:a" if links else "w", n, text, False)

    def pop() -> None:
        nonlocal links, apart, lasting_apart
        name, first, is_apart, lasting, place, _ = stack.pop()
        open_[name] -= 1
        links -= name == "a"
        apart -= is_apart
        lasting_apart -= is_apart and lasting
        page.spans.append((name, first, len(page.kind)))
        if place is not None:
            page.named.append((place, lasting, first, len(page.kind)))

    for m in TOKEN.finditer(source):
        if at < m.start():
            words(source[at : m.start()])
        at = m.end()
        name = m.group("name") or m.group("name2")
        if name is None:
            if m.group() in (OPEN, CLOSE):
                page.marks.append((len(page.kind), m.group() == OPEN))
            elif m.group("raw"):
                put(m.group("raw").lower(), 1, None, True)
            continue
        name, attrs = name.lower(), m.group("attrs") or m.group("attrs2") or ""
        if m.group("end") or m.group("end2"):
            if open_[name]:
                while stack[-1][0] != name:
                    pop()
                put(name, 1, None, name not in INLINE)
                pop()
            else:
                put(name, 1, None, name not in INLINE)
            continue
        is_apart, named, lasting = _is_apart(name, attrs)
        if named and name == "article" and not lasting and not open_["article"]:
            is_apart = named = False
        if named and (wrappers is None or m.start() in wrappers):
            is_apart = False
        if name in ("article", "main") and not is_apart and apart and not lasting_apart:
            while apart:  # an unclosed part that is no article ends here
                pop()
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # ends an open one of its kind
            at_block = stack[-1][5] if stack and open_[name] else -1
            for _ in range(NESTED_HEADINGS):
                if at_block < 0 or stack[at_block][0] == name or not (name == "p" and stack[at_block][0] in HEADINGS):
                    break
                at_block = stack[at_block - 1][5] if at_block else -1
            if at_block >= 0 and stack[at_block][0] == name:
                while len(stack) > at_block:
                    pop()
        if name in VOID or attrs.rstrip().endswith("/"):
            if name in ("br", "wbr", "img", "input"):
                put(name, 1, " " if name == "br" else None, False)
            else:
                put(name, 1, None, name not in INLINE)
            continue
        put(name, 1, None, name not in INLINE)
        block = len(stack) if name not in INLINE else stack[-1][5] if stack else -1
        stack.append((name, len(page.kind) - 1, is_apart, lasting, m.start() if named else None, block))
        open_[name] += 1
        links += name == "a"
        apart += is_apart
        lasting_apart += is_apart and lasting
        page.apart[-1] = apart > 0
    if at < len(source):
        words(source[at:])
    while stack:
        pop()
    return page


def learn(labelled: tuple[str, ...] = LABELLED) -> dict[str, float]:
    """Log odds of each kind of token inside content against outside; words at
    least +0.1 in content kinds, everything else at most -0.1."""
    inside, outside = Counter(), Counter()
    for source in labelled:
        page, on = tokenise(source), False
        marks = dict(page.marks)
        for i, (kind, size) in enumerate(zip(page.kind, page.size, strict=True)):
            on = marks.get(i, on)
            (inside if on else outside)[kind] += size
    a, b = sum(inside.values()), sum(outside.values())
    odds = {k: math.log((inside[k] + 0.5) / (a + 1) / ((outside[k] + 0.5) / (b + 1))) for k in {*inside, *outside}}
    return {k: max(v, 0.1) if k == "w" else min(v, -0.1) for k, v in odds.items()}


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last+1 of the contiguous run with the greatest sum; the earliest
    and shortest of equals; (0, 0) if no score is above 0."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def _wrappers(source: str, marked: float, scores: Callable[[Page], list[float]]) -> frozenset[int]:
    """Places of the elements named apart that hold the best run of the page without
    such names (most of its words do if an article or headline stands in them), if it
    scores far above the ``marked`` one.  Threads of comments without one are no wrappers."""
    page = tokenise(source, None)
    found = scores(page)
    first, last = best_run(found)
    if marked >= LEFT_BESIDE * sum(found[first:last]):
        return frozenset()
    up_to = [0.0, *accumulate(max(x, 0.0) for x in found)]
    heads = [0, *accumulate(k in ("article", "main", "h1") for k in page.kind)]
    words = lambda a, b: up_to[max(min(b, last), first)] - up_to[min(max(a, first), last)]
    out = set()
    for place, lasting, a, b in page.named:
        headed = heads[b] > heads[min(a + 1, b)]
        if headed and 2 * words(a, b) > words(first, last) or not lasting and a <= first and b >= last:
            out.add(place)
    return frozenset(out)


def extract(source: str | None, weights: dict[str, float]) -> str:
    unseen = min((v for k, v in weights.items() if k[:2] != "w:"), default=-1.0) / 2
    scores = lambda page: [weights.get(k, unseen) * n for k, n in zip(page.kind, page.size, strict=True)]
    page = tokenise(source)
    found = scores(page)
    first, last = best_run(found)
    if page.named and (wrappers := _wrappers(source or "", sum(found[first:last]), scores)):
        page = tokenise(source, wrappers)
        first, last = best_run(scores(page))
    if last == 0:  # all words stand in links or apart
        first, last = 0, len(page.kind)
    around = [s for s in page.spans if s[1] <= first and s[2] >= last and s[0] not in INLINE]
    whole = [s for s in around if s[0] in ("article", "main")]
    inner = min(whole or [s for s in around if s[0] not in ROOTS] or [("", first, last)], key=lambda s: s[2] - s[1])
    blocks, now = [], []
    for i in range(inner[1], inner[2]):
        if page.block[i]:
            blocks.append(now)
            now = []
        if not page.apart[i] and page.text[i] is not None:
            now.append(page.text[i])
    blocks.append(now)
    return "\n".join(t for b in blocks if (t := " ".join("".join(b).split())))


def main_text(pages: DataFrame, labelled: tuple[str, ...] = LABELLED, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""
    weights = learn(labelled)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                texts = [extract(h.as_py(), weights) for h in batch.column(2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return read.mapInArrow(extracted, "page_id bigint, url string, text string, n_chars bigint")


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
