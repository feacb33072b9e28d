"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block elements.  Parts that cannot be text
(scripts, styles, forms) and parts that say what they are (navigation, headers,
footers, side bars, adverts, notices, comments: by element, role, class or id)
are left out.  A class or id says so when every part of it (between hyphens,
underscores and changes of case) is a name of such a part or a word for a box,
as in ``comment-list``; ``has-sidebar`` or ``search-results`` do not.  It does
not count where the element holds the page's first article, unless it names
readers' comments, whose articles are none of the page's; and where nothing is
left of a page with an article, only names of readers' comments count.

First pass: link density, length and stop-word density make each block good,
bad or undecided (short, or with few stop words).  Second pass: undecided blocks take the label of their nearest decided neighbours; between a
good and a bad one the nearer counts (ties: good inside the article element,
bad outside).  Where a page has an article or main element, blocks outside are
bad.

Defined cases: null, empty and text-free pages give an empty text; unclosed
elements end with the element around them, an unclosed comment or script with
the page; repeated rows are read alike; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

LONG = 80           # characters of a block that decides by itself
LINKED = 0.4        # share of link characters that makes a block bad
STOP_HIGH = 0.2     # share of stop words that makes a long block good
STOP_LOW = 0.08     # below it a long block is undecided

# Stop words of four languages, and names of elements.
STOP_WORDS = frozenset((
    "the of and to in a is that it for was on are as with be by at from this have or an not but they which you he she we "
    "der die das und ist in zu den von mit sich auf für im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "de la le les et des en un une du que est pour qui dans pas sur au avec ne se plus par ce il son sont ou "
    "el los las y del se por con para su al lo como más o pero sus le ha una es no si").split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
LEFT_OUT = frozenset("nav aside footer form button select textarea noscript template svg iframe object canvas audio video "
                     "dialog menu label input head title".split())
CONTAINERS = (BLOCKS | LEFT_OUT | {"span", "a", "header"}) - {"p", "hr", "li", "input"}
NEVER_AROUND = frozenset("nav header footer aside head".split())  # an article inside means that they were not closed
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SAYS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
                 "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup sidebar side "
                 "aside widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs menu "
                 "nav navbar navigation toolbar pagination pager footer header masthead topbar comment comments commentlist "
                 "respond reply replies disqus login search copyright legal disclaimer hidden".split())
BOXES = frozenset("area bar block body bottom box btn button buttons card cards center col column container content feed form "
                  "full group holder icon icons inline inner item items layer left line link links list main module outer page "
                  "panel post posts primary reader readers right row rows secondary section site slot small stories thread title "
                  "top unit user users wrap wrapper zone".split())
READERS = frozenset("comment comments commentlist respond reply replies disqus".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|svg|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>"
    r"|</?[a-zA-Z!?/][^>]*(?:>|\Z)", re.S | re.I)
_NAMED = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ARTICLE = re.compile(r"<(?:article|main)\b", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    linked: int         # characters inside links
    inside: bool        # of an article or main element
    heading: bool
    label: str = ""


def named(attrs: str) -> frozenset[str]:
    """The names of ``SAYS`` in a class or id that has only these and ``BOXES``."""
    for m in _NAMED.finditer(attrs):
        if m[1].lower() in ("class", "id"):
            for name in m[2].strip("\"'").split():
                parts = frozenset((name.lower(),)) & SAYS or frozenset(map(str.lower, _PARTS.findall(name)))
                if parts <= SAYS | BOXES and parts & SAYS:
                    return parts & SAYS
    return frozenset()


def says_so(attrs: str) -> bool:
    """Whether an element's role or style says that it is not text."""
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs, re.I):
        return True
    for m in _NAMED.finditer(attrs):
        name, value = m[1].lower(), m[2].strip("\"'").lower()
        if name == "role" and value in ROLES or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and _HIDDEN.search(value):
            return True
    return False


def blocks(page: str, names_of: frozenset[str] = SAYS) -> tuple[list[Block], bool]:
    """Blocks of a page that are not left out, and whether it has an article;
    linear in the page, however its elements nest.  Of the names only those of
    ``names_of`` count."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []  # open containers, whether left out, whether an article of the page
    opened: Counter = Counter()               # their tags
    by_name: list[int] = []                   # places in the stack of those left out for a name that an article overrules
    comments: list[int] = []                  # places of readers' comments
    stuck = 0                                 # open elements left out as navigation and the like
    text: list[str] = []
    links = linked = breaks = skipped = articles = 0
    heading = article_seen = first_seen = False

    def end() -> None:
        nonlocal linked, heading, breaks
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        if joined:
            out.append(Block(joined, min(linked, len(joined)), articles > 0, heading))
        text.clear()
        linked, heading, breaks = 0, False, 0

    def pop() -> None:
        nonlocal skipped, articles, links, stuck
        tag, left_out, article = stack.pop()
        opened[tag] -= 1
        for places in (by_name, comments):
            if places and places[-1] == len(stack):
                places.pop()
        stuck -= left_out and tag in NEVER_AROUND
        skipped -= left_out
        articles -= article
        links -= tag == "a"

    at = 0
    for m in _MARKUP.finditer(page):
        part = page[at:m.start()]
        at = m.end()
        if part and not skipped:
            if not part.isspace():
                breaks = 0
            text.append(part)
            if links:
                linked += len(_SPACE.sub(" ", html.unescape(part)))
        tag = (m["tag"] or "").lower()
        if m["raw"]:
            text.append(" ")
            continue
        if not tag:
            continue
        if tag == "br":
            breaks += 1
            text.append(" ")
            if breaks > 1:
                end()
            continue
        if tag in BLOCKS and not skipped:
            end()
        if tag in VOID or tag not in CONTAINERS and not (tag[0] == "h" and tag[1:].isdigit()):
            continue
        if m["close"]:
            if tag[0] == "h" and tag[1:].isdigit():
                continue
            if opened[tag]:
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag[0] == "h" and tag[1:].isdigit():
            heading = True
            continue
        attrs = m["attrs"] or ""
        names = named(attrs) & names_of if attrs and tag not in ("html", "body") else frozenset()
        said = bool(attrs) and tag not in ("html", "body") and says_so(attrs)
        article = tag in ("article", "main") and not comments
        if article and not (said or names):
            while stuck:
                pop()  # never closed
            for i in by_name:
                stack[i] = stack[i][0], False, stack[i][2]
                skipped -= 1
            by_name.clear()
            article_seen = True
            first_seen |= tag == "article"
        if not attrs.rstrip().endswith("/"):
            by_tag = tag in LEFT_OUT or tag == "header" and not articles
            left_out = by_tag or said or bool(names)
            if left_out and not skipped:
                end()
            if names & READERS:
                comments.append(len(stack))
            elif names and not (by_tag or said or first_seen):
                by_name.append(len(stack))
            stack.append((tag, left_out, article))
            opened[tag] += 1
            stuck += left_out and tag in NEVER_AROUND
            skipped += left_out
            articles += article
            links += tag == "a"
    if not skipped and at < len(page):
        text.append(page[at:])
    end()
    return out, article_seen


def _first_pass(b: Block, article: bool) -> str:
    if article and not b.inside:
        return "bad"
    size = len(b.text)
    if b.linked / size > LINKED:
        return "bad"
    if size < LONG or b.heading:
        return ""
    words = [w.strip(".,;:!?()\"'%&#$*|").lower() for w in b.text.split()]
    density = sum(w in STOP_WORDS for w in words) / len(words)
    return "good" if density >= STOP_HIGH or b.inside and density >= STOP_LOW else "" if density >= STOP_LOW or b.inside else "bad"


def main_text(page: str | None) -> str:
    """The good blocks of a page, in order, joined by line ends."""
    found, article = blocks(page or "")
    if not found and _ARTICLE.search(page or ""):
        found, article = blocks(page or "", READERS)
    for b in found:
        b.label = _first_pass(b, article)
    # the nearest decided block on either side, inside or outside the article as the block is
    last: list[dict] = [{}, {}]
    sides = []
    for side, order in enumerate((range(len(found)), range(len(found) - 1, -1, -1))):
        nearest: list = [None] * len(found)
        for i in order:
            b = found[i]
            nearest[i] = last[side].get(b.inside)
            if b.label:
                last[side][b.inside] = i
        sides.append(nearest)
    labels = []
    for i, b in enumerate(found):
        if b.label:
            labels.append(b.label)
            continue
        near = [(abs(s[i] - i), found[s[i]]) for s in sides if s[i] is not None]
        if not near:
            labels.append("good" if b.inside else "bad")
            continue
        least = min(d for d, _ in near)
        around = {x.label for d, x in near if d == least}
        labels.append(around.pop() if len(around) == 1 else "good" if b.inside else "bad")
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [main_text(p.as_py()) for p in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
