"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text. Menus, forms, adverts and the like are skipped. The first pass
decides what it can from each other block alone, inside an article or not: its link density, its
length and its density of function words. What stays open, mostly short blocks, gets in the second
pass the label of the nearest decided blocks on either side; being in an article counts there, and
teasers give way to the text beside them.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.quality import STOP_WORDS
from tidewright.llm.windows import slices

_NAME_END, _SPECIAL, _COMMENT_END = re.compile(r"[\s/>]"), re.compile("[>\"']"), re.compile("--!?>")
#: Elements of which nothing is text, up to their end tag.
OPAQUE = frozenset("script style title template noscript iframe textarea svg math object audio video canvas select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand outside the main text.
ASIDE = frozenset("nav footer aside form button dialog menu".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody tfoot thead tr ul option".split()
)
#: Elements that end when the next one of their kind, or a block, begins.
CLOSES = {"p": "p", "li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}
HINT = re.compile(
    r"ads?|advert\w*|banners?|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"nav\w*|menu\w*|breadcrumbs?|sidebar|side-?bar|widgets?|comments?|commentlist|disqus|respond|repl(?:y|ies)|related|recommended|"
    r"share|sharing|social|newsletter|subscribe|signup|login|search|pagination|pager|footer|masthead|toolbar|skip-?link|"
    r"copyright|legal|disclaimer|tags?",
    re.IGNORECASE,
)
#: Parts of a class name that may stand beside a hint. Others, as in has-sidebar or tag-news, speak of something else.
BESIDE = re.compile(
    r"site|page|post|entry|main|global|primary|secondary|top|bottom|left|right|side|first|last|box|bar|block|wrap|wrapper|inner|outer|"
    r"container|content|body|area|section|group|list|items?|links?|slot|unit|zone|col|column|row|text|form|thread|panel|buttons?|icons?|message|js|\d+",
    re.IGNORECASE,
)
#: Hints of parts that may be lists of articles; an article inside does not end them, as it ends others.
LISTS = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|widgets?|comments?|commentlist|disqus|respond|repl(?:y|ies)|related|recommended", re.IGNORECASE
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
STOPS = frozenset(STOP_WORDS)

LONG, SHORT = 70, 25
STOPS_HIGH, STOPS_LOW = 0.25, 0.10
LINKS_HIGH = 0.5
#: Characters up to which an article with a link may be a teaser.
TEASER = 300


@dataclass
class Block:
    """Text of one block, the characters of it in links, whether it is a heading, its place (True in
    an article, False in a part that is never main text, None elsewhere), and which article of the page."""

    text: str
    link_chars: int
    heading: bool
    place: bool | None
    article: int = 0

    @property
    def linked(self) -> bool:
        return self.link_chars > LINKS_HIGH * len(self.text)


class Tags:
    """Finds the tags of a page, comments and declarations included, without looking twice at any part.

    A tag ends at the first `>` outside quotes; where a quote stays open, at the first `>`, and an end tag
    counts as a comment then. What lies ahead
    (the next `>`, the next end of a name, quotes that never close) is remembered, so that broken markup
    is read once as well. Searches must go forward.
    """

    def __init__(self, page: str):
        self.page = page
        self.next: dict[str | re.Pattern, int] = {}
        #: special characters outside quotes from which no `>` is reached
        self.hopeless: set[int] = set()

    def ahead(self, what: str | re.Pattern, at: int) -> int:
        """The next place of `what` from `at` on; the length of the page if there is none."""
        if self.next.get(what, -1) < at:
            if isinstance(what, str):
                found = self.page.find(what, at)
            else:
                m = what.search(self.page, at)
                found = m.start() if m else -1
            self.next[what] = found if found >= 0 else len(self.page)
        return self.next[what]

    def closed(self, at: int) -> int:
        """The first `>` from `at` on that is not in quotes; -1 if a quote stays open or none is left."""
        passed, here = [], self.ahead(_SPECIAL, at)
        while here < len(self.page) and here not in self.hopeless:
            if self.page[here] == ">":
                return here
            passed.append(here)
            close = self.page.find(self.page[here], here + 1)
            found = _SPECIAL.search(self.page, close + 1) if close >= 0 else None
            here = found.start() if found else len(self.page)
        self.hopeless.update(passed)
        return -1

    def search(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether an end tag, name, attributes) of the next tag; comments have no name."""
        page, n = self.page, len(self.page)
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            if page.startswith("<!--", start):
                m = _COMMENT_END.search(page, start + 4)
                return start, m.end() if m else n, False, "", ""
            closing = page.startswith("/", at)
            first = page[at + closing : at + closing + 1]
            if first.isascii() and first.isalpha():
                named = self.ahead(_NAME_END, at + closing)
                end = self.closed(named)
                if end < 0 and (end := self.ahead(">", named)) < n and closing:
                    return start, end + 1, False, "", ""
                if end < n:
                    return start, end + 1, closing, page[at + closing : named], page[named:end]
            elif first and page[at] in "!?/" and (end := self.ahead(">", at)) < n:
                return start, end + 1, False, "", ""
        return None


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order. Unclosed and stray tags are taken as browsers do."""
    out: list[Block] = []
    parts: list[str] = []
    # open elements, the place inside them, whether an article would end it, and the article they are in
    stack: list[tuple[str, bool | None, bool, int]] = []
    opened: Counter[str] = Counter()
    links = link_chars = breaks = articles = 0
    heading = False
    place: bool | None = None

    def flush() -> None:
        nonlocal link_chars, heading, breaks
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, link_chars, heading, place, stack[-1][3] if stack else 0))
        parts.clear()
        link_chars, heading, breaks = 0, False, 0

    at, tags = 0, Tags(page)
    while True:
        tag = tags.search(at)
        said = page[at : tag[0] if tag else len(page)]
        if said:
            parts.append(said)
            if not said.isspace():
                breaks = 0
            if links:
                link_chars += len(said.strip())
        if not tag:
            break
        _, at, closing, name, attributes = tag
        name = name.lower()
        if not name:
            continue
        if name in OPAQUE:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(page, at)
                at = end.start() if end else len(page)
            continue
        if name == "br":
            breaks += 1
            flush() if breaks > 1 else parts.append(" ")
            continue
        if name in ("td", "th"):
            parts.append(" ")
        if name in BLOCKS:
            flush()
        if name in VOID:
            continue
        if closing:
            while opened[name]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
        else:
            if name in BLOCKS or name in CLOSES:  # a new block ends an open paragraph, a new item the one before
                for open_name in {"p", name if CLOSES.get(name) else "p", CLOSES.get(name, "p")}:
                    if stack and stack[-1][0] == open_name:
                        opened[stack.pop()[0]] -= 1
            _, above, soft, article = stack[-1] if stack else ("", None, False, 0)
            articles += name == "article"
            stack.append((name, *_place(name, attributes, above, soft), articles if name == "article" else article))
            opened[name] += 1
        place = stack[-1][1] if stack else None
        links = opened["a"] if name == "a" or closing else links
        if re.fullmatch("h[1-6]", name):
            heading = not closing
    flush()
    return out


def _hints(names: str) -> list[str]:
    """The hints in class names and ids, each name taken as a whole."""
    found = []
    for name in names.split():
        parts = [name] if HINT.fullmatch(name) else re.split(r"[_-]+", name.strip("_-"))
        hints = [p for p in parts if HINT.fullmatch(p)]
        if hints and all(HINT.fullmatch(p) or BESIDE.fullmatch(p) for p in parts):
            found += hints
    return found


def _place(name: str, attributes: str, above: bool | None, soft: bool) -> tuple[bool | None, bool]:
    """The place inside an element that opens in the place `above`, and whether a main text inside ends it.
    `soft`: whether this element may end the place above."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
    main = name in MAIN or found.get("role", "").lower() in MAIN
    if above is False and not (main and soft) or name in ASIDE or (name == "header" and above is None):
        return False, name == "form" and above is not False or soft and name not in ASIDE - {"form"}
    if found and name not in ("a", "html", "body"):
        if found.get("role", "").lower() in ROLES or "hidden" in found or found.get("aria-hidden") == "true":
            return False, False
        if re.search(r"display\s*:\s*none", found.get("style", "")):
            return False, False
        hints = [] if name == "main" else _hints(f"{found.get('class', '')} {found.get('id', '')}")
        if hints and (name != "article" or any(LISTS.fullmatch(h) for h in hints)):
            return False, not any(LISTS.fullmatch(h) for h in hints)
    return (True if main else above), False


def first_pass(found: list[Block]) -> list[bool | None]:
    """True: main text, False: not, None: open. A single link between the paragraphs of an article stays open."""
    labels: list[bool | None] = []
    for i, block in enumerate(found):
        if block.place is False:
            labels.append(False)
        elif block.linked:
            beside = [b for b in found[max(i - 1, 0) : i] + found[i + 1 : i + 2] if b.place and b.linked and not b.heading]
            labels.append(None if block.place and (block.heading or not beside) else False)
        else:
            words = block.text.lower().split()
            density = sum(w.strip(".,;:!?\"'()") in STOPS for w in words) / len(words)
            prose = len(block.text) >= LONG and density >= STOPS_LOW or len(block.text) >= SHORT and density >= STOPS_HIGH
            labels.append(True if prose or len(block.text) >= 3 * LONG and block.link_chars == 0 else None)
    return labels


def teasers(found: list[Block], labels: list[bool | None]) -> set[int]:
    """Articles that only lead to other pages: short, with a link, and several of them or below a linked
    heading, on a page that has main text beside them."""
    chars: dict[int, int] = {}
    linking, headed = set(), set()
    for b in found:
        if b.place and b.article:
            chars[b.article] = chars.get(b.article, 0) + len(b.text)
            linking |= {b.article} if b.link_chars else set()
            headed |= {b.article} if b.heading and b.linked else set()
    short = {a for a in linking if chars[a] <= TEASER}
    short = short if len(short) > 1 else short & headed
    return short if any(label and b.article not in short for b, label in zip(found, labels)) else set()


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest block of their place, in an article or outside, that is
    decided by its own text. Where two are equally near, a heading follows the one after it, and any
    other is main text if either is. Without any decided block the open ones are main text in an
    article, and outside if the page has none.
    """
    n = len(labels)
    outside = not any(b.place for b in found)
    out = [bool(label) for label in labels]
    for place in (True, None):
        of_place = [b.place is place for b in found]
        before, after = [-1] * n, [n] * n
        last = -1
        for i in range(n):
            last = i if of_place[i] and labels[i] is not None else last
            before[i] = last
        last = n
        for i in reversed(range(n)):
            last = i if of_place[i] and labels[i] is not None else last
            after[i] = last
        for i in range(n):
            if not of_place[i] or labels[i] is not None:
                continue
            b, a = before[i], after[i]
            if b < 0 and a >= n:
                out[i] = bool(place) or outside
            elif b < 0 or (a < n and (a - i < i - b or (a - i == i - b and found[i].heading))):
                out[i] = bool(labels[a])
            elif a >= n or i - b < a - i:
                out[i] = bool(labels[b])
            else:
                out[i] = bool(labels[a] or labels[b])
    return out


def main_text(page: str) -> str:
    """The blocks of the main text joined by a line feed; empty if there are none."""
    found = blocks(page)
    labels = first_pass(found)
    passed_over = teasers(found, labels)
    for i, b in enumerate(found):
        if b.place and b.article in passed_over:
            b.place, labels[i] = False, False
    return "\n".join(b.text for b, keep in zip(found, second_pass(found, labels)) if keep)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """The rows of `pages` without `html_col`, with `text_col` and `n_chars`, which replace such columns.

    Null and empty pages have an empty text. Repeated rows come back as they are; an empty table
    gives none. Long pages and broken markup are read once.
    """
    keep = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower(), "n_chars")]
    rows = pages.select(F.struct(*keep).alias("row"), F.coalesce(html_col, F.lit("")).alias("html"))
    kind = rows.schema["row"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_ = batch.column(1).to_pylist()
            for at, upto in slices(pages_):
                texts = pa.array([main_text(p) for p in pages_[at:upto]], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, upto - at), texts], names=["row", "text"])

    made = rows.mapInArrow(work, f"row {kind}, text string")
    return made.select("row.*", F.col("text").alias(text_col), F.length("text").cast("long").alias("n_chars"))
