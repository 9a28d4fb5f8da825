"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one a block element. Lines of menus, adverts, forms and the like count as
empty, so that the distribution of text over lines falls to zero there. Over windows of lines the text
lengths (without link text) are summed; a surge from nothing to more than a threshold starts a passage, the
dive back to nothing ends it, and the text between them is kept. Lines of an article or main element form
passages of their own and, where a page has such an element, only these are kept. Names of elements are
evidence: what they mark counts as empty only as far as the distribution does not speak against it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import released, text_blocks

#: Lines of a window, and characters of a window from which its passage is text.
WINDOW, SURGE = 3, 86

RAW = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>script|style|noscript|template|svg|math|textarea|title|iframe|object|canvas)\b[^<>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
# possessive, and without "<" outside of quotes, so that an unclosed tag costs no second look at what follows
TAG = r"""<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9-]*+)(?P<rest>(?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^<>]*+>|<[a-zA-Z/!?][^<>]*+\Z"""
SCAN = re.compile(f"{RAW}|{TAG}", re.S | re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("head nav footer aside form button select menu dialog audio video fieldset".split())
PARAGRAPHS = frozenset("p li h1 h2 h3 h4 h5 h6 blockquote pre dd dt td th figcaption".split())
CONTAINERS = frozenset("body div section article main table".split())
SIBLINGS = frozenset("p li td th tr option dd dt".split())
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
#: What a class says of its element's surroundings or subject, such as has-sidebar or category-social.
ABOUT = re.compile(r"(?:^|(?<=[_-]))(?:has|no|not|with|without|category|cat|tag)[_-].*", re.I | re.S)
SURE = re.compile(
    r"(?:^|[_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|notice|comments?|commentlist|disqus|replies|respond|sidebar|widget|menu|nav(?:igation|bar)?|breadcrumbs?|footer|masthead|newsletter|subscribe|signup|popup|modal|overlay|pagination|pager|complementary|contentinfo)(?=$|[_-])",
    re.I,
)
#: Names that parts of an article may have too: their elements are dropped only if no line of them is long.
DOUBTFUL = re.compile(r"(?:^|[_-])(?:alert|banner|share|sharing|social|related|recommended|skip|search|login)(?=$|[_-])", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def marks_of(rest: str) -> tuple[bool, bool, bool]:
    """(whether a tag's attributes hide its element, whether its names mark it as no part of the main text, whether they leave no doubt)."""
    hidden = marked = sure = False
    for found in ATTRIBUTE.finditer(rest):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and UNSEEN.search(value)):
            hidden = True
        elif name in ("class", "id", "role", "aria-label"):
            tokens = [ABOUT.sub("", token) for token in value.split()]
            sure = sure or any(map(SURE.search, tokens))
            marked = marked or sure or any(map(DOUBTFUL.search, tokens))
    return hidden, marked, sure


class Page:
    """Lines of a page, one a block element, found in one pass over its tags.

    ``texts``, ``links`` (characters of link text), ``inside`` (in an article or main element), ``blocks`` (whether
    the line is a paragraph, item or heading) and ``holders`` (the number of the container around it) describe the
    lines; parts that never hold main text leave WINDOW empty ones. ``regions`` are the elements that their names
    mark: (first line, line after the last, whether the names leave no doubt).
    """

    def __init__(self, page: str):
        self.texts: list[str] = []
        self.links: list[int] = []
        self.inside: list[bool] = []
        self.blocks: list[bool] = []
        self.holders: list[int] = []
        self.regions: list[tuple[int, int, bool]] = []
        self._parts: list[str] = []
        self._linked = self._open_links = self._inside = self._dropped = self._blocks = 0
        # open elements: name, whether it is the root of a dropped part, whether its lines count as inside, its region
        self._stack: list[tuple[str, bool, bool, tuple[int, bool] | None]] = []
        self._at: dict[str, list[int]] = {}  # places in the stack by name
        self._walls: list[int] = []  # places of elements that are not inline
        self._containers = [0]
        self._numbered = 0
        self._scan(page)

    def _end_line(self) -> None:
        text = " ".join(html.unescape("".join(self._parts)).split())
        if text:
            self._add(text, min(self._linked, len(text)), self._blocks > 0)
        self._parts.clear()
        self._linked = 0

    def _add(self, text: str, linked: int, block: bool) -> None:
        self.texts.append(text)
        self.links.append(linked)
        self.inside.append(self._inside > 0)
        self.blocks.append(block)
        self.holders.append(self._containers[-1])

    def _gap(self) -> None:
        self._end_line()
        for _ in range(WINDOW):
            self._add("", 0, False)

    def _pop(self) -> None:
        name, root, counted, region = self._stack.pop()
        self._at[name].pop()
        if self._walls and self._walls[-1] == len(self._stack):
            self._walls.pop()
        if name not in INLINE or root or region:
            self._end_line()
        self._dropped -= root
        if root:
            self._gap()
        self._open_links -= name == "a"
        self._inside -= counted
        self._blocks -= name in PARAGRAPHS
        if name in CONTAINERS:
            self._containers.pop()
        if region:
            self.regions.append((region[0], len(self.texts), region[1]))

    def _push(self, name: str, rest: str) -> None:
        root = name in DROPPED or (name == "header" and not self._inside)
        region = None
        if not root and rest and name not in ("html", "body"):
            root, marked, sure = marks_of(rest)
            if marked and not root and name not in ("article", "main"):
                if name in INLINE:
                    root = True
                else:
                    region = (len(self.texts), sure)
        if root:
            self._gap()
        self._dropped += root
        self._open_links += name == "a"
        counted = name in ("article", "main") and not self._dropped  # an article in a dropped part is none
        self._inside += counted
        self._blocks += name in PARAGRAPHS
        if name in CONTAINERS:
            self._numbered += 1
            self._containers.append(self._numbered)
        self._at.setdefault(name, []).append(len(self._stack))
        if name not in INLINE:
            self._walls.append(len(self._stack))
        self._stack.append((name, root, counted, region))

    def _take(self, text: str) -> None:
        if text and not self._dropped:
            self._parts.append(text)
            if self._open_links:
                self._linked += len(text)

    def _scan(self, page: str) -> None:
        at = 0
        for tag in SCAN.finditer(page):
            self._take(page[at : tag.start()])
            at = tag.end()
            name = (tag["name"] or "").lower()
            if not name:
                continue
            if name not in INLINE:
                self._end_line()
            places = self._at.get(name)
            if tag["close"]:
                if places:
                    bottom = places[-1]
                    while len(self._stack) > bottom:
                        self._pop()
                continue
            rest = tag["rest"]
            if name in VOID or rest.endswith("/"):
                continue
            # these end an open one of their kind, if only inline elements stand between
            if name in SIBLINGS and places and (not self._walls or places[-1] >= self._walls[-1]):
                bottom = places[-1]
                while len(self._stack) > bottom:
                    self._pop()
            self._push(name, rest)
        self._take(page[at:])
        while self._stack:
            self._pop()
        self._end_line()


def masses(own: list[int], window: int) -> list[int]:
    """The sum over each line and those after it in the window."""
    return [sum(own[i : i + window]) for i in range(len(own))]


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The text between surge and dive points, blocks joined by one space; empty for null and empty pages.

    A marked element counts as empty if its names leave no doubt or no line of it reaches ``surge``, unless it holds over half of the
    page's text. Where an article or main element has text, lines outside of them count as empty and links inside count
    as text. A passage below ``surge`` is kept inside such an element, or if its paragraphs stand in
    the same container as a passage that reaches it.
    """
    if not page:
        return ""
    found = Page(page)
    texts, inside = found.texts, found.inside
    own = [len(text) - linked for text, linked in zip(texts, found.links, strict=True)]
    before, long = [0, *accumulate(own)], [0, *accumulate(n >= surge for n in own)]
    edges = [0] * (len(texts) + 1)
    for first, last, sure in found.regions:
        if 2 * (before[last] - before[first]) <= before[-1] and (sure or long[first] == long[last]):
            edges[first] += 1
            edges[last] -= 1
    gone = [n > 0 for n in accumulate(edges[:-1])]
    framed = any(a and t and not g for a, t, g in zip(inside, texts, gone, strict=True))
    # the distribution: lines of dropped parts are nothing, and each dropped run is a gap as wide as the window
    order: list[int] = []
    for i in range(len(texts)):
        if gone[i] or (framed and not inside[i]):
            if order and order[-1] >= 0:
                order += [-1] * window
        else:
            order.append(i)
    amounts = [0 if i < 0 else len(texts[i]) if framed else own[i] for i in order]
    mass = masses(amounts, window)
    passages: list[tuple[int, int]] = []
    start = None
    for i, n in enumerate([*mass, 0]):
        if start is None and n > 0:
            start = i
        elif start is not None and n == 0:
            passages.append((start, i))
            start = None
    least = 0 if framed else surge
    kept = [max(mass[i:j]) > least for i, j in passages]
    if not any(kept) and passages:  # a page of little text: its longest passage
        longest = max(passages, key=lambda p: sum(amounts[p[0] : p[1]]))
        kept = [p == longest for p in passages]
    lines = lambda p: [k for k in order[p[0] : p[1]] if k >= 0 and texts[k]]
    beside = {found.holders[k] for p, keep in zip(passages, kept, strict=True) if keep for k in lines(p) if found.blocks[k] and own[k]}
    chosen = [k for p, keep in zip(passages, kept, strict=True) for k in lines(p) if keep or (found.blocks[k] and own[k] and found.holders[k] in beside)]
    return " ".join(texts[k] for k in chosen)


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, text and n_chars (code points) of each page. Nothing is shuffled; null pages have empty text,
    repeated rows are extracted each, an empty table gives no row."""
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in released(text_blocks(batches, column="__html")):
            texts = list(map(main_text, batch.column(len(keep)).to_pylist()))
            columns = [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])

    return pages.select(*keep, F.col(html_col).alias("__html")).mapInArrow(run, f"{kinds}, text string, n_chars long")
