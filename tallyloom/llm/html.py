"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text nodes, each under its path of tags from the
root. Text that belongs to the article repeats one path with much text and much
punctuation; menus, notices and adverts repeat others with little. Per path the
length of text and the punctuation are summed over its nodes and divided by their
number; the two ratios are smoothed along the page, fused and held against a
threshold taken from the page itself. The paths that pass select the content.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.texts import only, slices

# --- Fixed values: element names and words of the HTML standard and of common page layouts. ---

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is not markup and not prose.
RAW = frozenset("script style noscript template textarea select iframe svg math object title head".split())
#: Elements read up to their end tag as plain characters.
CDATA = frozenset("script style textarea title iframe noscript".split())
#: Elements that never are part of the article.
OUTSIDE = frozenset("nav header footer aside form button dialog menu fieldset label".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Open elements that a start tag closes by itself, up to the boundary in the second set.
CLOSES = {
    "p": ({"p"}, set()),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
#: Formatting elements: a stray one stays open over blocks and says nothing about the layout.
INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var wbr".split())
#: Words in class, id and role that name parts around the article.
AROUND = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary "
    "consent contentinfo cookie cookies discussion disqus feedback footer gdpr header menu modal nav navbar navigation newsletter "
    "notice notices pagination popup promo promos promotion reaction reactions related replies reply respond review reviews search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that may stand beside them in one name, as they only tell where or in what form the part is.
LAYOUT = frozenset(
    "area articles bar block blocks bottom box btn button buttons col column container content fixed form global icons inner item items "
    "has left link links list main mobile no page posts primary right row section secondary site slot sticky thread top with wrap wrapper".split()
)
PUNCTUATION = re.compile(r"[,.;:!?…、。，：；！？]")

#: A tag or comment. A quote only counts behind an equals sign, and where none closes it it is a character like others;
#: no part is read twice.
TAG = re.compile(
    r"<(?:!--.*?(?:-->|$)|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*(?:>|$)|"
    r"(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|$))", re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+""", re.I)
SPACES = re.compile(r"\s+")


@dataclass
class Block:
    """The text between two block borders, the number of its path, and how much of it is link text.

    ``around`` numbers the innermost open element that is named as a part around the article, 0 if there is none.
    """

    path: int
    outside: bool
    around: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


class Page:
    """The blocks of a page in order. Paths and named elements are numbered, each with the number of its parent, so a
    path takes one entry however deep it is, and what holds for ancestors is worked out from parents to children."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        #: Per path its parent, its last label, and whether an article or main is in it. Path 0 is the page.
        self.parent, self.label, self.core = [0], [""], [False]
        self.number: dict[tuple[int, str], int] = {}
        #: Per named element the named element around it.
        self.named = [0]

    def child(self, path: int, name: str, label: str) -> int:
        found = self.number.get((path, label))
        if found is None:
            found = self.number[path, label] = len(self.parent)
            self.parent.append(path)
            self.label.append(label)
            self.core.append(self.core[path] or name in ("article", "main"))
        return found


def _attributes(source: str) -> tuple[str, bool]:
    """Words of class, id and role, and whether the element is hidden."""
    words, hidden = [], False
    for name, value in ATTRIBUTE.findall(source):
        value, name = value.strip("\"'"), name.lower()
        if name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden = hidden or value.lower() == "true"
        else:
            words.append(value)
    return " ".join(words).lower(), hidden


def _names_a_part(words: str) -> bool:
    """Whether one of the names is made of a word for a part around the article, and of layout words only."""
    for name in words.split():
        pieces = [p for p in re.split(r"[_-]+", name) if p and not p.isdigit()]
        if any(p in AROUND for p in pieces) and all(p in AROUND or p in LAYOUT for p in pieces):
            return True
    return False


class _Open:
    """The open elements, with what is asked of them kept as totals: nothing walks down the stack."""

    def __init__(self) -> None:
        self.names: list[str] = []
        # Per open element, the sum or the innermost so far: path, outside, named element, raw, links, block elements.
        self.state: list[tuple[int, bool, int, int, int, int]] = [(0, False, 0, 0, 0, 0)]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.block_places: list[int] = []

    def last(self, name: str) -> int:
        """Where the innermost open element of a name is, -1 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def push(self, name: str, path: int, outside: bool, around: int) -> None:
        _, _, _, raw, links, inner = self.state[-1]
        self.places[name].append(len(self.names))
        if name in BLOCK:
            self.block_places.append(len(self.names))
        self.names.append(name)
        self.state.append((path, outside, around, raw + (name in RAW), links + (name == "a"), inner + (name in BLOCK)))

    def close(self, upto: int) -> bool:
        """Close the elements from ``upto`` on; whether one of them ends a block."""
        ends = self.state[-1][5] > self.state[upto][5]
        while len(self.names) > upto:
            name = self.names.pop()
            self.places[name].pop()
            self.state.pop()
            if name in BLOCK:
                self.block_places.pop()
        return ends


def blocks(html: str) -> Page:
    """Text blocks in page order. Broken markup is read as it comes: ends without a start are passed over."""
    page, stack = Page(), _Open()
    current: Block | None = None

    def add(text: str) -> None:
        nonlocal current
        path, outside, around, raw, links, _ = stack.state[-1]
        if not text or raw:
            return
        if current is None:
            current = Block(path, outside, around)
            page.blocks.append(current)
        plain = unescape(text)
        current.parts.append(plain)
        if links:
            current.linked += len(plain.strip())

    at = 0
    while at < len(html):
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        match = TAG.match(html, lt)
        if match is None:
            add(html[at:lt + 1])
            at = lt + 1
            continue
        add(html[at:lt])
        at = match.end()
        ending, name, rest = match.group(1), (match.group(2) or "").lower(), match.group(3) or ""
        if not name:
            if match.group().startswith("<![CDATA["):
                add(match.group()[9:-3])
            continue
        if ending:
            k = stack.last(name)
            # An inline end does not reach over a block, an inner end not over its cell or list.
            if k >= 0 and (name not in INLINE or stack.state[-1][5] == stack.state[k + 1][5]) and stack.close(k):
                current = None
            if name in BLOCK:
                current = None
            continue
        if name in BLOCK:
            current = None
        if name in ENDS_P and stack.block_places and stack.names[stack.block_places[-1]] == "p":
            stack.close(stack.block_places[-1])
        if name in CLOSES:
            closed, border = CLOSES[name]
            k = max(map(stack.last, closed))
            if k >= 0 and k > max(map(stack.last, border), default=-1) and stack.close(k):
                current = None
        if name in VOID or rest.rstrip().endswith("/") and name not in BLOCK:
            continue
        if name in CDATA:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        words, hidden = _attributes(rest) if rest.strip() else ("", False)
        path, outside, around, *_ = stack.state[-1]
        # The whole page or article may carry such a word as a layout flag; there it says nothing.
        if words and name not in ("html", "body", "main", "article") and _names_a_part(words):
            page.named.append(around)
            around = len(page.named) - 1
        # A header inside the article holds its headline.
        outside = outside or hidden or name in OUTSIDE and not (name == "header" and stack.last("article") >= 0)
        # Formatting elements are no part of a path; a stray one would split the article.
        if name not in INLINE:
            path = page.child(path, name, f"{name}.{'.'.join(sorted(words.split()))}" if words else name)
        stack.push(name, path, outside, around)
    for b in page.blocks:
        b.text = SPACES.sub(" ", "".join(b.parts)).strip()
        b.parts.clear()
    page.blocks = [b for b in page.blocks if b.text]
    return page


def _apart(page: Page) -> list[bool]:
    """Per block whether it lies in an element named as a part around the article.

    The words say nothing on an element that holds most of the page's unlinked text, as a page wrapper does,
    unless an article or main with text lies beside it.
    """
    told = [b for b in page.blocks if not b.outside]
    prose = [0] * len(page.named)
    cores = [0] * len(page.named)
    for b in told:
        prose[b.around] += max(0, len(b.text) - b.linked)
        cores[b.around] += b.linked < len(b.text) and page.core[b.path]
    # Children have greater numbers than their parents.
    for n in range(len(page.named) - 1, 0, -1):
        prose[page.named[n]] += prose[n]
        cores[page.named[n]] += cores[n]
    apart = [False] * len(page.named)
    for n in range(1, len(page.named)):
        wraps = 2 * prose[n] > prose[0] and (not cores[0] or cores[n] > 0)
        apart[n] = apart[page.named[n]] or not wraps
    return [apart[b.around] for b in page.blocks]


def _smooth(values: np.ndarray, radius: int = 1) -> np.ndarray:
    """A Gaussian over the neighbours in page order, with a deviation of the radius."""
    weights = np.exp(-np.arange(-radius, radius + 1) ** 2 / (2.0 * radius * radius))
    padded = np.pad(values, radius, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def _scores(found: list[Block]) -> np.ndarray:
    """Per block the smoothed and fused text and punctuation of its path, link text not counted."""
    text, marks, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in found:
        text[b.path] += max(0, len(b.text) - b.linked)
        marks[b.path] += len(PUNCTUATION.findall(b.text)) if b.linked < len(b.text) else 0
        nodes[b.path] += 1
    by_text = _smooth(np.array([text[b.path] / nodes[b.path] for b in found]))
    by_marks = _smooth(np.array([marks[b.path] / nodes[b.path] for b in found]))
    # A path of link text only has no score of its own, whatever stands beside it.
    return np.where([text[b.path] > 0 for b in found], np.log1p(by_text) * np.log1p(by_marks), -1.0)


def _root(page: Page, passed: set[int]) -> int:
    """The lowest common ancestor of paths."""
    below = [0] * len(page.parent)
    for path in passed:
        below[path] += 1
    for path in range(len(below) - 1, 0, -1):
        below[page.parent[path]] += below[path]
    # The last of the ancestors that hold all of them: ancestors have smaller numbers.
    return max(path for path, n in enumerate(below) if n == len(passed))


def select(page: Page, share: float = 0.5, lowered: float = 0.2) -> list[Block]:
    """The content among the blocks of one page, in page order.

    Each path scores its text and its punctuation per node, link text not counted. Scores are smoothed along
    the page and fused; a path passes if its best node reaches ``share`` of the page's deviation. Every block of a
    passing path stays. A part named as lying around the article scores ``lowered`` times what it does, and has to reach
    the middle score of the article's own blocks, and to hold more text than all of them; it is taken for the article where there is nothing else. Below the
    lowest common ancestor of the passing paths short neighbours are added, no longer than the longest block that
    passed: a headline or a one-word paragraph is told by where it stands.
    """
    inside = [(b, apart) for b, apart in zip(page.blocks, _apart(page)) if not b.outside]
    own, around = ([b for b, apart in inside if apart is part] for part in (False, True))
    passed: set[int] = set()
    longest = 0
    for found in (own, around):
        if not found or passed and found is around:
            continue
        scores = _scores(found)
        threshold = share * np.maximum(scores, 0).std()
        good = (scores >= threshold) & (scores >= 0)
        passed |= {b.path for b, ok in zip(found, good) if ok}
        longest = max([longest, *(len(b.text) for b in found if b.path in passed)])
        if found is own and passed and around:
            middle, prose = float(np.median(scores[good])), defaultdict(int)
            for b in inside:
                prose[b[0].path] += max(0, len(b[0].text) - b[0].linked)
            most = sum(prose[path] for path in passed)
            passed |= {b.path for b, score in zip(around, _scores(around)) if lowered * score >= middle and prose[b.path] > most}
    if not passed:
        return []
    # The container of the article: the lowest common ancestor of all passing paths.
    root = _root(page, passed)
    if len(passed) == 1 and root and page.label[root].split(".")[0] in BLOCK - {"article", "section", "main", "div", "body", "td"}:
        # A single path may be the paragraph itself; its neighbours share the parent.
        root = page.parent[root]
    under = [False] * len(page.parent)
    for path in range(root, len(under)):
        under[path] = path == root or path > 0 and under[page.parent[path]]
    return [b for b, apart in inside if b.path in passed or not apart and under[b.path] and b.linked < len(b.text) <= longest]


def main_text(html: str | None) -> str:
    """The article of one page, a block per line."""
    return "\n".join(b.text for b in select(blocks(html or "")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` per row. A null, empty or text-free page has the empty text.

    Pages are judged one by one, each from its own paths: nothing is shuffled, repeated rows get the same text,
    an empty table gives an empty result and further columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    source = only(pages, page_id=id_col, url=url_col, html=html_col)
    kind = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(run, f"page_id {kind}, url string, text string")
