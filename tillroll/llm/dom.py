"""Pages as trees of blocks: what each block says, and numbers that describe it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np

# Elements by how they are laid out.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style noscript template svg math iframe object canvas audio video select textarea".split())
#: What can stand in a head; html is no element of its own here.
HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
#: Unseen elements that may hold others of their name.
NESTED = frozenset("template svg math object".split())
#: A start tag on the left closes an open element on the right, up to the nearest of the elements behind it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

GROUPS = (
    ("article", "main"),
    ("section", "div"),
    ("p",),
    ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"),
    ("ul", "ol", "dl", "menu"),
    ("li", "dt", "dd"),
    ("nav",),
    ("header",),
    ("footer", "address"),
    ("aside",),
    ("form", "fieldset", "button", "dialog"),
    ("table", "tbody", "thead", "tfoot", "tr", "td", "th"),
    ("blockquote", "pre", "figure", "figcaption"),
    ("html", "body"),
)
_GROUP = {tag: i for i, tags in enumerate(GROUPS) for tag in tags}
OTHER = len(GROUPS)
#: A start tag of these ends an unseen element that is never closed.
BLOCKS = frozenset(_GROUP) | frozenset("caption center details dir hr search summary".split())

#: Words in class, id and role, by what they hint at.
HINTS = (
    "article content post entry main story body text page",
    "nav navbar navigation menu breadcrumb breadcrumbs tabs pager pagination toc",
    "header masthead banner topbar branding logo",
    "footer copyright legal colophon contentinfo",
    "sidebar aside related widget recommended rail teaser more complementary",
    "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup paywall message",
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner300",
    "comment comments reply replies respond disqus discussion responses commentlist reader",
    "share social follow tags meta byline search login form",
)
_HINTS = [frozenset(words.split()) for words in HINTS]
_WORD = re.compile(r"[a-z]+")
_UNSEEN_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1|\Z)|<(/?)(" + "|".join(sorted(UNSEEN - {"head", "script", "style"})) + r")\b", re.S | re.I
)
_SENTENCE_END = re.compile(r"[.!?…](?:\s|$)")

FEATURES = OTHER + 1 + 2 * len(HINTS) + 14


@dataclass
class Page:
    """Blocks in the order they begin, each with its parent; the texts of a page with the block that says them."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    hints: list[frozenset[int]] = field(default_factory=list)
    labels: list[int | None] = field(default_factory=list)
    pieces: list[tuple[int, str, int]] = field(default_factory=list)


def _never_closed(html: str) -> set[tuple[int, int]]:
    """Line and column of each start tag of an unseen element that has no end tag; a head's is not needed."""
    open_at: dict[str, list[int]] = {}
    lost, stop = [], -1
    for found in _UNSEEN_TAG.finditer(html):
        if not found[3]:
            continue
        tag, at = found[3].lower(), found.start()
        own = open_at.setdefault(tag, [])
        if found[2]:
            if own:
                own.pop()
            continue
        if stop < at and (stop := html.find(">", at)) < 0:
            break
        if html[stop - 1] == "/":
            continue
        if tag not in NESTED:
            lost += own
            own.clear()
        own.append(at)
    lost += [at for own in open_at.values() for at in own]
    places, line, begin, done = set(), 1, 0, 0
    for at in sorted(lost):
        if lines := html.count("\n", done, at):
            line, begin = line + lines, html.rindex("\n", done, at) + 1
        places.add((line, at - begin))
        done = at
    return places


class _Reader(HTMLParser):
    """Builds a Page; a piece is (block, text, characters of it inside links).

    A head ends with the first thing that can't stand in it; an unseen element
    without an end tag with the first block that begins in it, or with the
    block around it.
    """

    def __init__(self, never_closed: set[tuple[int, int]]):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self._open: list[tuple[str, int]] = []
        #: Places in _open of each tag.
        self._places: dict[str, list[int]] = {}
        self._never_closed = never_closed
        #: Places in _open of unseen elements, and whether they are never closed.
        self._unseen: list[tuple[int, bool]] = []
        self._links = 0
        self._text: list[str] = []
        self._linked = 0
        self._add("body", [])
        self._push("#root", 0)

    def _push(self, tag: str, block: int) -> None:
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append((tag, block))

    def _add(self, tag: str, attrs: list) -> int:
        page = self.page
        said = " ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role", "itemprop"))
        words = set(_WORD.findall(said)) if said else ()
        page.tags.append(tag)
        page.parents.append(self._open[-1][1] if self._open else -1)
        page.hints.append(frozenset(i for i, own in enumerate(_HINTS) if not own.isdisjoint(words)) if words else frozenset())
        label = next((v for k, v in attrs if k == "data-label"), None)
        page.labels.append(int(label) if label in ("0", "1") else None)
        return len(page.tags) - 1

    def end_piece(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            self.page.pieces.append((self._open[-1][1], text, min(self._linked, len(text))))
        self._text, self._linked = [], 0

    def _pop(self, at: int) -> None:
        seen = self._unseen[0][0] if self._unseen else len(self._open)
        if any(tag not in INLINE for tag, _ in self._open[at:seen]):
            self.end_piece()
        for tag, _ in self._open[at:]:
            self._places[tag].pop()
            self._links -= tag == "a"
        while self._unseen and self._unseen[-1][0] >= at:
            self._unseen.pop()
        del self._open[at:]

    def _end_unseen(self, tag: str) -> None:
        """Ends the innermost unseen elements that can't hold this tag."""
        while self._unseen:
            at, never_closed = self._unseen[-1]
            if tag in HEAD if self._open[at][0] == "head" else not never_closed or tag not in BLOCKS:
                return
            self._pop(at)

    def _close(self, tags, until=frozenset()) -> None:
        """Closes the last open element of these tags, unless one of `until` was opened after it."""
        at = self._last(tags)
        if at > max(0, self._last(until)):
            self._pop(at)

    def _last(self, tags) -> int:
        return max((self._places[tag][-1] for tag in tags if self._places.get(tag)), default=-1)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._end_unseen(tag)
        if tag == "br" and not self._unseen:
            self._text.append(" ")
        if tag in VOID and (tag != "hr" or self._unseen):
            return
        if tag in INLINE or self._unseen:
            # Inside an unseen element nothing but its nesting matters.
            if tag in UNSEEN:
                self._unseen.append((len(self._open), self.getpos() in self._never_closed))
            if tag not in ("html", "body"):
                self._links += tag == "a"
                self._push(tag, self._open[-1][1])
            return
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        elif tag not in UNSEEN:
            self._close({"p"}, {"td", "th", "button", "li", "div", "article", "section"} if tag != "p" else {"td", "th", "button"})
        if tag == "head" and (len(self.page.tags) > 1 or self.page.pieces or "".join(self._text).strip()):
            return
        if tag in UNSEEN:
            self._unseen.append((len(self._open), self.getpos() in self._never_closed))
            self._push(tag, self._open[-1][1])
            return
        self.end_piece()
        if tag in ("html", "body", "hr"):
            return
        self._push(tag, self._add(tag, attrs))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("html", "body"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            self._end_unseen("body")
            self.end_piece()
        elif tag == "br":
            self._text.append("" if self._unseen else " ")
        elif not any(at > self._last({tag}) and not lost and self._open[at][0] != "head" for at, lost in self._unseen[:1]):
            # An end tag ends no element around an unseen one that has its own end tag still to come.
            self._close({tag})

    def handle_data(self, data: str) -> None:
        if self._unseen and self._open[-1][0] == "head" and data.strip():
            self._pop(self._unseen[-1][0])
        if self._unseen:
            return
        self._text.append(data)
        if self._links:
            self._linked += len(data.strip())


def read_page(html: str | None) -> Page:
    """The blocks and texts of a page; a null or empty one has its root alone."""
    reader = _Reader(_never_closed(html) if html else set())
    if html:
        reader.feed(html)
        reader.close()
        reader.end_piece()
    return reader.page


def describe(page: Page) -> np.ndarray:
    """FEATURES numbers for each block: its element, hints on it and above it, its texts, its subtree, its place."""
    count = len(page.tags)
    chars, linked, ends, words = (np.zeros(count) for _ in range(4))
    place = np.zeros(count)
    for i, (block, text, inside) in enumerate(page.pieces):
        chars[block] += len(text)
        linked[block] += inside
        ends[block] += len(_SENTENCE_END.findall(text))
        words[block] += text.count(" ") + 1
        place[block] = i
    all_chars, all_linked, all_ends = chars.copy(), linked.copy(), ends.copy()
    paragraphs = np.array([t == "p" for t in page.tags], float)
    above = [page.hints[0]]
    parents = page.parents
    for at in range(1, count):
        above.append(page.hints[at] | above[parents[at]] if page.hints[at] else above[parents[at]])
    for at in range(count - 1, 0, -1):
        up = parents[at]
        all_chars[up] += all_chars[at]
        all_linked[up] += all_linked[at]
        all_ends[up] += all_ends[at]
        paragraphs[up] += paragraphs[at]
    out = np.zeros((count, FEATURES))
    rows = np.arange(count)
    groups = np.array([_GROUP.get(t, OTHER) for t in page.tags])
    out[rows, groups] = 1
    at = OTHER + 1
    for i in range(count):
        for h in page.hints[i]:
            out[i, at + h] = 1
        for h in above[i]:
            out[i, at + len(HINTS) + h] = 1
    at += 2 * len(HINTS)
    total = max(1.0, all_chars[0])
    numbers = (
        np.log1p(chars) / 8,
        linked / np.maximum(1, chars),
        np.minimum(1, ends / np.maximum(1, words) * 8),
        chars > 0,
        words > 8,
        ends > 0,
        np.log1p(all_chars) / 10,
        all_linked / np.maximum(1, all_chars),
        all_chars / total,
        np.log1p(paragraphs) / 4,
        np.minimum(1, all_ends / 20),
        place / max(1, len(page.pieces)),
        all_chars == 0,
        np.ones(count),
    )
    for k, column in enumerate(numbers):
        out[:, at + k] = column
    return out


def groups_of(page: Page) -> np.ndarray:
    """Number of each block's kind of element."""
    return np.array([_GROUP.get(t, OTHER) for t in page.tags])
