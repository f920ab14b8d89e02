"""The main text of HTML pages by a minimum cut.

A page is cut into blocks of text. A linear classifier gives each block a cost for being called
boilerplate and a cost for being called content: the capacities of its edges from the source and
to the sink. Neighbours in page order are joined by an edge, stronger the more ancestors they
share, and so are blocks that follow each other under the same parent with others between. The
maximum flow from source to sink finds the cut of least total cost; what stays on the source's
side is the main text.

The weights below are set by hand; there are no labelled pages to fit them to.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import quoted, ship

#: Elements that hold no markup and no text to read; all up to their end tag is left out.
RAW = frozenset("script style noscript iframe textarea title".split())
#: Elements whose subtree holds no text to read; one left open ends with its parent.
SILENT = frozenset("template svg math object canvas audio video map select option button head".split())
#: Of these, the ones that stand within a line.
IN_LINE = frozenset("script button select svg math".split())
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript noframes template head html".split())
#: Elements that end an unclosed svg or math, unless in one that takes HTML.
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
TAKES_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
#: Elements within a line; all others start and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr input meta link base embed".split()
)
#: Elements without an end.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are boilerplate by their kind.
NOT_MAIN = frozenset("nav footer aside form menu dialog header".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of class, id and role that mark boilerplate, and those that mark content.
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice alert nav navbar navigation menu breadcrumb breadcrumbs footer foot header masthead sidebar "
    "side rail widget widgets comment comments commentlist reply replies respond disqus discussion share sharing "
    "social related recommended newsletter subscribe subscription signup login signin form search popup modal "
    "overlay tags pagination pager toolbar copyright legal disclaimer complementary contentinfo "
    "kommentar kommentare leserkommentare commentaire commentaires comentario comentarios werbung anzeige "
    "publicite publicidad anuncio anuncios impressum datenschutz seitenleiste fusszeile".split()
)
#: Headings, letters and spaces only, of a section or division with what readers wrote.
COMMENT_HEADINGS = frozenset(
    {
        "comment", "comments", "reader comments", "leave a comment", "leave a reply", "replies", "responses",
        "kommentar", "kommentare", "leserkommentare", "kommentar schreiben",
        "commentaire", "commentaires", "commentaires des lecteurs", "laisser un commentaire",
        "comentario", "comentarios", "comentarios de los lectores", "deja un comentario",
    }
)
GOOD_WORDS = frozenset("article content post entry main story body text maintext articlebody".split())
#: What text in a marked element loses, once however many marks it is under.
MARKED = 12.0
#: What kinds and names of elements can add to a block, at most: a long paragraph under a mark that stands stays out.
GAINS = 7.5
#: Characters from which a block counts as a paragraph, whatever its element.
LONG = 80

_ENDS = re.compile(r"</(" + "|".join(sorted(RAW | SILENT)) + r")(?=[\s/>])[^>]*>?", re.IGNORECASE)
_UNQUOTED = re.compile(r"=\s*[^\s\"']+\Z")
_HINTS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_CLOSES = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
}


_SPACES_AND_QUOTES = frozenset(" \t\n\r\f\v\"'")
_NAME = re.compile(r"[^\s/>]*")
_STOP = re.compile(r"[>\"']")


class Tags:
    """The tags and comments of a page from left to right; the time grows with the page's length only.

    A tag is a name behind < or </ and goes on to the next > outside quotes; other things behind <!,
    <? and </ go on to the next >. A < that starts neither is text. What was looked for and not
    found is remembered: a place where a name or a tag ends, and quotes that lead to no end.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.last = html.rfind(">")
        self.next_stop = self.next_end = (0, -1)  # from where the place was looked for, and the place
        self.hopeless: set[int] = set()

    def _stop(self, at: int) -> int:
        """The next > or quote."""
        since, place = self.next_stop
        if not since <= at <= place:
            found = _STOP.search(self.html, at)
            place = found.start() if found else len(self.html)
            self.next_stop = (at, place)
        return place

    def _name_end(self, at: int) -> int:
        since, place = self.next_end
        if not since <= at <= place:
            place = _NAME.match(self.html, at).end()
            self.next_end = (at, place)
        return place

    def _tag_end(self, at: int) -> int:
        """The > that ends the tag of which `at` is past the name, -1 if there is none."""
        html, quotes = self.html, []
        while True:
            stop = self._stop(at)
            if stop < len(html) and html[stop] == ">":
                return stop
            if stop < len(html) and stop not in self.hopeless:
                quotes.append(stop)
                close = html.find(html[stop], stop + 1)
                if close >= 0:
                    at = close + 1
                    continue
            self.hopeless.update(quotes)
            return -1

    def search(self, at: int) -> tuple[int, int, str | None, bool, str] | None:
        """Start, end, name, whether it is an end tag, and what is behind the name; no name for the others."""
        html = self.html
        while (start := html.find("<", at)) >= 0:
            at = start + 1
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(html), None, False, ""
            if start > self.last:
                at = html.find("<!--", at)
                if at < 0:
                    return None
                continue
            sign = html[at]
            first = at + (sign == "/")
            if html[first].isascii() and html[first].isalpha():
                name_end = self._name_end(first)
                end = self._tag_end(name_end)
                if end >= 0:
                    return start, end + 1, html[first:name_end], sign == "/", html[name_end:end]
            if sign in "!?/":
                return start, html.find(">", at) + 1, None, False, ""
        return None


class Element:
    __slots__ = ("name", "parent", "depth", "bias", "last", "gain", "mark", "good", "holder", "held", "in_article")

    def __init__(self, name: str, parent: Element | None, more: str = "") -> None:
        self.name, self.parent, self.bias = name, parent, 0.0
        self.depth = parent.depth + 1 if parent else 0
        self.last = -1
        self.held: Held | None = None
        self.in_article = name == "article" or bool(parent and parent.in_article)
        self.gain, self.mark, self.good = _evidence(name, more, parent) if parent else (0.0, "", False)
        self.good = self.good or bool(parent and parent.good)
        self.holder: Element = self if self.mark or not parent else parent.holder  # nearest with a mark


class Held:
    """What is in an element with a mark; `free` and `good` leave out what is in further ones."""

    __slots__ = ("text", "free", "good", "mains", "articles", "heads")

    def __init__(self) -> None:
        self.text = self.free = self.good = self.mains = self.articles = self.heads = 0

    def add(self, inner: Held) -> None:
        self.text += inner.text
        self.mains += inner.mains
        self.articles += inner.articles
        self.heads += inner.heads


class Block:
    __slots__ = ("text", "links", "parent")

    def __init__(self, text: str, links: int, parent: Element) -> None:
        self.text, self.links, self.parent = text, links, parent

    @property
    def bias(self) -> float:
        return self.parent.bias


def _evidence(name: str, more: str, parent: Element) -> tuple[float, str, bool]:
    """What the element's kind and names say of the text in it: gain, mark and whether it is marked as content.

    The mark is "kind" where the element is boilerplate by its kind, "names" where a form, a word or
    hiding says so, which a wrapper around the whole page may have too.
    """
    gain, mark, good = 0.0, "", False
    if name == "header" and parent.in_article:
        gain -= 1.0
    elif name in NOT_MAIN:
        mark = "names" if name == "form" else "kind"
    elif name in ("article", "main"):
        gain += 3.0
        good = True
    if more and "=" in more:
        words = set()
        for groups in _HINTS.findall(more):
            words.update(w.lower() for w in _WORDS.findall("".join(groups)))
        if words & BAD_WORDS:
            good = False
            if name not in ("body", "html", "article", "main"):
                mark = mark or "names"
        elif words & GOOD_WORDS:
            good = True
        if words & GOOD_WORDS:
            gain += 1.5
        if "hidden" in more.lower() and re.search(r"\bhidden\b|display\s*:\s*none", more, re.IGNORECASE):
            mark = mark or "names"
    return gain, mark, good


def _mark_comments(text: str, heading: Element, before: list[Block]) -> None:
    """Mark a section or division that begins with a heading of readers' comments."""
    holder = heading.parent
    if holder.name not in ("section", "div") or holder.mark:
        return
    if " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) not in COMMENT_HEADINGS:
        return
    inner = before[-1].parent if before else None
    while inner and inner.depth > holder.depth:
        inner = inner.parent
    if inner is not holder:  # nothing in it comes before
        holder.mark = "names"
        holder.holder = heading.holder = holder


def _weigh(elements: list[Element], found: list[Block]) -> None:
    """Set each element's bias: the gains on the way to it, less MARKED if it is under a mark that stands.

    A mark by names says what an element is beside the rest of the page. It does not stand where
    the element holds the page's main, or all its articles and a good part of the text, or nearly
    all paragraph text that is in no other marked element, unless the page has content marked as
    such elsewhere. Elements that hold main, articles, a first heading or most text come first.
    """
    root = elements[0]
    marked = [e for e in elements if e.mark or e is root]
    for element in marked:
        element.held = Held()
    for element in elements:
        held = element.holder.held
        held.mains += element.name == "main"
        held.articles += element.name == "article" and element.good
        held.heads += element.name == "h1"
    for block in found:
        n = len(block.text)
        if block.parent.name in ("p", "blockquote", "pre") or n >= LONG:
            held, plain = block.parent.holder.held, max(0, n - block.links)
            held.text += plain
            held.free += plain
            held.good += plain if block.parent.good else 0
    for element in reversed(marked):
        if element is not root:
            element.parent.holder.held.add(element.held)
    stands = {e: bool(e.mark) for e in marked}
    free, good, articles = root.held.free, root.held.good, root.held.articles
    judged = [e for e in marked if e.mark == "names"]
    judged.sort(key=lambda e: (-(e.held.mains > 0), -(e.held.articles > 0), -(e.held.heads > 0), -e.held.text))
    under = {root: False}
    for element in judged:
        held, above = element.held, element.parent.holder
        if stands[above]:
            continue
        wraps = held.mains > 0
        if not wraps and held.text and good * 10 <= held.text:
            all_articles = held.articles and held.articles == articles
            wraps = 4 * held.text >= held.text + free if all_articles else 3 * held.text > 2 * (held.text + free)
        if wraps:
            stands[element] = False
            free += held.free
            good += held.good
    for element in elements[1:]:
        above = element.parent
        under[element] = under[above] or stands.get(element, False)
        element.gain += above.gain
        element.bias = min(GAINS, element.gain) - (MARKED if under[element] else 0.0)


def _last_value(more: str) -> int:
    """Where the signs without a space or quote at the end begin, or the = before them."""
    at = len(more)
    while at and more[at - 1] not in _SPACES_AND_QUOTES:
        at -= 1
    equals = more.find("=", at)
    if equals >= 0:
        return equals
    before = len(more[:at].rstrip())
    return before - 1 if before and more[before - 1] == "=" else at


def _closed(more: str) -> bool:
    """Whether a tag ends itself; the slash of an unquoted value does not."""
    return more.endswith("/") and not _UNQUOTED.search(more, _last_value(more))


class Silent:
    """The open silent elements and what is open in them, from the outermost."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.counts: Counter[str] = Counter()

    def __bool__(self) -> bool:
        return bool(self.names)

    def add(self, name: str) -> None:
        self.names.append(name)
        self.counts[name] += 1

    def drop(self, *names: str) -> None:
        """Close until none of these is open."""
        while self.names and any([self.counts[n] for n in names]):
            self.counts[self.names.pop()] -= 1

    def clear(self) -> None:
        self.names.clear()
        self.counts.clear()

    def in_head(self) -> bool:
        return len(self.names) == 1 and self.names[0] == "head"

    def foreign(self) -> bool:
        return bool(self.counts["svg"] or self.counts["math"])

    def follow(self, name: str, end: bool, more: str, outside: Counter[str]) -> bool:
        """Take a tag; False if it is outside, where so many elements of each name are open."""
        if end:
            if self.counts[name]:
                while self.names[-1] != name:
                    self.counts[self.names.pop()] -= 1
                self.counts[self.names.pop()] -= 1
                return True
            if not outside[name]:
                return True
            self.clear()  # the parent's end
            return False
        if name == "body" or self.in_head() and name not in IN_HEAD:
            self.clear()
        elif name in BREAKS_OUT and self.foreign() and not any([self.counts[n] for n in TAKES_HTML]):
            self.drop("svg", "math")
        elif name in ("option", "optgroup") and self.names[-1] == "option":
            self.counts[self.names.pop()] -= 1
        elif name in ("button", "select"):
            self.drop(name)
        if self.names and name not in VOID and name != "head" and not _closed(more):
            self.add(name)
        return bool(self.names)


def blocks(html: str) -> list[Block]:
    out: list[Block] = []
    node = Element("", None)
    elements = [node]
    parts: list[str] = []
    links = length = 0
    linked: list[int] = []  # length of text at the start of each open link
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal links, length
        if parts:
            raw = "".join(parts)
            text = " ".join((unescape(raw) if "&" in raw else raw).split())
            if text:
                if node.name in HEADINGS and len(text) < 60:
                    _mark_comments(text, node, out)
                out.append(Block(text, links, node))
            parts.clear()
        links = length = 0
        if linked:
            linked[:] = [0]

    def add(text: str) -> None:
        nonlocal length
        parts.append(text)
        length += len(text)

    def close(element: Element) -> None:
        """Close this element and all that are open in it."""
        nonlocal node
        while True:
            opened[node.name] -= 1
            node, left = node.parent, node
            if left is element:
                return

    ends: dict[str, list[tuple[int, int]]] = {}
    for m in _ENDS.finditer(html):
        ends.setdefault(m[1].lower(), []).append(m.span())
    inside = Silent()
    at = 0
    tags = Tags(html)
    while tag := tags.search(at):
        start, past, name, is_end, more = tag
        if start > at:
            if inside.in_head() and not html[at:start].isspace():
                inside.clear()
            if not inside:
                add(html[at:start])
        at = past
        if name is None:
            continue
        name = name.lower()
        if name in RAW and not is_end and not (inside and inside.foreign() and _closed(more)):
            if not inside and name not in IN_LINE:
                flush()
            found = ends.get(name, ())
            nearest = bisect_left(found, (at, 0))
            if nearest < len(found):
                at = found[nearest][1]
            elif name in ("script", "style"):
                at = len(html)
            continue
        if inside and inside.follow(name, is_end, more, opened):
            continue
        if name in SILENT:
            if is_end:
                continue
            if name not in IN_LINE:
                flush()
            # one that is never closed holds nothing; the four named need no end tag
            closes = bool(ends.get(name)) and ends[name][-1][0] >= at
            if not _closed(more) and (closes or name in ("head", "option", "svg", "math")):
                inside.add(name)
            continue
        if name in INLINE:
            if name == "br":
                add(" ")
            elif name == "a":
                if linked:
                    links += length - linked.pop()
                if not is_end:
                    linked.append(length)
            continue
        if linked:
            links += length - linked[-1]
        flush()
        if is_end:
            if opened[name]:
                walk = node
                while walk.name != name:
                    walk = walk.parent
                close(walk)
            continue
        if node.name == "p" or node.name in HEADINGS:
            close(node)
        if name in _CLOSES:
            same, until = _CLOSES[name]
            closing = None
            walk = node if any([opened[n] for n in same.split()]) else elements[0]
            while walk.parent and walk.name not in until:
                if walk.name in same.split():
                    closing = walk
                    if name != "tr":
                        break
                walk = walk.parent
            if closing:
                close(closing)
        if name not in VOID and not more.endswith("/"):
            node = Element(name, node, more)
            opened[name] += 1
            elements.append(node)
    if at < len(html) and (not inside or inside.in_head()):
        add(html[at:])
    flush()
    _weigh(elements, out)
    return out


def score(block: Block) -> float:
    """Positive for content: the difference of the two costs of a block."""
    text, name = block.text, block.parent.name
    n = len(text)
    out = block.bias - 0.6
    out += min(n, 400) / 160
    if name in ("p", "blockquote", "pre"):
        out += 1.0
    elif name in HEADINGS:
        out += 0.6
    elif name == "li":
        out -= 0.4
    if text[-1] in ".!?…。":
        out += 0.4
    out -= 4.0 * min(1.0, block.links / max(1, n))
    if "©" in text[:80] or "all rights reserved" in text.lower()[-120:]:
        out -= 4.0
    return out


def smoothness(a: Block, b: Block) -> float:
    """Cost of telling two neighbours apart."""
    if a.parent is b.parent:
        return 1.5
    x, y = a.parent, b.parent
    while x is not y:
        if x.depth >= y.depth:
            x = x.parent
        else:
            y = y.parent
    apart = a.parent.depth + b.parent.depth - 2 * x.depth
    return 1.5 / (1 + 0.5 * apart)


def source_side(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The nodes on the source's side of a minimum cut.

    gains: capacity from the source if positive, to the sink if negative. Flow is sent from each
    node with capacity left along shortest paths; what cannot reach the sink any more never will,
    so each such part is searched once.
    """
    n = len(gains)
    left = list(gains)
    to: list[list[int]] = [[] for _ in range(n)]
    ends: list[int] = []
    room: list[float] = []
    for a, b, capacity in edges:
        to[a].append(len(ends))
        to[b].append(len(ends) + 1)
        ends += (b, a)
        room += (capacity, capacity)
    stuck = [False] * n
    for start in range(n):
        while left[start] > 1e-9 and not stuck[start]:
            came = {start: -1}
            queue = deque([start])
            hit = -1
            while queue and hit < 0:
                node = queue.popleft()
                for edge in to[node]:
                    other = ends[edge]
                    if room[edge] > 1e-9 and other not in came and not stuck[other]:
                        came[other] = edge
                        if left[other] < -1e-9:
                            hit = other
                            break
                        queue.append(other)
            if hit < 0:
                for node in came:
                    stuck[node] = True
                break
            flow, node = min(left[start], -left[hit]), hit
            while node != start:
                flow = min(flow, room[came[node]])
                node = ends[came[node] ^ 1]
            node = hit
            while node != start:
                edge = came[node]
                room[edge] -= flow
                room[edge ^ 1] += flow
                node = ends[edge ^ 1]
            left[start] -= flow
            left[hit] += flow
    return stuck


def labelled(html: str | None) -> list[tuple[Block, bool]]:
    """Blocks of a page in order, each with whether it is main text."""
    found = blocks(html or "")
    if not found:
        return []
    gains = [score(b) for b in found]
    edges = [(i - 1, i, smoothness(found[i - 1], found[i])) for i in range(1, len(found))]
    for i, block in enumerate(found):
        holder = block.parent.parent or block.parent
        if 0 <= holder.last < i - 1:
            edges.append((holder.last, i, 0.75))
        holder.last = i
    return list(zip(found, source_side(gains, edges)))


def main_text(html: str | None) -> str:
    return "\n\n".join(block.text for block, is_main in labelled(html) if is_main)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of `pages` but the HTML, and `text` and `n_chars`, its code points.

    A null or empty page has the empty text. Character references are decoded, white space in
    a block is one space, blocks are trimmed and joined by an empty line in page order. Columns
    of `pages` with these names are replaced. An empty table gives no rows.
    """
    ship(pages.sparkSession)

    @F.arrow_udf("string")
    def of_page(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch]
            yield pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.string())

    own = [quoted(c) for c in pages.columns if c not in (html_col, "text", "n_chars")]
    texts = pages.select(*own, of_page(quoted(html_col).cast("string")).alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
