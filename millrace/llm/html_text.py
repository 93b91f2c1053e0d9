"""Main text of web pages by line-block distribution: lengths over sliding windows of lines, from surge to dive."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import pieces

#: Elements whose content is never page text: such as hold plain characters up to their own end, and such as hold markup.
CHARACTERS = frozenset("script style textarea title iframe".split())
MUTE = frozenset("noscript template svg object canvas math select button".split())
#: Of these such as never stand in one another: where one begins, the one before has ended.
ALONE = frozenset("title textarea iframe button select".split())
#: Elements that stand around an article.
ASIDE = frozenset("nav footer aside form menu dialog head".split())
ARTICLE = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output q rp rt "
    "ruby s samp small source span strike strong sub sup time tt u var wbr link meta base param track col embed area".split()
)
VOID = frozenset("br img input source wbr link meta base param track col embed area hr".split())
#: Words in class or id that name what is not the article; ``comment`` names a reader's.
SIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|menu|nav\w*|breadcrumbs?|sidebar|side|footer|header|"
    r"masthead|cookies?|consent|notices?|alert|popup|modal|newsletter|subscri\w+|signup|login|social|share|sharing|"
    r"related|recommend\w*|teasers?|widget|toolbar|pagination|pager|copyright|comments?|disqus|repl(?:y|ies)|respond|"
    r"hidden|skip|search|form)(?=$|[\s_-])",
    re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
       | <(/?)([a-z][^\s/>]*+)((?:[^>"']*+(?:"[^"]*"|'[^']*'))*+[^>"']*+)(?:>|\Z)
       | </?[a-z][^>]*+(?:>|\Z)
       | <[!?][^>]*+(?:>|\Z)""",
    re.I | re.S | re.X,
)

#: What a class or id says of the page's state rather than of the element: ``has-sidebar``, ``main-nav-open``.
STATE = re.compile(r"(?:^|[\s_-])(?:has|have|no|not|with|without)[_-]\S*|(?<!\S)\S*[_-](?:open|opened|closed|enabled|disabled)(?!\S)", re.I)
#: Side words that may stand for text of readers or of other pages, and so hold articles of their own.
OTHERS = re.compile(r"comments?|disqus|repl(?:y|ies)|respond|related|recommend|teasers?", re.I)
#: Side words that also name wrappers around the whole page.
LAYOUT = re.compile(r"side|nav|menu|header|footer|masthead|banner|toolbar|widget|search|form", re.I)

#: Of these such as also occur in names of ordinary blocks.
VAGUE = re.compile(r"[\s_-]*(?:side|nav\w*|menu|header|toolbar|widget|search|form)[\s_-]*", re.I)

WINDOW, SURGE = 3, 80
#: A character in a marked article counts as so many outside when one is chosen against the other.
MARK = 2


class Node:
    """An element: what it says of itself, and what the page's text makes of it."""

    __slots__ = ("above", "tag", "aside", "named", "article", "main", "linked")

    def __init__(self, above: int, tag: str, aside: bool = False, named: str = "", article: bool = False, main: bool = False) -> None:
        self.above, self.tag, self.aside, self.named, self.article, self.main = above, tag, aside, named, article, main
        self.linked = 0  # characters of its own lines that are in links


def _kind(tag: str, attributes: str, inside: bool) -> tuple[bool, str, bool, bool]:
    """Whether an element is set aside, the class or id that would do so, whether it is an article, and the main one."""
    aside, named, article, main = tag in ASIDE or (tag == "header" and not inside), "", tag in ARTICLE, tag == "main"
    if attributes and not attributes.isspace():
        for name, *values in ATTRIBUTE.findall(attributes):
            value, name = "".join(values), name.lower()
            if name in ("class", "id"):
                if tag not in ("body", "html") and SIDE.search(value) and SIDE.search(own := STATE.sub(" ", value)):
                    named += " " + " ".join(found[0] for found in SIDE.finditer(own))
            elif name == "role":
                aside |= value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert")
                article |= value.lower() in ("main", "article")
                main |= value.lower() == "main"
            elif name == "itemprop":
                article |= value == "articleBody"
            elif name == "style":
                aside |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            else:
                aside |= value.lower() != "false"
    return aside, named, article, main


class Tags:
    """The next tag of a name behind a place. Places go up, so a page is gone through once for each name."""

    def __init__(self, page: str) -> None:
        self.page, self.found = page, {}

    def after(self, sign: str, tag: str, place: int) -> re.Match | None:
        """The next opening (``sign`` is ``<``) or closing (``</``) tag."""
        since, match = self.found.get((sign, tag), (len(self.page) + 1, None))
        if since > place or (match is not None and match.start() < place):
            match = re.compile(rf"{sign}{tag}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).search(self.page, place)
            self.found[(sign, tag)] = (place, match)
        return match

    def end(self, tag: str, place: int) -> re.Match | None:
        """The closing tag of an element that begins here; none if another begins before it and they cannot nest."""
        close = self.after("</", tag, place)
        if close is not None and tag in ALONE:
            again = self.after("<", tag, place)
            if again is not None and again.start() < close.start():
                return None
        return close


def parsed(page: str) -> tuple[list[tuple[str, int]], list[Node]]:
    """The page's lines with the element each stands in, and all elements, outer before inner; the first is the page.

    Blocks and line breaks end a line. What is never text ends with its element: at its own end, at ``/>`` where it
    is drawing or formula, or at its parent's end; an element of that kind that the page never ends holds nothing,
    only scripts and styles then go on to the page's end, as in browsers.
    """
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    nodes = [Node(-1, "")]
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    counts: Counter[str] = Counter()  # open elements by name
    tags = Tags(page)
    linked = 0  # characters of the line that are in links
    in_link = False

    def end() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, stack[-1][1]))
            nodes[stack[-1][1]].linked += min(linked, len(text))
        linked = 0

    def close(upto: int) -> None:
        for tag, *_ in stack[upto:]:
            counts[tag] -= 1
        del stack[upto:]

    def push(node: Node, tag: str, inside: bool) -> None:
        nodes.append(node)
        stack.append((tag, len(nodes) - 1, inside))
        counts[tag] += 1

    here = place = 0
    muted, within = "", Counter()
    while token := TOKEN.search(page, place):
        if token.start() > here and not muted:
            parts.append(page[here : token.start()])
            linked += (token.start() - here) * in_link
        here = place = token.end()
        shut, tag, attributes = token[1], (token[2] or "").lower(), token[3] or ""
        if not tag:
            continue
        if tag in CHARACTERS and not shut:
            close_tag = tags.end(tag, here)
            if close_tag is not None:
                here = place = close_tag.end()
            elif tag in ("script", "style"):
                here = place = len(page)
            continue
        empty = attributes.endswith("/")
        if muted:
            if not shut:
                if tag not in VOID and not empty:
                    within[tag] += 1
                continue
            if within[tag] > 0:
                within[tag] -= 1
                if tag == muted and not within[tag]:
                    muted = ""
                continue
            if not counts[tag]:
                continue
            muted = ""  # the parent ends
        if tag in MUTE:
            if not shut and not (empty and tag in ("svg", "math")) and tags.end(tag, here) is not None:
                muted, within = tag, Counter({tag: 1})
            continue
        if tag == "br":
            parts.append(" ")
        if tag == "a":
            in_link = not shut
        if tag in INLINE and not shut and not attributes:
            continue
        if shut:
            if tag in INLINE:
                # Only inline elements that are set aside are on the stack.
                if stack[-1][0] == tag:
                    end()
                    close(len(stack) - 1)
                continue
            end()
            in_link = False
            if counts[tag] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag))
            continue
        aside, named, article, main = _kind(tag, attributes, stack[-1][2])
        if tag in INLINE:
            if (aside or named) and tag not in VOID and not empty:
                end()
                push(Node(stack[-1][1], tag, aside, named), tag, stack[-1][2])
            continue
        end()
        while stack[-1][0] in ("p", *INLINE) and len(stack) > 1 or stack[-1][0] == tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            close(len(stack) - 1)
        if tag not in VOID and not (empty and tag not in ("p", "div")):
            push(Node(stack[-1][1], tag, aside, named, article, main), tag, stack[-1][2] or (article and not aside))
    if here < len(page) and not muted:
        parts.append(page[here:])
    end()
    return out, nodes


def states(found: list[tuple[str, int]], nodes: list[Node]) -> tuple[list[bool], list[bool]]:
    """For each element whether it is set aside, and whether it stands in an article.

    A class or id sets no element aside that holds the main element, an article of at least half the weight of all text
    not set aside, or, if its word also names layout, the page's bulk with a line long enough for a surge. Within an
    article words that also name layout set aside only what looks like it: short lines, or a third of it links.
    """
    own, longest, linked = [0] * len(nodes), [0] * len(nodes), [n.linked for n in nodes]
    within = [False] * len(nodes)
    for i in range(1, len(nodes)):
        within[i] = within[nodes[i].above] or nodes[nodes[i].above].article
    for text, node in found:
        own[node] += len(text)
        longest[node] = max(longest[node], len(text))
    aside = [n.aside or bool(n.named) for n in nodes]
    if any(n.named for n in nodes):
        below = aside.copy()
        for i in range(1, len(nodes)):
            below[i] |= below[nodes[i].above]
        outside = sum(size for size, off in zip(own, below) if not off)
        marked, main = [0] * len(nodes), [False] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            n = nodes[i]
            if n.article and not n.aside and not OTHERS.search(n.named):
                marked[i] = own[i]
                main[i] |= n.main
            if n.named and not n.aside:
                whole = bool(LAYOUT.search(n.named)) and own[i] >= 4 * outside and longest[i] >= SURGE
                held = marked[i] > 0 and MARK * marked[i] >= outside
                prose = within[i] and longest[i] >= SURGE and 3 * linked[i] < own[i] and all(map(VAGUE.fullmatch, n.named.split()))
                aside[i] = not (main[i] or prose or not OTHERS.search(n.named) and (held or whole))
            if not aside[i]:
                own[n.above] += own[i]
                linked[n.above] += linked[i]
                marked[n.above] += marked[i]
                longest[n.above] = max(longest[n.above], longest[i])
                main[n.above] |= main[i]
    article = [False] * len(nodes)
    for i in range(1, len(nodes)):
        aside[i] |= aside[nodes[i].above]
        article[i] = article[nodes[i].above] or (nodes[i].article and not aside[i])
    return aside, article


def _common(nodes: list[Node], one: int, two: int) -> int:
    """The innermost element around both."""
    while one != two:
        if one > two:
            one = nodes[one].above
        else:
            two = nodes[two].above
    return one


def _beside(nodes: list[Node], article: list[bool], one: int, two: int) -> bool:
    """Whether what stands between two lines stands inside a text: in an article, or among the blocks of one element."""
    a, b, below = one, two, {one: one, two: two}
    while a != b:
        if a > b:
            below[one], a = a, nodes[a].above
        else:
            below[two], b = b, nodes[b].above
    return article[a] or all(line == near or nodes[near].article for line, near in below.items())


def main_lines(found: list[tuple[str, int]], nodes: list[Node], window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines between surge and dive of the window sums.

    Lines set aside weigh nothing. They, and an article's begin and end, part what stands before and behind by empty
    lines as wide as the window. A run begins at the first window that holds text and ends where the windows fall to
    nothing; it surges if a window reaches ``surge``. What is set aside inside a text, though, is no dive: the runs
    around it are one. If no surging run outside weighs more than ``MARK`` times the marked articles, these are the
    main text, all their runs; else it is all runs that surge, with the weak ones between them in the same element, or,
    if none surges, the heaviest one.
    """
    aside, article = states(found, nodes)
    kept = [i for i, (_, node) in enumerate(found) if not aside[node]]
    if not kept:
        return []
    of = [found[i][1] for i in kept]
    marked = np.array([article[node] for node in of])
    change = np.concatenate(([False], marked[1:] != marked[:-1]))
    place = np.arange(len(kept)) + window * np.cumsum((np.diff(kept, prepend=kept[0] - 1) > 1) | change)
    weights = np.zeros(place[-1] + window, np.int64)
    weights[place] = [len(found[i][0]) for i in kept]
    sums = np.convolve(weights, np.ones(window, np.int64))[window - 1 :]
    runs: list[tuple[int, int]] = []
    edges = np.flatnonzero(np.diff(np.concatenate(([False], sums > 0, [False])).astype(np.int8)))
    for begin, behind in np.searchsorted(place, edges).reshape(-1, 2).tolist():
        if runs and not change[begin] and _beside(nodes, article, of[begin - 1], of[begin]):
            begin = runs.pop()[0]
        runs.append((begin, behind))
    size, sums = weights[place], sums[place]

    def weight(run: tuple[int, int]) -> int:
        return int(size[slice(*run)].sum())

    if marked.any():
        rivals = [weight(r) for r in runs if not marked[r[0]] and sums[slice(*r)].max() >= surge]
        if max(rivals, default=0) <= MARK * size[marked].sum():
            return [found[i][0] for i, own in zip(kept, marked) if own]
        joined = runs[:1]
        for begin, behind in runs[1:]:
            if change[begin] and _beside(nodes, article, of[begin - 1], of[begin]):
                begin = joined.pop()[0]
            joined.append((begin, behind))
        runs = joined
    strong = [r for r in runs if sums[slice(*r)].max() >= surge] or [max(runs, key=weight)]
    # A weak run between two strong ones, in an element that holds both and is not the whole page, is part of the text.
    for one, two in list(zip(strong, strong[1:])):
        around = _common(nodes, of[one[1] - 1], of[two[0]])
        if nodes[around].tag not in ("", "html", "body"):
            between = (r for r in runs if one[1] <= r[0] and r[1] <= two[0])
            strong += [r for r in between if all(_common(nodes, around, node) == around for node in of[slice(*r)])]
    strong.sort()
    return [found[i][0] for begin, behind in strong for i in kept[begin:behind]]


def extract(page: str) -> str:
    """The main text: its blocks in page order, two line feeds between them."""
    return "\n\n".join(main_lines(*parsed(page)))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars. A null or empty html, or one without main text, gives "".

    Repeated rows are extracted each; nothing moves between tasks. Other columns are left aside.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "html"):
                texts = [extract(page or "") for page in part.column("html").to_pylist()]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
                columns.append(pa.array([len(t) for t in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
