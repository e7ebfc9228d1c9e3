"""Main-text extraction from HTML: blocks labelled by a minimum cut."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>""",
    re.S,
)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video select textarea title datalist".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
BOILER_TAGS = frozenset("nav aside footer menu dialog button head".split())
#: Furniture too, but they also wrap whole pages: an article inside is one.
WRAPPER_TAGS = frozenset("form fieldset header".split())
MAIN_TAGS = frozenset(["article", "main"])
#: Words in class, id or role that name page furniture, and those that name the article.
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner sponsor sponsored promo promotion nav navbar navigation menu menubar sidebar side aside "
    "footer foot header head masthead topbar toolbar bottombar breadcrumb breadcrumbs comment comments commentlist disqus respond reply replies discussion feedback "
    "cookie cookies consent gdpr notice notices alert alerts notification popup modal overlay newsletter subscribe subscription signup signin login register form search "
    "searchbox related recommended recommendations recirc share sharing social widget widgets pagination pager skip copyright legal disclaimer complementary contentinfo tooltip".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus respond reply replies discussion feedback".split())
#: Words that say nothing beside a furniture word.
PLAIN_NAMES = frozenset("area list section wrap wrapper container box block thread top bottom left right main inner outer".split())
MAIN_NAMES = frozenset("article content main post entry story body text".split())
#: A start tag of the key ends an open element of the values, up to the scope.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("article aside blockquote body div dl fieldset figure footer form header html main menu nav ol section table td th ul".split())
_KEEP_OPEN = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]), "tr": frozenset(["table"]), "td": frozenset(["tr", "table"]), "th": frozenset(["tr", "table"]), "option": frozenset()}

#: Terminal capacities. A block in a furniture or article element is all but decided; others lean by their text.
SURE, LEAN = 4000, 60
#: What furniture names cost a block: on elements named by nothing else, on others, inside an article, on those that hold most of the
#: page's text, on text elements and headings (inline tags: nothing); and what an article's block with such a name has for it.
ONLY, NAMED, INSIDE, WRAPPER, SMALL, ARTICLE = 400, 160, 90, 20, 30, 100
SECTIONS = frozenset("article body center details div dl html ol section td ul".split())
#: Smoothness capacities: neighbours in page order, more if they have the same parent, and next siblings in the tree.
NEXT, SAME_PARENT, SIBLING = 15, 30, 25


def _names(attrs: str) -> tuple[set[str], bool]:
    """Words of class, id and role in lower case, and whether the element is hidden."""
    names: set[str] = set()
    hidden = False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            names.update(x.lower() for x in _NAME.findall(value))
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return names, hidden


def _zone(zone: int, tag: str, attrs: str) -> tuple[int, set[str], bool]:
    """The zone: -2 furniture with everything inside, -1 furniture but for an article inside, 1 article, 0 unknown. Then the
    furniture words that name the element, and whether nothing else names it."""
    if zone < -1 or tag in BOILER_TAGS:
        return -2, set(), False
    names, hidden = _names(attrs) if attrs and "=" in attrs or " hidden" in attrs else (set(), False)
    if hidden:
        return -2, set(), False
    bad, good = names & BOILER_NAMES, names & MAIN_NAMES
    if good and bad <= {"header", "head", "side"} or tag in ("body", "html"):
        bad = set()
    only = bool(bad) and names <= BOILER_NAMES | PLAIN_NAMES
    if tag in MAIN_TAGS or "main" in names and not bad:
        return 1, bad, only
    if zone < 0 or tag in WRAPPER_TAGS and (tag != "header" or zone <= 0 and not good):
        return -1, set(), False
    if good and not bad and tag in ("div", "section", "td"):
        return 1, bad, only
    return zone, bad, only


Block = tuple[str, int, int, int, tuple[int, int]]


def blocks(page: str) -> list[Block]:
    """(text, zone, parent element, characters inside links, (inside an article, what names cost)) of the text blocks in page order."""
    out: list[tuple[str, int, int, int, tuple[int, ...]]] = []
    marks: list[tuple[int, bool, bool]] = []  # what an element's furniture names cost, whether nothing else names it, whether they say comments
    stack: list[tuple[str, int, int, tuple[int, ...]]] = [("", 0, 0, ())]  # tag, zone, number of its nearest block element, marks
    buf: list[str] = []
    serial = linked = links = 0

    def flush() -> None:
        nonlocal linked
        if buf:
            text = "".join(buf)
            buf.clear()
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                out.append((text, stack[-1][1], stack[-1][2], linked, stack[-1][3]))
        linked = 0

    def entered(tag: str, attrs: str) -> tuple[int, tuple[int, ...]]:
        zone, bad, only = _zone(stack[-1][1], tag, attrs)
        own = stack[-1][3]
        if tag in MAIN_TAGS or zone > 0 >= stack[-1][1]:
            # an article is no furniture because of what is around it, but for comments
            own = tuple(k for k in own if marks[k][2])
        if bad and tag in BLOCK:
            cost = SMALL if tag not in SECTIONS else INSIDE if stack[-1][1] > 0 else NAMED
            marks.append((ONLY if only and tag in SECTIONS else cost, only, bool(bad & COMMENT_NAMES)))
            own += (len(marks) - 1,)
        return zone, own

    at, n = 0, len(page)
    find = _TOKEN.search
    while at < n:
        m = find(page, at)
        stop = m.start() if m else n
        if stop > at:
            piece = page[at:stop]
            buf.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m[0].startswith("<![CDATA["):
                buf.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        attrs = (m["attrs"] or m["attrs2"] or "") if not (m["end"] or m["end2"]) else ""
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    break
                if stack[i][0] in SCOPE and tag not in BLOCK:
                    i = 0
                    break
            else:
                i = 0
            if i:
                if tag in BLOCK or any(s[0] in BLOCK or s[1] != stack[i - 1][1] or s[3] != stack[i - 1][3] for s in stack[i:]):
                    flush()
                links -= sum(s[0] == "a" for s in stack[i:])
                del stack[i:]
            elif tag in BLOCK:
                flush()
            continue
        if tag in SKIPPED and not attrs.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else (n if tag in ("script", "style", "textarea", "title") else at)
            buf.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag != "wbr":
                buf.append(" ")
            continue
        if tag in BLOCK:
            flush()
            ends = CLOSES.get(tag, ())
            keep = _KEEP_OPEN.get(tag, SCOPE)
            cut = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in ends or stack[i][0] == "p":
                    cut = i
                if stack[i][0] in keep and stack[i][0] not in ends:
                    break
            if cut:
                links -= sum(s[0] == "a" for s in stack[cut:])
                del stack[cut:]
            zone, own = entered(tag, attrs)
            serial += 1
            stack.append((tag, zone, serial, own))
        else:
            zone, own = entered(tag, attrs)
            if zone != stack[-1][1] or own != stack[-1][3]:
                flush()
            links += tag == "a"
            stack.append((tag, zone, stack[-1][2], own))
        if attrs.endswith("/") and tag not in BLOCK:
            links -= tag == "a"
            stack.pop()
    flush()
    return _named(out, marks)


def _named(found: list[tuple[str, int, int, int, tuple[int, ...]]], marks: list[tuple[int, bool, bool]]) -> list[Block]:
    """Blocks with the cost of the names around them, less for elements that hold most of the page's text."""
    chars = [0] * len(marks)
    for b in found:
        for k in b[4]:
            chars[k] += len(b[0])
    half = sum(len(b[0]) for b in found) / 2
    cost = [c if only and comments else min(c, 3 * WRAPPER if only else WRAPPER) if n > half else c for (c, only, comments), n in zip(marks, chars)]
    out = []
    for text, zone, parent, linked, own in found:
        if own and zone >= 0:
            inside = zone > 0 and not any(marks[k][2] and cost[k] > INSIDE for k in own)
            out.append((text, 0, parent, linked, (int(inside), max(cost[k] for k in own))))
        else:
            out.append((text, zone, parent, linked, (0, 0)))
    return out



def _lean(text: str, linked: int) -> int:
    """The classifier for blocks outside any named part: long text with sentence ends and few links leans to content."""
    words = text.count(" ") + 1
    density = min(1.0, linked / max(1, len(text)))
    score = min(words, 40) * 4 - 30 + 25 * (text[-1] in ".!?…\"'”»:;") - round(200 * density)
    if text[:1] == "©" or text.lower().startswith(("copyright", "all rights reserved")):
        score -= 150
    return max(-LEAN * 3, min(LEAN * 3, score))


def costs(found: list[Block]) -> list[int]:
    """Per block: over 0 what it costs to call it boilerplate, under 0 what it costs to call it content."""
    has_main = any(z > 0 or inside for _, z, _, _, (inside, _) in found)
    outside = 2 * LEAN if has_main else 0
    return [SURE * (1 if z > 0 else -1) if z else _lean(t, linked) + (ARTICLE if inside else -outside) - named for t, z, _, linked, (inside, named) in found]


def min_cut(cost: list[int], edges: dict[int, dict[int, int]]) -> list[bool]:
    """Content side of the minimum cut: max-flow by shortest augmenting paths. Each block's terminal capacity is its
    cost; ``edges`` are symmetric smoothness capacities."""
    n = len(cost)
    rest = list(cost)  # over 0: left from the source; under 0: left to the sink
    flow = {i: dict(e) for i, e in edges.items()}
    while True:
        came = {i: -1 for i in range(n) if rest[i] > 0}
        todo = deque(came)
        end = -1
        while todo and end < 0:
            i = todo.popleft()
            for j, c in flow.get(i, {}).items():
                if c > 0 and j not in came:
                    came[j] = i
                    if rest[j] < 0:
                        end = j
                        break
                    todo.append(j)
        if end < 0:
            # what the source still reaches is content; ties (nothing left either way) go with it only if reached
            return [i in came for i in range(n)]
        path = [end]
        while came[path[-1]] >= 0:
            path.append(came[path[-1]])
        push = min(-rest[end], rest[path[-1]], *(flow[b][a] for a, b in zip(path, path[1:])))
        rest[end] += push
        rest[path[-1]] -= push
        for a, b in zip(path, path[1:]):
            flow[b][a] -= push
            flow[a][b] = flow[a].get(b, 0) + push


def label(found: list[Block]) -> list[bool]:
    """True for content. Runs of blocks with the same sure label are one node, so the graph stays small on long pages."""
    cost = costs(found)
    node: list[int] = []
    total: list[int] = []
    sure = 0
    for c, (_, zone, _, _, _) in zip(cost, found):
        if zone and zone == sure:
            total[-1] += c
        else:
            total.append(c)
            sure = zone
        node.append(len(total) - 1)
    edges: dict[int, dict[int, int]] = {}

    def join(a: int, b: int, c: int) -> None:
        if a != b:
            for x, y in ((a, b), (b, a)):
                e = edges.setdefault(x, {})
                e[y] = e.get(y, 0) + c

    last: dict[int, int] = {}
    for i in range(len(found)):
        parent = found[i][2]
        if i:
            join(node[i - 1], node[i], NEXT + SAME_PARENT * (found[i - 1][2] == parent))
        if parent in last:
            join(last[parent], node[i], SIBLING)
        last[parent] = node[i]
    side = min_cut(total, edges)
    return [side[k] for k in node]


def main_text(page: str | None) -> str:
    """Text of the content blocks; where the cut finds none, of all blocks outside furniture elements."""
    found = blocks(page or "")
    if not found:
        return ""
    side = label(found)
    if not any(side):
        side = [b[1] >= 0 for b in found]
    return "\n".join(b[0] for b, keep in zip(found, side) if keep)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points), a row per row of ``pages`` (page_id, url, html).

    Each page is read whole in its task, cut into blocks at block elements, and the blocks are labelled by a minimum cut: the
    classifier's costs are terminal capacities, page order and nearness in the tree are smoothness capacities. Kept blocks: character
    references decoded, white space to one space, trimmed, joined by one line end. Null html: empty
    text. Null ids or urls and repeated rows stay as they are. Extra columns are left out. Empty table: no rows.
    """

    @F.pandas_udf("string")
    def text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in parts:
            yield p.map(main_text, na_action=None)

    return pages.select("page_id", "url", text(F.coalesce("html", F.lit(""))).alias("text")).select("*", F.length("text").cast("long").alias("n_chars"))
