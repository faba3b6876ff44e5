"""Main text of web pages by composite text density.

A page becomes a tree of its elements. Every node has the characters C and tags T below it, and those inside links,
LC and LT. Its composite density is

    C / T * log(C * T / (LC * LT)) / log(log(1 + C * LC / (C - LC) + C of the page * LC / the page's C + e))

so text in few tags weighs much and text in links little. The density sum of a node adds up the densities of its
children and, for text of its own, that share of its own density. The threshold is the smallest density on the path
from the body to the node of the largest sum. From the top down, each node that reaches it marks the node of the
largest sum anywhere below as main text, so a text in several places is found in all of them. Where `article` and
`main` hold half of the text, the selection is made among them and the sections beside them, by the same threshold.

Navigation, footers and hidden parts are left out of the tree's sums. Class names and ids of menus, comments, adverts
are evidence only: a whole name or its leading part leaves an element out too, unless it holds an h1, a main, an article
among the longest of the page or most of the page's text (forms likewise). The last part of a name (`user-comments`)
leaves an element out of the text if its density is below the threshold; states and topics (`has-sidebar`,
`category-legal`) say nothing.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from scoreloom.llm.common import sliced

# Element names and their roles in HTML.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
#: Elements without main text that end with their end tag; without one ahead the start tag is noise.
EMBEDDED = frozenset("template svg math object select canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
WALLS = BLOCK | EMBEDDED  # a start tag inside them ends no paragraph around them
HEAD = frozenset("head title meta link base style script".split())
NOT_TEXT = frozenset("nav footer aside form button dialog menu fieldset head label input datalist output progress meter map".split())
ENDS_P = BLOCK - frozenset("br button body html".split())
#: start tag -> open elements that it ends, up to the nearest of the boundaries.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
MARKS = (
    r"(?:ads?|adv|advert\w*|adsense|adslot|banner\w*|sponsor\w*|promo\w*|menu\w*|nav|navbar|navigation|breadcrumbs?|sidebar\w*|side|aside|widgets?"
    r"|footer\w*|foot|masthead|topbar|toolbar|header|site-header|page-header|cookie\w*|consent|gdpr|notice\w*|alert\w*|popup\w*|modal\w*|overlay|newsletter\w*|subscri\w*"
    r"|signup|login|social\w*|share\w*|sharing|related\w*|recommend\w*|comment\w*|disqus\w*|replies|reply|respond|discussion|pagination|pager|copyright"
    r"|legal|disclaimer|adblock|adbox|adunit|adwrap\w*|search\w*|skip-?link|sr-only|hidden|tags|tagcloud|trending|popular|most-read|outbrain|taboola)"
)
OTHER_MARKS = r"(?:comment\w*|repl(?:y|ies)|related\w*|promo\w*|ads?|advert\w*|sponsor\w*|teaser\w*|recommend\w*)"
#: First parts of names that tell a state, a layout or a topic of an element, not what it is.
STATE = r"(?:has|have|no|not|non|with|without|is|in|on|js|show|hide|category|cat|tag|topic|type|format|layout|template|single|page-with)[_-]"
MARKED, LAST = re.compile(rf"{MARKS}(?:$|[_-])", re.I), re.compile(rf"(?!{STATE}).*[_-]{MARKS}$", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Marks of headers, which may hold a title inside a main part, and marks that an article of its own has.
TITLE = re.compile(r"(?:.*[_-])?(?:header|masthead)(?:$|[_-])", re.I)
OTHER, LAST_OTHER = re.compile(rf"{OTHER_MARKS}(?:$|[_-])", re.I), re.compile(rf"(?!{STATE}).*[_-]{OTHER_MARKS}$", re.I)
MAIN = frozenset("article main".split())
PARTS = frozenset("article main section".split())
PEER = 0.5  # density of a part beside a part of its kind that leads to the densest node, relative to that part's
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
WITH_MAIN = frozenset("h1 h2 h3 h4 h5 h6 hgroup header p br hr figure time".split())
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a string only behind `=`; anywhere else it is a character like any other
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_SPACE = re.compile(r"[\s\xa0]+")


#: What an element's names say against it: nothing, doubt (their last parts), a firm mark, or that it is no text at all.
NONE, DOUBT, FIRM, NEVER = range(4)


class Node:
    """An element; parts are texts and child elements in page order."""

    __slots__ = ("tag", "parts", "skip", "link", "chars", "tags", "link_chars", "link_tags", "density", "total", "peak", "parent", "mark", "depth")

    def __init__(self, tag: str, parent: Node | None, mark: int):
        self.tag, self.parent, self.mark = tag, parent, mark
        self.depth = parent.depth + 1 if parent else 0
        self.skip = mark >= FIRM
        self.link = tag == "a"
        self.parts: list = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.peak = self  # node of the largest density sum of the subtree


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _marked(tag: str, raw: str, in_main: bool) -> int:
    """How far an element is marked as something other than main text; `in_main` tells that a main part is open."""
    if tag in EMBEDDED:
        return NEVER
    if tag == "form":
        return FIRM
    if tag in NOT_TEXT:
        return NEVER
    if tag == "header":  # that of an article may hold its title
        return NONE if in_main else NEVER
    if not raw.strip() or tag in ("body", "html", "main", "h1"):
        return NONE
    at = _attributes(raw)
    names = [x for k in ("class", "id") for x in at.get(k, "").split()]
    if tag == "article":
        return FIRM if any(OTHER.match(x) for x in names) else DOUBT if any(LAST_OTHER.match(x) for x in names) else NONE
    if "hidden" in at or at.get("aria-hidden", "").lower() == "true" or at.get("role", "").lower() in ROLES:
        return NEVER
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", ""), re.I):
        return NEVER
    if any(map(TITLE.match, names)) and in_main:
        names = [x for x in names if not TITLE.match(x)]
    return FIRM if any(map(MARKED.match, names)) else DOUBT if any(map(LAST.match, names)) else NONE


def _acquit(root: Node) -> None:
    """Take the marks from elements that hold an h1, the main part or most of the text of a page."""
    nodes, todo = [], [root]
    while todo:
        n = todo.pop()
        nodes.append(n)
        todo += [c for c in n.parts if isinstance(c, Node) and c.mark != NEVER]
    if all(n.mark == NONE for n in nodes):
        return
    chars: dict[Node, int] = {}
    heads: set[Node] = set()
    for n in reversed(nodes):
        below = [c for c in n.parts if isinstance(c, Node) and c.mark != NEVER]
        # text of links is no sign of a main part
        chars[n] = 0 if n.link else sum(len(x) - x.count(" ") for x in n.parts if isinstance(x, str) and not x.isspace()) + sum(chars[c] for c in below)
        if n.tag == "h1" or any(c in heads for c in below):
            heads.add(n)
    parts = [n for n in nodes if n.tag in MAIN and n.mark == NONE and chars[n]]
    longest = max((chars[n] for n in parts), default=0)
    main: set[Node] = set()
    for n in parts:
        if n.tag == "main" or 2 * chars[n] >= longest:
            while n and n not in main:
                main.add(n)
                n = n.parent
    below_mark: set[Node] = set()
    for n in nodes:  # parents first
        if n.mark != NONE or n.parent in below_mark:
            below_mark.add(n)
    outside = set(parts) - below_mark
    for n in nodes:
        if n.mark != NONE and (n in main or n in heads or not outside and 2 * chars[n] > chars[root]):
            n.mark, n.skip = NONE, False


class Open:
    """The open elements by name, so that what a tag closes is found at once however deep a page is."""

    def __init__(self):
        self.root = self.node = Node("html", None, NONE)
        self.named: dict[str, list[Node]] = {}
        self.blocks: list[Node] = []

    def push(self, tag: str, raw: str) -> None:
        child = Node(tag, self.node, _marked(tag, raw, any(self.named.get(t) for t in MAIN)))
        self.node.parts.append(child)
        if tag not in VOID:
            self.node = child
            self.named.setdefault(tag, []).append(child)
            if tag in WALLS:
                self.blocks.append(child)

    def last(self, tags) -> Node | None:
        """The innermost open element of these names."""
        return max((self.named[t][-1] for t in tags if self.named.get(t)), key=lambda n: n.depth, default=None)

    def close(self, to: Node) -> None:
        """Close all elements down to `to` and that one too."""
        end = to.parent
        while self.node is not end:
            tag = self.node.tag
            self.named[tag].pop()
            if tag in WALLS:
                self.blocks.pop()
            self.node = self.node.parent


def tree(page: str) -> Node:
    """Element tree of a page, however broken; raw elements and comments are left out."""
    o = Open()
    at = 0
    missing: set[str] = set()  # names without an end tag ahead
    m = _TOKEN.search(page)
    while m:
        if m.start() > at:
            o.node.parts.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if page.startswith("<![CDATA[", m.start()):
                o.node.parts.append(page[m.start() + 9 : at].removesuffix("]]>").replace("&", "&amp;"))
        elif m[1]:
            if o.named.get(tag):
                o.close(o.named[tag][-1])
            elif tag == "br":
                o.node.parts.append(Node("br", o.node, NONE))
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag == "html":
            pass
        elif tag == "body":
            if o.node.parent:
                top = o.node
                while top.parent.parent:
                    top = top.parent
                o.close(top)
        else:
            if tag in EMBEDDED:
                lacking = tag in missing or not re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
                if lacking:
                    missing.add(tag)
                if lacking or m[3].rstrip().endswith("/"):
                    m = _TOKEN.search(page, at)
                    continue
            if tag in IMPLIED:
                ends, stop = IMPLIED[tag]
                wall = o.last(stop | EMBEDDED)
                while (old := o.last(ends)) and not (wall and wall.depth > old.depth):
                    o.close(old)
            if tag in ENDS_P and o.blocks and o.blocks[-1].tag == "p":
                o.close(o.blocks[-1])
            if o.node.tag == "head" and tag not in HEAD:
                o.close(o.node)
            o.push(tag, m[3])
        m = _TOKEN.search(page, at)
    if at < len(page):
        o.node.parts.append(page[at:])
    _acquit(o.root)
    return o.root


def _walk(root: Node) -> list[Node]:
    """Elements that are not left out, parents first."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += [c for c in n.parts if isinstance(c, Node) and not c.skip]
    return out


def _measure(nodes: list[Node]) -> None:
    """Counts, densities and density sums, children first."""
    own: dict[Node, int] = {}
    for n in reversed(nodes):
        for c in n.parts:
            if isinstance(c, str):
                n.chars += len(c) - c.count(" ") if not c.isspace() else 0
            elif not c.skip:
                n.chars += c.chars
                n.tags += c.tags + 1
                n.link_chars += c.chars if c.link else c.link_chars
                n.link_tags += c.link_tags + c.link
        own[n] = n.chars - sum(c.chars for c in n.parts if isinstance(c, Node) and not c.skip)
    page = nodes[0]
    share = page.link_chars / max(1, page.chars)
    for n in reversed(nodes):
        c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
        if c:
            base = math.log(c / max(1, c - n.link_chars) * n.link_chars + share * c + math.e)
            n.density = max(0.0, c / t * math.log(max(1.0, c / lc * t / lt)) / math.log(base + math.e - 1))
        below = [x for x in n.parts if isinstance(x, Node) and not x.skip]
        n.total = sum(x.density for x in below) + n.density * own[n] / max(1, c)
        n.peak = max([n, *(x.peak for x in below)], key=lambda x: x.total)


def _scope(root: Node, nodes: list[Node]) -> list[Node]:
    """Topmost elements in which main text is looked for, in page order: the page, or its articles, mains and sections beside them."""
    tops, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag in MAIN and n.chars:
            tops.append(n)
        else:
            todo += [c for c in reversed(n.parts) if isinstance(c, Node) and not c.skip]
    if 2 * sum(n.chars - n.link_chars for n in tops) < root.chars - root.link_chars or not tops:
        return [root]
    beside, known = {n.parent for n in tops}, set(tops)
    above = set(beside)
    for n in tops:
        while (n := n.parent) and n not in above:
            above.add(n)
    known |= {c for n in beside for c in n.parts if isinstance(c, Node) and not c.skip and c.chars and c.tag in PARTS and c not in above}
    return [n for n in nodes if n in known]


def main_nodes(root: Node) -> list[Node]:
    """Subtrees of largest density sum below the nodes that reach the threshold of the path to the densest node, in page order."""
    nodes = _walk(root)
    _measure(nodes)
    tops = _scope(root, nodes)
    best = max((n.peak for n in tops), key=lambda n: n.total)
    path, n = [], best
    while n:
        path.append(n)
        n = n.parent
    threshold = min(x.density for x in path)
    inside = set(path)
    for n in nodes:  # doubtful elements have to be as dense as main text
        n.skip = n.mark == DOUBT and n not in inside and n.density < threshold
    tops = [n for n in tops if not n.skip]
    peers: dict[tuple, float] = {}
    known = set(tops)
    for x in path:
        if x.tag in PARTS:
            for place in [x.parent] + [None] * (x in known):
                peers[place, x.tag] = min(threshold, PEER * x.density)
    chosen: set[Node] = set()
    todo = list(tops)
    while todo:
        n = todo.pop()
        need = min(peers.get((n.parent, n.tag), threshold), peers.get((None, n.tag), threshold) if n in known else threshold)
        if n in inside or n.density and n.density >= need:
            chosen.add(n.peak)
            if n.peak is not n:
                todo += [c for c in n.parts if isinstance(c, Node) and not c.skip]
    return _outermost(tops, _widened(tops, chosen))


def _below(tops: list[Node]) -> Iterator[Node]:
    for top in tops:
        yield from _walk(top)


def _widened(tops: list[Node], chosen: set[Node]) -> set[Node]:
    """Chosen nodes with the headings before them; whole parents that hold but headings and paragraphs beside them."""
    chosen = set(chosen)
    holds: set[Node] = set()
    for n in reversed(list(_below(tops))):
        parts = [x for x in n.parts if (not x.isspace() if isinstance(x, str) else not x.skip and x.chars)]
        if n in chosen or not any(isinstance(x, Node) and x in holds for x in parts):
            if n in chosen:
                holds.add(n)
            continue
        holds.add(n)
        if all(isinstance(x, Node) and (x in chosen or x.tag in WITH_MAIN) for x in parts):
            chosen.add(n)
            continue
        follows = False
        for x in reversed(parts):
            follows = isinstance(x, Node) and (x in holds or follows and x.tag in HEADING)
            if follows and x not in holds:
                chosen.add(x)
    return chosen


def _outermost(tops: list[Node], chosen: set[Node]) -> list[Node]:
    out, todo = [], tops[::-1]
    while todo:
        n = todo.pop()
        if n in chosen:
            out.append(n)
        else:
            todo += [c for c in reversed(n.parts) if isinstance(c, Node) and not c.skip]
    return out


def _blocks(node: Node) -> Iterator[str]:
    """Texts of blocks in page order, character references decoded and white space folded."""
    line: list[str] = []
    stack: list = [iter(node.parts)]
    tags = [node.tag]

    def ended() -> str:
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        line.clear()
        return text

    while stack:
        part = next(stack[-1], None)
        if part is None:
            stack.pop()
            if tags.pop() in BLOCK and (text := ended()):
                yield text
        elif isinstance(part, str):
            line.append(part)
        elif not part.skip:
            if part.tag in BLOCK and (text := ended()):
                yield text
            stack.append(iter(part.parts))
            tags.append(part.tag)
    if text := ended():
        yield text


def main_text(page: str | None) -> str:
    """Main text of a page; NULL, empty and text-free pages give an empty text."""
    if not page:
        return ""
    return "\n".join(line for n in main_nodes(tree(page)) for line in _blocks(n))


def extract(pages: DataFrame) -> DataFrame:
    """`pages` with `text` and `n_chars` (code points) in the place of `html`.

    Every page is read whole, and each row by itself, so repeated rows give the same text twice and NULL ids or urls
    pass through. Input columns named text or n_chars are replaced.
    """
    pages = pages.drop("text", "n_chars")
    kept = [c for c in pages.columns if c != "html"]
    schema = StructType([*[pages.schema[c] for c in kept], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches):
        for batch in sliced(batches):
            texts = [main_text(p) for p in batch.column(len(kept)).to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*kept, "text", "n_chars"])

    return pages.select(*kept, "html").mapInArrow(run, schema)
