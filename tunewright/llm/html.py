"""Main text of web pages by scores on the element tree.

The page becomes a tree of elements. Elements that hold no prose of the page (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, reader comments, hidden ones) are left out, by
their tag, role, class or id. Every paragraph gets points for its length and its commas and passes
them to its ancestors: all to the parent, half to the next, and ever less above. A container's points
are discounted by the share of its text that is in links. The best container is kept; ``article`` and
``main`` have a bonus in this and bound nothing. Beside it and beside each of its ancestors, siblings
are kept that have a fair part of its points or are prose themselves.

The text is that of the kept elements in page order: a block is a run of text between the starts and
ends of block elements, its character references are decoded and its white space becomes one space.

Defined results: a null or empty page, and one without any text, gives an empty text; broken markup is
read as browsers do in the common cases (an open paragraph ends where a block begins, an unmatched
end tag is dropped, an unclosed comment or script runs to the end). Repeated rows are extracted each by
itself. Columns of the input that are called like an output column are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tunewright.llm import words as W
from tunewright.llm.registry import query

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form frame frameset head iframe input "
    "math menu nav noembed noframes noscript object optgroup option script select style svg template "
    "textarea title video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
#: Words of class and id that mark elements without prose of the page.
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertisements advertising adsense alert alerts "
    "aside banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright "
    "disqus footer footnav gdpr header hero login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices notification notifications overlay pager pagination popup promo promos "
    "promotion promoted rail recommended related replies respond responses secondary share sharing sidebar sidebars "
    "signup skyscraper social sponsor sponsored sponsors subscribe subscription toolbar topbar widget "
    "widgets".split()
)
#: ... but not as "has-sidebar", nor as the heading of an article ("post-header").
MODIFIERS = frozenset("has have hide is no not with without".split())
HEADER_NAMES = frozenset("banner header hero".split())
KEPT_NAMES = frozenset("article content entry post story".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_PARAGRAPH = frozenset("p pre td th li dd dt blockquote div section article main body".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"""
    r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)(?:>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: White space of HTML and the other blanks of Unicode.
_BLANK = re.compile(r"\s+")
# a part of a list or table that starts ends these open elements, up to these
_ENDS = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dd dt", ("dl",)), "dd": ("dd dt", ("dl",)),
    "tr": ("td th tr", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "score", "text", "links")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []
        self.score, self.text, self.links = 0.0, 0, 0


def _drops(tag: str, attributes: str, path: Path) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header":
        # the heading of an article stays
        return not path.nearest(("article", "main"))
    if "=" not in attributes and "hidden" not in attributes:
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "").lower()):
        return True
    if found.get("role", "").strip().lower() in ROLES:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    named = unescape(found.get("class", "")) + " " + unescape(found.get("id", ""))
    return any(map(_marks, named.split()))


def _marks(name: str) -> bool:
    words = _SPLIT.split(_CAMEL.sub(" ", name).lower())
    hits = NAMES.intersection(words)
    if not hits or words[0] in MODIFIERS:
        return False
    return not (hits <= HEADER_NAMES and KEPT_NAMES.intersection(words))


class Path:
    """The open elements from the root to the current one, with their depths by tag."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.blocks: list[int] = []
        self.by_tag: dict[str, list[int]] = defaultdict(list)

    def push(self, node: Node) -> None:
        if node.tag in BLOCK:
            self.blocks.append(len(self.nodes))
        self.by_tag[node.tag].append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, depth: int) -> None:
        """Close the element at ``depth`` and all below it; each element is closed once."""
        while len(self.nodes) > depth:
            tag = self.nodes.pop().tag
            self.by_tag[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def nearest(self, tags: tuple[str, ...]) -> int:
        """Depth of the innermost open element of these tags, 0 if there is none."""
        return max((self.by_tag[t][-1] for t in tags if self.by_tag.get(t)), default=0)

    def start(self, tag: str) -> None:
        """Close what a starting block ends: an open paragraph, or list and table parts of its kind."""
        # only inline elements can stand between an open paragraph and this place
        if self.blocks and self.nodes[self.blocks[-1]].tag == "p":
            self.cut(self.blocks[-1])
        if tag in _ENDS:
            tags, scope = _ENDS[tag]
            outer = self.nearest(scope)
            ended = [self.by_tag[t] for t in tags.split() if self.nearest((t,)) > outer]
            if ended:
                self.cut(min(d[bisect_right(d, outer)] for d in ended))

    def end(self, tag: str) -> None:
        depth = self.nearest((tag,))
        # an end tag does not reach beyond the block around it, unless it ends a block itself
        if depth and (tag in BLOCK or not self.blocks or self.blocks[-1] < depth):
            self.cut(depth)


def parse(html: str) -> Node:
    """The tree of a page; dropped elements keep no text."""
    root = Node("#root", None)
    path = Path(root)
    at, n = 0, len(html)
    for m in iter(lambda: _TAG.search(html, at), None):
        node = path.nodes[-1]
        if m.start() > at and not node.dropped:
            node.children.append(unescape(html[at : m.start()]))
        at = max(m.end(), m.start() + 1)
        if m[1] is not None:
            if not node.dropped:
                node.children.append(m[1])
            continue
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            path.end(tag)
            continue
        if tag in BLOCK:
            path.start(tag)
            node = path.nodes[-1]
        if tag in VOID:
            if not node.dropped:
                node.children.append(Node(tag, node))
            continue
        child = Node(tag, node, node.dropped or _drops(tag, m[4], path))
        if not child.dropped or not node.dropped:
            node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = end.end() if end else n
            continue
        if not m[4].rstrip().endswith("/") or tag not in ("svg", "path", "math"):
            path.push(child)
    node = path.nodes[-1]
    if at < n and not node.dropped:
        node.children.append(unescape(html[at:]))
    return root


def _order(root: Node) -> list[Node]:
    """All kept nodes, parents first; without recursion, as pages may be deep."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.dropped:
            continue
        out.append(x)
        todo.extend(c for c in reversed(x.children) if isinstance(c, Node))
    return out


def score(nodes: list[Node]) -> None:
    """Fill in text and link lengths, and pass the paragraphs' points up."""
    own = {}
    for x in nodes:
        t = [_BLANK.sub(" ", c) for c in x.children if isinstance(c, str)]
        own[x] = (sum(len(c.strip()) for c in t), sum(c.count(",") for c in t))
        x.text = own[x][0]
    inline = dict(own)
    for x in reversed(nodes):
        if x.parent is not None:
            x.parent.text += x.text
            x.parent.links += x.text if x.tag == "a" else x.links
            if x.tag not in BLOCK:
                a, b = inline[x], inline[x.parent]
                inline[x.parent] = (a[0] + b[0], a[1] + b[1])
    for x in nodes:
        size, commas = inline[x]
        if not size or (x.tag not in _PARAGRAPH and x.tag != "#root"):
            continue
        points = 1 + commas + min(size / 100, 3.0)
        if x.text:
            points *= 1 - x.links / x.text
        x.score += points if x.tag not in ("p", "td", "th", "li", "dd", "dt") else 0.0
        up, level = x.parent, 1
        while up is not None and level <= 5:
            up.score += points / (1 if level == 1 else 2 if level == 2 else 3 * (level - 1))
            up, level = up.parent, level + 1
    for x in nodes:
        if x.text:
            x.score *= 1 - x.links / x.text


def _prose(x: Node) -> bool:
    """Text that is mostly outside links."""
    return bool(x.text) and x.links / x.text < 0.5


def _beside(c: Node | str, best: Node) -> bool:
    """Does a sibling of the best container belong to the text?"""
    if isinstance(c, str):
        return bool(c.strip())
    if c is best or c.tag in HEADINGS:
        return True
    return _prose(c) and (c.tag not in _CONTAINER or c.score >= 0.2 * best.score)


#: What an element that is named as the text counts for among the containers.
BONUS = 1.25
_CONTAINER = frozenset("article body center div main section td".split())


def main_nodes(root: Node) -> list[Node | str]:
    """The elements (and loose texts) that are kept, in page order."""
    nodes = _order(root)
    score(nodes)
    candidates = [x for x in nodes if x.text and x.tag != "p" and (x.tag in BLOCK or x is root)]
    if not candidates:
        return []
    best = max(candidates, key=lambda x: x.score * (BONUS if x.tag in ("article", "main") else 1.0))
    kept: deque[Node | str] = deque([best])
    inner = best
    while inner.parent is not None:
        around = inner.parent.children
        at = next(i for i, c in enumerate(around) if c is inner)
        for add, siblings in ((kept.appendleft, reversed(around[:at])), (kept.append, around[at + 1 :])):
            for c in siblings:
                if (isinstance(c, str) or not c.dropped) and _beside(c, best):
                    add(c)
        inner = inner.parent
    return list(kept)


def blocks(nodes: list[Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = _BLANK.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    for top in nodes:
        todo: list = [top]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                run.append(x)
            elif x is None:
                end()
            elif not x.dropped:
                if x.tag in BLOCK:
                    end()
                    todo.append(None)
                elif x.tag in ("br", "wbr"):
                    run.append(" " if x.tag == "br" else "")
                todo.extend(reversed(x.children))
    end()
    return out


def main_text(html: str | None) -> str:
    """The page's main text: its blocks joined by an empty line."""
    return "\n\n".join(blocks(main_nodes(parse(html)))) if html else ""


def extract(df: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Add text and n_chars (its code points) to the columns ``keep`` (all)."""
    keep = [c for c in (keep or df.columns) if c in df.columns and c not in ("text", "n_chars")]
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in keep], "text string, n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in W.pieces(batches):
            found = [main_text(h) for h in b.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *[b.column(c) for c in keep],
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=[*keep, "text", "n_chars"],
            )

    used = list(dict.fromkeys([*keep, html]))
    return df.select(used).mapInArrow(run, schema)


@query("op2_html_tree_scoring")
def op2_html_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, keep=["page_id", "url"])
