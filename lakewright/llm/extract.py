"""HTML extraction by composite text density (Sun, Song and Liao, SIGIR 2011).

Every node of the page's tree has a density, its characters for each tag, adjusted by the share of characters
and tags inside links. The sum of a node's children's densities finds the subtree that holds the article; the
smallest density on the path from it up to the body is the threshold for whatever else belongs to it.

Tags, roles and the names of classes only adjust the densities: the text of a menu, footer, advert or form counts
as link text, so an element of nothing else has density 0, below any threshold, and goes. What is never seen
(scripts, styles, hidden elements) is no text at all.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(?P<name>class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"(?P<a>[^"]*)"|'(?P<b>[^']*)'|(?P<c>[^\s"'>]+)))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text, not markup, up to their own end tag.
_RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in "script style textarea title noscript iframe xmp noembed noframes".split()}
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Start tags that end an open p; a p holds no blocks.
_ENDS_P = _BLOCK - frozenset("body html caption tbody td tfoot th thead tr".split())
#: Start tags that end an open one of the same kind, and what an open one can't be looked for beyond.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
#: What a start tag closes, seen from the closed element: element -> start tags that look for it; start tag -> barriers.
_BARRIERS = {tag: stop for tag, (_, stop) in _SIBLINGS.items()} | {"p": {"table", "td", "th", "button", "li", "dd", "blockquote"}}
_CLOSERS = {
    tag: {kind for kind, (kinds, _) in _SIBLINGS.items() if tag in kinds} | ({"p"} if tag == "p" else set())
    for tag in {t for kinds, stop in _SIBLINGS.values() for t in kinds | stop} | _BARRIERS["p"] | {"p"}
}
#: Their text is not the page's.
_UNSEEN = frozenset("script style noscript template head title textarea iframe object embed applet svg canvas audio video map xmp noembed noframes option".split())
#: Their text counts as link text.
_APART = frozenset("nav footer aside button select input dialog menu label fieldset legend search".split())
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adbox|adsense|banner\w*|sponsor\w*|promo\w*|outbrain|taboola|cookie\w*|consent\w*|gdpr|notice\w*|alert\w*|popup\w*|modal\w*|overlay\w*|"
    r"paywall\w*|subscribe\w*|subscription|newsletter\w*|signup|nav\w*|menu\w*|breadcrumb\w*|pagination|pager|toc|skip\w*|sidebar\w*|side|rail|aside|widget\w*|related\w*|recommend\w*|"
    r"share\w*|sharing|social\w*|footer\w*|foot|masthead|topbar|toolbar|comment\w*|disqus\w*|respond|replies|reply|feedback|login|search\w*|form|copyright|tags?|byline)(?=$|[\s_-])",
    re.I,
)
_HEADER = re.compile(r"(?:^|\s)(?:site[_-]|page[_-]|top[_-])?header(?=$|\s)", re.I)
#: Names of page layouts, which hold the article too.
_LAYOUT = re.compile(r"\b(?:has|with|no|without)[_-][\w-]+|\bwrapper\b|[\w-]+[_-](?:wrapper|wrap|container|layout|page)\b", re.I)
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_MAIN = frozenset(("article", "main"))
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: An end tag of another kind closes nothing beyond these.
_WALLS = frozenset(("article", "main", "body"))
_THROUGH_WALLS = frozenset(("html", "body", "article", "main", "div", "section"))


class Tree:
    """Nodes in page order: a node's parent comes before it. Text lies in pieces (node, text); ``("",)`` text ends a block.

    unseen and apart hold for a node and all below it. Reading is linear in the page: what a tag may close is looked
    up, never searched for among the open elements.
    """

    def __init__(self, page: str, by_name: bool = True):
        self.by_name = by_name
        self.tag, self.parent, self.unseen, self.apart, self.main = ["#root"], [-1], [False], [False], [False]
        self.pieces: list[tuple[int, str]] = []
        self._open = [0]
        #: Depths at which each tag is open; depths of walls; for each open element what a start tag may close there.
        self._depths: dict[str, list[int]] = {}
        self._walls = [0]
        self._closable: list[dict[str, int]] = [{}]
        at = 0
        while True:
            m = _TOKEN.search(page, at)
            text = page[at : m.start() if m else len(page)]
            if text:
                self.pieces.append((self._open[-1], text))
            if not m:
                break
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if m["end"]:
                self._end(tag)
                continue
            attrs = m["attrs"]
            if tag in _ENDS_P:
                self._cut(self._closable[-1].get("p", 0), mark=True)
            if tag in _SIBLINGS:
                self._cut(self._closable[-1].get(tag, 0))
            node = self._node(self._open[-1], tag, attrs)
            if tag in _VOID or attrs.endswith("/") and tag in ("path", "circle", "rect"):
                continue
            if tag in _RAW:
                end = _RAW[tag].search(page, at)
                at = end.end() if end else len(page)
                continue
            self._push(node, tag)

    def _push(self, node: int, tag: str) -> None:
        depth = len(self._open)
        self._open.append(node)
        self._depths.setdefault(tag, []).append(depth)
        if tag in _WALLS:
            self._walls.append(depth)
        above = self._closable[-1]
        if tag in _CLOSERS:
            # The outermost element of the kind inside the nearest barrier, for each start tag that closes it.
            above = {kind: at for kind, at in above.items() if tag not in _BARRIERS[kind]}
            for kind in _CLOSERS[tag]:
                above.setdefault(kind, depth)
        self._closable.append(above)

    def _cut(self, depth: int, mark: bool = False) -> None:
        """Closes the open elements from a depth on; 0: none."""
        if not depth:
            return
        if mark:
            self.pieces.append((self.parent[self._open[depth]], ""))
        while len(self._open) > depth:
            tag = self.tag[self._open.pop()]
            self._closable.pop()
            self._depths[tag].pop()
            if tag in _WALLS:
                self._walls.pop()

    def _end(self, tag: str) -> None:
        depths = self._depths.get(tag)
        if depths and (tag in _THROUGH_WALLS or depths[-1] > self._walls[-1]):
            self._cut(depths[-1], mark=tag in _BLOCK)

    def _node(self, parent: int, tag: str, attrs: str) -> int:
        values: dict[str, str] = {}
        for a in _ATTRIBUTE.finditer(attrs) if attrs else ():
            values.setdefault(a["name"].lower(), html.unescape(a["a"] or a["b"] or a["c"] or ""))
        role = values.get("role", "").lower()
        inside = self.main[parent]
        here = tag in _MAIN or role in _MAIN or values.get("itemprop", "").lower() == "articlebody"
        names = _LAYOUT.sub(" ", f"{values.get('class', '')} {values.get('id', '')}")
        unseen = tag in _UNSEEN or "hidden" in values or values.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(values.get("style", "")) is not None
        apart = tag in _APART or role in _ROLES or tag == "header" and not inside
        if tag not in ("html", "body") and not here and names != " ":
            apart = apart or self.by_name and (_BOILERPLATE.search(names) is not None or not inside and _HEADER.search(names) is not None)
        elif tag == "article" and re.search(r"(?:^|[\s_-])(?:comment|reply|ad|promo|related|teaser)", names, re.I):
            apart = True
        self.tag.append(tag)
        self.parent.append(parent)
        self.unseen.append(unseen or self.unseen[parent])
        self.apart.append(apart or self.apart[parent])
        self.main.append(inside or here)
        if tag in _BLOCK or tag == "br":
            self.pieces.append((len(self.tag) - 1, ""))
        return len(self.tag) - 1


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Composite text density and density sum of every node.

    With c characters and t tags in a node, lc and lt of them in links or set apart, and the page's share b of such
    characters: ``c / t * log(c / lc * t / lt)`` to the base ``log(c / (c - lc) * lc + b * c + e)``, where numbers below
    1 count as 1 and the base is e at least (nearer 1, it would favour the shortest texts beyond measure). A node of
    links alone has density 0. The sum of a block is over the blocks right below it; inline elements belong to their
    block's own text. They have no sum.
    """
    n = len(tree.tag)
    chars, tags, link_chars, link_tags = ([0] * n for _ in range(4))
    linked = [False] * n
    for i in range(1, n):
        linked[i] = tree.apart[i] or tree.tag[i] == "a" or linked[tree.parent[i]]
    for node, text in tree.pieces:
        if text and not tree.unseen[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if linked[node]:
                link_chars[node] += size
    for i in range(n - 1, 0, -1):
        if not tree.unseen[i]:
            p = tree.parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (tree.apart[i] or tree.tag[i] == "a")
    share = link_chars[0] / max(1, chars[0])
    block = [0] * n  # the nearest block round a node
    for i in range(1, n):
        p = tree.parent[i]
        block[i] = p if tree.tag[p] in _BLOCK else block[p]
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(1, tags[i]), max(1, link_chars[i]), max(1, link_tags[i])
        base = math.log(c / max(1, c - link_chars[i]) * link_chars[i] + share * c + math.e)
        density[i] = c / t * math.log(c / lc * t / lt) / max(1.0, math.log(base))
        if i and tree.tag[i] in _BLOCK:
            total[block[i]] += density[i]
    return density, total


def main_text(page: str | None) -> str:
    """The article's text: white space inside a block is one space, blocks are joined by a line feed.

    Where the names of classes leave no text at all, as a name on the element round the whole page can, the page is
    read again without regard to them.
    """
    if not page:
        return ""
    return _main_text(Tree(page)) or _main_text(Tree(page, by_name=False))


def chosen_nodes(tree: Tree, density: list[float], total: list[float]) -> set[int]:
    """Roots of the subtrees that make the article.

    The best node has the largest density sum in the body; of equal sums the first on the page. The threshold is the
    smallest density from it up to the body. Every node of at least that density adds the node of the largest sum
    inside it. The page's h1 before the best node, if not set apart, is its title.
    """
    n = len(tree.tag)
    best_in = list(range(n))
    for i in range(n - 1, 0, -1):
        a, p = best_in[i], tree.parent[i]
        b = best_in[p]
        if total[a] > total[b] or (total[a] == total[b] > 0 and a < b != p):
            best_in[p] = a
    top = next((i for i in range(n) if tree.tag[i] == "body"), 0)
    if not density[top]:
        top = 0
    best = best_in[top]
    threshold, i = density[best], best
    while i > 0 and i != top:
        i = tree.parent[i]
        threshold = min(threshold, density[i])
    chosen = {best_in[i] for i in range(top, n) if density[i] > 0 and density[i] >= threshold}
    return chosen | {i for i in range(top, best) if tree.tag[i] == "h1" and density[i] > 0}


def _main_text(tree: Tree) -> str:
    n = len(tree.tag)
    density, total = densities(tree)
    chosen = chosen_nodes(tree, density, total)
    inside = [False] * n
    for i in range(n):
        whole = i in chosen or (i > 0 and inside[tree.parent[i]])
        # A set-apart element inside the article is of no density, and goes; links in its sentences stay.
        inside[i] = whole and not tree.unseen[i] and not (tree.apart[i] and density[i] == 0.0)
    blocks: list[str] = []
    current: list[str] = []
    for node, text in tree.pieces:
        if not text:
            if tree.tag[node] == "br":
                current.append(" ")
                continue
            blocks.append("".join(current))
            current = []
        elif inside[node]:
            current.append(text)
    blocks.append("".join(current))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page's whole html.

    Null and empty html, and pages without text, give ''. Of equal density sums the first node on the page holds.
    Repeated rows and null ids keep their rows; other columns are not read. Map-only; a task holds the trees of one
    page at a time.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_pydict(
            {"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
        )

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_batches(source, run, "page_id long, url string, text string, n_chars long")
