"""Main text of web pages by composite text density."""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg textarea select title xmp noembed noframes".split())
NEVER_TEXT = frozenset("head nav footer aside form button menu annotation annotation-xml".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul").split())
#: An opening tag of the key closes an open element of these names first (omitted end tags).
CLOSES = {**dict.fromkeys(BLOCK - {"html", "body"}, frozenset(["p"])), "li": frozenset(["li", "p"]),
          "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]), "tr": frozenset(["tr", "td", "th", "p"]),
          "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]), "tbody": frozenset(["tr", "td", "th", "thead", "p"]),
          "option": frozenset(["option"])}
#: An omitted end tag is not looked for beyond these.
SCOPE = frozenset("html body div article section main aside nav header footer ul ol dl table form blockquote".split())
#: Words in class, id or role that mark what is not the article.  Reader comments and teasers of other
#: pages always are; the second kind unless it holds the article element; the third by its share of the page's prose.
COMMENTS = frozenset("comment comments disqus reply replies respond related recommended recommendations recommendation".split())
FURNITURE = frozenset(("ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion breadcrumb "
                       "breadcrumbs cookie cookies consent gdpr notice newsletter subscribe footer masthead menu nav navbar navigation "
                       "pagination pager sidebar share sharing social contentinfo complementary").split())
PERHAPS = frozenset("alert banner foot header hidden login modal overlay popup search side signup skip tags toolbar topbar widget widgets".split())
#: What such words are joined with in the usual names of furniture; with any other part the name means something else.
JOINED = frozenset(("area article articles bar block blocks body bottom box buttons button card cards center column container count "
                    "entry feed fixed form global group holder icons inner item items left links link list main message messages "
                    "module outer page panel post posts primary reader right row secondary section sections site slot small sticky "
                    "stories story text thread title top unit user wrap wrapper").split())
#: Inside an article, text elements are content whatever their class.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl li dt dd table tbody tr td th figure figcaption span b i em strong code".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
                 r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements that hold running text.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
SPACE = re.compile(r"\s+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?|\Z", re.I) for t in RAW}


class Node:
    """An element: its tag, children (nodes and strings in page order), and the sums over its subtree."""

    __slots__ = ("tag", "parent", "children", "other", "marked", "chars", "tags", "link_chars", "link_tags", "density", "density_sum",
                 "inside")

    def __init__(self, tag: str, parent: Node | None, other: bool = False):
        self.tag, self.parent, self.other, self.children, self.marked, self.inside = tag, parent, other, [], 0, False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.density_sum = 0.0


def _is_other(tag: str, attrs: str, parent: Node) -> bool:
    if tag in NEVER_TEXT:
        return True
    if tag == "header":       # a page's header is furniture, an article's holds its title
        p = parent
        while p is not None:
            if p.tag in ("article", "main"):
                return False
            p = p.parent
        return True
    if tag == "dialog" and not any(name.lower() == "open" for name, *_ in ATTR.findall(attrs)):
        return True           # not shown, like what is hidden
    if not attrs or tag in ("html", "body"):
        return False
    for name, a, b, c in ATTR.findall(attrs):
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and "true" in (a, b, c)):
            return True
        if name == "style" and "display:none" in (a or b or c).replace(" ", "").lower():
            return True
    return False


def _marked(tag: str, attrs: str) -> int:
    """What a node's class, id or role says: 3 reader comments or teasers, 2 furniture, 1 perhaps furniture, 0 nothing.

    A name counts if all its parts are such words or what they are usually
    joined with ("comments-area", "cookie-notice"), so "related-work",
    "share-price" or "side-by-side" say nothing.
    """
    if not attrs or tag in ("html", "body", "main"):
        return 0
    mark = 0
    for name, a, b, c in ATTR.findall(attrs):
        if name.lower() in ("class", "id", "role"):
            for word in entities.unescape(a or b or c).lower().split():
                if word == "sr-only":
                    return 2
                kinds = [3 if x in COMMENTS else 2 if x in FURNITURE else 1 if x in PERHAPS else 0 if x in JOINED else -1
                         for x in re.split(r"[-_]+", word) if x]
                # an "entry-header" holds the article's title
                if kinds and min(kinds) >= 0 and not ("header" in word and ARTICLE.search(word)):
                    mark = max(mark, *kinds)
    return mark


def _settle(root: Node) -> None:
    """Decides which marked nodes are furniture; a thread of comments or a notice stays one however long it is."""
    nodes, prose, linked, controls, holds = _order(root), {}, {}, {}, {}
    if not any(x.marked for x in nodes):
        return
    for node in reversed(nodes):
        inner = [x for x in node.children if not isinstance(x, str)]
        text = sum(len("".join(x.split())) for x in node.children if isinstance(x, str))
        off = node.other
        linked[node] = 0 if off else sum(linked[x] for x in inner) + (text if node.tag == "a" else 0)
        prose[node] = 0 if off or node.tag == "a" else text + sum(prose[x] for x in inner)
        controls[node] = node.tag in ("form", "button", "input", "select", "textarea") or any(controls[x] for x in inner)
        # the largest amount of prose in one article or main element that is not itself marked
        own = prose[node] if node.tag in ("article", "main") and not node.marked and not off else 0
        holds[node] = max([own, *(holds[x] for x in inner)])
    for node in nodes:            # parents first
        up = node.parent
        if up is None:
            continue
        node.inside = up.inside or up.tag in ("article", "main")
        if node.tag == "main" or node.other:
            continue
        if up.other:
            node.other = True
        elif node.marked == 3:
            node.other = True
        elif node.marked == 2:
            node.other = max(holds[node], prose[node] if node.tag == "article" else 0) * 2 <= prose[root]
        elif node.marked == 1 and node.inside:
            node.other = node.tag not in TEXT and (controls[node] or linked[node] > prose[node])
        elif node.marked == 1:
            share = 0.5 if node.tag == "article" else 0.9
            node.other = holds[node] * 2 <= prose[root] and prose[node] <= share * prose[root]


def parse(page: str) -> Node:
    """The element tree of a page; unclosed, stray and truncated tags never fail."""
    root = cur = Node("#root", None)
    pos, n = 0, len(page)
    while pos < n:
        m = TAG.search(page, pos)
        if m is None:
            cur.children.append(page[pos:])
            break
        if m.start() > pos:
            cur.children.append(page[pos:m.start()])
        pos = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            p = cur
            while p is not None and p.tag != tag:
                p = p.parent
            if p is not None and p.parent is not None:
                cur = p.parent
            continue
        shut = CLOSES.get(tag)
        if shut:
            p, top = cur, None
            while p is not None and p.tag not in SCOPE:
                if p.tag in shut:
                    top = p
                p = p.parent
            if top is not None:
                cur = top.parent
        if tag in RAW:
            pos = _RAW_END[tag].search(page, pos).end() if not m[3].rstrip().endswith("/") else pos
            cur.children.append(Node(tag, cur, True))
            continue
        node = Node(tag, cur, tag != "main" and (cur.other or _is_other(tag, m[3], cur)))
        if not node.other:
            node.marked = _marked(tag, m[3])
        cur.children.append(node)
        if tag not in VOID and not (m[3].rstrip().endswith("/") and tag not in BLOCK):
            cur = node
    _settle(root)
    return root


def _order(root: Node) -> list[Node]:
    """Every node, parents first; a loop, since nesting may be deeper than Python's stack."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(x for x in reversed(node.children) if not isinstance(x, str))
    return out


def measure(root: Node, body: Node) -> list[Node]:
    """Fills in characters, tags and composite text density of every node; returns them, parents first.

    A node's density is its characters per tag, adjusted by a logarithm that
    falls with the share of link characters and link tags, and relative to the
    whole body; its density sum adds the densities of its children.
    """
    nodes = _order(root)
    for node in reversed(nodes):
        if node.other:
            continue
        for x in node.children:
            if isinstance(x, str):
                node.chars += len("".join(x.split()))
            elif not x.other:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_chars += x.chars if x.tag == "a" else x.link_chars
                node.link_tags += x.link_tags + (x.tag == "a")
    share = body.link_chars / max(1, body.chars)
    for node in reversed(nodes):
        c, t = node.chars, max(1, node.tags)
        if node.other or not c:
            continue
        lc, lt = node.link_chars, max(1, node.link_tags)
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        inner = c / max(1, lc) * t / lt
        node.density = c / t * (math.log(max(inner, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if inner > 1 else 0.0)
        node.density_sum = sum(x.density for x in node.children if not isinstance(x, str))
    return nodes


def main_node(root: Node) -> Node | None:
    """The subtree that holds the article.

    The node of maximum density sum is found first; the fewest characters per
    tag on its path from body are the threshold.  An explicit ``article`` or ``main`` on the
    path is the answer, thin paragraphs included.  Otherwise the node grows to
    its parent as long as a sibling reaches the threshold (an article split
    over several boxes); siblings below it that are mostly links stay out.
    """
    nodes = _order(root)
    body = next((x for x in nodes if x.tag == "body"), root)
    measure(root, body)
    live = [x for x in nodes if not x.other and x.chars and (x is body or x.tag not in ("#root", "html"))]
    if not live:
        return root if root.chars else None
    best = max(live, key=lambda x: x.density_sum)
    path, p = [], best
    while p is not None and p is not body:
        path.append(p)
        p = p.parent
    threshold = min(x.chars / max(1, x.tags) for x in [*path, body])
    for p in reversed(path):          # from body downwards
        if p.tag in ("article", "main"):
            return p
    named = [x for x in live if x.tag in ("article", "main")]
    if named:
        first = max(named, key=lambda x: x.chars)
        if first.chars * 2 >= best.chars:
            return first
    top = best
    while top is not body and top.parent is not None and top.parent is not root:
        beside = [x for x in top.parent.children if not isinstance(x, str) and x is not top and not x.other and x.chars]
        gains = [x for x in beside if x.chars >= threshold * max(1, x.tags) and 2 * x.link_chars <= x.chars
                 and (x.tag in PROSE or any(not isinstance(y, str) and y.tag in PROSE for y in x.children))]
        if top.tag in BLOCK and beside and not gains:
            break
        for x in beside:
            if x not in gains and 2 * x.link_chars > x.chars:
                x.other = True
        top = top.parent
    return top


def blocks(node: Node) -> list[str]:
    """The texts of a subtree's blocks in page order, furniture left out."""
    out, now = [], []

    def flush():
        line = SPACE.sub(" ", entities.unescape("".join(now))).strip()
        now.clear()
        if line:
            out.append(line)

    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            now.append(x)
        elif x is None:
            flush()
        elif x.tag == "br":
            now.append(" ")
        elif not x.other:
            if x.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(x.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article's text: one line per block; empty for a null, empty or textless page."""
    if not page:
        return ""
    node = main_node(parse(page))
    return "\n".join(blocks(node)) if node is not None else ""


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``pages`` without its html, plus the main text and its length in code points.

    One narrow, map-side step: no row moves, none is dropped, repeated rows
    stay repeated.  Null html gives an empty text.  Other columns pass through;
    one named like an appended column is replaced.
    """
    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield pd.Series([main_text(h) for h in html], dtype=object)

    keep = [c for c in pages.columns if c.lower() not in (html_col.lower(), text_col.lower(), chars_col.lower())]
    return (pages.select(*keep, text_of(F.col(html_col)).alias(text_col))
            .withColumn(chars_col, F.length(text_col).cast("long")))
