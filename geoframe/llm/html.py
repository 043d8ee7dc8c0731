"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import table, text_bytes

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SCOPE = frozenset("html body article aside blockquote center details div figure footer form header li main nav ol section table td th tr ul dl dd dt button caption".split())
#: What may not stand inside another of its kind, and where the search for that other one ends.
SIBLINGS = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"}), "body": ("head", {"html"})}

#: Never article text.
DROPPED = frozenset("head script style noscript template nav footer aside form button select input textarea iframe object svg canvas dialog menu title".split())
#: Of these, elements that can hold the article when a page is wrapped in one or leaves one open.
WRAPPERS = frozenset("head nav footer aside form button object dialog menu header".split())
#: A mark only lowers the density of what has so much of the page's unlinked text, outside and inside an article, namely to this part.
LARGE, LARGE_INSIDE, LOWERED = 1 / 3, 0.1, 0.1
#: Words in class, id or role that mark menus, headers, footers, sidebars, notices, adverts, forms and reader comments.
MARKS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner banners nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar sidebar sidebars aside "
    "footer foot header masthead comment comments commentlist discussion disqus replies reply respond cookie cookies consent gdpr notice notices notification alert disclaimer newsletter subscribe signup login search "
    "searchbox social share sharing sharebar related recommended recommendations popup modal overlay widget widgets pagination pager copyright skip outbrain taboola contentinfo complementary".split()
)
#: Marks that name an article as well as a notice about one: on half of the page's unlinked text they say nothing.
WEAK = frozenset("alert banner banners header masthead notice notices promo promotion related search share sharing social widget widgets popup modal overlay".split())
#: With one of these beside it a mark tells how the page is laid out, not what the element is, as in has-sidebar.
LAYOUT = frozenset("has with no without layout".split())
#: Elements that hold text rather than lay out a page.
TEXTS = frozenset("h1 h2 h3 h4 h5 h6 hgroup p ul ol dl table pre blockquote figure details".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?=[\s/>]|$))", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "attributes", "chars", "link_chars", "tags", "link_tags", "density", "sum", "closed", "marked", "articles", "mains", "plain")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.children: list[Node | str] = []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0
        self.closed = self.marked = False
        self.articles = self.mains = self.plain = 0


def parse(source: str) -> Node:
    """A tree of the page: unclosed and misnested tags are closed as browsers do for paragraphs, list items and table cells."""
    root = at = Node("#root", None)
    pos, end = 0, len(source)
    while pos < end:
        m = _TOKEN.search(source, pos)
        text = source[pos : m.start() if m else end]
        if text:
            at.children.append(html.unescape(text))
        if not m:
            break
        pos = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                at.children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            node = at
            while node is not root and node.tag != tag:
                if tag in INLINE and node.tag in SCOPE:
                    node = root
                    break
                node = node.parent
            if node is not root:
                node.closed = True
                at = node.parent
            continue
        if tag in CLOSES_P:
            node = at
            while node is not root and node.tag != "p" and (node.tag in INLINE):
                node = node.parent
            if node.tag == "p":
                at = node.parent
        if tag in SIBLINGS:
            kinds, stop = SIBLINGS[tag]
            node, found = at, None
            while node is not root and node.tag not in stop:
                if node.tag in kinds.split():
                    found = node
                node = node.parent
            if found:
                at = found.parent
        node = Node(tag, at, m[3])
        at.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, pos)
            node.children.append(source[pos : close.start() if close else end])
            pos = close.end() if close else end
        elif tag not in VOID:  # a slash before > means nothing on other elements
            at = node
    return root


def _order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    out = [root]
    for node in out:
        out += [c for c in node.children if not isinstance(c, str)]
    return out


def _value(m: re.Match) -> str:
    return m[2] or m[3] or m[4] or ""


def is_hidden(node: Node) -> bool:
    """Whether a node is never shown as text."""
    if node.tag in DROPPED and node.tag not in WRAPPERS:
        return True
    if not node.attributes or node.tag in ("html", "body", "article", "main", "#root"):
        return False
    for m in _ATTRIBUTE.finditer(node.attributes):
        name = m[1].lower()
        if name == "hidden" or name == "aria-hidden" and _value(m).lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", _value(m), re.I):
            return True
    return False


def is_marked(node: Node, marks: frozenset[str] = MARKS) -> bool:
    if not node.attributes or node.tag in ("html", "body", "article", "main", "#root"):
        return False
    for m in _ATTRIBUTE.finditer(node.attributes):
        if m[1].lower() in ("class", "id", "role"):
            parts = {x.lower() for x in _SPLIT.split(_value(m))}
            if not marks.isdisjoint(parts) and LAYOUT.isdisjoint(parts):
                return True
    return False


def count(root: Node) -> None:
    """Articles, main elements and unlinked characters of every subtree."""
    for node in reversed(_order(root)):
        node.plain += sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.articles += node.tag == "article"
        node.mains += node.tag == "main"
        if node.tag == "a":
            node.plain = 0
        if node.parent:
            up = node.parent
            up.articles, up.mains, up.plain = up.articles + node.articles, up.mains + node.mains, up.plain + node.plain


def is_boilerplate(node: Node, root: Node, in_article: bool, in_content: bool) -> bool:
    """Whether a node goes with all that it holds. A mark on a large part of the page is noted instead."""
    share = node.plain / max(1, root.plain)
    if node.tag == "form":
        if node.closed and not node.articles and not node.mains and share < 0.5:
            return True
    elif node.tag in DROPPED or node.tag == "header" and not in_content:
        # articles in an aside or a footer beside others are teasers
        every = node.articles and node.articles == root.articles and not root.mains
        if not (node.mains or every or node.articles and share >= 0.5):
            return True
    if is_marked(node, MARKS if share < 0.5 else MARKS - WEAK) and not node.articles and not node.mains:
        if share < (LARGE_INSIDE if in_article else LARGE):
            return True
        node.marked = True
    return False


def prune(root: Node) -> None:
    for node in _order(root):
        node.children = [c for c in node.children if isinstance(c, str) or not is_hidden(c)]
    count(root)
    todo = [(root, False, False)]
    while todo:
        node, article, content = todo.pop()
        article = article or node.tag == "article"
        content = content or article or node.tag == "main"
        node.children = [c for c in node.children if isinstance(c, str) or not is_boilerplate(c, root, article, content)]
        todo += [(c, article, content) for c in node.children if not isinstance(c, str)]


def link_share(root: Node) -> float:
    """Part of the page's characters that stand in links, 0.05 at least so that the base of the density's logarithm stays over one."""
    total = linked = 0
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        for c in node.children:
            if isinstance(c, str):
                n = len(c) if node.tag not in DROPPED else 0
                total, linked = total + n, linked + n * inside
            else:
                todo.append((c, inside or c.tag == "a"))
    return max(0.05, linked / max(1, total))


def measure(root: Node, share: float) -> None:
    """Characters, tags and their linked parts of every node, its composite text density and the sum over its children and own text."""
    nodes = _order(root)
    own = {}
    for node in reversed(nodes):
        own[node] = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += own[node]
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent:
            up = node.parent
            up.chars, up.link_chars, up.tags, up.link_tags = up.chars + node.chars, up.link_chars + node.link_chars, up.tags + node.tags + 1, up.link_tags + node.link_tags
    for node in nodes:
        c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags), max(1, node.link_tags)
        if c:
            base = math.log(c * lc / max(1, c - lc) + share * c + math.e)
            node.density = max(0.0, c / t * math.log(max(1e-9, c / max(1, lc) * t / lt)) / math.log(base))
    for node in nodes:
        node.marked = node.marked or node.parent is not None and node.parent.marked
        if node.marked:
            node.density *= LOWERED
    for node in nodes:
        node.sum = own[node] * (LOWERED if node.marked else 1) + sum(c.density for c in node.children if not isinstance(c, str))


def blocks(node: Node) -> list[str]:
    """Texts between block boundaries in page order, white space collapsed, empty ones left out."""
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    todo: list[Node | str | None] = [node]
    while todo:
        x = todo.pop()
        if x is None:
            close()
        elif isinstance(x, str):
            held.append(x)
        elif x.tag == "br":
            held.append(" ")
        else:
            if x.tag not in INLINE:
                close()
                todo.append(None)
            todo += x.children[::-1]
    close()
    return out


def _runs(node: Node) -> list[list[Node | str]]:
    """Children in page order: neighbouring bare texts and inline elements together, other elements alone."""
    out: list[list[Node | str]] = []
    inline = False
    for c in node.children:
        if isinstance(c, str) and c.isspace():
            if inline:
                out[-1].append(c)
            continue
        now = isinstance(c, str) or c.tag in INLINE or c.tag == "br"
        if now and inline:
            out[-1].append(c)
        else:
            out.append([c])
        inline = now
    for run in out:
        while isinstance(run[-1], str) and run[-1].isspace():
            run.pop()
    return out


def main_text(source: str) -> str:
    """Main text of a page: what is left of the marked boilerplate around the subtree of the largest density sum.

    The outermost article or main element around that subtree is taken whole. Without one, what is mostly
    links and less dense than the least dense ancestor is left out of the highest ancestor under the body
    that reaches the body's density. Outside of these, elements that aren't in TEXTS must also reach the
    least density. Bare text and inline elements beside each other go together. A page without text gives
    an empty text.
    """
    root = parse(source)
    share = link_share(root)
    prune(root)
    measure(root, share)
    best = max(_order(root), key=lambda n: n.sum)
    path = [best]
    while path[-1].parent:
        path.append(path[-1].parent)
    inner = [n for n in path if n is best or n.tag not in ("html", "body", "#root")]
    body = next((n for n in path if n.tag == "body"), path[-1])
    least = min(n.density for n in [*inner, body])
    whole = next((n for n in inner[::-1] if n.tag in ("article", "main")), best)
    zone = whole if whole is not best else next((n for n in inner[::-1] if n.density >= body.density), best)

    def kept(run: list[Node | str], in_zone: bool) -> bool:
        c = run[0]
        if len(run) == 1 and not isinstance(c, str) and (c.tag in ("h1", "p") or min(c.density, c.sum) >= least):
            return True
        nodes = [x for x in run if not isinstance(x, str)]
        chars = sum(x.chars for x in nodes) + sum(len("".join(x.split())) for x in run if isinstance(x, str))
        if any(x.marked for x in nodes) and not best.marked or 2 * sum(x.link_chars for x in nodes) > chars:
            return False
        return in_zone or isinstance(c, str) or c.tag in TEXTS or c.tag in INLINE or c.tag == "br"

    on_path, todo, found = set(path), [(root, False)], []
    while todo:
        node, in_zone = todo.pop()
        if node is whole or node not in on_path:
            found += blocks(node)
            continue
        in_zone = in_zone or node is zone
        parts = []
        for run in _runs(node):
            if len(run) == 1 and run[0] in on_path:
                parts.append((run[0], in_zone))
            elif not on_path.isdisjoint(run) or kept(run, in_zone):
                parts.append((Node("#run", None), in_zone))
                parts[-1][0].children = run
        todo += parts[::-1]
    return "\n".join(found)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with its columns but ``html_col``, and text string and n_chars long, which replace columns of these names.

    Null html is empty; rows and other columns stay as they are.
    """
    others = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    names = [f"given_{k}" for k in range(len(others))]
    given = pages.select(*(F.col(c).alias(n) for c, n in zip(others, names)), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.decode("utf-8", "replace")) for x in text_bytes(batch.column(len(names)))]
            yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*names, "text", "n_chars"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in given.select(names).schema), "text string, n_chars long"])
    return given.mapInArrow(run, schema).toDF(*others, "text", "n_chars")


def op4_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
