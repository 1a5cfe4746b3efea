"""Operator 2: main text of web pages by site style trees.

A page is read as a tree of elements.  All pages of a host are merged into one
tree: elements of the same path of tags and classes are one node, which holds
how its children are laid out (presentation) and what its branch says (content) on
each page.  The importance of a node is a weighted sum of the entropies of the two, each
divided by its largest possible value: a branch that looks and reads the same
on all pages has none.  A container is removed from each page if its importance
is small against that of the main branch it lies in.

Elements that say what they are (menus, adverts, forms, comments, ...) have no
importance to begin with.  What an element is called is told by the last word of a
class or id: ``post-comments`` are comments, but ``side-effects`` are no side bar.
Where articles and main parts hold most of what is left of a page, only they count.

The merged trees are tables with a row per host and node.  A page is only told
which of its own nodes to remove, so neither a host's pages nor its tree are
ever in one place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded

# Weight of presentation in a node's importance, the share of the main branch's
# importance below which a container goes, and the elements needed to tell.
PRESENTATION = 0.3
LEAST_SHARE = 0.3
LEAST_SEEN = 5

# Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark "
    "meter output progress q rp rt ruby s samp small span strike strong sub sup time tt u var "
    "wbr br".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NO_TEXT = frozenset(
    "head script style noscript template iframe object svg math canvas audio video select "
    "datalist button form fieldset textarea title nav menu footer aside dialog xmp noembed "
    "noframes".split())
MAIN = frozenset(["article", "main"])
CONTAINERS = frozenset("div section ul ol dl table figure details center header hgroup".split())
CLOSES_P = CONTAINERS | MAIN | frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre address hr form fieldset nav footer aside menu "
    "dialog main".split())
SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
        "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
NO_ROLE = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar".split())
# Words at the end of a class or id that name what is not the article; the first few also on
# an article.
NO_STORY = frozenset(
    "comment comments ad ads advert advertisement sponsor sponsored promo related reply "
    "replies".split())
NO_CLASS = NO_STORY | frozenset(
    "adsense adslot advertising banner nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar side footer cookie cookies consent gdpr notice popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social recommended widget pagination "
    "pager toolbar search copyright masthead disclaimer alert disqus respond form skip "
    "topbar promotion".split())
# Words that say how something is laid out or counted, after the word that names it.
LAYOUT = frozenset(
    "box container wrapper wrap area section block list inner outer content body holder "
    "placeholder panel column col row group control unit slot spot space zone frame label item "
    "items button buttons link links icon icons bar title text posts articles stories left right "
    "top bottom main primary secondary x".split())
# Words in front that make a name of the page's state, not of the element.
STATE = frozenset("has with no without is not".split())

_TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^>"']|"[^"]*"|'[^']*')*+|[^>]*+)(?:>|(\Z)))""", re.S)
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|(\Z))", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_MASK = (1 << 61) - 1
_BASE = 1_000_003


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def _signed(value: int) -> int:
    value &= (1 << 64) - 1
    return value - (1 << 64) if value >> 63 else value


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def told(token: str) -> set[str]:
    """The word that names an element in one class or id: the last one that is no layout
    word, alone and with the word before it (``side-bar``)."""
    words = [w.lower() for w in _WORDS.findall(token.split("--")[0])]
    if words and words[0] in STATE:
        return set()
    joined = {"".join(words[-2:])} if len(words) > 1 else set()
    while len(words) > 1 and (words[-1] in LAYOUT or words[-1].isdigit()):
        words.pop()
    return joined | {"".join(words[-2:])} | set(words[-1:])


class _Node:
    __slots__ = ("tag", "path", "key", "main", "in_main", "skip", "layout", "first", "end")

    def __init__(self, tag, path, key, main, in_main, skip, first):
        self.tag, self.path, self.key, self.main = tag, path, key, main
        self.in_main, self.skip, self.first = in_main, skip, first
        self.layout, self.end = 0, None


class Page:
    """Text blocks of a page and its elements that have some.

    ``removed`` holds keys of nodes of the site's tree whose branches go.
    """

    def __init__(self, html: str, url: str | None, removed: frozenset[int] = frozenset()):
        self.host, self.removed = host_of(url), removed
        self.blocks: list[tuple[str, bool]] = []
        self.nodes: list[_Node] = []
        self.pieces: list[str] = []
        top = _Node("body", 1, self._key(1), None, False, False, 0)
        top.main = top
        self.stack = [top]
        self.nodes.append(top)
        self._read(html)
        self._flush()
        for node in self.stack:
            node.end = len(self.blocks)

    def _key(self, path: int) -> int:
        return _signed(_hash(f"{self.host} {path}"))

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join(unescape("".join(self.pieces)).split())
            self.pieces = []
            if text:
                self.blocks.append((text, self.stack[-1].in_main))

    def _text(self, text: str) -> None:
        if text and not self.stack[-1].skip:
            self.pieces.append(text)

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            found = _TAG.search(html, at)
            if not found:
                self._text(html[at:])
                return
            self._text(html[at:found.start()])
            at = found.end()
            if found[2] is None:
                continue
            if found[4] is not None:  # the text ends within a tag, or a quote is not closed
                found = _OPEN.match(html, found.start())
                if found[4] is not None:
                    return
                at = found.end()
            tag = found[2].lower()
            if found[1]:
                self._close(tag)
                continue
            self._open(tag, found[3])
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
                at = end.start() if end else size

    def _pop(self, depth: int) -> None:
        if any(n.tag not in INLINE for n in self.stack[depth:]):
            self._flush()
        for node in self.stack[depth:]:
            node.end = len(self.blocks)
        del self.stack[depth:]

    def _find(self, tags: tuple[str, ...], stop: tuple[str, ...] = ()) -> int:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                return i
            if self.stack[i].tag in stop:
                break
        return 0

    def _close(self, tag: str) -> None:
        depth = self._find((tag,))
        if depth and not (tag in INLINE and any(
                n.tag not in INLINE for n in self.stack[depth + 1:])):
            self._pop(depth)
        elif tag not in INLINE:
            self._flush()

    def _open(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P and (depth := self._find(
                ("p",), ("td", "th", "button", "object", "table"))):
            self._pop(depth)
        if tag in SAME and (depth := self._find((tag,), SAME[tag])):
            self._pop(depth)
        if tag in ("dt", "dd") and (depth := self._find(("dt", "dd"), ("dl",))):
            self._pop(depth)
        if self.stack[-1].tag == "head" and tag not in (
                "meta", "link", "base", "title", "script", "style", "noscript", "template"):
            self._pop(len(self.stack) - 1)
        up = self.stack[-1]
        if tag in INLINE:
            if tag == "br":
                self._text(" ")
            elif tag not in VOID and not (attributes and self._unwanted(tag, attributes, up)):
                pass
            elif tag not in VOID:
                self.stack.append(_Node(tag, up.path, up.key, up.main, up.in_main, True,
                                        len(self.blocks)))
                return
            if tag not in VOID:
                self.stack.append(_Node(tag, up.path, up.key, up.main, up.in_main, up.skip,
                                        len(self.blocks)))
            return
        self._flush()
        for above in reversed(self.stack):
            if above.tag not in INLINE:
                above.layout = (above.layout * _BASE + _hash(tag)) & _MASK
                break
        if tag in VOID:
            return
        style = tag
        if attributes and (names := re.search(r"\bclass\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)",
                                              attributes, re.I)):
            style += "." + ".".join(sorted(names[1].strip("\"'").split()))
        path = _hash(f"{up.path}/{style}")
        key = self._key(path)
        skip = (up.skip or tag in NO_TEXT or (tag == "header" and not up.in_main)
                or key in self.removed
                or bool(attributes) and self._unwanted(tag, attributes, up))
        node = _Node(tag, path, key, up.main, up.in_main or (tag in MAIN and not skip), skip,
                     len(self.blocks))
        if tag in MAIN and not skip:
            node.main = node
        if not skip:
            self.nodes.append(node)
        self.stack.append(node)

    def _unwanted(self, tag: str, attributes: str, up: _Node) -> bool:
        for found in _NAMES.finditer(attributes):
            name, value = found[1].lower(), (found[2] or "").strip("\"'")
            if name == "hidden" and not value or name == "role" and value.lower() in NO_ROLE:
                return True
            if name in ("class", "id"):
                names = {n for token in value.split() for n in told(token)}
                if names & (NO_STORY if tag in MAIN else NO_CLASS):
                    return True
                if "header" in names and tag not in MAIN and not up.in_main:
                    return True
        return False

    def text(self) -> str:
        """The main text: of articles and main parts, or of the page if these hold less
        than half of it."""
        inside = [t for t, main in self.blocks if main]
        if 2 * sum(map(len, inside)) < sum(len(t) for t, _ in self.blocks):
            inside = [t for t, _ in self.blocks]
        return "\n\n".join(inside)

    def branches(self) -> Iterator[tuple[int, int, int, int]]:
        """(node, main node, layout, content) of main parts and containers that have text."""
        sums, powers = [0], [1]
        for text, _ in self.blocks:
            sums.append((sums[-1] * _BASE + _hash(text)) % _MASK)
            powers.append(powers[-1] * _BASE % _MASK)
        for node in self.nodes:
            if node.end > node.first and (node.tag in CONTAINERS or node is node.main):
                content = (sums[node.end] - sums[node.first] * powers[node.end - node.first]) % _MASK
                yield node.key, node.main.key, _signed(node.layout), content


def _nodes(pages: DataFrame) -> DataFrame:
    """(page, node, main, layout, content) of the columns page, url, html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(page, *branch) for page, url, html in zip(
                        *(batch.column(c).to_pylist() for c in ("page", "url", "html")),
                        strict=True)
                    for branch in Page(html, url).branches()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["page", "node", "main", "layout", "content"])

    return pages.select("page", "url", "html").mapInArrow(
        run, "page bigint, node bigint, main bigint, layout bigint, content bigint")


def unimportant(nodes: DataFrame) -> DataFrame:
    """Nodes (of all hosts' trees) that are to be removed from the pages."""

    def entropy(column: str) -> DataFrame:
        counts = nodes.groupBy("node", "main", column).agg(F.count("*").alias("c"))
        return counts.groupBy("node", "main").agg(
            F.sum("c").alias("seen"), F.sum(F.expr("c * ln(c)")).alias("same")
        ).selectExpr("node", "main", "seen",
                     f"IF(seen > 1, 1 - same / (seen * ln(seen)), 1D) AS {column}_entropy")

    rows = entropy("layout").join(entropy("content").drop("seen"), ["node", "main"]).selectExpr(
        "node", "main", "seen",
        f"{PRESENTATION} * layout_entropy + {1 - PRESENTATION} * content_entropy AS importance")
    mains = rows.where("node = main").selectExpr("main", "importance AS whole")
    return rows.where("node <> main").join(mains, "main").where(
        f"seen >= {LEAST_SEEN} AND importance < {LEAST_SHARE} * whole").select("node").distinct()


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """Per page its id, url, main text and the text's number of code points.

    A null html is empty.  Pages without url are of one host without name.
    Repeated rows stay; pages are read whole, at any length; of equally important nodes none
    is preferred; an empty table stays empty; other columns are not read.
    """
    bounded(pages.sparkSession)
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"))
    # What is removed from a page depends on url and html alone.
    rows = rows.withColumn("page", F.xxhash64("url", "html"))
    nodes = stored(_nodes(rows), "nodes")
    noise = stored(unimportant(nodes), "noise")
    removed = stored(nodes.join(noise, "node").groupBy("page").agg(
        F.collect_set("node").alias("removed")), "removed")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [Page(h, u, frozenset(r or ())).text() for u, h, r in zip(
                *(batch.column(c).to_pylist() for c in ("url", "html", "removed")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(made, pa.string()),
                 pa.array([len(t) for t in made], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    # The written table's size is known: the planner broadcasts it only if it is small.
    joined = rows.join(removed, "page", "left").select("page_id", "url", "html", "removed")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
