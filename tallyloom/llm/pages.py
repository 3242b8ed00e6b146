"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of style nodes: a node is the path
of elements and their class and id words from the body down. Counting, over all
pages of the host, how its content and its sequence of children vary gives each
node an importance from entropies: a node that says the same on most pages is
template, one that says something else each time is content. Branches of low
importance leave each page. Counts are aggregates by host and node, so a host
with very many pages is spread over its nodes and pre-aggregated.

The tree holds the whole page. A page that marks its article (article or main
element) is cut to it first; a mark only raises importance: the marked element
itself stays, its branches of low importance leave as on any other page, and an
article of which nothing would be left stays whole. Elements that are something
else by their kind (menus, forms, ...) leave too, and so do those with a name
that says so, unless they hold the page's largest article or most of its text.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.rows import field, in_small_batches, own_name
from tallyloom.session import BROADCAST_ROWS, saved

# Elements by their role on a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
SKIP = RAW | frozenset("head nav header footer aside form menu dialog button select option object canvas audio video map input".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul caption""".split())
CLOSES_P = BLOCKS - {"body", "html"}
# An open element that a new one of the same family ends, up to a border.
SELF_CLOSING = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
                "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
                "option": (("option",), ("select",))}
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising advertorial banner banners sponsor sponsored sponsors promo
    promotion promos menu menus nav navbar navigation navi breadcrumb breadcrumbs pagination pager topbar toolbar header masthead footer
    sidebar sidebars aside widget widgets notice notices cookie cookies consent gdpr popup modal overlay alert newsletter subscribe
    subscription signup login share sharing social related recommended recommendations comment comments commentlist respond reply
    replies disqus discussion search form disclaimer copyright legal""".split())
# Names of reader comments, which may be marked as articles themselves.
COMMENT_WORDS = frozenset("comment comments commentlist respond reply replies disqus discussion".split())
# Names that tell no main text even for a paragraph or a heading; first parts of compound names that tell nothing.
TEXT_NOISE = frozenset("""ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos
    breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr newsletter copyright""".split())
NEUTRAL = frozenset("""with has no without not is cat category tag post article entry content page main story single format type
    status template""".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote td th dt dd figcaption caption".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
MAIN = frozenset(("article", "main"))

MARK = re.compile(r"<(?=[!?/a-zA-Z])")
OTHER = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
# A quoted value may hold ">"; the group takes what it can and gives nothing back, so a tag is read once.
TAG = re.compile(OTHER + r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+)>""", re.S)
PLAIN_TAG = re.compile(OTHER + r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ENDS_RAW = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|[\s"'])(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true)""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Settings of the tree.
LEAST_PAGES, LOW = 8, 0.2
# An odd number and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 2**64)


class Node:
    __slots__ = ("tag", "path", "noise", "named", "main", "children", "depth")

    def __init__(self, tag: str, path: int, noise: bool, named: str, depth: int) -> None:
        # ``named`` is "" or says what kind of noise the names suggest; it counts only where ``_judge_names`` lets it.
        self.tag, self.path, self.noise, self.named, self.main, self.depth = tag, path, noise, named, tag in MAIN, depth
        self.children: list = []


def _suggested(token: str, tag: str) -> str:
    """What a class or id says: "comment", "noise" or nothing. A compound name goes by its last part."""
    parts = [w.lower() for w in PARTS.findall(token)] or [token.lower()]
    last = token.lower() if token.lower() in NOISE_WORDS else parts[-1]
    if last not in NOISE_WORDS or len(parts) > 1 and parts[0] in NEUTRAL:
        return ""
    if tag in TEXT_TAGS and last not in TEXT_NOISE:
        return ""
    return "comment" if last in COMMENT_WORDS else "noise"


def _named(attributes: str, tag: str) -> tuple[str, bool, str]:
    """The style of an element (tag, class and id words), whether its kind is no main text, and what its names suggest."""
    noise, suggested = tag in SKIP, ""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag, noise or bool(attributes and HIDDEN.search(attributes)), ""
    words: list[str] = []
    for name, *values in NAMED.findall(attributes):
        value = next((v for v in values if v), "")
        if name.lower() == "role":
            noise |= value.lower() in ROLES
        else:
            words += [w.lower() for w in PARTS.findall(value)]
            for token in value.split():
                said = _suggested(token, tag)
                suggested = said if said == "comment" or not suggested else suggested
    noise |= bool(HIDDEN.search(attributes))
    return f"{tag}.{'.'.join(w for w in words if not w.isdigit())}", noise, suggested


def _judge_names(root: Node) -> None:
    """Names that suggest noise make it so, but not on an element with the largest article or most of the text.

    Reader comments leave whatever they hold.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.noise]
    if not any(node.named for node in order):
        return
    size: dict[int, int] = {}
    article: dict[int, int] = {}
    for node in reversed(order):
        if node.named == "comment":
            node.noise = True
        inner = [c for c in node.children if isinstance(c, Node) and not c.noise]
        size[id(node)] = 0 if node.noise else sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(size[id(c)] for c in inner)
        article[id(node)] = 0 if node.noise else max([size[id(node)] if node.main else 0, *(article[id(c)] for c in inner)])
    whole, largest = size[id(root)], article[id(root)]
    for node in order:
        if node.named == "noise" and not (2 * size[id(node)] > whole or largest and article[id(node)] == largest):
            node.noise = True


def parse(page: str) -> Node:
    """The tree of a page. Unclosed and stray tags are taken the way browsers commonly do.

    Every step is done once: open elements are found by their tag, and a tag
    whose quotes never close makes quotes count for nothing from there on.
    """
    root = Node("body", xxhash.xxh3_64_intdigest(b"body"), False, "", 0)
    at, end, pattern = 0, len(page), TAG
    stack: list[Node] = [root]
    opened: dict[str, list[int]] = {}
    blocks: list[Node] = []

    def close(depth: int) -> None:
        """Closes every element of this depth or deeper."""
        while len(stack) > depth:
            node = stack.pop()
            opened[node.tag].pop()
            if node.tag in BLOCKS:
                blocks.pop()

    while at < end:
        mark = MARK.search(page, at)
        if mark is None:
            stack[-1].children.append(page[at:])
            break
        found = pattern.match(page, mark.start())
        if found is None and pattern is TAG:
            pattern = PLAIN_TAG
            found = pattern.match(page, mark.start())
        if found is None:
            if page.find(">", mark.start()) < 0:
                stack[-1].children.append(page[at:])
                break
            # "</" without a name.
            stack[-1].children.append(page[at:mark.end()])
            at = mark.end()
            continue
        if found.start() > at:
            stack[-1].children.append(page[at:found.start()])
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if found.group(1):
            depths = opened.get(tag)
            # A stray end tag does not leave the table cell, item or section it stands in.
            if depths and (tag in BLOCKS or not blocks or blocks[-1].depth <= depths[-1]):
                close(depths[-1])
            continue
        if tag in ("html", "body"):
            continue
        if tag in RAW:
            # What these hold is no markup of the page.
            if not found.group(0).endswith("/>") or tag in ("script", "style", "title", "textarea"):
                stop = ENDS_RAW[tag].search(page, at)
                at = end if stop is None else stop.start()
            continue
        if tag in CLOSES_P and blocks and blocks[-1].tag == "p":
            close(blocks[-1].depth)
        if tag in SELF_CLOSING:
            ends, borders = SELF_CLOSING[tag]
            border = max((opened[b][-1] for b in borders if opened.get(b)), default=0)
            inside = [d for e in ends for d in _deeper(opened.get(e, ()), border)]
            if inside:
                close(min(inside))
        here = stack[-1]
        style, noise, named = _named(found.group(3), tag)
        node = Node(tag, xxhash.xxh3_64_intdigest(f"{here.path}>{style}".encode()), noise, named, len(stack))
        here.children.append(node)
        if tag not in VOID and not found.group(3).rstrip().endswith("/"):
            stack.append(node)
            opened.setdefault(tag, []).append(node.depth)
            if tag in BLOCKS:
                blocks.append(node)
    _judge_names(root)
    return root


def _deeper(depths, border: int):
    """The depths below the border, the deepest first; all of them are closed, so no depth is looked at twice."""
    for depth in reversed(depths):
        if depth <= border:
            return
        yield depth


def _blocks(top: Node, low: frozenset | set, out: list[str], line: list[str], spans: list | None = None) -> None:
    """Adds the blocks of ``top`` in page order; no recursion, pages may nest deeply.

    ``spans`` gets (node, start, end) of each block element below: its blocks are out[start:end].
    """
    stack: list = [iter(top.children)]
    owner: list[Node] = [top]
    starts: list[int] = [0]

    def finish() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        if text:
            out.append(text)
        line.clear()

    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            node, start = owner.pop(), starts.pop()
            if node.tag in BLOCKS:
                finish()
                if spans is not None and node is not top:
                    spans.append((node, start, len(out)))
        elif isinstance(child, str):
            line.append(child)
        elif child.tag in ("br", "wbr", "img", "hr"):
            if child.tag == "hr":
                finish()
            elif child.tag == "br":
                line.append(" ")
        elif child.noise or child.path in low and not child.main:
            if child.tag in BLOCKS or child.tag in SKIP:
                finish()
        else:
            if child.tag in BLOCKS:
                finish()
            stack.append(iter(child.children))
            owner.append(child)
            starts.append(len(out))
    finish()


def _roots(top: Node) -> list[Node]:
    """The outermost article and main elements that are not noise; an article inside main counts as main's."""
    found, stack = [], [top]
    while stack:
        node = stack.pop()
        if node.main:
            found.append(node)
            continue
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.noise]
    return found


def _narrowed(root: Node) -> Node:
    """A main element that holds exactly one article is narrowed to it."""
    if root.tag == "main":
        inner = [n for child in root.children if isinstance(child, Node) and not child.noise for n in _roots(child) if n.tag == "article"]
        if len(inner) == 1:
            return inner[0]
    return root


def main_text(page: str | None, low: frozenset | set = frozenset()) -> str:
    """Blocks of the main text joined by line feeds; ``low``: paths of low importance on this host."""
    top = parse(page or "")
    roots, out = [_narrowed(r) for r in _roots(top)], []
    # The article less its low branches, else all of it, else the page.
    for parts, away in ((roots, low), (roots, frozenset()), ([top], low)):
        for part in parts:
            _blocks(part, away, out, [])
        if out:
            break
    return "\n".join(out)


def style_nodes(page: str | None) -> list[tuple[int, int, int, int]]:
    """(path, content, children, first) of the block elements outside noise, marked articles included.

    Siblings of one style are one node with several contents; each different
    one is listed once, ``first`` is 1 once per node and page.
    """
    rows: dict[tuple[int, int, int], int] = {}
    seen, out, spans = set(), [], []
    _blocks(parse(page or ""), frozenset(), out, [], spans)
    # A polynomial over the hashes of the blocks names any stretch of them, so nested elements are not read again.
    named, power = [0], 1
    for block in out:
        named.append((named[-1] + xxhash.xxh3_64_intdigest(block.encode()) * power) % 2**64)
        power = power * BASE % 2**64
    for node, start, end in spans:
        shape = ",".join(str(c.path) for c in node.children if isinstance(c, Node))
        content = (named[end] - named[start]) * pow(UNBASE, start, 2**64) % 2**64
        row = (node.path, content, xxhash.xxh3_64_intdigest(shape.encode()))
        if row not in rows:
            rows[row] = int(node.path not in seen)
            seen.add(node.path)
    return [(*row, first) for row, first in rows.items()]


def _styled(batches):
    for batch in batches:
        hosts, rows = [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = style_nodes(page)
            hosts += [host] * len(found)
            rows += found
        table = np.array(rows, dtype=np.uint64).reshape(len(rows), 4)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), *(pa.array(np.ascontiguousarray(table[:, k]).view(np.int64), pa.int64()) for k in range(4))],
            names=["host", "path", "content", "shape", "first"])


def _texts(keep: int):
    def run(batches):
        for batch in batches:
            texts = [main_text(page, frozenset(p & 0xFFFFFFFFFFFFFFFF for p in low) if low else frozenset())
                     for page, low in zip(batch.column(keep).to_pylist(), batch.column(keep + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(texts, pa.string())], names=[*batch.schema.names[:keep], "main"])

    return run


def host_of(url):
    """Host of a url in lower case, empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def low_branches(pages: DataFrame, url: str = "url", page: str = "html", least: int = LEAST_PAGES, low: float = LOW) -> DataFrame:
    """(host, path): style nodes of low importance.

    With m pages of a host that have the node, a content found on c of them has
    the entropy log_m(c); the content importance is one minus the mean over the
    different contents. The presentation importance is the entropy, to base m,
    of the sequences of children. A node counts as low when both are. Nodes on
    fewer than ``least`` pages are never low.
    """
    rows = pages.select(host_of(field(pages, url)).alias("host"), field(pages, page).alias("page")).where("host <> ''")
    nodes = in_small_batches(rows).mapInArrow(_styled, "host string, path long, content long, shape long, first long")
    counted = saved(nodes.groupBy("host", "path", "content", "shape").agg(F.count("*").alias("n"), F.sum("first").alias("first")), "nodes")
    total = counted.groupBy("host", "path").agg(F.sum("first").alias("m"), F.sum("n").alias("all")).where(F.col("m") >= least)

    def each(name: str) -> DataFrame:
        # Many contents of one node become counts of counts before they meet in a task.
        one = counted.groupBy("host", "path", name).agg(F.sum("n").alias("c"))
        return one.groupBy("host", "path", "c").agg(F.count("*").alias("k")).join(total, ["host", "path"])

    share = F.col("c") / F.col("all")
    content = each("content").groupBy("host", "path").agg(
        (1 - F.sum(F.col("k") * F.ln(F.least("c", "m")) / F.ln("m")) / F.sum("k")).alias("content_importance"))
    shape = each("shape").groupBy("host", "path").agg(F.sum(-F.col("k") * share * F.ln(share) / F.ln("m")).alias("shape_importance"))
    return content.join(shape, ["host", "path"]).where((F.col("content_importance") < low) & (F.col("shape_importance") < low)).select("host", "path")


def extract_text(pages: DataFrame, url: str = "url", page: str = "html", into: str = "text", keep: tuple[str, ...] = ("page_id", "url"),
                 least: int = LEAST_PAGES, low: float = LOW) -> DataFrame:
    """The columns ``keep`` and ``into``: the main text of each page.

    Character references are decoded, white space inside a block becomes one
    blank, blocks follow each other by line feeds. Null and empty pages have
    the empty text. A null url belongs to no host; its page is judged by kinds
    and names alone. Repeated rows agree; columns that are not kept are
    ignored; an empty table gives none.
    """
    found = saved(low_branches(pages, url, page, least, low), "low")
    by_host = saved(found.groupBy("host").agg(F.collect_set("path").alias("low")), "hosts")
    # At most BROADCAST_ROWS paths of eight bytes are broadcast; beyond, the join shuffles and a large host is split.
    few = found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    host = own_name(pages, "page_host")
    rows = pages.select(*[field(pages, c).alias(f"k{i}") for i, c in enumerate(keep)], field(pages, page).alias("page"), host_of(field(pages, url)).alias(host))
    joined = rows.join(F.broadcast(by_host) if few else by_host, rows[host] == by_host["host"], "left").select(
        *[f"k{i}" for i in range(len(keep))], "page", "low")
    kinds = dict(pages.dtypes)
    schema = ", ".join([f"k{i} {kinds[c]}" for i, c in enumerate(keep)] + ["main string"])
    return joined.mapInArrow(_texts(len(keep)), schema).toDF(*keep, into)
