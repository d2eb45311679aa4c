"""Main text of web pages by a site style tree.

Pages of a host are merged into one tree whose nodes are tag paths (tag, id and class names,
digits folded).  A node's presentation importance is the entropy of the styles (sequences of
child tags) that its pages use; a leaf's content importance falls with the share of pages on
which the same content appears there.  A branch whose nodes are all below ``IMPORTANCE`` is noise
and is cut from every page of the host.  Pages with the same body count once, so that copies
of an article don't look like a template, and a node is judged only where ``PAGES`` different
pages have it.

Entropy alone can't cut menus, adverts and footers whose words differ from page to page (as
in the given pages).  Markup comes first: elements that HTML or their names mark as menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles or comments are always cut,
and of a page with an article (or main) only that is read.  A name alone cuts no element that
holds an article or main, and in an article no ``header``, which is its heading.  The tree then
judges what remains of every page, in articles too: by-lines, boxes and closing lines that a
host repeats there are cut.  Three rules keep it from cutting an article that pages share: pages
with the same article count once, plain inline elements of an article belong to their block, and
neither a heading by itself nor a whole article is noise.

Each page is parsed where it is read, once for the tree and once for its text; only hashes of
nodes are shuffled, pre-aggregated, and the noise nodes of a host come back as one row whose size
is bounded by the host's template (it holds tag paths, not contents).

Defined cases: null or empty html has empty text; unclosed and stray tags are tolerated;
character references are decoded; white space in a block becomes one space; a page without
article or main uses its whole body; a null url is a host of its own; repeated rows each get
their row; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts
from .url_graph import host_of

IMPORTANCE, PAGES = 0.2, 5
#: Deeper elements count as part of their ancestor at this depth.
DEPTH = 40

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
CUT_TAGS = frozenset("nav footer aside form script style noscript template iframe textarea button "
                     "select svg math object head dialog menu".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                      "menu menubar".split())
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer header "
    "masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "subscription signup login form comment comments commentlist disqus respond replies share "
    "sharing social related recommended widget widgets pagination pager toolbar skip".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset "
                   "figcaption figure footer h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
#: An opening tag closes these open elements first (up to the tags in the second set).
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CONTENT = ("article", "main", "body")

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|href|src)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
_HEADING = re.compile(r"h[1-6](?![a-z0-9])")
_HEAD = re.compile(r"/head(?![a-z0-9-])")
_END_RAW = {t: re.compile(rf"</{t}\s*>|\Z", re.I) for t in RAW}


class Node:
    """An open element: its tag path, whether markup cuts it, and the content it belongs to."""

    __slots__ = ("tag", "path", "cut", "named", "content", "children", "links")

    def __init__(self, tag: str, path: str, cut: bool, content: int, named: tuple = ()):
        self.tag, self.path, self.cut, self.content = tag, path, cut, content
        #: Elements outside articles, from the root to this one, that only their names cut: [cut].
        self.named = named
        self.children: list[str] = []
        self.links: list[str] = []


class Block:
    """A run of text between block borders: text, path of its element, and its place."""

    __slots__ = ("text", "path", "hard", "named", "content")

    def __init__(self, text: str, node: Node):
        self.text, self.path, self.hard, self.content = text, node.path, node.cut, node.content
        self.named = node.named

    @property
    def cut(self) -> bool:
        return self.hard or any(own[0] for own in self.named)


def _names(attributes: str) -> tuple[set[str], str, str, str]:
    """Words of class and id, the label for the path, the role, and the link target."""
    words, label, role, target = set(), "", "", ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            role = value.lower()
        elif name in ("href", "src"):
            target = value
        else:
            words.update(_SPLIT.split(_CAMEL.sub("-", value).lower()))
            label += ("." if name == "class" else "#") + _DIGITS.sub("0", value.lower())
    return words, label, role, target


def parse(html: str) -> tuple[list[Block], dict[str, tuple[str, str]]]:
    """Text blocks in page order, and per tag path its style and its content (for the tree)."""
    root = Node("", "", False, len(CONTENT))
    stack, blocks, buffer = [root], [], []
    styles: dict[str, list[str]] = {}
    contents: dict[str, list[str]] = {}

    def flush():
        if buffer:
            text = " ".join(unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                blocks.append(Block(text, stack[-1]))
                contents.setdefault(stack[-1].path, []).append(text)

    def close(count: int):
        for _ in range(count):
            node = stack[-1]
            if node.tag in BLOCKS or node.cut or node.named:
                flush()
            styles.setdefault(node.path, []).extend(node.children)
            contents.setdefault(node.path, []).extend(node.links)
            stack.pop()

    def close_through(tags, borders) -> None:
        for up, node in enumerate(reversed(stack[1:]), 1):
            if node.tag in borders:
                return
            if node.tag in tags:
                close(up)
                return

    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.match(html, at)
        if token is None:                                 # an unfinished tag is text
            buffer.append(html[at])
            at += 1
            continue
        at = token.end()
        slash, tag, attributes, text = token.groups()
        if text is not None:
            buffer.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag == "br":
                buffer.append(" ")
            elif any(node.tag == tag for node in stack[1:]):
                close_through({tag}, ())
            elif tag == "p":
                flush()
            continue
        if tag in BLOCKS:
            flush()
            close_through({"p"}, {"button", "table", "td", "th", "li", "div", "article", "section"})
        if tag in CLOSES:
            close_through(*CLOSES[tag])
        words, label, role, target = _names(attributes) if attributes else (set(), "", "", "")
        parent = stack[-1]
        parent.children.append(tag)
        if tag in VOID:
            if tag == "br":
                buffer.append(" ")
            elif tag == "img" and target:
                parent.links.append(target)
            continue
        content = min(parent.content, CONTENT.index(tag) if tag in CONTENT else len(CONTENT))
        in_article = parent.content < 2
        cut = parent.cut or tag in CUT_TAGS or role in CUT_ROLES or (
            tag == "header" and not in_article)
        names = words & (CUT_NAMES - {"header"} if in_article else CUT_NAMES)
        by_name = (tag not in ("html", "body", "main") and (tag != "article" or "comment" in words)
                   and bool(names))
        named = parent.named
        if by_name and (in_article or tag == "article"):
            cut = True
        elif by_name and not cut:
            flush()
            named = (*named, [True])
        if tag in ("article", "main") and not cut:
            for own in named:                             # wrappers of an article aren't cut
                own[0] = False
        if cut and not parent.cut:
            flush()
        inline = in_article and tag not in BLOCKS and not label
        path = parent.path if inline or len(stack) > DEPTH else f"{parent.path}/{tag}{label}"
        node = Node(tag, path, cut, content, named)
        if target:
            node.links.append(target)
        if tag in RAW:
            end = _END_RAW[tag].search(html, at)
            at = end.end()
            styles.setdefault(path, [])
            continue
        if not attributes.rstrip().endswith("/") or tag in BLOCKS:
            stack.append(node)
    flush()
    close(len(stack))
    return blocks, {path: (" ".join(styles[path]), "\n".join(contents.get(path, ())))
                    for path in styles if path}


def _marked(blocks: list[Block]) -> list[Block]:
    """The blocks that markup leaves: those of the articles, or else of main, or else all."""
    kept = [b for b in blocks if not b.cut]
    best = min((b.content for b in kept), default=len(CONTENT))
    return [b for b in kept if b.content == best] if best < 2 else kept


def main_text(html: str, noise: frozenset[str] = frozenset()) -> str:
    """The page's blocks that neither markup nor the host's tree cuts."""
    kept = _marked(parse(html)[0])
    if noise:
        own = [b for b in kept if not _noise(b, noise)]
        if own or not (kept and kept[0].content < 2):     # a whole article is no template
            kept = own
    return "\n\n".join(b.text for b in kept)


def _noise(block: Block, noise: frozenset[str]) -> bool:
    """Whether the tree cuts the block; an article's heading goes only with what holds it."""
    above, _, tag = block.path.rpartition("/")
    return _under(above if block.content < 2 and _HEADING.match(tag) else block.path, noise)


def _under(path: str, noise: frozenset[str]) -> bool:
    """Whether the path, or one above it, is a noise node."""
    parts = path.split("/")
    return any("/".join(parts[:i]) in noise for i in range(2, len(parts) + 1))


# --- the tree in Spark --------------------------------------------------------------------

def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, page, style, content): the nodes of every page, hashed.

    A page is known by the text that markup leaves of it.
    """
    def mark(s: str) -> int:
        return xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) - (1 << 63)

    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [], [])
        for host, html in zip(batch.column("host").to_pylist(), texts(batch.column("html"))):
            blocks, nodes = parse(html)
            own = _marked(blocks)
            page = mark("\n".join(b.text for b in (own if own and own[0].content < 2 else blocks)))
            for path, (style, content) in nodes.items():
                if _HEAD.search(path):
                    continue
                for column, value in zip(out, (host, path, page, mark(style), mark(content))):
                    column.append(value)
        yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                               *[pa.array(c, pa.int64()) for c in out[2:]]],
                              ["host", "path", "page", "style", "content"])


def importance(pages: DataFrame) -> DataFrame:
    """(host, path, n, importance) of every node: the greatest over its branch.

    Both entropies come from counts that add up: with n pages and counts c of its styles,
    the style entropy to base n is 1 - sum(c log c) / (n log n); the content importance of a leaf
    is 1 - mean(log c / log n) over its different contents.
    """
    nodes = (pages.select(F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), "html")
             .mapInArrow(_nodes, "host string, path string, page long, style long, content long")
             .distinct())
    kinds = nodes.select("host", "path", F.explode(F.array(
        F.struct(F.lit("style").alias("kind"), F.col("style").alias("mark")),
        F.struct(F.lit("content").alias("kind"), F.col("content").alias("mark")))).alias("k"))
    counts = (kinds.groupBy("host", "path", "k.kind", "k.mark").agg(F.count(F.lit(1)).alias("c")))
    is_style = F.col("kind") == "style"
    sums = counts.groupBy("host", "path").agg(
        F.sum(F.when(is_style, F.col("c"))).alias("n"),
        F.sum(F.when(is_style, F.col("c") * F.log("c"))).alias("style"),
        F.sum(F.when(~is_style, F.log("c"))).alias("content"),
        F.count(F.when(~is_style, 1)).alias("contents"))
    log_n = F.log("n")
    own = F.when(F.col("n") == 1, 1.0).otherwise(F.greatest(
        1 - F.col("style") / (F.col("n") * log_n), 1 - F.col("content") / F.col("contents") / log_n))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.size(parts)),
                        lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return (sums.select("host", "n", own.alias("own"), "path", F.explode(above).alias("branch"))
            .groupBy("host", F.col("branch").alias("path"))
            .agg(F.max(F.when(F.col("path") == F.col("branch"), F.col("n"))).alias("n"),
                 F.max("own").alias("importance")))


def noise_nodes(pages: DataFrame, least: float = IMPORTANCE, least_pages: int = PAGES) -> DataFrame:
    """(host, noise): the tag paths to cut from a host's pages.

    A noise path needs ``least_pages`` pages, and only its template can repeat it.
    """
    return (importance(pages).filter((F.col("importance") < least) & (F.col("n") >= least_pages))
            .groupBy("host").agg(F.collect_list("path").alias("noise")))


def extract(pages: DataFrame, least: float = IMPORTANCE, least_pages: int = PAGES) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""
    noise = stored(noise_nodes(pages, least, least_pages), "noise")

    @F.arrow_udf("string")
    def text_of(html: pa.Array, cut: pa.Array) -> pa.Array:
        return pa.array([main_text(h, frozenset(c or ())) for h, c in
                         zip(texts(html), cut.to_pylist())], pa.string())

    return (pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
            .join(noise, "host", "left")
            .select("page_id", "url", text_of("html", "noise").alias("text")))


def digest(extracted: DataFrame) -> DataFrame:
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
