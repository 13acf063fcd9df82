"""Main text of web pages, with a style tree per site.

The pages of a host are merged into one tree of styles: a node is a path of
elements with their classes. The content of a node is a set of features (text
blocks); a feature on d of the site's m pages has entropy log d / log m, and a
node's importance is one minus the mean entropy of its features: near 0 where
all pages say the same, 1 where every page says something else. For inner nodes the variety
of their child sequences (presentation) counts beside that of their content.
Pages that say the same, menus and the like aside, count once. Branches of low importance are removed from each page,
but not from an article, and not from a main element that would be left empty,
besides what names itself as menu, form, advert, comment and the like. A name is a whole class, id or role; where
branches so named hold much of a page's text, they go only if their importance is low too.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ledgerlight.llm.storage import Workspace, map_batches
from ledgerlight.llm.url_filters import host_of

# Elements of HTML by their role here.
RAW = {"script", "style", "textarea", "title", "xmp", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "object", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr",
    # formulas and drawings
    "math", "mfrac", "mi", "mn", "mo", "mover", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup",
    "mtext", "munder", "munderover", "semantics", "circle", "defs", "ellipse", "g", "line", "path", "polygon", "polyline",
    "rect", "svg", "text", "tspan", "use",
}
SKIPPED = {
    "head", "nav", "footer", "aside", "form", "noscript", "template", "iframe", "button", "select", "option",
    "dialog", "menu", "canvas", "audio", "video",
}
CONTENT = {"article": 2, "main": 1}  # bits
UNNAMED = {"html", "body", "main"}  # names on these, and on an article that is not inside another, say nothing
CLOSED_BY_ITSELF = {"p", "li", "td", "th", "tr", "dt", "dd", "option"}
# Words that name a part as something else than main text.
NOISE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
    "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead",
    "comment", "comments", "respond", "disqus", "cookie", "cookies", "consent", "notice", "popup", "modal", "newsletter",
    "subscribe", "share", "sharing", "social", "related", "widget", "pagination", "pager", "skip", "toolbar",
}
# Inside of main content these may name a part of it.
OUTSIDE_ONLY = {"related", "share", "sharing", "social", "toolbar", "widget"}
# Articles outside of a main element with less than this share of a page's text are teasers among other things.
LEAST_CONTENT = 1 / 3
# Elements deeper than this, and the rest of longer styles, are no nodes of their own in the style tree.
DEEPEST, LONGEST_STYLE = 48, 100
MUCH = 0.5  # share of a page's text that a name alone does not remove

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")

NODES = "host string, page long, path string, kind byte, feature long"


class _Element:
    __slots__ = ("children", "content", "named", "noise", "path", "tag")

    def __init__(self, tag: str, path: str, noise: bool, content: int, named: tuple[str, ...]) -> None:
        self.tag, self.path, self.noise, self.content, self.named = tag, path, noise, content, named
        self.children: dict[str, None] = {}  # different styles in page order


def _says_noise(names: list[str], content: int) -> bool:
    """Whether a whole name is made of noise words; a header inside the content is its title."""
    for name in (x for value in names for x in value.split()):
        words = set(_WORDS.findall(name))
        if words and words <= NOISE_WORDS and not (content and words <= {"header", *OUTSIDE_ONLY}):
            return True
    return False


def page_blocks(html: str) -> tuple[list[tuple[str, str, int, bool, tuple[str, ...]]], list[tuple[str, str]]]:
    """Text blocks in page order as (path, text, bits: 1 in a main element, 2 in an article; in an element that is
    no text, paths of the branches around it that name themselves noise), and the child sequence of each inner element."""
    blocks: list[tuple[str, str, int, bool, tuple[str, ...]]] = []
    shapes: list[tuple[str, str]] = []
    stack = [_Element("", "", False, 0, ())]
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = "".join(parts)
            parts.clear()
            if text.strip():
                top = stack[-1]
                blocks.append((top.path, text, top.content, top.noise, top.named))

    def close(depth: int) -> None:
        while len(stack) > depth:
            gone = stack.pop()
            if gone.children:
                shapes.append((gone.path, " ".join(gone.children)))

    at, n = 0, len(html)
    while at < n:
        found = _TOKEN.search(html, at)
        if not found:
            parts.append(html[at:])
            break
        if found.start() > at:
            parts.append(html[at : found.start()])
        at = found.end()
        end, tag, rest = found[1], found[2], found[3]
        if tag is None:
            end, tag, rest = found[4], found[5], found[6]
            if tag is None:
                continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        if end:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = closing.end() if closing else n
            continue
        if tag in VOID:
            continue
        if stack[-1].tag == "p" or (stack[-1].tag == tag and tag in CLOSED_BY_ITSELF):
            close(len(stack) - 1)
        if tag == "body":  # a head that is not closed
            close(next((d for d, e in enumerate(stack) if e.tag == "head"), len(stack)))
        names = [m[2].strip("\"'").lower() for m in _NAMES.finditer(rest)] if "=" in rest else []
        parent = stack[-1]
        style = ".".join([tag, *(_DIGITS.sub("0", x) for x in names)])[:LONGEST_STYLE]
        parent.children[style] = None
        path = f"{parent.path}/{style}" if len(stack) <= DEEPEST else parent.path
        if tag in CONTENT:
            content, noise = parent.content | CONTENT[tag], False
        else:
            content = parent.content
            noise = parent.noise or tag in SKIPPED or (tag == "header" and not content)
        named = () if tag in UNNAMED else parent.named
        if names and tag not in UNNAMED and not (tag == "article" and parent.content < 2) and _says_noise(names, content) and path not in named:
            named = (*named, path)
        stack.append(_Element(tag, path, noise, content, named))
        if rest.endswith("/") and tag == "iframe":
            close(len(stack) - 1)
    flush()
    close(1)
    return blocks, shapes


def clean(text: str) -> str:
    return " ".join((entities.unescape(text) if "&" in text else text).split())


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _node_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, pages, paths, kinds, features = [], [], [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not html:
                continue
            blocks, shapes = page_blocks(html)
            page = _hash(text_of(blocks, set()))
            seen = {("", 2, 0)} | {(path, 0, _hash(text)) for path, text, *_ in blocks} | {(path, 1, _hash(shape)) for path, shape in shapes if shape}
            hosts += [host] * len(seen)
            pages += [page] * len(seen)
            for path, kind, feature in seen:
                paths.append(path)
                kinds.append(kind)
                features.append(feature)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(pages, pa.int64()), pa.array(paths, pa.string()),
             pa.array(kinds, pa.int8()), pa.array(features, pa.int64())],
            names=["host", "page", "path", "kind", "feature"],
        )


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Importance of each node of each host: ``(host, path, pages, importance)``."""
    rows = map_batches(pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")), _node_rows, NODES)
    # Pages that hold a feature; pages that say the same have the same number.
    held = rows.distinct().groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("d"))
    nodes = held.groupBy("host", "path", "kind").agg(
        F.sum("d").alias("n"), F.sum(F.col("d") * F.log("d")).alias("weighted"), F.max("d").alias("most")
    )
    nodes = Workspace(pages.sparkSession, "styles").write(nodes, "nodes")
    # The feature of kind 2 is one per page, so it counts the site's pages.
    site = nodes.where("kind = 2").groupBy("host").agg(F.max("n").alias("m"))
    sizes = nodes.groupBy("host").agg(F.max("most").alias("most")).join(site, "host", "left")
    sizes = sizes.select("host", F.greatest(F.coalesce("m", F.lit(1)), "most").alias("m"))
    depth = F.size(F.split("path", "/"))
    prefixes = F.transform(F.sequence(F.lit(2), depth), lambda i: F.array_join(F.slice(F.split("path", "/"), 1, i), "/"))
    content = (
        nodes.where("kind = 0 AND path <> ''")
        .withColumn("node", F.explode(prefixes))
        .groupBy("host", F.col("node").alias("path"))
        .agg(F.sum("n").alias("n"), F.sum("weighted").alias("weighted"))
    )
    shape = nodes.where("kind = 1").select("host", "path", F.col("n").alias("sn"), F.col("weighted").alias("sw"))
    entropy = F.when(F.col("m") > 1, F.col("weighted") / (F.col("n") * F.log("m"))).otherwise(0.0)
    # Presentation: the entropy of the mix of child sequences, log n - mean log d, against log m.
    presentation = F.when((F.col("m") > 1) & (F.col("sn") > 0), (F.log("sn") - F.col("sw") / F.col("sn")) / F.log("m"))
    joined = content.join(shape, ["host", "path"], "left").join(sizes, "host")
    importance = F.greatest(F.coalesce(presentation, F.lit(0.0)) * 0.5, 1.0 - entropy)
    return joined.select("host", "path", F.col("m").alias("pages"), importance.alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, noise in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            texts.append(main_text(html or "", set(noise or ())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])


def main_text(html: str, noise: set[str]) -> str:
    """The text of a page without noisy parts and without the branches in ``noise``."""
    return text_of(page_blocks(html)[0], noise)


def text_of(blocks: list[tuple[str, str, int, bool, tuple[str, ...]]], noise: set[str]) -> str:
    def dropped(path: str) -> bool:
        while path:
            if path in noise:
                return True
            path = path.rpartition("/")[0]
        return False

    kept = [b for b in blocks if not b[3]]
    sizes: dict[str, int] = {}
    for b in kept:
        for path in b[4]:
            sizes[path] = sizes.get(path, 0) + len(b[1].strip())
    much = MUCH * sum(len(b[1].strip()) for b in kept)
    gone = {path for path, size in sizes.items() if size <= much or dropped(path)}
    # Beside main content a name is enough.
    some_inside = any(b[2] for b in kept)
    kept = [b for b in kept if gone.isdisjoint(b[4]) and (b[2] or not some_inside or not b[4])]
    inside = [b for b in kept if b[2]]
    if any(b[2] & 1 for b in inside) or sum(len(b[1].strip()) for b in inside) >= LEAST_CONTENT * sum(len(b[1].strip()) for b in kept):
        kept = inside or kept
    if noise:
        left = [b for b in kept if b[2] >= 2 or not dropped(b[0])]
        # Main content stays whole where nothing else of it would be left.
        kept = left if any(b[2] for b in left) else [b for b in kept if b[2] or not dropped(b[0])]
    return "\n".join(t for t in (clean(text) for _, text, *_ in kept) if t)


# A list of this many noisy branches, all told, goes to every worker; a longer one is joined by host.
BROADCAST_ROWS = 200_000


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_importance: float = 0.2,
    least_pages: int = 5,
) -> DataFrame:
    """Per page: id, url and ``text``, its blocks joined by line feeds (empty if none).

    Where a page has a main element, or articles with a third of its text, only their text counts. A branch is removed where its host has
    at least ``least_pages`` different pages and its importance is below ``least_importance``; pages without a host are one site. Very deep pages cost in
    proportion to their length: elements beyond a fixed depth belong to the node above. Null or empty html has no text; a null url has an empty host; repeated
    rows give repeated results; other columns are ignored.
    """
    work = Workspace(pages.sparkSession, "extraction")
    low = style_tree(pages, url_col, html_col).where((F.col("importance") < least_importance) & (F.col("pages") >= least_pages))
    low = work.write(low.select("host", "path"), "noise")
    noise = low.groupBy("host").agg(F.collect_set("path").alias("noise"))
    if low.count() <= BROADCAST_ROWS:
        noise = F.broadcast(noise)
    own = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    own = own.withColumn("host", host_of(F.col("url"))).join(noise, "host", "left")
    return map_batches(own.select("id", "url", "html", "noise"), _extract, "id long, url string, text string").withColumnsRenamed({"id": id_col, "url": url_col})
