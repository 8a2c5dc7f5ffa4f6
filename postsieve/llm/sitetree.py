"""Main text of web pages by a site style tree.

The element trees of one host are merged: a node is a path of element styles (tag, class, id) from the body. For each node the
entropy of its contents and of its inner styles over the host's pages tells how much it varies. Branches that hardly vary are
furniture of the site and are cut from each page, as are elements that say themselves that they are none of the article, unless
they hold what the page marks as its article or nearly all of its text. The article itself, where a page marks it, is never cut
by its entropy: an article may be printed many times. For the same reason pages with one and the same article count once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import map_batches
from postsieve.session import cut_lineage

LOW, SEEN = 0.2, 5  # importance below which a branch goes, and distinct articles a node must have been seen with
NEARLY = 0.9  # share of the text that would be left from which an element is no furniture

TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z|[^>]*+>?)|<[!?/][^>]*+>?", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
GONE = frozenset(
    "script style title noscript template button select option textarea input iframe object embed svg math canvas audio video noembed noframes".split()
)
DOUBTED = frozenset("head nav footer aside form dialog menu".split())  # cut unless they turn out to hold the page's text
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img picture".split()
)
SILENT = frozenset("script style template noscript link meta input".split())  # neither seen nor breaking a line
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption".split())
ARTICLE = frozenset(("article", "main"))
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article main section div".split())
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement adsbygoogle banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs masthead footer"
    " sidebar cookie cookies consent gdpr notice notification popup modal newsletter subscribe subscription share sharing social related comment comments disqus"
    " respond replies login signup search widget toolbar pagination pager skip".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())


class Element:
    """An element: style path, whether it is cut, or doubted for what it says of itself, and its texts and inner elements in order."""

    __slots__ = ("cut", "doubted", "free", "holds", "inner", "marked", "path", "size", "style", "tag", "under")

    def __init__(self, tag: str, style: str, path: int, cut: bool, doubted: bool = False):
        self.tag, self.style, self.path, self.cut, self.doubted, self.inner = tag, style, path, cut, doubted, []
        self.holds = False  # an article is in here, or this is one


def parse(page: str) -> Element:
    """Element tree of a page: unclosed, crossed and stray tags are read as browsers read them, near enough for text."""
    root = Element("#", "", 0, False)
    stack, at = [root], 0
    while (m := TAG.search(page, at)) is not None:
        if m.start() > at:
            stack[-1].inner.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in ENDS_P:
            _end(stack, {"p"})
        if tag in SAME_ENDS:
            _end(stack, SAME_ENDS[tag])
        element = _element(tag, m[3], stack)
        stack[-1].inner.append(element)
        if tag in ARTICLE:
            for e in (*stack, element):
                e.holds = True
        if tag in RAW:
            end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            end_at = end.start() if end else len(page)
            if tag not in GONE:
                element.inner.append(page[at:end_at])
            at = end_at
            stack.append(element)
        elif tag not in VOID:
            stack.append(element)
    if at < len(page):
        stack[-1].inner.append(page[at:])
    settle(root)
    return root


def settle(root: Element) -> None:
    """Cut the doubted elements, but not one that is the page rather than its furniture.

    Kept are those that hold a main; those that hold an article, if no article is left outside of doubted elements and less
    text is; and those with at least half of the page's text and nearly all that would be left. Outer ones are settled before
    inner ones, so that a sidebar inside a kept wrapper still goes. Text in links counts a tenth.
    """
    order, todo = [], [(root, False)]
    while todo:
        e, linked = todo.pop()
        order.append((e, linked))
        todo.extend((x, linked or x.tag == "a") for x in e.inner if not isinstance(x, str) and not x.cut)
    for e, linked in reversed(order):
        e.size = e.under = 0  # text below, and that of it below doubted elements
        e.marked, e.free = set(), set()  # kinds of articles with text below, and those outside of doubted elements
        for x in e.inner:
            if isinstance(x, str):
                e.size += sum(map(len, x.split())) * (1 if linked else 10)
            elif not x.cut:
                e.size += x.size
                e.under += x.size if x.doubted else x.under
                e.marked |= x.marked
                e.free |= set() if x.doubted else x.free
        if e.tag in ARTICLE and e.size:
            e.marked.add(e.tag)
            if e.size > e.under:
                e.free.add(e.tag)
    left, free, kept = 0, set(), [root]
    while kept:
        left += sum(e.size - e.under for e in kept)
        free = free.union(*(e.free for e in kept))
        found, todo = [], kept
        while todo:
            inner = [x for x in todo.pop().inner if not isinstance(x, str) and not x.cut]
            found.extend(x for x in inner if x.doubted)
            todo.extend(x for x in inner if not x.doubted)
        for e in found:
            article = "article" in e.marked and "article" not in free and e.size >= left
            most = e.size > 0 and 2 * e.size >= root.size and e.size >= NEARLY * (e.size + left)
            e.cut = not ("main" in e.marked or article or most)
        kept = [e for e in found if not e.cut]


def _end(stack: list[Element], tags: set[str]) -> None:
    """Close the innermost open element of these tags, unless a container stands between."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in SCOPE:
            return


def _element(tag: str, raw: str, stack: list[Element]) -> Element:
    names, cut, doubted = "", tag in GONE, tag in DOUBTED
    if raw and not raw.isspace() and tag not in ("html", "body"):
        found = {a.lower(): html.unescape(x or y or z).lower() for a, x, y, z in ATTRIBUTE.findall(raw)}
        names = " ".join(sorted(f"{found.get('class', '')} {found.get('id', '')}".split()))
        if tag not in ARTICLE and tag not in INLINE:
            words = set(names.split())  # whole names: a part as in no-sidebar or related-work says little, there the style tree decides
            inside = any(e.tag in ARTICLE for e in stack)
            doubted = doubted or bool(words & FURNITURE) or found.get("role") in ROLES or (not inside and "header" in words)
        hidden = "hidden" in re.split(r"[\s=/]+", re.sub(r"\"[^\"]*\"|'[^']*'", "", raw.lower())) or found.get("aria-hidden") == "true"
        cut = cut or hidden or re.search(r"display\s*:\s*none", found.get("style", "")) is not None
    if tag == "header" and not any(e.tag in ARTICLE for e in stack):
        doubted = True
    style = f"{tag}.{names}" if names else tag
    return Element(tag, style, xxhash.xxh3_64_intdigest(style.encode(), seed=stack[-1].path) >> 1, cut, doubted)


def blocks(top: Element, low: frozenset[int] = frozenset()) -> list[str]:
    """Blocks of text below an element in page order, without cut elements and without branches of low importance."""
    out, current = [], []

    def flush():
        text = " ".join(html.unescape("".join(current)).split())
        current.clear()
        if text:
            out.append(text)

    todo: list = [top]  # not by recursion: pages may nest deeply
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            current.append(x)
        elif x.cut or x.path in low:
            if x.tag not in INLINE and x.tag not in SILENT:
                flush()
        elif x.tag in INLINE:
            if x.tag in ("br", "wbr"):
                current.append(" " if x.tag == "br" else "")
            todo.extend(reversed(x.inner))
        else:
            flush()
            todo.append(None)
            todo.extend(reversed(x.inner))
    flush()
    return out


def elements(top: Element) -> list[tuple[Element, bool]]:
    """The element and all below that are not cut, outer before inner, each with whether it lies inside an article."""
    found, todo = [], [(top, False)]
    while todo:
        e, inside = todo.pop()
        found.append((e, inside))
        inside = inside or e.tag in ARTICLE
        todo.extend((x, inside) for x in e.inner if not isinstance(x, str) and not x.cut)
    return found


def articles(root: Element) -> list[Element]:
    """What a page marks as its article: the outermost main elements, else the outermost articles; else the whole page."""
    for tag in ("main", "article"):
        found, todo = [], [root]
        while todo:
            e = todo.pop(0)
            if e.tag == tag and not e.cut:
                found.append(e)
            elif not e.cut:
                todo[:0] = [x for x in e.inner if not isinstance(x, str)]
        if any(blocks(e) for e in found):
            return found
    return [root]


def main_text(page: str | None, low: frozenset[int] = frozenset()) -> str:
    """The article of a page: its blocks joined by line feeds; empty if there is none."""
    return "\n".join(b for e in articles(parse(page)) for b in blocks(e, low)) if page else ""


def style_nodes(page: str) -> list[tuple[int, int, int, int]]:
    """(path, article, content, inner styles) of the page's containers that may be furniture, as hashes; one row per path.

    No candidates are the elements that are or hold an article, and those that only wrap a line of text.
    """
    root = parse(page)
    key = lambda s: xxhash.xxh3_64_intdigest(s.encode()) - (1 << 63)
    article = key("\n".join(b for e in articles(root) for b in blocks(e)))
    all_elements = elements(root)
    content: dict[int, int] = {}  # hash of an element's text, from the hashes of what it holds
    for e, _ in reversed(all_elements):
        own = xxhash.xxh3_64()
        for x in e.inner:
            own.update(" ".join(x.split()) if isinstance(x, str) else "" if x.cut else content[id(x)].to_bytes(8, "little"))
        content[id(e)] = own.intdigest()
    found: dict[int, list[Element]] = {}
    for e, inside in all_elements:
        plain = e.tag in INLINE or e.tag in LEAF or e.tag in ("#", "html", "body", "br", "hr", "img") or (inside and e.style == e.tag)
        if not plain and not e.holds:
            found.setdefault(e.path, []).append(e)
    return [
        (path, article, key(" ".join(str(content[id(e)]) for e in same)), key(" ".join(x.style for e in same for x in e.inner if not isinstance(x, str))))
        for path, same in found.items()
    ]


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def low_importance(pages: DataFrame, url: str = "url", text: str = "html") -> DataFrame:
    """Per host the style paths of low importance: (host, low). Importance is the greater of the two entropies, each over the
    logarithm of the number of distinct articles the node was seen with, hence between 0 and 1.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(h, *n) for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for n in style_nodes(p or "")]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        types = [pa.string(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "path", "article", "content", "inner"])

    seen = map_batches(pages.select(host_of(url).alias("host"), F.col(text)), run, "host string, path bigint, article bigint, content bigint, inner bigint")
    once = cut_lineage(seen.groupBy("host", "path", "article").agg(F.min("content").alias("content"), F.min("inner").alias("inner")), "style-nodes")

    def entropy(column: str) -> DataFrame:
        counts = once.groupBy("host", "path", column).agg(F.count("*").alias("n"))
        total = counts.groupBy("host", "path").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s")).where(F.col("m") >= SEEN)
        return total.select("host", "path", "m", ((F.log("m") - F.col("s") / F.col("m")) / F.log("m")).alias(column))

    nodes = entropy("content").join(entropy("inner").drop("m"), ["host", "path"])
    low = nodes.where(F.greatest("content", "inner") < LOW)
    return cut_lineage(low.groupBy("host").agg(F.collect_list("path").alias("low")), "low-nodes")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """Main text per page: key, url, text, n_chars. Null and empty pages give an empty text; rows stay one to one.

    Pages whose url names no host share the empty host. The low branches of a host are a short list; Spark sends it to all
    tasks where the table is small by its files, and else shuffles by host with skew handling.
    """
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}
    low = low_importance(pages, url, text)
    joined = pages.select(key, url, text, host_of(url).alias("host")).join(low, "host", "left").select(key, url, text, "low")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, frozenset(x or ())) for p, x in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[key, url, "text", "n_chars"]
        )

    return map_batches(joined, run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars bigint")
