"""Main text of web pages by site style trees.

The element trees of all pages of a host are merged by their styled paths (tag
and class names from the root down).  A path whose layout and texts hardly
differ from page to page is presentation: menus, notices, boiler plate.  Its
importance is low, and the branch is taken out of each page.  Elements that say
what they are (nav, footer, form, class names of adverts and the like) go in any
case, also on hosts with too few pages to compare.

Importances are counts over (host, path, layout or text), so one host with a
third of all pages is summed before the shuffle.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as tb
from tidemark.runtime import cut_lineage

#: Pages of a host that must have a path before its importance counts.
LEAST_PAGES = 5
#: Branches of less importance are presentation.
LEAST_IMPORTANCE = 0.3
#: Paths of little importance that are sent to all tasks at most; beyond, pages are joined by host.
BROADCAST_PATHS = 100_000
#: Bits of the field of pages that occur more than once.
FIELD_BITS = 22

# Element names by what the HTML standard says of them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg math canvas object audio video select".split())
BLOCK = set(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot"}
SCOPE = set("html body article section div main td th table header footer aside nav form blockquote li dd figure details".split())
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
NOISE_TAGS = set("nav aside footer form button head menu dialog fieldset input label search".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar side rail widget widgets "
    "footer foot masthead topbar toolbar header "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comments comment respond reply replies disqus discussion "
    "skip search copyright legal disclaimer".split()
)
MAIN_NAMES = set("article main content post entry story body".split())
TEXT_TAGS = set("p h1 h2 h3 h4 h5 h6 blockquote pre main article body html".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


def host_of(url):
    """Host of a URL in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


class Node:
    __slots__ = ("tag", "path", "low", "noise", "main", "children", "parent")

    def __init__(self, tag, path, noise, main, parent):
        self.tag, self.path, self.noise, self.main, self.parent = tag, path, noise, main, parent
        self.low, self.children = False, []


def _styled(tag: str, raw: str) -> tuple[str, bool, bool]:
    """Name of an element in its path, whether it names itself noise, whether it names itself the main part."""
    noise, main = tag in NOISE_TAGS, tag in ("article", "main")
    if not raw.strip():
        return tag, noise, main
    found = {}
    for m in ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    classes = sorted(found.get("class", "").split())
    role = found.get("role", "").lower()
    parts = {p.lower() for p in NAME_PARTS.findall(found.get("class", "") + " " + found.get("id", ""))}
    if tag not in ("html", "body") and (parts & NOISE_NAMES and not parts & MAIN_NAMES - {"body"} or parts & {"comments", "comment", "ad", "ads", "sidebar"}):
        noise = True
    if role in NOISE_ROLES or "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        noise = True
    return ".".join([tag, *classes]), noise, main or role in ("main", "article") or found.get("itemprop") == "articleBody"


def parse(page: str) -> Node:
    """Element tree; children are nodes and pieces of text (strings).

    Follows the standard where pages lean on it: void and raw elements, end
    tags left out, a block that ends an open paragraph, unknown end tags.
    """
    root = Node("", 0, False, False, None)
    at, end, node = 0, len(page), root
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing, raw = tag.lower(), m[1] or m[4], (m[3] or m[6] or "")
        if closing:
            up = node
            while up is not root and up.tag != tag:
                if up.tag in ("article", "main", "body", "table") and tag not in BLOCK:
                    up = root
                    break
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in ENDS_P:
            up = node
            while up is not root and up.tag not in SCOPE and up.tag != "p":
                up = up.parent
            if up is not root and up.tag == "p":
                node = up.parent
        if tag in SIBLINGS:
            up = node
            while up is not root and up.tag not in SIBLINGS[tag] and up.tag not in ("ul", "ol", "dl", "table", "div", "article"):
                up = up.parent
            if up is not root and up.tag in SIBLINGS[tag]:
                node = up.parent
        if tag in RAW:
            if not raw.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}[\s/>]|</{re.escape(tag)}\Z", re.I).search(page, at)
                if close is None:
                    at = end
                else:
                    stop = page.find(">", close.start())
                    at = end if stop < 0 else stop + 1
            continue
        name, noise, main = _styled(tag, raw)
        if tag == "header":
            noise = not _within_main(node)
        parent = node.path.to_bytes(8, "little")
        made = Node(tag, xxhash.xxh3_64_intdigest(parent + name.encode()), noise, main, node)
        node.children.append(made)
        if tag not in VOID and not raw.rstrip().endswith("/"):
            node = made
    return root


def _within_main(node: Node) -> bool:
    while node is not None:
        if node.main:
            return True
        node = node.parent
    return False


def _squeeze(pieces: list[str]) -> str:
    return " ".join(entities.unescape("".join(pieces)).split())


def features(root: Node) -> dict[tuple[int, int], set[int]]:
    """Per (path, kind): hashes of layouts (kind 0: child elements) and of texts (kind 1: own and inline text)."""
    found: dict[tuple[int, int], set[int]] = {}

    def add(path, kind, value):
        found.setdefault((path, kind), set()).add(value)

    stack = [root]
    while stack:
        node = stack.pop()
        kids = [c for c in node.children if isinstance(c, Node)]
        stack.extend(kids)
        if node.path:
            order = []
            for kid in kids:
                if not order or order[-1] != kid.path:
                    order.append(kid.path)
            add(node.path, 0, xxhash.xxh3_64_intdigest(np.array(order, np.uint64).tobytes()))
            text = _squeeze([c for c in node.children if isinstance(c, str)])
            if text:
                add(node.path, 1, xxhash.xxh3_64_intdigest(text))
    return found


def importances(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, path, pages and importance of each styled path that ``least_pages`` pages or more have.

    With m pages, layouts of shares p have importance -sum(p log_m p); a text
    that k pages show has importance 1 - log_m k, averaged over what the pages
    show.  A path has the larger of the two if it holds text.  Pages of a host
    that are equal byte for byte count once, wherever they lie: pages that a
    bit field takes for copies go on with their digest, which is counted.
    """
    rows = pages.select(host_of(F.col("url")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("h", F.xxhash64("host", "html"))
    copies = tb.bit_field(rows.groupBy("h").count().where(F.col("count") > 1), "h", FIELD_BITS)

    def batches(stream):
        for batch in stream:
            count, seen = Counter(), set()
            copied = tb.in_field(batch.column(2).to_numpy(), copies, FIELD_BITS)
            for host, page, twice in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), copied):
                own = None
                if twice:
                    own = xxhash.xxh3_128_digest(page)
                    if (host, own) in seen:
                        continue
                    seen.add((host, own))
                for (path, kind), values in features(parse(page)).items():
                    if kind == 0:  # once for each path of the page
                        count[host, path, 2, 0, own] += 1
                    for value in values:
                        count[host, path, kind, value, own] += 1
            if count:
                host, path, kind, value, own = zip(*count)
                signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), signed(path), pa.array(kind, pa.int32()), signed(value), pa.array(list(count.values()), pa.int64()), pa.array(own, pa.binary())], names=["host", "path", "kind", "value", "n", "own"])

    alone = F.coalesce(F.sum(F.when(F.col("own").isNull(), F.col("n"))), F.lit(0))
    counted = rows.mapInArrow(batches, "host string, path long, kind int, value long, n long, own binary").groupBy("host", "path", "kind", "value").agg((alone + F.count_distinct("own")).alias("n"))
    # sums of n and n ln n are all that the two importances need, so m may come from the same grouping
    part = lambda kind, value: F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0.0))
    nlogn = F.col("n") * F.log("n")
    sums = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 2, F.col("n"))).alias("pages"), part(0, nlogn).alias("layout"), part(1, F.col("n").cast("double")).alias("texts"), part(1, nlogn).alias("common")
    ).where(F.col("pages") >= least_pages)
    m, base = F.col("pages"), F.log("pages")
    layout = (base - F.col("layout") / m) / base
    text = F.when(F.col("texts") > 0, 1 - F.col("common") / F.col("texts") / base)
    return sums.select("host", "path", "pages", F.greatest(layout, F.coalesce(text, F.lit(0.0))).alias("importance"))


def mark_low(root: Node, low: frozenset) -> None:
    """Mark the branches all of whose paths are of low importance."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    for node in reversed(order):
        node.low = node.path in low and all(c.low for c in node.children if isinstance(c, Node))


def main_text(root: Node, low: frozenset) -> str:
    """Blocks of the main part in order, joined by two line feeds.

    Low branches go as a whole if they are containers, single paragraphs of
    running text stay; they never take the whole main part away.
    """
    if low:
        mark_low(root, low)

    def blocks(tops: list[Node], prune: bool) -> list[str]:
        out, piece = [], []

        def flush():
            text = _squeeze(piece)
            piece.clear()
            if text:
                out.append(text)

        for top in tops:
            stack: list = [top]
            while stack:
                item = stack.pop()
                if item is flush:
                    flush()
                elif isinstance(item, str):
                    piece.append(item)
                elif item.noise and item is not top:
                    continue
                elif prune and item.low and item.tag not in TEXT_TAGS and item is not top:
                    continue
                elif item.tag in ("br", "hr"):
                    piece.append(" ")
                    if item.tag == "hr":
                        flush()
                else:
                    if item.tag in BLOCK or item.tag == "":
                        flush()
                        stack.append(flush)
                    stack.extend(reversed(item.children))
            flush()
        return out

    mains, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.noise:
            continue
        if node.main:
            mains.append(node)
            continue
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    inner = []
    for node in mains:  # a main element that holds articles is only their frame
        found, stack = [], [c for c in reversed(node.children) if isinstance(c, Node)]
        while stack:
            child = stack.pop()
            if child.noise:
                continue
            if child.main and node.tag == "main":
                found.append(child)
            else:
                stack.extend(c for c in reversed(child.children) if isinstance(c, Node))
        inner.extend(found or [node])
    return "\n\n".join(blocks(inner, True) or blocks(inner, False) or blocks([root], True) or blocks([root], False))


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_importance: float = LEAST_IMPORTANCE, broadcast_paths: int = BROADCAST_PATHS) -> DataFrame:
    """page_id, url and text of every row of pages (page_id, url, html).

    A null page is empty and has an empty text; a null url is a host of its
    own.  Repeated rows are each extracted; other columns are not read.
    """
    low = cut_lineage(importances(pages, least_pages).where(F.col("importance") < least_importance).groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("low")))
    paths = low.agg(F.coalesce(F.sum(F.size("low")), F.lit(0)), F.count("*")).first()
    held = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    # within the bound every task gets all paths; beyond it pages meet those of their host in a shuffle join, whose large hosts Spark splits
    side = F.broadcast(low) if paths[0] + paths[1] <= broadcast_paths else low
    joined = held.join(side, "host", "left").select("page_id", "url", "html", "low")

    def batches(stream):
        for batch in stream:
            known, texts = {}, []
            for page, paths in zip(batch.column(2).to_pylist(), batch.column(3)):
                own = frozenset()
                if paths.is_valid:
                    raw = np.asarray(paths.values).tobytes()
                    own = known.get(raw)
                    if own is None:
                        own = known[raw] = frozenset(np.frombuffer(raw, np.uint64).tolist())
                texts.append(main_text(parse(page), own) if page else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kinds = dict(pages.dtypes)
    return joined.mapInArrow(batches, f"page_id {kinds['page_id']}, url string, text string")
