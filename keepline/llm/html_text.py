"""Main text of web pages by wrappers: union-free patterns inferred from same-host pages."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import table

#: Shards in which a host's wrappers are merged before they meet.
SHARDS = 64
#: Longest run of siblings that is folded as a repeated group.
PERIOD = 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|object|select)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S | re.I)
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
#: Start tags that end an open element of these names.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_CLOSES_P = _BLOCK - {"body", "html", "dd", "dt", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "summary", "figcaption"}
_SCOPE = {"table", "ul", "ol", "dl", "article", "section", "main", "div", "body", "html", "td", "th", "blockquote"}
_OFF_TAGS = set("nav footer aside form head button dialog menu".split())
_OFF_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menus?|breadcrumbs?|header|masthead|footer|sidebars?|aside|ads?|advert\w*|banner|sponsor\w*"
    r"|promo\w*|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscri\w*|signup|share|sharing"
    r"|social|related|recommend\w*|more-from|comments?|commentlist|disqus|repl(?:y|ies)|respond|form|search\w*|login"
    r"|paginat\w*|pager|widgets?|toolbar|skip|copyright|disclaimer|site-info)(?:$|[\s_-])", re.I)
_OFF_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
_MAIN_NAMES = re.compile(
    r"(?:^|[\s_-])(?:article(?:-?body|-?content|-?text)?|post-?(?:body|content|text)|entry-?(?:content|body)|story(?:-?body)?"
    r"|main-?(?:content|text)|content-?(?:body|main)|articlebody)(?:$|[\s_-])", re.I)


class Element:
    """An element of a page: label, whether it is left out or marked as main text, children."""

    __slots__ = ("tag", "label", "off", "main", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.children = tag, []
        found = {m[0].lower(): next((x for x in m[1:] if x), "") for m in _ATTR.findall(attrs)} if attrs else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".strip()
        role = found.get("role", "").lower()
        self.label = tag + ("." + ".".join(sorted(set(names.split()))) if names else "")
        hidden = "hidden" in found or "none" in found.get("style", "").replace("display:", "display: ").split()
        inert = tag in ("html", "body", "main", "article")
        self.off = hidden or found.get("aria-hidden") == "true" or tag in _OFF_TAGS or role in _OFF_ROLES or (
            not (inert and tag != "article") and bool(names and _OFF_NAMES.search(names)))
        self.main = not self.off and (
            tag in ("article", "main") or role in ("main", "article")
            or found.get("itemprop", "").lower() == "articlebody" or bool(names and _MAIN_NAMES.search(names)))


def parse(page: str) -> Element:
    """Tree of a page; missing end tags are implied, scripts, styles and comments are gone."""
    root = Element("#page")
    stack, at = [root], 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            stack[-1].children.append(page[at:m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        ends = _ENDS.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends or (stack[i].tag == "p" and tag in _CLOSES_P):
                del stack[i:]
                break
            if stack[i].tag in _SCOPE and stack[i].tag != "p":
                break
        element = Element(tag, m[4])
        stack[-1].children.append(element)
        if tag not in _VOID and not m[4].endswith("/"):
            stack.append(element)
    if at < len(page):
        stack[-1].children.append(page[at:])
    return root


def _clean(text: str) -> str:
    return " ".join(html.unescape(text).split())


# A pattern is a list of nodes. A text node is ["t", fingerprint or None for a slot, words]; an
# element is ["e", label, off, main, count, optional, repeated, pattern]; a repeated run of several
# siblings is ["e", "", ...] around their patterns. Words are summed over pages for scoring.

def pattern_of(element: Element) -> list:
    """Pattern of an element's children, with repeated siblings folded into groups."""
    out = []
    for child in element.children:
        if isinstance(child, str):
            text = _clean(child)
            if text:
                if out and out[-1][0] == "t":
                    out[-1][1] = None
                    out[-1][2] += text.count(" ") + 1
                else:
                    out.append(["t", xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1,
                                text.count(" ") + 1])
        elif child.tag != "br":
            out.append(["e", child.label, child.off, child.main, 1, False, False, pattern_of(child)])
    for period in range(1, PERIOD + 1):
        out = _fold(out, period)
    return out


def _key(node: list) -> str:
    return "#" if node[0] == "t" else node[1] or "(" + " ".join(map(_key, node[7])) + ")"


def _fold(nodes: list, period: int) -> list:
    """Replace runs of equal neighbours (groups of ``period`` siblings) by one repeated group."""
    out, i = [], 0
    keys = [_key(n) for n in nodes]
    while i < len(nodes):
        j = i + period
        group = None
        while keys[i:i + period] == keys[j:j + period] and len(keys[i:i + period]) == period and "#" not in keys[i:i + period]:
            group = merge(group or nodes[i:i + period], nodes[j:j + period])
            j += period
        if group is None:
            out.append(nodes[i])
            i += 1
        elif period == 1:
            group[0][4], group[0][6] = 1, True
            out.append(group[0])
            i = j
        else:
            out.append(["e", "", False, False, 1, False, True, group])
            i = j
    return out


def merge(a: list, b: list) -> list:
    """Align two patterns. Texts that differ become slots, nodes of one side only become optional."""
    if [_key(n) for n in a] == [_key(n) for n in b]:
        return [_merge_node(x, y) for x, y in zip(a, b)]
    ka, kb = [_key(n) for n in a], [_key(n) for n in b]
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            rows[i][j] = rows[i + 1][j + 1] + 1 if ka[i] == kb[j] else max(rows[i + 1][j], rows[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] == kb[j]:
            out.append(_merge_node(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and rows[i + 1][j] >= rows[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return out


def _optional(node: list) -> list:
    return node if node[0] == "t" else [*node[:5], True, *node[6:]]


def _merge_node(x: list, y: list) -> list:
    if x[0] == "t":
        return ["t", x[1] if x[1] == y[1] else None, x[2] + y[2]]
    return ["e", x[1], x[2], x[3], x[4] + y[4], x[5] or y[5], x[6] or y[6], merge(x[7], y[7])]


def _mass(nodes: list, slots_only: bool, link: bool = False) -> int:
    """Words in the texts of a pattern that can be main text."""
    total = 0
    for n in nodes:
        if n[0] == "t":
            total += 0 if link or (slots_only and n[1] is not None) else n[2]
        elif not n[2]:
            total += _mass(n[7], slots_only, link or n[1].split(".")[0] == "a")
    return total


def main_path(wrapper: list, pages: int) -> list[str]:
    """Labels from the root to the region that holds the main text.

    Marked regions (article, main and their like) win where they hold text. Else the walk follows the child
    with most of the words, counting only slots where several pages were aligned, and stops where no child has
    most of them.
    """
    slots = pages > 1 and _mass(wrapper, True) > 0
    total = _mass(wrapper, slots)
    best: tuple[int, list[str]] = (0, [])

    def marked(nodes: list, path: list[str], inside: bool) -> None:
        nonlocal best
        for n in nodes:
            if n[0] == "e" and not n[2]:
                here = path + [n[1]] if n[1] else path
                mass = _mass(n[7], False)
                if n[3] and (mass > best[0] or inside and 10 * mass >= 9 * best[0] > 0):
                    best = (mass, here)
                marked(n[7], here, inside or n[3])

    marked(wrapper, [], False)
    if best[0]:
        return best[1]
    path, nodes = [], wrapper
    while total:
        inner = [(_mass(n[7], slots), n) for n in nodes if n[0] == "e" and not n[2]]
        most = max(inner, key=lambda x: x[0], default=(0, None))
        tag = most[1][1].split(".")[0] if most[1] else ""
        if 10 * most[0] < 7 * total or (tag in _BLOCK and tag not in _SCOPE) or (tag and tag not in _BLOCK):
            break
        path, nodes = path + [most[1][1]] if tag else path, most[1][7]
    return path


def _regions(root: Element, path: list[str]) -> list[Element]:
    found = [root]
    for label in path:
        found = [c for e in found for c in e.children
                 if not isinstance(c, str) and c.label == label and not c.off]
    return found


def blocks_of(element: Element) -> list[str]:
    """Texts of an element's blocks in order, without parts that are left out."""
    out: list[list[str]] = [[]]

    def walk(e: Element) -> None:
        for c in e.children:
            if isinstance(c, str):
                out[-1].append(c)
            elif c.tag == "br":
                out[-1].append(" ")
            elif not c.off and not (c.tag == "header" and not _has_title(c)):
                if c.tag in _BLOCK:
                    out.append([])
                walk(c)
                if c.tag in _BLOCK:
                    out.append([])

    walk(element)
    texts = (_clean("".join(parts)) for parts in out)
    return [t for t in texts if t]


def _has_title(e: Element) -> bool:
    return any(not isinstance(c, str) and (c.tag == "h1" or _has_title(c)) for c in e.children)


def extract(page: str, path: list[str] | None) -> str:
    """Main text of one page by its host's path, by its own where the path leads nowhere."""
    root = parse(page)
    found = _regions(root, path) if path else []
    blocks = [b for e in found for b in blocks_of(e)]
    if not blocks:
        found = _regions(root, main_path(pattern_of(root), 1))
        blocks = [b for e in found for b in blocks_of(e)]
    return "\n".join(blocks)


def _host(url) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def host_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, path): where each host's pages hold their main text.

    Pages become patterns in their own tasks, which fold them into one wrapper per host and batch. Wrappers
    of a host are merged in shards and then once more, so no task gathers a host's pages.
    """
    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, list] = {}
            for host, text in zip(*(c.to_pylist() for c in batch.columns)):
                pattern, n = pattern_of(parse(text or "")), 1
                if host in known:
                    pattern, n = merge(known[host][0], pattern), known[host][1] + 1
                known[host] = [pattern, n]
            yield pa.record_batch(
                [pa.array(list(known)), pa.array([json.dumps(w[0]) for w in known.values()], pa.string()),
                 pa.array([w[1] for w in known.values()], pa.int64())], ["host", "wrapper", "pages"])

    def combine(group: pa.Table) -> pa.Table:
        wrapper, n = None, 0
        for text, k in zip(group["wrapper"].to_pylist(), group["pages"].to_pylist()):
            nodes = json.loads(text)
            wrapper = nodes if wrapper is None else merge(wrapper, nodes)
            n += k
        return pa.table({"host": group["host"][:1], "wrapper": pa.array([json.dumps(wrapper)], pa.string()),
                         "pages": pa.array([n], pa.int64())})

    def locate(group: pa.Table) -> pa.Table:
        whole = combine(group)
        path = main_path(json.loads(whole["wrapper"][0].as_py()), whole["pages"][0].as_py())
        return pa.table({"host": whole["host"], "path": pa.array([path], pa.list_(pa.string()))})

    rows = pages.select(_host(F.col(url)).alias("host"), F.col(page).alias("html"))
    kind = "host string, wrapper string, pages long"
    parts = rows.mapInArrow(infer, kind)
    shard = F.pmod(F.xxhash64("wrapper"), F.lit(SHARDS)).cast("int")
    parts = parts.withColumn("shard", shard).groupBy("host", "shard").applyInArrow(combine, kind)
    return parts.groupBy("host").applyInArrow(locate, "host string, path array<string>")


def extract_text(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of each page.

    Same-host token streams are aligned into a wrapper with text slots, optional parts and repeated groups; the
    wrapper tells which region varies as main text does. Each page then yields the blocks of that
    region without menus, notices, forms, adverts or comments in it: character references decoded, white
    space runs as one space, blocks joined by a line break.

    Null and empty pages give the empty text. Pages without url or host form one host. Hosts of one page use the
    page alone. Repeated rows change nothing. A column named ``out`` is replaced, others pass through.
    """
    paths = materialize(host_paths(pages, url, page), "hosts")
    keyed = pages.withColumn("host_", _host(F.col(url)))
    paths = paths.select(F.col("host").alias("host_"), F.col("path").alias("path_"))
    few = paths.limit(100_001).count() <= 100_000
    joined = keyed.join(F.broadcast(paths) if few else paths, "host_", "left")

    @F.arrow_udf("string")
    def text_of(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, where in batches:
            yield pa.array([extract(t or "", p) for t, p in zip(texts.to_pylist(), where.to_pylist())], pa.string())

    return joined.withColumn(out, text_of(F.col(page), F.col("path_"))).drop("host_", "path_")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
