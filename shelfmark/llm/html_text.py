"""Main text of pages by a site style tree.

The pages of a host are merged by the paths of their elements. A path that many pages share has a
presentation importance, the entropy of the ways its content is laid out, and a content importance,
which falls as the same content recurs on page after page. Branches of low importance are removed
from each page, and with them what is never text: menus, forms, scripts, adverts and the like.
"""

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import stored
from .url_rules import split_url
from .words import with_results

LEAST_IMPORTANCE = 0.2
LEAST_PAGES = 5  # pages of a host that must share a path before it is judged
CONTENT_WEIGHT = 0.9

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NAME = re.compile(r"[a-z]+")

# Element names of HTML by their part in a page.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {
    tag: re.compile(rf"</{tag}\b[^>]*>", re.I)
    for tag in "script style textarea title iframe noscript xmp noembed noframes".split()
}
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_DROPPED = set(
    "aside audio button canvas datalist dialog footer form head header iframe input map menu nav "
    "noscript object option script select style svg template textarea title video".split()
)
_PLAIN = _INLINE | set(
    "html body article main p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody "
    "tfoot tr td th caption figure figcaption header hgroup address details summary".split()
)
_ENDS_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
_ENDS_ITSELF = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPES = set("html body article main section div aside nav td th table ul ol dl".split())
# Words that name a part beside the text in classes, ids and roles.
_BESIDE = set(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs "
    "comment comments commentlist complementary consent contentinfo cookie cookies copyright "
    "disqus footer form header masthead menu menubar nav navbar navigation newsletter notice "
    "notices pager pagination popup promo promoted promotion related reply respond search share "
    "sharing sidebar sidenav skip social sponsor sponsored subscribe toolbar topbar widget".split()
)


class _Open:
    __slots__ = ("dropped", "held", "path", "tag")

    def __init__(self, tag, path, dropped, held):
        self.tag, self.path, self.dropped, self.held = tag, path, dropped, held


def _names(attributes):
    found = []
    for kind, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        found.append((kind.lower(), value))
    return found


def _beside(names):
    return any(word in _BESIDE for _, value in names for word in _NAME.findall(value))


def blocks(page, by_name=True):
    """(path, text, container, plain) of the blocks of a page, in order.

    `path` names the elements from the root, with classes; equal neighbours share a path. `container`
    is the innermost of `article` and `main` around the block, or None. `plain` tells that nothing
    between it and the block but headings, paragraphs, lists, tables and phrases. Blocks in parts
    that are never text are left out; `by_name` tells whether classes, ids and roles count for that. Elements that are left open end where HTML ends them.
    """
    out, buffer = [], []
    stack = [_Open("", "", False, (None, True))]

    def flush():
        if buffer:
            top = stack[-1]
            text = " ".join(buffer_text().split())
            if text and not top.dropped:
                k = len(stack) - 1
                while k and stack[k].tag in _INLINE:
                    k -= 1
                out.append((stack[k].path, text, *stack[k].held))
            buffer.clear()

    def buffer_text():
        text = "".join(buffer)
        return html.unescape(text) if "&" in text else text

    def close(tags, scopes):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in scopes:
                return

    page = page or ""
    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            rest = page[at:]
            cut = re.search(r"</?[a-zA-Z]", rest)  # a tag that the page breaks off in
            if not stack[-1].dropped:
                buffer.append(rest[: cut.start()] if cut else rest)
            break
        if found.start() > at and not stack[-1].dropped:
            buffer.append(page[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "br" or tag == "p" and not any(x.tag == "p" for x in stack):
                buffer.append(" ")
            elif any(x.tag == tag for x in stack):
                if tag not in _INLINE:
                    flush()
                close({tag}, () if tag in _SCOPES or tag not in _INLINE else _SCOPES)
            continue
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag not in _INLINE:
            flush()
        if tag in _VOID:
            continue
        if tag in _ENDS_PARAGRAPH:
            close({"p"}, _SCOPES)
        if tag in _ENDS_ITSELF:
            close(_ENDS_ITSELF[tag], {"ul", "ol", "dl", "table", "select"})
        top = stack[-1]
        names = _names(found[3]) if found[3] else []
        roles = [value for kind, value in names if kind == "role"]
        container, plain = top.held
        inside = container is not None
        beside = tag in _DROPPED and not (tag == "header" and inside)
        whole = tag in ("html", "body") or tag in ("article", "main") and not inside
        dropped = top.dropped or beside or by_name and not whole and _beside(names)
        if tag in ("article", "main") or "main" in roles:
            container, plain = tag if tag == "article" else "main", True
        plain = plain and (tag in _PLAIN or tag == "main") and not (names and tag not in _INLINE)
        if tag in ("article", "main") or "main" in roles:
            plain = True
        classes = "".join(f".{v}" for kind, value in names if kind == "class" for v in value.split())
        path = f"{top.path}/{tag}{classes}" if tag not in _INLINE else top.path
        stack.append(_Open(tag, path, dropped, (container, plain)))
    flush()
    return out


def _number(text):
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


_NODE = T.ArrayType(
    T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("layout", T.LongType()),
            T.StructField("contents", T.ArrayType(T.LongType())),
        ]
    )
)


_PAGE = T.StructType([T.StructField("texts", T.LongType()), T.StructField("nodes", _NODE)])


@F.arrow_udf(_PAGE)
def _nodes(pages: pa.Array) -> pa.Array:
    """Hash of all block texts of a page; its paths, how many blocks each has, and their texts' hashes."""
    out = []
    for page in pages:
        nodes, texts = {}, []
        text_of_page = page.as_py()
        for path, text, *_ in blocks(text_of_page) or blocks(text_of_page, by_name=False):
            texts.append(_number(text))
            nodes.setdefault(path, []).append(texts[-1])
        nodes = [
            {"node": _number(path), "layout": len(own), "contents": sorted(set(own))}
            for path, own in nodes.items()
        ]
        out.append({"texts": _number(repr(texts)), "nodes": sorted(nodes, key=lambda n: n["node"])})
    node = pa.struct([("node", pa.int64()), ("layout", pa.int64()), ("contents", pa.list_(pa.int64()))])
    return pa.array(out, pa.struct([("texts", pa.int64()), ("nodes", pa.list_(node))]))


def style_tree(pages, url="url", page="html"):
    """(`host`, `node`, `pages`, `presentation`, `content`, `importance`) of the paths of each host.

    `pages` counts the pages m that have the path; pages of a host with the same block texts are copies
    of one page and count once, with the smallest list of paths. `presentation` is the entropy, to the base m, of
    the layouts they give it. `content` is 1 less the mean spread log(c) / log(m) of its contents,
    where c pages share a content. Both are 1 for a single page. All are partial sums and joins of
    counts; a host with very many pages is never one group.
    """
    return _tree(_nodes_of_pages(pages, url, page))


def _page_key(url, page):
    """Host and digest of a page. Pages of a host that share a digest may share their low paths."""
    return split_url(F.col(url))[0], F.xxhash64(F.col(page))


def _nodes_of_pages(pages, url, page):
    host, digest = _page_key(url, page)
    nodes = pages.select(host.alias("host"), digest.alias("digest"), _nodes(F.col(page)).alias("p"))
    return stored(nodes.select("host", "digest", "p.*"), "style-nodes")


def _tree(nodes):
    nodes = nodes.groupBy("host", "texts").agg(F.min("nodes").alias("nodes"))
    nodes = nodes.select("host", F.explode("nodes").alias("n")).select("host", "n.*")
    layouts = nodes.groupBy("host", "node", "layout").agg(F.count("*").alias("n"))
    log = F.sum(F.col("n") * F.log("n"))
    shape = layouts.groupBy("host", "node").agg(F.sum("n").alias("pages"), log.alias("logs"))
    # Entropy of shares n / m, to the base m.
    entropy = 1 - F.col("logs") / (F.col("pages") * F.log("pages"))
    contents = nodes.select("host", "node", F.explode("contents").alias("content"))
    contents = contents.groupBy("host", "node", "content").agg(F.count("*").alias("n"))
    spread = contents.groupBy("host", "node").agg(F.avg(F.log("n")).alias("spread"))
    tree = shape.join(spread, ["host", "node"])
    several = F.col("pages") > 1
    tree = tree.withColumns(
        {
            "presentation": F.when(several, entropy).otherwise(1.0),
            "content": F.when(several, 1 - F.col("spread") / F.log("pages")).otherwise(1.0),
        }
    )
    importance = (1 - CONTENT_WEIGHT) * F.col("presentation") + CONTENT_WEIGHT * F.col("content")
    tree = tree.withColumn("importance", importance)
    return tree.select("host", "node", "pages", "presentation", "content", "importance")


def main_text(page, low=()):
    """The text of a page without the branches whose paths have numbers in `low`.

    Articles, else the main part, else all. If names of parts leave nothing, they are not heeded:
    they then name a frame around the text. A plain paragraph, heading, list or table of an article
    stays even where other pages repeat it: pages may share an article.
    """
    found = blocks(page) or blocks(page, by_name=False)
    kinds = {container for _, _, container, _ in found}
    chosen = next((kind for kind in ("article", "main") if kind in kinds), None)
    own = [x for x in found if chosen is None or x[2] == chosen]
    low = set(low or ())
    kept = [x for x in own if not low or chosen and x[3] or _number(x[0]) not in low]
    return " ".join(text for _, text, *_ in kept or own)


def extract_text(pages, url="url", page="html"):
    """`pages` with `text`, the main text, and `n_chars`, its code points.

    A null or empty page has the empty text. A page with a null url belongs to the host without a
    name. Character references are decoded, white space in a block becomes one space, and blocks are
    joined by one space. Every row is kept, equal ones too; columns with the two names are replaced.
    """
    nodes = _nodes_of_pages(pages, url, page)
    low = _tree(nodes).filter((F.col("importance") < LEAST_IMPORTANCE) & (F.col("pages") >= LEAST_PAGES))
    own = nodes.select("host", "digest", F.explode("nodes.node").alias("node"))
    own = own.join(low.select("host", "node"), ["host", "node"])
    # A page has its own low paths only, so no list is longer than a page.
    low = own.groupBy(F.col("host").alias("_host"), F.col("digest").alias("_digest")).agg(
        F.collect_set("node").alias("_low")
    )
    low = stored(low, "style-low")
    host, digest = _page_key(url, page)

    @F.arrow_udf("string")
    def extracted(texts: pa.Array, lows: pa.Array) -> pa.Array:
        rows = zip(texts, lows, strict=True)
        return pa.array([main_text(a.as_py(), b.as_py()) for a, b in rows], pa.string())

    def of_pages(held):
        same = (F.col("own") == F.col("_host")) & (F.col("page") == F.col("_digest"))
        held = held.join(low, same, "left")
        held = held.select("row", extracted(F.col("html"), F.col("_low")).alias("text"))
        return held.withColumn("n_chars", F.length("text").cast("bigint"))

    needed = {"own": host, "page": digest, "html": F.col(page)}
    return with_results(pages, needed, ["text", "n_chars"], of_pages)
