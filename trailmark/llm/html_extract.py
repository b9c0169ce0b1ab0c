"""HTML extraction with a site style tree.

The pages of one host are merged into a tree of style nodes: a path of elements (tag and classes) below the root. Of
each path the tree knows on how many different pages it occurs, how its children are arranged (presentation) and which
texts it shows (content). Presentation importance is the entropy of the arrangements over the pages; content importance
is one minus the mean entropy of its texts over the pages, so a text that every page shows weighs nothing. A block's
importance combines both: (1 - g^l) presentation + g^l content, for l arrangements and g = DECAY. Branches below
LEAST are removed from every page of the host.

Marked-up noise needs no statistics: menus, page headers and footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are known by their element or role, and around the article by a name in their class or id.
Inside an article (or main) a name alone removes an element only if it is a container and the name is its whole class
or id and says advert, comments, menu or the like; names that articles use as well (share, related, social, notice)
only make the element one that the tree may remove. Other paragraphs and headings of an article are always kept, as
copies and repeated lines of articles would otherwise pass for a template. Where the article (else main) holds at least
SHARE of a page's text, that is the main text, otherwise (a teaser card, say) the whole body is. Exact copies of a page
count once in the tree.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.common import table, written

#: Importance below which a branch is removed, the weight of content, and the different pages a path must be on (below
#: three, two copies of one article would be a template).
LEAST, DECAY, PAGES = 0.2, 0.9, 3
#: Share of a page's text that an article must hold to be taken for the page's main text.
SHARE = 0.25
#: Removed paths up to which they are broadcast (about 5 MB); more are joined by host.
BROADCAST_PATHS = 200_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noframes xmp".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre search"
    " section select summary table tbody td template tfoot th thead title tr ul".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_NOISE_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe svg canvas object select button textarea dialog"
    " head search fieldset input label option noframes audio video".split()
)
#: Noise around an article, but lists and words of its own within.
_OUTER_TAGS = frozenset("header menu".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu form".split())
_COMMENTS = frozenset("comment comments disqus replies reply respond commentlist".split())
_NOISE_NAMES = _COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices notification alert popup modal overlay newsletter subscribe subscription signup login menu menus"
    " nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets footer masthead topbar toolbar related"
    " recommended recommendations share sharing social pagination pager copyright".split()
)
#: Noise only outside an article, whose own header holds its title.
_OUTER_NAMES = frozenset("header banner head".split())
#: Names that inside an article are noise too, as the whole of a container's class or id; the other names are not, but
#: lift the exemption from the tree.
_INNER_NAMES = _COMMENTS | frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr newsletter nav navbar"
    " navigation breadcrumb breadcrumbs sidebar pagination pager".split()
)
_CONTAINERS = frozenset("div section aside ul ol header figure table details center".split())
#: An element of the first kind is closed when one of the second begins.
_CLOSES = {
    "p": _BLOCK - {"option"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "option": frozenset(["option"]),
    "head": frozenset(["body"]),
}
_WALLS = frozenset("table td th ul ol dl div section article main body".split())


class _Node:
    """An open element: tag, path hash, whether it is noise, inside an article or main, prose that the tree may not
    remove, or suspect by a name; and its children's tags."""

    __slots__ = ("tag", "path", "noise", "article", "main", "prose", "suspect", "children")

    def __init__(self, tag: str, path: int, noise: bool, article: bool, main: bool, prose: bool, suspect: bool):
        self.tag, self.path, self.noise = tag, path, noise
        self.article, self.main, self.prose, self.suspect = article, main, prose, suspect
        self.children: list[str] = []


def _is_noise(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, str]:
    """Whether an element is noise by its markup, whether a name makes it suspect, and its classes."""
    if tag in _NOISE_TAGS or (tag in _OUTER_TAGS and not inside):
        return True, True, ""
    if not attributes.strip():
        return False, False, ""
    classes, names, whole = "", set(), set()
    for m in _ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if key == "role" and value in _NOISE_ROLES:
            return True, True, ""
        if key in ("class", "id"):
            names.update(_NAME.findall(value))
            whole.add(value.strip())
            if key == "class":
                classes = value
    if tag in ("html", "body", "main"):
        return False, False, classes
    if tag == "article":
        return bool(whole & _COMMENTS), False, classes
    if inside:
        return tag in _CONTAINERS and bool(whole & _INNER_NAMES), bool(names & _NOISE_NAMES), classes
    known = names & (_NOISE_NAMES | _OUTER_NAMES)
    return bool(known) and tag not in _PROSE, bool(known), classes


class Block:
    """A run of text between block boundaries, without what its markup calls noise: what it says and where."""

    __slots__ = ("text", "path", "parent", "article", "main", "prose")

    def __init__(self, text: str, at: _Node, parent: int):
        self.text, self.path, self.parent = text, at.path, parent
        self.article, self.main, self.prose = at.article, at.main, at.prose


def parse(html: str | None) -> tuple[list[Block], list[tuple[int, int]]]:
    """(blocks in page order, (path, arrangement of children) of every block element) of a whole page.

    Any input is taken: unclosed and unopened elements, a page that ends within a tag, no markup at all.
    """
    if not html:
        return [], []
    root = _Node("", 0, False, False, False, False, False)
    stack, blocks, styles, held = [root], [], [], []

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                k = len(stack) - 1
                while k and stack[k].tag not in _BLOCK:
                    k -= 1
                blocks.append(Block(text, stack[k], stack[k - 1].path if k else 0))

    def close(k: int) -> None:
        while len(stack) > k:
            node = stack.pop()
            if node.tag in _BLOCK:
                styles.append((node.path, hash_of(" ".join(node.children))))

    at, low = 0, None
    for m in iter_tokens(html):
        start, end, closing, tag, attributes, raw = m
        if start > at and not stack[-1].noise:
            held.append(html[at:start])
        at = end
        if tag is None:
            continue
        if tag in ("script", "style"):
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag not in _BLOCK and any(n.tag in _BLOCK for n in stack[k + 1 :]):
                        break  # an inline element does not end blocks inside it
                    close(k)
                    break
            continue
        for k in range(len(stack) - 1, 0, -1):
            open_tag = stack[k].tag
            if tag in _CLOSES.get(open_tag, ()):
                close(k)
                break
            if open_tag in _WALLS:
                break
        up = stack[-1]
        inside = up.article or up.main
        noise, suspect, classes = _is_noise(tag, attributes, inside)
        if tag in _BLOCK:
            if not up.children or up.children[-1] != tag:
                up.children.append(tag)
            path = hash_of(f"{up.path}>{tag}.{classes}")
        else:
            path = up.path
        if tag in _VOID:
            continue
        node = _Node(
            tag,
            path,
            up.noise or noise,
            up.article or (tag == "article" and not noise),
            up.main or tag == "main",
            (up.prose or tag in _PROSE) and not suspect and not up.suspect,
            suspect or up.suspect,
        )
        stack.append(node)
        if raw is not None:
            if not node.noise:
                held.append(raw)
            close(len(stack) - 1)
    if at < len(html) and not stack[-1].noise:
        held.append(html[at:])
    flush()
    close(1)
    return blocks, styles


def hash_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def iter_tokens(html: str) -> Iterator[tuple[int, int, bool, str | None, str, str | None]]:
    """(start, end, closing, tag or None for comments, attributes, content of a raw-text element) of each token."""
    at, low = 0, None
    while True:
        m = _TOKEN.search(html, at)
        if m is None:
            return
        at = m.end()
        if m[2] is None:
            yield m.start(), at, False, None, "", None
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW and not closing:
            if low is None:
                low = html.lower() if len(html.lower()) == len(html) else html
            stop = low.find("</" + tag, at)
            stop = len(html) if stop < 0 else stop
            end = html.find(">", stop)
            end = len(html) if end < 0 else end + 1
            yield m.start(), end, False, tag, m[3], html[at:stop]
            at = end
            continue
        yield m.start(), at, closing, tag, m[3], None


def main_text(blocks: list[Block], removed: frozenset[int] | set[int] = frozenset()) -> str:
    """The main text of a page: its blocks by \\n, without noise and the paths removed for its host."""
    left = [b for b in blocks if b.path not in removed or (b.prose and (b.article or b.main))]
    size = sum(len(b.text) for b in left)
    for within in ("article", "main"):
        inside = [b for b in left if getattr(b, within)]
        if inside and sum(len(b.text) for b in inside) >= SHARE * size:
            return "\n".join(b.text for b in inside)
    return "\n".join(b.text for b in left)


def host(url: Column) -> Column:
    """The host of an address, in lower case; '' where there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (host, html): a row for each text shown and each arrangement, with a hash of the page."""
    for batch in batches:
        hosts, pages = batch.column(0), batch.column(1)
        out: list[list] = [[], [], [], [], [], []]
        for k in range(len(pages)):
            page = pages[k].as_py()
            if not page:
                continue
            name, key = hosts[k].as_py(), hash_of(page)
            blocks, styles = parse(page)
            rows = {(True, b.path, b.parent, hash_of(b.text)) for b in blocks}
            rows |= {(False, path, 0, style) for path, style in styles}
            for text, path, parent, value in rows:
                for column, item in zip(out, (name, key, text, path, parent, value), strict=True):
                    column.append(item)
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out, kinds, strict=True)],
            names=["host", "page", "is_text", "path", "parent", "value"],
        )


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of every path that shows text, over the different pages of its host."""
    schema = "host string, page bigint, is_text boolean, path bigint, parent bigint, value bigint"
    seen = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(_grow, schema).distinct()
    seen = written(seen, "style-tree")
    # every count is combined before it is shuffled, so one large host is spread over its paths and values
    shown = seen.groupBy("host", "is_text", "path", "parent", "value").agg(F.count(F.lit(1)).alias("c"))
    on = seen.select("host", "is_text", "path", "page").distinct().groupBy("host", "is_text", "path").agg(
        F.count(F.lit(1)).alias("pages")
    )
    text = shown.where("is_text").groupBy("host", "path").agg(
        F.sum(F.log("c")).alias("spread"), F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent")
    )
    text = text.join(on.where("is_text").drop("is_text"), ["host", "path"])
    content = F.when(F.col("pages") > 1, 1 - F.col("spread") / F.col("n") / F.log("pages")).otherwise(F.lit(1.0))
    text = text.select("host", "path", "parent", "pages", content.alias("content"))
    style = shown.where("NOT is_text").groupBy("host", "path").agg(
        F.sum(F.col("c") * F.log("c")).alias("cl"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("l")
    )
    entropy = F.when(F.col("all") > 1, (F.log("all") - F.col("cl") / F.col("all")) / F.log("all")).otherwise(F.lit(1.0))
    style = style.select("host", F.col("path").alias("parent"), entropy.alias("presentation"), "l")
    both = text.join(style, ["host", "parent"], "left")
    share = F.pow(F.lit(DECAY), F.coalesce("l", F.lit(0)))
    importance = (1 - share) * F.coalesce("presentation", F.lit(0.0)) + share * F.col("content")
    return both.select("host", "path", "pages", importance.alias("importance"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, removed = batch.column(2), batch.column(3)
        texts = []
        for k in range(len(pages)):
            gone = removed[k].as_py()
            texts.append(main_text(parse(pages[k].as_py())[0], frozenset(gone) if gone else frozenset()))
        sizes = pa.array(np.array([len(t) for t in texts], dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, least: float = LEAST, min_pages: int = PAGES) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    A null or empty html gives an empty text; pages without a host form one group of their own; repeated rows are
    extracted one by one. Other columns of pages are ignored, and an empty table gives no rows.
    """
    low = style_tree(pages).where((F.col("pages") >= min_pages) & (F.col("importance") < least))
    low = written(low.select("host", "path"), "removed-paths")
    by_host = low.groupBy("host").agg(F.collect_list("path").alias("removed"))
    if low.count() <= BROADCAST_PATHS:
        by_host = F.broadcast(by_host)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host(F.col("url")).alias("host"))
    joined = rows.join(by_host, "host", "left").select("page_id", "url", "html", "removed")
    return joined.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


QUERY = "op8_html_extract"
ORACLE_SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
