"""The main text of web pages by a style tree of their site.

The pages of a host are merged into one tree of presentation: a node is the
path of block elements with their classes.  Its importance joins two entropies.
Presentation: nodes that are built in ever other ways matter, those that look
alike on all pages do not.  Content: a text that stands on many of the pages
with the node says nothing about one of them, a text of one page does.  Branches
of low importance are removed from each page of the host.

Two kinds of evidence stand beside the tree, as it needs several pages of a host
and cannot tell unique adverts from content: what an element is (navigation,
form, script, ...) or is called (class, id, role), and the ``article`` or
``main`` element of a page, whose text is kept but for the named parts in it and
its branches of an importance below ``REPEATED``.  Comments, adverts, notices and
teasers that say so by their name go wherever they stand, also as paragraphs and articles.  That cut is stricter, and
articles that say the same count once: copies of a page repeat nothing.

Spark adds up the nodes (host, path, text hash) with partial sums before they
are shuffled; the table of unimportant nodes has as many rows as sites have
kinds of branches and is broadcast if it is small.  Pages are parsed in their
row, twice; nothing of a page but its hashes is shuffled.

Defined cases: a null or empty html gives an empty text; a null ``url`` belongs
to the host of empty name; on hosts with fewer than ``PAGES`` pages the tree
removes nothing; equal pages of a host have equal texts; markup that is not
closed ends with the page; further columns may have any name.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import sent, small_batches

PAGES = 5  # of a host, before its tree says anything
LOW = 0.25  # importance below which a branch goes
REPEATED = 0.15  # the same within article and main
FADE = 0.9  # weight of what is in a node, against how it is built
SMALL = 200_000  # nodes that are broadcast

# The kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math textarea title xmp "
                "noframes canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main "
    "menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr "
    "ul".split())
NOISE = frozenset("nav header footer aside form menu dialog select head button fieldset "
                  "optgroup option dir".split())
NAMES = frozenset(
    "nav navbar navigation menu menubar header masthead topbar footer foot bottom sidebar side "
    "aside rail ad ads advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion banner notice alert cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe subscription signup login form search comment comments commentlist reply replies "
    "respond disqus discussion share sharing social related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager widget copyright legal skip toolbar contentinfo complementary "
    "teaser topnav mainnav sitenav navmenu mainmenu sitemenu siteheader sitefooter pagefooter "
    "cookiebanner cookieconsent cookienotice adcontainer adbanner leftsidebar rightsidebar "
    "sidebarleft sidebarright relatedposts relatedarticles socialshare sharebuttons socialmedia "
    "newslettersignup searchform searchbox loginform commentform commentsection".split())
#: Reader comments, adverts, notices and teasers by a name that says nothing else but where they stand;
#: such a name also holds for a paragraph, and for an article in the branch.
ASIDE = frozenset(
    "ad ads advert adverts advertisement sponsored sponsor promo notice notices cookie cookies consent "
    "newsletter subscribe share sharing comment comments reply replies respond disqus discussion "
    "related recommended recommendations teaser teasers".split())
PLACES = frozenset("area list section post block box container wrapper wrap thread reader readers user "
                   "body content inner item items entry text site page article bar buttons posts "
                   "articles stories more".split())
# Whose own name says nothing, as it is the name of what they say.
SPEAKING = frozenset("html body article main h1 h2 h3 h4 h5 h6 p".split())
PLAIN = frozenset("html body main h1 h2 h3 h4 h5 h6".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
# Each attribute with its value, so that no name is found within a value or another name.
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?")
PIECES = re.compile(r"[a-z]+")


class Block(NamedTuple):
    path: int  # hash of the names of the open elements
    text: str
    main: bool  # within article or main
    noise: bool
    shape: int  # hash of what opened within the parent


class _Open(NamedTuple):
    tag: str
    path: int
    main: bool
    noise: bool  # by what it or an element around it is
    named: bool  # by a name


def _aside(name: str) -> bool:
    """Whether all parts of a name are of ``ASIDE`` or ``PLACES``, some of ``ASIDE``: not ``has-comments``."""
    parts = set(PIECES.findall(name))
    return not parts.isdisjoint(ASIDE) and parts <= ASIDE | PLACES


def _names(attributes: str) -> tuple[str, bool, bool, list[str]]:
    """The class and id of an element, without digits, whether one of them (whole, but for its
    hyphens) is a name of no content, whether the element is hidden, and the names."""
    own, named, hidden, names = [], False, False, []
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden":
            hidden |= name == "hidden" or value == "true"
        elif name in ("class", "id", "role"):
            named |= not NAMES.isdisjoint(value.replace("-", "").replace("_", "").split())
            own += PIECES.findall(value)
            names += value.split()
    return ".".join(own), named, hidden, names


def blocks(page: str) -> list[Block]:
    """The texts of a page in their order, each with its place in the tree."""
    out: list[Block] = []
    stack = [_Open("", 0, False, False, False)]
    words: list[str] = []
    shape = at = 0

    def flush():
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            top = stack[-1]
            out.append(Block(top.path, text, top.main, top.noise or top.named, shape))

    for m in _tokens(page):
        if m.start() > at:
            words.append(entities.unescape(page[at:m.start()]))
        at = max(at, m.end())
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag == "br":
            words.append(" ")
        if tag in RAW:
            if not (m[1] or m[4]):
                end = re.compile(f"</{tag}[^>]*>", re.I).search(page, m.end())
                at = end.end() if end else len(page)
            continue
        if tag not in BLOCK:
            continue
        flush()
        shape = zlib.crc32(tag.encode(), shape)
        if m[1] or m[4]:
            names = [o.tag for o in stack]
            if tag in names:
                del stack[len(names) - 1 - names[::-1].index(tag):]
            continue
        if stack[-1].tag == "p":
            stack.pop()
        while stack[-1].tag in CLOSES.get(tag, ()):
            stack.pop()
        if tag in VOID:
            continue
        own, named, hidden, names = _names(m[3] or m[6] or "")
        top = stack[-1]
        main = top.main or tag in ("article", "main")
        # A heading's own header, inside the article, is a part of it.
        noise = top.noise or hidden and tag not in ("html", "body", "article", "main") \
            or tag in NOISE and not (tag == "header" and top.main)
        # An article is a comment by its whole name only; headings are called after what they say.
        noise = noise or tag not in PLAIN and any(
            n in ASIDE if tag == "article" else _aside(n) for n in names)
        # The name of a wrapper says nothing of an article in it.
        named = tag not in ("article", "main") and (top.named or named and tag not in SPEAKING)
        path = zlib.crc32(f"{tag}.{own}".encode(), top.path)
        stack.append(_Open(tag, path, main, noise, named))
    words.append(entities.unescape(page[at:]))
    flush()
    return out


def _tokens(page: str) -> Iterator[re.Match]:
    """Tags and comments; raw elements are passed over with what is in them."""
    at = 0
    while m := TOKEN.search(page, at):
        yield m
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if tag in RAW and not (m[1] or m[4]):
            end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)


def main_text(page: str | None, low: set[int]) -> str:
    """The kept blocks of a page, joined by line breaks."""
    found = blocks(page) if page else []
    if any(b.main and not b.noise for b in found):
        kept = [b for b in found if b.main and not b.noise and b.path not in low]
    else:
        kept = [b for b in found if not b.noise and b.path not in low]
    return "\n".join(b.text for b in kept)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][\w+.-]*://([^/?#]*)", 1))


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, main, importance) of the nodes of each host's tree."""
    def parts(batches):
        for batch in batches:
            rows = set()
            out = []
            for site, page in zip(batch["host"], batch["html"]):
                rows.clear()
                article = 0
                for b in blocks(page) if page else ():
                    content = zlib.crc32(b.text.encode("utf-8", "replace"))
                    rows.add((site, b.path, b.main, content, b.shape))
                    if b.main and not b.noise:
                        article = zlib.crc32(content.to_bytes(4), article)
                out += [(*r, article if r[2] else 0) for r in rows]
            yield pd.DataFrame(out, columns=["host", "path", "main", "content", "shape", "article"])

    rows = pages.select(host(F.col("url")).alias("host"), "html")
    sites = rows.groupBy("host").agg(F.count("*").alias("pages"))
    found = rows.mapInPandas(parts, "host string, path long, main boolean, content long, "
                                    "shape long, article long")
    # Within main a page is its article, so copies of it are one; elsewhere each page counts.
    found = found.groupBy(*found.columns).agg(F.count("*").alias("k")).withColumn(
        "k", F.when(F.col("main"), 1).otherwise(F.col("k")))

    def entropy(of: str) -> DataFrame:
        """Per node its distinct values, its pages and the logarithms of the pages of each value."""
        return found.groupBy("host", "path", "main", of).agg(F.sum("k").alias("k")).groupBy(
            "host", "path", "main").agg(F.count("*").alias("n"), F.sum("k").alias("m"),
                                F.sum(F.log("k")).alias("logs"),
                                F.sum(F.col("k") * F.log("k")).alias("klogs"))

    built = entropy("shape").select(
        "host", "path", "main", F.when(F.col("m") > 1, (F.log("m") - F.col("klogs") / F.col("m"))
                               / F.log("m")).otherwise(1.0).alias("built"))
    said = entropy("content").select(
        "host", "path", "main", F.col("m").alias("seen"),
        F.when(F.col("m") > 1, 1 - F.col("logs") / F.col("n") / F.log("m")).otherwise(1.0)
        .alias("said"))
    return said.join(built, ["host", "path", "main"]).join(sent(sites), "host").filter(
        (F.col("pages") >= PAGES) & (F.col("seen") >= PAGES)).select(
        "host", "path", "main", ((1 - FADE) * F.col("built") + FADE * F.col("said")).alias("importance"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    small_batches(pages.sparkSession)
    cut = F.when(F.col("main"), REPEATED).otherwise(LOW)
    low = stored(style_tree(pages).filter(F.col("importance") < cut).select("host", "path"), "nodes")
    by_host = low.groupBy("host").agg(F.collect_list("path").alias("low"))
    if low.count() <= SMALL:
        by_host = F.broadcast(by_host)

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages_, low_ in batches:
            yield pd.Series([main_text(p, set(x) if x is not None else set())
                             for p, x in zip(pages_, low_)], dtype=object)

    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host")).join(
        by_host, "host", "left")
    return rows.select("page_id", "url", text("html", "low").alias("text")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
