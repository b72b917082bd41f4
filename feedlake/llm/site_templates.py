"""Main text of web pages, with site templates found by counting element subtrees.

Every block element is hashed with all that stands below it.  Spark counts, per host, on
how many different pages each hash occurs; pages with the same text are one, so copies of a
page are no template of their host.  Subtrees that recur on ``LEAST_PAGES`` pages are
deleted.  Elements that say what they are (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, reader comments) go in any case.  What is left of the main content
is the text: one line per block, white space inside a block being one space.

The main content of a page is all that stands in an ``article``, ``main`` or an element of
that role.  Without one all of the body may be text, and the deepest box with more than
three quarters of it counts as the main content.  Headings, paragraphs, list items, cells
and boxes of running text are passages, which pages may share, and never templates alone;
other block elements are, by position: beside the main content if they recur, inside of it
if they hold no more than half of it and recur on a tenth of the pages of their host, or on
``MANY_PAGES``.

Counts are sums over (host, hash), so a host with a third of all pages is added up before
it is moved.  A page is parsed twice, for the counts, which are written, and for its text;
markup is never shuffled.  A block is listed with all elements it lies in, so a page takes
time and space by its blocks times the depth of its nesting.

Defined results: null or empty html has no text; a null url is a host of its own; equal
pages are counted as one; a page cut off anywhere is read as far as it goes; other columns
are not kept.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import quoted, written

LEAST_PAGES = 5

# Boxes inside the main content: this share of the pages of their host, or so many.
LEAST_SHARE = 0.1
MANY_PAGES = 1_000

# A box with this many words directly in it is running text.
_RUNNING = 50

# What elements are for, by tag, role, and words of class and id.
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_GONE_TAGS = _RAW | set("head nav footer aside form button select option dialog menu svg canvas object audio video map".split())
_GONE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_GONE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside widget widgets header masthead footer copyright share sharing "
    "social related recommended recommendations comment comments commentlist respond replies disqus pagination pager "
    "skip toolbar search hidden".split()
)
# What may follow such a word in a class or id: parts of a layout, not things.
_LAYOUT = set(
    "area bar block body box btn button buttons col column container content group head heading holder icon icons id info "
    "inner item items label law left link links list main message now outer panel policy right row section settings slot "
    "text this title top bottom unit wrap wrapper".split()
)
_MAIN_TAGS = {"article", "main"}
_BLOCKS = set(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption".split()
)
# Parts of a text, rather than boxes in it.
_PASSAGES = set(
    "h1 h2 h3 h4 h5 h6 header hgroup p li dt dd caption thead tbody tfoot tr th td blockquote pre figcaption address".split()
)
# An element of the first kind ends an open one of the second.
_ENDS = {
    **{tag: ("p",) for tag in _BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",),
    "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead"), "tfoot": ("tbody",),
}
# An implied end does not reach out of these.
_FENCES = set("article aside blockquote body div figure footer form header html main nav ol section table td th ul dl".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_NAME = re.compile(r"[A-Za-z0-9]+")
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


@dataclass
class _Element:
    tag: str
    parent: _Element | None
    gone: bool
    main: _Element | None
    parts: list[str] = field(default_factory=list)
    subtree: int = 0
    size: int = 0
    words: int = 0
    says: bool = False
    has_main: bool = False
    largest: _Element | None = None


def _attributes(source: str) -> dict[str, str]:
    return {
        name.lower(): entities.unescape(one or two or three)
        for name, one, two, three in _ATTRIBUTE.findall(source)
    }


def _is_gone(tag: str, attributes: dict[str, str], inside_main: bool) -> bool:
    if tag in _GONE_TAGS or tag == "header" and not inside_main:
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in _GONE_ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    if tag in ("body", "html"):
        return False
    return any(map(_is_furniture, f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()))


@lru_cache(maxsize=10_000)
def _is_furniture(name: str) -> bool:
    """Whether a class or id names such a thing: site-header and ad-top do, social-history does not."""
    words = _NAME.findall(name)
    if not words:
        return False
    if words[-1] in _GONE_WORDS:
        return True
    return words[0] in _GONE_WORDS and all(
        word in _LAYOUT or word in _GONE_WORDS or word[0].isdigit() for word in words[1:]
    )


class Page:
    """Blocks and element subtrees of one page."""

    def __init__(self, source: str):
        self.root = _Element("#", None, False, None)
        self.stack = [self.root]
        self.opened: list[_Element] = []
        # Pieces of text with their element and the number of their block.
        self.pieces: list[tuple[_Element, int, str]] = []
        self.block = 0
        at = 0
        find = _TOKEN.search
        while at < len(source):
            found = find(source, at)
            if not found:
                self._text(source[at:])
                break
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            tag = found["tag"]
            if tag is None:
                if found[0].startswith("<![CDATA["):
                    self._text(entities.escape(found[0][9:].removesuffix("]]>")))
                continue
            tag = tag.lower()
            if found["end"]:
                self._end(tag)
            else:
                self._start(tag, found["attrs"])
                if tag in _RAW and not found[0].endswith("/>"):
                    close = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(source, at)
                    if tag == "title":
                        self._text(source[at : close.start() if close else len(source)])
                    at = close.end() if close else len(source)
                    self._end(tag)
        while len(self.stack) > 1:
            self._close()
        self.marked = any(one.main is one for one in self.opened)
        if not self.marked:
            self._find_main()

    def _find_main(self) -> None:
        """The deepest box with more than three quarters of the text, unless that is the body."""
        heavy = self.root
        while (inner := heavy.largest) is not None and 4 * inner.size > 3 * self.root.size:
            if inner.tag not in _BLOCKS or inner.tag in _PASSAGES:
                break
            heavy = inner
        if heavy.tag in ("#", "html", "body"):
            return
        heavy.main = heavy
        above = heavy
        while above is not None:
            above.has_main, above = True, above.parent
        for one in self.opened:  # parents come first
            if one.main is None and one.parent.main is not None:
                one.main = one.parent.main

    def _text(self, text: str) -> None:
        if text and not text.isspace():
            here = self.stack[-1]
            here.parts.append(text)
            if not here.gone:
                here.size += len(text)
                here.words += len(text.split())
            self.pieces.append((here, self.block, text))
        elif text and self.pieces:
            self.pieces.append((self.stack[-1], self.block, " "))

    def _start(self, tag: str, source: str) -> None:
        if tag in _ENDS:
            self._implied(_ENDS[tag])
        if tag in _BLOCKS:
            self.block += 1
        above = self.stack[-1]
        if tag in _VOID:
            if tag == "br":
                self.pieces.append((above, self.block, " "))
            return
        attributes = _attributes(source) if source and not source.isspace() else {}
        gone = above.gone or _is_gone(tag, attributes, above.main is not None)
        one = _Element(tag, above, gone, above.main)
        if not gone and above.main is None and (tag in _MAIN_TAGS or attributes.get("role", "").lower() == "main"):
            one.main = one
        if attributes:
            one.parts.append("\x00".join(f"{k}={v}" for k, v in sorted(attributes.items()) if k in ("class", "id", "href")))
        self.stack.append(one)
        self.opened.append(one)

    def _implied(self, tags: tuple[str, ...]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                while len(self.stack) > depth:
                    self._close()
                return
            if self.stack[depth].tag in _FENCES:
                return

    def _end(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.block += 1
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                while len(self.stack) > depth:
                    self._close()
                return
            if tag not in _BLOCKS and self.stack[depth].tag in _FENCES:
                return

    def _close(self) -> None:
        one = self.stack.pop()
        above = self.stack[-1]
        if one.tag in _BLOCKS:
            self.block += 1
        one.says = any(one.parts)
        one.has_main = one.has_main or one.main is one
        body = f"{one.tag}\x01" + "\x01".join(" ".join(part.split()) for part in one.parts)
        one.subtree = xxhash.xxh64_intdigest(body) - (1 << 63)
        above.parts.append(f"\x02{one.subtree:x}")
        above.has_main = above.has_main or one.has_main
        above.size += one.size
        if one.tag not in _BLOCKS:
            above.words += one.words
        if one.size and (above.largest is None or one.size > above.largest.size):
            above.largest = one

    def text_hash(self) -> int:
        """Hash of all text but that of elements that go in any case."""
        said = " ".join(text for one, _, text in self.pieces if not one.gone)
        return xxhash.xxh64_intdigest(" ".join(said.split())) - (1 << 63)

    def subtrees(self) -> dict[int, bool]:
        """Hashes of block elements that may be templates, and whether all stand in the main content."""
        found: dict[int, bool] = {}
        for one in self.opened:
            if one.says and self._may_recur(one):
                inside = one.main is not None
                found[one.subtree] = inside and found.get(one.subtree, True)
        return found

    def _may_recur(self, one: _Element) -> bool:
        """Whether an element is a template if it recurs."""
        if one.tag not in _BLOCKS or one.has_main or one.tag in ("html", "body"):
            return False
        if one.tag in _PASSAGES or one.words >= _RUNNING:
            return False
        return one.main is None or 2 * one.size <= one.main.size

    def blocks(self) -> list[tuple[str, list[int]]]:
        """Text blocks of the main content, each with the subtrees that it lies in."""
        here = self.marked and any(one.main is not None and not one.gone for one, _, _ in self.pieces)
        out: list[tuple[str, list[int]]] = []
        last, parts, holder = -1, [], None

        def flush() -> None:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, self._chain(holder)))

        for element, block, text in self.pieces:
            if element.gone or (here and element.main is None):
                continue
            if block != last:
                if parts:
                    flush()
                last, parts, holder = block, [], element
            parts.append(text)
        if parts:
            flush()
        return out

    def _chain(self, element: _Element | None) -> list[int]:
        found = []
        while element is not None:
            if self._may_recur(element):
                found.append(element.subtree)
            element = element.parent
        return found


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


_PARSED = (
    "page_id long, url string, key_a long, key_b long, "
    "blocks array<struct<text: string, under: array<bigint>>>"
)


_SUBTREES = "host string, page long, key_a long, key_b long, subtrees array<struct<subtree: bigint, inside: boolean>>"


def _subtrees(pages: DataFrame) -> DataFrame:
    """Host, hash of the text, and the different subtrees of each page, with its key."""
    kind = pa.list_(pa.struct([("subtree", pa.int64()), ("inside", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch = whole.slice(begin, 500)
                hosts, texts, found = [], [], []
                for url, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    page = Page(body or "")
                    hosts.append(host_of(url))
                    texts.append(page.text_hash())
                    found.append([{"subtree": h, "inside": inside} for h, inside in sorted(page.subtrees().items())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hosts), pa.array(texts, pa.int64()), *batch.columns[3:5], pa.array(found, kind)],
                    names=["host", "page", "key_a", "key_b", "subtrees"],
                )

    return pages.mapInArrow(run, _SUBTREES)


def _blocks(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("under", pa.list_(pa.int64()))]))
        for whole in batches:
            for begin in range(0, len(whole), 500):
                batch = whole.slice(begin, 500)
                found = [
                    [{"text": text, "under": under} for text, under in Page(body or "").blocks()]
                    for body in batch.column(2).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], *batch.columns[3:5], pa.array(found, kind)],
                    names=["page_id", "url", "key_a", "key_b", "blocks"],
                )

    return pages.mapInArrow(run, _PARSED)


def site_templates(
    subtrees: DataFrame,
    *,
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    many_pages: int = MANY_PAGES,
) -> DataFrame:
    """``host`` and ``subtree`` of what recurs on ``least_pages`` different pages of a host.

    ``wide`` tells what recurs widely enough to be a template inside the main content too.
    """
    seen = subtrees.select("host", "page", F.explode("subtrees.subtree").alias("subtree")).distinct()
    recurring = seen.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages"))
    recurring = recurring.filter(F.col("pages") >= least_pages)
    sizes = subtrees.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("size"))
    wide = (F.col("pages") >= many_pages) | (F.col("pages") >= least_share * F.col("size"))
    return recurring.join(sizes, "host").select("host", "subtree", wide.alias("wide"))


def main_texts(
    pages: DataFrame,
    *,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
    many_pages: int = MANY_PAGES,
) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and ``n_templates``, the subtrees of the page
    that are part of the template of its host."""
    columns = [F.col(quoted(page_id)).alias("page_id"), F.col(quoted(url)).cast("string").alias("url"),
               F.col(quoted(html)).alias("html")]
    slim = pages.select(*columns).withColumn("page_id", F.col("page_id").cast("long"))
    # Equal rows have equal keys, and the same result.
    keyed = slim.select(
        "*",
        F.xxhash64("page_id", "url", "html").alias("key_a"),
        F.xxhash64(F.lit("second"), "html", "url", "page_id").alias("key_b"),
    )
    # Read twice: to find what recurs, and to tell each page of it.
    subtrees = written(_subtrees(keyed), "subtrees")
    recurring = site_templates(
        subtrees, least_pages=least_pages, least_share=least_share, many_pages=many_pages
    )
    on_page = subtrees.select("key_a", "key_b", "host", F.inline("subtrees"))
    hits = (
        on_page.join(recurring, ["host", "subtree"])
        .filter("wide OR NOT inside")
        .groupBy("key_a", "key_b")
        .agg(F.collect_set("subtree").alias("templates"))
    )
    joined = _blocks(keyed).join(hits, ["key_a", "key_b"], "left")
    kept = "filter(blocks, b -> templates IS NULL OR NOT arrays_overlap(b.under, templates))"
    return joined.select(
        "page_id",
        "url",
        F.expr(f"array_join(transform({kept}, b -> b.text), '\\n')").alias("text"),
        F.expr("coalesce(size(templates), 0)").alias("n_templates"),
    )
