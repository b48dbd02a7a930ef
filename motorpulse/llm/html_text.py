"""Main text of web pages, without what a site puts on every page.

Pages are parsed on the executors into text blocks. Every element is known by the hash of
its whole subtree; Spark counts these per host and layout, and subtrees that recur across
different articles are deleted as parts of the site's template. What no site has often
enough to count, fixed lists of elements and classes leave out besides.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Set
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import slices, stored, with_column

#: A subtree is template if so many different articles of the host and layout have it ...
LEAST_ARTICLES = 3
#: ... and beyond these this share of all of them ...
LEAST_SHARE = 0.25
#: ... and this share of those that have it are no near copies of the most copied one.
LEAST_OTHERS = 0.25
#: Menus are known by their shape too: tags, classes and order, without the text. They lie
#: outside of articles, hold so many links, and these hold this share of their text.
LEAST_LINKS, LINK_SHARE = 3, 0.8
#: Hashes of templates that go to every task, at most (some 60 MB as Python objects).
BROADCAST_HASHES = 500_000
#: Parts into which the pages of every layout are dealt where there are more.
SALTS = 64

# Elements of the HTML standard by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without any text of the page.
SILENT = frozenset("script style noscript template iframe embed svg head title noembed noframes".split())
NO_ARTICLE = frozenset("nav footer aside map button select textarea dialog menu datalist".split())
CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup popup "
    "modal overlay sidebar nav navbar navigation menu breadcrumb breadcrumbs masthead footer comment "
    "comments disqus respond reply replies share sharing social related recommended widget pagination "
    "pager toolbar login search copyright".split()
)
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
#: Elements that an opening tag of the same kind closes, up to a border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Elements that hold a whole article and are never template themselves.
WHOLES = frozenset("html body main article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INLINE_BORDER = {"td", "th", "table", "button", "object"}

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAME_PART = re.compile(r"[a-z0-9]+")
NUMBER = re.compile(r"[-_]?[0-9]+$")
DIGIT = re.compile(r"[0-9]")


def _values(attributes: str) -> dict[str, str]:
    if not attributes.strip():
        return {}
    return {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}


def _listed(tag: str, values: dict[str, str], inside: bool) -> bool:
    """Whether the lists leave out the element; ``inside`` an article or main they take
    whole class names only, and a heading's id says nothing anywhere."""
    if tag in NO_ARTICLE or (tag == "header" and not inside):
        return True
    if not values:
        return False
    classes = [NUMBER.sub("", c) for c in values.get("class", "").split()]
    if tag in WHOLES:
        return tag == "article" and not COMMENTS.isdisjoint(classes)
    meant = set(classes)
    if not inside:
        names = NAME_PART.findall(" ".join(classes))
        # "has-sidebar" and the like say what stands beside an element, not what it is.
        meant |= {n for n, before in zip(names, ["", *names]) if before not in ("has", "with", "no", "without")}
        if tag not in HEADINGS:
            meant.add(values.get("id", ""))
    style = values.get("style", "").replace(" ", "")
    return (
        not CLASSES.isdisjoint(meant)
        or ("header" in meant and not inside)
        or values.get("role") in ROLES
        or "hidden" in values
        or "display:none" in style
    )


class Block(NamedTuple):
    text: str
    inside: bool  # an article or main element
    listed: bool
    within: int  # the innermost numbered element around it, or -1
    form: int  # the innermost form, or -1


class _Element:
    """An open element: what is known of its subtree so far."""

    __slots__ = ("tag", "kind", "number", "parts", "shapes", "listed", "form", "classes", "chars", "linked", "links", "whole")

    def __init__(self, tag: str, kind: str = "", number: int = -1, listed: bool = False, form: int = -1, classes: str = ""):
        self.tag, self.kind, self.number, self.listed = tag, kind, number, listed
        self.form, self.classes, self.parts, self.shapes = form, classes, [], []
        self.chars = self.linked = self.links = 0
        self.whole = tag in WHOLES


def _digest(parts: list[str]) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "replace"))


class Page:
    """Blocks of one page, in order, and the hashes of all its subtrees.

    Elements are numbered as they open and point to the one around them, so what a page
    takes grows with its length, however deep its markup is.
    """

    def __init__(self, source: str):
        #: Of every numbered element: hash of its subtree, hash of its shape (0: none), parent.
        self.hashes: list[int] = []
        self.shapes: list[int] = []
        self.parents: list[int] = []
        self.blocks: list[Block] = []
        #: Tags and classes of the elements down to the first article or main element.
        self.layout = ""
        self._open: list[_Element] = []
        self._tags: Counter[str] = Counter()
        self._numbers: list[int] = []
        self._silent = self._listed = self._inside = self._links = 0
        # Of every form: the form around it, and whether an article or main is in it.
        self._around_form: list[int] = []
        self._holding: list[bool] = []
        self._forms: list[int] = []
        self._text: list[str] = []
        self._listed_text: list[str] = []
        self._linked = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at = 0
        find = TAG.search
        while (m := find(source, at)) is not None:
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self._close(tag)
                continue
            attributes = m[3] if m[2] else m[6]
            self._start(tag, attributes)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
                at = end.start() if end else len(source)
        if at < len(source):
            self._add(source[at:])
        while self._open:
            self._pop()
        self._flush()

    def _add(self, text: str) -> None:
        if not self._silent:
            (self._listed_text if self._listed else self._text).append(text)
            if self._links:
                self._linked += sum(map(len, text.split()))

    def _flush(self) -> None:
        for parts, listed in ((self._text, False), (self._listed_text, True)):
            if not parts:
                continue
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if not text:
                continue
            within = self._numbers[-1] if self._numbers else -1
            form = self._forms[-1] if self._forms else -1
            self.blocks.append(Block(text, self._inside > 0, listed, within, form))
            if self._open:
                around = self._open[-1]
                around.parts.append(text)
                around.shapes.append("")
                around.chars += len(text) - text.count(" ")
                around.linked += self._linked
        self._linked = 0

    def _push(self, element: _Element) -> None:
        self._open.append(element)
        self._tags[element.tag] += 1

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
            self._close_implied({"p"}, INLINE_BORDER)
        elif tag == "br":
            self._add(" ")
        if tag in CLOSES:
            self._close_implied(*CLOSES[tag])
        if tag in VOID:
            return
        if self._silent or tag in SILENT:
            self._silent += 1
            self._push(_Element(tag, "silent"))
            return
        values = _values(attributes)
        listed = not self._listed and _listed(tag, values, self._inside > 0)
        self._listed += listed
        form, kind, number = -1, "", -1
        if tag == "form":
            form = len(self._holding)
            self._around_form.append(self._forms[-1] if self._forms else -1)
            self._holding.append(False)
            self._forms.append(form)
        classes = values.get("class", "")
        if tag in ("article", "main") and not self._listed:
            kind = "inside"
            self._inside += 1
            if self._forms:
                self._holding[self._forms[-1]] = True
            if not self.layout:
                names = [f"{e.tag}.{e.classes}" for e in self._open] + [f"{tag}.{classes}"]
                # Names with a number in them are often those of the one page.
                self.layout = "\n".join(_plain(n) for n in names)
        elif tag in BLOCKS and tag not in WHOLES:
            number = len(self.hashes)
            self.hashes.append(0)
            self.shapes.append(0)
            self.parents.append(self._numbers[-1] if self._numbers else -1)
            self._numbers.append(number)
        elif tag == "a":
            self._links += 1
        self._push(_Element(tag, kind, number, listed, form, classes))

    def _close_implied(self, tags: set[str], border: set[str]) -> None:
        if not any(self._tags[t] for t in tags):
            return
        for k in range(len(self._open) - 1, -1, -1):
            tag = self._open[k].tag
            if tag in tags:
                while len(self._open) > k:
                    self._pop()
                return
            if tag in border or (tag in BLOCKS and tag not in tags and "p" in tags):
                return

    def _close(self, tag: str) -> None:
        while self._tags[tag]:
            found = self._open[-1].tag == tag
            self._pop()
            if found:
                return

    def _pop(self) -> None:
        e = self._open[-1]
        if e.tag in BLOCKS:
            self._flush()
        self._open.pop()
        self._tags[e.tag] -= 1
        if e.kind == "silent":
            self._silent -= 1
            return
        self._listed -= e.listed
        if e.form >= 0:
            self._forms.pop()
        if e.kind == "inside":
            self._inside -= 1
        elif e.tag == "a":
            self._links -= 1
            e.links += 1
        if e.number >= 0:
            self._numbers.pop()
        if self._open:
            self._open[-1].links += e.links
            self._open[-1].whole |= e.whole
        if not e.parts:  # an inline element: its text is part of the block around it
            if self._open and e.tag == "a":
                self._open[-1].shapes.append("a")
            return
        digest = _digest([e.tag, *e.parts])
        shape = _digest(["shape", f"{e.tag}.{_plain(e.classes)}", *e.shapes])
        if e.number >= 0:
            self.hashes[e.number] = digest - (1 << 63)
            menu = e.links >= LEAST_LINKS and e.linked >= LINK_SHARE * e.chars
            if menu and not self._inside and not e.whole:
                self.shapes[e.number] = shape - (1 << 63)
        if self._open:
            around = self._open[-1]
            around.parts.append(f"{digest:x}")
            around.shapes.append(f"{shape:x}")
            around.chars += e.chars
            around.linked += e.linked

    def subtrees(self) -> list[int]:
        """Hashes of all subtrees with text, and of the shapes of its menus."""
        return list(dict.fromkeys(h for h in (*self.hashes, *self.shapes) if h))

    def unlisted(self) -> list[Block]:
        """Blocks that no list leaves out. A form is left out unless it holds an article or
        main element or half of the page's text."""
        blocks = [b for b in self.blocks if not b.listed]
        chars = [0] * len(self._holding)
        for b in blocks:
            if b.form >= 0:
                chars[b.form] += len(b.text)
        for f in range(len(chars) - 1, 0, -1):
            if self._around_form[f] >= 0:  # forms are numbered from the outside in
                chars[self._around_form[f]] += chars[f]
                self._holding[self._around_form[f]] |= self._holding[f]
        half = sum(len(b.text) for b in blocks) / 2
        out: list[bool] = []
        for f, around in enumerate(self._around_form):
            out.append((around >= 0 and out[around]) or (chars[f] < half and not self._holding[f]))
        return [b for b in blocks if b.form < 0 or not out[b.form]]

    def without(self, recurring: Set[int]) -> list[Block]:
        """The unlisted blocks that are in no recurring subtree."""
        blocks = self.unlisted()
        if not recurring:
            return blocks
        gone: list[bool] = []
        for k, around in enumerate(self.parents):
            found = self.hashes[k] in recurring or self.shapes[k] in recurring
            gone.append(found or (around >= 0 and gone[around]))
        return [b for b in blocks if b.within < 0 or not gone[b.within]]


def _plain(names: str) -> str:
    return " ".join(w for w in names.split() if not DIGIT.search(w))


def main_text(blocks: list[Block]) -> str:
    """Blocks of the article and main elements, or all if those hold less than half."""
    inside = [b for b in blocks if b.inside]
    most = 2 * sum(len(b.text) for b in inside) >= sum(len(b.text) for b in blocks)
    return "\n".join(b.text for b in (inside if most else blocks))


def sketch(blocks: list[Block]) -> int:
    """The least hash of three following words in the longest block: near copies of an
    article mostly share it, two articles do not."""
    words = max((b.text for b in blocks), key=len, default="").split()
    hashes = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15)
    for k in (1, 2):
        if len(words) >= 3:
            mixed = np.bitwise_xor(mixed[:-1] * np.uint64(0xC2B2AE3D27D4EB4F), hashes[k : len(mixed) - 1 + k])
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return int((mixed ^ mixed >> np.uint64(32)).min()) - (1 << 63) if len(words) else 0


HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", re.I)


def _layout(page: Page, url: str | None) -> int | None:
    """Hash of host and layout; null without a host."""
    host = HOST.match(url or "")
    return None if host is None else _digest([f"{host[1].lower()}\n{page.layout}"]) - (1 << 63)


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple[Page, int | None]]]]:
    """Batches of (page_id, url, html, ...), and their pages with their layouts."""
    for batch in slices(batches, 2):
        sources = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        pages = ((url, Page(source or "")) for url, source in sources)
        yield batch, [(page, _layout(page, url)) for url, page in pages]


SEEN = "layout long, article long, sketch long, subtrees array<long>"


def _seen(pages: DataFrame) -> DataFrame:
    """Of every page with a host and text: layout, hash and sketch of its article, subtrees."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parsed in _pages(batches):
            rows = []
            for page, layout in parsed:
                found = page.unlisted()
                if layout is not None and found:
                    article = _digest(["\n".join(b.text for b in found)]) - (1 << 63)
                    rows.append((layout, article, sketch(found), page.subtrees()))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in SEEN.split(", ")])

    return pages.mapInArrow(task, SEEN)


def _with_layouts(pages: DataFrame) -> DataFrame:
    """The pages with their layouts; a page is parsed for that alone."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parsed in _pages(batches):
            layouts = pa.array([layout for _, layout in parsed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, layouts], [*batch.schema.names, "layout"])

    return pages.mapInArrow(task, with_column(pages.schema, "layout", T.LongType()))


def _texts(pages: DataFrame, known: Broadcast | None) -> DataFrame:
    """page_id, url, text of ``pages`` (page_id, url, html and, without ``known``, recurring)."""
    schema = T.StructType([*pages.schema.fields[:2], T.StructField("text", T.StringType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, parsed in _pages(batches):
            if known is not None:
                recurring = [known.value.get(layout, ()) for _, layout in parsed]
            else:
                recurring = [set(r or ()) for r in batch.column(3).to_pylist()]
            texts = [main_text(page.without(found)) for (page, _), found in zip(parsed, recurring)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return pages.mapInArrow(task, schema)


def _templates(seen: DataFrame) -> DataFrame:
    """Hashes of the recurring subtrees of every host and layout: (layout, recurring).

    Articles with one sketch are near copies and count as one; how many different ones
    they are tells copies of an article from a template. No layout has more recurring
    subtrees than four times those of its average page.
    """
    whole = F.array(F.lit(None).cast("long"))  # stands for the article, to count them all
    each = seen.select("layout", "article", "sketch", F.explode(F.concat(whole, "subtrees")).alias("subtree"))
    rows, low, high = F.count("*").alias("rows"), F.min("article").alias("low"), F.max("article").alias("high")
    groups = each.groupBy("layout", "subtree", "sketch").agg(rows, low, high)
    copies = F.when(F.col("low") == F.col("high"), 1).otherwise(F.col("rows"))
    counts = groups.groupBy("layout", "subtree").agg(
        F.count("*").alias("articles"), F.sum(copies).alias("near"), F.max(copies).alias("most")
    )
    # What recurs at all is little beside the subtrees; it is read twice, so it is stored.
    counts = stored(counts.where((F.col("articles") > LEAST_ARTICLES) | F.col("subtree").isNull()))
    totals = counts.where("subtree IS NULL").select("layout", F.col("articles").alias("all"))
    many = counts.where("subtree IS NOT NULL")
    many = many.where(F.col("near") - F.col("most") >= LEAST_OTHERS * F.col("near")).join(totals, "layout")
    many = many.where(F.col("articles") >= LEAST_ARTICLES + LEAST_SHARE * F.col("all"))
    return many.groupBy("layout").agg(F.collect_set("subtree").alias("recurring"))


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html"
) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars.

    Character references are decoded, white space inside a block is one space, blocks
    follow each other in page order with a line feed between. A null or empty page has
    an empty text; unclosed and cut-off markup is closed at the end; pages whose url is
    null or has no host are in no site and lose no template. Equal and nearly equal
    articles count once towards a template, so that copies of an article do not delete
    it. Of what is left, the blocks of the article and main elements are the text, or all
    blocks if those hold less than half of it. One row per row.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html")
    )
    templates = stored(_templates(_seen(rows)))
    return _cleaned(rows, templates).withColumn("n_chars", F.length("text").cast("long"))


def _cleaned(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """The texts of the pages without the templates of their layouts.

    Templates of up to ``BROADCAST_HASHES`` hashes, as counted, go to every task, and no
    page is shuffled. More are joined: pages are dealt to ``SALTS`` parts of their layout.
    """
    if (templates.agg(F.sum(F.size("recurring"))).first()[0] or 0) <= BROADCAST_HASHES:
        known = {r["layout"]: frozenset(r["recurring"]) for r in templates.collect()}
        return _texts(rows, rows.sparkSession.sparkContext.broadcast(known))
    placed = _with_layouts(rows).withColumn("salt", F.pmod(F.xxhash64("html", "page_id", "url"), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    met = placed.join(templates.withColumn("salt", salts), ["layout", "salt"], "left")
    return _texts(met.select("page_id", "url", "html", "recurring"), None)
