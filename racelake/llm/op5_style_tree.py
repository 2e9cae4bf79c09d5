"""HTML extraction: site style tree.

The DOMs of all pages of a host are merged: an element's place in the style tree is its path
of tags with their class, id and role.  For every place two distributions over the host's
pages are measured, that of the presentation (the sequence of child elements) and that of the
content (the text below it); the importance of the place is the larger of the two entropies,
relative to the logarithm of the number of pages that have the place.  Copies (same host, same
html) are one page.  Places that show the same few things on page after page have a low
importance; a block is removed from a page if it and all places below it have one.  An ancestor of
an important place stays, as do ``html``, ``body``, ``main`` and ``article``; words set apart inside
a block stay or go with it.  A host
whose pages do not differ anywhere gives no evidence, nor does one with
few pages; there, as everywhere, roles that markup states by itself (``nav``, ``footer``,
``form``, a class ``ad``, ...) are removed.  If a page marks its article or main part, only that
part is read, and the tree is asked there too; as the mark speaks for the part, a block of it
goes only if another page of the host shows the same at that place, and a part that would lose
all its text stays as it is.

The distributions are counted by Spark, one row per (distinct page, place) and partial sums per
task, so a host with a third of all pages is not gathered anywhere; a page only gets back the low
places it has.

Text: character references decoded, white space inside a block one space, trimmed, blocks in
page order joined by a blank line.

Cases: null or empty html and pages without main text give an empty text; broken and unclosed
markup is closed as browsers do; a page of any length is read whole; a null url is a host of
its own kind without evidence; repeated rows give one row each; an empty table gives an empty
result; columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import _blocks as B

MIN_PAGES = 5
LOW_IMPORTANCE = 0.5
SCHEMA = "page_id long, url string, text string, n_chars long"

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template svg math iframe object canvas audio video select "
                   "textarea button datalist title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                  "search section summary table tbody td tfoot th thead tr ul caption".split())
CLOSES_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption li dd dt legend summary".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = frozenset("table ul ol dl td th html body article section div".split())

BOILERPLATE = frozenset("nav header footer aside form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
                  "toolbar".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
                  "nav navbar navigation menu breadcrumb breadcrumbs sidebar header masthead footer cookie cookies "
                  "consent gdpr notice notices newsletter subscribe signup login share sharing social comment comments "
                  "disqus replies respond related recommended popup modal overlay toolbar pagination pager widget "
                  "skip copyright".split())
NAME_SPLIT = re.compile(r"[^a-z]+")


PROTECTED = frozenset(("html", "body", "article", "main"))


class _Node:
    __slots__ = ("tag", "path", "noise", "at", "texts", "children")

    def __init__(self, tag: str, path: int, noise: bool, at: int = -1):
        self.tag, self.path, self.noise, self.at = tag, path, noise, at
        self.texts: list[str] = []
        self.children: list[str] = []


def _named(attrs: dict[str, str | None]) -> bool:
    words = NAME_SPLIT.split(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())
    return not NAMES.isdisjoint(words) or (attrs.get("role") or "").lower() in ROLES or "hidden" in attrs or (
        (attrs.get("aria-hidden") or "").lower() == "true")


class _Page(HTMLParser):
    """The blocks of a page, and per style place what it shows."""

    def __init__(self, removed: frozenset[int], measure: bool):
        super().__init__(convert_charrefs=True)
        self.removed, self.measure = removed, measure
        self.elements: list[tuple[int, int | None, str, bool]] = []  # (parent's number, path if read, tag, in the article)
        self.stack = [_Node("", 0, False)]
        self.blocks: list[tuple[bool, str]] = []   # (inside the marked article, text)
        self.parts: list[str] = []
        self.places: dict[int, list] = {}
        self.article = 0
        self.has_article = False

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.blocks.append((self.article > 0, text))

    def _pop(self) -> None:
        node = self.stack.pop()
        if node.tag in BLOCK:
            self._flush()
        if node.tag in ("article", "main") and not node.noise:
            self.article -= 1
        if self.measure and not node.noise:
            place = self.places.setdefault(node.path, [xxhash.xxh64(), xxhash.xxh64()])
            text = " ".join(node.texts)
            place[0].update(text.encode("utf-8", "replace") + b"\\0")
            place[1].update(",".join(node.children).encode() + b"\\0")
            self.stack[-1].texts.append(text)

    def _close(self, tags: set[str] | frozenset[str], scope: frozenset[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, SCOPE)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SCOPE - SIBLINGS[tag])
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                self.handle_data(" " if tag != "wbr" else "")
            return
        own = dict(attrs)
        up = self.stack[-1]
        noise = up.noise or tag in HIDDEN
        if not noise:
            inside = self.article > 0
            noise = (tag in BOILERPLATE and not (tag == "header" and inside)) or (
                tag not in PROTECTED and _named(own)) or (
                tag == "article" and inside)
        name = f"{tag}.{own.get('class') or ''}#{own.get('id') or ''}"
        path = up.path
        if not noise:
            up.children.append(name)
            path = xxhash.xxh64_intdigest(f"{up.path}>{name}") >> 1
        at = len(self.elements)
        self.elements.append((up.at, None if noise else path, tag, self.article > 0))
        noise = noise or at in self.removed
        if tag in ("article", "main") and not noise:
            self.article += 1
            self.has_article = True
        self.stack.append(_Node(tag, path, noise, at))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "use"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        self._close({tag}, frozenset() if tag in BLOCK else frozenset(BLOCK))

    def handle_data(self, data: str) -> None:
        node = self.stack[-1]
        if not node.noise:
            self.parts.append(data)
            if self.measure:
                node.texts.append(data)

    def run(self, html: str) -> _Page:
        self.feed(html)
        self.close()
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        return self

    def text(self) -> str:
        marked = [t for inside, t in self.blocks if inside]
        return "\n\n".join(marked if self.has_article and marked else [t for _, t in self.blocks])


    def branches(self, low: frozenset[int], own: frozenset[int]) -> frozenset[int]:
        """The numbers of the blocks that are of low importance with all that is below them.

        In the marked article the places ``own``, where the page differs from all others, count as important."""
        gone = [(path is None or path in low and not (inside and path in own)) and tag not in PROTECTED
                for _, path, tag, inside in self.elements]
        for at in range(len(self.elements) - 1, -1, -1):
            up = self.elements[at][0]
            if up >= 0 and not gone[at]:
                gone[up] = False
        return frozenset(at for at, (_, path, tag, _) in enumerate(self.elements)
                         if gone[at] and path is not None and tag in BLOCK)


def parse(html: str | None, measure: bool = False, removed: frozenset[int] = frozenset()) -> _Page:
    return _Page(removed, measure).run(html or "")


def main_text(html: str | None, low: frozenset[int], own: frozenset[int] = frozenset()) -> str:
    """The text of a page without its branches of low importance; ``own``: the low places whose content it shares with
    no other page of the host."""
    page = parse(html)
    removed = page.branches(low, own) if low else frozenset()
    if removed:
        less = parse(html, removed=removed)
        if any(inside for inside, _ in less.blocks) or not any(inside for inside, _ in page.blocks):
            page = less
    return page.text()


def _places(pages: DataFrame) -> DataFrame:
    """One row per (distinct page of a host, style place): hashes of its content and presentation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, content, shape, at = [], [], [], []
            for i, html in enumerate(batch.column("html").to_pylist()):
                for path, (c, s) in parse(html, measure=True).places.items():
                    at.append(i)
                    place.append(path)
                    content.append(c.intdigest() >> 1)
                    shape.append(s.intdigest() >> 1)
            page = batch.column("page").take(pa.array(at, pa.int64()))
            host = batch.column("host").take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [page, host, *(pa.array(x, pa.int64()) for x in (place, content, shape))],
                names=["page", "host", "place", "content", "shape"])

    shown = pages.select("page", "host", "html").filter("host is not null")
    return (shown.mapInArrow(run, f"page long, host {dict(shown.dtypes)['host']}, place long, content long, shape long")
            .groupBy("page", "host", "place").agg(F.first("content").alias("content"), F.first("shape").alias("shape")))


def low_places(places: DataFrame) -> DataFrame:
    """(host, place) of low importance."""
    shown = (places.select("host", "place", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("content").alias("v")),
                                                        F.struct(F.lit(1).alias("kind"), F.col("shape").alias("v"))))
                     .alias("s")).select("host", "place", "s.kind", "s.v"))
    times = shown.groupBy("host", "place", "kind", "v").agg(F.count(F.lit(1)).alias("n"))
    entropy = (times.groupBy("host", "place", "kind")
               .agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("s"))
               .select("host", "place", "m", (F.log("m") - F.col("s") / F.col("m")).alias("h")))
    importance = (entropy.groupBy("host", "place").agg(F.max("m").alias("m"), F.max("h").alias("h"))
                  .filter(F.col("m") >= MIN_PAGES)
                  .select("host", "place", (F.col("h") / F.log("m")).alias("importance")))
    differs = importance.groupBy("host").agg(F.max("importance").alias("most")).filter(
        F.col("most") >= LOW_IMPORTANCE)
    return (importance.filter(F.col("importance") < LOW_IMPORTANCE)
            .join(differs.select("host"), "host", "left_semi").select("host", "place"))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.col("html").cast("string").alias("html"))
    own = own.withColumn("host", F.lower(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))
    own = own.withColumn("host", F.when(F.col("host") != "", F.xxhash64("host")))  # shuffled with every place
    own = own.withColumn("page", F.xxhash64("html"))
    places = B.store(spark, _places(own), "places")
    shown = places.select("page", "host", "place", "content").join(low_places(places), ["host", "place"])
    alone = (shown.groupBy("host", "place", "content").agg(F.min("page").alias("page"), F.count(F.lit(1)).alias("n"))
             .filter("n = 1").select("page", "host", "place", F.lit(True).alias("alone")))
    # united, not joined: the places are shuffled by content and by page, not by their own key as well
    mine = (shown.select("page", "host", "place", F.lit(None).cast("boolean").alias("alone")).union(alone)
            .groupBy("page", "host").agg(F.collect_set("place").alias("low"),
                                         F.collect_set(F.when(F.col("alone"), F.col("place"))).alias("own")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, frozenset(low or ()), frozenset(own or ()))
                     for html, low, own in zip(*(batch.column(c).to_pylist() for c in ("html", "low", "own")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return (own.join(mine, ["page", "host"], "left").select("page_id", "url", "html", "low", "own").mapInArrow(run, SCHEMA))


def op5_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, B.table(spark, sf_dir, "pages"))
