"""Operator 7: the main text of web pages, without the templates of their sites.

Every page is read into elements, each with a hash of its subtree. Spark counts on
how many different pages of a host a subtree occurs; those on many are the site's
template and are deleted from its pages, as are elements that their tag, role or
class names as no part of an article.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.session import materialize, ship_package, sized

# Kinds of subtrees, in the last two bits of their hash: boxes, long ones and prose, prose inside an article.
BOX, LONG, PROSE_IN_ARTICLE = 0, 1, 2
MIN_PAGES = {BOX: 8, LONG: 8, PROSE_IN_ARTICLE: 32}  # different pages of a host that a template subtree is on, at least,
# and their share of all different pages of the host. Articles share sentences, and near copies of one most of theirs.
MIN_SHARE = {BOX: 0.02, LONG: 0.25, PROSE_IN_ARTICLE: 0.5}
ENOUGH = {BOX: 100, LONG: 1000, PROSE_IN_ARTICLE: float("inf")}  # pages that suffice whatever their share
LONG_WORDS = 50  # outside links
CELL_WORDS = 4  # shorter cells hold values or labels

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCK = frozenset(["p"])
SELF_CLOSING = {  # an opening tag ends an open element of these, up to the nearest container
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
CONTAINERS = frozenset("ul ol dl table select body article main section div aside nav".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
MAIN = frozenset(["article", "main"])
ROOTS = MAIN | {"html", "body"}
CELLS = frozenset("td th dt dd".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li figcaption".split()) | CELLS | INLINE
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# No part of an article, by tag, role and words of class or id.
DROPPED_TAGS = frozenset(
    "head title nav header footer aside form script style noscript template iframe svg canvas button select textarea "
    "input object dialog menu".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus footer masthead menu nav navbar navigation newsletter notice notices popup promo promotion related "
    "respond share sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split()
)
# Words that a name made of them and the above ones may have besides; others give it a meaning of its own.
NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box btn button buttons container content entry form global group header icons inner item items "
    "left link links list main mobile module outer panel post posts primary right row secondary section site signup slot text "
    "thread title top unit wrap wrapper".split()
)
# An article within these is none of the page's own: comments and teasers.
APART_TAGS = frozenset("nav footer aside dialog menu".split())
APART_ROLES = DROPPED_ROLES - {"banner"}
APART_WORDS = frozenset("comment comments disqus footer menu nav navigation related respond sidebar".split())


@dataclass
class Element:
    tag: str
    begin: int  # place of the opening in the page's events
    dropped: bool
    parts: list[str] = field(default_factory=list)  # of the subtree's fingerprint
    inside: bool = False  # of an article
    parent: Element | None = None
    has_text: bool = False  # of its own
    words: int = 0  # of the subtree,
    linked: int = 0  # and those of them in links
    end: int = 0
    hash: int = 0
    apart: bool = False  # in or itself an element whose articles are not the page's own
    main: bool = False  # an article of the page itself
    holds_main: bool = False


def named(value: str, words: frozenset[str]) -> bool:
    """One of the names in ``value`` is made of ``words`` and neutral ones."""
    for name in value.split():
        parts = {w for w in re.split(r"[^a-z0-9]+", name) if w and not w[0].isdigit()}
        if not parts.isdisjoint(words) and parts <= DROPPED_WORDS | NEUTRAL_WORDS:
            return True
    return False


def dropped(tag: str, attrs: list[tuple[str, str | None]], inside: bool = False) -> bool:
    """An element, ``inside`` an article or not, is no part of an article by its own tag and attributes."""
    if tag in DROPPED_TAGS:
        return True
    if tag in ROOTS:
        return tag == "article" and any(n == "class" and named((v or "").lower(), APART_WORDS) for n, v in attrs)
    for name, value in attrs:
        if name == "hidden":
            return True
        value = (value or "").lower()
        if name == "role" and value in DROPPED_ROLES:
            return True
        if name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
        # Ids of headings and sections in an article are made of their titles.
        if name == "class" and tag not in HEADINGS or name == "id" and not (tag in HEADINGS or inside and tag == "section"):
            if named(value, DROPPED_WORDS):
                return True
    return False


def apart(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Articles in a dropped element of this kind are not the page's own."""
    if tag in APART_TAGS or tag in ROOTS:
        return True
    values = [(name, (value or "").lower()) for name, value in attrs]
    return any(n == "role" and v in APART_ROLES or n in ("class", "id") and named(v, APART_WORDS) for n, v in values)


class Page(HTMLParser):
    """The events of a page in order: its texts, and its elements at their openings and closings."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[str | Element] = []
        self.open: list[Element] = []
        self.tags: Counter[str] = Counter()  # of the open elements
        self.elements: list[Element] = []
        self.feed(html)
        self.close()
        while self.open:
            self.shut()

    def shut(self) -> Element:
        """Close the innermost element."""
        element = self.open.pop()
        self.tags[element.tag] -= 1
        element.end = len(self.events)
        self.events.append(element)
        element.hash = xxhash.xxh64_intdigest("\x00".join([element.tag, *element.parts]))
        if self.open:
            self.open[-1].parts.append(f"\x01{element.hash}")
            self.open[-1].words += element.words
            self.open[-1].linked += element.words if element.tag == "a" else element.linked
            if element.holds_main or element.main:
                self.open[-1].holds_main = True
        return element

    def shut_if_open(self, tags: frozenset[str]) -> None:
        """Close the nearest open element of ``tags`` that no container separates from here."""
        if not any(self.tags[tag] for tag in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag in tags:
                while len(self.open) > i:
                    self.shut()
                return
            if self.open[i].tag in CONTAINERS:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SELF_CLOSING:
            self.shut_if_open(SELF_CLOSING[tag])
        elif tag not in INLINE and tag not in VOID:
            self.shut_if_open(CLOSED_BY_BLOCK)
        parent = self.open[-1] if self.open else None
        inside = parent is not None and (parent.inside or parent.main)
        element = Element(tag, len(self.events), dropped(tag, attrs, inside), inside=inside, parent=parent)
        element.apart = (parent is not None and parent.apart) or (element.dropped and apart(tag, attrs))
        element.main = tag in MAIN and not element.apart
        self.events.append(element)
        self.elements.append(element)
        self.open.append(element)
        self.tags[tag] += 1
        if tag in VOID:
            self.shut()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, the slash is not looked at

    def handle_endtag(self, tag: str) -> None:
        if self.tags[tag]:
            while self.shut().tag != tag:
                pass

    def handle_data(self, data: str) -> None:
        self.events.append(data)
        if self.open and (words := data.split()):
            self.open[-1].parts.append(" ".join(words))
            self.open[-1].has_text = True
            self.open[-1].words += len(words)

    def candidates(self) -> Iterator[tuple[Element, int]]:
        """Elements of the text that may belong to a template, and their keys: the hash with the kind as its last bit.

        Not those that hold the article, and of those inside it no part of a sentence and no short cell.
        """
        has_main = any(e.main for e in self.elements)
        end = 0
        for e in self.elements:
            if e.begin < end:
                continue
            if e.dropped and not e.holds_main:
                end = e.end
            elif e.parts and e.tag not in ROOTS and not e.holds_main and (e.inside or not has_main):
                prose = e.inside and e.tag in PROSE
                if prose and e.tag in INLINE and (e.parent.tag in PROSE or e.parent.has_text):
                    continue
                if prose and e.tag in CELLS and e.words < CELL_WORDS:
                    continue
                long = e.tag in PROSE or e.words - e.linked >= LONG_WORDS
                yield e, e.hash & ~3 | (PROSE_IN_ARTICLE if prose else LONG if long else BOX)

    def text(self, templates: set[int]) -> str:
        """What is left of the articles, or of the body if there is none, blocks parted by one space."""
        deleted = {id(e) for e, key in self.candidates() if key in templates} if templates else set()
        has_main = any(e.main for e in self.elements)
        out: list[str] = []
        within, i = 0, 0
        while i < len(self.events):
            event = self.events[i]
            if isinstance(event, str):
                if within or not has_main:
                    out.append(event)
            elif i == event.begin:
                if (event.dropped and not event.holds_main) or id(event) in deleted:
                    i = event.end
                    out.append(" " if event.tag not in INLINE else "")
                else:
                    within += event.main
                    out.append(" " if event.tag not in INLINE else "")
            else:
                within -= event.main
                out.append(" " if event.tag not in INLINE else "")
            i += 1
        return " ".join("".join(out).split())


def host_of(url: str = "url") -> F.Column:
    """Host of a URL in lower case, empty without one."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(host)


def subtrees(pages: DataFrame) -> DataFrame:
    """host, html_hash, hash and page (fingerprint of the page's text) of every candidate subtree, once per page."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, htmls, found, prints = [], [], [], []
            for host, html_hash, html in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True
            ):
                page = Page(html.as_py())
                main = xxhash.xxh64_intdigest(page.text(set()))
                for key in [None, *{key for _, key in page.candidates()}]:  # the null counts the page itself
                    hosts.append(host)
                    htmls.append(html_hash)
                    found.append(None if key is None else key - (1 << 63))
                    prints.append(main - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *[pa.array(c, pa.int64()) for c in (htmls, found, prints)]],
                ["host", "html_hash", "hash", "page"],
            )

    kinds = "host string, html_hash bigint, hash bigint, page bigint"
    return pages.select("host", "html_hash", "html").mapInArrow(hashes, kinds)


def by_kind(values: dict[int, float]) -> F.Column:
    kind = F.col("hash").bitwiseAND(3)
    return F.when(kind == BOX, float(values[BOX])).when(kind == LONG, float(values[LONG])).otherwise(float(values[PROSE_IN_ARTICLE]))


def site_templates(found: DataFrame) -> DataFrame:
    """host and hash of every template subtree, from the rows of ``subtrees``.

    Pages with the same text count once, so that copies of an article do not turn it into a template.
    """
    different = found.select("host", "hash", "page").distinct()
    counts = materialize(different.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("pages")), "subtree_counts")
    totals = counts.where("hash IS NULL").select("host", F.col("pages").alias("total"))
    often = counts.where((F.col("pages") >= by_kind(MIN_PAGES)) & F.col("hash").isNotNull())
    least = F.least(by_kind(MIN_SHARE) * F.col("total"), by_kind(ENOUGH))
    recurring = often.join(sized(totals), "host").where(F.col("pages") >= least)
    return materialize(recurring.select("host", "hash"), "site_templates")


def templates_of_pages(pages: DataFrame) -> DataFrame:
    """host, html_hash and the template subtrees of the pages that have any; a list is no longer than its page."""
    found = materialize(subtrees(pages), "subtrees")
    hits = found.join(sized(site_templates(found)), ["host", "hash"]).select("host", "html_hash", "hash").distinct()
    written = materialize(hits, "template_hits")
    lists = written.groupBy("host", "html_hash").agg(F.collect_list("hash").alias("templates"))
    return sized(lists, bound=written)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page has an empty text; a null or malformed url belongs to an empty host; repeated rows
    give equal texts; an empty table gives no rows; unclosed and crossed tags are closed the way
    browsers do; columns other than page_id, url and html are not looked at. Html is read twice
    and only shuffled when the table of the pages' templates is too large to broadcast.
    """
    ship_package(pages.sparkSession)
    rows = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"),
        pages["url"].alias("url"),
        F.coalesce(pages["html"], F.lit("")).alias("html"),
    ).withColumns({"host": host_of(), "html_hash": F.xxhash64("html")})
    templates = templates_of_pages(rows)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, found in zip(batch.column(2), batch.column(3), strict=True):
                texts.append(Page(html.as_py()).text({h + (1 << 63) for h in found.as_py() or ()}))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    joined = rows.join(templates, ["host", "html_hash"], "left").select("page_id", "url", "html", "templates")
    return joined.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
