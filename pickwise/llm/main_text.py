"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: elements with the same path of styles
(tag, class, id from the root) are one node of the tree. A node's presentation
importance is the entropy of the child styles it shows on different pages; its
content importance falls with the entropy of the spread of its contents over
the pages: a content on one page counts 1, a content on all of them 0. Branches
of nodes with low importance are removed from each page. Copies of a page count
once, and a node must be on ``MIN_PAGES`` pages to be judged.

Menus and notices whose text differs on each page look important to entropies.
So elements whose tag, role, class or id says what they are go first, and where
a page marks its article and most of what remains lies inside, the text is
that, else all that remains; inside an article only branches with a class or id are judged, and the article itself and what holds it stay. Names
are whole classes and ids; where no other article has text, they don't drop
what holds the one with most of the text, and never an outermost article; ids
of headings and sections inside don't count.

A page is read in one pass whose work grows with its length, however deeply it
is nested: a judged element points to the judged element it lies in, a block
to the innermost one, and what is under an element is hashed as a stretch of a
running hash of the blocks.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.shared import slices, stored
from pickwise.llm.url_filter import host_and_path

MIN_PAGES = 4
LOW = 0.2
GAMMA = 0.9
# The running hash of a page's blocks: a polynomial over a Mersenne prime.
PRIME = (1 << 61) - 1
BASE = 0x1F3A5C7E9B2D4F61 % PRIME

# Element kinds of HTML, and names that mark boilerplate.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript textarea title iframe xmp noembed noframes".split())
IN_HEAD = set("title meta link base style script noscript template".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"body", "html"}
DROPPED = set("head nav footer aside form button select menu dialog template svg annotation annotation-xml object canvas audio video".split()) | RAW
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = set(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert"
    " sidebar nav navbar navigation menu breadcrumb breadcrumbs header masthead footer comment comments disqus reply replies respond share sharing"
    " social related recommended newsletter subscribe subscription signup popup modal overlay pagination pager widget login search toolbar"
    " site-header site-footer site-nav page-header page-footer main-nav comment-list comments-area comments-section commentlist".split())
SECTIONS = set("section hgroup h1 h2 h3 h4 h5 h6".split())
# A start tag closes the open element of its group inside the nearest of the group's containers.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I) for tag in RAW}


class Element:
    """An open element. ``at``: the innermost judged element it is or lies in."""

    __slots__ = ("at", "children", "dropped", "first", "judged", "main", "named", "path", "tag")

    def __init__(self, tag: str, path: int, dropped: bool, main: bool, judged: bool, first: int, named: bool = False, at: int = -1):
        self.tag, self.path, self.dropped, self.main, self.judged, self.first, self.named, self.at = tag, path, dropped, main, judged, first, named, at
        self.children: list[str] = []


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(ATTRIBUTE.finditer(text)))} if text.strip(" /\n\t\r\f") else {}


def _says_boilerplate(tag: str, has: dict[str, str], in_main: bool) -> bool:
    """By its tag, role or style."""
    if tag in DROPPED or tag == "header" and not in_main:
        return True
    if not has or tag in ("html", "body"):
        return False
    if has.get("role", "").lower() in ROLES or "hidden" in has or has.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", has.get("style", "").lower()))


def _named_boilerplate(tag: str, has: dict[str, str], in_main: bool) -> bool:
    """By a whole class or the id."""
    if not has or tag in ("html", "body"):
        return False
    named = set(has.get("class", "").lower().split())
    if not (in_main and tag in SECTIONS):
        named.add(has.get("id", "").strip().lower())
    return bool(named & (NAMES - {"header"} if in_main else NAMES))


class Page:
    """One pass over a page. ``blocks``: (text, inside a marked article,
    innermost judged element it is under or -1) in page order, without branches
    that say they are boilerplate; ``paths`` and ``ups``: node of each judged
    element and the judged element it lies in (or -1), outer ones first;
    ``nodes``: (node, style of its children, content) of each of them that has
    text; ``article``: an article tag has text; ``lost``: one lies in
    a branch dropped by its name.
    With ``spare`` names count inside an article only."""

    def __init__(self, html: str, spare: bool = False):
        self.spare, self.lost, self.article = spare, False, False
        self.blocks: list[tuple[str, bool, int]] = []
        self.paths: list[int] = []
        self.ups: list[int] = []
        self.sums = [0]
        self.nodes: list[tuple[int, int, int]] = []
        self.parts: list[str] = []
        self.stack = [Element("", 0, False, False, False, 0)]
        self.open: Counter[str] = Counter()
        self._read(html)

    def _flush(self) -> None:
        if self.parts:
            if text := " ".join("".join(self.parts).split()):
                self.article |= self.open["article"] > 0
                self.blocks.append((text, self.stack[-1].main, self.stack[-1].at))
                self.sums.append((self.sums[-1] * BASE + _hash(text)) % PRIME)
            self.parts.clear()

    def _content(self, first: int) -> int:
        """Hash of the blocks from ``first`` on: equal for equal blocks wherever they stand."""
        return (self.sums[-1] - self.sums[first] * pow(BASE, len(self.blocks) - first, PRIME)) % PRIME

    def _close(self) -> None:
        e = self.stack[-1]
        if e.tag in BLOCK and not e.dropped:
            self._flush()
        self.stack.pop()
        self.open[e.tag] -= 1
        if e.judged and len(self.blocks) > e.first:
            self.nodes.append((e.path, _hash(" ".join(e.children)), self._content(e.first)))

    def _close_to(self, tags: set[str], within: set[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                while len(self.stack) > k:
                    self._close()
                return
            if self.stack[k].tag in within:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "body" or self.stack[-1].tag == "head" and tag not in IN_HEAD:
            self._close_to({"head"}, set())
        if self.open["p"] and tag in CLOSES_P:
            self._close_to({"p"}, {"button", "td", "th", "caption", "object"})
        if tag in SIBLINGS:
            self._close_to(*SIBLINGS[tag])
        up = self.stack[-1]
        self.open[tag] += 1
        if up.dropped:
            has = _attributes(attributes) if up.named else {}
            named = up.named and not _says_boilerplate(tag, has, True)
            self.lost |= named and (tag in ("article", "main") or has.get("role", "").lower() == "main")
            self.stack.append(Element(tag, 0, True, False, False, 0, named))
            return
        if tag in BLOCK:
            self._flush()
        has = _attributes(attributes)
        style = tag + "".join(f".{c}" for c in sorted(has.get("class", "").split())) + (f"#{has['id']}" if "id" in has else "") if has else tag
        up.children.append(style)
        holds = tag in ("article", "main") or has.get("role", "").lower() == "main"
        says, in_article = _says_boilerplate(tag, has, up.main or holds), self.open["article"] > (tag == "article")
        named = not says and (in_article or not (holds or self.spare)) and _named_boilerplate(tag, has, up.main)
        dropped = says or named
        judged = tag in BLOCK and not (dropped or holds or tag in ("html", "body")) and (not up.main or "class" in has or "id" in has)
        path = _hash(f"{up.path}/{style}") if tag in BLOCK else up.path
        if judged:
            self.paths.append(path)
            self.ups.append(up.at)
        self.stack.append(Element(tag, path, dropped, not dropped and (up.main or holds), judged, len(self.blocks), named, len(self.paths) - 1 if judged else up.at))

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            mark = html.find("<", at)
            mark = size if mark < 0 else mark
            if mark > at and not self.stack[-1].dropped:
                text = html[at:mark]
                self.parts.append(unescape(text) if "&" in text else text)
            m = TOKEN.match(html, mark) if mark < size else None
            if m is None:
                if mark < size and not self.stack[-1].dropped:
                    self.parts.append("<")
                at = mark + 1
                continue
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if tag == "br":
                if not self.stack[-1].dropped:
                    self.parts.append(" ")
            elif tag == "hr":
                # a break between blocks, without anything in it
                if self.open["p"]:
                    self._close_to({"p"}, {"button", "td", "th", "caption", "object"})
                if not self.stack[-1].dropped:
                    self._flush()
            elif m[1] or m[4]:
                if self.open[tag] > 0:
                    self._close_to({tag}, set())
            elif tag in RAW:
                rest = RAW_END[tag].search(html, at)
                at = rest.end() if rest else size
            elif tag not in VOID:
                self._start(tag, m[3] or m[6] or "")
        while len(self.stack) > 1:
            self._close()
        self._flush()


def read_page(html: str) -> Page:
    """The page; where its only article lies in a branch dropped by its name
    and has most of the text, the blocks in that branch."""
    page = Page(html)
    if page.lost and not page.article:
        spared = Page(html, spare=True)
        marked = [b for b in spared.blocks if b[1]]
        inside = [b for b in page.blocks if b[1]]
        size = sum(len(b[0]) for b in inside or page.blocks)
        if marked and sum(len(b[0]) for b in marked) - (size if inside else 0) > size:
            spared.blocks = marked
            return spared
    return page


def chosen_text(texts: list[str], inside: list[bool], under: list[int], paths: list[int], ups: list[int], low: set[int] | frozenset[int]) -> str:
    """The blocks outside of all nodes in ``low``, joined by newlines: those
    inside marked articles where they hold most of the text, else all."""
    gone = [False]  # of the page itself, which index -1 would mean
    for path, up in zip(paths, ups, strict=True):
        gone.append(gone[up + 1] or path in low)
    kept = [(text, mark) for text, mark, at in zip(texts, inside, under, strict=True) if not gone[at + 1]]
    marked = [text for text, mark in kept if mark]
    return "\n".join(marked if 2 * sum(map(len, marked)) > sum(len(text) for text, _ in kept) else [text for text, _ in kept])


def main_text(html: str | None, low: frozenset[int] = frozenset()) -> str:
    """Blocks of the main text joined by newlines, without nodes in ``low``."""
    page = read_page(html or "")
    texts, inside, under = (list(x) for x in zip(*page.blocks, strict=True)) if page.blocks else ([], [], [])
    return chosen_text(texts, inside, under, page.paths, page.ups, low)


PARSED = "page_id long, url string, texts array<string>, inside array<boolean>, under array<int>, paths array<long>, ups array<int>, page long, nodes array<struct<node: long, style: long, content: long>>"


def parse(pages: DataFrame) -> DataFrame:
    """Each page once: its blocks with the innermost judged element each is
    under and whether it is inside a marked article, the judged elements, a hash
    of the html, and what the style tree needs of the judged elements."""
    node = pa.struct([("node", pa.int64()), ("style", pa.int64()), ("content", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=256):
            read = [read_page(html or "") for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array([[b[0] for b in p.blocks] for p in read], pa.list_(pa.string())),
                 pa.array([[b[1] for b in p.blocks] for p in read], pa.list_(pa.bool_())), pa.array([[b[2] for b in p.blocks] for p in read], pa.list_(pa.int32())),
                 pa.array([p.paths for p in read], pa.list_(pa.int64())), pa.array([p.ups for p in read], pa.list_(pa.int32())),
                 pa.array([_hash(html or "") for html in batch.column("html").to_pylist()], pa.int64()),
                 pa.array([[{"node": n, "style": s, "content": c} for n, s, c in set(p.nodes)] for p in read], pa.list_(node))],
                ["page_id", "url", "texts", "inside", "under", "paths", "ups", "page", "nodes"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, PARSED)


def cut(pages: DataFrame) -> DataFrame:
    """page_id, url and text of parsed ``pages`` without the nodes in their column ``low`` (null: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list | None, set[int]] = (None, set())
        for batch in slices(batches, rows=256):
            texts = []
            for row in batch.select(["texts", "inside", "under", "paths", "ups", "low"]).to_pylist():
                if row["low"] != held[0]:
                    held = (row["low"], set(row["low"] or ()))
                texts.append(chosen_text(row["texts"], row["inside"], row["under"], row["paths"], row["ups"], held[1]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.select("page_id", "url", "texts", "inside", "under", "paths", "ups", "low").mapInArrow(run, "page_id long, url string, text string")


def importance(nodes: DataFrame) -> DataFrame:
    """(host, node, pages, importance): (1 - g^l) presentation + g^l content
    with l child styles and g = ``GAMMA``. All sums are grouped by hash with
    partial sums first; a host with most pages is no more than a longer sum."""
    nodes = nodes.distinct()
    pages = nodes.groupBy("host", "node", "page").agg(F.min("style").alias("style"))
    styles = pages.groupBy("host", "node", "style").agg(F.count(F.lit(1)).alias("k"))
    m = F.sum("k")
    shown = styles.groupBy("host", "node").agg(
        m.alias("pages"), F.count(F.lit(1)).alias("styles"),
        # entropy of k / m to the base m
        F.when(m > 1, (F.log(m) - F.sum(F.col("k") * F.log("k")) / m) / F.log(m)).otherwise(F.lit(1.0)).alias("shown"))
    spread = nodes.select("host", "node", "page", "content").distinct().groupBy("host", "node", "content").agg(F.count(F.lit(1)).alias("n"))
    held = spread.groupBy("host", "node").agg((F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias("spread"))
    both = shown.join(held, ["host", "node"])
    content = F.when(F.col("pages") > 1, 1 - F.col("spread") / F.log("pages")).otherwise(F.lit(1.0))
    weight = F.pow(F.lit(GAMMA), F.col("styles") - 1)
    return both.select("host", "node", "pages", ((1 - weight) * F.col("shown") + weight * content).alias("importance"))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html; other columns
    are ignored): page_id, url, text, n_chars (code points).

    Null or empty html gives an empty text, a null url counts to the host "",
    repeated rows give a row each, and an empty table gives none. Broken
    markup is read leniently: unclosed elements end with their parent, stray
    end tags are ignored, a tag cut off at the end is dropped. Very long and
    very deeply nested pages are read whole, with work that grows with their
    length. Of blocks half inside and half outside marked articles all stay.
    """
    host, _ = host_and_path(F.col("url"))
    parsed = stored(parse(pages).withColumn("host", F.coalesce(host, F.lit(""))), "pages")
    nodes = parsed.select("host", "page", F.explode("nodes").alias("x")).select("host", "page", "x.*")
    weak = importance(nodes).filter((F.col("pages") >= min_pages) & (F.col("importance") < low))
    # written first, so the planner knows their size and need not move pages to join them
    removed = stored(weak.groupBy("host").agg(F.collect_set("node").alias("low")), "style-tree")
    found = cut(parsed.drop("page", "nodes").join(removed, "host", "left"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
