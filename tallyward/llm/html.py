"""Main text of web pages by paths on which the pages of a host agree.

Each page's containers are scored by the text in them outside links; the deepest container that holds
most of it gets the page's vote. Votes are counted per host and path, where a path is the chain of tags with
their classes, digits taken out. Each page is then read again and its text taken from what the containers
on its host's path have in common, and from its own best container, each widened to the article or main element around it;
all text there that is not marked as something else stays.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import table
from tallyward.plans.durable import durable

# Share of a page's text that the voted container holds at least.
MOST = 0.8
_MARKUP = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
# Name and value, one attribute after the other, so that nothing within a quoted value or a longer name is taken for one.
_ATTRIBUTE = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_TOKEN = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
# Their content is not markup; it ends with their own end tag.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
# A longer path goes on from a hash of what it has so far, so that deep nesting costs no more than its tags.
PATH_CHARS = 1_000
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CONTAINERS = {"body", "main", "article", "section", "div", "td", "center"}
_BLOCKS = _CONTAINERS | {
    "html", "head", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "th",
    "caption", "blockquote", "pre", "figure", "figcaption", "header", "footer", "nav", "aside", "form", "fieldset", "address", "hr",
    "details", "summary", "dialog", "menu", "hgroup", "search", "option", "legend"}
_DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "textarea", "noscript", "template", "svg", "object", "canvas",
            "audio", "video", "dialog", "menu", "search", "script", "style", "title", "iframe", "xmp", "noembed", "noframes"}
# What a class or id names that is not the article, alone or in a compound with words that say only where it stands or of what
# kind of box it is. Any other word, as in form-factor or has-sidebar, makes it a name of something else.
_SIGNS = set("""nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads adsbygoogle gpt adslot advert
adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice popup modal newsletter subscribe
signup share sharing social related recommended recommendations comment comments reply replies disqus form login search toolbar pagination
pager widget widgets copyright disclaimer hidden alert""".split())
_PLACES = set("""site page main global top bottom left right upper lower side inner outer primary secondary post entry article blog list area
wrap wrapper container box bar block section row col column holder panel slot unit zone region item items link links button buttons icons
posts articles stories thread title heading text inline sticky fixed floating small large wide narrow google dfp js c l u""".split())
_TALK = set("comment comments reply replies disqus".split())
_ARTICLE_SIGNS = _SIGNS - {"header", "footer", "search", "form", "share", "social"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
# An opening tag that ends an open element of the same kind.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_FENCES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


@dataclass
class Page:
    """Containers with their parents, paths and tags, and blocks of text with their container and link-free length."""

    parents: list[int] = field(default_factory=lambda: [-1])
    paths: list[str] = field(default_factory=lambda: [""])
    tags: list[str] = field(default_factory=lambda: [""])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    # Elements left out by their class, id or role: the one around each, and whether it can be taken back. Number 0 is none.
    around_marked: list[int] = field(default_factory=lambda: [0])
    may_return: list[bool] = field(default_factory=lambda: [False])
    # The innermost of these around each block.
    marks: list[int] = field(default_factory=list)

    def settle(self) -> None:
        """Drop the blocks of marked elements, but for those of an element that holds most of the page's text: its name is misleading."""
        held = [0] * len(self.around_marked)
        for (_, _, free), mark in zip(self.blocks, self.marks):
            held[mark] += free
        whole = sum(held)
        for mark in range(len(held) - 1, 0, -1):  # what is around stands before
            held[self.around_marked[mark]] += held[mark]
        out = [False] * len(held)
        for mark in range(1, len(held)):
            out[mark] = out[self.around_marked[mark]] or not (self.may_return[mark] and held[mark] >= MOST * whole)
        self.blocks = [block for block, mark in zip(self.blocks, self.marks) if not out[mark]]

    def totals(self) -> list[int]:
        total = [0] * len(self.parents)
        for at, _, free in self.blocks:
            total[at] += free
        for at in range(len(total) - 1, 0, -1):  # parents stand before their children
            total[self.parents[at]] += total[at]
        return total

    def best(self, total: list[int]) -> int:
        at, children = 0, [[] for _ in total]
        for child, parent in enumerate(self.parents[1:], 1):
            children[parent].append(child)
        while children[at]:
            largest = max(children[at], key=lambda c: total[c])
            if total[largest] < MOST * total[0] or not total[largest]:
                break
            at = largest
        return at

    def around(self, some: list[int]) -> int:
        """The outermost article around all of ``some`` containers, or else main, or else the innermost container of all of them."""
        common = [some[0]]
        while common[-1]:
            common.append(self.parents[common[-1]])
        common.reverse()
        # Where each container seen so far joins the first one's line; every container is walked through once.
        joins = {at: i for i, at in enumerate(common)}
        last = len(common) - 1
        for at in some[1:]:
            seen = []
            while at not in joins:
                seen.append(at)
                at = self.parents[at]
            joins.update(dict.fromkeys(seen, joins[at]))
            last = min(last, joins[at])
        del common[last + 1:]
        return next((at for tag in ("article", "main") for at in common if self.tags[at] == tag), common[-1])

    def below(self, tops: set[int]) -> list[str]:
        inside = [False] * len(self.parents)
        for at, parent in enumerate(self.parents):
            inside[at] = at in tops or (parent >= 0 and inside[parent])
        return [text for at, text, _ in self.blocks if inside[at]]


def _names(name: str, signs: set[str]) -> set[str]:
    """The signs in a class or id, if all its words are signs or places."""
    words = set(_TOKEN.findall(name))
    return words & signs if words <= signs | _PLACES else set()


def _step(tag: str, attributes: str, in_article: bool) -> tuple[str, bool, set[str]]:
    """An element's part of the path, whether its tag leaves it out, and what of its attributes does."""
    dropped = tag in _DROPPED or (tag == "header" and not in_article)
    found = {}
    if attributes and not attributes.isspace():
        for name, *values in _ATTRIBUTE.findall(attributes):
            found.setdefault(name.lower(), next((v for v in values if v), ""))
    classes = found.get("class", "").lower().split()
    marks: set[str] = set()
    if tag not in ("html", "body", "main") and found:
        signs = _ARTICLE_SIGNS if tag == "article" else _SIGNS
        for name in [*classes, found.get("id", "").lower()]:
            marks |= _names(name, signs)
        if found.get("role", "").lower() in _ROLES:
            marks.add("role")
        dropped = dropped or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    return ".".join([tag, *sorted({_DIGITS.sub("#", c) for c in classes})]), dropped, marks


def parse(source: str | None) -> Page:
    page = Page()
    if not source:
        return page
    # Of each open element: tag, container, left out, within a link, within an article, the marked element around.
    stack: list[tuple[str, int, bool, bool, bool, int]] = [("", 0, False, False, False, 0)]
    open_tags: Counter[str] = Counter()
    held: list[str] = []
    linked = 0

    def end_block() -> None:
        nonlocal linked
        if held:
            text = " ".join(references.unescape("".join(held)).split())
            if text:
                page.blocks.append((stack[-1][1], text, max(0, len(text) - linked)))
                page.marks.append(stack[-1][5])
            held.clear()
        linked = 0

    def close(depth: int) -> None:
        if any(s[0] in _BLOCKS for s in stack[depth:]):
            end_block()
        for s in stack[depth:]:
            open_tags[s[0]] -= 1
        del stack[depth:]

    at, size = 0, len(source)
    while at < size:
        mark = source.find("<", at)
        match = _MARKUP.match(source, mark) if mark >= 0 else None
        stop = mark + (match is None) if mark >= 0 else size
        if stop > at and not stack[-1][2]:
            text = source[at:stop]
            held.append(text)
            if stack[-1][3]:
                linked += len(" ".join(text.split()))
        if match is None:
            at = stop
            continue
        at = match.end()
        ends, tag, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not tag:
            continue
        tag = tag.lower()
        if ends:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0) if open_tags[tag] > 0 else 0
            if depth and not (tag not in _BLOCKS and any(s[0] in _BLOCKS for s in stack[depth:])):
                close(depth)
            elif tag == "p":
                end_block()
            continue
        if tag in _BLOCKS:
            # A block ends an open paragraph, and what was left open in it.
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] in _BLOCKS), 0)
            if depth and stack[depth][0] == "p":
                close(depth)
            end_block()
        if tag in _CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in _FENCES[tag]:
                    break
                if stack[depth][0] in _CLOSES[tag]:
                    close(depth)
                    break
        if tag == "br":
            if not stack[-1][2]:
                held.append(" ")
            continue
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCKS:
            continue
        _, container, dropped, link, article, mark = stack[-1]
        step, own, signs = _step(tag, attributes, article)
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(source, at)
            at = end.end() if end else size
            continue
        if signs:
            page.around_marked.append(mark)
            # A thread of comments may well be longer than the article.
            page.may_return.append(not signs & _TALK)
            mark = len(page.may_return) - 1
        if tag in _CONTAINERS and not (dropped or own):
            page.parents.append(container)
            path = page.paths[container]
            if len(path) > PATH_CHARS:
                path = hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            page.paths.append(f"{path}/{step}")
            page.tags.append(tag)
            container = len(page.parents) - 1
        open_tags[tag] += 1
        stack.append((tag, container, dropped or own, link or tag == "a", article or tag in ("article", "main"), mark))
    end_block()
    page.settle()
    return page


def vote(source: str | None) -> tuple[str, int] | None:
    """Path of the page's best container, with its text's length; None without text."""
    page = parse(source)
    total = page.totals()
    best = page.best(total)
    return (page.paths[best], total[best]) if total[best] else None


def extract(source: str | None, path: str | None) -> str:
    page = parse(source)
    total = page.totals()
    on_path = [i for i, p in enumerate(page.paths) if path is not None and p == path and total[i]]
    tops = {page.around(some) for some in (on_path, [page.best(total)]) if some}
    return "\n\n".join(page.below(tops))


def _spare(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes on each host, then with the most text, then the first by name."""

    def cast(frames: Iterator) -> Iterator:
        for batch in frames:
            hosts, votes = batch.column("host").to_pylist(), [vote(h) for h in batch.column("html").to_pylist()]
            some = [(h, *v) for h, v in zip(hosts, votes) if v]
            yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in some], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                                             ["host", "path", "chars"])

    votes = pages.select(_host().alias("host"), "html").mapInArrow(cast, "host string, path string, chars long")
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"))
    return counted.groupBy("host").agg(F.max(F.struct("pages", "chars", "path"))["path"].alias("path"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` (url, html, any other columns but html) with ``text`` and ``n_chars``, columns of these names replaced.

    A null or empty page gives an empty text. Pages without a host are one host. Repeated rows vote each and
    give equal texts. An empty table stays empty.
    """
    pages = pages.drop("text", "n_chars")
    rest = [c for c in pages.columns if c != "html"]
    host, path = (_spare(name, pages.columns) for name in ("_host", "_path"))
    # Written down, so that Spark knows its size: as long as it is small it is broadcast and no html is shuffled.
    paths = durable(host_paths(pages), "paths").toDF(host, path)
    joined = pages.withColumn(host, _host()).join(paths, host, "left").select(*rest, "html", path)
    schema = pages.select(*rest, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def read(frames: Iterator) -> Iterator:
        for batch in frames:
            texts = [extract(h, p) for h, p in zip(batch.column("html").to_pylist(), batch.column(path).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], schema.names)

    return joined.mapInArrow(read, schema)


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
