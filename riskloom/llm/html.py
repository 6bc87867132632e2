"""HTML extraction by consensus of a host's pages.

Every page's containers are scored by the text of the blocks in them; the path of the best one, generalised to tags and
classes without digits, is the page's vote. Spark counts the votes per host, and each page is read again with the path
that won on its host; pages that lack it use their own best container.

Parts that are not the article (menus, headers, footers, sidebars, notices, adverts, forms, comments) are known by their
tag, class, id or role and count neither as text nor as score. The rest of the winning container is kept whole.

Defined results: a null html is empty, an empty page has an empty text; a null url belongs to the host without name;
repeated rows vote each and are read alike; ties of votes go to the higher total score, then the lower path; pages of
any length are read whole; other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import lookup_join, stored
from riskloom.llm.urls import host_of

# Tags by their part in a page.
RAW = "script style noscript template textarea iframe xmp title".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div main section td".split())
ASIDE_TAGS = frozenset(
    "aside button dialog footer form head header input menu nav option select svg".split()
)
# A start tag of the key closes an open element of the value, unless one of SCOPES stands between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = frozenset("article body button div html main ol section table td th ul".split())
# Words of classes, ids and roles that mark parts beside the article.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "consent contentinfo cookie cookies copyright discussion disqus disclaimer footer gdpr header login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted "
    "related replies respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar topbar widget widgets".split()
)

# A tag with its quoted values, for those whose values hold a ">".
TAG = re.compile(r"<[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>")
NAME = re.compile(r"/?([a-z][^\s/>]*)", re.I)
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
ATTRIBUTE = re.compile(
    r"(?<![\w-])(?P<name>class|id|role|hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I
)
WORD = re.compile(r"[a-z]+")


class Element:
    """An element and what is known of those around it, so that nothing has to climb: the nearest block element and the
    nearest container at or above it."""

    __slots__ = ("tag", "step", "parent", "aside", "score", "block", "container", "matched", "inside")

    def __init__(self, tag: str, step: str, parent: Element | None, aside: bool):
        self.tag, self.step, self.parent, self.aside, self.score = tag, step, parent, aside, 0.0
        self.block = self if parent is None or tag in BLOCKS else parent.block
        self.container = self if tag in CONTAINERS else parent and parent.container
        self.matched, self.inside = 0, False

    @property
    def path(self) -> str:
        steps, e = [], self
        while e.parent is not None:
            steps.append(e.step)
            e = e.parent
        return ">".join(reversed(steps))


@dataclass
class Block:
    owner: Element
    text: str


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _attributes(rest: str) -> tuple[list[str], set[str], bool]:
    """Classes, words that may mark a part beside the article, and whether the element is hidden."""
    classes, words, hidden = [], set(), False
    for m in ATTRIBUTE.finditer(rest):
        name, value = m["name"].lower(), entities.unescape(m[2] or m[3] or m[4] or "").lower()
        if name == "class":
            classes = value.split()
        if name in ("class", "id", "role"):
            words.update(WORD.findall(value))
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            hidden = True
    return classes, words, hidden


def _step(tag: str, classes: list[str]) -> str:
    """A generalised step of a path: the tag and its classes without digits."""
    names = sorted({re.sub(r"\d+", "", c) for c in classes} - {""})
    return ".".join([tag, *names])


class Parser:
    """Reads pages; what a tag says is worked out once per distinct tag string."""

    def __init__(self) -> None:
        self.known: dict[str, tuple] = {}

    def _tag(self, token: str) -> tuple:
        """Of the inside of a tag: whether it closes, its name, the step of its path, whether it is beside the article,
        whether it bounds blocks, and whether it has no content to parse."""
        name = NAME.match(token)
        tag, closes = name[1].lower(), token.startswith("/")
        step, beside, rest = tag, tag in ASIDE_TAGS, token[name.end() :]
        if not closes and rest.strip():
            classes, words, hidden = _attributes(rest)
            step = _step(tag, classes)
            named = bool(words & ASIDE_WORDS) and tag not in ("html", "body", "article", "main")
            beside = beside or named or hidden
        whole = tag in VOID or tag in RAW_END or rest.endswith("/") and tag in ("svg", "path")
        found = (closes, tag, step, beside, tag in BLOCKS, whole)
        closed = token.count('"') % 2 == token.count("'") % 2 == 0
        if closed and len(token) <= 200 and len(self.known) < 50_000:
            self.known[token] = found
        return found

    def parse(self, html: str | None) -> Page:
        root = Element("", "", None, False)
        page, stack, parts = Page(), [root], []
        known, unescape = self.known, entities.unescape

        def flush() -> None:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                owner = stack[-1].block
                if not owner.aside:
                    page.blocks.append(Block(owner, text))

        # Where the open elements of each tag are in the stack.
        open_at: dict[str, list[int]] = {}

        def last(tags) -> int:
            found = 0
            for t in tags:
                places = open_at.get(t)
                if places and places[-1] > found:
                    found = places[-1]
            return found

        def close(tags, stop) -> None:
            i = last(tags)
            if i and (i == len(stack) - 1 or last(stop) <= i):
                if any(e.tag in BLOCKS for e in stack[i:]):
                    flush()
                for e in stack[i:]:
                    open_at[e.tag].pop()
                del stack[i:]

        html = html or ""
        at = here = after = 0
        while True:
            start = html.find("<", here)
            if start >= after:
                after = html.find(">", start + 1)
            end = after
            if start < 0 or end < 0:
                break
            if end - start > 200 and not (NAME.match(html, start + 1) or html.startswith(("!", "?"), start + 1)):
                here = start + 1  # a plain "<" far from any end
                continue
            token = html[start + 1 : end]
            found = known.get(token)
            if found is None:
                if token.startswith("!--"):
                    end = html.find("-->", start + 4) + 2
                    end = end if end > 1 else len(html) - 1
                elif not token.startswith(("!", "?")):
                    if not NAME.match(token):
                        here = start + 1  # a plain "<"
                        continue
                    if token.count('"') % 2 or token.count("'") % 2:
                        whole = TAG.match(html, start)
                        end = whole.end() - 1 if whole else end
                        token = html[start + 1 : end]
                    found = self._tag(token)
            if start > at and not stack[-1].aside:
                text = html[at:start]
                parts.append(unescape(text) if "&" in text else text)
            at = here = end + 1
            if found is None:
                continue
            closes, tag, step, beside, block, empty = found
            if closes:
                close((tag,), () if block else BLOCKS)
                continue
            if tag == "br":
                parts.append(" ")
            elif block:
                flush()
                close(("p",), SCOPES)
                if tag in CLOSES:
                    close(CLOSES[tag], SCOPES - CLOSES[tag])
            if empty:
                if tag in RAW_END:
                    close_tag = RAW_END[tag].search(html, at)
                    at = here = close_tag.end() if close_tag else len(html)
                continue
            # The head of an article is part of it; that of a page is not.
            if tag == "header" and beside and (open_at.get("article") or open_at.get("main")):
                beside = False
            above = stack[-1]
            element = Element(tag, step, above, above.aside or beside)
            open_at.setdefault(tag, []).append(len(stack))
            stack.append(element)
            page.elements.append(element)
        if at < len(html) and not stack[-1].aside:
            parts.append(unescape(html[at:]))
        flush()
        return page


def _containers_above(element: Element) -> list[Element]:
    first = element.container
    second = first and first.parent.container
    return [e for e in (first, second) if e]


def best_container(page: Page) -> Element | None:
    """The container with the highest score: the text of blocks right in it, and half of that one level below."""
    for block in page.blocks:
        for weight, container in zip((1.0, 0.5), _containers_above(block.owner), strict=False):
            container.score += weight * len(block.text) * (3 if container.tag in ("article", "main") else 1)
    best = None
    for e in page.elements:
        if e.score and (best is None or e.score > best.score):
            best = e
    return best


def _at_path(page: Page, path: str) -> set[int]:
    """The elements at ``path`` that are no asides. Each knows how much of the path leads to it, -1 if none does."""
    found = set()
    for e in page.elements:
        at, piece = e.parent.matched, e.step if e.parent.parent is None else ">" + e.step
        e.matched = at + len(piece) if at >= 0 and path.startswith(piece, at) else -1
        if e.matched == len(path) and not e.aside:
            found.add(id(e))
    return found


def _text_in(page: Page, chosen: set[int]) -> str:
    """The blocks in the chosen elements; elements come after those around them."""
    for e in page.elements:
        e.inside = e.parent.inside or id(e) in chosen
    return "\n".join(b.text for b in page.blocks if b.owner.inside)


def main_text(page: Page, path: str | None) -> tuple[str, str | None]:
    """The text of the containers at ``path``, or of the page's best one, and the path used."""
    chosen = _at_path(page, path) if path else set()
    text = _text_in(page, chosen) if chosen else ""
    if text:
        return text, path
    best = best_container(page)
    if best is None:
        return "\n".join(b.text for b in page.blocks), None
    return _text_in(page, {id(best)}), best.path


def page_votes(pages: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``score`` of every page that has a container with text."""

    @F.pandas_udf("struct<path: string, score: double>")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = Parser()
        for pages in batches:
            best = [best_container(parser.parse(h)) for h in pages]
            yield pd.DataFrame(
                {
                    "path": pd.Series([b.path if b else None for b in best], dtype=object),
                    "score": [b.score if b else 0.0 for b in best],
                }
            )

    votes = pages.select(host_of(F.col("url")).alias("host"), vote(F.col("html")).alias("v"))
    return votes.select("host", "v.path", "v.score").filter("path is not null")


def host_paths(pages: DataFrame) -> DataFrame:
    """One stored row per host: the path with the most votes. Votes are summed before any shuffle."""
    votes = page_votes(pages).groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").alias("score")
    )
    # min_by over negated counts takes the lower path among equals.
    winner = F.min_by("path", F.struct(-F.col("n"), -F.col("score"), "path")).alias("_voted_path")
    return stored(votes.groupBy(F.col("host").alias("_voted_host")).agg(winner), "html-paths")


def extract(pages: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``text`` and the ``path`` it comes from."""
    if paths is None:
        paths = host_paths(pages)

    @F.pandas_udf("struct<text: string, path: string>")
    def read(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        parser = Parser()
        for html, path in batches:
            done = [main_text(parser.parse(h), p) for h, p in zip(html, path, strict=True)]
            yield pd.DataFrame(done, columns=["text", "path"], dtype=object)

    rows = pages.withColumn("_voted_at", host_of(F.col("url")))
    rows = lookup_join(rows, paths, F.col("_voted_at") == F.col("_voted_host"))
    rows = rows.withColumn("_voted_read", read(F.col("html"), F.col("_voted_path")))
    rows = rows.withColumns({"text": F.col("_voted_read")["text"], "path": F.col("_voted_read")["path"]})
    return rows.drop("_voted_at", "_voted_host", "_voted_path", "_voted_read")
