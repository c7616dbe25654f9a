"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative, by weights
learned from labelled pages: the log-odds of a kind of word or tag inside the article
against outside. One linear scan finds the contiguous region with the largest sum; its
blocks, without the asides it may contain, are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED_PAGES = 2000

#: Elements whose content is never text of the page.
_RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title",
        "select", "button", "object", "canvas", "math", "head")
#: Elements that stand beside an article.
_ASIDE = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "fieldset"}
#: Words in a class, id or role that mark what stands beside an article.
_ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "byline", "comment", "comments", "commentlist", "complementary",
    "contentinfo", "cookie", "cookies", "consent", "disqus", "dialog", "footer", "form",
    "gdpr", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "notification", "outbrain", "pager",
    "pagination", "popup", "popover", "promo", "promoted", "promotion", "recommended",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup",
    "sitemap", "skip", "social", "sponsor", "sponsored", "subscribe", "taboola", "tags",
    "toc", "toolbar", "topbar", "widget", "widgets",
}
#: Elements that begin and end a block of text.
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li",
    "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_ARTICLE = {"article", "main"}

#: A quote opens a value only behind ``=``, and only if it is closed; any other quote is an
#: ordinary character of the tag.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_TOLD = {"class", "id", "role", "hidden", "aria-hidden", "style"}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """A run of text between block tags: its parts, and its score when it is scanned."""

    parts: list[str] = field(default_factory=list)
    beside: bool = False


@dataclass
class Page:
    """Words and tags in page order, as (kind, block); block -1 stands for a tag."""

    kinds: list[str] = field(default_factory=list)
    of_block: list[int] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    articles: int = 0


#: With one of these words in front, a name is of an aside as well.
_ASIDE_FIRST = {"ad", "ads", "advert", "comment", "comments", "cookie", "cookies", "disqus",
                "newsletter", "outbrain", "sponsored", "taboola"}
#: What is closed by the next element of its kind.
_CLOSED_BY_NEXT = {"li", "dd", "dt", "td", "th", "tr", "option"}
#: An element that only has an aside's word somewhere in its name is none if it holds this
#: share of the words that stand in no certain aside.
_WRAPS = 0.5


def _stands_beside(name: str, attributes: str, in_article: bool) -> str:
    """Whether an element stands beside the article: ``yes``, ``maybe`` or nothing.

    Certain are elements that say so, what is hidden, and names that are an aside's word or
    end in one (``site-footer``). A name with such a word elsewhere is a ``maybe``.
    """
    if name in _ASIDE and not (name == "header" and in_article):
        return "yes"
    if name in _ARTICLE or name in ("html", "body"):
        return ""
    words = _ASIDE_WORDS - {"header"} if in_article else _ASIDE_WORDS
    found = ""
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key not in _TOLD:
            continue
        if value[:1] in ("'", '"') and value[-1:] == value[:1]:
            value = value[1:-1]
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return "yes"
        if key == "style" and _HIDDEN.search(value):
            return "yes"
        if key in ("class", "id", "role"):
            for token in value.split():
                parts = [part.lower() for part in _NAME_PARTS.findall(token)]
                if words.isdisjoint(parts):
                    continue
                if parts[-1] in words or parts[0] in _ASIDE_FIRST:
                    return "yes"
                found = "maybe"
    return found


def _unclosed(source: str) -> set[int]:
    """Where elements that stand beside begin that are never closed."""
    opened: dict[str, list[int]] = {}
    for found in _ASIDE_TAGS.finditer(source):
        name = found[2].lower()
        if not found[1]:
            opened.setdefault(name, []).append(found.start())
        elif opened.get(name):
            opened[name].pop()
    return {at for places in opened.values() for at in places}


_ASIDE_TAGS = re.compile(rf"<(/?)({'|'.join(sorted(_ASIDE))})(?=[\s/>])", re.IGNORECASE)


@dataclass
class _Aside:
    """An open element that stands beside: its depth, and the ``maybe`` it is, if any.

    One that is never closed ends where a paragraph, heading or article begins.
    """

    depth: int
    maybe: int | None
    unclosed: bool


def parse_page(source: str) -> Page:
    """Words, tags and blocks of a page in one pass; broken markup never fails.

    An element ends with the one around it, whether it is closed or not.
    """
    page = Page(blocks=[Block()])
    stack: list[str] = []
    asides: list[_Aside] = []
    certain: list[bool] = []  # for words: in a certain aside?
    maybes: list[frozenset[int]] = []  # for words: the uncertain asides they are in
    block_maybes: list[frozenset[int]] = [frozenset()]
    unclosed = _unclosed(source)
    links = headings = open_articles = n_maybes = 0
    at, n = 0, len(source)
    now_certain, now_maybes = False, frozenset()

    def mark() -> None:
        nonlocal now_certain, now_maybes
        now_certain = any(a.maybe is None for a in asides)
        now_maybes = frozenset(a.maybe for a in asides if a.maybe is not None)

    def text(raw: str) -> None:
        if not raw:
            return
        plain = html.unescape(raw)
        block = page.blocks[-1]
        if (now_certain or now_maybes) and not "".join(block.parts).strip():
            block.beside, block_maybes[-1] = now_certain, now_maybes
        block.parts.append(plain)
        kind = "word:link" if links else "word:heading" if headings else "word:plain"
        for _ in plain.split():
            page.kinds.append(kind)
            page.of_block.append(len(page.blocks) - 1)
            page.inside.append(page.articles > 0 and open_articles > 0)
            certain.append(now_certain)
            maybes.append(now_maybes)

    def new_block() -> None:
        if page.blocks[-1].parts:
            page.blocks.append(Block())
            block_maybes.append(frozenset())
        page.blocks[-1].beside, block_maybes[-1] = now_certain, now_maybes

    def shorten(depth: int) -> None:
        nonlocal open_articles
        for name in stack[depth:]:
            open_articles -= name in _ARTICLE
        del stack[depth:]
        if asides and asides[-1].depth >= depth:
            while asides and asides[-1].depth >= depth:
                asides.pop()
            mark()

    while at < n:
        found = _TOKEN.search(source, at)
        if found is None:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        if found[2] is None or not found[4]:
            continue  # a comment, a declaration, or a tag that the page's end cuts off
        name, closing = found[2].lower(), bool(found[1])
        empty = found[3].endswith("/") and not found[3].endswith("=/")
        if not closing and name in _RAW and not empty:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.IGNORECASE).search(
                source, at
            )
            if end is None and name == "head":
                continue
            close = source.find(">", end.end()) if end else -1
            at = n if close < 0 else close + 1
            continue
        if name in _BLOCK:
            new_block()
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth] == name:
                    shorten(depth)
                    break
            links -= name == "a" and links > 0
            headings -= name in _HEADINGS and headings > 0
        elif name not in _VOID and not empty:
            if stack and (
                (stack[-1] == "p" and name in _BLOCK)
                or (stack[-1] == name and name in _CLOSED_BY_NEXT)
            ):
                shorten(len(stack) - 1)
            if asides and asides[-1].unclosed and (name == "p" or name in _HEADINGS | _ARTICLE):
                asides.pop()
                mark()
            beside = _stands_beside(name, found[3], open_articles > 0)
            if beside:
                maybe = None if beside == "yes" else n_maybes
                n_maybes += beside == "maybe"
                asides.append(_Aside(len(stack), maybe, found.start() in unclosed))
                mark()
            elif name in _ARTICLE:
                page.articles += not now_certain
            open_articles += name in _ARTICLE
            stack.append(name)
            links += name == "a"
            headings += name in _HEADINGS
        elif name == "br":
            page.blocks[-1].parts.append(" ")
        if name in _BLOCK:
            page.blocks[-1].beside, block_maybes[-1] = now_certain, now_maybes
        page.kinds.append("tag:" + ("/" if closing else "") + name)
        page.of_block.append(-1)
        page.inside.append(open_articles > 0)
        certain.append(now_certain)
        maybes.append(now_maybes)
    _settle(page, certain, maybes, block_maybes, n_maybes)
    return page


def _settle(
    page: Page,
    certain: list[bool],
    maybes: list[frozenset[int]],
    block_maybes: list[frozenset[int]],
    n_maybes: int,
) -> None:
    """Decide which uncertain asides are some, and name words and tags in asides so."""
    held = [0] * n_maybes
    words = 0
    for kind, sure, inside in zip(page.kinds, certain, maybes):
        if kind.startswith("word:") and not sure:
            words += 1
            for k in inside:
                held[k] += 1
    wraps = {k for k in range(n_maybes) if held[k] >= _WRAPS * words}
    for k, (sure, inside) in enumerate(zip(certain, maybes)):
        if sure or inside - wraps:
            kind = page.kinds[k]
            page.kinds[k] = (
                "word:beside" if kind.startswith("word:") else f"tag:beside:{kind[4:]}"
            )
    for block, inside in zip(page.blocks, block_maybes):
        block.beside = block.beside or bool(inside - wraps)


#: Kinds of tags that are told apart; others share one weight.
KNOWN_TAGS = _BLOCK | _VOID | {
    "a", "abbr", "b", "cite", "code", "em", "font", "i", "label", "mark", "q", "s", "small",
    "span", "strong", "sub", "sup", "time", "u",
}


def _kind(kind: str) -> str:
    if kind.startswith("word:"):
        return kind
    place, _, name = kind.rpartition(":")
    return kind if name.lstrip("/") in KNOWN_TAGS else f"{place}:other"


#: Prior counts (inside, outside) of each kind: what holds without any labelled page.
_PRIOR = {
    "word:plain": (20.0, 2.0),
    "word:heading": (10.0, 4.0),
    "word:link": (2.0, 8.0),
    "word:beside": (1.0, 20.0),
}
_TAG_PRIOR = (4.0, 6.0)
_BESIDE_TAG_PRIOR = (1.0, 20.0)
_LEAST, _MOST = 0.02, 4.0


@dataclass(frozen=True)
class Weights:
    """Score of each kind: words that stand in articles above zero, all tags below."""

    by_kind: dict[str, float]

    def of(self, kind: str) -> float:
        kind = _kind(kind)
        if kind not in self.by_kind:
            return _weigh(kind, 0, 0)
        return self.by_kind[kind]


def _weigh(kind: str, inside: float, outside: float) -> float:
    if kind.startswith("word:"):
        a, b = _PRIOR[kind]
        return max(-_MOST, min(_MOST, log((inside + a) / (outside + b))))
    a, b = _BESIDE_TAG_PRIOR if kind.startswith("tag:beside:") else _TAG_PRIOR
    return -max(_LEAST, min(_MOST, -log((inside + a) / (outside + b))))


def learn_weights(pages: DataFrame, labelled_pages: int = LABELLED_PAGES) -> Weights:
    """Weights from pages that label themselves with exactly one article or main element.

    What is in that element and in no aside of it counts as inside. At most
    ``labelled_pages`` pages are used, those whose url and id hash smallest; a page counts
    once, however many rows repeat it, with the least of their sources. Counts by kind
    are summed by Spark, and there are no more kinds than known tags allow.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, list[int]] = {}
            for source in batch.column(0).to_pylist():
                page = parse_page(source or "")
                if page.articles != 1:
                    continue
                for kind, inside in zip(page.kinds, page.inside, strict=True):
                    sums.setdefault(_kind(kind), [0, 0])[not inside] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.string()),
                    pa.array([v[0] for v in sums.values()], pa.int64()),
                    pa.array([v[1] for v in sums.values()], pa.int64()),
                ],
                names=["kind", "inside", "outside"],
            )

    # A null id or url is a value like others.
    key = [
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("page_id", "url")
    ]
    known = pages.select(*key, F.col("html").cast("string"))
    chosen = (
        known.select("page_id", "url")
        .distinct()
        .orderBy(F.xxhash64("page_id", "url"), "page_id", "url")
        .limit(labelled_pages)
    )
    rows = (
        known.join(F.broadcast(chosen), ["page_id", "url"])  # at most that many rows
        .groupBy("page_id", "url")
        .agg(F.min("html").alias("html"))
        .select("html")
        .mapInArrow(count, "kind string, inside bigint, outside bigint")
        .groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()
    )
    return Weights({r["kind"]: _weigh(r["kind"], r["inside"], r["outside"]) for r in rows})


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and end position of the contiguous region with the largest sum; (0, 0) if none.

    Of equal sums the first region is taken, and of those the one that begins last.
    """
    best, region = 0.0, (0, 0)
    total, first = 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, k
        total += score
        if total > best + 1e-12:
            best, region = total, (first, k + 1)
    return region


def main_text(source: str | None, weights: Weights) -> str:
    """The blocks of the best region, whole, without what stands beside the article."""
    if not source:
        return ""
    page = parse_page(source)
    cache: dict[str, float] = {}
    scores = []
    for kind in page.kinds:
        if kind not in cache:
            cache[kind] = weights.of(kind)
        scores.append(cache[kind])
    first, end = best_region(scores)
    held = {b for b in page.of_block[first:end] if b >= 0}
    texts = []
    for k in sorted(held):
        if not page.blocks[k].beside:
            text = " ".join("".join(page.blocks[k].parts).split())
            if text:
                texts.append(text)
    return "\n".join(texts)


def extract_pages(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """One row for each row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``.

    A null or empty html gives an empty text. Without ``weights`` they are learned from
    ``pages`` itself; an empty table leaves what holds without any page. Pages are
    independent: repeated rows and null ids stay as they are. Other columns, whatever their
    names, do not matter. Long pages are read whole, in one pass.
    """
    held = learn_weights(pages) if weights is None else weights
    kinds = ", ".join(
        f"{name} {pages.schema[name].dataType.simpleString()}" for name in ("page_id", "url")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source, held) for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(
        extract, f"{kinds}, text string, n_chars bigint"
    )
