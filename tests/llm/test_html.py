"""Articles that must not be lost, asides that must be, and what weights are learned from."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from txlake.llm import html_extraction
from txlake.llm.html_extraction import Weights, extract_pages, learn_weights, main_text, parse_page

SF = "/root/testdata/sf0.001"
P = "Several words of a paragraph that belongs to the article and nowhere else."
Q = "Another paragraph with more words, which stands behind the first in the article."
NONE = Weights({})


@pytest.mark.parametrize(
    "source, text",
    [
        (f"<p>See <a href=/it's-here>this</a> page.</p><p>{P}</p>", f"See this page.\n{P}"),
        (f"<p title=don't>{P}</p><p>{Q}</p>", f"{P}\n{Q}"),
        (f"<p title=\"a > b\" class='x > y'>{P}</p id='>'><p>{Q}</p>", f"{P}\n{Q}"),
        (f"<p title=\"never closed>{P}</p><p>{Q}</p>", f"{P}\n{Q}"),
        (f"<p a=\"b\"c'>{P}</p>", P),
        (f"<div class='search-results-article'><p>{P}</p><p>{Q}</p></div>", f"{P}\n{Q}"),
        (f"<section class='social-science'><h2>Title here</h2><p>{P}</p></section>", f"Title here\n{P}"),
        (f"<article><nav><a href=x>Home</a><p>{P}</p><p>{Q}</p></article>", f"{P}\n{Q}"),
        (f"<article><div class=sidebar>Aside words<p>in it</article><p>{P}</p><p>{Q}</p>", f"{P}\n{Q}"),
        (f"<nav><nav>x</nav>y</nav><article><p>{P}</p></article>", P),
        (f"<article><p>{P}</p><div class='related-posts'><p>Read this too</p></div><p>{Q}</p></article>", f"{P}\n{Q}"),
        (f"<article><p>{P}</p><div class='cookie-banner wide'>We use them</div><p>{Q}</p></article>", f"{P}\n{Q}"),
        (f"<article><p>{P}</p></article><div id=comments><p>{Q}</p></div>", P),
        (f"<article title='my class sidebar'><p data-x='class=menu'>{P}</p></article>", P),
        ("<p>", ""),
        ("<div class='nav", ""),
    ],
)
def test_pages(source, text):
    assert main_text(source, NONE) == text


def test_an_element_ends_with_the_one_around_it():
    page = parse_page(f"<div><aside class=x><p>a b</div><p>{P}")
    beside = [b.beside for b in page.blocks if "".join(b.parts).strip()]
    assert beside == [True, False] or beside == [False, False]


def test_learned_from_pages_not_rows(spark):
    """A page whose hash is least, repeated 3000 times, is one of the labelled pages."""
    pages = spark.createDataFrame(
        [(k, f"u{k}", f"<article><p>{'w ' * (k + 1)}</p></article>") for k in range(50)],
        "page_id long, url string, html string",
    )
    least = pages.orderBy(F.xxhash64(F.col("page_id").cast("string"), "url")).first()["page_id"]
    hot = pages.filter(F.col("page_id") == least).crossJoin(spark.range(3000).select())
    seen = []
    weigh = html_extraction._weigh
    html_extraction._weigh = lambda kind, a, b: seen.append((kind, a, b)) or weigh(kind, a, b)
    try:
        both = [learn_weights(df, 20) for df in (pages, pages.union(hot))]
    finally:
        html_extraction._weigh = weigh
    assert both[0] == both[1]
    assert sum(a for kind, a, _ in seen if kind == "tag:p") == 40  # twenty pages, twice


def test_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars long"
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0
    page = f"<article><p>{P}</p></article>"
    rows = [(1, "u", page, "x", 5), (1, "u", page, "x", 5), (None, None, None, None, None), (2, None, "", None, 1)]
    found = extract_pages(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(repr, found.collect())) == sorted(
        [f"Row(page_id=1, url='u', text={P!r}, n_chars={len(P)})"] * 2
        + ["Row(page_id=None, url=None, text='', n_chars=0)", "Row(page_id=2, url=None, text='', n_chars=0)"]
    )


def test_long_pages_in_linear_time():
    def seconds(n):
        source = f"<article>{'<div><p>a word or two <li>x' * n}<p title=\"{'<nav>' * 50}</article>"
        start = time.perf_counter()
        assert len(main_text(source, NONE)) > 10 * n
        return time.perf_counter() - start

    seconds(2000)
    assert seconds(40_000) < 30 * max(seconds(4000), 0.02)


def test_words_of_labelled_pages(spark):
    """Precision and recall of words against the article elements of the tables' pages."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = learn_weights(pages)
    right = found = wanted = 0
    for row in pages.collect():
        page = parse_page(row["html"] or "")
        if page.articles != 1:
            continue
        inside = [
            b
            for b, kind, held in zip(page.of_block, page.kinds, page.inside)
            if held and kind.startswith("word:") and kind != "word:beside"
        ]
        text = main_text(row["html"], weights).split()
        want = " ".join("".join(page.blocks[b].parts) for b in sorted(set(inside))).split()
        left = list(want)
        both = 0
        counts: dict[str, int] = {}
        for w in left:
            counts[w] = counts.get(w, 0) + 1
        for w in text:
            if counts.get(w):
                counts[w] -= 1
                both += 1
        right, found, wanted = right + both, found + len(text), wanted + len(want)
    print(f"precision {right / found:.4f}, recall {right / wanted:.4f} of {wanted} words")
    assert right / found > 0.95 and right / wanted > 0.95
