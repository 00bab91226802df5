"""Main text on pages whose marks are renamed or taken away, and on awkward ones."""

from __future__ import annotations

import re

import numpy as np
import pytest

from millrace.llm import extraction
from millrace.sources.lines import table


@pytest.fixture(scope="module")
def model(spark):
    return extraction.train(extraction.sample_pages(table(spark, "/root/testdata/sf0.1", "pages").filter("page_id % 2 = 0")))


@pytest.fixture(scope="module")
def held_out(spark):
    rows = table(spark, "/root/testdata/sf0.1", "pages").filter("page_id % 2 = 1 AND page_id < 400").select("html").collect()
    pages = [r["html"] for r in rows]
    read = [extraction.blocks(p) for p in pages]
    return [(p, b, np.array([extraction.weak_label(x) for x in b], bool)) for p, b in zip(pages, read)]


def f1(model, pairs):
    """By characters, over all pages."""
    right = wrong = missed = 0
    labels = model.label([extraction.vectors(b) for b, _ in pairs])
    for (read, want), got in zip(pairs, labels):
        size = np.array([len(b.text) for b in read])
        right, wrong, missed = right + size[want & got].sum(), wrong + size[~want & got].sum(), missed + size[want & ~got].sum()
    return 2 * right / (2 * right + wrong + missed)


def rewritten(page, start, end):
    return re.sub(r"</article>", end, re.sub(r"<article[^>]*>", start, page))


@pytest.mark.parametrize("start,end", [
    ("<article>", "</article>"), ('<div class="content">', "</div>"), ("<div>", "</div>"), ('<section id="main-col">', "</section>")])
def test_renamed_articles(model, held_out, start, end):
    pairs = [(extraction.blocks(rewritten(p, start, end)), want) for p, _, want in held_out]
    assert all(len(b) == len(w) for b, w in pairs) and f1(model, pairs) >= 0.95


@pytest.mark.parametrize("thread", ['<div id="disqus_thread">{}</div>', '<section class="replies">{}</section>'])
def test_reader_comments_without_their_name(model, held_out, thread):
    said = thread.format("<p>I do not agree with this at all, friends.</p><p>Nor me. Great page though.</p>")
    pairs = []
    for page, _, want in held_out:
        read = extraction.blocks(rewritten(page, '<div class="content">', "</div>").replace("</body>", said + "</body>"))
        pairs.append((read, np.concatenate([want, np.zeros(len(read) - len(want), bool)])))
    assert f1(model, pairs) >= 0.95


def test_more_kinds_of_main_text(model, held_out):
    """Tables, quotes, captions and what follows a ``pre`` inside the article."""
    found = kept = 0
    for i, (page, read, want) in enumerate(held_out):
        inside = "<table><tr><td>Cell of a table</td><td>Another cell</td></tr></table><figure><figcaption>What the picture shows</figcaption></figure><pre>some code</pre><blockquote><p>A quotation that follows the code.</p></blockquote>"
        middle = page.find("</p>", page.find("<article")) + 4
        parts = extraction.blocks(page[:middle] + inside + page[middle:])
        labels = model.label([extraction.vectors(parts)])[0]
        for block, label in zip(parts, labels):
            if block.text in ("Cell of a table", "What the picture shows", "A quotation that follows the code.", "some code"):
                found, kept = found + 1, kept + label
    assert found >= 4 * len(held_out) and kept >= 0.95 * found


def test_a_page_written_by_hand(model):
    words = "The morning was cold and the river lay still under the bridge where they had met."
    page = (
        '<html><body><ul class="topbar"><li><a href="/">Home</a></li><li><a href="/a">About</a></li></ul><div class="content"><h1>On the river</h1>'
        + "".join(f"<p>{words} Part {i}.</p>" for i in range(4)) + '</div><div class="bottom"><a href="/i">Imprint</a></div></body></html>')
    read = extraction.blocks(page)
    kept = [b.text for b, label in zip(read, model.label([extraction.vectors(read)])[0]) if label]
    assert kept == ["On the river", *[f"{words} Part {i}." for i in range(4)]]


def test_disguises_keep_the_blocks(held_out):
    for i, (page, read, _) in enumerate(held_out[:60]):
        assert [b.text for b in extraction.blocks(extraction._disguised(page, i))] == [b.text for b in read]
        assert len(extraction.training_pages(page, i)) == 4


def test_empty_tables_and_pages(spark, model):
    schema = "page_id long, url string, html string, path string, `key` long"
    assert extraction.extract(spark.createDataFrame([], schema), model).count() == 0
    assert extraction.sample_pages(spark.createDataFrame([], schema)) == []
    rows = [(None, None, None, "x", 1), (1, "u", "", "x", 1), (1, "u", "<p>" * 3000, "x", 1), (2, "u", "&lt;&amp;" * 50_000, "x", 1)]
    got = extraction.extract(spark.createDataFrame(rows, schema), extraction.train([]))
    assert sorted((r["page_id"] is None, r["n_chars"]) for r in got.collect()) == [(False, 0), (False, 0), (False, 0), (True, 0)]
