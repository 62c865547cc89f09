from __future__ import annotations

import html
import re

import numpy as np
import pytest

from tierstone.llm import html_text
from tierstone.llm.queries import table


def declared(page):
    """The blocks of the article element, by the plain layout of the test pages."""
    article = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:h1|p|br)>", article[1]) if article else []
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in parts)
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def labeller(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages").select("html").collect()
    return html_text.train([r["html"] for r in pages][:120])


def text_of(labeller, page):
    names, words = html_text.Slots(html_text.PATH_SLOTS), html_text.Slots(html_text.WORD_SLOTS)
    return html_text.main_texts(labeller, [page], names, words)[0]


def test_held_out_pages(spark, labeller):
    rows = table(spark, "/root/testdata/sf0.01", "pages").select("html").collect()[120:]
    assert np.mean([text_of(labeller, r["html"]) == declared(r["html"]) for r in rows]) > 0.98


def test_held_out_layouts(spark, labeller):
    rows = table(spark, "/root/testdata/sf0.001", "pages").select("html").collect()
    rng = np.random.default_rng(77)
    wrong = total = 0
    for row in rows:
        blocks = html_text.blocks_of(row["html"])
        own = html_text.declared_labels(blocks)
        main = [t for (_, t, _), y in zip(blocks, own) if y][:30]
        made = html_text.variant(rng, main, [t for _, t, _ in blocks])
        marked = html_text.blocks_of(made)
        expected = np.array([html_text.MARK in text for _, text, _ in marked])
        names, words = html_text.Slots(html_text.PATH_SLOTS), html_text.Slots(html_text.WORD_SLOTS)
        clean = html_text.blocks_of(made.replace(html_text.MARK, ""))
        found = labeller.main_blocks([html_text.Page(clean, names, words)])[0]
        wrong += int((found != expected).sum())
        total += len(expected)
    assert wrong / total < 0.04


@pytest.mark.parametrize(
    "page, texts",
    [
        (None, []),
        ("", []),
        ("plain &amp; simple &eacute;&#8364; &am x", ["plain & simple é€ &am x"]),
        ("<p>a <b>b</b>c<p>d\n\n e</p>", ["a bc", "d e"]),
        ("<div>a<script>if (a<b) x('<p>');</script>b</div>", ["a", "b"]),
        ("a<!-- <p>no</p> -->b<style>p{}", ["ab"]),
        ("<p title='a>b'>x</p><a href=\"/\">y", ["x", "y"]),
        ("x<!-- open <p>never", ["x"]),
        ("<title>t</title><body>x<br>y", ["x", "y"]),
    ],
)
def test_blocks(page, texts):
    assert [t for _, t, _ in html_text.blocks_of(page)] == texts


def test_paths_and_links():
    blocks = html_text.blocks_of('<div class="side bar"><ul><li><a>l</a><li>m</ul></div><p>t')
    assert [p for p, _, _ in blocks] == [
        ("div", ".side", ".bar", "ul", "li"), ("div", ".side", ".bar", "ul", "li"), ("p",),
    ]
    assert [s for _, _, s in blocks] == [1.0, 0.0, 0.0]


def test_slopes_match_differences():
    pages = [
        html_text.Page(html_text.blocks_of(p), html_text.Slots(64), html_text.Slots(64))
        for p in ("<p>one two<p>three<div>four", "<li>five")
    ]
    model = html_text.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    labels = np.array([1.0, 0.0, 1.0, 0.0])

    def loss():
        score, _ = model.scores(pages)
        return float(np.mean(np.log1p(np.exp(-(2 * labels - 1) * score))))

    slopes = model.slopes(pages, labels)
    rng = np.random.default_rng(0)
    for name, value in model.p.items():
        for _ in range(4):
            used = np.argwhere(slopes[name] != 0)
            at = tuple(used[rng.integers(len(used))])
            keep, step = value[at], 1e-3
            value[at] = keep + step
            up = loss()
            value[at] = keep - step
            down = loss()
            value[at] = keep
            assert abs((up - down) / (2 * step) - slopes[name][at]) < 2e-3 + 0.05 * abs(slopes[name][at])


def test_edges(spark):
    schema = "page_id long, url string, html string, text string, names int"
    long = "<article>" + "".join(f"<p>paragraph {k} of a long page.</p>" for k in range(3000)) + "</article>"
    rows = [(1, None, None, "x", 1), (None, "u", "", "x", 1), (2, "u", "<p></p>", "x", 1),
            (2, "u", "<p></p>", "x", 1), (3, "v", long, "x", 1)]
    found = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 5 and [r["text"] for r in found][:4] == [""] * 4
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


def long_page(k, paras):
    text = "".join(f"<p>Paragraph {k} {j} of an ordinary long page.</p>" for j in range(paras))
    return f"<nav><a>home</a></nav><article><h1>t{k}</h1>{text}</article><footer>end</footer>"


def test_long_pages_are_learnt_from(spark, monkeypatch):
    """A table of which one page in a hundred is short; empty pages do not thin the sample."""
    given = []
    monkeypatch.setattr(html_text.Labeller, "fit", lambda self, pages, labels: given.append(pages))
    rows = [(k, "u", long_page(k, 5 if k % 100 == 0 else 500)) for k in range(400)]
    rows += [(k, "u", "") for k in range(400, 800)]
    html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert len(given[0]) == html_text.SAMPLE_PAGES * (1 + html_text.VARIANTS)


def test_lessons_are_bounded():
    short = long_page(1, 20)
    blocks, labels, measures = html_text.lesson(short)
    assert blocks == html_text.blocks_of(short)
    assert (measures == html_text.measures_of(blocks)).all()
    deep = "<div class='a b'>" * 3000
    comments = "<div class=comment><p>A comment of some words.</p></div>" * 20_000
    page = deep + long_page(2, 3) + comments + "<p>" + "word " * 100_000 + "<p>" + "x" * 100_000
    blocks, labels, measures = html_text.lesson(page)
    assert len(blocks) == len(labels) == len(measures) <= html_text.LEARN_BLOCKS
    assert labels.sum() == 4 and measures[-1, 2] > 0.99
    assert 0 < sum(len(t) for _, t, _ in blocks) <= html_text.LEARN_CHARS
    assert sum(len(p) for p, _, _ in blocks) <= html_text.LEARN_NAMES
