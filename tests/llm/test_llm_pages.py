"""Main text of pages whose markup the table's own pages never show."""

import numpy as np
import pytest

from cadence.llm import extraction
from cadence.llm.common import table

A, B, C = "The water rose for nine days and reached the gardens.", "Nobody had expected it so early, though some had spoken of it.", "By evening the road was dry again, they said."
HEAD = "<h1>The river in spring</h1>"
SHAPES = {
    "list": f"{HEAD}<p>{A}</p><ul><li>First thing to bring</li><li>Second thing to bring</li></ul><p>{B}</p>", "numbered": f"{HEAD}<ol><li>{A}</li><li>{B}</li></ol>",
    "divisions": f"{HEAD}<div>{A}</div><div>{B}</div><div>{C}</div>", "breaks": f"{HEAD}{A}<br><br>{B}<br>{C}", "sections": f"{HEAD}<p>{A}</p><section><h2>Part two</h2><p>{B}</p></section><section><h2>Part three</h2><p>{C}</p></section>",
    "table": f"{HEAD}<p>{A}</p><table><tr><th>Year</th><th>Height</th></tr><tr><td>1901</td><td>4 m</td></tr></table><p>{B}</p>", "quote": f"{HEAD}<p>{A}</p><blockquote><p>{B}</p></blockquote><p>{C}</p>",
    "headings": f"{HEAD}<p>{A}</p><h3>Later</h3><p>{B}</p>", "code": f"{HEAD}<p>{A}</p><pre>x = 1</pre><p>{C}</p>", "figure": f"{HEAD}<p>{A}</p><figure><img src=x><figcaption>The river</figcaption></figure><p>{B}</p>",
    "definitions": f"{HEAD}<dl><dt>River</dt><dd>{A}</dd><dt>Road</dt><dd>{C}</dd></dl>", "header": f"<header>{HEAD}</header><p>{A}</p><p>{B}</p>", "paragraphs": f"{HEAD}<p>{A}</p><p>{B}</p>"}
COMMENTS = '<section class="comments"><h2>Comments</h2><article class="comment"><p>I do not agree at all.</p></article><article class="comment"><p>Well said, neighbour.</p></article></section>'


def page(opened, inside, closed):
    return (f'<html><head><title>x</title></head><body><header><a href="/">Home</a></header><nav><ul><li><a href="/a">News</a></li><li><a href="/b">About us</a></li></ul></nav><div class="ad">Buy one now</div>'
            f'{opened}{inside}{closed}<aside><h3>Related</h3><ul><li><a href="/c">More like this</a></li></ul></aside><footer>&copy; Example</footer></body></html>')


def wanted(inside):
    return "\n\n".join(b[2] for b in extraction.blocks(inside))


@pytest.fixture(scope="module")
def model(spark):
    pages = sorted(r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect())
    return extraction.train(extraction.training_pages(pages[:200]))


@pytest.mark.parametrize("shape", SHAPES)
def test_marked_articles_of_any_shape_are_whole(model, shape):
    assert extraction.extract(page("<article>", SHAPES[shape], "</article>"), *model) == wanted(SHAPES[shape])
    assert extraction.extract(page("<main>", SHAPES[shape], "</main>"), *model) == wanted(SHAPES[shape])
    assert extraction.extract(page("<article>", SHAPES[shape] + COMMENTS, "</article>"), *model) == wanted(SHAPES[shape])


@pytest.mark.parametrize("opened", ['<div class="content">', "<div>"])
def test_unmarked_articles_of_any_shape(model, opened):
    """Without an article element: most shapes exactly, and nothing foreign."""
    exact = 0
    for inside in SHAPES.values():
        got = extraction.extract(page(opened, inside, "</div>"), *model)
        exact += got == wanted(inside)
        assert not {"Home", "News", "About us", "Buy one now", "Related", "More like this"} & set(got.split("\n\n"))
    assert exact >= 11


def test_blocks_without_marks(spark, model):
    pages = sorted(r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect())
    right = total = 0
    for h in extraction.training_pages(pages[200:], seed=99):
        found = extraction.blocks(h)
        kept = extraction.viterbi(np.array([model[0][f].sum() for f in extraction.features(found)]), model[1])
        right += sum(k == (b[4] == "1") for k, b in zip(kept, found, strict=True))
        total += len(found)
    assert right / total > 0.98


def test_outer_articles_and_nested_ones():
    h = '<script>var a="<article>";</script><!-- <article> --><article id="1">a<article>b</article>c</article>x<ARTICLE>d</ARTICLE><main>m</main><article>open'
    spans = extraction.outer(h)
    assert [h[b:c] for _, b, c, _ in spans] == ["a<article>b</article>c", "d", "open"]
    labels = [(b[2], b[4]) for b in extraction.blocks(extraction.labelled(h, spans))]
    assert labels == [("a", "1"), ("b", "0"), ("c", "1"), ("x", None), ("d", "1"), ("m", None), ("open", "1")]
    assert extraction.outer("<main>a<main>b</main></main>")[0][:3] == (0, 6, 21) and extraction.outer("<p>none</p>") == []


def test_all_class_words_and_deep_markup_count():
    many = " ".join("abcdefghijklmnop") + " sidebar"
    assert "c:sidebar" in extraction.blocks(f'<div class="{many}"><p>x</p></div>')[0][0]
    deep = "<p>" + "<b>" * 60 + "one<p>two"
    assert [b[2] for b in extraction.blocks(deep)] == ["one", "two"] and "t:b" not in extraction.blocks(deep)[1][0]


def test_a_table_without_marked_pages(spark):
    rows = [(k, "u", page('<div class="post">', SHAPES["paragraphs"].replace("nine", str(k)), "</div>")) for k in range(5)]
    got = extraction.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: wanted(SHAPES["paragraphs"].replace("nine", str(k))) for k in range(5)}
