"""Page extraction: parsing, Viterbi against all labellings, held-out layouts, hand-made pages."""

import gc
import itertools
import random
import time
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from harvestry.llm import html_crf

MODEL = html_crf.trained()


def texts(page):
    return [b.text for b in html_crf.leaf_blocks(page)]


@pytest.mark.parametrize("page, want", [
    ("<p>a &amp; b&nbsp;c &lt;d&gt; &#233;</p>", ["a & b c <d> é"]),
    ("<p>one<p>two <b>bold\n\t text</b> on</p>tail", ["one", "two bold text on", "tail"]),
    ("<P CLASS=x>a<BR>b</P><ul><li>c<li>d</ul>", ["a b", "c", "d"]),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><p>x</p>", ["x"]),
    ("<p title='a>b'>x</p><!-- <p>no</p> --><p>y", ["x", "y"]),
    ("<p>flat < 2 km</p><![foo[y]]><p>z</p>", ["flat < 2 km", "z"]),
    ("a<textarea>no</textarea><select><option>no</select>b", ["a", "b"]),
    ("<p>open <b>never closed", ["open never closed"]),
    ("<p>x</p><p", ["x"]), ("", []), ("<div> \n </div>", []), ("<!-- open", [])])
def test_leaf_blocks(page, want):
    assert texts(page) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div class='a b'>", "</div>", "<", ">", "&", "&amp", "x ", "<!--", "-->",
     "<![", "]]>", "<script>", "</script>", "<a href=\"", "\"", "'", "=", "<li>", "</ul>", "<br/>",
     "<title>", "<td>", "\x00", "<svg>", "</"]), max_size=25).map("".join))
def test_any_markup(page):
    blocks = html_crf.leaf_blocks(page)
    assert all(b.text and b.text == " ".join(b.text.split()) for b in blocks)
    assert len(MODEL.labels(blocks)) == len(blocks)


def test_long_pages_in_linear_time():
    page = "<div>" * 20_000 + "<p a=\"x" * 20_000 + "</div>" * 20_000
    html_crf.leaf_blocks(page)
    html_crf.leaf_blocks("<p>word word</p>" * 50_000)


@pytest.mark.parametrize("unit", [
    "<ul><li>x", "<div>x", "<p>x<div>", "<table><tr><td>x", "<div class='a b'>x</span></q>", "<b>x",
    "<article><header>x", "<li>x<select>"])
def test_deep_pages_in_linear_time_and_memory(unit):
    def cost(times):
        gc.collect()
        tracemalloc.start()
        began = time.process_time()
        blocks = html_crf.leaf_blocks(unit * times)
        labels = MODEL.labels(blocks)
        taken, held = time.process_time() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(labels) == len(blocks)
        return taken, held

    cost(100)
    few, many = cost(5_000), cost(50_000)
    assert many[0] < 30 * few[0] + 1 and many[1] < 20 * few[1] + 1_000_000


def plain_path(names):
    """Features of a path from its (tag, words), outermost first."""
    found = {f"t:{tag}" for tag, _ in names} | {f"w:{w}" for _, words in names for w in words}
    if "article" in [tag for tag, _ in names]:
        found |= {f"inner:{tag}" for tag, _ in names if tag in ("header", "aside")}
    if names:
        found |= {f"own:{names[-1][0]}"} | {f"ownw:{w}" for w in names[-1][1]}
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(
    ["<article>", "</article>", "<header class=top>", "</header>", "<aside>", "<div class='a b'>",
     "</div>", "<ul>", "</ul>", "<li>", "<p>", "<b>", "</b>", "x", "<td>", "<table>"]), max_size=30))
def test_path_features_by_new_ones_equal_whole_paths(tags):
    for block in html_crf.leaf_blocks("".join(tags) + "x"):
        names, place = [], block.path
        while place:
            names.insert(0, (place.tag, place.words))
            place = place.parent
        assert html_crf.path_features(block.path) == plain_path(names)


def test_viterbi_finds_the_best_labelling():
    rng = random.Random(3)
    blocks = html_crf.training_pages(1, 5)[0][0][:8]
    names = {f for b in blocks for f in html_crf.path_features(b.path)
             | set(html_crf.text_features(b))}
    for _ in range(20):
        weights = {n: (rng.gauss(0, 1), rng.gauss(0, 1)) for n in sorted(names)}
        turns = tuple(tuple(rng.gauss(0, 2) for _ in range(2)) for _ in range(2))

        def score(labels, weights=weights, turns=turns):
            own = sum(weights[f][y] for b, y in zip(blocks, labels, strict=True)
                      for f in html_crf.path_features(b.path) | set(html_crf.text_features(b)))
            return own + sum(turns[a][b] for a, b in itertools.pairwise(labels))

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=score)
        assert html_crf.Chain(weights, turns).labels(blocks) == list(best)


def test_held_out_layouts():
    pages = html_crf.training_pages(150, seed=901)
    wrong = sum(a != b for blocks, labels in pages
                for a, b in zip(MODEL.labels(blocks), labels, strict=True))
    assert wrong <= 0.01 * sum(len(labels) for _, labels in pages)


PAGE = """<html><body><header class="site-header"><a href="/">The Site</a></header>
<ul class="menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul>
<div class="cookie-notice"><p>We use cookies to improve the site. Accept?</p></div>
<article><h1>A title of some words</h1><p>First paragraph, with a <a href=x>link</a> &amp; more.
<div class="ad"><p>Buy this now, it is good and cheap.</p></div>
<p>Second paragraph here. It has two sentences.</p>
<form><label>Email</label><input><button>Subscribe</button></form><p>Last one.</p></article>
<aside class="sidebar"><h3>Related</h3><p>Another story you may like to read today.</p></aside>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>I liked this article a lot.
</p></div></section><footer><p>© 2020 The Site. All rights reserved.</p></footer></body></html>"""


def test_hand_made_page():
    assert html_crf.main_text(PAGE, MODEL) == (
        "A title of some words\nFirst paragraph, with a link & more.\n"
        "Second paragraph here. It has two sentences.\nLast one.")


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (1, "u", PAGE, "y"), (2, None, None, "z"), (None, "v", "", None)],
        "page_id long, url string, html string, text string")
    out = html_crf.extract(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    rows = out.collect()
    assert len(rows) == 4 and rows[0]["text"] == rows[1]["text"]
    assert [r["n_chars"] for r in rows] == [len(r["text"]) for r in rows]
    assert (rows[2]["text"], rows[3]["text"]) == ("", "")
    assert html_crf.extract(pages.limit(0)).collect() == []


def test_hints_late_in_a_block():
    long_ = "word " * 60
    for hint, name in (("all rights reserved", "rights"), ("cookies", "consent")):
        assert name in html_crf.text_features(html_crf.Block(None, long_ + hint, 0))
    assert "act" not in html_crf.text_features(html_crf.Block(None, long_ + "search", 0))


def test_formulas_are_inline_text():
    page = ("<p>Here <math><semantics><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mspace/>"
            "<mn>4</mn></mrow><annotation encoding='tex'>x^2=4</annotation></semantics></math>"
            " holds.</p><p>y")
    assert texts(page) == ["Here x2=4 holds.", "y"]
    whole = PAGE.replace("Second paragraph here.", "Second <math><mi>e</mi></math> here.")
    assert "Second e here. It has two sentences." in html_crf.main_text(whole, MODEL)
