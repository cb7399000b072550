import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harvestry.functions import markup
from harvestry.operators import extract
from harvestry.sources.documents import index_entries
from harvestry.sources.files import read_rules

HEAD = "http://web:9312/properties/"


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, html string")


def found(html, path):
    root = markup.tree(html)
    return markup.texts(root, root, path, markup.compile_path(path))


@pytest.mark.parametrize("html, path, expected", [
    ("<p>a<p>b<b>c</b>d", "//p/text()", ["a", "b", "d"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "//li/text()", ["a", "b", "c", "d"]),
    ("<ul><li>a<li>b</ul>", "//li[2]/text()", ["b"]),
    ("<ul><li>a<li>b</ul>", "//li[last()]/text()", ["b"]),
    ("<br>x<img src=1>y", "//img/@src", ["1"]),
    ("<script>if (a<b) '<p>'</script><p>t", "//p/text()", ["t"]),
    ("<div><i>x</i></div><div><i>y</i><i>z</i></div>", "//div/i[1]/text()", ["x", "y"]),
    ("<a class='b next c' href='1'><i href='2'></i></a>",
     '//*[contains(@class,"next")]//@href', ["1", "2"]),
    ("<a class='next' href='1'><i href='2'></i></a>",
     '//*[contains(@class,"next")]/@href', ["1"]),
    ("<p id='x'><span>s</span>t</p>", '//*[@id="x"]/span/text()', ["s"]),
    ("<p id='x'><span>s</span><b>u</b>t</p>", '//*[@id="x"]/*/text()', ["s", "u"]),
    ("<p title>t</p><p>u</p>", "//p[@title]/text()", ["t"]),
    ("a &amp; b&pound;", "/text()", ["a & b£"]),
    ("<div><div>in</div>out</div>", "//div//text()", ["in", "out"]),
    ("</p></x>t", "/text()", ["t"]),
    ("", "//p/text()", []),
])
def test_paths(html, path, expected):
    assert found(html, path) == expected


@pytest.mark.parametrize("path", ["", "//p[", "//p/text(", "count(//p)", "//p[a=1]", "p | q"])
def test_paths_outside_the_subset_are_refused(path):
    with pytest.raises(ValueError):
        markup.compile_path(path)


def test_property_page(spark):
    html = """<body><h1 itemprop="name">  it's two-bed flat
        </h1><div><b itemprop="name">second parent</b><b itemprop="name">not first</b></div>
        <span itemprop="price">&pound;1,334.39pw x 2</span>
        <p itemprop="description"> line one <br> line two </p>
        <div itemtype="http://schema.org/Place"> Angel, London </div>
        <img itemprop="image" src="../images/i1.jpg">"""
    url = HEAD + "property_000000.html"
    row = extract.detail_items(pages(spark, (url, html))).first()
    assert row.title == ["It'S Two-Bed Flat", "Second Parent"]
    assert row.price == [1334.39, 2.0]
    assert row.description == ["line one line two"]
    assert row.address == ["Angel, London"]
    assert row.image_urls == ["http://web:9312/images/i1.jpg"]
    assert row.url == [url]


def test_fields_without_values_are_absent(spark):
    row = extract.detail_items(pages(spark, ("http://x/", "<p itemprop='price'>.</p>"))).first()
    assert row.title is None and row.address is None and row.image_urls is None
    assert row.price == [None]  # found, but no number: to be set aside
    assert row.description == [""]


INDEX = """<div class="page next"><a href="index_00001.html"><i href="inner.html">n</i></a></div>
<ul>{}</ul>""".format("".join(f"""
  <li itemtype="http://schema.org/Product"><a itemprop="url" href="property_{i:06d}.html">x</a>
  <h3 itemprop="name">flat {i}</h3><b itemprop="price">{i},000.50</b>
  <p itemtype="http://schema.org/Place"><span> street {i} </span>ignored</p>""" for i in range(3)))


def test_cards(spark):
    url = HEAD + "index_00000.html"
    rows = extract.card_items(pages(spark, (url, INDEX))).orderBy("pos").collect()
    assert [r.title for r in rows] == [["Flat 0"], ["Flat 1"], ["Flat 2"]]
    assert [r.price for r in rows] == [[0.5], [1000.5], [2000.5]]
    assert [r.url for r in rows] == [[f"{HEAD}property_{i:06d}.html"] for i in range(3)]
    assert [r.address for r in rows] == [[f"street {i}"] for i in range(3)]


def test_cards_of_a_page_without_any(spark):
    assert extract.card_items(pages(spark, ("http://x/", "<p>none"))).count() == 0


def test_link_rules(spark):
    url = HEAD + "index_00000.html"
    both = INDEX + '<a itemprop="url" href="index_00001.html">claimed by the first rule</a>'
    rows = extract.page_links(pages(spark, (url, both)), [extract.NEXT_LINKS, extract.ITEM_LINKS])
    links = sorted((r.rule, r.link) for r in rows.collect())
    assert links == [(0, HEAD + "index_00001.html"), (0, HEAD + "inner.html")] + [
        (1, f"{HEAD}property_{i:06d}.html") for i in range(3)]


def test_regions(spark):
    html = '<nav><a href="/a">a</a></nav><a href="/a">a</a><a href="/b">b</a>'
    rows = extract.anchors_by_region(pages(spark, ("http://x/y", html)), ["nav", None]).collect()
    assert sorted((r.rule, r.link) for r in rows) == [(0, "http://x/a"), (1, "http://x/b")]


def test_list_entries(spark):
    html = ('<ul><li><h3>item 12</h3><div class="info">abc</div>'
            "<li><h3>item twelve</h3><div>no</div></ul>")
    rows = extract.list_entries(pages(spark, ("http://x/", html))).orderBy("pos").collect()
    assert [(r.id, r.info) for r in rows] == [(12, ["abc"]), (None, [])]


def test_rule_table(spark, tmp_path):
    table = tmp_path / "todo.csv"
    table.write_bytes(
        b'url,name,price\r'
        b'http://web/a.html,"//*[@id=""itemTitle""]/text()","//*[@id=""prcIsum""]/text()"\r'
        b'http://web/b.html,//h1/text(),//span/strong/text()\r'
        b'http://web/c.html,"//*[@id=""product-desc""]/span/text()",')
    rules = read_rules(spark, str(table))
    assert extract.rule_rows(rules).count() == 5
    site = pages(
        spark, ("http://web/a.html", "<p id=itemTitle>A</p><p id=prcIsum>$1</p>"),
        ("http://web/b.html", "<h1>B</h1><h1>BB</h1><span><strong>2</strong></span>"),
        ("http://web/c.html", "<div id=product-desc><span>C</span></div>"),
        ("http://web/d.html", "<h1>no rule</h1>"))
    items = {r.url: r.fields for r in extract.rule_items(site, rules).collect()}
    assert items == {
        "http://web/a.html": {"name": ["A"], "price": ["$1"]},
        "http://web/b.html": {"name": ["B", "BB"], "price": ["2"]},
        "http://web/c.html": {"name": ["C"]}}
    assert extract.rule_values(extract.rule_items(site, rules)).count() == 6


def test_json_index(spark):
    body = '[{"id": 0, "title": " better set unique "}, {"id": 7, "title": "x"}]'
    rows = index_entries(spark.createDataFrame([(body,)], "body string"), HEAD).collect()
    assert [(r.url, r.title) for r in rows] == [
        (HEAD + "property_000000.html", " better set unique "),
        (HEAD + "property_000007.html", "x")]


def test_pages_are_parsed_once(spark):
    cards = extract.select_cards(pages(spark, ("http://x/", INDEX)), "//li", {"t": ".//h3/text()"})
    plan = cards.select(F.get("t", F.lit(0)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


TRICKY = """<!-- <a href="no"> --><script>var a = '<a href="no">';</script>
<p>flat < 2 km</p><A HREF='u'>1</A><a href=v>2</a><a class="x" href="s?a=1&amp;b=2">3</a>
<![foo[y]]><![ x><nav><a href="n">4</a></nav><a name="none">5</a>"""


def test_all_anchors(spark):
    frame = pages(spark, ("http://x/y/", TRICKY))
    hrefs = [r.href for r in extract.page_anchors(frame).orderBy("pos").collect()]
    assert hrefs == ["u", "v", "s?a=1&b=2", "n"]
    by_tree = [r.link for r in extract.page_links(frame, ["//nav//a/@href", "//a/@href"])
               .orderBy("rule").collect()]
    by_region = [r.link for r in extract.anchors_by_region(frame, ["nav", None])
                 .orderBy("rule").collect()]
    assert by_tree == by_region == [
        "http://x/y/n", "http://x/y/u", "http://x/y/v", "http://x/y/s?a=1&b=2"]


def test_one_text_per_run(spark):
    root = markup.tree("<h1>flat < 2 km &amp; more</h1><p>a<!-- c -->b</p><p>a</i>b</p>")
    steps = markup.compile_path("//h1/text()")
    assert markup.texts(root, root, "//h1/text()", steps) == ["flat < 2 km & more"]
    assert markup.texts(root, root, "//p/text()", markup.compile_path("//p/text()")) == [
        "a", "b", "a", "b"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(
    ["<![", "<!", "<!--", "-->", "]]>", "[", "]", "<", ">", "</", "<a ", "href=", '"', "'", "x",
     " ", "<?", "<![CDATA[", "<!DOCTYPE", "&", "&#", "&#x110000;", "<p>", "<script>",
     "</script>", "<textarea>", "/>", "\x00"]), max_size=20).map("".join))
def test_any_markup_is_a_page(page):
    root = markup.tree(page)
    for path in ("//a/@href", "//p/text()", "//*"):
        markup.select(root, markup.compile_path(path))
