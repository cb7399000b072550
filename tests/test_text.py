import string
from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harvestry.functions import pricing, text, urls

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
LETTERS = string.ascii_letters + "äéñßÉÅø" + "'-0 9. \t\n"
prose = st.lists(st.text(LETTERS, max_size=25), min_size=30, max_size=60)


def apply(spark, values, function, kind="string"):
    rows = [(i, value) for i, value in enumerate(values)]
    frame = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in frame.select("i", function(F.col("x")).alias("y"))
            .orderBy("i").collect()]


def test_white_space_set():
    assert sorted(text.WHITESPACE) == sorted(SPACES)


def test_every_white_space_splits_and_strips(spark):
    values = [f"{c}a{c}b{c}" for c in SPACES]
    assert apply(spark, values, text.words) == [["a", "b"]] * len(values)
    assert apply(spark, values, text.strip) == [f"a{c}b" for c in SPACES]


@SLOW
@given(prose)
def test_title_strip_split_like_python(spark, values):
    plain = [value.replace("ß", "") for value in values]
    assert apply(spark, plain, text.title_case) == [value.title() for value in plain]
    assert apply(spark, values, text.strip) == [value.strip() for value in values]
    assert apply(spark, values, text.words) == [value.split() for value in values]


def test_title_keeps_letters_with_long_upper_case(spark):
    assert apply(spark, ["ßtraße it's two-bed", ""], text.title_case) == [
        "ßtraße It'S Two-Bed", ""]


def test_numbers(spark):
    nodes = [["£1,334.39pw x 2"], ["."], ["none"], ["1.2.3 4", "5"], []]
    found = apply(spark, nodes, text.numbers, "array<string>")
    assert found == [[1334.39, 2.0], [None], [], [None, 4.0, 5.0], []]


@SLOW
@given(st.lists(st.decimals(0, 10**7, places=2), min_size=20, max_size=40))
def test_numbers_with_commas(spark, values):
    nodes = [[f"{value:,}"] for value in values]
    assert apply(spark, nodes, text.numbers, "array<string>") == [[float(v)] for v in values]


def test_iso_text(spark):
    moments = ["2015-01-02 03:04:05", "2015-01-02 03:04:05.000600", None]
    found = apply(spark, moments, lambda x: text.iso_text(x.cast("timestamp_ntz")))
    assert found == ["2015-01-02T03:04:05", "2015-01-02T03:04:05.000600", None]


BASES = ["http://web:9312/properties/index_00000.html", "https://a.example.com",
         "http://a.example.com/x/y/z?q=1#f", "http://a.example.com/x/"]


def resolve(spark, pairs):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)],
                                  "i int, base string, href string")
    return [r.y for r in frame.select("i", urls.join_url(F.col("base"), F.col("href")).alias("y"))
            .orderBy("i").collect()]


def test_join_url_cases(spark):
    hrefs = ["b.html", "/b", "//c.example.com/d", "?q=2", "#g", "", "../b", "../../../b", "./b",
             "b/../c", "b/..", ".", "..", "https://d.example.com/e", "mailto:x@y.z",
             "b/./c?x=..#.."]
    pairs = [(base, href) for base in BASES for href in hrefs]
    assert resolve(spark, pairs) == [urljoin(*pair) for pair in pairs]


segments = st.sampled_from(["a", "b.html", "..", ".", "c d", "ü"])
hrefs = st.lists(segments, min_size=1, max_size=6).map("/".join)


@SLOW
@given(st.lists(st.tuples(st.sampled_from(BASES), st.sampled_from(["", "/"]), hrefs,
                          st.sampled_from(["", "?x=1", "#y"])), min_size=30, max_size=60))
def test_join_url_like_python(spark, cases):
    pairs = [(base, lead + path + tail) for base, lead, path, tail in cases]
    assert resolve(spark, pairs) == [urljoin(*pair) for pair in pairs]


def test_host_and_domains(spark):
    values = ["http://Web:9312/a", "https://u:p@a.b.com?x", "http://xb.com", "mailto:a@b.com", None]
    assert apply(spark, values, urls.host) == ["web", "a.b.com", "xb.com", None, None]
    assert apply(spark, values, lambda u: urls.in_domain(u, ["b.com", "web"])) == [
        True, True, False, False, False]
    assert apply(spark, values, lambda u: urls.in_domain(u, [])) == [True] * 5


def legacy(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    return [r.x for r in pricing.legacy_price(frame, "x").orderBy("i").collect()]


def test_legacy_price(spark):
    assert legacy(spark, [1234.567, 100.0, 12345678.9, 99.0 + 1, None]) == [
        1481.48, 120.0, 14814800.0, 120.0, None]


@SLOW
@given(st.lists(st.one_of(
    st.floats(1, 1e12), st.decimals(1, 10**7, places=3).map(float),
    st.integers(1, 10**6).map(lambda n: n + 0.5), st.integers(8, 10**7).map(lambda n: n / 8)),
    min_size=50, max_size=120))
def test_six_digits_like_c(spark, values):
    frame = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    found = [r.x for r in pricing.six_digits(frame, "x").orderBy("i").collect()]
    assert found == [v if v == int(v) else float("%.6g" % v) for v in values]


def test_only_the_first_price_changes(spark):
    found = apply(spark, [[1.0, 2.0], [1.0], [], None],
                  lambda p: pricing.with_first(p, pricing.first(p) + 1), "array<double>")
    assert found == [[2.0, 2.0], [2.0], [], None]
