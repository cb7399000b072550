"""Line deduplication next to plain Python, and the query's SQL on planted rows."""

import hashlib
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from harvestry.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"


def plain(texts, min_docs, min_chars=1):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))

    found = defaultdict(set)
    for at, text in enumerate(texts):
        for line in (text or "").split("\n"):
            found[key(line)].add(at)
    common = {k for k, v in found.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in common]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def rows_of(spark, texts, **options):
    docs = spark.createDataFrame(
        [(i if i % 7 else None, t, "e", i, 5) for i, t in enumerate(texts)],
        "doc_id long, text string, lines string, place int, n_lines int")
    out = line_dedup.drop_common_lines(docs, **options)
    assert out.columns == ["doc_id", "text", "lines", "place", "n_lines", "n_dropped"]
    return [(r["text"], r["n_lines"], r["n_dropped"]) for r in out.orderBy("place").collect()]


LINE = st.sampled_from(["a", "A ", "\tb", "B\r", "", " ", "É", "é", "c d", "C  d", "x\x0b", " x"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.none() | st.lists(LINE, max_size=5).map("\n".join), max_size=12))
def test_equals_plain(spark, texts):
    assert rows_of(spark, texts, min_docs=3) == plain(texts, 3)


def test_long_texts_repeated_rows_and_limits(spark):
    texts = ["same line\nown %d" % i for i in range(20)] + ["Same Line "] * 3 + [None, "", "\n"]
    texts += ["\n".join(f"l{i}" for i in range(30_000)), "x" * 300_000, "short\nsame line"] * 2
    assert rows_of(spark, texts, min_docs=10) == plain(texts, 10)
    assert rows_of(spark, texts, min_docs=2, min_chars=6) == plain(texts, 2, 6)
    assert rows_of(spark, texts, min_docs=100) == plain(texts, 100)


def test_digest_of_the_query(spark):
    from harvestry.llm.queries import op9_line_dedup
    found = op9_line_dedup(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = plain([d["text"] for d in docs], 10)
    assert {r["doc_id"]: (r["kept_sha256"], r["n_lines"], r["n_dropped"]) for r in found} == {
        d["doc_id"]: (hashlib.sha256(t.encode()).hexdigest(), n, lost)
        for d, (t, n, lost) in zip(docs, want, strict=True)}
