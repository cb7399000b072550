import json

from pyspark.sql import functions as F

from harvestry.operators import frontier, reach
from harvestry.sources import generate
from harvestry.sources.documents import worker_urls

TARGETS = ["scrapyd1:6800", "scrapyd2:6800", "scrapyd3:6800"]


def requests(spark, *urls):
    return spark.createDataFrame([(i, url) for i, url in enumerate(urls)], "pos long, url string")


def test_batches(spark):
    firsts = frontier.first_seen(requests(spark, "a", "b", "a", "c", "d", "b", "e"))
    rows = frontier.url_batches(firsts, 2, TARGETS).orderBy("batch").collect()
    assert [(r.batch, r.target, r.n, json.loads(r.urls)) for r in rows] == [
        (1, TARGETS[0], 2, ["a", "b"]), (2, TARGETS[1], 2, ["c", "d"]), (3, TARGETS[2], 1, ["e"])]


def test_no_urls_no_batch(spark):
    firsts = frontier.first_seen(requests(spark, "a").limit(0))
    assert frontier.url_batches(firsts, 2, TARGETS).count() == 0


def test_targets_come_round(spark):
    batches = spark.range(1, 8).withColumnRenamed("id", "batch")
    rows = frontier.with_target(batches, TARGETS).orderBy("batch").collect()
    assert [r.target for r in rows] == [TARGETS[i % 3] for i in range(7)]


def test_seen_urls_are_left_out(spark):
    seen = requests(spark, "b", "x")
    rows = frontier.first_seen(requests(spark, "a", "b", "a", "c"), seen).collect()
    assert sorted((r.url, r.pos) for r in rows) == [("a", 0), ("c", 3)]


def test_worker_receives_its_urls(spark):
    batches = spark.createDataFrame([(1, '["a","b"]')], "batch int, urls string")
    rows = worker_urls(batches, 1).orderBy("pos").collect()
    assert [(r.batch, r.url, r.rule) for r in rows] == [(1, "a", 1), (1, "b", 1)]


def test_numbering_is_exact_and_spread(spark):
    """A third of the rows share one position; no partition gets them all."""
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("pos"),
        F.concat(F.lit("u"), F.col("id")).alias("url"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = frontier.number_rows(rows, ["pos", "url"])
        found = numbered.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ordered = sorted(found, key=lambda r: (r.pos, r.url))
    assert [r.number for r in ordered] == list(range(1, 30001))
    largest = max(sum(r.part == p for r in found) for p in {r.part for r in found})
    assert largest < 30000 * 0.6


def test_routes(spark):
    rows = spark.createDataFrame(
        [("item", None), ("request", None), ("request", 0), ("request", 1), ("item", 1)],
        "kind string, rule int")
    assert [r.route for r in frontier.route(rows, 1).collect()] == [
        "pass", "pass", "pass", "batch", "pass"]


def test_dispatch_order(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1)], "pos int, priority int")
    found = frontier.dispatch_order(rows).orderBy("turn").collect()
    assert [r.pos for r in found] == [2, 4, 1, 3]


def test_triage(spark):
    rows = spark.createDataFrame(
        [(False, None, None), (True, 500, "ok"), (True, 200, "error"), (True, 200, "ok")],
        "sent boolean, code int, status string")
    assert [r.problem for r in frontier.triage(rows).collect()] == [
        "request not sent", "request failed: 500", "operation error", None]


def test_allowed_domains(spark):
    rows = requests(spark, "http://web:9312/a", "http://sub.web/a", "http://xweb/a")
    assert [r.pos for r in frontier.allowed(rows, ["web"]).collect()] == [0, 1]
    assert frontier.allowed(rows, []).count() == 3


def test_index_shards(spark):
    rows = generate.index_shards(spark, "http://web:9312/properties/", 1667).orderBy("shard")
    urls = [r.url.rsplit("/", 1)[1] for r in rows.collect()]
    assert urls == ["index_%05d.html" % (1667 * x // 20) for x in range(20)]
    assert urls[:4] == [f"index_{n}.html" for n in ("00000", "00083", "00166", "00250")]


def test_index_page_shards(spark):
    def starts(pages, shards):
        found = generate.index_page_shards(spark, "b/", pages, shards).orderBy("page").collect()
        return [(r.page, r.url) for r in found]

    assert starts(1, 4) == [] and starts(0, 4) == []
    assert starts(10, 3) == [(1, "b/index?p=1"), (5, "b/index?p=5"), (9, "b/index?p=9")]
    assert generate.index_page_count(1000) == 50 and generate.index_page_count(1001) == 51


def test_detail_requests(spark):
    rows = generate.detail_requests(spark, "b/", 10, 4).orderBy("id").collect()
    assert [(r.id, r.url) for r in rows] == [
        (1, "b/detail?id0=1"), (5, "b/detail?id0=5"), (9, "b/detail?id0=9")]


def test_seed_pages(spark):
    archive = spark.createDataFrame([("a", "<p>")], "url string, html string")
    found, gone = generate.seed_pages(requests(spark, "a", "b").select("url"), archive)
    assert [tuple(r) for r in found.collect()] == [("a", "<p>")]
    assert [r.url for r in gone.collect()] == ["b"]


def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "src string, dst string")


def reached(spark, seeds, pairs):
    start = spark.createDataFrame([(s,) for s in seeds], "url string")
    return {r.url: r.depth for r in reach.reach(start, edges(spark, *pairs)).collect()}


def levels(seeds, pairs):
    """Plain breadth-first search."""
    depth = {s: 0 for s in seeds}
    todo = list(seeds)
    for page in todo:
        for src, dst in pairs:
            if src == page and dst not in depth:
                depth[dst] = depth[page] + 1
                todo.append(dst)
    return depth


def test_chain(spark):
    pairs = [(f"p{i}", f"p{i + 1}") for i in range(37)] + [("x", "y")]
    assert reached(spark, ["p0"], pairs) == levels(["p0"], pairs)
    assert reached(spark, ["p0", "p30", "x"], pairs) == levels(["p0", "p30", "x"], pairs)


def test_chain_into_a_cycle(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("z", "a")]
    assert reached(spark, ["a"], pairs) == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_branching_with_cycles(spark):
    pairs = [("a", "b"), ("a", "c"), ("b", "a"), ("c", "d"), ("d", "d"), ("d", "b"), ("e", "a")]
    assert reached(spark, ["a"], pairs) == levels(["a"], pairs)


def test_long_chain_with_branches(spark, monkeypatch):
    """Rounds go by the logarithm of a stretch's length and by the joints on the way."""
    stored = []
    store = reach.store
    monkeypatch.setattr(reach, "store", lambda df, label, *more: stored.append(
        label) or store(df, label, *more))
    n = 10_000
    chain = spark.range(n).selectExpr("concat('p', id) as src", "concat('p', id + 1) as dst")
    seeds = spark.createDataFrame([("p0",)], "url string")

    def run(more):
        stored.clear()
        found = reach.reach(seeds, chain.unionByName(edges(spark, *more)))
        leaves = found._jdf.queryExecution().analyzed().collectLeaves().size()
        row = found.selectExpr("count(*)", "max(depth)", "sum(depth)").first()
        return tuple(row), len(stored), leaves

    plain = run([("x", "y")])
    assert plain[0] == (n + 1, n, n * (n + 1) // 2)
    branched = run([("p17", "q"), ("p5000", "r"), ("q", "p9000")])
    # The short cut p17, q, p9000 shortens the depths from p9000 on.
    saved = (9000 - 19) * 1001
    assert branched[0] == (n + 3, max(n - 8981, 8999), n * (n + 1) // 2 - saved + 18 + 5001)
    assert plain[1] <= 24 and branched[1] <= plain[1] + 6 and branched[2] == plain[2]


def test_no_links(spark):
    assert reached(spark, ["a"], [("x", "y")]) == {"a": 0}


def test_crawl_emits_items_once(spark):
    seeds = spark.createDataFrame([("i0",)], "url string")
    follow = edges(spark, ("i0", "i1"), ("i1", "i2"), ("i2", "i0"))
    items = edges(spark, ("i0", "x"), ("i1", "y"), ("i2", "x"), ("other", "z"))
    found = sorted(tuple(r) for r in reach.crawl(seeds, follow, items).collect())
    assert found == [("index", "i0", 0), ("index", "i1", 1), ("index", "i2", 2),
                     ("item", "x", 1), ("item", "y", 2)]
    only = reach.crawl(seeds, follow, items.limit(0))
    assert {r.kind for r in only.collect()} == {"index"}
