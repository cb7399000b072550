import json
import re
import os

import pytest
from pyspark.sql import functions as F

from harvestry.operators import enrich
from harvestry.operators.boost import price_shifts, word_prices
from harvestry.plans.streams import stream_session
from harvestry.schemas import PRICED_TITLE
from harvestry.sinks.files import stream_feed, write_feed
from harvestry.sources.files import read_items, stream_items, stream_table
from harvestry.operators import metrics as batch_metrics
from harvestry.operators.frontier import first_seen, url_batches
from harvestry.session import ship_package
from harvestry.streaming import boost, frontier, lookups, metrics
from harvestry.streaming.cache import cache_runs, read_cache, seed_cache, start_cached
from harvestry.streaming.runs import KeyedRuns, covering

A = {"title": ["Split Business Split"], "price": [1.0]}
B = {"title": ["Need business"], "price": [2.0]}


def put(folder, name, *items):
    """Write a feed file, a second newer than the ones before: streams go by file time."""
    folder.mkdir(exist_ok=True)
    newest = 1500000000 + len(list(folder.iterdir()))
    (folder / name).write_text("".join(json.dumps(item) + "\n" for item in items))
    os.utime(folder / name, (newest, newest))


def run_boost(spark, root, files_per_trigger=1):
    items = stream_items(stream_session(spark), str(root / "feed"), PRICED_TITLE,
                         files_per_trigger)
    running = boost.start_boost(items, str(root / "out"), str(root / "checkpoint"),
                                availableNow=True)
    running.awaitTermination(120)
    return running


def shifts(spark, root, batch):
    found = spark.read.parquet(str(root / "out" / "shifts" / f"batch_id={batch}"))
    return {r.word: r["shift"] for r in found.collect()}


AFTER_A = pytest.approx({"business": 0.0, "split": 0.0})
AFTER_B = pytest.approx({"need": 0.44444444, "business": 0.0, "split": -0.44444444})


def test_state_runs_over_batches(spark, tmp_path):
    put(tmp_path / "feed", "1.jl", A)
    put(tmp_path / "feed", "2.jl", B)
    run_boost(spark, tmp_path)
    assert shifts(spark, tmp_path, 0) == AFTER_A
    assert shifts(spark, tmp_path, 1) == AFTER_B
    report = spark.read.parquet(str(tmp_path / "out" / "report" / "batch_id=1"))
    assert [r.word for r in report.orderBy("line").collect()] == [
        "need", "business", "split", "need", "business", "split"]


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    put(tmp_path / "feed", "1.jl", A)
    run_boost(spark, tmp_path)
    assert shifts(spark, tmp_path, 0) == AFTER_A
    put(tmp_path / "feed", "2.jl", B)
    run_boost(spark, tmp_path)
    assert shifts(spark, tmp_path, 1) == AFTER_B


def test_stream_equals_batch(spark, tmp_path):
    names = [("red", 3), ("blue", 5), ("old", 7)]
    for i in range(4):
        put(tmp_path / "feed", f"{i}.jl", *[
            {"title": [f"{a} {b} {i}"], "price": [float(x * y + i)]}
            for a, x in names for b, y in names])
    last = run_boost(spark, tmp_path, 2).lastProgress["batchId"]
    items = read_items(spark, str(tmp_path / "feed"), PRICED_TITLE, strict=True)
    want = {r.word: r["shift"] for r in price_shifts(word_prices(items)).collect()}
    assert last == 1 and shifts(spark, tmp_path, last) == pytest.approx(want)


def test_crawl_feed_becomes_stream_input(spark, tmp_path):
    """Items stream into a feed whose files are the input of the next stream."""
    put(tmp_path / "crawl", "1.jl", A, B)
    session = stream_session(spark)
    crawl = stream_items(session, str(tmp_path / "crawl"), PRICED_TITLE)
    stream_feed(crawl, str(tmp_path / "feed"), str(tmp_path / "feed_checkpoint"),
                availableNow=True).awaitTermination(120)
    run_boost(spark, tmp_path, None)
    assert shifts(spark, tmp_path, 0) == AFTER_B


def test_url_dedup_keeps_state_over_restarts(spark, tmp_path):
    def run(*urls):
        name = f"{len(list(tmp_path.glob('in/*.jl')))}.jl"
        put(tmp_path / "in", name, *[{"url": url} for url in urls])
        requests = stream_session(spark).readStream.schema("url string").json(
            str(tmp_path / "in"))
        frontier.start_dedup(requests, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
                             availableNow=True).awaitTermination(120)
        return sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run("a", "b", "a") == ["a", "b"]
    assert run("b", "c") == ["a", "b", "c"]


def test_bounded_dedup_plan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    requests = spark.readStream.schema("url string, ts timestamp").json(str(tmp_path / "in"))
    assert frontier.new_urls(requests, "url", "ts", "1 hour").isStreaming


def lives(*seconds):
    return [{"schedule_time": f"2015-01-01T00:00:{s:02d}Z",
             "received_time": f"2015-01-01T00:00:{s:02d}Z",
             "scraped_time": f"2015-01-01T00:00:{s + 1:02d}Z"} for s in seconds]


def test_late_items_raise_their_interval(spark, tmp_path):
    schema = "schedule_time timestamp, received_time timestamp, scraped_time timestamp"

    def run():
        items = stream_session(spark).readStream.schema(schema).json(str(tmp_path / "in"))
        metrics.start_intervals(items, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 5,
                                availableNow=True).awaitTermination(120)
        found = metrics.read_intervals(spark, str(tmp_path / "out"), 5).orderBy("start")
        return [(r.start.second, r["items"], r.latency) for r in found.collect()]

    put(tmp_path / "in", "1.jl", *lives(0, 1, 12))
    assert run() == [(0, 2, 1.0), (10, 1, 1.0)]
    put(tmp_path / "in", "2.jl", *lives(3, 30))  # 3 is late, and counts
    assert run() == [(0, 3, 1.0), (10, 1, 1.0), (30, 1, 1.0)]


def test_cache_grows_with_the_stream(spark, tmp_path):
    """The second batch finds in the cache what the first one geocoded."""
    cache, out = cache_runs(str(tmp_path / "cache")), str(tmp_path / "out")
    seed_cache(cache, spark.createDataFrame(
        [("ADDRESS_CACHE:seed", '{"lat":1.0,"lon":1.0}')], "key string, value string"))
    schema = "seq long, address array<string>, location struct<lat:double,lon:double>"
    replies = [("new", 0, json.dumps({"status": "OK", "results": [
        {"geometry": {"location": {"lat": 5.0, "lng": 6.0}}}]}))]

    def locate(items):
        frame = items.sparkSession.createDataFrame(
            replies, "address string, attempt int, body string")
        return enrich.from_replies(items, enrich.settle_replies(frame))

    def run(name, *rows):
        put(tmp_path / "in", name, *[{"seq": s, "address": [a]} for s, a in rows])
        items = stream_session(spark).readStream.schema(schema).json(str(tmp_path / "in"))
        start_cached(items, locate, cache, out, str(tmp_path / "checkpoint"),
                     availableNow=True).awaitTermination(120)
        return {r.seq: r.geo for r in spark.read.parquet(out).collect()}

    assert run("1.jl", (1, "seed"), (2, "new"), (3, "gone")) == {
        1: "already_set", 2: "found", 3: "error"}
    replies.clear()
    replies.append(("other", 0, '{"status": "ZERO_RESULTS"}'))
    assert run("2.jl", (4, "new"), (5, "other")) == {
        1: "already_set", 2: "found", 3: "error", 4: "already_set", 5: "error"}
    entries = {r.key for r in read_cache(spark, cache, before=2).collect()}
    assert entries == {"ADDRESS_CACHE:seed", "ADDRESS_CACHE:new"}
    assert read_cache(spark, cache, before=0).count() == 1


@pytest.mark.parametrize("single", [True, False])
def test_table_stream_reads_files_and_folders(spark, tmp_path, single):
    frame = spark.range(10)
    folder = tmp_path / "t.parquet"
    frame.coalesce(1).write.parquet(str(folder))
    path = str(next(folder.glob("part-*"))) if single else str(folder)
    rows = stream_table(stream_session(spark), path, frame.schema)
    query = (rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start(str(tmp_path / "o")))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "o")).agg(F.sum("id")).first()[0] == 45


def test_partitioned_feed_streams(spark, tmp_path):
    items = spark.createDataFrame([(A["title"], A["price"], 1), (B["title"], B["price"], 2)],
                                  "title array<string>, price array<double>, batch int")
    write_feed(items, str(tmp_path / "feeds"), "batch")
    stream = stream_items(stream_session(spark), str(tmp_path / "feeds" / "*"), PRICED_TITLE, 1)
    running = boost.start_boost(stream, str(tmp_path / "out"), str(tmp_path / "c"),
                                availableNow=True)
    running.awaitTermination(120)
    assert running.lastProgress["batchId"] == 1
    assert shifts(spark, tmp_path, 1) == AFTER_B


KEYED = "key string, value string, seen long"


def test_runs_cover_all_batches():
    for fan in (2, 3, 4):
        for n in range(70):
            held = [i for level, number in covering(n, fan)
                    for i in range(number * fan ** level, (number + 1) * fan ** level)]
            assert held == list(range(n))
            assert len(covering(n, fan)) <= (fan - 1) * 7


def test_keyed_runs_hold_each_latest_row(spark, tmp_path):
    """Every state is right, also when a batch is repeated; folders do not grow in number."""
    schema = spark.createDataFrame([], KEYED).schema
    runs = KeyedRuns(str(tmp_path / "t"), schema, buckets=3, fan=2)
    state = {}
    for batch in range(11):
        rows = [(f"k{batch % 3}", f"v{batch}", batch), (f"own{batch}", "x", batch)]
        for _ in range(2 if batch % 4 == 0 else 1):
            runs.merge(spark, batch)
            seen = runs.before(spark, batch)
            assert {r.key: r.value for r in seen.collect()} == state
            runs.write(spark.createDataFrame(rows, schema), batch)
        state |= {k: v for k, v, _ in rows}
    assert len(list(tmp_path.glob("t/level=0/slot=*"))) == 4
    assert len(list(tmp_path.glob("t/level=*/slot=*"))) <= 4 * 4
    touched = spark.createDataFrame([("own3",), (None,)], "key string")
    found = runs.before(spark, 11, touched)
    assert found.where("key = 'own3'").count() == 1
    scans = re.findall(r"PartitionFilters: \[[^]]*bucket", found._jdf.queryExecution()
                       .executedPlan().toString())
    assert scans


def test_keyed_runs_without_rows_and_with_expiry(spark, tmp_path):
    schema = spark.createDataFrame([], KEYED).schema
    runs = KeyedRuns(str(tmp_path / "t"), schema, fan=2, age="seen", keep=10)
    for batch, rows in enumerate([[], [("a", "x", 5)], [("b", "x", 30)], [("c", "x", 31)], []]):
        runs.merge(spark, batch)
        runs.write(spark.createDataFrame(rows, schema), batch)
    assert {r.key for r in runs.before(spark, 4).collect()} == {"b", "c"}
    assert KeyedRuns(str(tmp_path / "none"), schema).before(spark, 0).count() == 0


@pytest.mark.parametrize("cuts", [[10], [3, 4, 10], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]])
def test_url_batches_wherever_the_stream_is_cut(spark, tmp_path, cuts):
    rows = [(url, pos) for pos, url in enumerate("abacbdaefd")]
    schema = "url string, pos long"
    want = url_batches(first_seen(spark.createDataFrame(rows, schema)), 2, ["x", "y"])
    batches = frontier.UrlBatches(str(tmp_path / "out"), 2, ["x", "y"], buckets=2, fan=2)
    low = 0
    for high in cuts:  # a run of the stream per cut: state lives over restarts
        put(tmp_path / "in", f"{high}.jl", *[{"url": u, "pos": p} for u, p in rows[low:high]])
        low = high
        feed = stream_session(spark).readStream.schema(schema).json(str(tmp_path / "in"))
        running = batches.start(feed, str(tmp_path / "c"), availableNow=True)
        running.awaitTermination(120)
    last = len(cuts) - 1
    assert sorted(batches.read(spark, last).collect()) == sorted(want.collect())
    assert batches.read(spark, last, flush=False).agg(F.min("n")).first()[0] == 2


def test_a_repeated_micro_batch_changes_no_url_batch(spark, tmp_path):
    batches = frontier.UrlBatches(str(tmp_path / "out"), 2, ["x"], buckets=2, fan=2)
    frames = [spark.createDataFrame(rows, "url string, pos long") for rows in (
        [("a", 0), ("b", 1), ("c", 2)], [("c", 3), ("d", 4)], [("e", 5)], [(None, 6), ("a", 7)])]
    for at, frame in enumerate(frames):
        batches.publish(frame, at)
        batches.publish(frame, at)
    assert [(r.batch, r.urls) for r in batches.read(spark, 3).orderBy("batch").collect()] == [
        (1, '["a","b"]'), (2, '["c","d"]'), (3, '["e"]')]


def test_bounded_dedup_passes_late_new_urls(spark, tmp_path):
    seen = frontier.seen_runs(str(tmp_path / "seen"), 10, buckets=2, fan=2)

    def run(name, *rows):
        put(tmp_path / "in", name, *[{"url": u, "second": s} for u, s in rows])
        feed = stream_session(spark).readStream.schema("url string, second long").json(
            str(tmp_path / "in"))
        frontier.start_bounded_dedup(feed, seen, str(tmp_path / "out"), str(tmp_path / "c"),
                                     availableNow=True).awaitTermination(120)
        return sorted(tuple(r)[:2] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert run("1", ("a", 100), ("a", 105), ("b", 100)) == [("a", 100), ("b", 100)]
    assert run("2", ("a", 115), ("late", 1), ("b", 111)) == [
        ("a", 100), ("b", 100), ("b", 111), ("late", 1)]
    # "late" has expired in the merge of both batches, the others have not.
    run("3", ("c", 112))
    assert {r.key for r in seen.before(spark, 3).collect()} == {"a", "b", "c"}


def lifecycle(start, end):
    return {"begun": f"2015-01-01T00:{start}Z", "ended": f"2015-01-01T00:{end}Z"}


def test_gauges_on_a_stream_are_corrected(spark, tmp_path):
    schema = "begun timestamp, ended timestamp"
    wanted = [batch_metrics.Gauge("busy", "begun", "ended"), batch_metrics.Gauge("all", "begun")]

    def run():
        items = stream_session(spark).readStream.schema(schema).json(str(tmp_path / "in"))
        metrics.start_gauges(items, wanted, str(tmp_path / "out"), str(tmp_path / "c"), 60,
                             availableNow=True).awaitTermination(120)
        return sorted(map(tuple, metrics.read_gauges(spark, str(tmp_path / "out"),
                                                     wanted).collect()))

    put(tmp_path / "in", "1.jl", lifecycle("01:30", "04:30"), lifecycle("02:30", "02:40"))
    first = run()
    put(tmp_path / "in", "2.jl", lifecycle("00:30", "03:30"))  # late: changes past ticks
    second = run()
    whole = spark.read.schema(schema).json(str(tmp_path / "in"))
    assert second == sorted(map(tuple, batch_metrics.gauges(whole, wanted, 60).collect()))
    assert second != first and sorted(map(tuple, metrics.read_gauges(
        spark, str(tmp_path / "out"), wanted, before=1).collect())) == first


def reply(address, attempt, lat=None, status="OK"):
    place = [{"geometry": {"location": {"lat": lat, "lng": 2.0}}}] if lat else []
    return {"address": address, "attempt": attempt,
            "body": json.dumps({"status": status, "results": place})}


@pytest.mark.parametrize("order", [[0, 1, 2, 3], [3, 2, 1, 0], [2, 0, 3, 1]])
def test_pending_lookups_in_any_order(spark, tmp_path, order):
    """Items and replies in any order give what the batch gives; what nobody answers waits."""
    ship_package(spark)
    items = "seq long, address array<string>, location struct<lat:double,lon:double>"
    replies = "address string, attempt int, body string"
    parts = [
        [{"seq": 1, "address": ["a"]}, {"seq": 2, "address": ["b"]}, {"seq": 3, "address": ["a"]}],
        [reply("a", 1, 5.0), reply("b", 0, status="ZERO_RESULTS"), reply("c", 0, 7.0)],
        [reply("a", 0, status="OVER_QUERY_LIMIT"), reply("a", 2, 6.0)],
        [{"seq": 4, "address": ["a"]}, {"seq": 5, "address": ["c"]}, {"seq": 6, "address": ["d"]},
         {"seq": 7, "address": []}, {"seq": 8, "address": ["b"], "location": {"lat": 1, "lon": 1}}]]
    for name in ("items", "replies"):
        (tmp_path / name).mkdir()
    for at in order:  # a restart of the stream for each part
        put(tmp_path / ("replies" if at in (1, 2) else "items"), f"{at}.jl", *parts[at])
        session = stream_session(spark)
        lookups.start_pending(
            session.readStream.schema(items).json(str(tmp_path / "items")),
            session.readStream.schema(replies).json(str(tmp_path / "replies")),
            str(tmp_path / "out"), str(tmp_path / "c"), availableNow=True).awaitTermination(180)
    got = {r.seq: (r.geo, r.location and r.location.lat)
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: ("found", 5.0), 3: ("found", 5.0), 4: ("found", 5.0), 2: ("error", None),
                   5: ("found", 7.0), 7: ("error", None), 8: ("already_set", 1.0)}
    whole = enrich.from_replies(
        spark.read.schema(items).json(str(tmp_path / "items")), enrich.settle_replies(
            spark.read.schema(replies).json(str(tmp_path / "replies"))))
    assert {r.seq: (r.geo, r.location and r.location.lat) for r in whole.collect()
            if r.seq != 6} == got


def test_pending_lookups_of_many_addresses_ask_no_state_one_by_one(spark, tmp_path):
    """30,000 addresses in two micro-batches: a call per address and batch would take minutes."""
    ship_package(spark)
    n = 30_000
    name = F.concat(F.lit("a"), F.col("id").cast("string"))
    items = spark.range(n).select(F.col("id").alias("seq"), F.array(name).alias("address"), F.lit(
        None).cast("struct<lat:double,lon:double>").alias("location"))
    body = F.format_string('{"status": "OK", "results": [{"geometry": {"location": '
                           '{"lat": %d, "lng": 2}}}]}', "id")
    replies = spark.range(n).select(name.alias("address"), F.lit(0).alias("attempt"),
                                    body.alias("body"))
    for rows, folder in ((items, "items"), (replies, "replies")):
        rows.repartition(2).write.parquet(str(tmp_path / folder))
    session = stream_session(spark)
    running = lookups.start_pending(
        stream_table(session, str(tmp_path / "items"), items.schema, files_per_trigger=1),
        stream_table(session, str(tmp_path / "replies"), replies.schema, files_per_trigger=1),
        str(tmp_path / "out"), str(tmp_path / "c"), availableNow=True)
    done = running.awaitTermination(90)
    running.stop()
    assert done
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.where("location.lat = seq and geo = 'found'").select(
        "seq").distinct().count() == n


def test_pending_state_over_merges_and_repeated_batches(spark, tmp_path):
    """A repeated batch answers the same; what is answered leaves merged runs; each copy of an
    item is answered."""
    items = spark.createDataFrame(
        [(at, [f"a{at % 5}"], None) for at in [*range(20), 12]],
        "seq long, address array<string>, location struct<lat:double,lon:double>")
    # The first reply to a3 never comes, nobody answers a4.
    parts = [(0, "a0", 1, 1.0), (0, "a1", 0, 2.0), (1, "a0", 0, None), (1, "a2", 2, 3.0),
             (2, "a2", 0, None), (3, "a2", 1, None), (3, "a3", 1, 4.0)]
    answers = spark.createDataFrame(
        [{**reply(a, n, lat, "OK" if lat else "OVER_QUERY_LIMIT"), "turn": at}
         for at, a, n, lat in parts], "address string, attempt int, body string, turn int")
    state = lookups.pending_runs(str(tmp_path / "state"), items.schema, buckets=2, fan=2)
    got = []
    for batch, times in enumerate((1, 1, 2, 1)):
        events = lookups.pending_events(items.where(F.col("seq") % 4 == batch),
                                        answers.where(F.col("turn") == batch).drop("turn"))
        runs = [sorted((r.seq, r.location.lat) for r in lookups.serve(
            events, state, batch, 2).collect()) for _ in range(times)]
        assert runs[0] == runs[-1]
        got += runs[0]
    assert sorted(got) == sorted((at, at % 5 + 1.0) for at in [*range(20), 12] if at % 5 < 3)
    merged = state.waiting._read(spark, [(1, 0)])
    assert {r.address for r in merged.collect()} == {"a2", "a3", "a4"}
