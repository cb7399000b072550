import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestry.functions.time import micros, moment
from harvestry.operators import metrics, status


def lifecycles(spark, *rows):
    """Rows of (scheduled, received, scraped) in seconds after midnight."""
    frame = spark.createDataFrame([tuple(map(float, r)) for r in rows],
                                  "a double, b double, c double")

    def at(name):
        return F.timestamp_micros((F.col(name) * 1000000).cast("long") + 1420070400000000)

    return frame.select(at("a").alias("schedule_time"), at("b").alias("received_time"),
                        at("c").alias("scraped_time"))


def test_intervals_with_an_empty_one(spark):
    items = lifecycles(spark, (0, 1, 2), (0, 2, 4), (5, 6, 12))
    sums = metrics.interval_sums(items, 5)
    filled = metrics.interval_rates(metrics.fill_intervals(sums, 5), 5).orderBy("start").collect()
    assert [r["items"] for r in filled] == [2, 0, 1]
    assert [r.rate for r in filled] == [0.4, 0.0, 0.2]
    assert [r.latency for r in filled] == [3.0, 0.0, 7.0]
    assert [r.pipeline for r in filled] == [1.5, 0.0, 6.0]
    assert [r.start.second for r in filled] == [0, 5, 10]


def test_fill_crosses_blocks(spark):
    items = lifecycles(spark, (0, 0, 0), (0, 0, 30000))
    filled = metrics.fill_intervals(metrics.interval_sums(items, 1), 1)
    assert filled.count() == 30001 and filled.agg(F.sum("items")).first()[0] == 2


def test_no_items_no_intervals(spark):
    sums = metrics.interval_sums(lifecycles(spark, (0, 0, 0)).limit(0), 5)
    assert metrics.fill_intervals(sums, 5).count() == 0


def test_report_line(spark):
    items = lifecycles(spark, (0, 1, 2), (0, 2, 4))
    rates = metrics.interval_rates(metrics.interval_sums(items, 5), 5)
    assert rates.select(metrics.report_line()).first()[0] == (
        "Scraped 2 items at 0.4 items/s, avg latency: 3.00 s and avg time in pipelines: 1.50 s")


def test_gauges(spark):
    items = lifecycles(spark, (0.5, 2.5, 4.5), (1, 2, 9000), (3, 3.2, 3.4)).withColumn(
        "size", F.lit(10).cast("long"))
    wanted = [metrics.Gauge("queued", "schedule_time", "received_time"),
              metrics.Gauge("done", "scraped_time"),
              metrics.Gauge("bytes", "received_time", "scraped_time", "size")]
    rows = metrics.gauges(items, wanted, 1).collect()
    first = min(r.tick for r in rows)
    value = {(r.tick - first + 1, r.gauge): r.value for r in rows}
    assert first == 1420070401 and len(rows) == 3 * 9000
    assert [value[t, "queued"] for t in (1, 2, 3, 4)] == [2, 1, 1, 0]
    assert [value[t, "done"] for t in (1, 3, 4, 5, 8999, 9000)] == [0, 0, 1, 2, 2, 3]
    assert [value[t, "bytes"] for t in (1, 2, 3, 4, 5, 9000)] == [0, 10, 20, 20, 10, 0]


def test_rate_violations(spark):
    calls = spark.createDataFrame(
        [("a", f"2015-01-01 00:00:00.{i}") for i in range(6)]
        + [("b", f"2015-01-01 00:00:0{i}") for i in range(6)], "key string, ts string")
    found = metrics.rate_violations(calls.withColumn("ts", F.col("ts").cast("timestamp")),
                                    "key", "ts", 5).collect()
    assert [(r.key, r.calls) for r in found] == [("a", 6)]


def test_signal_counts(spark):
    events = spark.createDataFrame([("item_scraped",), ("item_dropped",), ("spider_error",)],
                                   "event_type string")
    assert {r.event_type: r.n for r in metrics.signal_counts(events).collect()} == {
        "item_scraped": 1, "item_dropped": 1, "spider_error": 1}


CONFIG = [
    ("settings", "default", "properties.settings"),
    ("deploy", "url", "http://localhost:6800/"), ("deploy", "project", "properties"),
    ("deploy:scrapyd1", "url", "http://scrapyd1:6800/"),
    ("deploy:scrapyd2", "url", "http://scrapyd2:6800/"),
    ("deploy:scrapyd3", "url", "http://scrapyd3:6800/"),
]


def config(spark, rows):
    settings = spark.createDataFrame(rows, "section string, key string, value string")
    found = {}
    for r in status.target_config(settings).collect():
        found.setdefault(r.target, {})[r.key] = r.value
    return found


def test_target_config(spark):
    assert config(spark, CONFIG) == {
        "default": {"url": "http://localhost:6800/", "project": "properties"},
        **{f"scrapyd{i}": {"url": f"http://scrapyd{i}:6800/", "project": "properties"}
           for i in (1, 2, 3)}}


def test_no_default_target_without_a_url(spark):
    found = config(spark, [row for row in CONFIG if row[:2] != ("deploy", "url")])
    assert set(found) == {"scrapyd1", "scrapyd2", "scrapyd3"}


def test_no_base_section(spark):
    found = config(spark, [row for row in CONFIG if row[0] != "deploy"])
    assert found == {f"scrapyd{i}": {"url": f"http://scrapyd{i}:6800/"} for i in (1, 2, 3)}


def test_job_status(spark):
    jobs = [{"id": "x"}]
    replies = spark.createDataFrame([
        ("s2", 200, json.dumps({"running": jobs, "finished": jobs * 2})),
        ("s1", 200, json.dumps({"pending": jobs})), ("s3", 500, "{}")],
        "target string, code int, body string")
    lines = [r.line for r in status.job_status(replies).collect()]
    assert lines == ["s1                   running: 0, finished: 0, pending: 1",
                     "s2                   running: 1, finished: 2, pending: 0"]
    wanted = spark.createDataFrame([("s2",)], "target string")
    assert [r.target for r in status.job_status(replies, wanted).collect()] == ["s2"]


def test_wanted_targets(spark):
    known = spark.createDataFrame([("a", "url", "u"), ("b", "url", "v")],
                                  "target string, key string, value string")
    assert [r.target for r in status.wanted_targets(known, ["b", "c"]).collect()] == ["b"]
    with pytest.raises(ValueError):
        status.wanted_targets(known, ["c"])




def test_micros_do_not_depend_on_the_zone(spark):
    texts = ["1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-03-10 02:30:00.25",
             "2024-11-03 01:30:00.000001", "2038-01-19 03:14:08"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn(
        "ntz", F.col("t").cast("timestamp_ntz"))
    want = [int((datetime.fromisoformat(t) - datetime(1970, 1, 1)) / timedelta(microseconds=1))
            for t in texts]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        counted = frame.withColumn("us", micros(frame, "ntz"))
        back = counted.withColumn("again", moment(F.col("us"), T.TimestampNTZType()))
        rows = back.collect()
        assert [r.us for r in rows] == want
        assert [r.again for r in rows] == [r.ntz for r in rows]
        instants = back.select(moment(F.col("us"), T.TimestampType()).alias("x"))
        assert [r[0] for r in instants.select(micros(instants, "x")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_later_settings_win(spark, tmp_path):
    from harvestry.sources.files import read_settings
    (tmp_path / "x.cfg").write_text(
        "[deploy]\nproject = a\nproject = b\n[deploy:s]\nurl = one\n# url = no\nurl: two\n"
        "[deploy]\nproject = c\n[deploy:s]\nkey = z\nkey = y\n")
    found = status.target_config(read_settings(spark, str(tmp_path / "x.cfg")))
    assert sorted(map(tuple, found.collect())) == [
        ("s", "key", "y"), ("s", "project", "c"), ("s", "url", "two")]


@pytest.mark.parametrize("slots", [1, 2, 64])
def test_bursts_over_any_border(spark, slots):
    """Against a plain sliding test; some calls have equal times, one key is hot."""
    rng = random.Random(4)
    calls = [(rng.choice("aaab"), rng.randrange(-40, 300) * 250_000) for _ in range(300)]
    frame = spark.createDataFrame(calls, "key string, us long").select(
        "key", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"))
    frame = frame.unionByName(spark.createDataFrame([("a", None)], "key string, ts timestamp_ntz"))
    got = metrics.rate_bursts(frame, "key", "ts", 3, 1, slots)
    epoch = datetime(1970, 1, 1)
    found = sorted((r.key, (r.ts - epoch) // timedelta(microseconds=1)) for r in got.collect())
    want = []
    for key in "ab":
        times = sorted(us for k, us in calls if k == key)
        want += [(key, t) for i, t in enumerate(times) if i >= 3 and t - times[i - 3] < 1_000_000]
    assert found == sorted(want) and want


def test_targets_asked_for_by_a_table(spark):
    known = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "target string, n int")
    asked = spark.createDataFrame([("b",), ("c",), ("b",)], "target string")
    assert [r.target for r in status.asked_targets(known, asked).collect()] == ["b"]
