import time

import pytest
from pyspark.sql import functions as F

from harvestry.functions.pricing import legacy_price
from harvestry.operators.external import pipe_numbers
from harvestry.operators.items import judge
from harvestry.sources.files import read_settings
from harvestry.streaming.signals import SignalListener, observe_items

AWK = ["bash", "-c", 'while read line; do awk "BEGIN {print 1.20 * $line}"; done']


def test_legacy_price_equals_the_command(spark):
    rows = spark.range(1, 1000, 1, 4).select(
        "id", F.when(F.col("id") % 50 != 0, F.col("id") * 13.37 + F.col("id") / 8).alias("price"))
    piped = pipe_numbers(rows, "price", AWK, out="piped", chunk=100)
    both = legacy_price(piped, "price").collect()
    assert len(both) == 999 and any(r.price is None for r in both)
    assert [r.price for r in both] == [r.piped for r in both]


def test_pipe_replaces_the_column(spark):
    rows = spark.createDataFrame([(1, 1234.567), (2, None)], "i int, price double")
    found = pipe_numbers(rows, "price", AWK).orderBy("i").collect()
    assert [(r.i, r.price) for r in found] == [(1, 1481.48), (2, None)]


def test_a_command_that_ends_early_is_an_error(spark):
    rows = spark.createDataFrame([(1.0,)], "price double")
    with pytest.raises(Exception, match="ended early|BrokenPipe"):
        pipe_numbers(rows, "price", ["true"]).collect()


def test_observed_counts(spark):
    judged = judge(spark.range(10), [(F.col("id") > 6, "Not good")])
    watched, counts = observe_items(judged)
    watched.write.format("noop").mode("overwrite").save()
    assert counts.get == {"item_scraped": 7, "item_dropped": 3}


def test_stream_signals(spark, tmp_path):
    signals = []
    listener = SignalListener(lambda name, run: signals.append(name))
    spark.streams.addListener(listener)
    try:
        (tmp_path / "in").mkdir()
        (tmp_path / "in" / "1.jl").write_text('{"url": "a"}\n')
        stream = spark.readStream.schema("url string").json(str(tmp_path / "in"))
        query = (stream.writeStream.format("noop").trigger(availableNow=True)
                 .option("checkpointLocation", str(tmp_path / "c")).start())
        query.awaitTermination(60)
        for _ in range(100):
            if "closed" in signals:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert signals[0] == "opened" and "progress" in signals and signals[-1] == "closed"


def test_settings_file(spark, tmp_path):
    (tmp_path / "x.cfg").write_text(
        "# comment\n[settings]\ndefault = properties.settings\n\n[deploy]\n"
        "url = http://localhost:6800/\n; no = no\nproject: properties\n\n"
        "[deploy:scrapyd1]\nURL=http://scrapyd1:6800/\n")
    rows = sorted(tuple(r)[:3] for r in read_settings(spark, str(tmp_path / "x.cfg")).collect())
    assert rows == [
        ("deploy", "project", "properties"), ("deploy", "url", "http://localhost:6800/"),
        ("deploy:scrapyd1", "url", "http://scrapyd1:6800/"),
        ("settings", "default", "properties.settings")]
