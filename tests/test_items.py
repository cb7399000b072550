import hashlib
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from harvestry.operators import items as ops
from harvestry.schemas import CORRUPT, ITEM, PRICED_TITLE
from harvestry.sinks import files, rows
from harvestry.sources.files import read_items


def test_drop_scenario(spark):
    named = spark.createDataFrame([("Hello 0",), ("Hello 1",)], "name string")
    judged = ops.judge(named, [(F.col("name") == "Hello 1", "Not good")])
    accepted, rejected = ops.split(judged)
    assert [r.name for r in accepted.collect()] == ["Hello 0"]
    assert [(r.name, r.reason) for r in rejected.collect()] == [("Hello 1", "Not good")]


def test_first_reason_counts(spark):
    judged = ops.judge(spark.range(3), [(F.col("id") > 1, "big"), (F.col("id") > 0, "small")])
    assert [r.reason for r in judged.orderBy("id").collect()] == [None, "small", "big"]


def test_require(spark):
    frame = spark.createDataFrame([(1, ["a"]), (2, []), (3, None)], "i int, address array<string>")
    reasons = [r.reason for r in ops.require(frame, ["address"]).orderBy("i").collect()]
    assert reasons == [None, "no address", "no address"]
    assert ops.require(frame.filter("i = 1"), ["address"], strict=True).count() == 1
    with pytest.raises(PySparkException):
        ops.require(frame, ["address"], strict=True).collect()


SCRAPED = ["title", "price", "description", "address", "image_urls", "url", "project", "spider",
           "server", "date"]


def test_contracts(spark):
    good = {"title": ["t"], "price": [1.0], "description": ["d"], "address": ["a"],
            "image_urls": ["i"], "url": ["u"]}
    bad = {**good, "address": None, "image_urls": []}
    site = spark.createDataFrame([{**good}, {**bad}], ITEM)
    page = F.when(F.col("address").isNull(), "bad").otherwise("good")
    items = ops.tidy_dates(ops.with_lineage(site, "properties", "basic", "host")).withColumn(
        "page", page)
    contracts = spark.createDataFrame(
        [(url, 1, SCRAPED) for url in ("good", "bad", "empty")],
        "page string, min_items int, fields array<string>")
    found = ops.check_contracts(items, contracts, SCRAPED, url="page").collect()
    assert sorted((r.page, r.check, r.detail) for r in found) == [
        ("bad", "scrapes", "address"), ("bad", "scrapes", "image_urls"),
        ("empty", "returns", "items 0")]


def test_lineage_is_one_moment(spark):
    items = ops.with_lineage(spark.range(100), "p", "s", "h")
    assert items.select("date").distinct().count() == 1


def test_stage_order_and_switch(spark):
    def append(text):
        return lambda items: items.withColumn("x", F.concat("x", F.lit(text)))

    frame = spark.createDataFrame([("",)], "x string")
    done = ops.run_stages(frame, [(600, append("c")), (100, append("a")), (300, None),
                                  (500, append("b"))])
    assert done.first().x == "abc"


def test_feed_round_trip(spark, tmp_path):
    path = str(tmp_path / "feed")
    data = [(["café"], [1.5], 1), (["b"], [2.0], 2), (["c"], [2.5], 2)]
    frame = spark.createDataFrame(data, "title array<string>, price array<double>, batch int")
    files.write_feed(frame, path, "batch")
    files.write_feed(frame.filter("batch = 1"), path, "batch")
    back = read_items(spark, path, PRICED_TITLE, strict=True)
    assert sorted(r.title[0] for r in back.collect()) == ["b", "c", "café", "café"]
    assert read_items(spark, path + "/batch=2", PRICED_TITLE).count() == 2


def test_malformed_lines(spark, tmp_path):
    (tmp_path / "x.jl").write_text('{"title": ["a"], "price": [1]}\n{"title": [\n')
    found = read_items(spark, str(tmp_path), PRICED_TITLE)
    assert sorted((r.title is None, r[CORRUPT]) for r in found.collect()) == [
        (False, None), (True, '{"title": [')]
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_items(spark, str(tmp_path), PRICED_TITLE, strict=True).collect()


def test_documents(spark, tmp_path):
    items = spark.createDataFrame([{"title": ["é"], "location": {"lat": 1.0, "lon": 2.0}}], ITEM)
    document = rows.item_documents(items).first().document
    assert "é" in document
    assert json.loads(document) == {"title": ["é"], "location": {"lat": 1.0, "lon": 2.0}}
    path = str(tmp_path / "documents")
    files.write_documents(items, path)
    assert spark.read.text(path + "/collection=properties").first().value == document


LONG = "http://web/" + "x" * 120


def test_upsert(spark):
    def row(url, title, price, description, seq):
        return ([url], [title] if title else None, [price], description and [description], seq)

    items = spark.createDataFrame([
        row("http://a", "t" * 40, 1.0, "one\r\ntwo\nthree", 1),
        row("http://a", "new", 2.0, "d", 5),
        row(LONG + "1", "first", 3.0, "d", 2),
        row(LONG + "2", "last", 4.0, "d", 3),
        row("http://skipped", "t", 5.0, None, 4),
        row("http://skipped", None, 5.0, "d", 4),
        row("http://cut", "t" * 40, 6.0, "one\r\ntwo\n" + "y" * 40, 4),
    ], "url array<string>, title array<string>, price array<double>, description array<string>,"
       " seq long")
    old = spark.createDataFrame(
        [("http://a", "http://a", "old", 0.0, "o"), ("http://kept", "http://kept", "k", 0.0, "o")],
        "key string, url string, title string, price double, description string")

    def upserted(**options):
        done = rows.upsert(old, rows.upsert_rows(items, **options))
        assert "SortAggregate" not in done._jdf.queryExecution().executedPlan().toString()
        return {r.key: (r.url, r.title, r.price, r.description) for r in done.collect()}

    whole = upserted()
    assert {k: v for k, v in whole.items() if k.startswith(LONG)} == {
        LONG + "1": (LONG[:100], "first", 3.0, "d"), LONG + "2": (LONG[:100], "last", 4.0, "d")}
    assert {k: v[1:] for k, v in upserted(cut_key=True).items()} == {
        "http://a": ("new", 2.0, "d"),
        "http://kept": ("k", 0.0, "o"),
        LONG[:100]: ("last", 4.0, "d"),
        "http://cut": ("t" * 30, 6.0, ("one two\n" + "y" * 40)[:30]),
    }


def test_image_manifest(spark):
    items = spark.createDataFrame([(["http://a/1", "http://a/2"],), (["http://a/1"],), (None,)],
                                  "image_urls array<string>")
    manifest = rows.image_manifest(items)
    digest = hashlib.sha1(b"http://a/1").hexdigest()
    found = {r.url: (r.path, r.thumbnail) for r in manifest.collect()}
    assert len(found) == 2
    assert found["http://a/1"] == (f"full/{digest}.jpg", f"thumbs/small/{digest}.jpg")


def test_image_records(spark, tmp_path):
    items = spark.createDataFrame([(["http://a/1"],)], "image_urls array<string>")
    manifest = rows.image_manifest(items)
    file = tmp_path / manifest.first().path
    file.parent.mkdir()
    file.write_bytes(b"image")
    stored = spark.read.format("binaryFile").load(str(file.parent))
    record = rows.image_records(manifest, stored, str(tmp_path)).first()
    assert record.checksum == hashlib.md5(b"image").hexdigest()


def test_written_target_keeps_untouched_buckets(spark, tmp_path):
    path = str(tmp_path / "target")

    def rows_of(*keys, price=1.0, seq=0):
        return spark.createDataFrame([(k, k, "t", price, "d", seq) for k in keys],
                                     "key string, url string, title string, price double, "
                                     "description string, seq long")

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "target").glob("bucket=*/*.parquet")}

    keys = [f"k{i}" for i in range(40)]
    assert rows.upsert_table(rows_of(), path) == []
    assert len(rows.upsert_table(rows_of(*keys), path, 8)) == 8
    before = files()
    for _ in range(2):  # writing again changes nothing
        touched = rows.upsert_table(rows_of("k3", "new", price=2.0, seq=1), path, 8)
        got = {r.key: r.price for r in rows.read_table(spark, path).collect()}
        assert got == {**{k: 1.0 for k in keys}, "k3": 2.0, "new": 2.0}
    assert len(touched) <= 2
    after = files()
    kept = [f for f in before if int(f.parent.name.split("=")[1]) not in touched]
    assert kept and all(after[f] == before[f] for f in kept)
    assert all(f in kept for f in before if f in after)
