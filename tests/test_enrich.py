import json

from pyspark.sql import functions as F

from harvestry.operators import enrich


def body(status, lat=None, lng=None):
    results = [] if lat is None else [{"geometry": {"location": {"lat": lat, "lng": lng}}}]
    return json.dumps({"status": status, "results": results})


def scenario(spark):
    """One item placed, one cached, two sharing a cold address, two sharing an unknown one,
    one whose first reply is over quota."""
    place = {"lat": 9.0, "lon": 9.5}
    items = spark.createDataFrame([
        (1, ["preset"], place), (2, ["cached"], None), (3, ["cold"], None), (4, ["cold"], None),
        (5, ["unknown"], None), (6, ["unknown"], None), (7, ["busy"], None)],
        "seq long, address array<string>, location struct<lat:double,lon:double>")
    cache = spark.createDataFrame([
        ("ADDRESS_CACHE:cached", '{"lat": 3.0, "lon": 4.0}'), ("ADDRESS_CACHE:cold", ""),
        ("OTHER:unknown", '{"lat": 0.0, "lon": 0.0}')], "key string, value string")
    replies = spark.createDataFrame([
        ("cold", 0, body("OK", 1.5, 2.5)), ("unknown", 0, body("ZERO_RESULTS")),
        ("busy", 0, body("OVER_QUERY_LIMIT")), ("busy", 1, body("OK", 5.0, 6.0)),
        ("preset", 0, body("OK", 0.0, 0.0))], "address string, attempt int, body string")
    return items, cache, replies


def places(items):
    return {r.seq: r.location and tuple(r.location) for r in items.collect()}


def test_cache(spark):
    items, cache, _ = scenario(spark)
    assert places(enrich.from_cache(items, cache)) == {
        1: (9.0, 9.5), 2: (3.0, 4.0), 3: None, 4: None, 5: None, 6: None, 7: None}


def test_geocode_with_retries(spark):
    items, cache, replies = scenario(spark)
    done = enrich.from_replies(enrich.from_cache(items, cache), enrich.settle_replies(replies))
    assert places(done) == {
        1: (9.0, 9.5), 2: (3.0, 4.0), 3: (1.5, 2.5), 4: (1.5, 2.5), 5: None, 6: None,
        7: (5.0, 6.0)}
    assert {r.seq: r.geo for r in done.collect()} == {
        1: "already_set", 2: "already_set", 3: "found", 4: "found", 5: "error", 6: "error",
        7: "found"}


def test_lookups_read_plain_shuffles(spark):
    """Each side of each lookup is a shuffle of its own: sharing one between lookups, as before,
    kept AQE from splitting a hot address."""
    items, cache, replies = scenario(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = enrich.from_replies(enrich.from_cache(enrich.with_address(items), cache),
                                   enrich.settle_replies(replies))
        plan = done._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_key") == 4
    assert done.count() == 7 and "_address" in done.columns


def test_geocode_without_retries(spark):
    items, _, replies = scenario(spark)
    done = enrich.from_replies(items, enrich.settle_replies(replies, retry=False))
    assert {r.seq: r.geo for r in done.collect()}[7] == "error"


def test_counters(spark):
    items, cache, replies = scenario(spark)
    settled = enrich.settle_replies(replies)
    row = enrich.geo_counters(enrich.from_cache(items, cache), settled).first()
    assert row.asDict() == {"already_set": 2, "misses": 3, "retries": 1, "errors": 2}
    empty = enrich.geo_counters(items.limit(0), settled).first()
    assert empty.asDict() == {"already_set": 0, "misses": 0, "retries": 0, "errors": 0}


def test_cache_write_back(spark):
    items, cache, replies = scenario(spark)
    done = enrich.from_replies(enrich.from_cache(items, cache), enrich.settle_replies(replies))
    done = done.withColumn("location", F.when(F.col("seq") == 4, F.struct(
        F.lit(7.0).alias("lat"), F.lit(8.0).alias("lon"))).otherwise(F.col("location")))
    merged = {r.key: r.value for r in
              enrich.merge_cache(cache, enrich.cache_rows(done)).collect()}
    assert {r.key: r.value for r in enrich.cache_entries(done).collect()}.items() <= merged.items()
    assert set(merged) == {"ADDRESS_CACHE:preset", "ADDRESS_CACHE:cached", "ADDRESS_CACHE:cold",
                           "ADDRESS_CACHE:busy", "OTHER:unknown"}
    assert json.loads(merged["ADDRESS_CACHE:cold"]) == {"lat": 7.0, "lon": 8.0}


def test_translate(spark):
    items = spark.createDataFrame([("a",), ("b",), ("c",)], "info string")
    first = spark.createDataFrame([("a", "1a"), ("b", "1b")], "text string, translation string")
    second = spark.createDataFrame([("b", "2b")], "text string, translation string")

    def run(**options):
        return {r.info: r.translation
                for r in enrich.translate(items, F.col("info"), **options).collect()}

    assert run() == {"a": "N/A", "b": "N/A", "c": "N/A"}
    assert run(calculated=True, sources=(first, second)) == {
        "a": "1a", "b": "2b", "c": "calculated-c"}


def test_price_stages(spark):
    items = spark.createDataFrame([([99.0, 5.0],), ([],), (None,)], "price array<double>")
    done = enrich.legacy_pricing(enrich.add_surcharge(items))
    assert [r.price for r in done.collect()] == [[120.0, 5.0], [], None]


def test_hot_address_is_split(spark):
    """An address held by most items, through settled replies and a cache ahead of them: AQE
    splits both joins, in a session without settings of the library's own."""
    session = spark.newSession()
    for key, value in {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}.items():
        session.conf.set(key, value)
    address = F.when(F.col("id") % 10 < 8, "hot").otherwise(F.col("id").cast("string"))
    hot = session.range(0, 200000, 1, 8).select(
        F.col("id").alias("seq"), F.array(address).alias("address"),
        F.lit(None).cast("struct<lat:double,lon:double>").alias("location"))
    body = json.dumps({"status": "OK", "results": [
        {"geometry": {"location": {"lat": 1.0, "lng": 2.0}}}]})
    replies = session.range(0, 200000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("address"),
        F.lit(0).alias("attempt"), F.lit(body).alias("body"))
    cache = session.range(0, 1000).select(
        F.concat(F.lit("ADDRESS_CACHE:k"), F.col("id").cast("string")).alias("key"),
        F.lit('{"lat":1.0,"lon":1.0}').alias("value"))
    done = enrich.from_replies(enrich.from_cache(enrich.with_address(hot), cache),
                               enrich.settle_replies(replies))
    rows = done.collect()
    assert len(rows) == 200000 and all(r.geo == "found" for r in rows)
    plan = done._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("SortMergeJoin(skew=true)") == 2


def test_repeated_cache_keys_multiply_nothing(spark):
    items = spark.createDataFrame([(["a"], None)], "address array<string>, "
                                  "location struct<lat:double,lon:double>")
    cache = spark.createDataFrame([("ADDRESS_CACHE:a", '{"lat":1.0,"lon":1.0}'),
                                   ("ADDRESS_CACHE:a", '{"lat":2.0,"lon":1.0}')],
                                  "key string, value string")
    assert [r.location.lat for r in enrich.from_cache(items, cache).collect()] == [2.0]


def test_a_place_comes_from_one_reply(spark):
    """Replies of the same attempt are not mixed: latitude and longitude belong together."""
    def body(lat, lng):
        return json.dumps({"status": "OK", "results": [
            {"geometry": {"location": {"lat": lat, "lng": lng}}}]})

    rows = [("a", 0, body(1.0, 9.0)), ("a", 0, body(2.0, 3.0)), ("a", 0, body(None, 1.0)),
            ("b", 0, body(None, 5.0)), ("c", 0, '{"status": "OVER_QUERY_LIMIT"}')]
    frame = spark.createDataFrame(rows, "address string, attempt int, body string")
    got = {r.address: (r.found and tuple(r.found), r.retries)
           for r in enrich.settle_replies(frame).collect()}
    assert got == {"a": ((1.0, 9.0), 0), "b": (None, 0), "c": (None, 1)}
