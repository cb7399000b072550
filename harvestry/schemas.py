"""Explicit schemas. Every field is nullable: a field an item lacks is NULL."""

from __future__ import annotations

from pyspark.sql import types as T

_strings = T.ArrayType(T.StringType())

LOCATION = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

IMAGE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("checksum", T.StringType()),
])

CORRUPT = "_corrupt_record"

# The twelve item fields, in declaration order.
ITEM = T.StructType([
    T.StructField("title", _strings),
    T.StructField("price", T.ArrayType(T.DoubleType())),
    T.StructField("description", _strings),
    T.StructField("address", _strings),
    T.StructField("image_urls", _strings),
    T.StructField("images", T.ArrayType(IMAGE)),
    T.StructField("location", LOCATION),
    T.StructField("url", _strings),
    T.StructField("project", _strings),
    T.StructField("spider", _strings),
    T.StructField("server", _strings),
    T.StructField("date", _strings),
])

# The projection the word-price analysis needs; the JSON reader skips the other fields.
PRICED_TITLE = T.StructType([ITEM["title"], ITEM["price"]])

LIST_ITEM = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("info", _strings),
    T.StructField("translation", T.StringType()),
])

INDEX_ENTRIES = T.ArrayType(T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("title", T.StringType()),
]))

GEOCODE = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("geometry", T.StructType([
            T.StructField("location", T.StructType([
                T.StructField("lat", T.DoubleType()),
                T.StructField("lng", T.DoubleType()),
            ])),
        ])),
    ]))),
])

JOB_STATUS = T.StructType([
    T.StructField(state, T.ArrayType(T.StructType([T.StructField("id", T.StringType())])))
    for state in ("running", "finished", "pending")
])
