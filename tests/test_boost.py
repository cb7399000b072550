import pytest
from pyspark.errors import PySparkException

from harvestry.operators.boost import (
    price_shifts, split_priced, top_bottom, word_prices, word_totals)
from harvestry.schemas import PRICED_TITLE

A = (["Split Business Split"], [1.0])
B = (["Need business"], [2.0])


def items(spark, *rows):
    return spark.createDataFrame(list(rows), PRICED_TITLE)


def prices(spark, *rows):
    return {r.word: (r.price_sum, r.n) for r in word_prices(items(spark, *rows)).collect()}


def shifts(spark, *rows):
    return {r.word: r["shift"]
            for r in price_shifts(word_prices(items(spark, *rows))).collect()}


def test_word_prices_of_one_item(spark):
    assert prices(spark, A) == {"business": (1.0, 1), "split": (1.0, 1)}


def test_word_prices_of_two_items(spark):
    assert prices(spark, A, B) == {"need": (2.0, 1), "business": (3.0, 2), "split": (1.0, 1)}


def test_totals_weigh_words(spark):
    row = word_totals(word_prices(items(spark, A, B))).first()
    assert (row.price_sum, row.n) == (6.0, 4)


def test_shifts_of_one_item(spark):
    assert shifts(spark, A) == pytest.approx({"business": 0.0, "split": 0.0})


def test_shifts_of_two_items(spark):
    assert shifts(spark, A, B) == pytest.approx(
        {"need": 0.44444444, "business": 0.0, "split": -0.44444444})


def test_no_items_no_shifts(spark):
    assert shifts(spark) == {}


def test_only_word_is_worth_one(spark):
    assert shifts(spark, (["one One"][:1], [3.0])) == {"one": 1.0}
    assert shifts(spark, (["one"], [3.0]), (["one"], [5.0])) == {"one": 1.0}


def test_distinct_before_lower_case(spark):
    assert prices(spark, (["Split split"], [1.0])) == {"split": (2.0, 2)}


def test_zero_mean_is_an_error(spark):
    with pytest.raises(PySparkException):
        shifts(spark, (["a b"], [0.0]))


def test_incomplete_items_are_set_aside(spark):
    rows = items(spark, A, (None, [1.0]), ([], [1.0]), (["x"], None), (["x"], []))
    usable, rejected = split_priced(rows)
    assert usable.count() == 1
    assert sorted(r.reason for r in rejected.collect()) == [
        "no price", "no price", "no title", "no title"]
    assert word_prices(rows).count() == 2


def test_top_bottom_order_and_overlap(spark):
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0)], "word string, shift double")
    lines = [(r.line, r.side, r.word) for r in top_bottom(table, 2).orderBy("line").collect()]
    assert lines == [(1, "top", "b"), (2, "top", "c"), (3, "bottom", "b"), (4, "bottom", "a")]


def test_word_aggregate_is_shuffled_once(spark):
    found = price_shifts(word_prices(items(spark, A, B)))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]
