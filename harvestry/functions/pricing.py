"""Price arithmetic. Steps that use a value more than once are DataFrame steps, so that the
value is computed once and inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The surcharge step and the legacy calculator's factor.
SURCHARGE = 1.0
LEGACY_FACTOR = 1.2


def first(prices: Column) -> Column:
    return F.get(prices, F.lit(0))


def with_first(prices: Column, price: Column) -> Column:
    """The list with element 0 replaced; an empty or missing list stays as it is."""
    rest = F.slice(prices, 2, F.greatest(F.size(prices) - 1, F.lit(0)))
    return F.when(F.size(prices) > 0, F.concat(F.array(price), rest)).otherwise(prices)


def surcharge(price: Column) -> Column:
    return price + F.lit(SURCHARGE)


def six_digits(rows: DataFrame, name: str) -> DataFrame:
    """Round the positive numbers in a column to six significant digits as C's "%.6g" does:
    by their exact binary value, ties to even. Integral numbers stay as they are.
    (``format_string`` rounds the shortest decimal form half up, which differs on ties.)
    """
    y, whole, unit, scale = (F.col(c) for c in (name, "_whole", "_unit", "_scale"))
    multiple, rest = F.col("_multiple"), F.col("_rest")
    places, left = F.col("_places"), F.col("_left")
    low = F.lit((1 << 26) - 1)
    exact = F.least(y, F.lit(float(2**53)))  # larger numbers are integral
    steps = rows.withColumns({
        "_whole": F.floor(exact),
        "_digits": F.length(F.floor(exact).cast("string")),
        # A number from 1 has at most 52 binary places: an exact integer, in two halves.
        "_bits": ((exact - F.floor(exact)) * float(2**52)).cast("long"),
    }).withColumns({
        "_unit": F.pow(F.lit(10.0), F.greatest(F.col("_digits") - 6, F.lit(0))).cast("long"),
        "_scale": F.pow(F.lit(10.0), F.greatest(6 - F.col("_digits"), F.lit(0))).cast("long"),
    }).withColumns({
        # Six digits or more before the point: round to a multiple of the unit.
        "_multiple": F.floor(whole / unit),
        # Fewer: fraction times scale, each half a product that fits 64 bits.
        "_lower": F.col("_bits").bitwiseAND(low) * scale,
        "_upper": F.shiftright("_bits", 26) * scale,
    }).withColumns({
        "_rest": (y - multiple * unit) * 2,
        "_upper": F.col("_upper") + F.shiftright("_lower", 26),
    }).withColumns({
        "_places": F.shiftright("_upper", 26),
        "_left": F.col("_upper").bitwiseAND(low) * (1 << 26) + F.col("_lower").bitwiseAND(low),
    })
    half = F.lit(2**51)
    large_up = (rest > unit) | ((rest == unit) & (multiple % 2 == 1))
    small_up = (left > half) | ((left == half) & (places % 2 == 1))
    rounded = (
        F.when((y == whole) | (y >= 2**53), y)
        .when(y < 1, F.format_string("%.6g", y).cast("double"))
        .when(unit * 100000 <= whole, ((multiple + large_up.cast("long")) * unit).cast("double"))
        .otherwise((whole * scale + places + small_up.cast("long")) / scale))
    return steps.withColumn(name, rounded).drop(
        "_whole", "_digits", "_bits", "_unit", "_scale", "_multiple", "_lower", "_upper",
        "_rest", "_places", "_left")


def legacy_price(rows: DataFrame, name: str) -> DataFrame:
    """The price as the legacy tool prints it: input to 6 decimals, times 1.2, then an
    integral result in full and any other with six significant digits."""
    return six_digits(rows.withColumn(name, F.lit(LEGACY_FACTOR) * F.round(name, 6)), name)
