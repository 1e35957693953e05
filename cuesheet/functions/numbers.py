"""Numbers as the scripts write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """``value`` to ``digits`` decimals by its exact binary value, true ties to the even digit.

    Spark's own ``round`` decides by the shortest decimal text, so that 64.3175, whose binary value
    lies below the tie, goes up. The scaled product's rounding error is recovered by splitting the value
    in halves of 26 bits, and decides where the product looks like a tie."""
    scale = float(10 ** digits)
    big = value * F.lit(134217729.0)
    high = big - (big - value)
    product = value * F.lit(scale)
    error = (high * F.lit(scale) - product) + (value - high) * F.lit(scale)
    low = F.floor(product)
    part = product - low
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (low % 2 != 0))))
    return F.when(F.abs(product) < 2.0 ** 51, (low + F.when(up, 1).otherwise(0)).cast("double") / F.lit(scale)).otherwise(value)
