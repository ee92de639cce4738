"""DOUBLE values as BIGINT keys in the same order, inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the 64-bit format: bits of the fraction, bias of the exponent, exponent of infinity, smallest normal value.
FRACTION = 52
BIAS = 1023
TOP = 2047
NORMAL = 2.0**-1022
#: Half the exponent of the smallest value: 2^537 squared scales it to 1.
HALF = 2.0**537


def order_key(value: Column) -> Column:
    """The bits of a DOUBLE as a number that keeps the order (-0.0 as 0.0); NULL for NULL and NaN.

    Built from exact arithmetic only: scaling by powers of two, and one correction of the logarithm.
    """
    x = F.when(~F.isnan(value), value.cast("double"))
    size = F.abs(x)
    guess = F.floor(F.log2(size)).cast("int")
    scaled = size * F.pow(F.lit(2.0), -guess)
    exponent = guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    fraction = ((size * F.pow(F.lit(2.0), -exponent) - 1) * float(1 << FRACTION)).cast("bigint")
    normal = F.shiftleft((exponent + BIAS).cast("bigint"), FRACTION) + fraction
    bits = F.when(size == 0, F.lit(0).cast("bigint")).when(size < NORMAL, (size * HALF * HALF).cast("bigint")).when(size == float("inf"), F.lit(TOP << FRACTION).cast("bigint")).otherwise(normal)
    # Written so that the long expression stands once: generated code repeats it wherever it stands.
    return bits * F.when(x < 0, -1).otherwise(1) - (x < 0).cast("bigint")


def order_value(key: Column) -> Column:
    """The DOUBLE of an order key; keys beyond infinity give infinity."""
    bits = F.when(key < 0, -key - 1).otherwise(key)
    exponent = F.shiftright(bits, FRACTION)
    fraction = bits.bitwiseAND(F.lit((1 << FRACTION) - 1).cast("bigint")).cast("double")
    normal = (1 + fraction / float(1 << FRACTION)) * F.pow(F.lit(2.0), (exponent - BIAS).cast("double"))
    size = F.when(exponent == 0, fraction / HALF / HALF).when(exponent >= TOP, F.lit(float("inf"))).otherwise(normal)
    return F.when(key < 0, -size).otherwise(size)
