import math
import random
import struct

from tidelane.functions.orderkeys import order_key, order_value
from pyspark.sql import functions as F


def bits(v):
    (n,) = struct.unpack("<q", struct.pack("<d", v + 0.0))
    return n if n >= 0 else n ^ 0x7FFF_FFFF_FFFF_FFFF


def test_keys_are_the_bits_in_order_and_come_back(spark):
    rng = random.Random(3)
    values = [float("-inf"), -1e300, -2.5, -1e-320, -0.0, 0.0, 5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 0.1, 1.0, math.nextafter(1, 0), math.nextafter(2, 0), 1e308, 1.7976931348623157e308, float("inf")]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(5000)]
    values += [math.nextafter(2.0**e, d) for e in range(-1070, 1023, 7) for d in (0, math.inf)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_key(F.col("v")).alias("k"))
    for r in df.select("v", "k", order_value(F.col("k")).alias("b")).collect():
        assert r.k == bits(r.v) and r.b == r.v, (r.v, r.k, bits(r.v), r.b)


def test_nulls_and_nans_have_no_key(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert [r[0] for r in df.select(order_key(F.col("v"))).collect()] == [None, None]
