import math
import random

from neudrift.functions.fixed3 import with_fixed3


def test_equals_c_formatting(spark):
    draw = random.Random(3)
    values = [1.0005, 1.0015, 2.0025, -0.0001, 0.0, -0.0, 0.5075, 0.0005, 0.0015, 0.9995, 0.99951,
              999.9995, -999.9995, 5e-324, 1e-310, 123456789.0625, 2.0**52 + 0.5, 2.0**60, -2.0**43 - 0.125]
    values += [round(draw.uniform(-100, 100), draw.choice([3, 4, 5, 6])) for _ in range(4000)]
    values += [draw.randrange(-10**6, 10**6) / 2000 for _ in range(4000)]
    values += [draw.randrange(-10**6, 10**6) / 16000 for _ in range(4000)]
    values += [math.ldexp(draw.uniform(-1, 1), draw.randrange(-30, 60)) for _ in range(4000)]
    values += [math.nextafter(draw.randrange(10**6) / 2000, draw.choice([0, 1e9])) for _ in range(4000)]
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "i int, v double, kept double")
    found = with_fixed3(df, ["v"]).orderBy("i").collect()
    wrong = [(r.kept, r.v) for r in found if r.v != "%.3f" % r.kept]
    assert not wrong, wrong[:5]


def test_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert with_fixed3(df, ["v"]).first().v == ""
