import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from neudrift.functions.buckets import width_seconds
from neudrift.operators.medians import hot_keys, medians
from neudrift.operators.archive import archive_rows, daily_lines
from neudrift.operators.resample import bucket_spine, resample_dense, resample_medians
from neudrift.schema import ARCHIVE_COLUMNS

START = datetime(2024, 2, 28, 22, 40)


def observations(seed, rows=800, nulls=True, spread=60 * 60 * 30):
    """Random rows of three series, one of which holds a third of all rows in one minute."""
    draw = random.Random(seed)
    out = []
    for _ in range(rows):
        rover = draw.choice(["AAAA", "BBBB", "CCCC"])
        offset = draw.uniform(0, 40) if draw.random() < 0.33 else draw.uniform(0, spread)
        n = None if nulls and draw.random() < 0.1 else round(draw.gauss(0, 1), draw.choice([1, 4, 12]))
        out.append((rover, "BASE", START + timedelta(microseconds=int(offset * 1e6)), n,
                    round(draw.uniform(-5, 5), 2)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "rover string, base string, time timestamp_ntz, n double, e double")


def pandas_resample(rows, width, dense=False):
    data = pd.DataFrame(rows, columns=["rover", "base", "time", "n", "e"])
    parts = []
    for rover, part in data.groupby("rover"):
        table = part.set_index("time")[["n", "e"]].astype(float).resample(width).median()
        table = table if dense else table.dropna()
        parts.append(table.reset_index().assign(rover=rover))
    return pd.concat(parts).sort_values(["rover", "time"]).reset_index(drop=True)[["rover", "time", "n", "e"]]


def collected(df):
    out = df.select("rover", "time", "n", "e").toPandas().sort_values(["rover", "time"])
    return out.reset_index(drop=True)


def same(left, right):
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=0, atol=1e-12)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("width", ["60s", "1min", "10min", "7min", "1h", "5h", "1d", "2d"])
def test_sparse_equals_pandas(spark, width, seed):
    rows = observations(seed)
    same(collected(resample_medians(frame(spark, rows), width, ["n", "e"])), pandas_resample(rows, width))


@pytest.mark.parametrize("limit", [1, 5, 40])
@pytest.mark.parametrize("width", ["60s", "7min", "1h"])
def test_split_buckets_give_the_same_medians(spark, width, limit):
    rows = observations(limit)
    same(collected(resample_medians(frame(spark, rows), width, ["n", "e"], hot_values=2 * limit)),
         pandas_resample(rows, width))


def test_split_with_copies_and_missing_values(spark):
    rows = [("k", 1.0)] * 50 + [("k", 2.0)] * 50 + [("k", None)] * 7 + [("l", 3.0)] * 30 + [("m", None)] * 30
    rows += [("o", float(i)) for i in range(31)]
    df = spark.createDataFrame(rows, "key string, v double")
    hot = hot_keys(df, ["key"], ["v"], 5)
    assert hot.count() == 4
    found = {r.key: r.v for r in medians(df, ["key"], ["v"], hot).collect()}
    assert found == {"k": 1.5, "l": 3.0, "m": None, "o": 15.0}


def test_hot_key_that_filters_removed(spark):
    df = spark.createDataFrame([("k", 1.0), ("l", 2.0)], "key string, v double")
    hot = spark.createDataFrame([("k",), ("gone",)], "key string")
    assert {r.key: r.v for r in medians(df, ["key"], ["v"], hot).collect()} == {"k": 1.0, "l": 2.0}


def signed(value):
    return None if value is None else str(value)


@pytest.mark.parametrize("limit", [1, 1_000])
def test_zeros_keep_their_sign(spark, limit):
    """The same on both ways: -0.0 comes before 0.0, and a mean of both is 0.0."""
    cases = {"a": [-0.0] * 3, "b": [0.0] * 3, "c": [-0.0, 0.0], "d": [-0.0, -0.0, 0.0], "e": [-0.0, 0.0, 0.0],
             "f": [-1.0, -0.0, 0.0, 1.0], "g": [-1.0, -0.0, -0.0, 1.0], "h": [None, -0.0], "i": [None, None],
             "j": [-2.0, -1.0, -0.0, 5.0], "k": [0.0, -0.0, -0.0, 3.0, -0.0, 4.0]}
    want = {"a": "-0.0", "b": "0.0", "c": "0.0", "d": "-0.0", "e": "0.0", "f": "0.0", "g": "-0.0", "h": "-0.0",
            "i": None, "j": "-0.5", "k": "0.0"}
    df = spark.createDataFrame([(k, v) for k, vs in cases.items() for v in vs], "key string, v double").repartition(5)
    hot = hot_keys(df, ["key"], ["v"], limit)
    assert (hot is None) == (limit > 1)
    assert {r.key: signed(r.v) for r in medians(df, ["key"], ["v"], hot).collect()} == want


def test_proven_bound_needs_no_count(spark):
    df = spark.createDataFrame([("k", 1.0)] * 9, "key string, v double")
    assert hot_keys(df, ["key"], ["v"], 5, at_most=5) is None
    assert hot_keys(df, ["key"], ["v"], 5, at_most=6).count() == 1


def test_no_hot_keys(spark):
    df = spark.createDataFrame([("k", 1.0)], "key string, v double")
    assert hot_keys(df, ["key"], ["v"], 5) is None


@pytest.mark.parametrize("width", ["60s", "7min"])
@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_dense_equals_pandas(spark, width, limit):
    rows = observations(7)
    df = frame(spark, rows).withColumn("source_file", F.col("rover"))
    same(collected(resample_dense(df, width, ["n", "e"], hot_values=limit)),
         pandas_resample(rows, width, dense=True))


def test_dense_without_empty_buckets_is_sparse(spark):
    df = frame(spark, observations(9, nulls=False)).withColumn("source_file", F.lit("f"))
    dense = resample_dense(df, "60s", ["n", "e"]).where("n IS NOT NULL")
    same(collected(dense), collected(resample_medians(df, "60s", ["n", "e"])))


def test_gap(spark):
    times = [datetime(2024, 3, 1, 0, 0, 5), datetime(2024, 3, 1, 0, 3, 5)]
    df = frame(spark, [("AAAA", "BASE", t, 1.0, 1.0) for t in times]).withColumn("source_file", F.lit("f"))
    assert resample_medians(df, "60s", ["n", "e"]).count() == 2
    assert resample_dense(df, "60s", ["n", "e"]).count() == 4


def test_spine_over_a_long_span(spark):
    ends = [datetime(1999, 12, 31, 23, 59, 59), datetime(2001, 1, 1)]
    df = frame(spark, [("AAAA", "BASE", t, 1.0, 1.0) for t in ends])
    spine = bucket_spine(df, "60s", ["base", "rover"])
    found = spine.agg(F.count("bucket"), F.count_distinct("bucket"), F.min("bucket"), F.max("bucket")).first()
    assert tuple(found) == (527042, 527042, datetime(1999, 12, 31, 23, 59), datetime(2001, 1, 1))


@pytest.fixture
def new_york(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_times_do_not_depend_on_the_session_zone(spark, new_york):
    """The night in which 02:00 to 03:00 does not exist there."""
    start = datetime(2024, 3, 9, 23)
    rows = [("AAAA", "BASE", start + timedelta(seconds=20 * i), i % 17 / 3, i % 5 / 7) for i in range(1200)]
    df = frame(spark, rows).withColumn("source_file", F.lit("f"))
    for width in ("60s", "7min"):
        same(collected(resample_medians(df, width, ["n", "e"])), pandas_resample(rows, width))
        same(collected(resample_dense(df, width, ["n", "e"])), pandas_resample(rows, width, dense=True))
    full = df.select("*", *[F.lit(0.0).alias(c) for c in ("sdn", "sde", "u", "sdu")])
    texts = daily_lines(archive_rows(resample_medians(full, "60s", ARCHIVE_COLUMNS)))
    stamps = sorted(r.line.split("\t")[0] for r in texts.collect())
    assert stamps == sorted({r[2].strftime("%Y-%m-%d %H:%M:00") for r in rows})


def test_widths():
    assert [width_seconds(w) for w in ("60s", "1min", "2h", "h", "1d", "10T", "90 seconds", 5)] == [
        60, 60, 7200, 3600, 86400, 600, 90, 5]
    for bad in ("", "5", "3 weeks", "0s", "min5"):
        with pytest.raises(ValueError):
            width_seconds(bad)


def hot_rows(spark, n=120_000):
    """One key with many values: spread, with ties, nearly all equal, mostly missing, signed zeros, extreme tails."""
    k = F.col("id")
    noise = F.rand(3)
    return spark.range(n, numPartitions=6).select(
        F.lit("K").alias("k"), noise.alias("a"), F.round(noise * 50).alias("b"),
        F.when(k % 1000 == 0, noise).otherwise(7.0).alias("c"), F.when(k % 500 == 0, noise).alias("d"),
        F.when(k % 2 == 0, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("e"), F.exp(noise * 300 - 150).alias("f"),
        F.lit(None).cast("double").alias("g"))


@pytest.mark.parametrize("size, reach", [(1024, 0.01), (8, 0.001)])
def test_bracketed_medians_are_exact(spark, monkeypatch, size, reach):
    """With a sketch far too small and a narrow bracket, middle ranks are missed and all values are ranked."""
    monkeypatch.setattr("neudrift.operators.medians.SKETCH_SIZE", size)
    monkeypatch.setattr("neudrift.operators.medians.REACH", reach)
    rows, columns = hot_rows(spark), list("abcdefg")
    found = medians(rows, ["k"], columns, rows.select("k").distinct()).collect()
    data = rows.drop("k").toPandas()
    assert len(found) == 1
    for c in columns[:-1]:
        assert found[0][c] == pytest.approx(data[c].median(), abs=0), c
    assert found[0]["g"] is None


def test_bracket_shuffles_few_values(spark):
    """Between the bounds lie some 2 % of a column's values, and they alone are kept one by one."""
    from neudrift.operators import medians as module

    rows = hot_rows(spark).select("k", "a", "f")
    sketches = rows.groupBy("k").agg(*[F.kll_sketch_agg_double(c, F.lit(1024)).alias(c) for c in "af"])
    ends = F.array(F.lit(0.5 - module.REACH), F.lit(0.5 + module.REACH))
    bounds = sketches.select("k", *[F.kll_sketch_get_quantile_double(c, ends).alias(f"_{c}") for c in "af"])
    counted = module._counts_around(rows.join(bounds, "k"), ["k"], ["a", "f"])
    kept = counted.where("part = 0").count()
    assert 0 < kept < 0.04 * 2 * 120_000
    assert counted.agg(F.sum("n")).first()[0] == 2 * 120_000
