"""Median resampling onto fixed time buckets, sparse or gap-filled."""

from pyspark.sql import DataFrame, functions as F

from neudrift.functions.buckets import (
    bucket_start, divides_day, plus_seconds, seconds_between, width_seconds,
)
from neudrift.operators.medians import HOT_VALUES, drop_empty, hot_keys, medians
from neudrift.schema import DEFAULT_WIDTH, ONE_MINUTE_METRICS, VALUE_COLUMNS
from neudrift.session import join_small, settle

PAIR = ("base", "rover")
PER_FILE = (*PAIR, "source_file")
_BLOCK = 1440


def with_bucket(df: DataFrame, width=DEFAULT_WIDTH, by=PAIR, origin: DataFrame | None = None):
    """Add `bucket`, the start of the bucket of `time`.

    A width that does not divide a day is counted from the first midnight of each series;
    `origin` (see `first_days`) holds that day and is found from `df` when not given.
    """
    if divides_day(width):
        return df.withColumn("bucket", bucket_start(F.col("time"), width))
    if origin is None:
        origin = first_days(df, by)
    return (
        join_small(df, origin, list(by))
        .withColumn("bucket", bucket_start(F.col("time"), width, F.col("first_day")))
        .drop("first_day")
    )


def first_days(df: DataFrame, by=PAIR) -> DataFrame:
    """Day of the first observation of each series, computed once."""
    return settle(df.groupBy(*by).agg(F.to_date(F.min("time")).alias("first_day")))


def resample_medians(df: DataFrame, width=DEFAULT_WIDTH, columns=VALUE_COLUMNS, by=PAIR,
                     hot_values=HOT_VALUES, superset: DataFrame | None = None,
                     at_most: int | None = None) -> DataFrame:
    """Sparse resampling: one row per series and occupied bucket, exact medians of `columns`.

    `hot_values` is the bucket size (rows times columns) above which the ranked medians take over.
    Buckets are counted as soon as this is called, unless `at_most`, a proven bound on the rows of
    a bucket, shows that there is no need. `superset` may give the rows before filtering, on which
    the bucket sizes can be counted from fewer columns.
    """
    origin = None if divides_day(width) else first_days(df, by)
    keys = [*by, "bucket"]
    counted = (df if superset is None else superset).select(*by, "time")
    hot = hot_keys(with_bucket(counted, width, by, origin), keys, columns, hot_values, at_most)
    rows = with_bucket(df, width, by, origin).select(*keys, *columns)
    result = medians(rows, keys, columns, hot)
    return drop_empty(result, columns).withColumnRenamed("bucket", "time")


def bucket_spine(df: DataFrame, width=DEFAULT_WIDTH, by=PER_FILE) -> DataFrame:
    """Every bucket from the first to the last observation of each series.

    Blocks of buckets are spread first and the buckets of a block second, so that a series with a
    stray date does not build one huge array.
    """
    seconds = width_seconds(width)
    ends = df.groupBy(*by).agg(F.min("time").alias("_first"), F.max("time").alias("_last"))
    day = F.to_date("_first")
    spans = ends.select(
        *by, bucket_start(F.col("_first"), seconds, day).alias("_from"),
        bucket_start(F.col("_last"), seconds, day).alias("_to"))
    last = (seconds_between(F.col("_from"), F.col("_to")) / seconds).cast("long")
    blocks = spans.select(*by, "_from", last.alias("_last")).select(
        *by, "_from", "_last",
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"_last div {_BLOCK}"))).alias("_block"))
    numbered = blocks.select(*by, "_from", F.explode(F.sequence(
        F.col("_block") * _BLOCK,
        F.least("_last", F.col("_block") * _BLOCK + (_BLOCK - 1)))).alias("_number"))
    return numbered.select(*by, plus_seconds(F.col("_from"), F.col("_number") * seconds).alias("bucket"))


def resample_dense(df: DataFrame, width=DEFAULT_WIDTH, columns=ONE_MINUTE_METRICS, by=PER_FILE,
                   hot_values=HOT_VALUES, at_most: int | None = None) -> DataFrame:
    """Gap-filled resampling of each source file: also the empty buckets between its first and
    last observation, with null medians; a column may be null in an occupied bucket too."""
    origin = None if divides_day(width) else first_days(df, by)
    keys = [*by, "bucket"]
    rows = with_bucket(df, width, by, origin).select(*keys, *columns)
    hot = hot_keys(rows, keys, columns, hot_values, at_most)
    occupied = medians(rows, keys, columns, hot)
    return (
        bucket_spine(df, width, by).join(occupied, keys, "left")
        .select(*by, F.col("bucket").alias("time"), *columns)
    )
