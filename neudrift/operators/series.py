"""Displacement series: time slice, zero level, centimetres, long form, axis ranges."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from neudrift.functions.buckets import divides_day, midnight, ntz, width_seconds
from neudrift.schema import COMPONENT_LABELS, COMPONENTS, LEVEL_BUCKETS
from neudrift.session import BROADCAST_ROWS


def slice_time(df: DataFrame, start, end, column="time") -> DataFrame:
    """Buckets that start within [start, end], both ends included."""
    return df.where(F.col(column).between(ntz(start), ntz(end)))


def observations_for_slice(df: DataFrame, start, end, width) -> DataFrame:
    """The observations that the buckets of a slice are made of, as a filter the scan can take.

    Without it only a condition on the bucket expression would reach the scan. For a width that
    does not divide a day the first day must stay whole, since it anchors the buckets.
    """
    first = ntz(start) if divides_day(width) else midnight(ntz(start))
    beyond = ntz(end) + F.expr(f"INTERVAL '{width_seconds(width)}' SECOND")
    return df.where((F.col("time") >= first) & (F.col("time") < beyond))


def reference_levels(df: DataFrame, by, components=COMPONENTS, buckets=LEVEL_BUCKETS) -> DataFrame:
    """Mean of the first `buckets` rows of each series by time.

    The row limit is applied in each task before the shuffle, so no series is gathered whole.
    """
    order = Window.partitionBy(*by).orderBy("time")
    return (
        df.select(*by, "time", *components)
        .withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= buckets)
        .groupBy(*by).agg(*[F.avg(c).alias(f"{c}_level") for c in components])
    )


def displacement_cm(df: DataFrame, by, components=COMPONENTS, buckets=LEVEL_BUCKETS,
                    at_most: int | None = None) -> DataFrame:
    """Offsets from the reference level in centimetres.

    `at_most` is a proven bound on the number of series, within which the levels are broadcast.
    """
    levels = reference_levels(df, by, components, buckets)
    if at_most is not None and at_most <= BROADCAST_ROWS:
        levels = F.broadcast(levels)
    return df.join(levels, list(by)).select(
        *by, "time", *[((F.col(c) - F.col(f"{c}_level")) * 100).alias(c) for c in components])


def component_series(df: DataFrame, by, components=COMPONENTS) -> DataFrame:
    """One row per point: series keys, component, time, value_cm."""
    return df.unpivot([*by, "time"], list(components), "component", "value_cm")


def component_label(component: Column) -> Column:
    pairs = [F.lit(x) for pair in COMPONENT_LABELS.items() for x in pair]
    return F.element_at(F.create_map(*pairs), component)


def axis_range(series: DataFrame, by=("figure",)) -> DataFrame:
    """Lowest and highest value per figure and component, over all its series."""
    return series.groupBy(*by, "component").agg(
        F.min("value_cm").alias("floor_cm"), F.max("value_cm").alias("ceiling_cm"))
