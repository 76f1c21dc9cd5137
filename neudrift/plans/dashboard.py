"""The monitoring dashboard: groups of baselines drawn together, each over several ranges."""

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.functions.buckets import (
    clock_text, divides_day, minute_text, ntz, preset_span, resolve_range, seconds_between, time_bin,
)
from neudrift.operators.clean import clean
from neudrift.operators.medians import HOT_VALUES
from neudrift.operators.resample import PAIR, resample_medians
from neudrift.operators.series import (
    axis_range, component_label, component_series, displacement_cm, observations_for_slice,
    slice_time,
)
from neudrift.schema import COMPONENTS, DASHBOARD_GROUPS, DASHBOARD_PRESETS, DEFAULT_WIDTH
from neudrift.session import join_small, kept, settle, settling
from neudrift.sources.files import base_of, most_rows, rover_of, scan_daily
from neudrift.sources.lines import Reading, usable

# Fixed value: how figure names begin.
FIGURE_PREFIX = "rtk_"

# Seconds of the narrowest bin of a range join.
LEAST_BIN = 600


def group_frame(spark: SparkSession, groups=DASHBOARD_GROUPS) -> DataFrame:
    """Groups given as lists: group_key (first baseline), position, baseline, rover, base."""
    rows = [(group[0], i, name) for group in groups for i, name in enumerate(group)]
    frame = spark.createDataFrame(rows, "group_key string, position int, baseline string")
    return with_stations(frame)


def with_stations(frame: DataFrame) -> DataFrame:
    return frame.withColumns({
        "rover": rover_of(F.col("baseline")), "base": base_of(F.col("baseline"))})


def preset_ranges(presets, as_of):
    """(name, start, end) of each preset, ending at `as_of`."""
    return [(name, as_of - preset_span(name), as_of) for name in presets]


def expand_figures(groups: DataFrame, ranges) -> DataFrame:
    """One row per group member and range."""
    spans = F.array(*[
        F.struct(F.lit(name).alias("preset"), ntz(start).alias("start"), ntz(end).alias("end"))
        for name, start, end in ranges])
    return (
        groups.select("*", F.explode(spans).alias("_range")).select("*", "_range.*").drop("_range")
        .withColumn("figure", F.concat_ws("_", "group_key", "preset"))
    )


def slice_figures(resampled: DataFrame, figures: DataFrame, columns=COMPONENTS,
                  at_most: int | None = None, span: float | None = None) -> DataFrame:
    """Give each figure the buckets of its baselines within its range.

    A join on baseline and time bin. A range is listed under every bin that it meets, and a bucket looks only at
    the ranges of its own bin, so that many ranges of one baseline are neither compared with all its buckets nor
    one key of the join. Bins are as wide as a range is on average, so ranges are listed some twice.
    `at_most` and `span` are the number of `figures` and their mean length in seconds, if both are known.
    """
    spec = figures.select("figure", *PAIR, "start", "end").where(F.col("start") <= F.col("end"))
    if at_most is None or span is None:
        length = seconds_between(F.col("start"), F.col("end"))
        at_most, span = spec.agg(F.count(F.lit(1)), F.avg(length)).first()
    width = max(int(span or 0), LEAST_BIN)
    bins = F.sequence(time_bin(F.col("start"), width), time_bin(F.col("end"), width))
    listed = spec.withColumn("_bin", F.explode(bins))
    rows = resampled.select(*PAIR, "time", *columns).withColumn("_bin", time_bin(F.col("time"), width))
    # A range meets span / width + 2 bins at most, so all do three times their number.
    return (
        join_small(rows, listed, [*PAIR, "_bin"], at_most=3 * at_most)
        .where(F.col("time").between(F.col("start"), F.col("end")))
        .select("figure", *PAIR, "time", *columns)
    )


def dashboard_series(rows: DataFrame, groups: DataFrame, ranges, width=DEFAULT_WIDTH,
                     at_most: int | None = None, hot_values=HOT_VALUES,
                     superset: DataFrame | None = None, bucket_rows: int | None = None) -> DataFrame:
    """All points of all figures: figure, component, rover, base, time, value_cm.

    `rows` are clean observations. Baselines are resampled once, over the widest range, however many
    figures use them; with a width that does not divide a day once per range, since buckets are then
    counted from the first day of the range. `at_most` is the number of rows of `groups`, if known, and
    `bucket_rows` a proven bound on the rows of a bucket.
    """
    members = groups.select(*PAIR).distinct()
    if at_most is None:
        at_most = groups.count()

    def resampled(first, last):
        def needed(df):
            return join_small(observations_for_slice(df, first, last, width), members, list(PAIR),
                              "left_semi", at_most=at_most)

        return resample_medians(
            needed(rows), width, COMPONENTS, hot_values=hot_values,
            superset=needed(rows if superset is None else superset), at_most=bucket_rows)

    def sliced(buckets, some):
        span = sum((end - start).total_seconds() for _, start, end in some) / len(some)
        return slice_figures(buckets, expand_figures(groups, some), at_most=at_most * len(some), span=span)

    if divides_day(width):
        buckets = resampled(min(start for _, start, _ in ranges), max(end for _, _, end in ranges))
        points = sliced(buckets, ranges)
    else:
        points = reduce(DataFrame.unionByName, [
            sliced(resampled(one[1], one[2]), [one]) for one in ranges])
    moved = displacement_cm(points, ("figure", *PAIR), at_most=at_most * len(ranges))
    return component_series(moved, ("figure", *PAIR))


def figure_catalog(figures: DataFrame, kind="png", live=True) -> DataFrame:
    """Name, title and time marker per figure; `live` leaves the end out of the name."""
    first = figures.where("position = 0").select("group_key", "baseline", "preset", "start", "end")
    tail = F.col("preset") if live else F.concat_ws(
        "-", "preset", minute_text(F.col("end")))
    return first.select(
        F.concat_ws("_", "group_key", "preset").alias("figure"),
        F.concat(F.lit(FIGURE_PREFIX), "baseline", F.lit("_"), tail, F.lit(f".{kind}")).alias("file_name"),
        F.concat_ws(" ", "baseline", tail).alias("title"),
        base_of(F.col("baseline")).alias("base"),
        clock_text(F.col("end")).alias("marker"),
    )


def explicit_range_catalog(groups: DataFrame, start: datetime, end: datetime, kind="png") -> DataFrame:
    """Names and titles when a start is given: the range takes the place of the preset."""
    span = F.concat_ws("-", minute_text(ntz(start)), minute_text(ntz(end)))
    return groups.where("position = 0").select(
        F.concat(F.lit(FIGURE_PREFIX), "baseline", F.lit("_"), span, F.lit(f".{kind}")).alias("file_name"),
        F.concat_ws(" ", "baseline", span).alias("title"),
        clock_text(ntz(end)).alias("marker"),
    )


def plot_rows(spark: SparkSession, root: str, start, end, baselines, width, reading: Reading = Reading()):
    """Clean observations of some baselines, and a bound on the rows of a bucket if that is within the limit
    of hot buckets. Else the text is parsed once, and the rows are set aside to be read twice."""
    bound = most_rows(spark, root, start, end, baselines)
    lines = scan_daily(spark, root, start, end, list(baselines), reading.skip_unreadable)
    rows = clean(observations_for_slice(usable(reading.parse(lines)), start, end, width), reading.codes).select(*PAIR, "time", *COMPONENTS)
    return (rows, bound) if bound <= HOT_VALUES // len(COMPONENTS) else (settle(rows), None)


def run_dashboard(spark: SparkSession, root: str, groups=DASHBOARD_GROUPS, presets=DASHBOARD_PRESETS,
                  as_of=None, width=DEFAULT_WIDTH, end=None, reading: Reading = Reading()):
    """(series, axis ranges, figure catalog) of the dashboard over a folder of daily files.

    An explicit `end` is part of the figures' names; without one they are live, up to `as_of`.
    """
    _, last, _ = resolve_range(end=end, as_of=as_of)
    ranges = preset_ranges(presets, last)
    baselines = sorted({name for group in groups for name in group})
    frame = group_frame(spark, groups)
    with settling(spark):
        rows, bound = plot_rows(spark, root, min(r[1] for r in ranges), last, baselines, width, reading)
        series = kept(dashboard_series(
            rows, frame, ranges, width, at_most=sum(len(group) for group in groups), bucket_rows=bound))
    figures = expand_figures(frame, ranges)
    return series, axis_range(series), figure_catalog(figures, live=end is None)


def plot_series(spark: SparkSession, root: str, baselines, preset="twodays", start=None, end=None,
                as_of=None, width=DEFAULT_WIDTH, reading: Reading = Reading()) -> DataFrame:
    """Points of one figure: the given baselines over a preset or an explicit range."""
    start, end, preset = resolve_range(preset, start, end, as_of)
    with settling(spark):
        rows, bound = plot_rows(spark, root, start, end, baselines, width, reading)
        resampled = resample_medians(rows, width, COMPONENTS, at_most=bound)
        moved = displacement_cm(slice_time(resampled, start, end), PAIR, at_most=len(set(baselines)))
        return kept(component_series(moved, PAIR).withColumn("label", component_label(F.col("component"))))


def plot_catalog(spark: SparkSession, baselines, preset="twodays", start=None, end=None, as_of=None,
                 kind="png") -> DataFrame:
    """Name, title and time marker of the figure that `plot_series` gives the points of."""
    groups = group_frame(spark, [tuple(baselines)])
    live = end is None
    first, last, name = resolve_range(preset, start, end, as_of)
    if name is None:
        return explicit_range_catalog(groups, first, last, kind)
    figures = expand_figures(groups, [(name, first, last)])
    return figure_catalog(figures, kind, live).select("file_name", "title", "marker")
