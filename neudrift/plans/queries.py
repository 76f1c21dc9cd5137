"""The registered queries: each runs operators over the observations of an `events` table."""

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from neudrift.functions.buckets import day_text
from neudrift.functions.fixed3 import with_fixed3
from neudrift.operators import archive as arch
from neudrift.operators.clean import clean, decode_quality, exclude_quality, for_table
from neudrift.operators.resample import PAIR, resample_dense, resample_medians
from neudrift.operators.series import (
    axis_range, component_label, displacement_cm, observations_for_slice, reference_levels,
    slice_time,
)
from neudrift.operators.table import (
    append_bucketed, append_one_minute, as_one_minute, create_bucketed, read_one_minute, register_one_minute,
    table_columns, unique_by_key,
)
from neudrift.plans import dashboard as dash
from neudrift.plans.observations import store_lines
from neudrift.schema import (
    ARCHIVE_COLUMNS, COMPONENTS, DASHBOARD_PRESETS, FREEZE_BYTES, ONE_MINUTE_METRICS, PRESET_HOURS,
    VALUE_COLUMNS,
)
from neudrift.session import delete, last_use, move, scratch_path, settle
from neudrift.sources import events as ev
from neudrift.sources.files import (
    archive_sizes, archive_text, discover_baselines, list_below, list_files, newest_files, scan_archive, scan_daily,
    select_file_dates,
)
from neudrift.sources.lines import field_names, parse_lines, usable
from neudrift.streaming.load import stream_one_minute
from neudrift.streaming.resample import read_medians, stream_late_rows, stream_medians

AS_OF = datetime(2024, 1, 30, 12, 0, 0)
NOW = {"availableNow": True}
ARCHIVED_UNTIL = "2024-01-25 00:00:00"
PERIOD_START, PERIOD_END = "2023-12-28", "2024-02-02"


def rounded(df: DataFrame, columns, digits=6) -> DataFrame:
    """Values as compared: the last bits of an interpolated median are not specified."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


# Parsing and cleaning

def parse_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(ev.render_lines(ev.observations(spark, sf_dir)))
    return usable(parsed).select("event_id", "time", *VALUE_COLUMNS)


def spoiled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines spoiled in a way that depends on the quality."""
    labelled = decode_quality(ev.observations(spark, sf_dir)).withColumn(
        "kind", F.coalesce("quality", F.lit("none")))
    value, kind = F.col("value"), F.col("kind")
    return ev.render_lines(labelled, ["kind"]).withColumn(
        "value",
        F.when(kind == "float", F.regexp_replace(value, r"^([^.]*)[.][0-9]+", "$1"))
        .when(kind == "sbas", F.concat(value, F.lit("  1")))
        .when(kind == "dgps", F.concat(F.substring_index(value, "  ", 1), F.lit("  abc")))
        .when(kind == "single", F.concat(F.lit("% "), value))
        .otherwise(F.concat(value, F.lit(" % note"))))


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser says about spoiled lines."""
    return (
        parse_lines(spoiled_lines(spark, sf_dir)).groupBy("kind", F.coalesce("reason", F.lit("usable")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("lines"), F.count("time").alias("times"))
    )


def load_report(spark, sf_dir):
    """What a job read, set aside and wrote, counted while it wrote."""
    target = scratch_path(spark, "observations")
    return last_use(store_lines(spoiled_lines(spark, sf_dir), target), target)


def clean_observations(spark, sf_dir):
    return clean(ev.observations(spark, sf_dir)).select(
        "event_id", *PAIR, "time", *VALUE_COLUMNS)


def quality_filter_keep_null(spark, sf_dir):
    return exclude_quality(ev.observations(spark, sf_dir)).select("event_id", *PAIR, "time", "q")


def quality_decoded(spark, sf_dir):
    return decode_quality(ev.observations(spark, sf_dir)).select("event_id", "q", "quality")


def geodetic_observations(spark, sf_dir):
    """Lines whose first three values are latitude, longitude and height, parsed and cleaned as such."""
    parsed = parse_lines(ev.render_lines(ev.observations(spark, sf_dir)), layout="geodetic")
    columns = field_names("geodetic")
    return clean(usable(parsed), columns=columns).select("event_id", "time", *columns)


# Files

def file_listing(spark, sf_dir) -> DataFrame:
    """The daily files that the observations would come from; a file's length is taken from its
    fixed-quality observations of the late evening, so that some files are empty."""
    late_fixed = F.when((F.col("q") == 1) & (F.hour("time") >= 20), 150).otherwise(0)
    return (
        ev.observations(spark, sf_dir)
        .groupBy("baseline", F.to_date("time").alias("day"))
        .agg(F.sum(late_fixed).cast("long").alias("length"))
        .select(
            F.col("baseline").alias("directory"), "day", "length",
            F.concat("baseline", day_text(F.col("day")), F.lit("0000b.pos")).alias("name"))
    )


def daily_files(spark, sf_dir) -> str:
    """The observations written as daily files below <folder>/root; the folder. Spark names the parts, so each file
    is moved."""
    folder = scratch_path(spark, "daily")
    named = ev.daily_source(ev.observations(spark, sf_dir))
    lines = ev.render_lines(named, ["source_file", "time", "event_id"])
    parts = F.split("source_file", "/")
    (lines.select("value", "time", "event_id", parts[0].alias("directory"), parts[1].alias("name"))
     .repartition("directory", "name").sortWithinPartitions("directory", "name", "time", "event_id")
     .select("value", "directory", "name").write.partitionBy("directory", "name").text(f"{folder}/parts"))
    found = list_below(spark, f"{folder}/parts", "*.txt").select("path").toLocalIterator()
    for row in found:
        directory, name = (part.split("=", 1)[1] for part in row.path.split("/")[-3:-1])
        move(spark, row.path, f"{folder}/root/{directory}/{name}")
    return folder


def scan_daily_files(spark, sf_dir):
    """All daily files read back at once: rows of each, their time span and sums, parsed from the text."""
    folder = daily_files(spark, sf_dir)
    rows = usable(parse_lines(scan_daily(spark, f"{folder}/root")))
    return last_use(rows.groupBy("baseline", "rover", "base", F.element_at(F.split("source_file", "/"), -1).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("first"), F.max("time").alias("last"),
        F.round(F.sum("e"), 3).alias("e"), F.count("u").alias("with_u")), folder)


def listed_files(spark, sf_dir):
    """The daily files as the listing has them: names and which of them the newest four of each baseline are."""
    folder = daily_files(spark, sf_dir)
    listing = list_files(spark, f"{folder}/root")
    newest = newest_files(listing).select("directory", "name", F.lit(True).alias("newest"))
    return last_use(listing.join(newest, ["directory", "name"], "left").select(
        "directory", "name", F.coalesce("newest", F.lit(False)).alias("newest")), folder)


def baseline_tags(spark, sf_dir):
    return discover_baselines(file_listing(spark, sf_dir))


def newest_file_list(spark, sf_dir):
    return newest_files(file_listing(spark, sf_dir)).select("directory", "name", "length")


def files_by_date(spark, sf_dir):
    listing = file_listing(spark, sf_dir)
    return select_file_dates(listing, "2024-01-05 11:00:00", "2024-01-09 00:30:00").select(
        "directory", "name", "day")


# Resampling

def resampled(spark, sf_dir, width, columns, **options) -> DataFrame:
    observed = ev.observations(spark, sf_dir)
    return resample_medians(clean(observed), width, columns, superset=observed, **options)


def resample_60s(spark, sf_dir):
    return rounded(resampled(spark, sf_dir, "60s", ARCHIVE_COLUMNS), ARCHIVE_COLUMNS)


def resample_1h(spark, sf_dir):
    return rounded(resampled(spark, sf_dir, "1h", VALUE_COLUMNS), VALUE_COLUMNS)


def resample_7min_day_origin(spark, sf_dir):
    return rounded(resampled(spark, sf_dir, "7min", COMPONENTS), COMPONENTS)


def resample_1d_split(spark, sf_dir):
    """Daily medians with the size limit so low that many buckets take the ranked way."""
    return rounded(resampled(spark, sf_dir, "1d", COMPONENTS, hot_values=45 * len(COMPONENTS)), COMPONENTS)


def dense_medians(spark, sf_dir) -> DataFrame:
    return resample_dense(for_table(ev.daily_source(ev.observations(spark, sf_dir))))


def resample_dense_60s(spark, sf_dir):
    return rounded(dense_medians(spark, sf_dir), ONE_MINUTE_METRICS)


def comparable_table(table: DataFrame) -> DataFrame:
    floats = [f.name for f in table.schema if f.dataType.simpleString() == "float"]
    return rounded(table, floats).withColumn("q", F.col("q").cast("int"))


def one_min_table(spark, sf_dir):
    return comparable_table(as_one_minute(unique_by_key(dense_medians(spark, sf_dir))))


# Series

def station_groups(spark, sf_dir) -> DataFrame:
    """Dashboard groups found in the data: all baselines of a base station, in name order."""
    found = ev.observations(spark, sf_dir).select("baseline", *PAIR).distinct()
    by_name = Window.partitionBy("base").orderBy("baseline")
    return settle(found.select(
        F.first("baseline").over(by_name).alias("group_key"),
        (F.row_number().over(by_name) - 1).alias("position"), "baseline", *PAIR))


def series_of(spark, sf_dir, presets=DASHBOARD_PRESETS) -> DataFrame:
    observed = ev.observations(spark, sf_dir)
    return dash.dashboard_series(
        clean(observed), station_groups(spark, sf_dir), dash.preset_ranges(presets, AS_OF),
        superset=observed)


def sliced_figures(spark, sf_dir):
    ranges = dash.preset_ranges(PRESET_HOURS, AS_OF)
    first = min(start for _, start, _ in ranges)
    observed = observations_for_slice(ev.observations(spark, sf_dir), first, AS_OF, "60s")
    buckets = resample_medians(clean(observed), "60s", COMPONENTS, superset=observed)
    figures = dash.expand_figures(station_groups(spark, sf_dir), ranges)
    bound = figures.count()
    return dash.slice_figures(buckets, figures, at_most=bound), bound


def preset_slices(spark, sf_dir):
    return rounded(sliced_figures(spark, sf_dir)[0], COMPONENTS)


def event_windows(spark, sf_dir):
    """The hourly buckets in the six hours after every `sbas` observation of a baseline: as many ranges as
    there are such observations, on six baselines."""
    observed = ev.observations(spark, sf_dir)
    windows = observed.where("q = 3").select(
        F.col("event_id").alias("figure"), *PAIR, F.col("time").alias("start"),
        (F.col("time") + F.expr("INTERVAL 6 HOURS")).alias("end"))
    return rounded(dash.slice_figures(resampled(spark, sf_dir, "1h", COMPONENTS), windows), COMPONENTS)


def demeaned_cm(spark, sf_dir):
    points, bound = sliced_figures(spark, sf_dir)
    return rounded(displacement_cm(points, ("figure", *PAIR), at_most=bound), COMPONENTS, 8)


def series_levels(spark, sf_dir):
    levels = reference_levels(
        slice_time(resampled(spark, sf_dir, "60s", COMPONENTS), "2024-01-10 00:00:30", AS_OF), PAIR)
    return rounded(levels, [f"{c}_level" for c in COMPONENTS], 10)


def component_series(spark, sf_dir):
    series = rounded(series_of(spark, sf_dir), ["value_cm"], 8)
    return series.withColumn("label", component_label(F.col("component")))


def axis_floor(spark, sf_dir):
    return rounded(axis_range(series_of(spark, sf_dir)), ["floor_cm", "ceiling_cm"], 8)


def dashboard_7min(spark, sf_dir):
    """A width that does not divide a day: buckets are counted from the first day of each range."""
    observed = ev.observations(spark, sf_dir)
    return rounded(dash.dashboard_series(
        clean(observed), station_groups(spark, sf_dir), dash.preset_ranges(DASHBOARD_PRESETS, AS_OF),
        width="7min", superset=observed), ["value_cm"], 8)


def figure_catalog(spark, sf_dir):
    groups = station_groups(spark, sf_dir)
    figures = dash.expand_figures(groups, dash.preset_ranges(DASHBOARD_PRESETS, AS_OF))
    points = series_of(spark, sf_dir).groupBy("figure").agg(F.count(F.lit(1)).alias("points"))
    return dash.figure_catalog(figures, live=False).join(points, "figure", "left")


# Archive

def new_archive_rows(spark, sf_dir, width="1h") -> DataFrame:
    return arch.archive_rows(resampled(spark, sf_dir, width, ARCHIVE_COLUMNS))


def old_archive_rows(spark, sf_dir) -> DataFrame:
    """An earlier archive: hours in which there were fixed or float observations, up to a date,
    1 mm off so that kept rows can be told from new ones, rounded by its own text."""
    observed = ev.observations(spark, sf_dir).where(
        F.col("q").isin(1, 2) & (F.col("time") < F.lit(ARCHIVED_UNTIL).cast("timestamp_ntz")))
    rows = arch.archive_rows(resample_medians(clean(observed), "1h", ARCHIVE_COLUMNS))
    shifted = rows.withColumns({c: F.col(c) + 0.001 for c in ARCHIVE_COLUMNS})
    return with_fixed3(shifted, ARCHIVE_COLUMNS).withColumns(
        {c: F.col(c).cast("double") for c in ARCHIVE_COLUMNS})


def archive_run_states(new, old) -> DataFrame:
    sizes = arch.partition_bytes(arch.daily_lines(old))
    return arch.archive_states(arch.period_calendar(new, PERIOD_START, PERIOD_END), sizes)


def period_status(spark, sf_dir):
    rows = new_archive_rows(spark, sf_dir)
    return arch.period_status(arch.period_calendar(rows, PERIOD_START, PERIOD_END))


def archive_status(spark, sf_dir):
    old = old_archive_rows(spark, sf_dir)
    states = archive_run_states(new_archive_rows(spark, sf_dir), old)
    return states.select("baseline", "date", "state", "rows_new", "bytes")


def neu_lines(spark, sf_dir):
    lines = arch.daily_lines(new_archive_rows(spark, sf_dir))
    return arch.with_headers(lines, lines.select("baseline", "date").distinct())


def median_file(spark, sf_dir):
    return arch.median_lines(new_archive_rows(spark, sf_dir))


def median_file_days(spark, sf_dir):
    return arch.median_lines(new_archive_rows(spark, sf_dir, "1d"))


def archive_merge(spark, sf_dir):
    new, old = new_archive_rows(spark, sf_dir), old_archive_rows(spark, sf_dir)
    states = archive_run_states(new, old)
    lines = arch.daily_lines(arch.archive_update(new, old, states))
    return lines.join(states.select("baseline", "date", "state"), ["baseline", "date"])


def neu_lines_split(spark, sf_dir):
    """Archive text with the size limit so low that most buckets take the ranked way."""
    rows = arch.archive_rows(resampled(spark, sf_dir, "1h", ARCHIVE_COLUMNS, hot_values=len(ARCHIVE_COLUMNS)))
    return arch.daily_lines(rows)


def archive_roundtrip(spark, sf_dir):
    """The merged archive written as files, and what their lines and the listing say afterwards."""
    target = scratch_path(spark, "archive")
    new, old = new_archive_rows(spark, sf_dir), old_archive_rows(spark, sf_dir)
    arch.write_daily(arch.with_headers(arch.daily_lines(old), old.select(*arch.PARTITION).distinct()), target)
    arch.write_archive(spark, new, target, PERIOD_START, PERIOD_END, FREEZE_BYTES)
    rows = scan_archive(spark, target).groupBy(*arch.PARTITION).agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("first"), F.max("time").alias("last"),
        *[F.round(F.sum(c), 3).alias(c) for c in ARCHIVE_COLUMNS])
    return last_use(archive_sizes(spark, target).join(rows, list(arch.PARTITION), "left"), target)


def median_file_roundtrip(spark, sf_dir):
    """Whole-span files as lines, written in two runs of different baselines and read back."""
    target = scratch_path(spark, "median-files")
    rows = settle(new_archive_rows(spark, sf_dir))
    first = F.col("baseline") < "RV03"
    for some in (first, ~first):
        arch.write_median_files(rows.where(some), target)
    return last_use(spark.read.schema("line string, baseline string").text(target).select("baseline", "line"), target)


def archive_days(spark, sf_dir):
    """Archive files of the days of a calendar: every third day of a month on which there are observations."""
    target = scratch_path(spark, "calendar")
    rows = settle(new_archive_rows(spark, sf_dir))
    arch.write_daily(arch.with_headers(arch.daily_lines(rows), rows.select(*arch.PARTITION).distinct()), target)
    third = F.dayofmonth(F.to_date("time")) % 3 == 0
    calendar = ev.observations(spark, sf_dir).where(third).select(day_text(F.col("time")).alias("date"))
    found = scan_archive(spark, target, calendar).groupBy(*arch.PARTITION).agg(F.count(F.lit(1)).alias("rows"))
    return last_use(found, target)


def bucketed_table(spark, sf_dir, buckets=16):
    """The one-minute table in buckets, loaded in two steps that overlap."""
    path, name = scratch_path(spark, "bucketed"), f"one_min_{uuid.uuid4().hex}"
    minutes = settle(as_one_minute(unique_by_key(resample_dense(for_table(ev.daily_source(ev.observations(spark, sf_dir)))))))
    create_bucketed(spark, name, path, buckets)
    try:
        append_bucketed(minutes.where("base = 'BS00'"), name, buckets)
        append_bucketed(minutes, name, buckets)
        return last_use(comparable_table(spark.table(name)), path)
    finally:
        spark.sql(f"DROP TABLE {name}")


def written_order(spark, sf_dir):
    """Lines of each archive file and how many of them are older than the line before, by their place in the file."""
    target = scratch_path(spark, "ordered")
    rows = settle(new_archive_rows(spark, sf_dir))
    arch.write_daily(arch.with_headers(arch.daily_lines(rows), rows.select(*arch.PARTITION).distinct()), target)
    lines = archive_text(spark, target).withColumn("place", F.monotonically_increasing_id())
    before = Window.partitionBy(*arch.PARTITION).orderBy("place")
    # The header sorts before any time.
    disorder = F.count_if(F.col("line") < F.col("previous"))
    return last_use(lines.withColumn("previous", F.lag("line").over(before)).groupBy(*arch.PARTITION).agg(
        F.count(F.lit(1)).alias("lines"), disorder.alias("out_of_order")), target)


def table_metadata(spark, sf_dir):
    """The one-minute table as the catalog describes it, and how many rows have a value in each column."""
    path, name = scratch_path(spark, "described"), f"one_min_{uuid.uuid4().hex}"
    dense = resample_dense(for_table(ev.daily_source(ev.observations(spark, sf_dir))))
    append_one_minute(spark, dense, path)
    register_one_minute(spark, name, path)
    try:
        columns, table = table_columns(spark, name), spark.table(name)
        filled = table.agg(*[F.count(c).alias(c) for c in table.columns])
        filled = settle(filled.unpivot([], filled.columns, "column", "filled"))
    finally:
        spark.sql(f"DROP TABLE {name}")
    return last_use(columns.join(F.broadcast(filled), "column"), path)


# Streaming

def event_stream(spark, sf_dir) -> DataFrame:
    schema = ev.read_events(spark, sf_dir).schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return ev.observations_from(events)


def stream_resample(spark, sf_dir):
    target = scratch_path(spark, "stream-medians")
    query = stream_medians(clean(event_stream(spark, sf_dir)), target, f"{target}/checkpoint", "1h",
                           trigger=NOW)
    query.awaitTermination()
    return last_use(rounded(read_medians(spark, target), VALUE_COLUMNS), target)


def files_in_turn(spark, sf_dir, start) -> None:
    """Run a stream over the clean observations, which arrive as three folders with a pause between: those of
    quality 1, of 2, and the others. `start(stream)` gives the running query, which takes a folder as one micro-batch."""
    folder, observed = scratch_path(spark, "arriving"), settle(clean(ev.observations(spark, sf_dir)))
    for number, some in enumerate((F.col("q") == 1, F.col("q") == 2, F.col("q") > 2)):
        observed.where(some).write.parquet(f"{folder}/{number}")
        start(spark.readStream.schema(observed.schema).parquet(f"{folder}/*")).awaitTermination()
    delete(spark, folder)


def late_rows(spark, sf_dir):
    """Rows whose hour ended more than two days before the latest row of an earlier file."""
    target = scratch_path(spark, "late")
    files_in_turn(spark, sf_dir, lambda rows: stream_late_rows(rows, target, f"{target}/checkpoint", "1h", trigger=NOW))
    return last_use(spark.read.parquet(f"{target}/late").select("event_id", *PAIR, "time", "batch"), target)


def stream_within_delay(spark, sf_dir):
    """Medians of a stream of several micro-batches, of which the watermark leaves late rows out."""
    target = scratch_path(spark, "stream-delay")
    files_in_turn(spark, sf_dir, lambda rows: stream_medians(
        rows, target, f"{target}/checkpoint", "1h", COMPONENTS, trigger=NOW))
    return last_use(rounded(read_medians(spark, target), COMPONENTS), target)


def stream_load_table(spark, sf_dir):
    target = scratch_path(spark, "stream-table")
    prepared = for_table(ev.daily_source(event_stream(spark, sf_dir)))
    for query in stream_one_minute(prepared, f"{target}/table", f"{target}/checkpoint", trigger=NOW):
        query.awaitTermination()
    return last_use(comparable_table(read_one_minute(spark, f"{target}/table").drop("date")), target)


QUERIES = {
    "parse_observations": parse_observations,
    "quarantine_reasons": quarantine_reasons,
    "clean_observations": clean_observations,
    "quality_filter_keep_null": quality_filter_keep_null,
    "quality_decoded": quality_decoded,
    "geodetic_observations": geodetic_observations,
    "baseline_tags": baseline_tags,
    "newest_files": newest_file_list,
    "select_files_by_date": files_by_date,
    "resample_60s": resample_60s,
    "resample_1h": resample_1h,
    "resample_7min_day_origin": resample_7min_day_origin,
    "resample_1d_split": resample_1d_split,
    "resample_dense": resample_dense_60s,
    "one_min_table": one_min_table,
    "preset_slices": preset_slices,
    "event_windows": event_windows,
    "demeaned_cm": demeaned_cm,
    "series_levels": series_levels,
    "component_series": component_series,
    "axis_floor": axis_floor,
    "dashboard_7min": dashboard_7min,
    "figure_catalog": figure_catalog,
    "period_status": period_status,
    "archive_status": archive_status,
    "neu_lines": neu_lines,
    "median_file": median_file,
    "median_file_days": median_file_days,
    "archive_merge": archive_merge,
    "neu_lines_split": neu_lines_split,
    "archive_roundtrip": archive_roundtrip,
    "median_file_roundtrip": median_file_roundtrip,
    "stream_resample": stream_resample,
    "load_report": load_report,
    "scan_daily_files": scan_daily_files,
    "listed_files": listed_files,
    "archive_days": archive_days,
    "bucketed_table": bucketed_table,
    "written_order": written_order,
    "table_metadata": table_metadata,
    "late_rows": late_rows,
    "stream_within_delay": stream_within_delay,
    "stream_load_table": stream_load_table,
}
