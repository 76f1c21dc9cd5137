"""Daily text archive: lines, periods, freeze rule and keep-first merge."""

import os
import uuid
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from neudrift.functions.buckets import at_midnight, clock_text, day_text
from neudrift.functions.fixed3 import with_fixed3
from neudrift.schema import ARCHIVE_COLUMNS, ARCHIVE_HEADER, FREEZE_BYTES
from neudrift.session import join_small, settle
from neudrift.sources.files import archive_sizes, archive_text, scan_archive

PARTITION = ("baseline", "date")
ROW_KEY = (*PARTITION, "time")


def archive_rows(resampled: DataFrame) -> DataFrame:
    """Resampled medians as archive rows: baseline, date (yyyymmdd), time, six columns."""
    return resampled.select(
        F.concat_ws("-", "rover", "base").alias("baseline"),
        day_text(F.col("time")).alias("date"), "time", *ARCHIVE_COLUMNS)


def period_days(start, end) -> Column:
    """Days after `start` up to and including `end`."""
    first, last = (F.lit(str(x)).cast("date") for x in (start, end))
    after = F.date_add(first, 1)
    return F.when(after <= last, F.sequence(after, last)).otherwise(F.array().cast("array<date>"))


def period_calendar(rows: DataFrame, start, end, baselines: DataFrame | None = None) -> DataFrame:
    """Every baseline with every day of the run, the day's row count and whether the day lies
    within the baseline's data.

    Outside its data a day has nothing to write; an empty day inside yields a header only.
    `baselines` adds those without any row.
    """
    days = rows.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("rows_new"))
    spans = days.groupBy("baseline").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    if baselines is not None:
        spans = baselines.select("baseline").distinct().join(spans, "baseline", "left")
    calendar = spans.select(
        "baseline", "_first", "_last", F.explode(period_days(start, end)).alias("_day")
    ).select(
        "baseline", day_text(F.col("_day")).alias("date"), "_first", "_last")
    return calendar.join(days, list(PARTITION), "left").select(
        *PARTITION,
        F.coalesce(F.col("date").between(F.col("_first"), F.col("_last")), F.lit(False)).alias("covered"),
        F.coalesce("rows_new", F.lit(0)).alias("rows_new"))


def period_status(calendar: DataFrame) -> DataFrame:
    return calendar.withColumn(
        "status",
        F.when(~F.col("covered"), "no data").when(F.col("rows_new") == 0, "header only")
        .otherwise("written"))


def archive_states(calendar: DataFrame, sizes: DataFrame, freeze_bytes=FREEZE_BYTES) -> DataFrame:
    """What the run does to each partition.

    An absent one is created; one below `freeze_bytes` grows; a larger one stays as it is, complete
    or not. `freeze_bytes=None` lets every partition grow.
    """
    frozen = F.lit(False) if freeze_bytes is None else F.col("bytes") >= freeze_bytes
    return calendar.join(sizes, list(PARTITION), "left").withColumn(
        "state",
        F.when(F.col("bytes").isNull() & ~F.col("covered"), "no_data")
        .when(F.col("bytes").isNull(), "created")
        .when(frozen, "frozen")
        .when(~F.col("covered"), "no_new_data")
        .otherwise("grown"))


def merge_keep_first(existing: DataFrame, new: DataFrame, keys=ROW_KEY) -> DataFrame:
    """Existing rows and the new rows whose key is not among them."""
    return existing.unionByName(new.join(existing.select(*keys), list(keys), "left_anti"))


def archive_update(rows: DataFrame, existing: DataFrame, states: DataFrame) -> DataFrame:
    """Rows of the partitions that are created or grow, as they are after the run."""
    def of(frame, *wanted):
        chosen = states.where(F.col("state").isin(*wanted)).select(*PARTITION)
        return frame.join(chosen, list(PARTITION), "left_semi")

    return merge_keep_first(of(existing, "grown"), of(rows, "created", "grown"))


def time_text(time: Column, date_only: Column) -> Column:
    return F.when(date_only, time.cast("date").cast("string")).otherwise(clock_text(time))


def _line(stamp: Column) -> Column:
    return F.concat_ws("\t", stamp, *ARCHIVE_COLUMNS).alias("line")


def daily_lines(rows: DataFrame) -> DataFrame:
    """Archive rows as text: baseline, date, time, line.

    A file whose every row is at midnight shows dates only. Times are unique within a day, so that
    is a file of one row; the window is over one day of one baseline.
    """
    day = Window.partitionBy(*PARTITION)
    marked = rows.withColumn("_dates", F.min(at_midnight(F.col("time")).cast("int")).over(day) == 1)
    return with_fixed3(marked, ARCHIVE_COLUMNS).select(
        *PARTITION, "time", _line(time_text(F.col("time"), F.col("_dates"))))


def with_headers(lines: DataFrame, partitions: DataFrame, by=PARTITION) -> DataFrame:
    """Add the header line, with a null time, for each of `partitions`."""
    header = partitions.select(
        *by, F.lit(None).cast("timestamp_ntz").alias("time"), F.lit(ARCHIVE_HEADER).alias("line"))
    return lines.unionByName(header)


def partition_bytes(lines: DataFrame, by=PARTITION) -> DataFrame:
    """Size in bytes of each file made of `lines`, header included."""
    return lines.groupBy(*by).agg(
        (F.sum(F.octet_length("line") + 1) + len(ARCHIVE_HEADER.encode()) + 1).alias("bytes"))


def write_daily(lines: DataFrame, root: str) -> None:
    """One text file per baseline and day, lines in time order; other partitions are untouched."""
    (
        lines.repartition(*PARTITION)
        .sortWithinPartitions(*PARTITION, F.col("time").asc_nulls_first())
        .select(*PARTITION, "line")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION).text(root)
    )


def write_archive(spark: SparkSession, rows: DataFrame, root: str, start, end,
                  freeze_bytes=None, baselines: DataFrame | None = None) -> DataFrame:
    """Bring the archive below `root` up to date and return the status of every partition.

    The medians and the states are fixed before anything is written. Only partitions that grow are
    read back, and those rows are set aside first because their files are about to be replaced.
    """
    rows = settle(rows)
    calendar = period_calendar(rows, start, end, baselines)
    states = settle(archive_states(calendar, archive_sizes(spark, root), freeze_bytes))
    growing = states.where("state = 'grown'").select(*PARTITION)
    existing = settle(scan_archive(spark, root, growing))
    update = archive_update(rows, existing, states)
    changed = states.where("state IN ('created', 'grown')").select(*PARTITION)
    write_daily(with_headers(daily_lines(update), changed), root)
    return load_status(states, existing, archive_sizes(spark, root))


def export_daily(spark: SparkSession, root: str, folder: str, partitions: DataFrame | None = None) -> None:
    """Copy the archive below `root`, or some partitions of it, to files named <baseline>-distance-<yyyymmdd>.neu.

    `folder` must be mounted on every executor.
    """
    named = archive_text(spark, root, partitions).select(
        F.concat("baseline", F.lit("-distance-"), "date", F.lit(".neu")).alias("name"), "line")
    _export(named, folder)


def _export(named: DataFrame, folder: str) -> None:
    """One file per name, the header first and lines in time order.

    Each file is written under another name first, so that neither a reader nor a repeated task
    meets half a file.
    """
    def write(rows):
        for name, group in groupby(rows, key=lambda row: row.name):
            draft = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
            with open(draft, "w") as file:
                file.writelines(f"{row.line}\n" for row in group)
            os.replace(draft, os.path.join(folder, name))

    os.makedirs(folder, exist_ok=True)
    (
        named.repartition("name")
        .sortWithinPartitions("name", ~F.col("line").startswith("#"), "line")
        .foreachPartition(write)
    )


def load_status(states: DataFrame, existing: DataFrame, sizes_after: DataFrame) -> DataFrame:
    """Per partition: state, rows before (of grown ones), new rows offered, bytes before and after."""
    old = existing.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("rows_old"))
    after = sizes_after.withColumnRenamed("bytes", "bytes_after")
    return (
        states.withColumnRenamed("bytes", "bytes_before")
        .join(old, list(PARTITION), "left").join(after, list(PARTITION), "left")
        .select(*PARTITION, "state", "rows_new", "rows_old", "bytes_before", "bytes_after")
    )


def median_lines(rows: DataFrame) -> DataFrame:
    """The whole span of each baseline as text: baseline, time, line.

    Dates only where every row of the baseline is at midnight.
    """
    dates = rows.groupBy("baseline").agg(F.min(at_midnight(F.col("time")).cast("int")).alias("_dates"))
    marked = join_small(rows, dates, "baseline")
    return with_fixed3(marked, ARCHIVE_COLUMNS).select(
        "baseline", "time", _line(time_text(F.col("time"), F.col("_dates") == 1)))


def write_median_files(rows: DataFrame, root: str) -> None:
    """The whole span of each baseline below baseline=<name>, in time order over its part files.

    The split is by ranges of (baseline, time), so a long series becomes several parts whose names
    sort in time order; the header is the first line of the first part. The rows are read several
    times, so they should be settled.
    """
    lines = median_lines(rows)
    lines = with_headers(lines, lines.select("baseline").distinct(), ("baseline",))
    (
        lines.repartitionByRange("baseline", F.col("time").asc_nulls_first())
        .sortWithinPartitions("baseline", F.col("time").asc_nulls_first())
        .select("baseline", "line")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("baseline").text(root)
    )


def export_median_files(spark: SparkSession, root: str, folder: str) -> None:
    """Copy the whole spans below `root` to files named <baseline>-distance.neu.

    `folder` must be mounted on every executor. The part files of a baseline sort in time order.
    """
    schema = "line string, baseline string"
    lines = spark.read.schema(schema).text(root)
    named = lines.select(F.concat("baseline", F.lit("-distance.neu")).alias("name"), "line")
    _export(named, folder)
