"""The daily archive job: all baselines of a folder at once."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from neudrift.operators.archive import archive_rows, write_archive, write_median_files
from neudrift.operators.clean import clean
from neudrift.operators.medians import HOT_VALUES
from neudrift.operators.resample import PAIR, resample_medians
from neudrift.schema import ARCHIVE_COLUMNS
from neudrift.session import kept, settle, settling
from neudrift.sources.files import discover_baselines, list_files, most_rows, scan_daily
from neudrift.sources.lines import Reading, quarantined, usable

SPAN = timedelta(days=5)


def archive_input(spark: SparkSession, root: str, start, end, width="1min",
                  hot_values=HOT_VALUES, reading: Reading = Reading()) -> DataFrame:
    """Archive rows of a span.

    The listing bounds the rows of a bucket. Where that proves that no bucket is hot, the text is parsed
    once and nothing is counted or set aside; else the parsed rows are set aside and read twice, to
    count bucket sizes and for the medians.
    """
    at_most = most_rows(spark, root, start, end)
    lines = scan_daily(spark, root, start, end, skip_unreadable=reading.skip_unreadable)
    observed = clean(usable(reading.parse(lines)), reading.codes)
    rows = observed.select(*PAIR, "time", *ARCHIVE_COLUMNS)
    if at_most > hot_values // len(ARCHIVE_COLUMNS):
        rows = settle(rows)
    return archive_rows(resample_medians(
        rows, width, ARCHIVE_COLUMNS, hot_values=hot_values, at_most=at_most))


def unusable_lines(spark: SparkSession, root: str, start=None, end=None,
                   reading: Reading = Reading()) -> DataFrame:
    """The lines of a span that the jobs leave out: file, line, reason."""
    return quarantined(reading.parse(scan_daily(spark, root, start, end, skip_unreadable=reading.skip_unreadable)))


def run_archive(spark: SparkSession, root: str, target: str, end, start=None, width="1min",
                freeze_bytes=None, hot_values=HOT_VALUES, reading: Reading = Reading()) -> DataFrame:
    """Write or grow the days after `start` up to `end` and return the status per partition.

    `freeze_bytes=FREEZE_BYTES` freezes files by the size that the rule of the former archive names.
    """
    start = start or end - SPAN
    with settling(spark):
        return kept(write_archive(
            spark, archive_input(spark, root, start, end, width, hot_values, reading), target, start, end,
            freeze_bytes, discover_baselines(list_files(spark, root), strict=False)))


def run_median_files(spark: SparkSession, root: str, target: str, start, end, width="1min",
                     hot_values=HOT_VALUES, reading: Reading = Reading()) -> bool:
    """Write the whole span of each baseline; False, and no file, when there is no data."""
    with settling(spark):
        rows = settle(archive_input(spark, root, start, end, width, hot_values, reading))
        if rows.isEmpty():
            return False
        write_median_files(rows, target)
        return True
