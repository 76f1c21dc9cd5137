"""The table load job: newest files of every baseline into the one-minute table."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.operators.clean import for_table
from neudrift.operators.medians import HOT_VALUES
from neudrift.operators.resample import resample_dense
from neudrift.operators.table import load_dense
from neudrift.operators.daily import changed_files
from neudrift.schema import DEFAULT_WIDTH, NEWEST_FILES, ONE_MINUTE_METRICS
from neudrift.session import kept, settle, settling
from neudrift.sources.files import (
    SHORTEST_DATED, STRICT_BASELINE, list_all, newest_files, skipped_files,
)
from neudrift.sources.lines import Reading, usable
from neudrift.streaming.refresh import as_sources, read_changed, relative_names


def densified(lines: DataFrame, width=DEFAULT_WIDTH, at_most: int | None = None,
              reading: Reading = Reading()) -> DataFrame:
    """Gap-filled medians per file; `at_most` is a proven bound on the lines of a file.

    Within the limit of hot buckets nothing is counted or set aside. Else the text is parsed once, and the
    parsed rows are read three times.
    """
    rows = for_table(usable(reading.parse(lines)), reading.codes)
    if at_most is None or at_most > HOT_VALUES // len(ONE_MINUTE_METRICS):
        rows, at_most = settle(rows), None
    return resample_dense(rows, width, at_most=at_most)


def listed(spark: SparkSession, root: str) -> DataFrame:
    """All files of the baselines below `root`, empty ones included."""
    return list_all(spark, root).where(F.col("directory").rlike(STRICT_BASELINE))


def selected_files(spark: SparkSession, root: str, keep=NEWEST_FILES) -> DataFrame:
    """The `keep` newest files of each baseline by name, less the empty ones among them."""
    return newest_files(listed(spark, root), keep)


def load_one_minute(spark: SparkSession, root: str, path: str, keep=NEWEST_FILES,
                    reading: Reading = Reading()) -> DataFrame:
    """Load the newest files, as far as they have changed since the last load, and return what was left
    out, per baseline; `keep=None` takes all."""
    with settling(spark):
        files = settle(listed(spark, root))
        sources = as_sources(relative_names(newest_files(files, keep)))
        sources, lines = read_changed(
            spark, root, changed_files(sources, f"{path}/_files"), reading.skip_unreadable)
        if lines is not None:
            longest = sources.agg(F.max("length")).first()[0] // SHORTEST_DATED
            load_dense(spark, densified(lines, at_most=longest, reading=reading), sources, path)
        return kept(skipped_files(files, keep))
