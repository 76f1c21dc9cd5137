"""Observation files, their listing and selection, and the text archive."""

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from neudrift.functions.buckets import day_text
from neudrift.schema import ARCHIVE_COLUMNS, BASELINE_LAYOUT, NEWEST_FILES
from neudrift.session import pruned_by, read_or_empty

# Directory names that count as baselines: the strict form is searched anywhere in the name.
STRICT_BASELINE = r"([A-Z0-9]{4})-([A-Z0-9]{4})"
LOOSE_BASELINE = r"^\S+-\S+"
# <baseline>/<baseline><yyyymmdd>0000b.pos; the part after the baseline has a fixed length.
_TAIL = len("yyyymmdd0000b.pos")

# Bytes of the shortest line that has a time, and of the shortest one that has all values too, line
# ends included. A file holds no more rows than its bytes allow.
SHORTEST_DATED = len("2024/03/01 00:00:00.0\n")
SHORTEST_COMPLETE = SHORTEST_DATED + 2 * len(BASELINE_LAYOUT)

_LISTING = "path string, name string, directory string, length long, modified timestamp"


def directories(root: str, baselines=None) -> str:
    """Pattern of the baselines' directories right below `root`; of all that may be one when None."""
    return f"{root.rstrip('/')}/{'*-*' if baselines is None else _either(sorted(set(baselines)))}"


def _either(names) -> str:
    return "{" + ",".join(names) + "}"


def list_below(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """One row per non-empty file at any depth below `root`; names, lengths and times only, no content."""
    return _listing(spark.read.format("binaryFile").option("recursiveFileLookup", True)
                    .option("pathGlobFilter", pattern).load(root))


def list_files(spark: SparkSession, root: str, pattern="*.pos", baselines=None) -> DataFrame:
    """One row per non-empty file in the baselines' directories right below `root`.

    Spark leaves empty files out of every scan; `list_all` has them.
    """
    def read(path):
        return _listing(spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path))

    return read_or_empty(spark, read, directories(root, baselines), _LISTING)


def list_all(spark: SparkSession, root: str, pattern="*", baselines=None) -> DataFrame:
    """As `list_files`, and empty files with length 0, on any file system.

    All names come from the file index that Spark makes at the driver for any scan; lengths and
    times come from the listing.
    """
    def read(path):
        return spark.read.option("pathGlobFilter", pattern).text(path)

    index = read_or_empty(spark, read, directories(root, baselines), "value string")
    names = [tuple(unquote(path).rsplit("/", 2)[1:]) for path in index.inputFiles()]
    known = spark.createDataFrame(names, "directory string, name string")
    return known.join(list_files(spark, root, pattern, baselines), ["directory", "name"], "left").select(
        "path", "name", "directory", F.coalesce("length", F.lit(0).cast("long")).alias("length"), "modified")


def _listing(files: DataFrame) -> DataFrame:
    parts = F.split("path", "/")
    return files.select(
        "path", F.element_at(parts, -1).alias("name"), F.element_at(parts, -2).alias("directory"),
        "length", F.col("modificationTime").alias("modified"))


def baseline_parts(directory: Column):
    """(rover, base) of a directory name, from the strict form."""
    return (F.regexp_extract(directory, STRICT_BASELINE, 1),
            F.regexp_extract(directory, STRICT_BASELINE, 2))


def rover_of(baseline: Column) -> Column:
    return F.substring(baseline, 1, 4)


def base_of(baseline: Column) -> Column:
    return F.substring(baseline, 6, 4)


def discover_baselines(listing: DataFrame, strict=True) -> DataFrame:
    """Distinct baselines of a listing (needs a `directory` column)."""
    found = listing.select(F.col("directory").alias("baseline")).distinct()
    if not strict:
        return found.where(F.col("baseline").rlike(LOOSE_BASELINE)).select(
            "baseline", rover_of(F.col("baseline")).alias("rover"),
            base_of(F.col("baseline")).alias("base"))
    rover, base = baseline_parts(F.col("baseline"))
    return found.where(F.col("baseline").rlike(STRICT_BASELINE)).select(
        "baseline", rover.alias("rover"), base.alias("base"))


def file_date(name: Column) -> Column:
    """Day of a daily file name (null when there is none)."""
    return F.try_to_timestamp(
        F.regexp_extract(name, r"([0-9]{8})0000b[.]pos$", 1), F.lit("yyyyMMdd")).cast("date")


def select_file_dates(listing: DataFrame, start, end, day="day") -> DataFrame:
    """Files of every day from the one of `start` to the one of `end`, both included."""
    return listing.where(F.col(day).between(_day(start), _day(end)))


def newest_files(listing: DataFrame, keep=NEWEST_FILES, group="directory") -> DataFrame:
    """Per baseline the `keep` last files by name that start with the baseline's name; empty ones
    are dropped afterwards, so fewer may remain. `keep=None` takes all."""
    own = listing.where(F.col("name").startswith(F.col(group)))
    if keep is not None:
        own = _ranked(own, group).where(F.col("_rank") <= keep).drop("_rank")
    return own.where("length > 0")


def skipped_files(listing: DataFrame, keep=NEWEST_FILES, group="directory") -> DataFrame:
    """The other non-empty files of each baseline, which `newest_files` leaves out: how many, how
    many bytes, and the last name."""
    own = listing.where(F.col("name").startswith(F.col(group)))
    older = own.where("false") if keep is None else _ranked(own, group).where(F.col("_rank") > keep)
    return older.where("length > 0").groupBy(group).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.max("name").alias("last"))


def _ranked(listing, group):
    return listing.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("name"))))


def most_rows(spark: SparkSession, root: str, start=None, end=None, baselines=None) -> int:
    """A bound on the complete rows that any baseline's daily files of a span can hold, from the listing."""
    files = list_files(spark, root, f"*-*{month_pattern(start, end)}0000b.pos", baselines)
    largest = files.groupBy("directory").agg(F.sum("length").alias("bytes")).agg(F.max("bytes")).first()[0]
    return (largest or 0) // SHORTEST_COMPLETE


def _day(moment) -> Column:
    return moment if isinstance(moment, Column) else F.lit(str(moment)).cast("date")


def _text(spark, paths, **options):
    reader = spark.read.option("ignoreMissingFiles", True)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.text(paths)


def month_pattern(start, end) -> str:
    """File pattern for the months of the days from `start` to `end`, as yyyymm with any day."""
    if start is None or end is None:
        return "[0-9]" * 8
    first, last = (x.year * 12 + x.month - 1 for x in (start, end))
    months = [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]
    return (_either(months) if months else "none") + "[0-9][0-9]"


def scan_daily(spark: SparkSession, root: str, start=None, end=None, baselines=None,
               skip_unreadable=False) -> DataFrame:
    """Lines of the daily files of a span, tagged with baseline, rover, base and source_file.

    Only the directories of the baselines, right below `root`, are listed, and the name pattern keeps
    other months out of the list. The other conditions are on file metadata, so files that fail
    them are not opened; Spark evaluates those once more on every line, so they are plain string
    functions. Missing and empty files contribute nothing; `skip_unreadable` extends that to corrupt
    ones.
    """
    def read(path):
        return _text(spark, path, ignoreCorruptFiles=skip_unreadable,
                     pathGlobFilter=f"*-*{month_pattern(start, end)}0000b.pos")

    try:
        lines = read(directories(root, baselines))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame(
            [], "value string, baseline string, rover string, base string, source_file string")
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    baseline = F.substring(name, F.lit(1), F.length(name) - _TAIL)
    lines = lines.where(path.endswith(F.concat(F.lit("/"), baseline, F.lit("/"), name)))
    stamp = F.substring(name, F.length(name) - (_TAIL - 1), F.lit(8))
    if start is not None:
        lines = lines.where(stamp >= day_text(_day(start)))
    if end is not None:
        lines = lines.where(stamp <= day_text(_day(end)))
    if baselines is None:
        lines = lines.where(baseline.rlike(LOOSE_BASELINE))
    else:
        lines = lines.where(baseline.isin(*baselines))
    return lines.select(
        "value", baseline.alias("baseline"), rover_of(name).alias("rover"),
        base_of(name).alias("base"), path.alias("source_file"))


def scan_files(spark: SparkSession, files: DataFrame, skip_unreadable=False) -> DataFrame:
    """Lines of the files of a selection such as `newest_files`.

    Only path names pass through the driver, as they do in any Spark file scan, and the selection
    holds at most a few per baseline.
    """
    paths = [row.path for row in files.select("path").toLocalIterator()]
    if not paths:
        return spark.createDataFrame(
            [], "value string, rover string, base string, source_file string")
    # A selected file's name starts with its directory's name, so both hold the same baseline.
    rover, base = baseline_parts(F.col("_metadata.file_name"))
    return _text(spark, paths, ignoreCorruptFiles=skip_unreadable).select(
        "value", rover.alias("rover"), base.alias("base"),
        F.col("_metadata.file_path").alias("source_file"))


ARCHIVE_SCHEMA = ", ".join(
    ["date_time string", *[f"{c} double" for c in ARCHIVE_COLUMNS], "baseline string", "date string"])


def _of_partitions(rows: DataFrame, partitions: DataFrame | None) -> DataFrame:
    """Rows of some archive partitions, given by any of baseline and date (yyyymmdd); of all without."""
    if partitions is None:
        return rows
    return pruned_by(rows, partitions, [c for c in ("baseline", "date") if c in partitions.columns])


def scan_archive(spark: SparkSession, root: str, partitions: DataFrame | None = None) -> DataFrame:
    """Rows of the text archive: baseline, date (yyyymmdd), time and the six archive columns. With a calendar,
    `partitions`, only its files are read."""
    def read(path):
        return spark.read.schema(ARCHIVE_SCHEMA).option("sep", "\t").option("comment", "#").csv(path)

    rows = read_or_empty(spark, read, root, ARCHIVE_SCHEMA)
    return _of_partitions(rows, partitions).select(
        "baseline", "date", F.col("date_time").try_cast("timestamp_ntz").alias("time"),
        *ARCHIVE_COLUMNS)


def archive_text(spark: SparkSession, root: str, partitions: DataFrame | None = None) -> DataFrame:
    """Lines of the text archive as they are, headers included: baseline, date, line."""
    schema = "line string, baseline string, date string"
    return _of_partitions(
        read_or_empty(spark, lambda path: spark.read.schema(schema).text(path), root, schema), partitions)


def archive_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Bytes per archive partition, from the listing alone."""
    listing = read_or_empty(
        spark, lambda path: list_below(spark, path, "*.txt"), root, _LISTING)
    sizes = listing.select(
        F.regexp_extract("path", r"/baseline=([^/]+)/", 1).alias("baseline"),
        F.regexp_extract("path", r"/date=([^/]+)/", 1).alias("date"), "length")
    return (
        sizes.groupBy("baseline", "date").agg(F.sum("length").alias("bytes"))
    )
