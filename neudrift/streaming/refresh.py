"""What the refreshing jobs share: changed files, and a query that calls a step at every trigger."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from neudrift.session import settle
from neudrift.sources.files import scan_files


EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def event_time(time: Column) -> Column:
    """A time without zone as the moment it is in UTC, since watermarks need moments."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH), time))


def without_zone(moment: Column) -> Column:
    """The inverse of `event_time`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), F.expr(EPOCH))


def relative_name(path: Column) -> Column:
    """<directory>/<name> of a path, the same however the path is spelled."""
    return F.concat_ws("/", F.slice(F.split(path, "/"), -2, 2))


def relative_names(listing: DataFrame) -> DataFrame:
    """A listing whose `path` is <directory>/<name>; `full` has the whole path."""
    return listing.withColumn("full", F.col("path")).withColumn("path", relative_name(F.col("path")))


def as_sources(listing: DataFrame) -> DataFrame:
    """What tells a reading of a listed file from others."""
    return listing.select(F.col("path").alias("source_file"), "length", "modified")


def read_changed(spark: SparkSession, root: str, sources: DataFrame, skip_unreadable=False) -> tuple[DataFrame, DataFrame | None]:
    """The sources, settled, and the lines of their files; None when nothing has changed."""
    sources = settle(sources)
    if sources.isEmpty():
        return sources, None
    paths = sources.select(F.concat(F.lit(root.rstrip("/") + "/"), "source_file").alias("path"))
    lines = scan_files(spark, paths, skip_unreadable)
    return sources, lines.withColumn("source_file", relative_name(F.col("source_file")))


def ticking(spark: SparkSession, step, checkpoint: str, trigger=None) -> StreamingQuery:
    """Start a query without rows of interest that calls `step` at every trigger.

    A step that failed is called again with the next batch; it has to leave the same result when repeated.
    """
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).option("numPartitions", 1).load()
    writer = clock.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, batch_id: step() and None)
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()
