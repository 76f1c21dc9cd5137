"""Medians kept up to date while observations arrive and files grow."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from neudrift.functions.buckets import bucket_start, divides_day, plus_seconds, width_seconds
from neudrift.operators.clean import clean
from neudrift.operators.daily import changed_files, on_dates, replace_dates, replace_files, stored, upsert
from neudrift.operators.medians import HOT_VALUES, drop_empty, medians_of_counts, value_counts
from neudrift.operators.resample import PAIR, resample_medians
from neudrift.schema import DEFAULT_WIDTH, VALUE_COLUMNS
from neudrift.session import settle, settling
from neudrift.sources.files import list_files
from neudrift.sources.lines import Reading, usable
from neudrift.streaming.refresh import as_sources, event_time, read_changed, relative_names, ticking, without_zone

# How late a row may come, after the longest range of a dashboard.
DELAY = "2 days"
BUCKET = ("base", "rover", "time")


def refresh_medians(spark: SparkSession, root: str, target: str, width=DEFAULT_WIDTH,
                    columns=VALUE_COLUMNS, hot_values=HOT_VALUES, reading: Reading = Reading()) -> list:
    """Bring `target`/medians up to date with the daily files below `root`; the days it touched.

    Files are compared with those of the last call by name, length and time of change. A changed file
    is read again whole and takes the place of its older reading; rows of a file that is gone stay. A width that
    does not divide a day is counted from the first day of a series, so all days are made again.
    """
    with settling(spark):
        sources = changed_files(as_sources(relative_names(list_files(spark, root))), target)
        sources, lines = read_changed(spark, root, sources, reading.skip_unreadable)
        if lines is None:
            return []

        def derive(rows, dates):
            medians = resample_medians(rows, width, columns, hot_values=hot_values)
            replace_dates(medians.withColumn("date", F.to_date("time")), dates, f"{target}/medians")

        rows = clean(usable(reading.parse(lines)), reading.codes, reading.columns()).withColumn("date", F.to_date("time"))
        dates = replace_files(rows.select(*PAIR, "time", *columns, "source_file", "date"), sources, target, derive,
                              whole=not divides_day(width))
        return sorted(row.date for row in dates.toLocalIterator())


def follow_medians(spark: SparkSession, root: str, target: str, checkpoint: str, trigger=None,
                   **options) -> StreamingQuery:
    """Start a query that calls `refresh_medians` at every trigger."""
    return ticking(spark, lambda: refresh_medians(spark, root, target, **options), checkpoint, trigger)


def counts_by_bucket(cleaned: DataFrame, width=DEFAULT_WIDTH, columns=VALUE_COLUMNS, delay=DELAY) -> DataFrame:
    """A stream of how often each value occurs in each bucket: (base, rover, time, name, value, minus_zero, n).

    The state is a number per bucket, column and value, so no key of it grows with the rows of a bucket. It is
    kept until the watermark, `delay` behind the latest row, has passed the end of the bucket.

    Rows are spread before they are counted, since a task holds all values that it counts: of a file that is read as
    one split these would be the values of the file.
    """
    if not divides_day(width):
        raise ValueError("a stream of medians needs a width that divides a day")
    rows = cleaned.withColumn("_moment", event_time(F.col("time"))).withWatermark("_moment", delay)
    rows = rows.select(*PAIR, "_moment", *columns).repartition(*PAIR, "_moment")
    rows = rows.withColumn("_window", F.window("_moment", f"{width_seconds(width)} seconds"))
    counted = value_counts(rows, [*PAIR, "_window"], columns)
    start = without_zone(F.col("_window.start")).alias("time")
    return counted.select(*PAIR, start, "name", "value", "minus_zero", "n")


def stream_medians(cleaned: DataFrame, target: str, checkpoint: str, width=DEFAULT_WIDTH,
                   columns=VALUE_COLUMNS, delay=DELAY, trigger=None) -> StreamingQuery:
    """Start a query that keeps `target`/medians equal to a batch resampling of the rows so far; rows that come
    later than `delay` are left out (see `stream_late_rows`).

    Each micro-batch hands on the counts that it changed (update mode). They take the place of the stored
    ones, so that a repeated micro-batch changes nothing, and the medians of the changed buckets follow by rank from
    all counts of these buckets. A target belongs to one checkpoint.
    """
    spark = cleaned.sparkSession

    def update(batch: DataFrame, batch_id: int) -> None:
        with settling(spark):
            changed = settle(batch.withColumn("date", F.to_date("time")))
            if changed.isEmpty():
                return
            upsert(changed, [*BUCKET, "name", "value", "minus_zero"], f"{target}/counts")
            schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in changed.schema)
            buckets = settle(changed.select("date", *BUCKET).distinct())
            counts = on_dates(stored(spark, f"{target}/counts", schema), buckets).join(
                buckets, ["date", *BUCKET], "left_semi")
            medians = drop_empty(medians_of_counts(counts, list(BUCKET), columns), columns)
            upsert(medians.withColumn("date", F.to_date("time")), list(BUCKET), f"{target}/medians")

    writer = counts_by_bucket(cleaned, width, columns, delay).writeStream.outputMode("update").option(
        "checkpointLocation", checkpoint).foreachBatch(update)
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def stream_late_rows(rows: DataFrame, target: str, checkpoint: str, width=DEFAULT_WIDTH, delay=DELAY,
                     trigger=None) -> StreamingQuery:
    """Start a query that sets aside in `target`/late the rows that come later than `delay`: those whose bucket ended
    that long before the latest row of the earlier micro-batches.

    `stream_medians` on the same stream leaves them out, as soon as it has noted the earlier micro-batches' times,
    which it does when it has to wait for new files; of files that follow without a pause it may still
    take late rows in. Each micro-batch writes its latest time and its late rows under its own number, so that a
    repeated one changes nothing.
    """
    spark = rows.sparkSession

    def update(batch: DataFrame, batch_id: int) -> None:
        latest = stored(spark, f"{target}/latest", "time timestamp_ntz, batch long")
        before = latest.where(F.col("batch") < batch_id).agg(F.max("time")).first()[0]
        limit = F.lit(before).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        end = plus_seconds(bucket_start(F.col("time"), width), F.lit(width_seconds(width)))
        batch.persist()
        late = batch.where(end <= limit)  # none while there is no earlier time
        for frame, name in ((late, "late"), (batch.agg(F.max("time").cast("timestamp_ntz").alias("time")), "latest")):
            frame.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{target}/{name}")
        batch.unpersist()

    writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(update)
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def read_medians(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/medians").drop("date")
