"""Incremental loading of the one-minute table."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from neudrift.operators.resample import resample_dense
from neudrift.operators.table import append_new_keys, as_one_minute, unique_by_key
from neudrift.plans.table_load import load_one_minute
from neudrift.schema import DEFAULT_WIDTH, ONE_MINUTE_KEY, ONE_MINUTE_SCHEMA
from neudrift.session import settling
from neudrift.streaming.refresh import event_time, ticking

# How late a minute may come: the days of the files that a load looks at.
DELAY = "4 days"


def dense_minutes(prepared: DataFrame, target: str, checkpoint: str, width=DEFAULT_WIDTH, trigger=None) -> StreamingQuery:
    """Start a query that fills the gaps of every source file and writes its minutes to `target`.

    `prepared` has the columns of `for_table`. A file is read within one micro-batch, so its span
    is known whole. Of the files of one micro-batch the first name wins.
    """
    spark = prepared.sparkSession

    def densify(batch: DataFrame, batch_id: int) -> None:
        with settling(spark):
            batch.persist()
            rows = as_one_minute(unique_by_key(resample_dense(batch, width)))
            rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
            batch.unpersist()

    return _start(prepared.writeStream.option("checkpointLocation", checkpoint).foreachBatch(densify), trigger)


def unique_minutes(minutes: DataFrame, table: str, checkpoint: str, delay=DELAY, trigger=None) -> StreamingQuery:
    """Start a query that adds a stream of minutes to the table, each key once.

    Keys are remembered as state until the watermark has passed them by `delay`; what is left is compared with the
    table, on the dates of the micro-batch only. So the first row to arrive stays, over restarts too, and a
    repeated micro-batch adds nothing. Minutes more than `delay` older than the latest one are left out.
    """
    spark = minutes.sparkSession
    once = minutes.withColumn("_moment", event_time(F.col("time"))).withWatermark("_moment", delay)
    once = once.dropDuplicatesWithinWatermark(list(ONE_MINUTE_KEY)).drop("_moment")

    def load(batch: DataFrame, batch_id: int) -> None:
        with settling(spark):
            append_new_keys(batch, table)

    return _start(once.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load), trigger)


def stream_one_minute(prepared: DataFrame, table: str, checkpoint: str, width=DEFAULT_WIDTH, delay=DELAY,
                      trigger=None) -> list[StreamingQuery]:
    """Start both queries: source files to dense minutes, and those to the table.

    The minutes between them are below `checkpoint`; Spark deletes them once they are loaded. With a trigger that
    ends, the first has ended when the second starts. A stream reads a path once; files that
    grow are for `follow_one_minute`.
    """
    spark, between = prepared.sparkSession, f"{checkpoint}/minutes"
    dense = dense_minutes(prepared, between, f"{checkpoint}/dense", width, trigger)
    if trigger and "availableNow" in trigger:
        dense.awaitTermination()
    minutes = spark.readStream.schema(ONE_MINUTE_SCHEMA).option("cleanSource", "delete").parquet(f"{between}/batch=*")
    return [dense, unique_minutes(minutes, table, f"{checkpoint}/load", delay, trigger)]


def _start(writer, trigger) -> StreamingQuery:
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def follow_one_minute(spark: SparkSession, root: str, table: str, checkpoint: str, trigger=None,
                      **options) -> StreamingQuery:
    """Start a query that calls `load_one_minute` at every trigger, so that files may grow."""
    return ticking(spark, lambda: load_one_minute(spark, root, table, **options), checkpoint, trigger)
