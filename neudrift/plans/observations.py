"""The job that keeps parsed observations as a table, with a report of what it read, left out and wrote."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.operators.clean import clean_counted
from neudrift.sources.files import scan_daily
from neudrift.sources.lines import Reading, counted, usable

REPORT = "position int, measure string, rows long"


def store_lines(lines: DataFrame, path: str, reading: Reading = Reading()) -> DataFrame:
    """Parse and clean lines and write them by date; the report: lines read, usable and set aside by reason, rows
    incomplete and of excluded quality, and rows written.

    One pass: the counts are gathered by the tasks that write.
    """
    spark = lines.sparkSession
    parsed, of_lines = counted(reading.parse(lines))
    rows, of_rows = clean_counted(usable(parsed), reading.codes, reading.columns())
    rows.withColumn("date", F.to_date("time")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    report = list((of_lines.get | of_rows.get).items())
    return spark.createDataFrame([(at, name, n) for at, (name, n) in enumerate(report)], REPORT)


def store_observations(spark: SparkSession, root: str, path: str, start=None, end=None,
                       reading: Reading = Reading()) -> DataFrame:
    """`store_lines` for the daily files of a span."""
    return store_lines(scan_daily(spark, root, start, end, skip_unreadable=reading.skip_unreadable), path, reading)
