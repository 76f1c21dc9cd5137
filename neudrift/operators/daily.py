"""Tables by day that are brought up to date: rows of source files that may grow or be replaced.

A store has two tables, both partitioned by `date`: `rows`, and `readings`, which says for every file and date with
rows which length and time of change were read. A changed file is one that the listing has and `readings` has not.
Its new rows take the place of its old ones in the dates that had or have any; those dates are written again with
Spark's dynamic partition overwrite. `readings` is written last, so that a step that failed is repeated whole and
leaves the same result.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.session import BROADCAST_ROWS, delete, join_small, pruned_by, read_or_empty, settle

READINGS = "source_file string, length long, modified timestamp, date date"
# The date of a file without rows.
NO_DAY = "1970-01-01"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table by date, empty where nothing has been written yet."""
    return read_or_empty(spark, lambda p: spark.read.schema(schema).parquet(p), path, schema)


def on_dates(table: DataFrame, dates: DataFrame) -> DataFrame:
    """The rows of some dates; only their partitions are read."""
    return pruned_by(table, dates, "date")


def replace_dates(table: DataFrame, dates: DataFrame, path: str) -> None:
    """Write `table`, all rows of some dates, in place of the stored ones; dates without rows any more go."""
    spark = table.sparkSession
    table = settle(table)  # it may be made from the partitions that it replaces
    table.hint("rebalance", "date").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    emptied = dates.join(table.select("date").distinct(), "date", "left_anti")
    for row in emptied.select(F.col("date").cast("string").alias("date")).toLocalIterator():
        delete(spark, f"{path}/date={row.date}")


def readings(spark: SparkSession, store: str) -> DataFrame:
    return stored(spark, f"{store}/readings", READINGS)


def changed_files(files: DataFrame, store: str) -> DataFrame:
    """The files (source_file, length, modified) that the store does not hold as they are now."""
    known = readings(files.sparkSession, store).select("source_file", "length", "modified").distinct()
    return files.join(known, ["source_file", "length", "modified"], "left_anti")


def replace_files(rows: DataFrame, files: DataFrame, store: str,
                  derive: Callable[[DataFrame, DataFrame], None], whole: bool = False) -> DataFrame:
    """Take in new readings of some files and bring what is derived from them up to date; the dates touched.

    `rows` holds all rows of `files`, with `source_file` and `date`. `derive(rows, dates)` gets all stored rows of the
    touched dates, or with `whole` of all dates.
    """
    spark = rows.sparkSession
    rows, files = settle(rows), settle(files.select("source_file", "length", "modified").dropDuplicates(["source_file"]))
    names = files.select("source_file")
    held = rows.select("source_file", "date").distinct()
    before = join_small(readings(spark, store), names, "source_file", "left_semi").select("date")
    dates = settle(held.select("date").union(before).distinct().where(F.col("date") != F.lit(NO_DAY).cast("date")))
    if whole:
        dates = settle(dates.union(readings(spark, store).select("date").where(
            F.col("date") != F.lit(NO_DAY).cast("date"))).distinct())

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    old = join_small(on_dates(stored(spark, f"{store}/rows", schema), dates), names, "source_file", "left_anti")
    now = settle(old.unionByName(rows))
    replace_dates(now, dates, f"{store}/rows")
    derive(now, dates)

    none = spark.createDataFrame([(NO_DAY,)], "date string").select(F.col("date").cast("date"))
    listed = files.join(held, "source_file", "left").withColumn("date", F.coalesce("date", F.lit(NO_DAY).cast("date")))
    kept = join_small(on_dates(readings(spark, store), dates.union(none)), names, "source_file", "left_anti")
    replace_dates(kept.unionByName(listed), dates.union(none), f"{store}/readings")
    return dates


def upsert(table: DataFrame, keys: list[str], path: str) -> None:
    """Put rows into a table by date, in place of the stored rows with the same keys; keys may be null."""
    spark = table.sparkSession
    table = settle(table)
    dates = settle(table.select("date").distinct())
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    old, new = on_dates(stored(spark, path, schema), dates).alias("old"), table.select("date", *keys).distinct().alias("new")
    same = F.col("old.date") == F.col("new.date")
    for key in keys:
        same = same & F.col(f"old.{key}").eqNullSafe(F.col(f"new.{key}"))
    few = table.count() <= BROADCAST_ROWS
    kept = old.join(F.broadcast(new) if few else new, same, "left_anti")
    replace_dates(kept.unionByName(table), dates, path)
