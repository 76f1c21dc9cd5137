"""The de-duplicated one-minute table."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from neudrift.operators.daily import on_dates, replace_dates, replace_files
from neudrift.schema import (
    ONE_MINUTE_COMMENT, ONE_MINUTE_KEY, ONE_MINUTE_SCHEMA, ONE_MINUTE_SOURCES,
)
from neudrift.session import read_or_empty, settle


def unique_by_key(dense: DataFrame, order=("source_file",), keys=ONE_MINUTE_KEY) -> DataFrame:
    """One row per key: that of the first source file by name, remaining ties by value.

    The limit of one row is applied in each task before the shuffle.
    """
    rest = [c for c in dense.columns if c not in (*keys, *order)]
    first = Window.partitionBy(*keys).orderBy(*order, *rest)
    return dense.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def as_one_minute(dense: DataFrame) -> DataFrame:
    """Names, types and column comments of the table; a median quality of 1.5 becomes 2."""
    def value(field):
        column = F.col(ONE_MINUTE_SOURCES[field.name])
        return F.round(column) if field.name == "q" else column

    return dense.select(*[
        value(field).cast(field.dataType).alias(field.name, metadata=field.metadata)
        for field in ONE_MINUTE_SCHEMA])


def read_one_minute(spark: SparkSession, path: str) -> DataFrame:
    dated = ONE_MINUTE_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", ")
    schema = f"{dated}, date date"
    return read_or_empty(spark, lambda p: spark.read.schema(schema).parquet(p), path, schema)


def load_dense(spark: SparkSession, dense: DataFrame, files: DataFrame, path: str) -> None:
    """Bring the table up to date with new readings of some source files, densified.

    A newer reading of a file takes the place of its older one; between files the first name wins, in
    whatever order they are loaded. The files' rows are kept below `path`/_files, by date, and the
    table's dates that they touch are made again.
    """
    def derive(rows, dates):
        replace_dates(as_one_minute(unique_by_key(rows.drop("date"))).withColumn("date", F.to_date("time")), dates, path)

    replace_files(dense.withColumn("date", F.to_date("time")), files, f"{path}/_files", derive)


def append_one_minute(spark: SparkSession, dense: DataFrame, path: str) -> None:
    """As `load_dense`, for rows that come without a listing: they are all rows of their files, in a
    reading that counts from now on."""
    files = dense.select("source_file").distinct().withColumns(
        {"length": F.lit(None).cast("long"), "modified": F.current_timestamp()})
    load_dense(spark, dense, files, path)


def append_new_keys(rows: DataFrame, path: str) -> None:
    """Add the rows whose key the table does not have yet; rows that are there stay.

    `rows` is in the table's form and has each key once. Only the dates of the rows are read.
    """
    spark = rows.sparkSession
    rows = settle(rows.withColumn("date", F.to_date("time")))
    known = on_dates(read_one_minute(spark, path), rows).select(*ONE_MINUTE_KEY)
    rows.join(known, list(ONE_MINUTE_KEY), "left_anti").hint("rebalance", "date").write.mode("append").partitionBy(
        "date").parquet(path)


def register_one_minute(spark: SparkSession, name: str, path: str) -> None:
    """Make the table known to the catalog, with its own and its columns' descriptions."""
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()} COMMENT '{field.metadata['comment']}'"
        for field in ONE_MINUTE_SCHEMA)
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} ({columns}, date DATE) USING parquet
        PARTITIONED BY (date) LOCATION '{path}' COMMENT '{ONE_MINUTE_COMMENT}'""")
    spark.catalog.recoverPartitions(name)


def create_bucketed(spark: SparkSession, name: str, path: str, buckets: int) -> None:
    """A one-minute table in the catalog whose files are dealt by the hash of the key, so that it is compared with
    new rows where it lies; all three columns, since few baselines would make few buckets."""
    columns = ", ".join(
        f"{field.name} {field.dataType.simpleString()} COMMENT '{field.metadata['comment']}'"
        for field in ONE_MINUTE_SCHEMA)
    key = ", ".join(ONE_MINUTE_KEY)
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key})
        INTO {buckets} BUCKETS LOCATION '{path}' COMMENT '{ONE_MINUTE_COMMENT}'""")


def new_to_bucketed(rows: DataFrame, name: str) -> DataFrame:
    """The rows, each key once, whose key a table of `create_bucketed` does not have. Only `rows` is shuffled."""
    known = rows.sparkSession.table(name).select(*ONE_MINUTE_KEY)
    return rows.join(known.hint("merge"), list(ONE_MINUTE_KEY), "left_anti")


def append_bucketed(rows: DataFrame, name: str, buckets: int) -> None:
    """Add rows with new keys to a table of `create_bucketed`; rows that are there stay."""
    fresh = new_to_bucketed(rows, name).select(*[field.name for field in ONE_MINUTE_SCHEMA])
    fresh.repartition(buckets, *ONE_MINUTE_KEY).write.insertInto(name)


def table_columns(spark: SparkSession, name: str) -> DataFrame:
    """A registered table as the catalog describes it: position, column, type, comment and whether it is a
    partition column."""
    rows = [(at, c.name, c.dataType, c.description, c.isPartition) for at, c in enumerate(spark.catalog.listColumns(name))]
    return spark.createDataFrame(rows, "position int, column string, type string, comment string, partition boolean")


def append_jdbc(rows: DataFrame, url: str, table: str, **options) -> None:
    """Append table rows to a database that enforces the key itself."""
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
