"""Observation rows from the `events` table, for the registered queries.

The table has no positions; a fixed mapping turns each event into an observation of one of six
station pairs, with some missing values and qualities so that the null rules have work to do.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.functions.buckets import day_text

OBSERVATIONS_SQL = """
SELECT event_id,
       concat('RV0', cast(user_id % 6 AS STRING)) AS rover,
       concat('BS0', cast(user_id % 2 AS STRING)) AS base,
       ts AS time,
       cast(k AS DOUBLE) / 100           AS e,
       value / 100                       AS n,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE (value - k) / 100 END AS u,
       CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_type = 'click' THEN 1 WHEN event_type = 'view' THEN 2
            WHEN event_type = 'purchase' THEN 3 WHEN event_type = 'signup' THEN 4 ELSE 5 END AS q,
       cast(4 + user_id % 12 AS INT)     AS ns,
       cast(event_id % 50 AS DOUBLE) / 10000  AS sdn,
       cast(event_id % 40 AS DOUBLE) / 10000  AS sde,
       cast(event_id % 90 AS DOUBLE) / 10000  AS sdu,
       cast(event_id % 30 AS DOUBLE) / -10000 AS sdne,
       cast(event_id % 20 AS DOUBLE) / 10000  AS sdeu,
       cast(event_id % 70 AS DOUBLE) / -10000 AS sdun,
       cast(event_id % 10 AS DOUBLE) / 10     AS age,
       1 + cast(event_id % 1000 AS DOUBLE) / 10 AS ratio
FROM (SELECT *, cast(regexp_extract(props, '[0-9]+', 0) AS INT) AS k FROM {events}) t
"""


def observations_from(events: DataFrame) -> DataFrame:
    """The same SELECT runs in Spark and as the oracle's view definition. Works on streams too."""
    rows = events.sparkSession.sql(OBSERVATIONS_SQL, events=events)
    return rows.withColumn("baseline", F.concat_ws("-", "rover", "base"))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_from(read_events(spark, sf_dir))


def daily_source(df: DataFrame) -> DataFrame:
    """Name the daily file each observation would have come from."""
    return df.withColumn("source_file", F.concat(
        "baseline", F.lit("/"), "baseline", day_text(F.col("time")),
        F.lit("0000b.pos")))


def render_lines(df: DataFrame, keep=("event_id",)) -> DataFrame:
    """Write observations as lines of the baseline layout; a missing value is a nan token."""
    def number(name):
        text = F.col(name).cast("decimal(12,4)").cast("string")
        return F.coalesce(F.lpad(text, 9, " "), F.lit("      nan"))

    def whole(name):
        return F.coalesce(F.col(name).cast("string"), F.lit("nan"))

    time = F.replace(F.col("time").cast("string"), F.lit("-"), F.lit("/"))
    millis = F.rpad(F.when(F.length(time) == 19, F.concat(time, F.lit("."))).otherwise(time), 23, "0")
    line = F.concat_ws(
        "  ", millis,
        number("e"), number("n"), number("u"), whole("q"), whole("ns"),
        *[number(c) for c in ("sdn", "sde", "sdu", "sdne", "sdeu", "sdun", "age", "ratio")])
    # As a generated column the text is made once, not again in each expression that reads it.
    return df.select(*keep, F.explode(F.array(line)).alias("value"))
