"""Exact medians per key, for any distribution of rows over keys."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window, functions as F

from neudrift.session import join_small, settle

# A key with more values (rows times columns) than this is not gathered in one task, where a value
# takes some 25 bytes. A minute at 100 observations per second, or a day at one per second, stays
# below it for the columns of a plot.
HOT_VALUES = 1_000_000
# Items of a hot column's quantile sketch, whose ranks are then off by less than half a percent of the
# column's values nearly always, and how far below and above the middle the values are looked at.
SKETCH_SIZE = 1024
REACH = 0.01


def hot_keys(rows: DataFrame, keys, columns, hot_values=HOT_VALUES,
             at_most: int | None = None) -> DataFrame | None:
    """Keys with more than `hot_values` values in `columns`, or None when there are none.

    With a proven bound on the rows of a key, `at_most`, that lies within the limit, nothing is counted.
    Else there is one narrow pass, run at once: only the key columns are read and counts are combined
    before the shuffle.
    """
    limit = hot_values // len(columns)
    if at_most is not None and at_most <= limit:
        return None
    crowded = rows.groupBy(*keys).count().where(F.col("count") > limit).drop("count")
    crowded = settle(crowded)
    return None if crowded.isEmpty() else crowded


def medians(rows: DataFrame, keys, columns, hot: DataFrame | None = None) -> DataFrame:
    """One row per key with the interpolating median of every column, nulls skipped.

    `hot` lists the keys that must not be gathered in one place (see `hot_keys`); it may hold keys
    that are absent from `rows` or not that large.
    """
    if hot is None:
        return _plain(rows, keys, columns)
    size = hot.count()
    cold = join_small(rows, hot, keys, "left_anti", at_most=size)
    crowded = join_small(rows, hot, keys, "left_semi", at_most=size)
    return _plain(cold, keys, columns).unionByName(_bracketed(crowded, keys, columns))


def _plain(rows, keys, columns):
    """Medians of keys within the limit: their sorted values' middle, or the mean of the middle two.

    Several times faster and smaller than the built-in `median`, which counts every value in a map
    of boxed objects. Lists leave nulls out; an empty list has no middle and gives null.

    A median keeps the sign of zero, as text shows it: -0.0 comes before 0.0. Sorting leaves the two in
    any order, so a zero in the middle gets the sign of its rank. (Both zeros as literals would be
    one to the optimizer.)
    """
    gathered = rows.groupBy(*keys).agg(*[F.collect_list(F.col(c).cast("double")).alias(c) for c in columns])
    ordered = gathered.select(*keys, *[F.sort_array(c).alias(c) for c in columns])

    def at(c, rank):
        below = f"size(filter({c}, x -> x < 0 OR (x = 0 AND cast(x AS STRING) = '-0.0')))"
        zero = f"abs(get({c}, {rank}))"
        return f"CASE WHEN get({c}, {rank}) = 0 THEN IF({rank} < {below}, -{zero}, {zero}) ELSE get({c}, {rank}) END"

    return ordered.select(*keys, *[
        F.expr(f"({at(c, f'((size({c}) - 1) div 2)')}) * 0.5D + ({at(c, f'(size({c}) div 2)')}) * 0.5D").alias(c)
        for c in columns])


def value_counts(rows: DataFrame, keys, columns) -> DataFrame:
    """(keys, name, value, minus_zero, n): how often each value of each column occurs, missing ones included."""
    return (
        rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
        .select(*keys, F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])).alias("_v"))
        .select(*keys, "_v.name", "_v.value",
                F.coalesce((F.col("_v.value") == 0) & (F.col("_v.value").cast("string") == "-0.0"), F.lit(False))
                .alias("minus_zero"))
        .groupBy(*keys, "name", "value", "minus_zero").agg(F.count(F.lit(1)).alias("n"))
    )


def _ranked(rows, keys, columns):
    return medians_of_counts(value_counts(rows, keys, columns), keys, columns)


def _bracketed(rows, keys, columns):
    """Medians of hot keys in two passes. Mergeable sketches (KLL) of every column give two values that enclose the
    middle ranks; then the values below and above are counted in each task, and only those between are shuffled
    and ranked. Sketches may err: a key of which a middle rank lies outside is ranked among all its values."""
    def quantiles(c):
        ends = F.kll_sketch_get_quantile_double(c, F.array(F.lit(0.5 - REACH), F.lit(0.5 + REACH)))
        return F.when(F.kll_sketch_get_n_double(c) > 0, ends).alias(f"_{c}")

    rows = rows.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    sketches = rows.groupBy(*keys).agg(*[F.kll_sketch_agg_double(c, F.lit(SKETCH_SIZE)).alias(c) for c in columns])
    bounds = settle(sketches.select(*keys, *[quantiles(c) for c in columns]))
    counted = settle(_counts_around(join_small(rows, bounds, keys), keys, columns))

    series = [*keys, "name"]
    places = counted.groupBy(*series).agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("part") < 0, F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("part") == 0, F.col("n")).otherwise(0)).alias("inside"))
    low, high = F.expr("(total - 1) div 2"), F.expr("total div 2")
    fits = (low >= F.col("below")) & (high < F.col("below") + F.col("inside"))
    places = settle(places.select("*", low.alias("low"), high.alias("high"), fits.alias("fits")))
    missed = settle(places.where("NOT fits").select(*keys).distinct())

    between = counted.where("part = 0").drop("part")
    found = medians_of_counts(between, keys, columns, places.drop("inside", "fits"))
    found = bounds.select(*keys).join(found, keys, "left")
    if missed.isEmpty():
        return found
    size = missed.count()
    return join_small(found, missed, keys, "left_anti", at_most=size).unionByName(
        _ranked(join_small(rows, missed, keys, "left_semi", at_most=size), keys, columns))


def _counts_around(marked, keys, columns):
    """(keys, name, part, value, minus_zero, n): how often each value between a column's bounds occurs (part 0), and how
    many values lie below (-1) and above (1) them."""
    def entry(c):
        value, (low, high) = F.col(c), (F.get(f"_{c}", F.lit(k)) for k in (0, 1))
        part = F.when(value < low, -1).when(value > high, 1).otherwise(0)
        return F.struct(F.lit(c).alias("name"), value.alias("value"), part.alias("part"))

    values = marked.select(*keys, F.inline(F.array(*[entry(c) for c in columns]))).where("value IS NOT NULL")
    inside = F.col("part") == 0
    return values.select(
        *keys, "name", "part", F.when(inside, F.col("value")).alias("value"),
        (inside & (F.col("value") == 0) & (F.col("value").cast("string") == "-0.0")).alias("minus_zero"),
    ).groupBy(*keys, "name", "part", "value", "minus_zero").agg(F.count(F.lit(1)).alias("n"))


def medians_of_counts(counted: DataFrame, keys, columns, places: DataFrame | None = None) -> DataFrame:
    """Medians by rank, from `value_counts`: the counted values are range-partitioned by (key, column, value), and
    only the ranges that hold the middle ranks are looked into.

    `places` (keys, name, total, below, low, high) gives the number of values of each column, of those below all
    that are in `counted`, and the two middle ranks; without it `counted` holds all values.
    """
    order = ["value", F.desc("minus_zero")]
    # Kept as a table: the range number of a value must not change between the two uses below.
    ranged = settle(
        counted.repartitionByRange(*keys, "name", *order)
        .withColumn("range", F.spark_partition_id()))
    known = ranged.where(F.col("value").isNotNull())
    series = [*keys, "name"]
    totals = known.groupBy(*series, "range").agg(F.sum("n").alias("n"))
    along = Window.partitionBy(*series).orderBy("range")
    before = F.sum("n").over(along) - F.col("n")
    if places is None:
        whole = Window.partitionBy(*series)
        placed = totals.withColumn("before", before).withColumn("total", F.sum("n").over(whole)).withColumns(
            {"low": F.expr("(total - 1) div 2"), "high": F.expr("total div 2")})
    else:
        placed = totals.withColumn("before", before).join(places, series).withColumn(
            "before", F.col("before") + F.col("below"))
    middle = (
        placed.where((F.col("before") <= F.col("high")) & (F.col("before") + F.col("n") > F.col("low")))
        .select(*series, "range", "before", "low", "high")
    )
    # At most two of a series' ranges hold its two middle ranks.
    inside = Window.partitionBy(*series, "range").orderBy(*order)
    signed = F.when(F.col("minus_zero"), -F.abs("value")).otherwise(F.col("value"))

    def at(rank):
        here = (F.col("upto") - F.col("n") <= F.col(rank)) & (F.col("upto") > F.col(rank))
        return F.max(F.when(here, signed))

    found = (
        join_small(known, middle, [*series, "range"])
        .withColumn("upto", F.col("before") + F.sum("n").over(inside))
        .where((F.col("upto") - F.col("n") <= F.col("high")) & (F.col("upto") > F.col("low")))
        .groupBy(*series)
        .agg((at("low") * 0.5 + at("high") * 0.5).alias("median"))
    )
    wide = found.groupBy(*keys).agg(*[
        F.max(F.when(F.col("name") == c, F.col("median"))).alias(c) for c in columns])
    # A key whose values are all missing still gets its row of nulls.
    return ranged.select(*keys).distinct().join(wide, keys, "left")


def drop_empty(df: DataFrame, columns) -> DataFrame:
    return df.where(~reduce(or_, [F.col(c).isNull() for c in columns]))
