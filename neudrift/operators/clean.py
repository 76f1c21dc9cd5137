"""Row filters and column shaping between parser and resampling."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Observation, functions as F

from neudrift.functions.quality import has_quality, quality_label
from neudrift.schema import EXCLUDED_QUALITY, ONE_MINUTE_METRICS, VALUE_COLUMNS


def _floating(df, columns):
    kinds = dict(df.dtypes)
    return [c for c in columns if kinds[c] in ("double", "float")]


def nan_to_null(df: DataFrame, columns) -> DataFrame:
    """One kind of missing value. Parsed lines have no NaN; other tables may."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(float("nan"))) for c in _floating(df, columns)})


def drop_incomplete(df: DataFrame, columns=VALUE_COLUMNS) -> DataFrame:
    """Keep rows in which every one of `columns` has a value, NaN not being one.

    Plain IS NOT NULL conditions, which a Parquet scan takes as filters.
    """
    present = [F.col(c).isNotNull() for c in columns]
    numbers = [~F.isnan(c) for c in _floating(df, columns)]
    return df.where(reduce(and_, present + numbers))


def exclude_quality(df: DataFrame, codes=EXCLUDED_QUALITY, column="q") -> DataFrame:
    """Drop the given quality codes; a row without a code stays."""
    return df.where(~has_quality(F.col(column), codes)) if codes else df


def clean(df: DataFrame, codes=EXCLUDED_QUALITY, columns=VALUE_COLUMNS) -> DataFrame:
    """The rows that plots and archives are made of; `columns` are those of another layout."""
    return exclude_quality(drop_incomplete(df, columns), codes)


def for_table(df: DataFrame, codes=EXCLUDED_QUALITY) -> DataFrame:
    """The rows and columns the one-minute table is made of: incomplete rows stay."""
    return nan_to_null(exclude_quality(df, codes), ONE_MINUTE_METRICS).select(
        "base", "rover", "source_file", "time", *ONE_MINUTE_METRICS)


def decode_quality(df: DataFrame, column="q") -> DataFrame:
    return df.withColumn("quality", quality_label(F.col(column)))


def clean_counted(df: DataFrame, codes=EXCLUDED_QUALITY, columns=VALUE_COLUMNS) -> tuple[DataFrame, Observation]:
    """`clean`, and how many rows are incomplete, of excluded quality, and left: counts that Spark gathers in
    whatever job reads the result first."""
    seen = Observation("rows")
    missing = reduce(or_, [F.col(c).isNull() for c in columns] + [F.isnan(c) for c in _floating(df, columns)])
    missing, excluded = F.coalesce(missing, F.lit(True)), has_quality(F.col("q"), codes) if codes else F.lit(False)
    marked = df.observe(
        seen, F.count_if(missing).alias("incomplete"), F.count_if(~missing & excluded).alias("excluded quality"),
        F.count_if(~missing & ~excluded).alias("written"))
    return clean(marked, codes, columns), seen
