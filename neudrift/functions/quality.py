"""Expressions on the observation quality code."""

from pyspark.sql import Column, functions as F

from neudrift.schema import QUALITY_LABELS


def quality_label(code: Column) -> Column:
    pairs = [F.lit(x) for pair in QUALITY_LABELS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), code.cast("int"))


def has_quality(code: Column, codes) -> Column:
    """True where the code is one of `codes`; false, never null, where it is missing."""
    return F.coalesce(code.isin(*codes), F.lit(False))
