"""Baseline displacement time series on Spark: parse, clean, resample, compare, archive."""
