"""Expressions over file names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from textfeat.functions import patterns


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def strip_suffix(name: Column) -> Column:
    """``12220-8.txt`` -> ``12220.txt``; any numeric suffix goes."""
    return F.regexp_replace(name, patterns.NUMERIC_SUFFIX, "$1$3")


def encoding_preference(name: Column) -> Column:
    """0 for UTF-8 variants, 2 for Latin-1 variants, 1 for the rest. Lower is better."""
    return (
        F.when(name.rlike(patterns.UTF8_NAME), 0)
        .when(name.rlike(patterns.LATIN1_NAME), 2)
        .otherwise(1)
        .cast("bigint")
    )


def is_eligible(name: Column, n_bytes: Column, max_mib: float) -> Column:
    """Text files of at most ``max_mib`` MiB, the bound included."""
    return name.endswith(".txt") & (n_bytes <= F.lit(float(max_mib) * 1048576))
