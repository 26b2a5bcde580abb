"""Token-array expressions. All stay inside the JVM and work on whole lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def letters(text: Column) -> Column:
    """Maximal runs of ``a``–``z`` in the lower-cased text, in order."""
    return F.array_remove(F.split(F.lower(text), "[^a-z]+"), "")


def letters_by_match(text: Column) -> Column:
    """The same tokens found by matching; kept as an independent second form."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))


def alphanumerics(text: Column) -> Column:
    """Maximal runs of ``a``–``z`` and digits; null text gives an empty array."""
    found = F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def adjacent(tokens: Column) -> Column:
    """Array of ``(w1, w2)`` structs of neighbouring tokens."""
    m = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(F.slice(tokens, F.lit(1), m).alias("w1"), F.slice(tokens, F.lit(2), m).alias("w2"))


def each(df: DataFrame, keep: list, array: Column, name: str) -> DataFrame:
    """One row per array element.

    A plain ``explode`` makes the optimiser add a filter on the array's size and
    push it towards the scan, where the array has to be built a second time.
    The outer form adds none; its rows for empty arrays are dropped here.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
