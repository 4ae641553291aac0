"""Small text expressions: emptiness as a value's absence, and joined lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_else(value: Column, other: Column) -> Column:
    """value, unless it is null or empty."""
    return F.when(F.coalesce(value, F.lit("")) != "", value).otherwise(other)


def given(values: Column) -> Column:
    """An array without nulls; an empty one for null."""
    return F.coalesce(F.array_compact(values), F.array().cast("array<string>"))


def joined(values: Column, by: str = ",") -> Column:
    """The array's texts with a separator between; '' for null and empty arrays."""
    return F.concat_ws(by, values)


def day_of_file(name: Column) -> Column:
    """The day that an archive's file name ends in, null where it is none."""
    stem = F.regexp_replace(F.element_at(F.split(name, "/"), -1), r"\.json\.gz$", "")
    return F.element_at(F.split(stem, "events-"), -1).try_cast("date")
