"""Numbers and dates that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDINAL = r"(\d+)(st|nd|rd|th)"


def label_lower_yes(value: Column) -> Column:
    return F.when(F.lower(value) == "yes", 1).otherwise(0)


def label_map(value: Column) -> Column:
    return F.when(value == "Yes", 1).when(value == "No", 0)


def parse_loudness(value: Column) -> Column:
    return F.replace(value, F.lit("db"), F.lit("")).try_cast("double")


def parse_length(value: Column) -> Column:
    """Seconds of `mm:ss`; other forms and nulls give null."""
    parts = F.split(value, ":")
    return F.when(
        value.rlike(r"^\d+:\d+$"),
        F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int"),
    )


def parse_release_date(value: Column) -> Column:
    """Day-first date with the ordinal suffix removed; bad text gives null."""
    plain = F.regexp_replace(value, ORDINAL, "$1")
    return F.to_date(F.try_to_timestamp(plain, F.lit("d MMMM yyyy")))


def ordinal_suffix(value: Column) -> Column:
    found = F.regexp_extract(value, r"\d+(st|nd|rd|th)", 1)
    return F.when(found != "", found)


def release_decade(date: Column) -> Column:
    """`1990s`; an absent date counts as `0s`."""
    year = F.coalesce(F.year(date), F.lit(0))
    return F.concat((year - year % 10).cast("string"), F.lit("s"))


def percent_to_fraction(value: Column) -> Column:
    plain = F.rtrim(F.replace(value, F.lit(","), F.lit(".")), F.lit("%"))
    return plain.try_cast("double") / 100
