"""Demographic recodes and calendar features."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
OCCUPATIONS = ("farmer", "trader", "student", "driver", "employee", "none", "other")
EDUCATION_LEVELS = ("none", "primary", "secondary", "college")


def marital_status(value: Column, age: Column) -> Column:
    text = F.lower(value)
    return (
        F.when(age < 15, F.lit("minor"))
        .when(text.contains("poly"), F.lit("polygamous"))
        .when(text.contains("single"), F.lit("single"))
        .when(text.rlike("married|cohabit"), F.lit("married"))
        .when(text.rlike("divorced|separated"), F.lit("divorced"))
        .when(text.contains("widowed"), F.lit("widowed"))
        .when(text == "minor", F.lit("minor"))
    )


def occupation(value: Column) -> Column:
    text = F.lower(value)
    blank = text.isNull() | text.rlike(r"^\s*$") | (text == "null")
    return F.when(~blank, F.when(text.isin(*OCCUPATIONS), text).otherwise(F.lit("other")))


def education_level(value: Column) -> Column:
    text = F.lower(value)
    return F.when(text.isin(*EDUCATION_LEVELS), text)


def is_friday(due: Column) -> Column:
    return F.coalesce(F.weekday(due) == 4, F.lit(False)).cast("int")


def year_month(day: Column) -> Column:
    """YYYYMM as an integer."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def shift_year_month(period: Column, months: int) -> Column:
    """Move a YYYYMM integer by whole months."""
    index = F.floor(period / 100).cast("int") * 12 + (period % 100) - 1 + months
    return (F.floor(index / 12) * 100 + (index % 12) + 1).cast("int")


def month_index(day: Column, start: str) -> Column:
    """1 for the month of `start`, 2 for the next one, and so on."""
    first = F.lit(start).cast("date")
    return ((F.year(day) - F.year(first)) * 12 + F.month(day) - F.month(first) + 1).cast("int")
