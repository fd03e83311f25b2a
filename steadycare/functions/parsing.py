"""Text to date, number and clean text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\x0b\x0c"
DATE_SHAPE = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"
NUMBER_SHAPE = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"


def parse_date(value: Column) -> Column:
    """Date from the first ten characters (year-month-day), null when they are not a date.

    The shape test comes first because a plain cast also accepts a bare year and trailing text.
    """
    head = F.substring(value.cast("string"), 1, 10)
    return F.regexp_extract(head, DATE_SHAPE, 0).try_cast("date")


def parse_number(value: Column) -> Column:
    """Double, or null for anything that is not a plain decimal number (so never NaN or infinity)."""
    return F.regexp_extract(value.cast("string"), NUMBER_SHAPE, 1).try_cast("double")


def parse_integer(value: Column) -> Column:
    return parse_number(value).try_cast("int")


def _printable(value: Column) -> Column:
    """Whether text starts with a visible ASCII character; a comparison of bytes."""
    return (value >= "!") & (value < "\x7f")


def blank_to_null(value: Column) -> Column:
    return F.when(_printable(value), value).otherwise(F.when(~value.rlike(r"^\s*$"), value))


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def strip_once(value: Column) -> Column:
    """`strip` for text that is mostly clean: what starts and ends with a visible character is left as it is.

    The value is read several times, so it has to be a column, not an expression.
    """
    bare = _printable(value) & _printable(F.substring(value, -1, 1))
    return F.when(bare, value).otherwise(strip(value))


def lower_names(df: DataFrame, drop_characters: str = "") -> DataFrame:
    """Lower-case column names, with the given characters removed from them."""
    table = str.maketrans("", "", drop_characters)
    return df.toDF(*[name.lower().translate(table) for name in df.columns])


def underscore_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def map_strings(df: DataFrame, function, skip: tuple[str, ...] = ()) -> DataFrame:
    """Apply a Column function to every string column, keeping the column order."""
    return df.select(
        [
            function(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
