"""Recodes used when a feature table is made ready for modelling."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .parsing import parse_integer, parse_number

NOT_RELEVANT = "NR"

# The model's column types. "double" and "int" are numeric, "string" is categorical.
EXPECTED_TYPES = {
    "iit": "int", "cascadestatus": "string", "visittype": "int", "visitby": "string",
    "tcareason": "string", "pregnant": "int", "breastfeeding": "int", "stabilityassessment": "int",
    "differentiatedcare": "string", "emr": "int", "whostage": "double", "adherence": "int",
    "sex": "int", "age": "double", "maritalstatus": "string", "educationlevel": "string",
    "occupation": "string", "bmi": "string", "regimen_switch": "int", "is_friday": "int",
    "daystonextappointment": "int", "timeonart": "double", "firstvisit": "int", "lastvd": "int",
    "late": "int", "late14": "int", "late30": "int",
    "lateness_last3": "double", "lateness_last5": "double", "lateness_last10": "double",
    "late_last3": "double", "late_last5": "double", "late_last10": "double",
    "late14_last3": "double", "late14_last5": "double", "late14_last10": "double",
    "late30_last3": "double", "late30_last5": "double", "late30_last10": "double",
    "optimizedhivregimen": "int", "most_recent_vl": "string", "ahd": "int",
    "kephlevel": "string", "facilitytypecategory": "string", "ownertype": "string",
    "men_knowledge": "double", "women_knowledge": "double", "men_heardaids": "double",
    "men_highrisksex": "double", "men_highrisksex_multi": "double",
    "men_sexnotwithpartner": "double", "men_sexpartners": "double", "men_nevertested": "double",
    "men_testedrecent": "double", "men_sti": "double", "women_heardaids": "double",
    "women_highrisksex": "double", "women_highrisksex_multi": "double",
    "women_sexnotwithpartner": "double", "women_sexpartners": "double",
    "women_nevertested": "double", "women_testedrecent": "double", "women_sti": "double",
}


def cast_expected(df: DataFrame, types: dict[str, str] = EXPECTED_TYPES) -> DataFrame:
    """Cast known columns to their model type; a value that does not fit becomes null."""
    parsers = {
        "int": parse_integer,
        "double": parse_number,
        "string": lambda c: c.cast("string"),
    }
    have = dict(df.dtypes)
    return df.select(
        [
            parsers[types[c]](F.col(c)).alias(c) if c in types and have[c] != types[c] else F.col(c)
            for c in df.columns
        ]
    )


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    wanted = set(columns)
    return df.select([parse_number(F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns])


def recode(value: Column, mapping: dict[str, object], keep_others: bool = False) -> Column:
    """Map exact labels; anything else becomes null, or stays as it is."""
    if not mapping:
        return value if keep_others else F.lit(None)
    out = None
    for label, new in mapping.items():
        test = value == label
        out = F.when(test, F.lit(new)) if out is None else out.when(test, F.lit(new))
    return out.otherwise(value) if keep_others else out


# Label recodes.
YES_NO = {"Yes": 1, "No": 0}
ADHERENCE_BINARY = {"good": 1, "poor": 0, "fair": 0}
ADHERENCE_GROUP = {"good": "optimal", "fair": "suboptimal", "poor": "suboptimal"}


def equals_flag(value: Column, label: str) -> Column:
    return F.coalesce(value == label, F.lit(False)).cast("int")


def mark_not_relevant(value: Column, missing: Column) -> Column:
    """`NR` where the value is null although its missing flag is 0."""
    return F.when(value.isNull() & (missing == 0), F.lit(NOT_RELEVANT)).otherwise(value.cast("string"))


def risk_category(score: Column, high: Column, medium: Column) -> Column:
    return (
        F.when(score.isNull(), F.lit(None))
        .when(score > high, F.lit("high"))
        .when(score > medium, F.lit("medium"))
        .otherwise(F.lit("low"))
    )
