"""Cleaning of the four raw tables."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import lab_high, lab_label, lab_test, logical_due
from ..functions.parsing import lower_names, map_strings, parse_date, parse_number, strip_once
from .dedup import impute_due, one_per_day, one_per_key, with_key

TREATMENTS = ("arv", "pmtct")
PERSON_COLUMNS = [
    "sex", "maritalstatus", "educationlevel", "occupation", "artoutcomedescription",
    "startartdate", "dob",
]
# What later steps read of a visit besides its key and dates, in the order that breaks ties.
VISIT_INPUTS = [
    "sitecode", "visittype", "visitby", "tcareason", "pregnant", "breastfeeding",
    "stabilityassessment", "differentiatedcare", "whostage", "height", "weight", "emr", "adherence",
    "currentregimen",
]
LAB_GROUP = ["key", "orderedbydate", "testname"]


def day(value: str | date):
    return F.lit(str(value)).cast("date")


# --- laboratory -----------------------------------------------------------------------------


def lab_results(raw: DataFrame, start: str) -> DataFrame:
    """CD4 and viral-load results since `start`, with the number read from the result text."""
    df = with_key(lower_names(raw))
    test = lab_test(F.col("testname"))
    return df.select(
        "key",
        parse_date(F.col("orderedbydate")).alias("orderedbydate"),
        test.alias("testname"),
        parse_number(F.col("testresult")).alias("number"),
    ).filter((F.col("orderedbydate") >= day(start)) & F.col("testname").isin("CD4", "VL"))


def lab_verdicts(results: DataFrame) -> DataFrame:
    """Per key, date and test: the category that survives, and what was repeated.

    A plain aggregate over integers, so it combines before the shuffle. Counts of all results are
    taken before CD4 results without a number are dropped, the others after.
    """
    high = lab_high(F.col("testname"), F.col("number"))
    numeric = F.col("number").isNotNull()
    groups = results.groupBy(*LAB_GROUP).agg(
        F.count(F.lit(1)).alias("results"),
        F.count("number").alias("numbers"),
        F.min(high).alias("lowest"),
        F.max(high).alias("highest"),
        F.max(F.when(numeric, high)).alias("numeric_high"),
    )
    single = F.col("results") == 1
    verdict = (
        F.when(single, F.col("highest"))
        .when(F.col("numbers") == 1, F.col("numeric_high"))
        .when((F.col("numbers") > 1) & (F.col("lowest") == F.col("highest")), F.col("highest"))
    )
    return groups.select(
        *LAB_GROUP,
        lab_label(F.col("testname"), verdict).alias("testresultcat"),
        ((F.col("numbers") == 1) & ~single).alias("numeric_only"),
    ).filter(F.col("testresultcat").isNotNull())


def clean_lab_daily(raw: DataFrame, start: str) -> DataFrame:
    """One row per key, date and test. Same categories as `clean_lab` without repeated rows."""
    return lab_verdicts(lab_results(raw, start)).drop("numeric_only")


def clean_lab(raw: DataFrame, start: str) -> DataFrame:
    """All surviving results: agreeing results of one day are all kept."""
    return dedup_lab(lab_results(raw, start))


def dedup_lab(results: DataFrame) -> DataFrame:
    kept = (F.col("testname") == "VL") | F.col("number").isNotNull()
    return (
        results.filter(kept)
        .join(lab_verdicts(results), LAB_GROUP)
        .filter(~F.col("numeric_only") | F.col("number").isNotNull())
        .select(*LAB_GROUP, "testresultcat")
    )


# --- pharmacy -------------------------------------------------------------------------------


def treatment_only(df: DataFrame) -> DataFrame:
    return df.filter(F.lower("treatmenttype").isin(*TREATMENTS))


def pharmacy_records(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Treatment dispenses in the period, with dates parsed and illogical return dates removed."""
    df = treatment_only(with_key(lower_names(raw)))
    dispensed, due = F.col("dispensedate"), F.col("expectedreturn")
    return (
        df.select(
            "key", "sitecode", "drug", parse_date(dispensed).alias("dispensedate"),
            parse_date(due).alias("expectedreturn"),
        )
        .filter(dispensed.between(day(start), day(end)))
        .withColumn("expectedreturn", logical_due(dispensed, due))
    )


def clean_pharmacy(raw: DataFrame, start: str, end: str) -> DataFrame:
    daily = one_per_day(
        pharmacy_records(raw, start, end), "dispensedate", "expectedreturn", ["drug", "sitecode"]
    )
    return impute_due(daily, "dispensedate", "expectedreturn").select(
        "key", "sitecode", "dispensedate", "nad_imputed", "nad_imputation_flag", "drug"
    )


# --- visits ---------------------------------------------------------------------------------


def clean_people(raw: DataFrame) -> DataFrame:
    """One demographics row per key, text in lower case and without surrounding blanks."""
    df = with_key(lower_names(raw))
    # unlike in other tables, dates stay text here
    df = map_strings(df.select("key", *PERSON_COLUMNS), lambda c: F.lower(strip_once(c)), ("key",))
    return one_per_key(df, PERSON_COLUMNS)


def visit_records(raw: DataFrame, start: str, end: str) -> DataFrame:
    """Visits in the period: text lower-cased and stripped, dates parsed, illogical dates removed."""
    visited, due = F.col("visitdate"), F.col("nextappointmentdate")
    dates = {"visitdate": parse_date(visited), "nextappointmentdate": parse_date(due)}
    df = with_key(lower_names(raw)).withColumns(dates)
    df = df.filter(visited.between(day(start), day(end)))
    return map_strings(df, lambda c: F.lower(strip_once(c)), skip=("key",)).withColumn(
        "nextappointmentdate", logical_due(visited, due)
    )


def daily_visits(raw: DataFrame, start: str, end: str, wanted: set[str] | None = None) -> DataFrame:
    """One visit per patient and day.

    Columns that later steps read break ties before any others, so leaving the others out beforehand
    does not change what is kept of the rest. The patient code is fixed by key and site. For the same reason, where only some
    inputs are `wanted`, no column after the last of them breaks ties, and only the site and the columns up to it go on.
    """
    records = visit_records(raw, start, end)
    settled = {"key", "visitdate", "nextappointmentdate", "patientpkhash", *VISIT_INPUTS}
    first = [c for c in VISIT_INPUTS if c in records.columns]
    others = [c for c in records.columns if c not in settled]
    ties = first + others
    if wanted is not None:
        last = max((i for i, c in enumerate(ties) if c == "sitecode" or c in wanted), default=-1)
        ties, left_out = ties[: last + 1], ties[last + 1 :]
        records = records.withColumns({c: F.lit(None).cast(records.schema[c].dataType) for c in left_out})
    return one_per_day(records, "visitdate", "nextappointmentdate", ties)


def visit_inputs(raw: DataFrame) -> DataFrame:
    """The columns of raw visits that features are made of."""
    df = lower_names(raw)
    wanted = ["patientpkhash", "visitdate", "nextappointmentdate", *VISIT_INPUTS]
    return df.select(*[c for c in wanted if c in df.columns])


def clean_visits(raw: DataFrame, people: DataFrame, start: str, end: str, wanted: set[str] | None = None) -> DataFrame:
    """Cleaned visits of known patients with their demographics and an imputed due date.

    Demographics are constant per key, so joining them after the daily reduction gives the same rows
    and shuffles far fewer. Spark picks the join by size; visits have to be partitioned by key for the window anyway.
    """
    joined = daily_visits(raw, start, end, wanted).join(clean_people(people), "key")
    return impute_due(joined, "visitdate", "nextappointmentdate")
