"""Visit features and demographics."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clinical, person
from ..functions.parsing import blank_to_null, map_strings, parse_date
from .dedup import history

# Output columns.
VISIT_COLUMNS = [
    "key", "sitecode", "visitdate", "visittype", "visitby", "tcareason", "pregnant",
    "pregnant_missing", "breastfeeding", "breastfeeding_missing", "stabilityassessment",
    "differentiatedcare", "whostage", "emr", "adherence", "sex", "age", "maritalstatus",
    "educationlevel", "occupation", "nad_imputed", "nad_imputation_flag", "bmi", "regimen_switch",
    "startartdate",
]

# The last raw column, in the order that breaks ties, that a feature of another name is made of.
MADE_OF = {
    "pregnant_missing": "pregnant", "breastfeeding_missing": "breastfeeding", "bmi": "weight", "regimen_switch": "currentregimen",
}


def inputs_of(columns: Iterable[str]) -> set[str]:
    """Raw visit columns that the given features are made of; those of a person and of dates need none."""
    return {MADE_OF.get(c, c) for c in columns}


def with_age(df: DataFrame) -> DataFrame:
    """Age at the visit; rows without a valid age drop."""
    age = clinical.age_years(F.col("dob"), F.col("visitdate"))
    return df.withColumn("age", age).filter(F.col("age") >= 0)


def regimen_switch():
    """1 if more than one regimen was recorded in the last 365 days, 0 for one, null for none.

    Two different values exist exactly when the smallest and the largest differ. Written as SQL
    because a day count is only accepted over a date column there, which keeps the window on the
    same sort as the others.
    """
    frame = "partition by key order by visitdate range between 365 preceding and current row"
    lowest = F.expr(f"min(currentregimen) over ({frame})")
    highest = F.expr(f"max(currentregimen) over ({frame})")
    return (lowest != highest).cast("int")


def visit_features(clean: DataFrame) -> DataFrame:
    """Recoded visits of patients with a valid age.

    Three projections on purpose: what is used more than once is a column before it is used, so it is
    computed once and each generated method stays small enough to be compiled.
    """
    df = map_strings(clean, blank_to_null, skip=("key",))
    aged = with_age(
        df.withColumns({c: parse_date(F.col(c)) for c in ("dob", "startartdate")})
    ).withColumn("sex", clinical.sex_flag(F.col("sex")))
    age, sex = F.col("age"), F.col("sex")
    recoded = aged.withColumns(
        {
            "pregnant": clinical.reproductive_status(F.col("pregnant"), age, sex),
            "breastfeeding": clinical.reproductive_status(F.col("breastfeeding"), age, sex),
            "adherence": clinical.adherence(F.col("adherence")),
            "whostage": clinical.who_stage(F.col("whostage")),
            "visittype": clinical.unscheduled(F.col("visittype")),
            "stabilityassessment": clinical.stability(F.col("stabilityassessment")),
            "differentiatedcare": clinical.delivery_model(F.col("differentiatedcare")),
            "bmi": clinical.body_mass(F.col("height"), F.col("weight"), age),
        }
    )
    return recoded.withColumns(
        {
            "pregnant_missing": clinical.reproductive_missing(F.col("pregnant"), age, sex),
            "breastfeeding_missing": clinical.reproductive_missing(F.col("breastfeeding"), age, sex),
            "bmi": clinical.bmi_band(F.col("bmi"), age),
            "regimen_switch": regimen_switch(),
        }
    ).select(*VISIT_COLUMNS)


def demographics(visits: DataFrame) -> DataFrame:
    """Calendar, time on treatment, tenure at the facility, and person recodes."""
    due, visit, age = F.col("nad_imputed"), F.col("visitdate"), F.col("age")
    first = F.min("visitdate").over(history(time="visitdate"))
    return (
        visits.withColumns(
            {
                "month": F.month(due),
                "dayofweek": F.weekday(due),
                "is_friday": person.is_friday(due),
                "daystonextappointment": F.datediff(due, visit),
                "timeonart": clinical.months_on_treatment(visit, F.col("startartdate")),
                "_first": first,
                "maritalstatus": person.marital_status(F.col("maritalstatus"), age),
                "occupation": person.occupation(F.col("occupation")),
                "educationlevel": person.education_level(F.col("educationlevel")),
            }
        )
        .withColumns(
            {
                "timeatfacility": F.datediff(visit, F.col("_first")) / F.lit(30.44),
                "firstvisit": (visit == F.col("_first")).cast("int"),
            }
        )
        .drop("_first")
    )
