"""Visit-level clinical recodes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parsing import parse_number

# Body-mass bands, plausible height (cm) and weight (kg), fertile age.
HEIGHT_RANGE = (50, 250)
WEIGHT_RANGE = (20, 200)
BMI_BANDS = ((18.5, "Underweight"), (25.0, "Normalweight"), (30.0, "Overweight"))
BMI_TOP = "Obese"
UNDER_15 = "Under15"
FERTILE_AGE = (15, 49)
COMMUNITY_DELIVERY = "community art distribution"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def adherence(value: Column) -> Column:
    """1 for good, 0 for fair or poor (text before the first pipe), null for anything else."""
    head = F.substring_index(F.lower(value), "|", 1)
    digits = F.regexp_replace(F.replace(head, F.lit("good"), F.lit("1")), "fair|poor", "0")
    return F.regexp_extract(digits, "^[01]$", 0).try_cast("int")


def unscheduled(value: Column) -> Column:
    return flag(F.lower(value).contains("unscheduled"))


def stability(value: Column) -> Column:
    text = F.lower(value)
    return F.when(~text.rlike(r"^\s*$"), F.when(text.rlike("un|not"), 0).otherwise(1))


def delivery_model(value: Column) -> Column:
    """Differentiated care; all community distribution variants share one label."""
    text = F.lower(value)
    return F.when(text.contains(COMMUNITY_DELIVERY), F.lit(COMMUNITY_DELIVERY)).otherwise(text)


def who_stage(value: Column) -> Column:
    return parse_number(value)


def age_years(born: Column, on: Column) -> Column:
    return F.datediff(on, born) / F.lit(365.25)


def sex_flag(value: Column) -> Column:
    return flag(value == "male")


def may_be_pregnant(age: Column, sex: Column) -> Column:
    return age.between(*FERTILE_AGE) & (sex == 0)


def reproductive_status(value: Column, age: Column, sex: Column) -> Column:
    """Pregnancy or breastfeeding answer: 1 yes, 0 no, null when unknown or not applicable.

    "no" is looked for anywhere in the answer, so "unknown" reads as no.
    """
    text = F.lower(value)
    return F.when(
        may_be_pregnant(age, sex), F.when(text.contains("yes"), 1).when(text.contains("no"), 0)
    )


def reproductive_missing(status: Column, age: Column, sex: Column) -> Column:
    return flag(status.isNull() & may_be_pregnant(age, sex))


def body_mass(height: Column, weight: Column, age: Column) -> Column:
    """Body-mass index from 15 years on, where height and weight are plausible."""
    valid = height.between(*HEIGHT_RANGE) & weight.between(*WEIGHT_RANGE)
    return F.when(valid & (age >= 15), weight / ((height / 100) * (height / 100)))


def bmi_band(bmi: Column, age: Column) -> Column:
    band = F.when(age < 15, F.lit(UNDER_15))
    for upper, label in BMI_BANDS:
        band = band.when(bmi < upper, F.lit(label))
    return band.when(bmi.isNotNull(), F.lit(BMI_TOP))


def optimised_regimen(drug: Column) -> Column:
    return flag(drug.contains("DTG"))


def lab_test(name: Column) -> Column:
    """CD4 counts, viral loads, or Other (percent CD4 tests and everything else)."""
    text = F.lower(name)
    count = text.contains("cd4") & ~text.contains("%") & ~text.contains("percent")
    return (
        F.when(count, F.lit("CD4"))
        .when(text.contains("viral") | text.contains("vl"), F.lit("VL"))
        .otherwise(F.lit("Other"))
    )


def lab_high(test: Column, number: Column) -> Column:
    """1 at or above 200, 0 below. A viral load without a number is low; such a CD4 is unknown."""
    return F.when(number >= 200, 1).when(number.isNotNull() | (test == "VL"), 0)


def lab_label(test: Column, high: Column) -> Column:
    return F.when(
        test == "VL", F.when(high == 1, F.lit("nonsuppressed")).when(high == 0, F.lit("suppressed"))
    ).when(test == "CD4", F.when(high == 1, F.lit("YesAHD")).when(high == 0, F.lit("NoAHD")))


def lab_category(test: Column, result: Column) -> Column:
    return lab_label(test, lab_high(test, parse_number(result)))


def due_gap_group(days: Column) -> Column:
    """Refill length in days that a gap stands for; 30 when it is unknown or beyond the last band."""
    return (
        F.when(days < 45, 30)
        .when(days < 75, 60)
        .when(days < 105, 90)
        .when(days < 150, 120)
        .when(days < 200, 180)
        .otherwise(30)
    )


def logical_due(contact: Column, due: Column) -> Column:
    """The due date, or null when it is not 1 to 365 days after the contact."""
    return F.when(F.datediff(due, contact).between(1, 365), due)


def months_on_treatment(visit: Column, start: Column) -> Column:
    months = F.datediff(visit, start) / F.lit(30.44)
    return F.when(months < 0, F.lit(0.0)).otherwise(months)


def viral_class(recent: Column, months_art: Column, months_here: Column) -> Column:
    """Most recent valid viral load, or why there is none."""
    return (
        F.when(recent.isNotNull(), recent)
        .when(months_art <= 6, F.lit("earlyart"))
        .when((months_art > 6) & (months_here <= 6), F.lit("restart"))
        .otherwise(F.lit("novalidvl"))
    )


def advanced_disease(age: Column, cd4: Column, stage: Column) -> Column:
    return flag(
        F.coalesce(age < 5, F.lit(False))
        | F.coalesce(cd4 == "YesAHD", F.lit(False))
        | F.coalesce(stage.isin(3, 4), F.lit(False))
    )


def restart_status(days_since_restart: Column) -> Column:
    months = days_since_restart / F.lit(30)
    return (
        F.when(months.isNull(), F.lit("neverdisengaged"))
        .when(months <= 6, F.lit("shorttermrestart"))
        .otherwise(F.lit("longtermrestart"))
    )


