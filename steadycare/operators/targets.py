"""Contacts of a patient and the interruption label of each of them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import clean_people
from .dedup import history

GRACE_DAYS = 30
# Outcomes under which a patient who did not come back counts as interrupted.
OPEN_OUTCOMES = ("active", "loss to follow up", "lost in hmis")
# Output columns.
TARGET_COLUMNS = ["key", "visitdate", "nad", "nad_imputation_flag", "sitecode", "visitdiff", "iit"]


def stack_contacts(visits: DataFrame, pharmacy: DataFrame) -> DataFrame:
    """Clinical and pharmacy contacts by name, with their type."""
    shared = ["nad_imputation_flag", "sitecode"]
    nad = F.col("nad_imputed").alias("nad")
    clinical = visits.select("key", "visitdate", nad, *shared, F.lit("clinical").alias("type"))
    dispensed = F.col("dispensedate").alias("visitdate")
    return clinical.unionByName(
        pharmacy.select("key", dispensed, nad, *shared, F.lit("pharmacy").alias("type"))
    )


def merge_contacts(stacked: DataFrame) -> DataFrame:
    """One contact per key and date: stated due dates before imputed ones, then the latest.

    Days with both a visit and a dispense become `both`; days with only a dispense drop. Both inputs
    hold one row per key and day, so a group has at most two rows. One sort by key and date serves
    this and all later windows on the patient.
    """
    same_day = Window.partitionBy("key", "visitdate")
    best = same_day.orderBy("nad_imputation_flag", F.col("nad").desc(), "type")
    whole = best.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        stacked.withColumns(
            {
                "_rank": F.row_number().over(best),
                "_rows": F.count(F.lit(1)).over(whole),
                "sitecode": F.first("sitecode", ignorenulls=True).over(whole),
            }
        )
        .filter("_rank = 1")
        .withColumn("type", F.when(F.col("_rows") > 1, F.lit("both")).otherwise(F.col("type")))
        .filter("type <> 'pharmacy'")
        .drop("_rank", "_rows")
    )


def outcomes(people: DataFrame) -> DataFrame:
    return clean_people(people).select("key", "artoutcomedescription")


def due_never_earlier(contacts: DataFrame) -> DataFrame:
    """Due dates never move backwards within a patient; a moved date counts as imputed."""
    so_far = F.max("nad").over(
        history(time="visitdate").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        contacts.withColumn("_nad", so_far)
        .withColumns(
            {
                "nad_imputation_flag": (
                    (F.col("nad_imputation_flag") == 1) | (F.col("_nad") != F.col("nad"))
                ).cast("int"),
                "nad": F.col("_nad"),
            }
        )
        .drop("_nad")
    )


def return_difference(contacts: DataFrame) -> DataFrame:
    """Next contact, days between it and the due date, and the label."""
    following = F.lead("visitdate").over(history(time="visitdate"))
    return contacts.withColumn("actualreturndate", following).withColumns(
        {
            "visitdiff": F.datediff("actualreturndate", "nad"),
            "iit": F.coalesce(
                F.datediff("actualreturndate", "nad") > GRACE_DAYS, F.lit(False)
            ).cast("int"),
        }
    )


def visit_number(contacts: DataFrame) -> DataFrame:
    """`num_visit`: 0 for the latest contact, counting back."""
    whole = Window.partitionBy("key")
    back = F.count(F.lit(1)).over(whole) - F.row_number().over(history(time="visitdate"))
    return contacts.withColumn("num_visit", back.cast("int"))


def site_latest(contacts: DataFrame) -> DataFrame:
    """Latest contact date per site. Every merged contact is a visit, so visits give the same."""
    return contacts.groupBy("sitecode").agg(F.max("visitdate").alias("site_latest"))


def resolve_last(contacts: DataFrame, sites: DataFrame) -> DataFrame:
    """Drop last contacts whose outcome is unknown or closed, label the other last ones 1.

    Earlier contacts pass unchanged. A last contact is unknown while its due date plus 30 days lies
    after the site's latest contact.
    """
    last = F.col("actualreturndate").isNull()
    seen = F.date_add("nad", GRACE_DAYS) <= F.col("site_latest")
    open_case = F.col("artoutcomedescription").isin(*OPEN_OUTCOMES)
    return (
        contacts.join(sites, "sitecode", "left")
        .filter(~last | (seen & open_case))
        .withColumn("iit", F.when(last, F.lit(1)).otherwise(F.col("iit")))
        .drop("site_latest")
    )


def before_last(contacts: DataFrame) -> DataFrame:
    """Contacts that were followed by another one."""
    return contacts.filter(F.col("actualreturndate").isNotNull())


def labelled_contacts(visits: DataFrame, pharmacy: DataFrame, people: DataFrame) -> DataFrame:
    merged = merge_contacts(stack_contacts(visits, pharmacy))
    return return_difference(due_never_earlier(merged)).join(outcomes(people), "key", "left")


def create_targets(
    visits: DataFrame, pharmacy: DataFrame, people: DataFrame, sites: DataFrame | None = None
) -> DataFrame:
    """Labelled contacts with a known outcome.

    `sites` is `site_latest(visits)`, given when the caller has it at hand already.
    """
    contacts = labelled_contacts(visits, pharmacy, people)
    sites = site_latest(visits) if sites is None else sites
    return resolve_last(contacts, sites).select(*TARGET_COLUMNS)
