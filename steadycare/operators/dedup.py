"""Keys, duplicate contacts, missing due dates.

`one_per_day` keeps one row per patient and calendar day. Its row-number filter is planned as a
group limit below the shuffle, so a patient (or a single day) holding a large share of the raw rows
is reduced inside every map task. After it a patient has at most one row per day of the study
period, which is what bounds every later window on `key`.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clinical import due_gap_group
from ..functions.parsing import strip

DEFAULT_GAP = 30


def patient_key(patient: Column, site: Column) -> Column:
    return F.concat(strip(patient), strip(site.cast("string")))


def with_key(df: DataFrame) -> DataFrame:
    """Add `key` (patient then site); the site is `sitecode`, or `mflcode` where that is missing."""
    if "key" in df.columns:
        return df.filter(F.col("key").isNotNull())
    site = "sitecode" if "sitecode" in df.columns else "mflcode"
    # a key is null where one of its parts is; asked of the parts, it is not put together twice
    return df.filter(F.col("patientpkhash").isNotNull() & F.col(site).isNotNull()).withColumns(
        {
            "sitecode": strip(F.col(site).cast("string")),
            "key": patient_key(F.col("patientpkhash"), F.col(site)),
        }
    )


def one_per_day(df: DataFrame, contact: str, due: str, ties: list[str]) -> DataFrame:
    """One row per key and contact date: the latest due date, then the smallest tie columns."""
    order = [F.col(due).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in ties]
    rank = F.row_number().over(Window.partitionBy("key", contact).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def one_per_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per key: the row with the smallest values of the given columns, in that order."""
    order = [F.col(c).asc_nulls_last() for c in columns]
    rank = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    return (
        df.select("key", *columns).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    )


def history(*, time: str, key: str = "key"):
    return Window.partitionBy(key).orderBy(time)


def impute_due(df: DataFrame, contact: str, due: str) -> DataFrame:
    """Add `nad_imputed` and `nad_imputation_flag`.

    A missing due date is the contact date plus the gap group of the patient's next contact (30 days
    for the last one). Expects one row per key and contact date.
    """
    gap = due_gap_group(F.datediff(due, contact))
    next_gap = F.coalesce(F.lead(gap).over(history(time=contact)), F.lit(DEFAULT_GAP))
    return df.withColumns(
        {
            "nad_imputed": F.coalesce(F.col(due), F.date_add(F.col(contact), next_gap)),
            "nad_imputation_flag": F.col(due).isNull().cast("int"),
        }
    )
