"""Point-in-time features of a labelled contact.

All windows partition by key and order by visit date, so they share one sort. A key has at most one
target per day of the study period.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clinical
from .asof import Latest, asof_join
from .dedup import history

LOOKBACKS = (3, 5, 10)
LATE_LIMITS = {"late": 0, "late14": 14, "late30": 30}
LAB_MAX_AGE = 365
# Visit features that the classes of laboratory results are made of.
LAB_INPUTS = ("age", "whostage", "timeonart", "timeatfacility")
# Columns of the visit table that a target has itself.
SHARED_WITH_TARGET = ("key", "visitdate", "sitecode", "nad_imputed", "nad_imputation_flag")


def cascade(targets: DataFrame) -> DataFrame:
    """Add `cascadestatus`: time since the visit that followed the latest interruption."""
    by_time = history(time="visitdate")
    restarted = F.when(F.lag("iit").over(by_time) == 1, F.col("visitdate"))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        targets.withColumn("_restart", restarted)
        .withColumn("_restart", F.last("_restart", ignorenulls=True).over(so_far))
        .withColumn(
            "cascadestatus", clinical.restart_status(F.datediff("visitdate", "_restart"))
        )
        .drop("_restart")
    )


def lateness(targets: DataFrame) -> DataFrame:
    """Days late at the previous contact, its flags, and their rolling means and sums."""
    by_time = history(time="visitdate")
    difference = F.col("visitdiff")
    clipped = F.when(
        difference.isNotNull(), F.least(F.greatest(difference, F.lit(0)), F.lit(100))
    )
    df = targets.withColumn("lastvd", F.lag(clipped).over(by_time)).withColumns(
        {name: clinical.flag(F.col("lastvd") > limit) for name, limit in LATE_LIMITS.items()}
    )
    rolling = {}
    for n in LOOKBACKS:
        frame = by_time.rowsBetween(1 - n, Window.currentRow)
        rolling[f"lateness_last{n}"] = F.avg("lastvd").over(frame)
        for name in LATE_LIMITS:
            rolling[f"{name}_last{n}"] = F.sum(name).over(frame).cast("double")
    return df.withColumns(rolling).drop("visitdiff")


def visits_side(visits: DataFrame) -> Latest:
    columns = tuple(c for c in visits.columns if c not in SHARED_WITH_TARGET)
    return Latest(visits, "visitdate", columns)


def pharmacy_side(pharmacy: DataFrame) -> Latest:
    rows = pharmacy.withColumn("optimizedhivregimen", clinical.optimised_regimen(F.col("drug")))
    return Latest(rows, "dispensedate", ("optimizedhivregimen",))


LAB_COLUMNS = {"VL": "most_recent_vl", "CD4": "most_recent_cd4"}


def lab_classes(df: DataFrame) -> DataFrame:
    """Turn the latest valid results into the viral-load class and the advanced-disease flag."""
    return df.withColumns(
        {
            "most_recent_vl": clinical.viral_class(
                F.col("most_recent_vl"), F.col("timeonart"), F.col("timeatfacility")
            ),
            "ahd": clinical.advanced_disease(
                F.col("age"), F.col("most_recent_cd4"), F.col("whostage")
            ),
        }
    ).drop("most_recent_cd4")


def visit_history(targets: DataFrame, visits: DataFrame) -> DataFrame:
    return lateness(cascade(asof_join(targets, "visitdate", [visits_side(visits)])))


def pharmacy_history(targets: DataFrame, pharmacy: DataFrame) -> DataFrame:
    return asof_join(targets, "visitdate", [pharmacy_side(pharmacy)])


def lab_sides(lab: DataFrame) -> list[Latest]:
    """One side for each test over the same rows, so that the table is read and shuffled once."""
    rows = lab.filter(F.col("testname").isin(*LAB_COLUMNS)).withColumns({c: F.col("testresultcat") for c in LAB_COLUMNS.values()})
    return [
        Latest(rows, "orderedbydate", (c,), max_age_days=LAB_MAX_AGE, where=F.col("testname") == test)
        for test, c in LAB_COLUMNS.items()
    ]


def lab_history(targets: DataFrame, lab: DataFrame) -> DataFrame:
    return lab_classes(asof_join(targets, "visitdate", lab_sides(lab)))


def full_history(
    targets: DataFrame, visits: DataFrame, pharmacy: DataFrame, lab: DataFrame
) -> DataFrame:
    """Visit, pharmacy and laboratory history with all as-of joins in one pass over the keys."""
    sides = [visits_side(visits), pharmacy_side(pharmacy), *lab_sides(lab)]
    return lab_classes(lateness(cascade(asof_join(targets, "visitdate", sides))))
