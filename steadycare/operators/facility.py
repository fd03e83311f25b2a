"""Facility context: reference tables, caseload, and rolling facility statistics.

Lookup joins carry no broadcast hint. Spark broadcasts a side when its own size estimate, or the size
adaptive execution measures, is under the configured threshold, and sorts and merges otherwise with
skewed sites split. Derived lookups (site statistics) are small aggregates; a caller that stages them
gives Spark their exact size before the big side is planned.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import lower_names
from ..functions.person import shift_year_month, year_month

NO_SHOW_DAYS = 30
ROLLING_MONTHS = 6
DEFAULT_SHIFT = -1
# Facility columns of the reference tables.
MFL_COLUMNS = ["code", "kephlevel", "county", "facilitytypecategory", "ownertype"]
# County survey indicators.
SURVEY_COLUMNS = [
    "men_knowledge", "women_knowledge", "men_heardaids", "men_highrisksex", "men_highrisksex_multi",
    "men_sexnotwithpartner", "men_sexpartners", "men_nevertested", "men_testedrecent", "men_sti",
    "women_heardaids", "women_highrisksex", "women_highrisksex_multi", "women_sexnotwithpartner",
    "women_sexpartners", "women_nevertested", "women_testedrecent", "women_sti",
]
# Columns of the saved site table.
SITE_COLUMNS = [
    "sitecode", "rolling_weighted_noshow", "rolling_weighted_dayslate", "txcurr", "kephlevel",
    "facilitytypecategory", "ownertype", *SURVEY_COLUMNS,
]


def facility_survey(mfl: DataFrame, dhs: DataFrame) -> DataFrame:
    """Facilities with the survey indicators of their county."""
    facilities = lower_names(mfl, "._").select(*MFL_COLUMNS)
    facilities = facilities.withColumn("code", F.col("code").cast("string"))
    survey = lower_names(dhs, ".").drop("country", "survey")
    return facilities.join(survey, "county", "left").select(
        *MFL_COLUMNS, *[c for c in survey.columns if c != "county"]
    )


def with_facility(df: DataFrame, facilities: DataFrame) -> DataFrame:
    return df.join(facilities, F.col("sitecode") == F.col("code"), "left")


def caseload(txcurr: DataFrame) -> DataFrame:
    return lower_names(txcurr).select(
        F.col("facilitycode").cast("string").alias("sitecode"),
        F.col("period").cast("int").alias("period"),
        F.col("indicator_value").alias("txcurr"),
    )


def with_period(df: DataFrame) -> DataFrame:
    return df.withColumn("period", year_month(F.col("visitdate")))


def with_caseload(df: DataFrame, txcurr: DataFrame) -> DataFrame:
    return df.join(caseload(txcurr), ["sitecode", "period"], "left")


def site_month(df: DataFrame) -> DataFrame:
    """Per site and month: share of no-shows, mean days late, and how many values there were."""
    late = F.coalesce(F.col("lastvd") > NO_SHOW_DAYS, F.lit(False)).cast("int")
    return df.groupBy("sitecode", "period").agg(
        F.avg(late).alias("last_iit"),
        F.avg("lastvd").alias("lastvd"),
        F.count("lastvd").alias("count"),
    )


def site_rolling(months: DataFrame, shift_months: int = DEFAULT_SHIFT) -> DataFrame:
    """Weighted means over the last six month rows of a site, filed under a shifted month.

    A frame without weight has no mean. Days late is unknown when any month in the frame has no
    value. With the default shift a month's figures are filed one month earlier.
    """
    frame = (
        Window.partitionBy("sitecode")
        .orderBy("period")
        .rowsBetween(1 - ROLLING_MONTHS, Window.currentRow)
    )
    weight = F.sum("count").over(frame)

    def mean(value: str):
        complete = F.count(value).over(frame) == F.count(F.lit(1)).over(frame)
        total = F.sum(F.col(value) * F.col("count")).over(frame)
        return F.when(complete & (weight > 0), total / weight)

    return months.select(
        "sitecode",
        shift_year_month(F.col("period"), shift_months).alias("period"),
        mean("last_iit").alias("rolling_weighted_noshow"),
        mean("lastvd").alias("rolling_weighted_dayslate"),
    )


def with_rolling(df: DataFrame, rolling: DataFrame) -> DataFrame:
    return df.join(rolling, ["sitecode", "period"], "left")


def facility_features(
    df: DataFrame, mfl: DataFrame, dhs: DataFrame, txcurr: DataFrame, rolling: DataFrame | None = None,
    facilities: DataFrame | None = None,
) -> DataFrame:
    """All facility columns for rows with a site, a visit date and `lastvd`.

    `rolling` is `site_rolling(site_month(...))` and `facilities` is `facility_survey(mfl, dhs)`, given when the caller
    has them staged already: the size of a join is only known once it is written.
    """
    columns = df.columns
    dated = with_period(df)
    rolling = site_rolling(site_month(dated)) if rolling is None else rolling
    facilities = facility_survey(mfl, dhs) if facilities is None else facilities
    located = with_caseload(with_facility(dated, facilities), txcurr)
    out = with_rolling(located, rolling)
    return out.select(*columns, *[c for c in out.columns if c not in columns and c != "period"])


def latest_sites(
    df: DataFrame, mfl: DataFrame, dhs: DataFrame, txcurr: DataFrame, rolling: DataFrame
) -> DataFrame:
    """One row per site seen in the latest month, with its facility columns.

    The columns are constant per site and month, so sites are made distinct before the lookups.
    """
    months = with_period(df).select("sitecode", "period")
    last = months.agg(F.max("period")).scalar()
    sites = months.filter(F.col("period") == last).distinct()
    located = with_caseload(with_facility(sites, facility_survey(mfl, dhs)), txcurr)
    return with_rolling(located, rolling).select(*SITE_COLUMNS)


def with_site_table(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Facility columns from the saved site table, one row per site."""
    return df.withColumn("sitecode", F.col("sitecode").cast("string")).join(
        sites.withColumn("sitecode", F.col("sitecode").cast("string")), "sitecode", "left"
    )
