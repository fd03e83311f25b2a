"""History, facility and the full feature table."""

from pyspark.sql import functions as F

from steadycare.functions.person import month_index as month_number
from steadycare.functions.person import shift_year_month
from steadycare.functions import recode as rc
from steadycare.functions.parsing import lower_names, parse_date
from steadycare.operators import facility as fc, history as hs

from .registry import query
from .views import EMR_POSITIVE, START, SURVEY

LATENESS = (
    "lastvd:i late:i late14:i late30:i lateness_last3:r lateness_last5:r lateness_last10:r late_last3:r late_last5:r "
    "late_last10:r late14_last3:r late14_last5:r late14_last10:r late30_last3:r late30_last5:r late30_last10:r"
)
VISIT_SIDE = (
    "visittype:i visitby tcareason pregnant:i pregnant_missing:i breastfeeding:i breastfeeding_missing:i "
    "stabilityassessment:i differentiatedcare whostage:r emr adherence:i sex:i age:r maritalstatus educationlevel "
    "occupation bmi regimen_switch:i startartdate month:i dayofweek:i is_friday:i daystonextappointment:i "
    "timeonart:r timeatfacility:r firstvisit:i"
)
TARGET = "key visitdate nad nad_imputation_flag:i sitecode iit:i"
SURVEY_OUT = " ".join(f"{c}:r" for c in SURVEY)
FACILITY = f"kephlevel facilitytypecategory ownertype {SURVEY_OUT}"


@query(f"{TARGET} visitdiff:i cascadestatus", "select * exclude (cascadestatus), cascadestatus from o_cascade")
def cascade(c):
    return hs.cascade(c.targets)


@query(f"{TARGET} {LATENESS}", "o_lateness")
def lateness(c):
    return hs.lateness(hs.cascade(c.targets))


@query(f"{TARGET} visitdiff:i {VISIT_SIDE}", """
select t.*, v.* exclude (key, visitdate, sitecode, nad_imputed, nad_imputation_flag)
from o_targets t asof left join o_demographics v on t.key = v.key and t.visitdate >= v.visitdate""")
def asof_visits(c):
    return hs.asof_join(c.targets, "visitdate", [hs.visits_side(c.visits)])


@query(f"{TARGET} {VISIT_SIDE} cascadestatus {LATENESS}", "o_targets_visit", staged=True)
def targets_visit(c):
    return hs.visit_history(c.targets, c.visits)


@query(f"{TARGET} optimizedhivregimen:i", "o_pharm", staged=True)
def asof_pharmacy(c):
    return hs.pharmacy_history(c.targets, c.pharmacy)


@query(f"{TARGET} most_recent_vl ahd:i", "o_history", staged=True)
def asof_labs(c):
    return hs.lab_history(hs.asof_join(c.targets, "visitdate", [hs.visits_side(c.visits)]), c.lab)


# --- facility ---


@query(f"code kephlevel county facilitytypecategory ownertype {SURVEY_OUT}", "o_mfl_dhs")
def mfl_dhs(c):
    return fc.facility_survey(c.raw["mfl"], c.raw["dhs"])


@query(
    "key visitdate sitecode period:i earlier_period:i",
    """select *, cast(strftime(date_trunc('month', visitdate) - interval 1 month, '%Y%m') as int) as earlier_period
    from o_period""",
)
def site_period(c):
    df = fc.with_period(c.targets)
    return df.withColumn("earlier_period", shift_year_month(F.col("period"), -1))


@query(
    f"key visitdate sitecode {FACILITY} county",
    "select t.*, m.* from o_targets t left join o_mfl_dhs m on t.sitecode = m.code",
)
def loc_static(c):
    return fc.with_facility(c.targets, fc.facility_survey(c.raw["mfl"], c.raw["dhs"]))


@query(
    "key visitdate sitecode period:i txcurr:r",
    "select p.*, t.txcurr from o_period p left join o_txcurr t on p.sitecode = t.sitecode and p.period = t.period",
)
def loc_caseload(c):
    return fc.with_caseload(fc.with_period(c.targets), c.raw["txcurr"])


def months(c):
    return fc.site_month(fc.with_period(hs.lateness(c.targets)))


@query("sitecode period:i last_iit:r lastvd:r count:l", "select *, n as count from o_site_month")
def site_month(c):
    return months(c)


@query("sitecode period:i rolling_weighted_noshow:r rolling_weighted_dayslate:r", "o_site_rolling")
def site_rolling(c):
    return fc.site_rolling(months(c))


@query(
    f"key visitdate sitecode {FACILITY} txcurr:r rolling_weighted_noshow:r rolling_weighted_dayslate:r",
    "o_features", staged=True,
)
def loc_rolling(c):
    late = hs.lateness(c.targets)
    return fc.facility_features(late, c.raw["mfl"], c.raw["dhs"], c.raw["txcurr"], c.rolling)


@query(
    f"sitecode rolling_weighted_noshow:r rolling_weighted_dayslate:r txcurr:r {FACILITY}",
    "o_loc_latest", staged=True, visits="",
)
def loc_latest(c):
    return c.latest_sites


@query(
    f"key visitdate sitecode most_recent_vl ahd:i rolling_weighted_noshow:r rolling_weighted_dayslate:r txcurr:r {FACILITY}",
    "select h.*, l.* exclude (sitecode) from o_history h left join o_loc_latest l using (sitecode)", staged=True, visits=" ".join(hs.LAB_INPUTS),
)
def score_context(c):
    return c.scoring_features(c.latest_sites)


FEATURES = (
    f"{TARGET} {VISIT_SIDE} cascadestatus {LATENESS} optimizedhivregimen:i most_recent_vl ahd:i code county {FACILITY} "
    "txcurr:r rolling_weighted_noshow:r rolling_weighted_dayslate:r"
)


@query(FEATURES, "o_features", staged=True)
def features_full(c):
    return c.features


# --- recodes ---


@query(
    "key nad tp:i",
    "select key, nad, (year(nad) - 1996) * 12 + month(nad) as tp from o_targets",
)
def month_index(c):
    return c.targets.withColumn("tp", month_number(F.col("nad"), START))


@query(
    "patientpkhash visitdate pregnant_flag:i breastfeeding_flag:i adherence_flag:i adherence_group sex_flag:i emr_flag:i friday_flag:i",
    f"""select v.PatientPKHash as patientpkhash, VisitDate as visitdate,
    case Pregnant when 'Yes' then 1 when 'No' then 0 end as pregnant_flag,
    case Breastfeeding when 'Yes' then 1 when 'No' then 0 end as breastfeeding_flag,
    case split_part(lower(Adherence), '|', 1) when 'good' then 1 when 'fair' then 0 when 'poor' then 0 end as adherence_flag,
    case split_part(lower(Adherence), '|', 1) when 'good' then 'optimal' when 'fair' then 'suboptimal'
     when 'poor' then 'suboptimal' else split_part(lower(Adherence), '|', 1) end as adherence_group,
    case when Sex = 'Male' then 1 else 0 end as sex_flag, case when lower(Emr) = '{EMR_POSITIVE}' then 1 else 0 end as emr_flag,
    case when dayname(try_cast(NextAppointmentDate as date)) = 'Friday' then 1 else 0 end as friday_flag
    from x_visits v join x_dem d on v.PatientPKHash = d.PatientPKHash and v.SiteCode = d.MFLCode""",
)
def recode(c):
    dem = lower_names(c.raw["dem"]).select("patientpkhash", F.col("mflcode").alias("sitecode"), "sex")
    df = lower_names(c.raw["visits"]).join(dem, ["patientpkhash", "sitecode"])
    word = F.substring_index(F.lower("adherence"), "|", 1)
    due = parse_date(F.col("nextappointmentdate"))
    return df.withColumns(
        {
            "pregnant_flag": rc.recode(F.col("pregnant"), rc.YES_NO),
            "breastfeeding_flag": rc.recode(F.col("breastfeeding"), rc.YES_NO),
            "adherence_flag": rc.recode(word, rc.ADHERENCE_BINARY),
            "adherence_group": rc.recode(word, rc.ADHERENCE_GROUP, keep_others=True),
            "sex_flag": rc.equals_flag(F.col("sex"), "Male"),
            "emr_flag": rc.equals_flag(F.lower("emr"), EMR_POSITIVE),
            "friday_flag": rc.equals_flag(F.dayname(due), "Fri"),
        }
    )


@query(
    "key visitdate pregnant breastfeeding",
    "select key, visitdate, " + ", ".join(
        f"case when {x} is null and {x}_missing = 0 then 'NR' else cast({x} as varchar) end as {x}"
        for x in ("pregnant", "breastfeeding")
    ) + " from o_visit_features",
)
def mark_nr(c):
    return c.visits.withColumns(
        {
            x: rc.mark_not_relevant(F.col(x), F.col(f"{x}_missing"))
            for x in ("pregnant", "breastfeeding")
        }
    )
