"""Sources, cleaning, scalar features, labels."""

import uuid

from pyspark.sql import functions as F

from steadycare.functions import clinical, person, recode
from steadycare.functions.parsing import blank_to_null as null_blanks
from steadycare.functions.parsing import lower_names, map_strings, parse_date, parse_number
from steadycare.functions.recode import coerce_numeric as to_numbers
from steadycare.operators import clean, dedup, targets as tg, visits as vs
from steadycare.sources.layout import PatientTables
from steadycare.sources.readers import requested_rows
from steadycare.sources.schemas import conform
from steadycare.sources.staging import shared_folder

from .oracle import day, flag, gap_group as sql_gap_group, logical, number
from .registry import query
from .views import END, START

RAW_VISIT = (
    "patientpkhash sitecode visitdate nextappointmentdate visittype visitby tcareason pregnant "
    "breastfeeding stabilityassessment differentiatedcare whostage height:r weight:r emr adherence "
    "currentregimen"
)
ACTIVE = "lower(trim(artoutcomedescription)) = 'active'"


def requests(c):
    """Requests for every patient whose recorded outcome is active."""
    dem = lower_names(c.raw["dem"]).filter(ACTIVE)
    return dem.select("patientpkhash", F.col("mflcode").alias("sitecode"))


# --- sources ---


@query(RAW_VISIT, "x_visits")
def src_visits(c):
    return conform(c.raw["visits"], "visits")


@query("facilitycode period:i indicator_value:r", "x_txcurr")
def src_txcurr(c):
    return conform(c.raw["txcurr"], "txcurr")


@query(
    "patientpkhash sitecode orderedbydate testname testresult",
    f"select * from x_lab v where exists (select 1 from x_dem d where d.PatientPKHash = v.PatientPKHash "
    f"and d.MFLCode = v.SiteCode and {ACTIVE})",
)
def src_point_read(c):
    return requested_rows(c.raw["lab"], requests(c))


@query(
    "patientpkhash sitecode dispensedate expectedreturn drug treatmenttype",
    f"select * from x_pharmacy v where PatientPKHash in (select PatientPKHash from x_dem where {ACTIVE})",
)
def src_patient_read(c):
    return requested_rows(c.raw["pharmacy"], requests(c), by_site=False)


@query(
    "patientpkhash sitecode orderedbydate testname testresult",
    f"select * from x_lab v where exists (select 1 from x_dem d where d.PatientPKHash = v.PatientPKHash "
    f"and d.MFLCode = v.SiteCode and {ACTIVE} and d.PatientPKHash like 'P%7')",
)
def src_bucket_read(c):
    """Laboratory rows of some patients, from a table laid out by patient."""
    spark = c.raw["lab"].sparkSession
    folder = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    tables = PatientTables(spark, folder, names=("lab",)).write_all(c.raw)
    few = requests(c).where("patientpkhash LIKE 'P%7'")
    return requested_rows(tables.of_patients("lab", few), few)


# --- columns, filters ---


@query("key patientpkhash sitecode", "select trim(PatientPKHash) || trim(SiteCode) as key, * from x_visits")
def patient_key(c):
    return dedup.with_key(lower_names(c.raw["visits"]))


@query("key patientpkhash mflcode sex", "select trim(PatientPKHash) || trim(MFLCode) as key, * from x_dem")
def dem_key(c):
    return dedup.with_key(lower_names(c.raw["dem"]))


@query(
    "patientpkhash visitdate parsed_visit parsed_due",
    f"select *, {day('VisitDate')} as parsed_visit, {day('NextAppointmentDate')} as parsed_due from x_visits",
)
def parse_dates(c):
    df = lower_names(c.raw["visits"])
    return df.withColumns(
        {
            "parsed_visit": parse_date(F.col("visitdate")),
            "parsed_due": parse_date(F.col("nextappointmentdate")),
        }
    )


@query(
    "patientpkhash orderedbydate testname",
    f"select PatientPKHash, {day('OrderedByDate')} as orderedbydate, TestName from x_lab "
    f"where {day('OrderedByDate')} >= date '{START}'",
)
def lab_window(c):
    df = lower_names(c.raw["lab"])
    df = df.withColumn("orderedbydate", parse_date(F.col("orderedbydate")))
    return df.filter(F.col("orderedbydate") >= clean.day(START))


@query("key sitecode drug dispensedate expectedreturn", "o_pwindow")
def pharmacy_window(c):
    return clean.pharmacy_records(c.raw["pharmacy"], START, END)


@query(
    "patientpkhash dispensedate drug treatmenttype",
    "select * from x_pharmacy where lower(TreatmentType) in ('arv', 'pmtct')",
)
def pharmacy_arv(c):
    return clean.treatment_only(lower_names(c.raw["pharmacy"]))


@query("key orderedbydate testname number:r", "select *, num as number from o_lwindow")
def lab_classify(c):
    return clean.lab_results(c.raw["lab"], START)


@query(
    "key patientpkhash sitecode visitdate nextappointmentdate visittype visitby tcareason pregnant "
    "breastfeeding stabilityassessment differentiatedcare whostage emr adherence currentregimen",
    "o_vwindow",
)
def visits_lower(c):
    return clean.visit_records(c.raw["visits"], START, END)


@query(
    "patientpkhash visittype adherence currentregimen",
    "select PatientPKHash, " + ", ".join(
        rf"case when regexp_matches({x}, '^\s*$') then null else {x} end as {x}"
        for x in ("VisitType", "Adherence", "CurrentRegimen")
    ) + " from x_visits",
)
def blank_to_null(c):
    return map_strings(lower_names(c.raw["visits"]), null_blanks)


@query(
    "key visitdate stated logical_due",
    f"select key, visitdate, due as stated, {logical('visitdate', 'due')} as logical_due from o_vrows",
)
def illogical_dates(c):
    df = dedup.with_key(lower_names(c.raw["visits"]))
    visit, due = parse_date(F.col("visitdate")), parse_date(F.col("nextappointmentdate"))
    return df.select(
        "key", visit.alias("visitdate"), due.alias("stated"),
        clinical.logical_due(visit, due).alias("logical_due"),
    )


@query(
    "patientpkhash visittype:i pregnant:i whostage:r adherence:i emr:i visitby currentregimen",
    "select PatientPKHash, " + ", ".join(
        f"cast({number(x)} as int) as {x}" for x in ("visittype", "pregnant", "adherence", "emr")
    ) + f", {number('whostage')} as whostage, visitby, currentregimen from x_visits",
)
def expected_types(c):
    return recode.cast_expected(lower_names(c.raw["visits"]))


@query("patientpkhash testname testresult:r", f"select PatientPKHash, TestName, {number('TestResult')} as testresult from x_lab")
def coerce_numeric(c):
    return to_numbers(lower_names(c.raw["lab"]), ["testresult"])


# --- scalar features ---

JOINED_VISIT = "select * from o_vjoin"


def joined(c):
    """One row per patient and day with demographics."""
    daily = clean.daily_visits(c.raw["visits"], START, END)
    return daily.join(clean.clean_people(c.raw["dem"]), "key")


@query(
    "key visitdate sex maritalstatus educationlevel occupation artoutcomedescription startartdate dob emr",
    "select * from o_vwindow join o_dem using (key)",
)
def visits_dem(c):
    records = clean.visit_records(c.raw["visits"], START, END)
    return records.join(clean.clean_people(c.raw["dem"]), "key")


@query(
    "key visitdate adherence adherence_flag:i",
    r"""select key, visitdate, adherence, case split_part(adherence, '|', 1) when 'good' then 1 when 'fair' then 0
    when 'poor' then 0 end as adherence_flag from o_vwindow""",
)
def f_adherence(c):
    df = clean.visit_records(c.raw["visits"], START, END)
    return df.withColumn("adherence_flag", clinical.adherence(F.col("adherence")))


@query(
    "key visitdate visittype unscheduled:i",
    f"select *, {flag("visittype like '%unscheduled%'")} as unscheduled from o_vwindow",
)
def f_visittype(c):
    df = clean.visit_records(c.raw["visits"], START, END)
    return df.withColumn("unscheduled", clinical.unscheduled(F.col("visittype")))


@query(
    "key visitdate stabilityassessment stable:i",
    """select *, case stabilityassessment when 'stable' then 1 when 'unstable' then 0 when 'not stable' then 0 end
    as stable from o_vwindow""",
)
def f_stability(c):
    df = clean.visit_records(c.raw["visits"], START, END)
    return df.withColumn("stable", clinical.stability(F.col("stabilityassessment")))


@query(
    "key visitdate differentiatedcare delivery",
    """select *, case when starts_with(differentiatedcare, 'community art distribution')
    then 'community art distribution' else differentiatedcare end as delivery from o_vwindow""",
)
def f_diffcare(c):
    df = clean.visit_records(c.raw["visits"], START, END)
    return df.withColumn("delivery", clinical.delivery_model(F.col("differentiatedcare")))


@query("key visitdate stage:r", "select *, try_cast(whostage as double) as stage from o_vwindow")
def f_who(c):
    df = clean.visit_records(c.raw["visits"], START, END)
    return df.withColumn("stage", clinical.who_stage(F.col("whostage")))


def aged(c):
    df = joined(c).withColumn("dob", parse_date(F.col("dob")))
    return vs.with_age(df).withColumn("male", clinical.sex_flag(F.col("sex")))


@query("key visitdate age:r", "o_vbody")
def f_age(c):
    return aged(c)


@query("key visitdate sex male:i", "select *, case when sex = 'male' then 1 else 0 end as male from o_vjoin")
def f_sex(c):
    return joined(c).withColumn("male", clinical.sex_flag(F.col("sex")))


def _reproductive(column):
    def plan(c):
        df = aged(c)
        status = clinical.reproductive_status(F.col(column), F.col("age"), F.col("male"))
        missing = clinical.reproductive_missing(status, F.col("age"), F.col("male"))
        return df.withColumns({"status": status, "status_missing": missing})

    return plan


_STATUS = """select key, visitdate, {c} as {c}, case when fertile and {c} = 'yes' then 1
 when fertile and {c} in ('no', 'unknown') then 0 end as status,
 case when fertile and coalesce({c} not in ('yes', 'no', 'unknown'), true) then 1 else 0 end as status_missing from o_vbody"""


@query("key visitdate pregnant status:i status_missing:i", _STATUS.format(c="pregnant"))
def f_pregnancy(c):
    return _reproductive("pregnant")(c)


@query("key visitdate breastfeeding status:i status_missing:i", _STATUS.format(c="breastfeeding"))
def f_breastfeeding(c):
    return _reproductive("breastfeeding")(c)


@query("key visitdate height:r weight:r age:r bmi", """select b.*, f.bmi from o_vbody b join o_visit_features f using (key, visitdate)""")
def f_bmi(c):
    mass = clinical.body_mass(F.col("height"), F.col("weight"), F.col("age"))
    return aged(c).withColumn("bmi", mass).withColumn("bmi", clinical.bmi_band(F.col("bmi"), F.col("age")))


@query("key visitdate maritalstatus", "o_demographics")
def f_marital(c):
    return aged(c).withColumn("maritalstatus", person.marital_status(F.col("maritalstatus"), F.col("age")))


@query(
    "key visitdate occupation",
    """select key, visitdate, case when nullif(occupation, '') is null or occupation = 'null' then null
    when occupation = 'engineer' then 'other' else occupation end as occupation from o_vjoin""",
)
def f_occupation(c):
    return joined(c).withColumn("occupation", person.occupation(F.col("occupation")))


@query(
    "key visitdate educationlevel",
    "select key, visitdate, nullif(educationlevel, 'university') as educationlevel from o_vjoin",
)
def f_education(c):
    return joined(c).withColumn("educationlevel", person.education_level(F.col("educationlevel")))


@query("key visitdate nad_imputed month:i dayofweek:i is_friday:i daystonextappointment:i", "o_demographics")
def f_calendar(c):
    return c.visits


@query("key visitdate startartdate timeonart:r", "o_demographics")
def f_timeonart(c):
    return c.visits


@query("key visitdate timeatfacility:r firstvisit:i", "o_demographics")
def f_tenure(c):
    return c.visits


@query("key visitdate regimen_switch:i", "o_visit_features")
def regimen_switch(c):
    return vs.visit_features(clean.clean_visits(c.raw["visits"], c.raw["dem"], START, END))


@query(
    "key dispensedate drug optimized:i",
    "select *, case when drug like '%DTG%' then 1 else 0 end as optimized from o_pwindow",
)
def f_regimen(c):
    df = clean.pharmacy_records(c.raw["pharmacy"], START, END)
    return df.withColumn("optimized", clinical.optimised_regimen(F.col("drug")))


@query("key orderedbydate testname category", "select *, cat as category from o_lwindow")
def lab_category(c):
    df = clean.lab_results(c.raw["lab"], START)
    return df.withColumn("category", clinical.lab_category(F.col("testname"), F.col("number")))


@query(
    "key visitdate gap:i gap_group:i",
    f"select key, visitdate, nextappointmentdate - visitdate as gap, {sql_gap_group('nextappointmentdate - visitdate')} as gap_group from o_vwindow",
)
def gap_group(c):
    df = clean.visit_records(c.raw["visits"], START, END)
    gap = F.datediff("nextappointmentdate", "visitdate")
    return df.withColumns({"gap": gap, "gap_group": clinical.due_gap_group(gap)})


# --- dedup, imputation, composed cleaning ---


@query("key visitdate nextappointmentdate visittype visitby whostage height:r emr adherence currentregimen", "o_vdaily")
def dedup_visits(c):
    return clean.daily_visits(c.raw["visits"], START, END)


@query("key visitdate nextappointmentdate nad_imputed nad_imputation_flag:i", "o_clean_visits")
def impute_due(c):
    return clean.clean_visits(c.raw["visits"], c.raw["dem"], START, END)


@query("key orderedbydate testname testresultcat", "o_lab_daily")
def lab_dedup(c):
    return c.lab


@query("key orderedbydate testname testresultcat", "o_clean_lab")
def clean_lab(c):
    return clean.clean_lab(c.raw["lab"], START)


@query("key sitecode dispensedate nad_imputed nad_imputation_flag:i drug", "o_clean_pharmacy")
def clean_pharmacy(c):
    return clean.clean_pharmacy(c.raw["pharmacy"], START, END)


@query(
    "key patientpkhash sitecode visitdate nextappointmentdate visittype visitby tcareason pregnant breastfeeding "
    "stabilityassessment differentiatedcare whostage height:r weight:r emr adherence currentregimen sex "
    "maritalstatus educationlevel occupation artoutcomedescription startartdate dob nad_imputed "
    "nad_imputation_flag:i",
    "o_clean_visits",
)
def clean_visits(c):
    return clean.clean_visits(c.raw["visits"], c.raw["dem"], START, END)


VISIT_FEATURES = (
    "key sitecode visitdate visittype:i visitby tcareason pregnant:i pregnant_missing:i breastfeeding:i "
    "breastfeeding_missing:i stabilityassessment:i differentiatedcare whostage:r emr adherence:i sex:i age:r "
    "maritalstatus educationlevel occupation nad_imputed nad_imputation_flag:i bmi regimen_switch:i startartdate"
)


@query(VISIT_FEATURES, "o_visit_features")
def visit_features(c):
    return vs.visit_features(clean.clean_visits(c.raw["visits"], c.raw["dem"], START, END))


@query(
    VISIT_FEATURES + " month:i dayofweek:i is_friday:i daystonextappointment:i timeonart:r timeatfacility:r firstvisit:i",
    "o_demographics",
)
def demographics(c):
    return c.visits


# --- labels ---


@query("key visitdate nad nad_imputation_flag:i sitecode type artoutcomedescription", "o_contacts")
def contacts(c):
    merged = tg.merge_contacts(tg.stack_contacts(c.visits, c.pharmacy))
    return merged.join(tg.outcomes(c.raw["dem"]), "key", "left")


@query("key visitdate nad nad_imputation_flag:i", "o_monotone")
def due_monotone(c):
    return tg.due_never_earlier(tg.merge_contacts(tg.stack_contacts(c.visits, c.pharmacy)))


@query("key visitdate nad num_visit:i actualreturndate visitdiff:i iit:i", "o_diff")
def target_diff(c):
    return tg.visit_number(c.contacts)


@query("key visitdate nad sitecode visitdiff:i iit:i artoutcomedescription", "o_last")
def target_last(c):
    return tg.resolve_last(c.contacts, c.sites).filter("actualreturndate is null")


@query("key visitdate nad nad_imputation_flag:i sitecode visitdiff:i iit:i", "o_targets")
def targets(c):
    return tg.create_targets(c.visits, c.pharmacy, c.raw["dem"])
