"""The same steps written in SQL for DuckDB, as named common table expressions.

`with_ctes(sql)` puts the expressions a statement needs in front of it.
"""

import re

from .views import EMR_ALLOW, EMR_POSITIVE, END, REFRESH, START, SURVEY, VIEWS

ALLOWED = ", ".join(f"'{e}'" for e in EMR_ALLOW)


def day(x: str) -> str:
    head = f"substr({x}, 1, 10)"
    return rf"try_cast(case when regexp_matches({head}, '^\d{{4}}-\d{{1,2}}-\d{{1,2}}$') then {head} end as date)"


def number(x: str) -> str:
    return rf"case when regexp_matches({x}, '^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$') then try_cast(trim({x}) as double) end"


def logical(contact: str, due: str) -> str:
    return f"case when {due} - {contact} between 1 and 365 then {due} end"


def gap_group(days: str) -> str:
    return (
        f"case when {days} < 45 then 30 when {days} < 75 then 60 when {days} < 105 then 90 "
        f"when {days} < 150 then 120 when {days} < 200 then 180 else 30 end"
    )


def flag(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


VISIT_TEXT = (
    "visittype visitby tcareason pregnant breastfeeding stabilityassessment differentiatedcare "
    "whostage emr adherence currentregimen"
).split()
VISIT_TIES = (
    "patientpkhash sitecode visittype visitby tcareason pregnant breastfeeding stabilityassessment "
    "differentiatedcare whostage height weight emr adherence currentregimen"
).split()
PERSON = "sex maritalstatus educationlevel occupation artoutcomedescription startartdate dob".split()

CTES: dict[str, str] = dict(VIEWS)

CTES["o_vrows"] = f"""
select trim(PatientPKHash) || trim(SiteCode) as key, lower(trim(PatientPKHash)) as patientpkhash,
 lower(trim(SiteCode)) as sitecode, {day('VisitDate')} as visitdate, {day('NextAppointmentDate')} as due,
 Height as height, Weight as weight, {', '.join(f'lower(trim({c})) as {c}' for c in VISIT_TEXT)}
from x_visits"""
CTES["o_vwindow"] = f"""
select * exclude (due), {logical('visitdate', 'due')} as nextappointmentdate
from o_vrows where visitdate between date '{START}' and date '{END}'"""
CTES["o_vdaily"] = f"""
select * from o_vwindow qualify row_number() over (partition by key, visitdate
 order by nextappointmentdate desc nulls last, {', '.join(c + ' asc nulls first' for c in VISIT_TIES)}) = 1"""
CTES["o_dem"] = f"""
select trim(PatientPKHash) || trim(MFLCode) as key, {', '.join(f'trim(lower({c})) as {c}' for c in PERSON)}
from x_dem qualify row_number() over (partition by trim(PatientPKHash) || trim(MFLCode)
 order by {', '.join(f'trim(lower({c})) asc nulls last' for c in PERSON)}) = 1"""
CTES["o_vjoin"] = "select * from o_vdaily join o_dem using (key)"
CTES["o_clean_visits"] = f"""
select *, coalesce(nextappointmentdate, visitdate + cast(coalesce(lead({gap_group('nextappointmentdate - visitdate')})
 over (partition by key order by visitdate), 30) as int)) as nad_imputed,
 {flag('nextappointmentdate is null')} as nad_imputation_flag
from o_vjoin"""

CTES["o_prows"] = f"""
select trim(PatientPKHash) || trim(SiteCode) as key, trim(SiteCode) as sitecode, Drug as drug,
 lower(TreatmentType) as treatmenttype, {day('DispenseDate')} as dispensedate, {day('ExpectedReturn')} as due
from x_pharmacy"""
CTES["o_pwindow"] = f"""
select key, sitecode, drug, dispensedate, {logical('dispensedate', 'due')} as expectedreturn
from o_prows where treatmenttype in ('arv', 'pmtct') and dispensedate between date '{START}' and date '{END}'"""
CTES["o_clean_pharmacy"] = f"""
select key, sitecode, dispensedate, drug, coalesce(expectedreturn, dispensedate + cast(coalesce(
 lead({gap_group('expectedreturn - dispensedate')}) over (partition by key order by dispensedate), 30) as int)) as nad_imputed,
 {flag('expectedreturn is null')} as nad_imputation_flag
from (select * from o_pwindow qualify row_number() over (partition by key, dispensedate
 order by expectedreturn desc nulls last, drug nulls first, sitecode nulls first) = 1)"""

CTES["o_lrows"] = f"""
select trim(PatientPKHash) || trim(SiteCode) as key, {day('OrderedByDate')} as orderedbydate,
 case when lower(TestName) like '%cd4%' and lower(TestName) not like '%\\%%' escape '\\'
  and lower(TestName) not like '%percent%' then 'CD4'
  when lower(TestName) like '%viral%' or lower(TestName) like '%vl%' then 'VL' else 'Other' end as testname,
 TestResult as testresult, {number('TestResult')} as num
from x_lab"""
CTES["o_lwindow"] = f"""
select *, case testname when 'VL' then case when num >= 200 then 'nonsuppressed' else 'suppressed' end
 when 'CD4' then case when num < 200 then 'NoAHD' when num >= 200 then 'YesAHD' end end as cat
from o_lrows where orderedbydate >= date '{START}' and testname in ('CD4', 'VL')"""
CTES["o_lcounted"] = """
select *, count(*) over g as lab_count from o_lwindow
window g as (partition by key, orderedbydate, testname)"""
CTES["o_clean_lab"] = """
select key, orderedbydate, testname, cat as testresultcat from (
 select *, count(num) over g as nums, min(cat) over g as lo, max(cat) over g as hi
 from o_lcounted where testname = 'VL' or num is not null
 window g as (partition by key, orderedbydate, testname))
where lab_count = 1 or (nums = 1 and num is not null) or (nums > 1 and lo = hi)"""
CTES["o_lab_daily"] = "select distinct * from o_clean_lab"


def _nullable(c: str) -> str:
    return f"nullif({c}, '')"


def _status(c: str) -> str:
    return (
        f"case when fertile then case when lower({c}) like '%yes%' then 1 "
        f"when lower({c}) like '%no%' then 0 end end"
    )


CTES["o_vaged"] = rf"""
select *, {day('dob')} as born, {day('startartdate')} as startart,
 (visitdate - {day('dob')}) / 365.25::double as age, {flag("sex = 'male'")} as male,
 regexp_replace(replace(split_part(adherence, '|', 1), 'good', '1'), 'fair|poor', '0', 'g') as adh
from o_clean_visits"""
CTES["o_vbody"] = """
select *, coalesce(age between 15 and 49 and male = 0, false) as fertile,
 case when height between 50 and 250 and weight between 20 and 200 and age >= 15
  then weight / ((height / 100) * (height / 100)) end as bmi_value
from o_vaged where age >= 0"""
CTES["o_visit_features"] = rf"""
select key, sitecode, visitdate, {flag("visittype like '%unscheduled%'")} as visittype,
 {_nullable('visitby')} as visitby, {_nullable('tcareason')} as tcareason,
 {_status('pregnant')} as pregnant, {flag(f"fertile and ({_status('pregnant')}) is null")} as pregnant_missing,
 {_status('breastfeeding')} as breastfeeding,
 {flag(f"fertile and ({_status('breastfeeding')}) is null")} as breastfeeding_missing,
 case when coalesce(stabilityassessment, '') = '' then null
  when stabilityassessment like '%un%' or stabilityassessment like '%not%' then 0 else 1 end as stabilityassessment,
 case when differentiatedcare like '%community art distribution%' then 'community art distribution'
  else {_nullable('differentiatedcare')} end as differentiatedcare,
 {number('whostage')} as whostage, {_nullable('emr')} as emr,
 case when adh in ('0', '1') then cast(adh as int) end as adherence, male as sex, age,
 {_nullable('maritalstatus')} as maritalstatus, {_nullable('educationlevel')} as educationlevel,
 {_nullable('occupation')} as occupation, nad_imputed, nad_imputation_flag,
 case when age < 15 then 'Under15' when bmi_value < 18.5 then 'Underweight' when bmi_value < 25 then 'Normalweight'
  when bmi_value < 30 then 'Overweight' when bmi_value >= 30 then 'Obese' end as bmi,
 case when count(nullif(currentregimen, '')) over yr = 0 then null
  when min(nullif(currentregimen, '')) over yr = max(nullif(currentregimen, '')) over yr then 0 else 1 end as regimen_switch,
 startart as startartdate
from o_vbody
window yr as (partition by key order by visitdate range between interval 365 days preceding and current row)"""
CTES["o_demographics"] = """
select * exclude (maritalstatus, occupation, educationlevel),
 case when age < 15 then 'minor' when maritalstatus like '%poly%' then 'polygamous'
  when maritalstatus like '%single%' then 'single'
  when maritalstatus like '%married%' or maritalstatus like '%cohabit%' then 'married'
  when maritalstatus like '%divorced%' or maritalstatus like '%separated%' then 'divorced'
  when maritalstatus like '%widowed%' then 'widowed' when maritalstatus = 'minor' then 'minor' end as maritalstatus,
 case when occupation is null or trim(occupation) = '' or occupation = 'null' then null
  when occupation in ('farmer','trader','student','driver','employee','none','other') then occupation else 'other' end as occupation,
 case when educationlevel in ('none','primary','secondary','college') then educationlevel end as educationlevel,
 month(nad_imputed) as month, isodow(nad_imputed) - 1 as dayofweek,
 case when isodow(nad_imputed) = 5 then 1 else 0 end as is_friday,
 nad_imputed - visitdate as daystonextappointment,
 case when visitdate < startartdate then 0.0::double else (visitdate - startartdate) / 30.44::double end as timeonart,
 (visitdate - min(visitdate) over (partition by key)) / 30.44::double as timeatfacility,
 case when visitdate = min(visitdate) over (partition by key) then 1 else 0 end as firstvisit
from o_visit_features"""

CTES["o_stacked"] = """
select key, visitdate, nad_imputed as nad, nad_imputation_flag, sitecode, 'clinical' as type from o_demographics
union all by name
select key, dispensedate as visitdate, nad_imputed as nad, nad_imputation_flag, sitecode, 'pharmacy' as type
from o_clean_pharmacy"""
CTES["o_contacts"] = """
select s.key, s.visitdate, s.nad, s.nad_imputation_flag, s.sitecode, s.type, o_dem.artoutcomedescription from (
 select * exclude (type, rows_here), case when rows_here > 1 then 'both' else type end as type from (
  select *, count(*) over (partition by key, visitdate) as rows_here from o_stacked)
 qualify row_number() over (partition by key, visitdate order by nad_imputation_flag, nad desc) = 1) s
left join o_dem using (key) where s.type <> 'pharmacy'"""
CTES["o_monotone"] = """
select * exclude (nad, nad_imputation_flag, highest), highest as nad,
 case when nad_imputation_flag = 1 or highest <> nad then 1 else 0 end as nad_imputation_flag
from (select *, max(nad) over (partition by key order by visitdate) as highest from o_contacts)"""
CTES["o_diff"] = """
select *, actualreturndate - nad as visitdiff,
 case when actualreturndate - nad > 30 then 1 else 0 end as iit
from (select *, row_number() over (partition by key order by visitdate desc) - 1 as num_visit,
 lead(visitdate) over (partition by key order by visitdate) as actualreturndate from o_monotone)"""
CTES["o_last"] = """
select c.* exclude (iit), 1 as iit from o_diff c
join (select sitecode, max(visitdate) as latest from o_diff group by sitecode) s using (sitecode)
where num_visit = 0 and nad + 30 <= latest
 and artoutcomedescription in ('active', 'loss to follow up', 'lost in hmis')"""
CTES["o_targets"] = """
select key, visitdate, nad, nad_imputation_flag, sitecode, visitdiff, iit from o_diff where num_visit > 0
union all by name
select key, visitdate, nad, nad_imputation_flag, sitecode, visitdiff, iit from o_last"""
CTES["o_targets_alone"] = """
select key, visitdate, nad, nad_imputation_flag, sitecode, visitdiff, iit from o_diff where num_visit > 0"""

ROLLING = ", ".join(
    f"avg(lastvd) over w{n} as lateness_last{n}, "
    + ", ".join(f"cast(sum({f}) over w{n} as double) as {f}_last{n}" for f in ("late", "late14", "late30"))
    for n in (3, 5, 10)
)
FRAMES = ", ".join(
    f"w{n} as (partition by key order by visitdate rows between {n - 1} preceding and current row)"
    for n in (3, 5, 10)
)


def history_ctes(base: str, suffix: str) -> None:
    """Cascade, lateness, and as-of history over a table of targets."""
    CTES[f"o_cascade{suffix}"] = f"""
select * exclude (prev, restart), case when restart is null then 'neverdisengaged'
 when (visitdate - restart) / 30.0::double <= 6 then 'shorttermrestart' else 'longtermrestart' end as cascadestatus
from (select *, max(case when prev = 1 then visitdate end) over (partition by key order by visitdate) as restart
 from (select *, lag(iit) over (partition by key order by visitdate) as prev from {base}))"""
    CTES[f"o_lateness{suffix}"] = f"""
select *, {ROLLING} from (
 select *, case when lastvd > 0 then 1 else 0 end as late, case when lastvd > 14 then 1 else 0 end as late14,
  case when lastvd > 30 then 1 else 0 end as late30 from (
   select * exclude (visitdiff), lag(case when visitdiff is not null then least(greatest(visitdiff, 0), 100) end)
    over (partition by key order by visitdate) as lastvd from o_cascade{suffix}))
window {FRAMES}"""
    CTES[f"o_targets_visit{suffix}"] = f"""
select t.*, v.* exclude (key, visitdate, sitecode, nad_imputed, nad_imputation_flag)
from o_lateness{suffix} t asof left join o_demographics v on t.key = v.key and t.visitdate >= v.visitdate"""
    CTES[f"o_pharm{suffix}"] = f"""
select t.*, p.optimizedhivregimen from o_targets_visit{suffix} t asof left join (
 select key, dispensedate, case when drug like '%DTG%' then 1 else 0 end as optimizedhivregimen from o_clean_pharmacy) p
on t.key = p.key and t.visitdate >= p.dispensedate"""
    CTES[f"o_history{suffix}"] = f"""
select * exclude (vl, cd4, vl_date, cd4_date),
 case when vl is not null and visitdate - vl_date <= 365 then vl when timeonart <= 6 then 'earlyart'
  when timeonart > 6 and timeatfacility <= 6 then 'restart' else 'novalidvl' end as most_recent_vl,
 case when coalesce(age < 5, false) or coalesce(cd4 = 'YesAHD' and visitdate - cd4_date <= 365, false)
  or coalesce(whostage in (3, 4), false) then 1 else 0 end as ahd
from (select a.*, c.cat as cd4, c.at as cd4_date from (
 select t.*, l.cat as vl, l.at as vl_date from o_pharm{suffix} t asof left join (
  select key, orderedbydate as at, testresultcat as cat from o_lab_daily where testname = 'VL') l
 on t.key = l.key and t.visitdate >= l.at) a asof left join (
  select key, orderedbydate as at, testresultcat as cat from o_lab_daily where testname = 'CD4') c
 on a.key = c.key and a.visitdate >= c.at)"""


history_ctes("o_targets", "")
history_ctes("o_targets_alone", "_alone")

CTES["o_mfl_dhs"] = f"""
select m.Code as code, m.KEPH_Level as kephlevel, m.County as county, m.Facility_type_category as facilitytypecategory,
 m.Owner_type as ownertype, {', '.join('d.' + c for c in SURVEY)}
from x_mfl m left join x_dhs d on m.County = d.County"""
CTES["o_period"] = "select *, year(visitdate) * 100 + month(visitdate) as period from o_lateness"
CTES["o_site_month"] = """
select sitecode, period, avg(case when lastvd > 30 then 1 else 0 end) as last_iit, avg(lastvd) as lastvd,
 count(lastvd) as n from o_period group by sitecode, period"""
CTES["o_site_rolling"] = """
select sitecode, period as own_period,
 cast(strftime(make_date(period // 100, period % 100, 1) - interval 1 month, '%Y%m') as int) as period,
 case when sum(n) over w > 0 then sum(last_iit * n) over w / sum(n) over w end as rolling_weighted_noshow,
 case when sum(n) over w > 0 and count(lastvd) over w = count(*) over w
  then sum(lastvd * n) over w / sum(n) over w end as rolling_weighted_dayslate
from o_site_month
window w as (partition by sitecode order by period rows between 5 preceding and current row)"""
CTES["o_txcurr"] = "select FacilityCode as sitecode, period, indicator_value as txcurr from x_txcurr"
CTES["o_features"] = """
select h.*, m.*, t.txcurr, r.rolling_weighted_noshow, r.rolling_weighted_dayslate
from (select *, year(visitdate) * 100 + month(visitdate) as period from o_history) h
left join o_mfl_dhs m on h.sitecode = m.code
left join o_txcurr t on h.sitecode = t.sitecode and h.period = t.period
left join o_site_rolling r on h.sitecode = r.sitecode and h.period = r.period"""
CTES["o_loc_latest"] = """
select s.sitecode, r.rolling_weighted_noshow, r.rolling_weighted_dayslate, t.txcurr, m.* exclude (code, county)
from (select distinct sitecode, period from o_period where period = (select max(period) from o_period)) s
left join o_mfl_dhs m on s.sitecode = m.code
left join o_txcurr t on s.sitecode = t.sitecode and s.period = t.period
left join o_site_rolling r on s.sitecode = r.sitecode and s.period = r.period"""


def in_window(table: str) -> str:
    """Rows of the refresh window with a stated due date and a known record system."""
    return f"""
select * exclude (emr), case when emr = '{EMR_POSITIVE}' then 1 else 0 end as emr from {table}
where nad between date '{REFRESH}' - interval 6 month and date '{REFRESH}'
 and nad_imputation_flag = 0 and emr in ({ALLOWED})"""


CTES["o_model_rows"] = in_window("o_features")
CTES["o_pool"] = in_window("o_targets_visit")
CTES["o_split"] = f"""
select *, 'train' as slice from o_pool
 where nad between date '{REFRESH}' - interval 6 month and date '{REFRESH}' - interval 1 month
union all
select *, 'val' as slice from o_pool where nad between date '{REFRESH}' - interval 1 month and date '{REFRESH}'"""
CTES["o_scored"] = """
select key, visitdate, nad, sitecode, iit, coalesce(lateness_last5, 0) / 100 as score from o_split where slice = 'val'"""
CTES["o_top_sites"] = """
select sitecode, count(*) as n_rows from o_pool group by sitecode order by n_rows desc, sitecode limit 100"""
CTES["o_site_thresholds"] = """
select p.sitecode, coalesce(s.high, g.high) as high, coalesce(s.medium, g.medium) as medium
from (select distinct sitecode from o_pool union all select '*') p
left join (select sitecode, quantile_cont(score, 0.75) as high, quantile_cont(score, 0.5) as medium from o_scored
 where sitecode in (select sitecode from o_top_sites) group by sitecode) s using (sitecode)
cross join (select quantile_cont(score, 0.75) as high, quantile_cont(score, 0.5) as medium from o_scored) g"""
CTES["o_categorised"] = """
select s.*, coalesce(t.high, g.high) as high, coalesce(t.medium, g.medium) as medium,
 case when score > coalesce(t.high, g.high) then 'high' when score > coalesce(t.medium, g.medium) then 'medium'
  else 'low' end as pred_cat
from o_scored s left join o_site_thresholds t on s.sitecode = t.sitecode
cross join (select * from o_site_thresholds where sitecode = '*') g"""


def reported(suffix: str) -> str:
    """Latest row per patient with score, category and risk factors."""
    return f"""
select key, visitdate, nad, sitecode, score, pred_cat,
 case when pred_cat <> 'low' then lateness_last5 end as avg_days_late_last5visits,
 case when pred_cat <> 'low' then timeonart end as months_on_art,
 case when pred_cat <> 'low' then most_recent_vl end as most_recent_viralload,
 case when pred_cat <> 'low' then case adherence when 1 then 'good' when 0 then 'poor' end end as adherence,
 case when pred_cat <> 'low' then case when visittype = 1 then 'unscheduled visits' else 'no unscheduled visits' end end as unscheduled_visits
from (select h.*, case when score > coalesce(t.high, g.high) then 'high'
  when score > coalesce(t.medium, g.medium) then 'medium' else 'low' end as pred_cat
 from (select *, coalesce(lateness_last5, 0) / 100 as score from o_history{suffix} where emr in ({ALLOWED})
  qualify row_number() over (partition by key order by nad desc, visitdate desc) = 1) h
 left join o_site_thresholds t on h.sitecode = t.sitecode
 cross join (select * from o_site_thresholds where sitecode = '*') g)"""


CTES["o_reported"] = reported("")
CTES["o_reported_alone"] = reported("_alone")
CTES["o_curve"] = """
select score, tp, n_through, hits, n, tp / n_through as precision, tp / total_hits as recall,
 (n_through - tp) / (total - total_hits) as fpr,
 case when n_through > n then (tp - hits) / (n_through - n) else 1.0::double end as precision_before,
 total_hits, total
from (select score, hits, n, sum(hits) over w as tp, sum(n) over w as n_through,
  sum(hits) over () as total_hits, sum(n) over () as total
 from (select score, sum(iit)::double as hits, count(*)::double as n from o_scored group by score)
 window w as (order by score desc))"""


def for_period(root: str, kept: str, suffix: str, end: str) -> None:
    """Copies of an expression and of all it uses, but for `kept`, for a study period with another end."""
    names: list[str] = []

    def visit(name: str) -> None:
        if name in CTES and name != kept and name not in names:
            names.append(name)
            for other in re.findall(r"\bo_\w+", CTES[name]):
                visit(other)

    visit(root)
    for name in names:
        text = re.sub(r"\bo_\w+", lambda m: m[0] + suffix if m[0] in names else m[0], CTES[name])
        CTES[name + suffix] = text.replace(f"date '{END}'", f"date '{end}'")


SHORT_END = "2000-01-31"
for_period("o_reported_alone", "o_site_thresholds", "_short", SHORT_END)


def with_ctes(sql: str) -> str:
    """The statement with the expressions it uses, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[ox]_\w+", text):
            if name in CTES and name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    return "with " + ",\n".join(f"{n} as ({CTES[n].strip()})" for n in order) + "\n" + sql
