"""The clinic tables as views over the driver's tables: one SQL text for Spark and for DuckDB."""

VIEWS = {
    "x_dem": """
select 'P' || lpad(cast(c_custkey as string),8,'0') as PatientPKHash, cast(1000+c_nationkey as string) as MFLCode,
 case when c_custkey%3=0 then 'Male' else 'Female' end as Sex,
 case c_custkey%9 when 0 then 'Single' when 1 then 'Married' when 2 then 'Cohabiting' when 3 then 'Divorced' when 4 then 'Separated' when 5 then 'Widowed' when 6 then 'Married Polygamous' when 7 then 'Unknown' end as MaritalStatus,
 case c_custkey%6 when 0 then 'Primary' when 1 then 'Secondary' when 2 then 'College' when 3 then 'None' when 4 then 'University' end as EducationLevel,
 case c_custkey%8 when 0 then 'Farmer' when 1 then 'Trader' when 2 then 'Student' when 3 then 'Engineer' when 4 then 'null' when 5 then '  ' when 6 then 'None' end as Occupation,
 case c_custkey%10 when 0 then 'Died' when 1 then 'Transferred out' when 2 then 'LOSS TO FOLLOW UP' when 3 then ' Lost in HMIS ' else 'Active' end as ARTOutcomeDescription,
 case when c_custkey%29=0 then null else cast(date '1994-01-01' + cast((c_custkey*13)%2500 as int) as string) end as StartARTDate,
 cast(date '1950-01-01' + cast((c_custkey*37)%18000 as int) as string) || 'T00:00:00' as DOB
 from customer""",
    "x_visits": """
select 'P' || lpad(cast(o_custkey as string),8,'0') as PatientPKHash, cast(1000+c_nationkey as string) as SiteCode,
 case when o_orderkey%211=0 then 'invalid-date' when o_orderkey%5=0 then cast(cast(o_orderdate as date) as string) || 'T12:00:00' else cast(cast(o_orderdate as date) as string) end as VisitDate,
 case when o_orderkey%9=0 then null else cast(cast(o_orderdate as date) + cast((o_orderkey*7)%420-20 as int) as string) end as NextAppointmentDate,
 case when o_orderkey%11=0 then 'UNSCHEDULED visit' when o_orderkey%13=0 then null else 'Scheduled' end as VisitType,
 case when o_orderkey%4=0 then 'Treatment Supporter' else 'Self' end as VisitBy, 'Follow up' as TCAReason,
 case o_orderkey%4 when 0 then 'Yes' when 1 then 'No' when 2 then 'Unknown' end as Pregnant,
 case o_orderkey%3 when 0 then 'Yes' when 1 then 'No' end as Breastfeeding,
 case o_orderkey%4 when 0 then 'Stable' when 1 then 'Unstable' when 2 then 'Not stable' end as StabilityAssessment,
 case o_orderkey%5 when 0 then 'Community ART Distribution HCW Led' when 1 then 'Community ART Distribution Peer Led' when 2 then 'Fast Track' when 3 then 'Standard Care' end as DifferentiatedCare,
 case when o_orderkey%6=5 then null else cast(1+o_orderkey%4 as string) end as WHOStage,
 cast(40+o_orderkey%230 as double) as Height, cast(10+o_orderkey%200 as double) as Weight,
 case o_orderstatus when 'F' then 'SystemA' when 'O' then 'SystemB' else 'SystemC' end as Emr,
 case o_orderkey%5 when 0 then 'Good|ok' when 1 then 'Fair' when 2 then 'Poor' when 3 then '' end as Adherence,
 case when o_orderkey%7=0 then ' ' else o_orderpriority end as CurrentRegimen
 from orders join customer on o_custkey=c_custkey""",
    "x_pharmacy": """
select 'P' || lpad(cast(o_custkey as string),8,'0') as PatientPKHash, cast(1000+c_nationkey as string) as SiteCode,
 cast(case when l_linenumber=1 then cast(o_orderdate as date) else cast(l_shipdate as date) end as string) as DispenseDate,
 case when l_partkey%10=0 then null else cast(case when l_linenumber=1 then cast(o_orderdate as date) else cast(l_shipdate as date) end + cast(l_quantity*9-15 as int) as string) end as ExpectedReturn,
 case l_partkey%3 when 0 then 'TDF/3TC/DTG' when 1 then 'TDF/3TC/EFV' else 'ABC/3TC/dtg' end as Drug,
 case l_returnflag when 'A' then 'ARV' when 'R' then 'PMTCT' else 'Prophylaxis' end as TreatmentType
 from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey""",
    "x_lab": """
select 'P' || lpad(cast(o_custkey as string),8,'0') as PatientPKHash, cast(1000+c_nationkey as string) as SiteCode,
 cast(cast(date_trunc('month', l_shipdate) as date) as string) as OrderedByDate,
 case l_suppkey%5 when 0 then 'Viral Load' when 1 then 'HIV VL' when 2 then 'CD4 Count' when 3 then 'CD4 %' else 'HB' end as TestName,
 case when l_partkey%6=0 then 'LDL' when l_partkey%17=0 then null else cast(cast(l_quantity*12 as int) as string) end as TestResult
 from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey""",
    "x_mfl": """
select cast(1000+n_nationkey as string) as Code, case n_nationkey%3 when 0 then 'Level 2' when 1 then 'Level 3' else 'Level 4' end as KEPH_Level, r_name as County,
 case n_nationkey%2 when 0 then 'Dispensary' else 'Hospital' end as Facility_type_category, case n_nationkey%4 when 0 then 'Public' when 1 then 'Private' else 'FBO' end as Owner_type
 from nation join region on n_regionkey=r_regionkey""",
    "x_txcurr": """
select cast(1000+c_nationkey as string) as FacilityCode, cast(year(o_orderdate)*100+month(o_orderdate) as int) as period, count(distinct o_custkey) as indicator_value
 from orders join customer on o_custkey=c_custkey group by 1,2""",
}

# Survey indicators: the k-th one is k hundredths times the region's number.
SURVEY = (
    "men_knowledge women_knowledge men_heardaids men_highrisksex men_highrisksex_multi "
    "men_sexnotwithpartner men_sexpartners men_nevertested men_testedrecent men_sti "
    "women_heardaids women_highrisksex women_highrisksex_multi women_sexnotwithpartner "
    "women_sexpartners women_nevertested women_testedrecent women_sti"
).split()
VIEWS["x_dhs"] = (
    "select r_name as County, 'KE' as Country, 'S1' as Survey, "
    + ", ".join(
        f"cast((r_regionkey+1)*{k} as double)/100 as {name}" for k, name in enumerate(SURVEY, 1)
    )
    + " from region"
)

START, END, REFRESH = "1996-01-01", "2001-01-01", "2000-06-30"
EMR_ALLOW, EMR_POSITIVE = ("systema", "systemb"), "systema"
TABLES = ("region", "nation", "customer", "orders", "lineitem")
