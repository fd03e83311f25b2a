"""Cleaning, duplicates, imputed due dates, labels."""

from datetime import date

import pytest

from steadycare.operators import clean, dedup, targets, visits

LAB = "PatientPKHash string, SiteCode string, OrderedByDate string, TestName string, TestResult string"
PHARMACY = (
    "PatientPKHash string, SiteCode string, DispenseDate string, ExpectedReturn string, Drug string, TreatmentType string"
)
CONTACT = "key string, visitdate date, nad_imputed date, nad_imputation_flag int, sitecode string"
DISPENSE = "key string, dispensedate date, nad_imputed date, nad_imputation_flag int, sitecode string"
PEOPLE = "key string, sex string, maritalstatus string, educationlevel string, occupation string, artoutcomedescription string, startartdate string, dob string"


def person(key, outcome):
    return (key, None, None, None, None, outcome, None, None)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_text_cd4_is_dropped(frame):
    df = frame(LAB, ("p", "1", "2023-01-01", "cd4 test", "result1"))
    assert clean.clean_lab(df, "2020-01-01").count() == 0


@pytest.mark.parametrize(
    "results, kept",
    [
        (["100"], ["suppressed"]),
        (["LDL", "500"], ["nonsuppressed"]),  # the only number wins
        (["100", "150"], ["suppressed"] * 2),  # agreeing results are all kept
        (["100", "150", "LDL"], ["suppressed"] * 3),
        (["100", "500"], []),
        (["LDL", "LDL"], []),  # repeated, no number
        (["LDL", "300", "400"], []),  # the text result counts as suppressed
    ],
)
def test_viral_load_groups(frame, results, kept):
    df = frame(LAB, *[("p", "1", "2023-01-01", "Viral Load", r) for r in results])
    assert [r["testresultcat"] for r in clean.clean_lab(df, "2020-01-01").collect()] == kept
    assert [r["testresultcat"] for r in clean.clean_lab_daily(df, "2020-01-01").collect()] == kept[:1]


def test_cd4_group_counts_text_as_repeat(frame):
    df = frame(LAB, *[("p", "1", "2023-01-01", "CD4", r) for r in ("x", "300")])
    assert [r["testresultcat"] for r in clean.clean_lab(df, "2020-01-01").collect()] == ["YesAHD"]


def test_treatment_and_period(frame):
    df = frame(
        PHARMACY,
        ("p", "1", "2023-01-01", "2023-02-01", "a", "ARV"),
        ("p", "1", "2023-03-01", "2023-04-01", "a", "pmtct"),
        ("p", "1", "2023-05-01", "2023-06-01", "a", "Other"),
        ("p", "1", "2023-06-01", "2023-07-01", "a", None),
        ("p", "1", "2019-06-01", "2019-07-01", "a", "ARV"),
        ("p", "1", "2023-12-31", "2024-07-01", "a", "ARV"),
    )
    out = clean.clean_pharmacy(df, "2020-01-01", "2023-12-31")
    assert [r["dispensedate"] for r in out.orderBy("dispensedate").collect()] == [
        date(2023, 1, 1), date(2023, 3, 1), date(2023, 12, 31),
    ]


def test_missing_due_uses_the_next_contacts_gap(frame):
    df = frame(
        "key string, c date, d date",
        ("a", "2022-01-01", None),
        ("a", "2022-03-01", "2022-05-30"),  # 90 days
        ("a", "2022-06-01", None),  # last: 30 days
    )
    out = dedup.impute_due(df, "c", "d").orderBy("c").collect()
    assert [r["nad_imputed"] for r in out] == [date(2022, 4, 1), date(2022, 5, 30), date(2022, 7, 1)]
    assert [r["nad_imputation_flag"] for r in out] == [1, 0, 1]


def test_one_row_per_day_prefers_the_latest_due_date(frame):
    df = frame(
        "key string, c date, d date, x string",
        ("a", "2022-01-01", None, "n"), ("a", "2022-01-01", "2022-02-01", "b"),
        ("a", "2022-01-01", "2022-02-01", "a"), ("a", "2022-01-01", "2022-01-15", "c"),
    )
    out = dedup.one_per_day(df, "c", "d", ["x"]).collect()
    assert [(r["d"], r["x"]) for r in out] == [(date(2022, 2, 1), "a")]


def test_key_parts_are_stripped_and_mflcode_is_used(frame):
    df = frame("patientpkhash string, mflcode int", (" p ", 12), (None, 3))
    assert [r["key"] for r in dedup.with_key(df).collect()] == ["p12"]


def visit_row(day, **changes):
    base = dict(
        PatientPKHash="P", SiteCode="1", VisitDate=day, NextAppointmentDate=None, VisitType=None, VisitBy=" Self ",
        TCAReason=None, Pregnant=None, Breastfeeding=None, StabilityAssessment=None, DifferentiatedCare=None,
        WHOStage=None, Height=None, Weight=None, Emr="SystemA", Adherence=None, CurrentRegimen=None,
    )
    return tuple({**base, **changes}.values())


VISIT = (
    "PatientPKHash string, SiteCode string, VisitDate string, NextAppointmentDate string, VisitType string, "
    "VisitBy string, TCAReason string, Pregnant string, Breastfeeding string, StabilityAssessment string, "
    "DifferentiatedCare string, WHOStage string, Height double, Weight double, Emr string, Adherence string, "
    "CurrentRegimen string"
)
DEM = "PatientPKHash string, MFLCode string, Sex string, MaritalStatus string, EducationLevel string, Occupation string, ARTOutcomeDescription string, StartARTDate string, DOB string"


def dem_row(key="P", dob="1990-01-01"):
    return (key, "1", " Female", "Single", None, "Farmer", "Active", "2020-01-01", dob)


def test_visits_without_demographics_drop_and_duplicates_do_not_fan_out(frame):
    df = frame(VISIT, visit_row("2022-01-01"), visit_row("2022-01-01", PatientPKHash="Q"), visit_row(" 2022-01-02"))
    out = clean.clean_visits(df, frame(DEM, dem_row(), dem_row()), "2020-01-01", "2023-01-01").collect()
    assert len(out) == 1  # a date with a leading blank is not a date
    assert (out[0]["visitby"], out[0]["sex"], out[0]["emr"], out[0]["key"]) == ("self", "female", "systema", "P1")


def test_regimen_switch_window(frame):
    df = frame(
        VISIT,
        visit_row("2022-01-01", CurrentRegimen="ABC"), visit_row("2022-03-01", CurrentRegimen="ABC"),
        visit_row("2022-06-01", CurrentRegimen="DEF"), visit_row("2023-06-02", CurrentRegimen="DEF"),
        visit_row("2024-12-01", CurrentRegimen="  "),
    )
    out = visits.visit_features(clean.clean_visits(df, frame(DEM, dem_row()), "2020-01-01", "2025-01-01"))
    assert [r["regimen_switch"] for r in out.orderBy("visitdate").collect()] == [0, 0, 1, 0, None]


def test_rows_without_valid_age_drop_before_tenure(frame):
    df = frame(VISIT, visit_row("2022-01-01"), visit_row("2022-02-01"))
    young = frame(DEM, dem_row(dob="2022-01-15"))
    out = visits.demographics(visits.visit_features(clean.clean_visits(df, young, "2020-01-01", "2025-01-01"))).collect()
    assert [(r["visitdate"], r["firstvisit"], r["timeatfacility"]) for r in out] == [(date(2022, 2, 1), 1, 0.0)]
    assert out[0]["maritalstatus"] == "minor"


# --- labels ---


def test_last_contact_unresolved(frame):
    v = frame(CONTACT, ("A", "2022-01-01", "2022-07-01", 0, "001"), ("A", "2022-07-01", "2022-10-01", 0, "001"))
    p = frame(DISPENSE, ("A", "2022-01-01", "2022-05-01", 0, "001"), ("A", "2022-07-01", "2022-11-01", 0, "001"))
    out = targets.create_targets(v, p, frame(PEOPLE, person("A", "active"))).collect()
    assert [(r["visitdate"], r["iit"]) for r in out] == [(date(2022, 1, 1), 0)]


def test_stated_due_date_wins_over_imputed(frame):
    v = frame(CONTACT, ("A", "2022-01-01", "2022-07-01", 1, "001"), ("A", "2022-07-01", "2022-10-01", 0, "001"))
    p = frame(DISPENSE, ("A", "2022-01-01", "2022-01-03", 0, "001"))
    out = targets.create_targets(v, p, frame(PEOPLE, person("A", "active"))).collect()
    assert [r["nad"] for r in out] == [date(2022, 1, 3)]


def test_late_return_is_an_interruption(frame):
    v = frame(CONTACT, ("A", "2022-01-01", "2022-03-01", 0, "001"), ("A", "2022-04-10", "2022-07-10", 0, "001"))
    p = frame(DISPENSE, ("A", "2022-01-01", "2022-03-01", 0, "001"))
    out = targets.create_targets(v, p, frame(PEOPLE, person("A", "active"))).orderBy("visitdate").collect()
    assert (out[0]["iit"], out[0]["visitdiff"]) == (1, 40)


@pytest.mark.parametrize("outcome, expected", [("died", 1), (" Active ", 2), (None, 1)])
def test_outcome_of_the_last_contact(frame, outcome, expected):
    v = frame(
        CONTACT,
        ("A", "2022-01-01", "2022-03-01", 0, "001"), ("A", "2022-04-10", "2022-07-10", 0, "001"),
        ("B", "2022-12-01", "2023-01-01", 0, "001"),
    )
    p = frame(DISPENSE, ("A", "2022-01-01", "2022-03-01", 0, "001"))
    out = targets.create_targets(v, p, frame(PEOPLE, person("A", outcome))).orderBy("visitdate").collect()
    assert len(out) == expected
    if expected == 2:
        assert (out[1]["iit"], out[1]["visitdiff"]) == (1, None)


def test_equality_with_the_site_maximum_counts(frame):
    v = frame(CONTACT, ("A", "2022-01-01", "2022-02-01", 0, "1"), ("B", "2022-03-03", "2022-04-01", 0, "1"))
    p = frame(DISPENSE)
    out = targets.create_targets(v, p, frame(PEOPLE, person("A", "active"), person("B", "active"))).collect()
    assert [(r["key"], r["iit"]) for r in out] == [("A", 1)]  # 2022-02-01 + 30 days = 2022-03-03


def test_single_unresolved_visit_gives_nothing(frame):
    v = frame(CONTACT, ("A", "2022-01-01", "2022-01-01", 0, "001"))
    p = frame(DISPENSE, ("A", "2022-01-01", "2022-01-01", 0, "001"))
    assert targets.create_targets(v, p, frame(PEOPLE, person("A", "active"))).count() == 0


def test_pharmacy_only_days_drop_and_due_dates_do_not_go_back(frame):
    v = frame(CONTACT, ("A", "2022-01-01", "2022-06-01", 0, "1"), ("A", "2022-02-01", "2022-03-01", 0, "1"))
    p = frame(DISPENSE, ("A", "2022-01-15", "2022-09-01", 0, "1"))
    merged = targets.merge_contacts(targets.stack_contacts(v, p))
    out = targets.due_never_earlier(merged).orderBy("visitdate").collect()
    assert [(r["nad"], r["nad_imputation_flag"], r["type"]) for r in out] == [
        (date(2022, 6, 1), 0, "clinical"), (date(2022, 6, 1), 1, "clinical"),
    ]
    numbers = targets.visit_number(targets.return_difference(merged)).orderBy("visitdate")
    assert [r["num_visit"] for r in numbers.collect()] == [1, 0]


def test_ties_after_the_wanted_columns_are_left_out(frame):
    """Rows of one day that tie: what is wanted is the same with and without the columns that come later in the order."""
    raw = "PatientPKHash string, SiteCode string, VisitDate string, NextAppointmentDate string, VisitType string, Emr string, Adherence string"
    same = [("p", "1", "2021-01-01", "2021-02-01", t, e, a) for t in ("b", "a", None) for e in ("y", None, "x") for a in ("poor", "good")]
    other = [("p", "1", "2021-03-01", "2021-04-01", "z", "w", "fair"), (None, "1", "2021-03-01", None, "z", "w", "fair")]
    df = frame(raw, *same, *other)
    whole = clean.daily_visits(df, "2020-01-01", "2023-01-01")
    for wanted in ([], ["visittype"], ["emr"], ["visittype", "adherence"]):
        less = clean.daily_visits(df, "2020-01-01", "2023-01-01", visits.inputs_of(wanted))
        kept = ["key", "visitdate", "nextappointmentdate", "sitecode", *wanted]
        assert rows(less.select(*kept), "visitdate") == rows(whole.select(*kept), "visitdate")
        assert less.columns == whole.columns
    assert visits.inputs_of(["regimen_switch", "bmi", "emr"]) == {"currentregimen", "weight", "emr"}
