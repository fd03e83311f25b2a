"""Scalar functions on the values whose results are known."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from steadycare.functions import clinical, parsing, person, recode


def test_dates(values):
    texts = ["2023-01-01T12:00:00", "invalid-date", None, "2023", "2023-1-1", "2023-1-1T1", "2023-02-30",
             "0000-01-01", "2023-01-01xyz", " 2023-01-01", "12023-01-01", "2024-02-29 10:00"]
    assert values(parsing.parse_date, "x string", texts) == [
        date(2023, 1, 1), None, None, None, date(2023, 1, 1), None, None,
        None, date(2023, 1, 1), None, None, date(2024, 2, 29),
    ]


def test_numbers(values):
    texts = ["12", " 1.5 ", "-3e2", ".5", "12d", "nan", "inf", "1,000", "<20", "LDL", "", None, "5."]
    assert values(parsing.parse_number, "x string", texts) == [
        12.0, 1.5, -300.0, 0.5, None, None, None, None, None, None, None, None, 5.0,
    ]


def test_blank_and_strip(values):
    assert values(parsing.blank_to_null, "x string", ["", "  ", "\t\n", " a ", None]) == [None, None, None, " a ", None]
    assert values(parsing.strip, "x string", ["\t a b\n "]) == ["a b"]


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (clinical.adherence, ["Good|Fair", "Fair", "Poor", "", None, "very good", "goodpoor"], [1, 0, 0, None, None, None, None]),
        (clinical.unscheduled, ["Unscheduled", "Routine", "UNSCHEDULED follow-up", None], [1, 0, 1, 0]),
        (clinical.stability, ["Unstable", "Not stable", "Stable", "", None, "  "], [0, 0, 1, None, None, None]),
        (
            clinical.delivery_model,
            ["Community ART Distribution Peer Led", "HCW Led", "Other", None],
            ["community art distribution", "hcw led", "other", None],
        ),
        (clinical.sex_flag, ["male", "female", None, "Male"], [1, 0, 0, 0]),
        (clinical.optimised_regimen, ["TDF/3TC/DTG", "abc/dtg", None], [1, 0, 0]),
        (
            clinical.lab_test,
            ["CD4 Count", "cd4 %", "CD4 percent", "HIV Viral Load", "hiv vl", "HB", None, "cd4 percent viral"],
            ["CD4", "Other", "Other", "VL", "VL", "Other", "Other", "VL"],
        ),
        (
            person.occupation,
            ["farmer", "Trader", "student", "driver", "employee", "none", "other", None, "ml engineer", " ", "null"],
            ["farmer", "trader", "student", "driver", "employee", "none", "other", None, "other", None, None],
        ),
        (
            person.education_level,
            ["none", "Primary", "secondary", "college", "university", "", None],
            ["none", "primary", "secondary", "college", None, None, None],
        ),
        (lambda c: recode.recode(c, recode.YES_NO), ["Yes", "No", "yes", None], [1, 0, None, None]),
        (
            lambda c: recode.recode(c, recode.ADHERENCE_GROUP, keep_others=True),
            ["good", "fair", "poor", "x", None],
            ["optimal", "suboptimal", "suboptimal", "x", None],
        ),
    ],
)
def test_text_recodes(values, function, given, expected):
    assert values(function, "x string", given) == expected


def test_marital_status(values):
    given = [("x", 14.0), ("single", 30.0), ("married", 30.0), ("cohabit", 30.0), ("divorced", 30.0), ("separated", 30.0),
             ("widowed", 30.0), ("Married Polygamous", 30.0), ("unknown", 30.0), (None, 30.0), (None, 3.0)]
    assert values(person.marital_status, "s string, a double", given) == [
        "minor", "single", "married", "married", "divorced", "divorced", "widowed", "polygamous", None, None, "minor",
    ]


def test_pregnancy(values):
    given = [("Yes", 25.0, 0), ("no", 25.0, 0), ("yes", 10.0, 0), ("unknown", 25.0, 0), (None, 25.0, 0), ("yes", 25.0, 1)]
    schema = "p string, a double, s int"
    assert values(clinical.reproductive_status, schema, given) == [1, 0, None, 0, None, None]

    def missing(p, a, s):
        return clinical.reproductive_missing(clinical.reproductive_status(p, a, s), a, s)

    assert values(missing, schema, given) == [0, 0, 0, 0, 1, 0]


def test_bmi(values):
    given = [(170.0, 70.0, 20.0), (160.0, 40.0, 20.0), (100.0, 15.0, 10.0), (170.0, 80.0, 20.0), (160.0, 90.0, 20.0),
             (40.0, 70.0, 20.0), (170.0, None, 20.0)]
    def band(h, w, a):
        return clinical.bmi_band(clinical.body_mass(h, w, a), a)

    assert values(band, "h double, w double, a double", given) == [
        "Normalweight", "Underweight", "Under15", "Overweight", "Obese", None, None,
    ]


def test_lab_category(values):
    given = [("VL", "LDL"), ("VL", "199"), ("VL", "200"), ("VL", None), ("CD4", "199"), ("CD4", "200"), ("CD4", "x")]
    assert values(clinical.lab_category, "t string, r string", given) == [
        "suppressed", "suppressed", "nonsuppressed", "suppressed", "NoAHD", "YesAHD", None,
    ]


def test_gap_groups(values):
    gaps = [1, 44, 45, 74, 75, 104, 105, 149, 150, 199, 200, 365, None]
    assert values(clinical.due_gap_group, "g int", gaps) == [30, 30, 60, 60, 90, 90, 120, 120, 180, 180, 30, 30, 30]


def test_logical_due(values):
    given = [("2022-01-01", "2022-01-01"), ("2022-01-01", "2022-01-02"), ("2022-01-01", "2023-01-01"),
             ("2022-01-01", "2023-01-02"), ("2022-01-01", None)]
    got = values(lambda c, d: clinical.logical_due(c.cast("date"), d.cast("date")), "c string, d string", given)
    assert got == [None, date(2022, 1, 2), date(2023, 1, 1), None, None]


def test_viral_class_and_disease(values):
    given = [("suppressed", 2.0, 2.0), (None, 6.0, 2.0), (None, 7.0, 6.0), (None, 7.0, 7.0), (None, None, 2.0)]
    assert values(clinical.viral_class, "v string, a double, f double", given) == [
        "suppressed", "earlyart", "restart", "novalidvl", "novalidvl",
    ]
    given = [(4.0, None, None), (30.0, "YesAHD", 1.0), (30.0, "NoAHD", 3.0), (30.0, None, 2.0), (None, None, None)]
    assert values(clinical.advanced_disease, "a double, c string, w double", given) == [1, 1, 1, 0, 0]


def test_calendar(values):
    days = ["2023-05-12", "2023-05-19", "2023-05-20"]
    assert values(lambda d: F.weekday(d.cast("date")), "d string", days) == [4, 4, 5]
    assert values(lambda d: person.is_friday(d.cast("date")), "d string", days) == [1, 1, 0]
    assert values(lambda d: person.month_index(d.cast("date"), "2022-11-01"), "d string", days) == [7, 7, 7]
    assert values(lambda p: person.shift_year_month(p, -1), "p int", [202301, 202312, 202302]) == [202212, 202311, 202301]
    assert values(lambda p: person.shift_year_month(p, 1), "p int", [202312]) == [202401]


def test_months_on_treatment(values):
    given = [("2022-03-01", "2022-01-01"), ("2022-01-01", "2022-02-01"), ("2022-01-01", None)]
    got = values(lambda v, s: clinical.months_on_treatment(v.cast("date"), s.cast("date")), "v string, s string", given)
    assert got == [pytest.approx(59 / 30.44), 0.0, None]


def test_not_relevant_and_risk(values):
    given = [(None, 0), (None, 1), ("1", 0)]
    assert values(recode.mark_not_relevant, "v string, m int", given) == ["NR", None, "1"]
    given = [(0.9, 0.8, 0.5), (0.8, 0.8, 0.5), (0.5, 0.8, 0.5), (None, 0.8, 0.5)]
    assert values(recode.risk_category, "s double, h double, m double", given) == ["high", "medium", "low", None]


def test_names(frame):
    df = frame("`Facility.Type_X` int, `A b` int", (1, 2))
    assert parsing.lower_names(df, "._").columns == ["facilitytypex", "a b"]
    assert parsing.underscore_names(df).columns == ["facility.type_x", "a_b"]


def test_expected_types(frame):
    df = frame("age string, sex string, bmi int, other string", ("12.5", "x", 3, "kept"))
    row = recode.cast_expected(df).first()
    assert (row["age"], row["sex"], row["bmi"], row["other"]) == (12.5, None, "3", "kept")


def test_big_driver_tables_are_shuffled_once_by_their_join_key(spark, tmp_path):
    from checks.tables import NEEDED, ClinicTables

    spark.range(50).selectExpr(*[f"id as {c}" for c in NEEDED["lineitem"]]).write.parquet(str(tmp_path / "lineitem.parquet"))
    plan = ClinicTables(spark, str(tmp_path))._read("lineitem")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [l_orderkey" in plan


def test_quick_paths_agree_with_the_plain_forms(values):
    odd = ["", " ", "\t\n", "x", " x", "x ", "\u0085", "  ", "é", "é ", "a b", "\x7f", " \x7f\r", "~", "!", "٠", "x\x0b", None]
    assert values(parsing.strip_once, "v string", odd) == values(parsing.strip, "v string", odd)
    plain = lambda v: F.when(~v.rlike(r"^\s*$"), v)
    assert values(parsing.blank_to_null, "v string", odd) == values(plain, "v string", odd)


def test_clean_text_needs_no_trimming_and_no_regular_expression(spark):
    df = spark.range(1).select(F.lit("x").alias("v"))
    for function, slow in ((parsing.blank_to_null, "RLIKE"), (parsing.strip_once, "trim")):
        sql = function(df["v"])._jc.toString()
        assert sql.startswith("CASE WHEN ") and slow.lower() in sql.lower().split(" else ")[1]


def test_clinic_queries_leave_no_method_to_the_interpreter(spark, tmp_path):
    from checks.tables import care

    care(spark, str(tmp_path))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
